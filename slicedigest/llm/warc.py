"""WARC archives of one zstandard frame per record, with the dictionary in a leading skippable frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows

# Fixed values of the format.
DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
VERSION = b"WARC/1.1"

GAP = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
"""An empty skippable frame. Spark's text writer puts it behind each record as its line end, and readers skip it."""

DEDUP_BYTES = 1000
SAMPLE_PAGES = 64
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 32_768
LEVEL = 3
MAX_RECORD = 1 << 31
_NAMES = uuid.uuid5(uuid.NAMESPACE_URL, "urn:warc:page")


def record_id(page: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMES, str(page))}>"


def _clean(value: str) -> str:
    """A header value on one line."""
    return "".join(c if c.isprintable() and c != " " else "".join(f"%{b:02X}" for b in c.encode()) for c in value)


def make_record(page: int | None, url: str | None, payload: bytes, sha1: str, refers_to: int | None) -> bytes:
    """A response record, or a revisit record without payload where ``refers_to`` names the page that has it."""
    head = [VERSION.decode()]
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head.append(f"WARC-Type: {'revisit' if revisit else 'response'}")
    head.append(f"WARC-Record-ID: {record_id(page)}")
    head.append("WARC-Date: 2024-01-01T00:00:00Z")
    head.append(f"WARC-Target-URI: {_clean(url) if url else 'urn:page:' + str(page)}")
    head.append(f"WARC-Payload-Digest: sha1:{sha1}")
    head.append(f"WARC-Block-Digest: sha1:{hashlib.sha1(block).hexdigest()}")
    if page is not None:
        head.append(f"Page-ID: {page}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        head.append(f"WARC-Refers-To: {record_id(refers_to)}")
        head.append(f"Refers-To-Page-ID: {refers_to}")
    head.append("Content-Type: application/http; msgtype=response")
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or plain content where there is too little to train on."""
    import zstandard

    cut = [s[i : i + 1024] for s in samples for i in range(0, min(len(s), SAMPLE_BYTES), 1024)]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, cut).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES].rjust(8, b" ")


def archive_frames(records: Iterable[tuple[bytes, bytes]]) -> Iterator[bytes]:
    """The frames of one archive from ``(record, payload)``: the dictionary, then a frame per record.

    The dictionary is made from the first records' payloads, at most ``SAMPLE_PAGES`` of them. No record, no frame.
    """
    import zstandard

    first, rest = [], iter(records)
    for record in rest:
        first.append(record)
        if len(first) >= SAMPLE_PAGES:
            break
    if not first:
        return
    book = _dictionary([p for _, p in first])
    yield struct.pack("<II", DICTIONARY_MAGIC, len(book)) + book
    dictionary = zstandard.ZstdCompressionDict(book)
    dictionary.precompute_compress(level=LEVEL)
    pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True, write_content_size=True)
    for record, _ in first:
        yield pack.compress(record)
    del first
    for record, _ in rest:
        yield pack.compress(record)


def write_archives(pages: DataFrame, path: str, dedup_bytes: int = DEDUP_BYTES) -> None:
    """Write a record per row of ``pages(page_id, url, html)`` into the folder ``path``, one archive per task.

    Among payloads of at least ``dedup_bytes`` that are equal, the largest ``page_id`` is a response and the others revisit
    it. Null html is an empty payload, a null url gets a name of its own; rows that repeat an id with one payload are one
    response each. Groups are found on digests alone: only sums per task are shuffled for them, and pages meet the groups that
    have several rows. Spark's writer commits the files, so a task that is lost leaves none behind.
    """
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1(F.encode("html", "UTF-8"))).withColumn("bytes", F.octet_length("html"))
    groups = rows.where(F.col("bytes") >= dedup_bytes).groupBy("sha1").agg(F.max("page_id").alias("keeper"), F.count("*").alias("n"))
    rows = rows.join(groups.where("n > 1").select("sha1", "keeper"), "sha1", "left")
    rows = rows.select("page_id", "url", "html", "sha1", F.expr("if(page_id <> keeper, keeper, null)").alias("refers_to"))

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        def records():
            for batch in batches:
                for page, url, html, sha1, refers in zip(*(batch[c] for c in ("page_id", "url", "html", "sha1", "refers_to")), strict=True):
                    payload = html.encode()
                    yield make_record(page, url, payload, sha1, refers), payload

        for frame in archive_frames(records()):
            yield (frame,)

    frames = map_rows(rows, run, "frame binary", rows=64)
    frames.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", GAP).mode("errorifexists").text(path)


class ArchiveError(ValueError):
    """What is wrong with an archive or record."""


def _frame_sizes(data: memoryview) -> Iterator[tuple[int, int, int]]:
    """``(start, length, magic)`` of each frame, from the frame and block headers alone."""
    at, end = 0, len(data)
    while at < end:
        if end - at < 8:
            raise ArchiveError(f"cut off at byte {at}")
        magic, size = struct.unpack_from("<II", data, at)
        if magic in SKIPPABLE:
            length = 8 + size
        elif magic == FRAME_MAGIC:
            length = _zstd_length(data, at)
        else:
            raise ArchiveError(f"no frame at byte {at}")
        if at + length > end:
            raise ArchiveError(f"frame at byte {at} is cut off")
        yield at, length, magic
        at += length


def _zstd_length(data: memoryview, at: int) -> int:
    descriptor = data[at + 4]
    single, checksum = descriptor >> 5 & 1, descriptor >> 2 & 1
    header = 5 + (not single) + (0, 1, 2, 4)[descriptor & 3] + (single, 2, 4, 8)[descriptor >> 6]
    pos = at + header
    while True:
        if pos + 3 > len(data):
            raise ArchiveError(f"frame at byte {at} is cut off")
        block = data[pos] | data[pos + 1] << 8 | data[pos + 2] << 16
        kind, size = block >> 1 & 3, block >> 3
        if kind == 3:
            raise ArchiveError(f"reserved block in the frame at byte {at}")
        pos += 3 + (1 if kind == 1 else size)
        if block & 1:
            return pos - at + 4 * checksum


def read_archive(data: bytes, max_record: int = MAX_RECORD) -> Iterator[tuple[int, bytes | None, str | None]]:
    """``(offset, record, error)`` for each record frame of an archive.

    The leading skippable frame, if it is the dictionary's, holds a dictionary, itself compressed or not; other skippable
    frames are passed over. A frame that does not decode gives an error and the next one is read; where frames can no longer
    be told apart, the rest is one error.
    """
    import zstandard

    view, book = memoryview(data), None
    try:
        for i, (at, length, magic) in enumerate(_frame_sizes(view)):
            if magic == DICTIONARY_MAGIC and i == 0:
                content = bytes(view[at + 8 : at + length])
                if content[:4] == struct.pack("<I", FRAME_MAGIC):
                    content = zstandard.ZstdDecompressor().decompressobj().decompress(content)
                book = zstandard.ZstdCompressionDict(content)
                continue
            if magic in SKIPPABLE:
                continue
            try:
                record = zstandard.ZstdDecompressor(dict_data=book).decompress(bytes(view[at : at + length]), max_output_size=max_record)
            except (zstandard.ZstdError, MemoryError) as error:
                yield at, None, f"frame does not decode: {error}"
                continue
            yield at, record, None
    except (ArchiveError, zstandard.ZstdError, IndexError, struct.error) as error:
        yield -1, None, str(error)


def parse_record(record: bytes) -> tuple[dict[str, str], bytes, bytes]:
    """Header fields by lower-case name, the block and the HTTP payload, all lengths and digests checked."""
    head, gap, rest = record.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not gap or not lines[0].startswith(b"WARC/1."):
        raise ArchiveError("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise ArchiveError("header line without a colon")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    for name in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if name not in fields:
            raise ArchiveError(f"{name} is missing")
    if not fields["content-length"].isdigit():
        raise ArchiveError("content-length is no number")
    length = int(fields["content-length"])
    block, tail = rest[:length], rest[length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise ArchiveError("content-length does not fit the record")
    declared = fields.get("warc-block-digest", "")
    if declared.startswith("sha1:") and declared[5:] != hashlib.sha1(block).hexdigest():
        raise ArchiveError("block digest differs")
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    declared = fields.get("warc-payload-digest", "")
    if fields["warc-type"] == "response" and declared.startswith("sha1:") and declared[5:] != hashlib.sha1(payload).hexdigest():
        raise ArchiveError("payload digest differs")
    return fields, block, payload


RECORDS = (
    "path string, frame_offset bigint, error string, record_type string, record_id string, target_uri string, page_id bigint, "
    "payload_digest string, refers_to_page bigint, http_length bigint, payload binary"
)


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """A row per record of the archives below ``path``; a frame or record that is damaged gives a row with its ``error``.

    One archive is read by one task and one record is decoded at a time. Revisits have no payload here; `resolve_revisits`
    looks theirs up. A folder without archives gives no rows.
    """
    files = spark.read.format("binaryFile").load(path).where("length > 0").select("path", "content")

    def number(value: str | None) -> int | None:
        return int(value) if value and value.lstrip("-").isdigit() else None

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for name, data in zip(batch["path"], batch["content"], strict=True):
                for at, record, error in read_archive(data):
                    if error is None:
                        try:
                            fields, block, payload = parse_record(record)
                        except ArchiveError as wrong:
                            error = str(wrong)
                    if error is not None:
                        yield name, at, error, *[None] * 8
                        continue
                    http = dict(x.split(b": ", 1) for x in block.partition(b"\r\n\r\n")[0].split(b"\r\n")[1:] if b": " in x)
                    yield (
                        name, at, None, fields["warc-type"], fields["warc-record-id"], fields.get("warc-target-uri"), number(fields.get("page-id")),
                        fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, number(fields.get("refers-to-page-id")),
                        number(http.get(b"Content-Length", b"").decode("ascii", "replace")), payload if keep_payload else None,
                    )

    spark_batches = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    try:
        return map_rows(files, run, RECORDS, rows=64)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", spark_batches)


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Sound records with ``payload_bytes``; a revisit takes it from the response that it refers to, found by page and digest.

    Only revisits and one row per response that has some are joined; a revisit whose response is missing gets null.
    """
    sound = records.where("error IS NULL").drop("error")
    own = F.when(F.col("record_type") == "response", F.octet_length("payload"))
    sound = sound.withColumn("payload_bytes", own.cast("bigint"))
    held = (
        sound.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_page"), F.col("payload_digest").alias("_digest"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    joined = sound.join(held, (F.col("refers_to_page") == F.col("_page")) & (F.col("payload_digest") == F.col("_digest")), "left")
    return joined.withColumn("payload_bytes", F.coalesce("payload_bytes", "_bytes")).drop("_page", "_digest", "_bytes")
