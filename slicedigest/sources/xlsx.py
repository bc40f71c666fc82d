"""Workbooks as a Spark source and sink, ``format("xlsx")``.

Rows have ``cells``, one short text per cell: a type letter (``n`` number, ``s`` text, ``d`` date or instant as a serial
number) and the value, null for an empty cell. Spark makes and reads those texts, so the Python side only moves them in and
out of XML, a row at a time; ``write_workbooks`` has Spark make the XML of a row too. A task writes and reads whole workbooks, and the cell budget of a workbook
bounds both.
"""

from __future__ import annotations

import codecs
import json
import posixpath
import re
import uuid
import zipfile
import zlib
from array import array
from collections.abc import Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from itertools import groupby
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr, unescape

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    In,
    InputPartition,
    WriterCommitMessage,
)

from slicedigest.functions.columns import named
from slicedigest.functions.digests import ALGORITHM, LIMBS, VERSION, carry, to_hex
from slicedigest.operators.digest import blank_digests, combine, row_limbs
from slicedigest.operators.export import Export
from slicedigest.operators.verify import missing_rows
from slicedigest.runtime import broadcast_if_small, materialise, use_checkpoint_dir

SCHEMA = "workbook string, sheet string, row bigint, cells array<string>"
WRITE_SCHEMA = "workbook string, sheet string, sheet_index int, row bigint, cells array<string>"
BATCH = 2048
PIECE = 1 << 16
"""Bytes of a sheet that are parsed together."""

# Fixed values of the file format.
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE_RELS = "http://schemas.openxmlformats.org/package/2006/relationships"
TYPES = "http://schemas.openxmlformats.org/package/2006/content-types"
DOCUMENT = "application/vnd.openxmlformats-officedocument.spreadsheetml"
HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
STYLES = (
    f'{HEAD}<styleSheet xmlns="{MAIN}"><fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="2"><xf/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
)
SHEET_START = f'{HEAD}<worksheet xmlns="{MAIN}"><sheetData>'.encode()
SHEET_END = b"</sheetData></worksheet>"
UNSTORABLE_CHARACTERS = [chr(n) for n in (*range(0x09), *range(0x0B, 0x20), 0xFFFE, 0xFFFF)]
UNSTORABLE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")
STORED = re.compile("_x([0-9A-Fa-f]{4})_")
EPOCH_SERIAL = 25569  # 1970-01-01
FIRST_SERIAL, LAST_SERIAL = -693593, 2958466  # the days of the years 1 to 9999, the last one exclusive
MAX_COLUMNS, MAX_ROWS = 16_384, 1_048_576
FIRST_SAFE_DATE = "1900-03-01"  # serial numbers below it are off by one day

# Rows and cells as ``WorkbookFile`` writes them. Whole cell, style, value, text.
_PLAIN = "[^<>&\x00-\x08\x0b-\x1f\ufffe\uffff]"
WRITTEN_ROW = re.compile('<row r="([1-9][0-9]{0,6})">')
WRITTEN_CELL = re.compile(
    f'(<c(?: s="(1)")?><v>({_PLAIN}+)</v></c>|<c t="inlineStr"><is><t xml:space="preserve">({_PLAIN}*(?:&(?:amp|lt|gt);{_PLAIN}*)*)</t></is></c>|<c/>)'
)
LONGEST_ROW = 1 << 20
"""Characters of a row beyond which a sheet is left to the XML parser."""


def store_text(text: str) -> str:
    return escape(UNSTORABLE.sub(lambda m: f"_x{ord(m[0]):04X}_", text))


def load_text(text: str) -> str:
    return STORED.sub(lambda m: chr(int(m[1], 16)), text)


def cells_xml(cells: list[str | None]) -> str:
    out = []
    for cell in cells:
        if cell is None:
            out.append("<c/>")
        elif cell[0] == "s":
            out.append(f'<c t="inlineStr"><is><t xml:space="preserve">{store_text(cell[1:])}</t></is></c>')
        else:
            style = ' s="1"' if cell[0] == "d" else ""
            out.append(f"<c{style}><v>{cell[1:]}</v></c>")
    return "".join(out)


class WorkbookFile:
    """One workbook being written: sheets one after the other, rows straight into the archive."""

    def __init__(self, stream) -> None:
        self.archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        self.names: list[str] = []
        self.part = None

    def start(self, name: str) -> None:
        self.finish_sheet()
        self.names.append(name)
        self.part = self.archive.open(f"xl/worksheets/sheet{len(self.names)}.xml", "w", force_zip64=True)
        self.part.write(SHEET_START)
        self.rows = 0

    def add(self, cells: str) -> None:
        """Add a row of cells that are XML already."""
        self.rows += 1
        self.part.write(f'<row r="{self.rows}">{cells}</row>'.encode())

    def finish_sheet(self) -> None:
        if self.part is not None:
            self.part.write(SHEET_END)
            self.part.close()
            self.part = None

    def close(self) -> None:
        self.finish_sheet()
        count = range(1, len(self.names) + 1)
        overrides = "".join(f'<Override PartName="/xl/worksheets/sheet{n}.xml" ContentType="{DOCUMENT}.worksheet+xml"/>' for n in count)
        sheets = "".join(f'<sheet name={quoteattr(name)} sheetId="{n}" r:id="rId{n}"/>' for n, name in zip(count, self.names))
        links = "".join(f'<Relationship Id="rId{n}" Type="{RELS}/worksheet" Target="worksheets/sheet{n}.xml"/>' for n in count)
        parts = {
            "[Content_Types].xml": f'<Types xmlns="{TYPES}"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{DOCUMENT}.sheet.main+xml"/><Override PartName="/xl/styles.xml" ContentType="{DOCUMENT}.styles+xml"/>{overrides}</Types>',
            "_rels/.rels": f'<Relationships xmlns="{PACKAGE_RELS}"><Relationship Id="rId1" Type="{RELS}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "xl/workbook.xml": f'<workbook xmlns="{MAIN}" xmlns:r="{RELS}"><sheets>{sheets}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{PACKAGE_RELS}">{links}<Relationship Id="rIdS" Type="{RELS}/styles" Target="styles.xml"/></Relationships>',
        }
        for name, text in parts.items():
            self.archive.writestr(name, HEAD + text)
        self.archive.writestr("xl/styles.xml", STYLES)
        self.archive.close()


def _column_number(reference: str) -> int:
    number = 0
    for letter in reference:
        if not letter.isalpha():
            break
        number = number * 26 + ord(letter.upper()) - 64
    return number - 1


def sheet_parts(archive: zipfile.ZipFile) -> dict[str, str]:
    """Return the archive member of every sheet, in workbook order."""
    links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(archive.read("xl/_rels/workbook.xml.rels"))}
    book = ElementTree.fromstring(archive.read("xl/workbook.xml"))
    targets = {s.get("name"): links[s.get(f"{{{RELS}}}id")] for s in book.iter(f"{{{MAIN}}}sheet")}
    return {name: t[1:] if t.startswith("/") else f"xl/{t}" for name, t in targets.items()}


def rich_text(item: ElementTree.Element | None) -> str:
    """Return a text item's content: plain or in formatted runs, without the phonetic guide beside it."""
    parts = []
    for child in item if item is not None else ():
        if child.tag == f"{{{MAIN}}}t":
            parts.append(child.text or "")
        elif child.tag == f"{{{MAIN}}}r":
            parts.append(child.findtext(f"{{{MAIN}}}t") or "")
    return load_text("".join(parts))


class SharedTexts:
    """The shared texts of a workbook, read when the first of them is asked for.

    They are kept as one run of bytes with their ends beside it, so a text costs its bytes and eight more.
    """

    def __init__(self, archive: zipfile.ZipFile) -> None:
        self.archive, self.ends, self.held = archive, None, bytearray()

    def _load(self) -> None:
        self.ends = array("Q", [0])
        if "xl/sharedStrings.xml" not in self.archive.namelist():
            return
        item_tag, root = f"{{{MAIN}}}si", None
        with self.archive.open("xl/sharedStrings.xml") as stream:
            for event, element in ElementTree.iterparse(stream, ("start", "end")):
                if root is None:
                    root = element
                elif event == "end" and element.tag == item_tag:
                    self.held += rich_text(element).encode("utf-8", "surrogatepass")
                    self.ends.append(len(self.held))
                    root.clear()

    def __len__(self) -> int:
        if self.ends is None:
            self._load()
        return len(self.ends) - 1

    def __getitem__(self, n: int) -> str:
        if not 0 <= n < len(self):
            raise IndexError(f"shared text {n} of {len(self)}")
        return self.held[self.ends[n] : self.ends[n + 1]].decode("utf-8", "surrogatepass")


def read_rows(stream, shared: Sequence[str]) -> Iterator[tuple[int, list[str | None]]]:
    """Yield ``(row from zero, cells)`` of one sheet, header included, forgetting each row once given.

    Rows and columns must ascend and stay inside the format's limits. Sheets in the very form that ``WorkbookFile`` writes are
    taken apart by patterns, which costs a third of parsing them; from the first row in any other form on, a sheet is parsed.
    """
    at = -1
    try:
        for at, cells in _written_rows(stream):
            yield at, cells
        return
    except OtherForm:
        stream.seek(0)
    yield from (row for row in _parsed_rows(stream, shared) if row[0] > at)


class OtherForm(Exception):
    """A sheet is not in the form that ``WorkbookFile`` writes."""


def _written_rows(stream) -> Iterator[tuple[int, list[str | None]]]:
    if stream.read(len(SHEET_START)) != SHEET_START:
        raise OtherForm
    decode, rest, at, more = codecs.getincrementaldecoder("utf-8")().decode, "", -1, True
    while more:
        piece = stream.read(PIECE)
        more = bool(piece)
        try:
            *rows, rest = (rest + decode(piece, not more)).split("</row>")
        except UnicodeDecodeError:
            raise OtherForm from None
        for row in rows:
            start = WRITTEN_ROW.match(row)
            found = WRITTEN_CELL.findall(row, start.end()) if start else []
            if not start or "".join([cell[0] for cell in found]) != row[start.end() :]:
                raise OtherForm
            before, at = at, int(start[1]) - 1
            if not before < at < MAX_ROWS or len(found) > MAX_COLUMNS:
                raise OtherForm
            yield at, [_written_cell(*cell) for cell in found]
        if len(rest) > LONGEST_ROW:
            raise OtherForm
    if rest != SHEET_END.decode():
        raise OtherForm


def _written_cell(whole: str, style: str, value: str, text: str) -> str | None:
    if value:
        return ("d" if style else "n") + value
    if whole == "<c/>":
        return None
    return "s" + (load_text(unescape(text)) if "&" in text or "_x" in text else text)


def _parsed_rows(stream, shared: Sequence[str]) -> Iterator[tuple[int, list[str | None]]]:
    cell_tag, value_tag, inline_tag = (f"{{{MAIN}}}{t}" for t in ("c", "v", "is"))
    at = -1
    for element in _row_elements(stream):
        before, at = at, int(element.get("r")) - 1 if element.get("r") else at + 1
        if not before < at < MAX_ROWS:
            raise ValueError(f"row {at + 1} behind row {before + 1}")
        cells: list[str | None] = []
        for cell in element.findall(cell_tag):
            if reference := cell.get("r"):
                column = _column_number(reference)
                if not len(cells) <= column < MAX_COLUMNS:
                    raise ValueError(f"column {column + 1} behind column {len(cells)}")
                cells += [None] * (column - len(cells))
            kind = cell.get("t", "n")
            if kind == "inlineStr":
                cells.append("s" + rich_text(cell.find(inline_tag)))
            elif (value := cell.findtext(value_tag)) is None:
                cells.append(None)
            elif kind == "n":
                cells.append(("n" if cell.get("s", "0") == "0" else "d") + value)
            elif kind == "s":
                cells.append("s" + shared[int(value)])
            else:
                cells.append("s" + load_text(value))
        if len(cells) > MAX_COLUMNS:
            raise ValueError(f"{len(cells)} columns")
        yield at, cells


def _row_elements(stream) -> Iterator[ElementTree.Element]:
    """Yield the rows of one sheet as elements.

    The sheet is parsed in pieces and the rows that a piece ends are taken together, which costs half of an event per element.
    """
    row_tag, data_tag = f"{{{MAIN}}}row", f"{{{MAIN}}}sheetData"
    parser = ElementTree.XMLPullParser(("start",))
    root, more = None, True
    while more:
        piece = stream.read(PIECE)
        more = bool(piece)
        parser.feed(piece) if more else parser.close()
        for _, element in parser.read_events():  # the events are only gone through for the errors among them
            root = element if root is None else root
        for data in root.findall(data_tag) if root is not None else ():
            done = len(data) - 1 if more else len(data)  # the last row may have begun only
            yield from (element for element in data[:done] if element.tag == row_tag)
            del data[:done]


def full_path(spark: SparkSession, path: str) -> str:
    """Return a path with its scheme: one without belongs to the session's default file system, as for Spark's own sources.

    On a cluster that must not be the local disk, which every executor has its own of. A path that names ``file:`` itself is
    taken as shared, and so is one below the checkpoint folder, which all executors reach by definition. Of a view of other
    file systems, which only Spark's readers can open, the path behind it is returned, also where the view is the default
    file system and the path has no scheme.
    """
    jvm = spark.sparkContext._jvm
    made = jvm.org.apache.hadoop.fs.Path(path)
    named_scheme = made.toUri().getScheme() is not None
    files = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if files.getUri().getScheme() == "viewfs":
        there, below, named_scheme = made, [], True
        while not files.exists(there) and there.getParent() is not None:
            below.append(there.getName())
            there = there.getParent()
        made = jvm.org.apache.hadoop.fs.Path("/".join([files.resolvePath(there).toString(), *reversed(below)]))
        files = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = files.makeQualified(made).toString()
    local = full.startswith("file:") and not named_scheme and not spark.sparkContext.master.startswith("local")
    if local and not _below(path, use_checkpoint_dir(spark)):
        raise ValueError(f"{path!r} is on each executor's own disk; name a shared folder with its scheme")
    return "file://" + full[len("file:") :] if re.match("file:/(?!/)", full) else full


def _below(path: str, folder: str) -> bool:
    inner, outer = (posixpath.normpath(re.sub("^file:/*", "/", p)) for p in (path, folder))
    return inner.startswith(outer.rstrip("/") + "/")


def _filesystem(path: str) -> tuple[pa.fs.FileSystem, str]:
    return pa.fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pa.fs.LocalFileSystem(), path)


@dataclass
class SheetsPartition(InputPartition):
    """Sheets that one task reads, as ``(path, sheet, archive member)``; a workbook that cannot be opened has neither."""

    sheets: list[tuple[str, str | None, str | None]]


@dataclass
class Written(WriterCommitMessage):
    """What one attempt left below the staging folder: ``(path there, name, bytes, CRC-32)`` per workbook."""

    books: list[tuple[str, str, int, int]]


SPLIT_BYTES = 1 << 20
"""Compressed sheets a task reads together; a larger sheet has a task of its own."""
LEAST_TASKS = 64
"""Tasks that a read is split into before small sheets are put together."""
OPENED = 16
"""Workbooks whose directories are read at once when a read is planned."""


class XlsxReader(DataSourceReader):
    """Plans by sheet: the directories of the workbooks say which sheets there are and how large.

    A sheet that cannot be read ends in a row with null row and cells, and the next one is read; where that holds for the whole
    workbook, the sheet is null too. ``books`` and ``sheets`` limit what is opened to the named ones; None means all.
    """

    def __init__(self, path: str, sheets: frozenset[str] | None = None, books: frozenset[str] | None = None) -> None:
        self.path, self.books, self.sheets = path, books, sheets

    def partitions(self) -> list[SheetsPartition]:
        fs, root = _filesystem(self.path)
        info = fs.get_file_info(root)
        found = [info] if info.is_file else fs.get_file_info(pa.fs.FileSelector(root, recursive=False))
        books = sorted(i.path for i in found if i.is_file and i.base_name.endswith(".xlsx") and (self.books is None or i.base_name in self.books))

        def listed(path: str) -> list[tuple[int, tuple[str, str | None, str | None]]]:
            with fs.open_input_file(path) as file:
                # A damaged file can fail in any way; only a store that does not answer is worth another attempt.
                try:
                    archive = zipfile.ZipFile(file)
                    parts = sheet_parts(archive)
                    sizes = {i.filename: i.compress_size for i in archive.infolist()}
                except (ConnectionError, TimeoutError):
                    raise
                except Exception:
                    return [(0, (path, None, None))]
                return [(sizes.get(member, 0), (path, sheet, member)) for sheet, member in parts.items() if self.sheets is None or sheet in self.sheets]

        with ThreadPoolExecutor(OPENED) as pool:
            every = [one for of_book in pool.map(listed, books) for one in of_book]
        limit = min(SPLIT_BYTES, sum(size for size, _ in every) // LEAST_TASKS)
        out, filled = [], 0
        for size, sheet in every:
            if not out or filled + size > limit:
                out.append(SheetsPartition([]))
                filled = 0
            out[-1].sheets.append(sheet)
            filled += size
        return out or [SheetsPartition([])]

    def read(self, partition: SheetsPartition) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        schema = pa.schema([("workbook", pa.string()), ("sheet", pa.string()), ("row", pa.int64()), ("cells", pa.list_(pa.string()))])

        def made(book: str, sheet: str | None, rows: list[tuple[int | None, list[str | None] | None]]) -> pa.RecordBatch:
            columns = [[book] * len(rows), [sheet] * len(rows), [n for n, _ in rows], [c for _, c in rows]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(columns, schema)], schema=schema)

        def rows(archive: zipfile.ZipFile, book: str, sheet: str, member: str, shared: SharedTexts) -> Iterator[pa.RecordBatch]:
            batch = []
            for row in read_rows(archive.open(member), shared):
                batch.append(row)
                if len(batch) == BATCH:
                    yield made(book, sheet, batch)
                    batch = []
            if batch:
                yield made(book, sheet, batch)

        for path, sheets in groupby(partition.sheets, key=lambda s: s[0]):
            book = path.rsplit("/", 1)[-1]
            with fs.open_input_file(path) as file:
                archive = shared = None
                for _, sheet, member in sheets:
                    try:
                        if sheet is not None:
                            if archive is None:
                                archive = zipfile.ZipFile(file)
                                shared = SharedTexts(archive)
                            yield from rows(archive, book, sheet, member, shared)
                        else:
                            yield made(book, None, [(None, None)])
                    except (ConnectionError, TimeoutError):
                        raise
                    except Exception:
                        yield made(book, sheet, [(None, None)])


class FilteringXlsxReader(XlsxReader):
    """Takes over filters that name workbooks or sheets, so that no other workbook is opened and no other sheet parsed."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            names = None
            if isinstance(f, EqualTo):
                names = {f.value}
            elif isinstance(f, In):
                names = set(f.value)
            if names is None or f.attribute not in (("workbook",), ("sheet",)):
                yield f
            elif f.attribute == ("workbook",):
                self.books = names if self.books is None else self.books & names
            else:
                self.sheets = names if self.sheets is None else self.sheets & names
                yield f  # a workbook that cannot be opened still gives a row, without a sheet


PUBLISHED = "_published-"
"""What the names of the lists of published workbooks begin with."""
MOVES = 16
"""Workbooks moved to their final names at once."""


class XlsxWriter(DataSourceArrowWriter):
    """Writes workbooks below a staging folder and publishes them when the job is through.

    Each attempt of a task has a folder of its own and reports sizes and checksums of what it wrote. The commit takes the
    attempts that Spark accepted, makes sure that their files are there at full length, moves them to their final names and
    writes the list of them last. Attempts that failed or lost leave nothing outside the staging folder, which goes with the
    commit or the abort; a job that fails leaves nothing at final names, and a commit that fails takes back what it moved.
    """

    def __init__(self, path: str) -> None:
        self.path = path
        self.job = uuid.uuid4().hex
        self.staging = f"_staging-{self.job}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _filesystem(self.path)
        attempt = uuid.uuid4().hex
        fs.create_dir(f"{root}/{self.staging}/{attempt}", recursive=True)
        done: list[tuple[str, str, int, int]] = []
        name = book = sheet = stream = None

        def finish() -> None:
            if book is not None:
                book.close()
                stream.close()
                done.append((f"{attempt}/{name}", name, stream.at, stream.crc))

        for batch in iterator:
            columns = batch.to_pydict()
            rows = columns["xml"] if "xml" in columns else map(cells_xml, columns["cells"])
            for workbook, title, cells in zip(columns["workbook"], columns["sheet"], rows):
                if workbook != name:
                    finish()
                    name = workbook
                    stream = _Seekless(fs.open_output_stream(f"{root}/{self.staging}/{attempt}/{name}"))
                    book, sheet = WorkbookFile(stream), None
                if title != sheet:
                    book.start(title)
                    sheet = title
                book.add(cells)
        finish()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _filesystem(self.path)
        books = sorted((b for m in messages if m is not None for b in m.books), key=lambda b: b[1])
        twice = [a[1] for a, b in zip(books, books[1:]) if a[1] == b[1]]
        if twice:
            raise ValueError(f"workbooks written by two tasks: {twice[:5]}")
        moved: list[str] = []

        def check(book: tuple[str, str, int, int]) -> None:
            size = fs.get_file_info(f"{root}/{self.staging}/{book[0]}").size
            if size != book[2]:
                raise OSError(f"{book[1]} has {size} bytes, {book[2]} were written")

        def publish(book: tuple[str, str, int, int]) -> None:
            final = f"{root}/{book[1]}"
            new = fs.get_file_info(final).type == pa.fs.FileType.NotFound
            fs.move(f"{root}/{self.staging}/{book[0]}", final)
            if new:
                moved.append(final)

        try:
            with ThreadPoolExecutor(MOVES) as pool:
                list(pool.map(check, books))
                list(pool.map(publish, books))
            listed = f"{root}/{self.staging}/{PUBLISHED}{self.job}.json"
            fs.create_dir(f"{root}/{self.staging}", recursive=True)
            with fs.open_output_stream(listed) as out:
                for _, name, size, crc in books:
                    out.write((json.dumps({"workbook": name, "bytes": size, "crc32": crc}) + "\n").encode())
            fs.move(listed, f"{root}/{PUBLISHED}{self.job}.json")
        except BaseException:
            for final in moved:
                fs.delete_file(final)
            raise
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _filesystem(self.path)
        staging = f"{root}/{self.staging}"
        if fs.get_file_info(staging).type != pa.fs.FileType.NotFound:
            fs.delete_dir(staging)


def published_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """Return per published workbook its recorded ``bytes`` and ``crc32``, and whether the file is ``whole``, ``changed`` or
    ``missing``; a workbook that no list names is ``unlisted``.

    Lists are read by Spark, files are summed up where they lie, each by one task in pieces. Of a workbook that was published
    again, each listed state counts.
    """
    fs, root = _filesystem(full_path(spark, path))
    names = [i.base_name for i in fs.get_file_info(pa.fs.FileSelector(root, allow_not_found=True)) if i.is_file]
    lists = [f"{full_path(spark, path)}/{n}" for n in names if n.startswith(PUBLISHED)]
    schema = "workbook string, bytes bigint, crc32 bigint"
    recorded = spark.createDataFrame([], schema)
    for one in lists:  # read by name: Spark itself passes over names that begin so
        listed = spark.createDataFrame([(one,)], "list string").mapInArrow(_lines_of(full_path(spark, path)), schema)
        recorded = recorded.unionByName(listed)
    there = spark.createDataFrame([(n,) for n in names if n.endswith(".xlsx")], "workbook string")
    found = there.repartition(max(1, min(len(names), 64)), "workbook").mapInArrow(_sums_of(full_path(spark, path)), schema)
    found = found.select("workbook", F.struct("bytes", "crc32").alias("found"))
    known = recorded.groupBy("workbook").agg(F.collect_set(F.struct("bytes", "crc32")).alias("states"), F.max("bytes").alias("bytes"), F.max("crc32").alias("crc32"))
    state = F.expr(
        "CASE WHEN states IS NULL THEN 'unlisted' WHEN found IS NULL THEN 'missing' WHEN array_contains(states, found) THEN 'whole' ELSE 'changed' END"
    )
    return known.join(found, "workbook", "full_outer").select("workbook", "bytes", "crc32", state.alias("state"))


def _lines_of(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        for batch in batches:
            for one in batch.column(0).to_pylist():
                with fs.open_input_file(f"{root}/{one.rsplit('/', 1)[-1]}") as file:
                    yield pa.RecordBatch.from_pylist([json.loads(line) for line in file.read().splitlines()], schema=_SUMS)

    return run


def _sums_of(path: str):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _filesystem(path)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                size = crc = 0
                with fs.open_input_stream(f"{root}/{name}", compression=None) as file:
                    while piece := file.read(1 << 20):
                        size, crc = size + len(piece), zlib.crc32(piece, crc)
                yield pa.RecordBatch.from_pylist([{"workbook": name, "bytes": size, "crc32": crc}], schema=_SUMS)

    return run


_SUMS = pa.schema([("workbook", pa.string()), ("bytes", pa.int64()), ("crc32", pa.int64())])


class _Seekless:
    """An output stream that only goes forward, as object stores give them; the archive then needs no seeking."""

    def __init__(self, stream) -> None:
        self.stream, self.at, self.crc = stream, 0, 0

    def write(self, data) -> int:
        self.stream.write(data)
        self.at += len(data)
        self.crc = zlib.crc32(data, self.crc)
        return len(data)

    def tell(self) -> int:
        return self.at

    def flush(self) -> None:
        self.stream.flush()

    def close(self) -> None:
        self.stream.close()


class XlsxDataSource(DataSource):
    """``spark.read.format("xlsx").load(folder)`` and ``df.write.format("xlsx").mode("append").save(folder)``."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: T.StructType) -> XlsxReader:
        sheets, books = (frozenset(json.loads(self.options[k])) if self.options.get(k) else None for k in ("sheets", "books"))
        kind = FilteringXlsxReader if self.options.get("pushdown") == "true" else XlsxReader
        return kind(self.options["path"], sheets, books)

    def writer(self, schema: T.StructType, overwrite: bool) -> XlsxWriter:
        return XlsxWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    spark.dataSource.register(XlsxDataSource)


def cell_text(value: Column, dtype: T.DataType) -> Column:
    """Render a converted column as cell texts."""
    if isinstance(dtype, T.StringType):
        return F.concat(F.lit("s"), value)
    if isinstance(dtype, T.DateType):
        safe = value >= F.lit(FIRST_SAFE_DATE).cast("date")
        return F.when(safe, F.concat(F.lit("d"), (F.unix_date(value) + EPOCH_SERIAL).cast("string"))).otherwise(F.concat(F.lit("s"), value.cast("string")))
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.timestamp_diff("SECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), value)
        safe = value >= F.lit(FIRST_SAFE_DATE).cast("timestamp_ntz")
        return F.when(safe, F.concat(F.lit("d"), (seconds / 86400 + EPOCH_SERIAL).cast("string"))).otherwise(F.concat(F.lit("s"), value.cast("string")))
    if isinstance(dtype, (T.DoubleType, T.NullType)):
        return F.concat(F.lit("n"), value.cast("string"))
    return F.concat(F.lit("s"), value.cast("string"))


def cell_xml(cell: Column) -> Column:
    """A cell text as XML, as ``cells_xml`` writes it."""
    letter, rest = F.substring(cell, 1, 1), F.substring(cell, 2, 2_147_483_647)
    text = F.regexp_replace(rest, "_(?=x[0-9A-Fa-f]{4}_)", "_x005F_")
    for stored in UNSTORABLE_CHARACTERS:
        text = F.replace(text, F.lit(stored), F.lit(f"_x{ord(stored):04X}_"))
    for plain in "&<>":
        text = F.replace(text, F.lit(plain), F.lit(escape(plain)))
    text = F.when(rest.rlike(f"[&<>]|{UNSTORABLE.pattern}"), text).otherwise(rest)
    return (
        F.when(cell.isNull(), "<c/>")
        .when(letter == "s", F.concat(F.lit('<c t="inlineStr"><is><t xml:space="preserve">'), text, F.lit("</t></is></c>")))
        .otherwise(F.concat(F.when(letter == "d", '<c s="1"><v>').otherwise("<c><v>"), rest, F.lit("</v></c>")))
    )


def cell_value(text: Column, dtype: T.DataType) -> Column:
    """Read a cell text at its recorded type; null when it does not fit."""
    letter, rest = F.substring(text, 1, 1), F.substring(text, 2, 2_147_483_647)
    number = F.when(letter != "s", rest.try_cast("double"))
    number = F.when(F.abs(number) < float("inf"), number)
    serial = F.when((number >= FIRST_SERIAL) & (number < LAST_SERIAL), number)
    if isinstance(dtype, T.StringType):
        return F.when(letter == "s", rest)
    if isinstance(dtype, T.DateType):
        day = (F.round(serial) - EPOCH_SERIAL).cast("int")
        return F.when(letter == "s", rest.try_cast("date")).otherwise(F.date_from_unix_date(day))
    if isinstance(dtype, T.TimestampNTZType):
        seconds = F.round((serial - EPOCH_SERIAL) * 86400).cast("bigint")
        return F.when(letter == "s", rest.try_cast("timestamp_ntz")).otherwise(F.timestamp_add("SECOND", seconds, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")))
    if isinstance(dtype, T.DoubleType):
        return number
    return F.lit(None) if isinstance(dtype, T.NullType) else rest.try_cast(dtype)


def sheet_rows(export: Export) -> tuple[DataFrame, list[Column]]:
    """Return every row of every sheet of an export as cell texts, header first, and the order that rows take in a workbook.

    Sources of any width come together. Each carries its own order columns, which are null for the others: a sheet has one
    source, so theirs decide nothing in it.
    """
    sorts = {a: [(f"__{n}_{i}", key) for i, key in enumerate(arranged.sorts)] for n, (a, arranged) in enumerate(export.arranged.items())}
    carried = {name: export.placed[a].schema[key.column].dataType for a, keys in sorts.items() for name, key in keys}
    frames = []
    for alias, arranged in export.arranged.items():
        placed = export.placed[alias]
        types = {f.name: f.dataType for f in placed.schema.fields}
        cells = F.array(*[cell_text(named(c), types[c]) for c in arranged.columns])
        own = {name: named(key.column) for name, key in sorts[alias]}
        keys = [own.get(name, F.lit(None).cast(t)).alias(name) for name, t in carried.items()]
        frames.append(placed.select("workbook", "sheet", "sheet_index", F.lit(1).cast("bigint").alias("row"), cells.alias("cells"), *keys))
        header = F.array(*[F.lit("s" + c) for c in arranged.columns])
        mine = export.plan.where(F.col("alias") == alias)
        nothing = [F.lit(None).cast(t).alias(name) for name, t in carried.items()]
        frames.append(mine.select("workbook", "sheet", "sheet_index", F.lit(0).cast("bigint").alias("row"), header.alias("cells"), *nothing))
    order = [F.col("workbook"), F.col("sheet_index"), F.col("row")]
    return reduce(DataFrame.unionByName, frames), order + [key.sorted(F.col(name)) for keys in sorts.values() for name, key in keys]


def workbook_rows(export: Export) -> DataFrame:
    """Return an export's rows as the writer wants them: each workbook whole in one task, moved and sorted once."""
    rows, order = sheet_rows(export)
    return rows.repartition("workbook").sortWithinPartitions(*order).select("workbook", "sheet", "sheet_index", "row", "cells")


def xml_rows(export: Export) -> DataFrame:
    """Return an export's rows in the order of the writer, the cells of each as one XML text that Spark makes."""
    return workbook_rows(export).select("workbook", "sheet", F.concat_ws("", F.transform("cells", cell_xml)).alias("xml"))


def write_workbooks(export: Export, path: str) -> None:
    """Write an export's workbooks, each by one task and many at once.

    The steps are those of ``format("xlsx")`` as a map over tasks whose messages are gathered, since a Python data source keeps
    processes of its own beside the driver for every step, until the session ends.
    """
    spark = export.plan.sparkSession
    writer = XlsxWriter(full_path(spark, path))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books = writer.write(iter(batches)).books
        yield pa.RecordBatch.from_pylist([dict(zip(_BOOKS.names, book)) for book in books], schema=_BOOKS)

    try:
        done = xml_rows(export).mapInArrow(run, "staged string, workbook string, bytes bigint, crc32 bigint").collect()
        writer.commit([Written([tuple(row) for row in done])])
    except BaseException:
        writer.abort([])
        raise


_BOOKS = pa.schema([("staged", pa.string()), ("workbook", pa.string()), ("bytes", pa.int64()), ("crc32", pa.int64())])

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def read_workbooks(spark: SparkSession, path: str, sheets: list[str] | None = None, books: list[str] | None = None) -> DataFrame:
    """Return ``workbook, sheet, row, cells`` of every sheet below a folder, or of those named; row zero is the header as written.

    Only workbooks named in ``books`` are opened, if it is given. Where the session has
    ``spark.sql.python.filterPushdown.enabled``, the folder is read as ``format("xlsx")``: filters on ``workbook`` and ``sheet``
    decide what is opened. Else the read is planned here and now and its tasks are dealt as rows, without the processes that a
    Python data source keeps beside the driver.
    """
    if spark.conf.get(PUSHDOWN, "false") == "true":
        register(spark)
        named_ones = {"sheets": sheets, "books": books}
        options = {k: json.dumps(v) for k, v in named_ones.items() if v}
        return spark.read.format("xlsx").options(pushdown="true", **options).load(full_path(spark, path))
    reader = XlsxReader(full_path(spark, path), frozenset(sheets) if sheets else None, frozenset(books) if books else None)
    planned = reader.partitions()
    tasks = spark.createDataFrame([(n, p.sheets) for n, p in enumerate(planned)], "task int, sheets array<struct<path: string, sheet: string, member: string>>")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed in batch.column("sheets").to_pylist():
                yield from reader.read(SheetsPartition([(s["path"], s["sheet"], s["member"]) for s in listed]))

    return tasks.repartitionById(len(planned), "task").mapInArrow(run, SCHEMA)


def unreadable_books(cells: DataFrame) -> DataFrame:
    """Return workbooks, and the sheet reached in each, whose file could not be read to its end."""
    return cells.where(F.col("row").isNull()).select("workbook", "sheet")


def written_headers(cells: DataFrame) -> DataFrame:
    """Return every sheet's header as written, before any name is changed."""
    return cells.where(F.col("row") == 0).select("workbook", "sheet", F.transform("cells", lambda c: F.substring(c, 2, 2_147_483_647)).alias("header"))


def read_back_sheets(cells: DataFrame, schema: T.StructType | dict[str, T.StructType], manifest: DataFrame) -> DataFrame:
    """Return what verification wants of workbooks read back: per sheet its header, rows, digest and readability.

    ``schema`` is the recorded schema of the sheets' source, or one per alias where a manifest has several sources; ``manifest``
    holds the fragments. The files are read once: every row is typed by the schema of the source that the manifest gives its
    sheet to, and a sheet nobody recorded by the first one. Header,
    lost cells, row count and digest come out of one aggregate. Trailing rows that hold nothing, which a sheet cannot
    record, are digested apart and added. A sheet that is not there has no row in the result, one nobody recorded has; pass
    the result to ``verify_fragments`` with ``every_sheet_seen``.
    """
    key = ["workbook", "sheet"]
    schemas = schema if isinstance(schema, dict) else {None: schema}
    header = F.when(F.col("row") == 0, F.transform("cells", lambda c: F.substring(c, 2, 2_147_483_647))).alias("__header")
    carried = {c: F.col(c) for c in (*key, "row", "__header", "dropped")}
    if len(schemas) == 1:
        (only,) = schemas.values()
        limbs = row_limbs(typed_cells(cells, only, F.col("row"), header), only.names, carried)
    else:
        owners = broadcast_if_small(materialise(manifest.select(*key, F.col("alias").alias("__alias"))))
        owned = cells.join(owners, key, "left").withColumn("__alias", F.coalesce("__alias", F.lit(next(iter(schemas)))))
        limbs = _limbs_by_source(owned, schemas, header, list(carried))
    data = F.col("row") > 0
    sums = [F.expr(f"coalesce(sum(__{p}{n}) FILTER (WHERE row > 0), 0L) AS __{p}{n}") for p in "fr" for n in range(LIMBS)]
    seen = limbs.groupBy(*key).agg(
        F.max("__header").alias("header"),
        F.coalesce(F.sum(F.when(data, F.col("dropped"))), F.lit(0).cast("bigint")).alias("dropped"),
        F.count_if(data).alias("rows"),
        F.bool_or(F.col("row").isNull()).alias("broken"),
        *sums,
    )
    whole = lambda p: F.expr(to_hex(carry([f"__{p}{n}" for n in range(LIMBS)])))
    seen = materialise(seen.select(*key, "header", "dropped", "rows", "broken", whole("f").alias("digest"), whole("r").alias("row_digest")))
    there = seen.where(F.col("header").isNotNull())
    short = missing_rows(there, manifest.join(there.select(*key), key, "left_semi"))  # an absent sheet is not padded
    widths = {alias: len(one.fields) for alias, one in schemas.items()}
    if len(set(widths.values())) == 1:
        blank = blank_digests(short.where("missing > 0"), next(iter(widths.values())))
    else:
        owned = short.where("missing > 0").join(manifest.select(*key, "alias"), key)
        width = F.create_map(*[F.lit(x) for pair in widths.items() for x in pair])[F.col("alias")]
        blank = blank_digests(owned, width)
    facts = [F.col(c) for c in ("algorithm", "version", "scope")]
    read = there.select(
        *key, "rows", "digest", "row_digest", F.lit(ALGORITHM).alias("algorithm"), F.lit(VERSION).alias("version"), F.lit("dataframe").alias("scope")
    )
    total = combine(read.unionByName(blank.select(*key, "rows", "digest", "row_digest", *facts)), key).select(*key, F.col("rows").alias("__rows"), F.col("digest").alias("__digest"))
    broken = seen.where(F.col("broken") & F.col("sheet").isNull()).select("workbook").distinct().withColumn("__broken", F.lit(True))
    sheets = seen.where(F.col("sheet").isNotNull()).select(*key, "header", "dropped", "broken", F.col("rows").alias("__found"))
    unreadable = F.coalesce("__broken", F.lit(False)) | F.coalesce("broken", F.lit(False)) | (F.coalesce("dropped", F.lit(0)) > 0)
    return (
        manifest.select(*key, F.col("rows").alias("expected"))
        .join(sheets, key, "full_outer")
        .join(total, key, "left")
        .join(broken, "workbook", "left")
        .where(F.col("__found").isNotNull() | F.col("__broken"))
        .select(
            *key,
            "header",
            F.col("__rows").alias("rows"),
            F.col("__digest").alias("digest"),
            (unreadable | F.coalesce(F.col("__found") > F.col("expected"), F.lit(False))).alias("unreadable"),
        )
    )


def _limbs_by_source(owned: DataFrame, schemas: dict[str, T.StructType], header: Column, carried: list[str]) -> DataFrame:
    """Return row limbs of sheets of several sources, each row typed by its own source, from one read of the files."""
    sums = [f"__{p}{n}" for p in "fr" for n in range(LIMBS)]
    none = [F.lit(None).cast("bigint").alias(f"__was{c}") for c in sums]
    out = owned.select("workbook", "sheet", "row", header, "__alias", F.col("cells").alias("__cells"), F.lit(0).alias("__lost"), *none)
    for n, (alias, schema) in enumerate(schemas.items()):
        mine = F.col("__alias") == alias
        fields = T.StructType([T.StructField(f"__s{n}_{i}", f.dataType) for i, f in enumerate(schema.fields)])
        kept = [c for c in out.columns if c not in ("workbook", "sheet")]
        typed = typed_cells(out.withColumn("cells", F.when(mine, F.col("__cells"))), fields, *[F.col(c) for c in kept])
        limbs = row_limbs(typed, fields.names, {c: F.col(c) for c in (*out.columns, "dropped")})
        found = [F.when(mine, F.col(c)).otherwise(F.col(f"__was{c}")).alias(f"__was{c}") for c in sums]
        lost = F.when(mine, F.coalesce("dropped", F.lit(0))).otherwise(F.col("__lost")).alias("__lost")
        out = limbs.select(*[c for c in out.columns if not c.startswith("__was") and c != "__lost"], lost, *found)
    named_columns = {"dropped": "__lost"}
    return out.select(*[F.col(named_columns.get(c, c)).alias(c) for c in carried], *[F.col(f"__was{c}").alias(c) for c in sums])


def typed_cells(cells: DataFrame, schema: T.StructType, *kept: Column) -> DataFrame:
    """Return cells at the recorded types, with ``dropped``: how many cells of the row did not fit theirs."""
    out, lost = [], F.lit(0)
    for n, field in enumerate(schema.fields):
        text = F.get("cells", F.lit(n))
        value = cell_value(text, field.dataType)
        out.append(value.alias(field.name))
        lost = lost + (text.isNotNull() & value.isNull()).cast("int")
    extra = (F.size("cells") > len(schema.fields)) & F.exists(F.slice("cells", F.lit(len(schema.fields) + 1), F.size("cells")), lambda c: c.isNotNull())
    return cells.select(*out, "workbook", "sheet", *kept, (lost + extra.cast("int")).alias("dropped"))


def typed_sheets(cells: DataFrame, schema: T.StructType) -> DataFrame:
    """Return the data rows of sheets at the recorded types."""
    return typed_cells(cells.where(F.col("row") > 0), schema, F.col("row"))
