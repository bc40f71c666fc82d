"""Links between the tokens of two tokenizers, by products of token-byte incidence matrices."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.llm.encode import MEMO_CHARS, MEMO_ENTRIES, default_ranks, encoder
from slicedigest.runtime import materialise

SLICE = 4_000_000
"""Id pairs whose counts are sent to the executors at once; more are sent in several passes over the documents' links."""
HELD_PAIRS = 1_000_000
"""Links and different pairs a task gathers before it adds them up, and before it hands its sums on."""


def default_pieces() -> str:
    """The 32k vocabulary of pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class Csr:
    """A sparse matrix by rows: row i has the columns ``indices[indptr[i]:indptr[i + 1]]`` with the values beside them."""

    indptr: np.ndarray
    indices: np.ndarray
    values: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def transpose(self) -> Csr:
        row, values = self.row_numbers(), self.values
        if (self.indices[1:] < self.indices[:-1]).any():
            order = np.argsort(self.indices, kind="stable")
            row, values = row[order], values[order]
        return Csr(_starts(self.indices, self.columns), row, values, self.rows)

    def times(self, other: Csr) -> Csr:
        """Gustavson's product: each row is the sum of the rows of ``other`` that its entries name, times their values.

        The rows are taken together: every entry fetches its row of ``other``, and what falls on one place is added up.
        """
        lengths = np.diff(other.indptr)[self.indices]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        if total == len(lengths) and (lengths == 1).all():  # each entry fetches one
            fetched, row, value = other.indptr[self.indices], self.row_numbers(), self.values
        else:
            fetched = np.arange(total) + np.repeat(other.indptr[self.indices] - (ends - lengths), lengths)
            row, value = np.repeat(self.row_numbers(), lengths), np.repeat(self.values, lengths)
        column = other.indices[fetched]
        value = value * other.values[fetched]
        place = row * other.columns + column
        if total and (place[1:] < place[:-1]).any():
            order = np.argsort(place, kind="stable")
            place, value = place[order], value[order]
        new = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]])) if total else np.empty(0, dtype=np.int64)
        place, value = place[new], np.add.reduceat(value, new) if total else value
        row, column = np.divmod(place, max(other.columns, 1))
        return Csr(_starts(row, self.rows), column, value, other.columns)

    def row_numbers(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))


def _starts(numbers: np.ndarray, count: int) -> np.ndarray:
    """Where each of ``count`` numbers begins among ``numbers`` once they are sorted, and where the last ends."""
    return np.concatenate([[0], np.cumsum(np.bincount(numbers, minlength=count))])


def token_bytes(ends: np.ndarray) -> Csr:
    """Incidence of tokens and bytes: token i has the bytes from the end of the one before it to its own."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(size), np.ones(size, dtype=np.int64), size)


def token_groups(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Incidence of tokens and groups: each token lies in the group that ends at the first cut not before its own end."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), np.ones(len(ends), dtype=np.int64), len(cuts))


@dataclass(frozen=True)
class Alignment:
    """Overlap links: entry (a, b) is how many bytes the tokens share. Group links: entry (a, b) is 1 if they share a group."""

    groups_a: Csr
    groups_b: Csr
    overlap: Csr
    shared: Csr


def align(ends_a: np.ndarray, ends_b: np.ndarray) -> Alignment:
    """Align two tokenizations of the same bytes, given where their tokens end."""
    cuts = ends_a[np.isin(ends_a, ends_b, assume_unique=True)]
    groups_a, groups_b = token_groups(ends_a, cuts), token_groups(ends_b, cuts)
    overlap = token_bytes(ends_a).times(token_bytes(ends_b).transpose())
    return Alignment(groups_a, groups_b, overlap, groups_a.times(groups_b.transpose()))


class _Pair:
    """Both tokenizers of a worker."""

    def __init__(self, ranks_path: str, pieces_path: str):
        import sentencepiece

        made = encoder(ranks_path)
        self.a, self.bytes_a = made.plain, made.byte_lengths
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        count = self.b.get_piece_size()
        self.pieces = [self._piece(i) for i in range(count)]
        self.lengths_b = np.array([len(p) for p in self.pieces], dtype=np.int64)
        self.apart = not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in range(count))
        self.words: dict[str, tuple | None] = {}
        self.sizes_a, self.lengths = self.bytes_a.tolist(), self.lengths_b.tolist()
        self.silent = 0 in self.lengths
        # ids as text, followed by what may come next: a comma, a bar or a semicolon
        most = max(count, len(self.bytes_a))
        self.marked = [f"{i}{mark}" for mark in (",", "|", ";") for i in range(most)]
        self.most = most

    def _piece(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[1:-1], 16)])
        return b"" if self.b.is_control(i) else self.b.id_to_piece(i).replace("▁", " ").encode()

    def encoded(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """The ids of both for each text; None if one of them does not give its bytes back."""
        spaced = [" " + t for t in texts]
        one, piece, size, out = self.a.encode_ordinary, self.pieces.__getitem__, self.sizes_a.__getitem__, []
        for text, b in zip(spaced, self.b.encode(texts, num_threads=1), strict=True):
            a, whole = one(text), text.encode()
            fine = b"".join(map(piece, b)) == whole and sum(map(size, a)) == len(whole)
            out.append((a, [x for x in b if self.lengths[x]] if self.silent else b) if fine else None)
        return out

    def words_of(self, text: str) -> list[str]:
        """The parts of a text at whose ends tokens of both end: its words if single spaces part them, else all of it.

        No token goes on behind a space, so such parts encode and align apart from each other.
        """
        return text.split(" ") if self.apart and " ".join(text.split()) == text.replace("\n", " ") else [text]

    def learn(self, texts: list[str]) -> list[list[str]]:
        """The words of each text, those not seen before aligned together and kept."""
        if len(self.words) >= MEMO_ENTRIES:
            self.words.clear()
        found = [self.words_of(t) if t else [] for t in texts]
        fresh = list({w: None for words in found for w in words if w not in self.words})
        self.words.update(zip(fresh, self._aligned(self.encoded(fresh)), strict=True))
        return found

    def forget(self, found: list[list[str]]) -> None:
        """Drop the long words of these texts, so that the table stays small."""
        for words in found:
            for w in words:
                if len(w) > MEMO_CHARS:
                    self.words.pop(w, None)

    def _aligned(self, ids: list[tuple[list[int], list[int]] | None]) -> list[tuple | None]:
        """Counts of tokens, groups, links and overlaps, the groups as text, and the linked id pairs of each word.

        Words are aligned as if they followed each other in one text: the matrices then have one block for each of them.
        """
        good = [x for x in ids if x is not None]
        if not good:
            return ids
        n_a, n_b = (np.array([len(x[k]) for x in good]) for k in (0, 1))
        a, b = (np.array([i for x in good for i in x[k]], dtype=np.int64) for k in (0, 1))
        made = align(np.cumsum(self.bytes_a[a]), np.cumsum(self.lengths_b[b]))
        word_of = np.repeat(np.arange(len(good)), n_a)
        pairs = (a[made.shared.row_numbers()] << 32 | b[made.shared.indices]).astype("<i8")
        groups = np.diff(np.concatenate([[-1], made.groups_a.indices[np.cumsum(n_a) - 1]]))
        links, overlaps = (np.bincount(word_of[m.row_numbers()], minlength=len(good)) for m in (made.shared, made.overlap))
        group = np.concatenate([made.groups_a.indices, made.groups_b.indices])
        side = np.repeat([0, 1], [len(a), len(b)])
        order = np.argsort(2 * group + side, kind="stable")
        token, part = np.concatenate([a, b])[order], (2 * group + side)[order]
        mark = np.where(np.concatenate([part[1:] != part[:-1], [True]]), 1 + side[order], 0)
        texts = list(map(self.marked.__getitem__, (mark * self.most + token).tolist()))
        ends, pair_ends = np.cumsum(n_a + n_b).tolist(), np.cumsum(links).tolist()
        counts = [x.tobytes() for x in np.stack([n_a, n_b, groups, links, overlaps], axis=1).astype("<i8")]
        out, at, pair_at = [], 0, 0
        for count, end, pair_end in zip(counts, ends, pair_ends, strict=True):
            out.append((count, "".join(texts[at:end])[:-1], pairs[pair_at:pair_end].tobytes()))
            at, pair_at = end, pair_end
        rows = iter(out)
        return [next(rows) if x is not None else None for x in ids]


@lru_cache(maxsize=2)
def _pair(ranks_path: str, pieces_path: str) -> _Pair:
    return _Pair(ranks_path, pieces_path)


def token_links(docs: DataFrame, ranks_path: str | None = None, pieces_path: str | None = None) -> DataFrame:
    """One row per document with the links between its tokens under a byte-level (A) and a piece vocabulary (B).

    ``n_a``, ``n_b`` count tokens, ``n_groups`` the groups between byte offsets at which tokens of both end, ``n_links`` the
    pairs of tokens in one group, ``n_overlaps`` the pairs that share bytes. A pair of ids counts the documents of the table
    that hold it linked; ``count_sum`` adds these counts up over the links, ``n_best`` counts the links whose count is the
    highest of their A id, ties included. ``groups_sha256`` hashes the ids of all groups. Null or empty texts, and those that
    the pieces do not give back, have no tokens: zeros and an empty string. Rows that repeat count as documents each; a null
    ``doc_id`` is kept; an empty table gives no rows; other columns are ignored.

    A task aligns a batch's new words together and keeps each text's different id pairs with their multiplicity, compressed, so nothing is
    encoded twice. Documents per pair are added up in tasks before they are shuffled. The counts then go to the links in slices
    of at most ``SLICE`` pairs, whole A ids each: sums over links add up over slices.
    """
    ranks_path, pieces_path = ranks_path or default_ranks(), pieces_path or default_pieces()

    def aligned(batches: Iterable[dict]) -> Iterator[tuple]:
        both, packer = _pair(ranks_path, pieces_path), zstandard.ZstdCompressor(level=1)
        for batch in batches:
            found = both.learn([t or "" for t in batch["text"]])
            for doc, words in zip(batch["doc_id"], found, strict=True):
                parts = [both.words[w] for w in words]
                if not parts or None in parts:
                    yield doc, 0, 0, 0, 0, 0, "", None
                    continue
                counts = np.frombuffer(b"".join([p[0] for p in parts]), dtype="<i8").reshape(-1, 5).sum(axis=0).tolist()
                pairs = np.frombuffer(b"".join([p[2] for p in parts]), dtype="<i8")
                keys, times = np.unique(pairs, return_counts=True)
                blob = packer.compress(np.diff(keys, prepend=0).astype("<i8").tobytes() + times.astype("<i8").tobytes())
                yield doc, *counts, hashlib.sha256(";".join([p[1] for p in parts]).encode()).hexdigest(), blob
            both.forget(found)

    schema = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_overlaps bigint, groups_sha256 string, links binary"
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text"))
    held = materialise(map_rows(rows, aligned, schema, rows=256))

    def counted(batches: Iterable[dict]) -> Iterator[tuple]:
        sums, parts, waiting = (np.empty(0, dtype=np.int64),) * 2, [], 0
        for batch in batches:
            for blob in batch["links"]:
                parts.append(_unpacked(blob)[0])
                waiting += len(parts[-1])
            if waiting >= HELD_PAIRS:
                sums, parts, waiting = _added(sums, parts), [], 0
                if len(sums[0]) >= HELD_PAIRS:
                    yield from zip(*(x.tolist() for x in sums), strict=True)
                    sums = (np.empty(0, dtype=np.int64),) * 2
        yield from zip(*(x.tolist() for x in _added(sums, parts)), strict=True)

    linked = held.where("links IS NOT NULL")
    counts = map_rows(linked.select("links"), counted, "pair bigint, n bigint", rows=65_536).groupBy("pair").agg(F.sum("n").alias("n"))
    counts = materialise(counts.withColumn("a", F.shiftright("pair", 32)))
    best = counts.groupBy("a").agg(F.max("n").alias("best"))
    counts = materialise(counts.join(best, "a").select("a", "pair", "n", (F.col("n") == F.col("best")).alias("best")))
    slices = -(-counts.count() // SLICE)
    if slices > 1:  # whole A ids, so that slices may be a little uneven
        slices *= 2
    sums = [held.select("doc_id", F.monotonically_increasing_id().alias("row"))]
    lit = F.lit(0).cast("bigint")
    if slices <= 1:
        table = _broadcast(counts)
        done = held.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_overlaps", "groups_sha256", "links")
        return map_rows(done, _looked_up(table), schema.replace("links binary", "n_best bigint, count_sum bigint"), rows=1024)
    total = None
    numbered = held.withColumn("row", F.monotonically_increasing_id())
    for s in range(slices):
        chosen = counts.where(F.pmod(F.xxhash64("a"), F.lit(slices)) == s)
        part = map_rows(
            numbered.where("links IS NOT NULL").select("row", "links"), _looked_up(_broadcast(chosen)), "row bigint, n_best bigint, count_sum bigint", rows=4096
        )
        total = materialise(part if total is None else total.unionByName(part).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    made = numbered.drop("links").join(total, "row", "left")
    return made.drop("row").withColumns({c: F.coalesce(c, lit) for c in ("n_best", "count_sum")})


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    """A document's different pairs, ascending, and how many links each has."""
    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype="<i8").reshape(2, -1)
    return np.cumsum(both[0]), both[1]


def _added(sums: tuple[np.ndarray, np.ndarray], parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Documents per pair: what was summed so far and one for each further pair."""
    keys = np.concatenate([sums[0], *parts])
    if not len(keys):
        return keys, sums[1]
    values = np.concatenate([sums[1], np.ones(len(keys) - len(sums[0]), dtype=np.int64)])
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(values, first)


def _broadcast(counts: DataFrame):
    """Pairs in ascending order, their counts and whether these are the highest of their A id; at most about ``SLICE`` rows."""
    got = counts.select("pair", "n", "best").toArrow().sort_by("pair")
    columns = tuple(got.column(c).to_numpy() for c in ("pair", "n", "best"))
    return counts.sparkSession.sparkContext.broadcast(columns)


def _looked_up(table):
    """Replace each row's links by how many are best and by the sum of their counts; pairs that the table lacks add nothing."""

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        pairs, counts, best = table.value
        for batch in batches:
            for *kept, blob in zip(*batch.values(), strict=True):
                n_best = count_sum = 0
                if blob is not None and len(pairs):
                    keys, times = _unpacked(blob)
                    at = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
                    times = np.where(pairs[at] == keys, times, 0)
                    n_best, count_sum = int((times * best[at]).sum()), int((times * counts[at]).sum())
                yield *kept, n_best, count_sum

    return run
