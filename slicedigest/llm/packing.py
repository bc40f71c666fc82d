"""Sum-of-squares online packing of documents into token windows."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.llm.encode import added_tokens, default_ranks, encoder

END_ID = 1
OPEN_WINDOWS = 1024
"""Most partly filled windows a task keeps. A task that would hold more closes them all, as at its end."""

SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
    "sequence_tokens bigint, ids binary"
)


class Levels:
    """Partly filled windows by fill level; ``counts[h]`` windows are filled to ``h``."""

    def __init__(self, size: int):
        self.size = size
        self.counts = np.zeros(size + 1, dtype=np.int64)
        self.windows: dict[int, list[list]] = {}
        self.open = 0

    def level_for(self, length: int) -> int:
        """The level at which the sum of squared counts ends up least; level 0 is a new window, ties go to the fullest."""
        n, top = self.counts, self.size - length
        change = 2 * (n[length : self.size + 1] - n[: top + 1]) + 2
        change[0] = 2 * n[length] + 1
        change[top] = 1 - 2 * n[top] if top else 0
        change[1:][n[1 : top + 1] == 0] = np.iinfo(np.int64).max
        return int(top - np.argmin(change[::-1]))

    def place(self, piece: tuple, length: int) -> list | None:
        """Put a piece into a window; returns the window if that fills it."""
        level = self.level_for(length)
        if level:
            window = self.windows[level].pop()
            self.counts[level] -= 1
            self.open -= 1
        else:
            window = []
        window.append(piece)
        if level + length == self.size:
            return window
        self.windows.setdefault(level + length, []).append(window)
        self.counts[level + length] += 1
        self.open += 1
        return None

    def drain(self) -> Iterator[list]:
        """Empty the array: the fullest windows are topped up with pieces cut from the emptiest ones.

        What is left at the end, less than a window, leaves as windows whose lengths are powers of two.
        """
        rest = [w for level in sorted(self.windows, reverse=True) for w in self.windows[level]]
        self.counts[:] = 0
        self.windows, self.open = {}, 0
        first, last = 0, len(rest) - 1
        while first < last:
            window, room = rest[first], self.size - _filled(rest[first])
            while room and first < last:
                piece = rest[last].pop()
                head, tail = _cut(piece, room)
                window.append(head)
                room -= len(head[4]) // 4
                if tail:
                    rest[last].append(tail)
                if not rest[last]:
                    last -= 1
            if room:
                break
            yield window
            first += 1
        if first <= last:
            yield from _powers(rest[first], self.size)


def _filled(window: list) -> int:
    return sum(len(p[4]) for p in window) // 4


def _cut(piece: tuple, length: int) -> tuple[tuple, tuple | None]:
    row, doc, tokens, start, ids = piece
    if len(ids) <= 4 * length:
        return piece, None
    return (row, doc, tokens, start, ids[: 4 * length]), (row, doc, tokens, start + length, ids[4 * length :])


def _powers(window: list, size: int) -> Iterator[list]:
    if (left := _filled(window)) == size:
        yield window
        return
    pieces = window[::-1]
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        part = []
        while room:
            head, tail = _cut(pieces.pop(), room)
            room -= len(head[4]) // 4
            part.append(head)
            if tail:
                pieces.append(tail)
        yield part


def pack_documents(docs: DataFrame, size: int = 2048, ranks_path: str | None = None, end_id: int = END_ID, keep_ids: bool = True) -> DataFrame:
    """Pack every row's text into windows of at most ``size`` tokens; one row per piece.

    A document is its text's ids and ``end_id``; null text counts as empty, and rows that repeat or share a ``doc_id`` are
    documents of their own. Whole windows are cut from a document's front; its rest goes online to the fill level that
    minimises the squared counts of partly filled windows, kept in an array of counts by level. Each partition packs what it
    reads, so nothing is shuffled, and closes its windows by cutting pieces to fit (`Levels.drain`): a window is either full
    or a power of two long. ``sequence_id`` is the partition's number times 2^40 plus the window's number in it. Columns
    besides ``doc_id`` and ``text`` are ignored; an empty table gives no rows.
    """
    path = ranks_path or default_ranks()

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        from pyspark import TaskContext

        bpe, end = encoder(path, added_tokens(path)), int(end_id).to_bytes(4, "little")
        base, levels, made, row = TaskContext.get().partitionId() << 40, Levels(size), 0, 0

        def emit(window: list) -> Iterator[tuple]:
            nonlocal made
            at, total = 0, _filled(window)
            for _, doc, tokens, start, ids in window:
                n = len(ids) // 4
                yield doc, start, n, zlib.crc32(ids), tokens, base + made, at, total, ids if keep_ids else None
                at += n
            made += 1

        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                ids = bpe.ids(text or "") + end
                n = len(ids) // 4
                whole = n - n % size
                for start in range(0, whole, size):
                    yield from emit([(row, doc, n, start, ids[4 * start : 4 * (start + size)])])
                if whole < n:
                    full = levels.place((row, doc, n, whole, ids[4 * whole :]), n - whole)
                    if full:
                        yield from emit(full)
                    elif levels.open > OPEN_WINDOWS:
                        for window in levels.drain():
                            yield from emit(window)
                row += 1
        for window in levels.drain():
            yield from emit(window)

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")), run, SCHEMA, rows=2048)
