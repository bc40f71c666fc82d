"""SimHash near-duplicates by segment bit counts."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows, small_batches
from slicedigest.llm.components import component_roots
from slicedigest.runtime import materialise

SEED = 42
SHINGLE = 4
DISTANCE = 4
SEGMENTS = 32
"""Segments of two bits each, so a fingerprint becomes 32 counts of 0, 1 or 2."""
BLOCKS = 7
"""Parts of the count vector. With at most four differing bits, at least three parts agree in all their counts."""
SMALL_CELL = 24
"""A cell of more fingerprints leaves a spanning forest of its links instead of every pair."""


def fingerprint(text: str, shingle: int = SHINGLE) -> int:
    """The 64-bit fingerprint of a whole text; 0 if it has no word."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    return majority_bits(np.array(hashes, dtype=np.uint64))


def majority_bits(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half of the hashes."""
    bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    return int.from_bytes(np.packbits(2 * bits.sum(axis=0, dtype=np.int64) > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the fingerprint as a signed long) of every row."""

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                fp = fingerprint(text or "", shingle)
                yield doc, fp - (1 << 64) if fp >> 63 else fp

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")), run, "doc_id bigint, fp bigint")


def segment_counts(fps: np.ndarray) -> np.ndarray:
    """The bit count of each two-bit segment, written in unary (0: 00, 1: 01, 2: 11).

    The Manhattan distance of two count vectors is then the number of bits in which their unary forms differ.
    """
    even = np.uint64(0x5555555555555555)
    low, high = fps & even, (fps >> np.uint64(1)) & even
    return low | high | ((low & high) << np.uint64(1))


def _masks() -> list[int]:
    """For each part of the count vector the bits of its segments, in whole segments of two bits."""
    bounds = [round(i * SEGMENTS / BLOCKS) for i in range(BLOCKS + 1)]
    return [((1 << 2 * (b - a)) - 1) << 2 * a for a, b in zip(bounds, bounds[1:], strict=False)]


COMBINATIONS = list(combinations(range(BLOCKS), BLOCKS - DISTANCE))


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    """A one-to-one mixing of 64-bit words."""
    with np.errstate(over="ignore"):
        x = x ^ np.uint64((salt + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def cells(fps: DataFrame) -> DataFrame:
    """Grid cells ``(cell, fp)`` of distinct fingerprints: one per choice of three parts of the count vector.

    A difference in one bit moves one count by one, so the Manhattan distance of the counts is at most the number of differing
    bits. Points within distance four differ in at most four of the seven parts and share a cell for at least one choice.
    """
    small_batches(fps.sparkSession)
    masks = _masks()
    chosen = [np.uint64(sum(masks[b] for b in c)) for c in COMBINATIONS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            counts = segment_counts(fp.view(np.uint64))
            keys = np.concatenate([_mix(counts & m, i).view(np.int64) for i, m in enumerate(chosen)])
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(fp, len(chosen)))], names=["cell", "fp"])

    return fps.select("fp").mapInArrow(run, "cell bigint, fp bigint")


def _close(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Pairs within the distance: first by the counts' Manhattan distance, then by the differing bits themselves."""
    near = np.bitwise_count(segment_counts(a) ^ segment_counts(b)) <= DISTANCE
    near[near] = np.bitwise_count(a[near] ^ b[near]) <= DISTANCE
    return near


def _forest(fps: np.ndarray) -> Iterator[tuple[int, int]]:
    """Links that span the components of one cell. A fingerprint that was reached is compared no more as a target."""
    rest = fps[1:]
    frontier = [fps[0]] if len(fps) else []
    while len(rest):
        if not frontier:
            frontier, rest = [rest[0]], rest[1:]
            continue
        at = frontier.pop()
        near = _close(np.full(len(rest), at), rest)
        for other in rest[near]:
            yield int(at.view(np.int64)), int(other.view(np.int64))
        frontier.extend(rest[near])
        rest = rest[~near]


def _links(cell: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links inside the runs of equal cells of sorted arrays."""
    bounds = np.concatenate([[0], np.flatnonzero(cell[1:] != cell[:-1]) + 1, [len(cell)]])
    sizes = np.diff(bounds)
    left, right = [], []
    large = sizes > SMALL_CELL
    run_size = np.repeat(np.where(large, 0, sizes), sizes)
    place = np.arange(len(cell)) - np.repeat(bounds[:-1], sizes)
    for step in range(1, int(run_size.max(initial=0))):
        i = np.flatnonzero(place + step < run_size)
        near = _close(fps[i], fps[i + step])
        left.append(fps[i][near].view(np.int64))
        right.append(fps[i + step][near].view(np.int64))
    for r in np.flatnonzero(large):
        found = list(_forest(fps[bounds[r] : bounds[r + 1]]))
        left.append(np.array([a for a, _ in found], dtype=np.int64))
        right.append(np.array([b for _, b in found], dtype=np.int64))
    if not left:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def links(fps: DataFrame) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints within the distance, enough of them to keep every component whole.

    Small cells give all their pairs; a large one gives a spanning forest, at most one link per fingerprint. A link that
    several cells hold may come several times.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            cell = np.concatenate([cell, batch.column(0).to_numpy(zero_copy_only=False)])
            fp = np.concatenate([fp, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            if len(cell) < 65_536 or cell[0] == cell[-1]:
                continue
            done = int(np.searchsorted(cell, cell[-1]))  # the last run may go on in the next batch
            a, b = _links(cell[:done], fp[:done])
            cell, fp = cell[done:], fp[done:]
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])
        if len(cell):
            a, b = _links(cell, fp)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    parts = cells(fps)
    return parts.repartition("cell").sortWithinPartitions("cell").mapInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id`` of every row, the smallest ``doc_id`` it reaches.

    Words are runs of characters other than ASCII white space, A to Z lowered; shingles of four words are hashed by XXH64. A
    text of fewer words is one shingle; null and empty texts have fingerprint zero, which links like any other. Fingerprints
    link at four or fewer differing bits. Copies meet as one fingerprint, so only different fingerprints are compared. A row
    whose ``doc_id`` is null takes part, but cannot be a ``component_id``; it is null where no row of the component has an id.
    Rows that repeat come out as often; an empty table gives no rows; other columns are ignored.
    """
    made = materialise(fingerprints(docs, shingle))
    classes = materialise(made.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = component_roots(links(classes))
    labelled = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    ids = labelled.groupBy("root").agg(F.min("first_id").alias("component_id"))
    of_class = labelled.join(ids, "root").select("fp", "component_id")
    return made.join(of_class, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
