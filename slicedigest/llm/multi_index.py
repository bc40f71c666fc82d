"""Near-duplicate embeddings by an inverted multi-index over the halves of the vectors."""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicedigest.llm.batches import ROWS_PER_BATCH, map_rows
from slicedigest.llm.components import component_roots
from slicedigest.runtime import broadcast_if_small, materialise

COSINE = 0.95
RECALL = 0.999
"""Share of pairs at exactly the least cosine whose cell the traversal must reach; closer pairs are reached more often."""
SAMPLE_ROWS = 10_000
"""Vectors of each dimension that the codebooks and the traversal's limit are fitted on."""
OCCUPANCY = 32
"""Vectors a cell should hold on average: the codebooks grow with the root of the table."""
ROWS_PER_CODE = 8
"""Sampled vectors per code at least, so that a codebook has no more codes than its sample can place."""
BLOCK = 2048
"""Vectors at home that one group holds; smaller cells share a group, a fuller one is dealt to several."""
SHELF = 8192
"""Vectors at home in the cells that share a group, twice as many at most."""
SHELF_BYTES = 4 << 20
"""Bytes of them beyond which a group of more than ``BLOCK`` takes fewer."""
EMPTY = np.iinfo(np.int64).max
"""The shelf of a cell that no vector has its home in."""
SEED = 11


def fitted(rows: np.ndarray, codes: int, rounds: int = 10) -> np.ndarray:
    """Codes of one half by k-means on the sampled rows; those that lose all their rows go."""
    rng = np.random.default_rng(SEED)
    found = np.unique(rows[rng.permutation(len(rows))[:codes]], axis=0)
    for _ in range(rounds):
        nearest = _squares(rows, found).argmin(axis=1)
        count = np.bincount(nearest, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, nearest, rows)
        found = np.unique(total[count > 0] / count[count > 0][:, None], axis=0)
    return found


def _squares(rows: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return (rows * rows).sum(axis=1)[:, None] - 2 * rows @ codes.T + (codes * codes).sum(axis=1)


class Codebook:
    """The codes of one half, and how far a row is from the cell of each."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.gaps = np.sqrt(np.maximum(_squares(codes, codes), 0)) if len(codes) else np.zeros((0, 0))

    def margins(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's code, and its squared distance to the plane that parts it from each other code's cell.

        A row of another code's cell is at least that far away.
        """
        square = _squares(rows, self.codes)
        home = square.argmin(axis=1)
        at = np.arange(len(rows))
        gap = self.gaps[home]
        beyond = np.maximum(square - square[at, home][:, None], 0) / np.where(gap > 0, 2 * gap, 1)
        beyond[at, home] = 0
        return home, beyond * beyond


def reached(one: np.ndarray, two: np.ndarray, limit: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of codes whose halves' distances add up to ``limit`` at most, in ascending order of their sum."""
    first, second = np.flatnonzero(one <= limit), np.flatnonzero(two <= limit)
    cost = one[first][:, None] + two[second]
    i, j = np.nonzero(cost <= limit)
    order = np.argsort(cost[i, j], kind="stable")
    return first[i[order]], second[j[order]]


def multi_sequence(one: np.ndarray, two: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Pairs of codes in ascending order of the sum of their halves' distances, up to ``limit``."""
    yield from zip(*[codes.tolist() for codes in reached(one, two, limit)], strict=True)


class MultiIndex:
    """Codebooks of both halves for unit vectors of one dimension, and the limit of the traversal."""

    def __init__(self, sample: np.ndarray, count: int, cosine: float, recall: float):
        self.cut = sample.shape[1] // 2
        codes = max(1, min(len(sample) // ROWS_PER_CODE, math.ceil(math.sqrt(count / OCCUPANCY))))
        self.halves = [Codebook(fitted(half, codes)) for half in (sample[:, : self.cut], sample[:, self.cut :])]
        self.limit = self._calibrated(sample, cosine, recall)

    def margins(self, rows: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        return self.halves[0].margins(rows[:, : self.cut]), self.halves[1].margins(rows[:, self.cut :])

    def _calibrated(self, sample: np.ndarray, cosine: float, recall: float) -> float:
        """The limit up to which ``recall`` of partners at exactly ``cosine``, in random directions, are reached.

        Two unit vectors of that cosine are sqrt(2 - 2 * cosine) apart, which bounds the limit whatever the data are.
        """
        turned = np.random.default_rng(SEED).standard_normal(sample.shape)
        turned -= (turned * sample).sum(axis=1)[:, None] * sample
        size = np.linalg.norm(turned, axis=1)[:, None]
        partner = cosine * sample + math.sqrt(1 - cosine * cosine) * turned / np.where(size > 0, size, 1)
        (_, one), (_, two) = self.margins(sample)
        (i, _), (j, _) = self.margins(partner)
        at = np.arange(len(sample))
        cost = np.sort(one[at, i] + two[at, j])
        return min(float(cost[min(len(cost) - 1, math.ceil(recall * len(cost)))]), 2 - 2 * cosine) + 1e-9

    def code(self, one: int | np.ndarray, two: int | np.ndarray) -> int | np.ndarray:
        return one * len(self.halves[1].codes) + two

    def cells(self) -> int:
        return len(self.halves[0].codes) * len(self.halves[1].codes)


def _units(batch: dict) -> np.ndarray:
    rows = np.array(batch, dtype=float)
    rows /= np.abs(rows).max(axis=1)[:, None]  # squares neither overflow nor vanish
    return rows / np.linalg.norm(rows, axis=1)[:, None]


class _Classes:
    """Classes that came to a task: ids, counts and vectors, and the cells that each is at home in or visits."""

    def __init__(self, batches: list[pa.RecordBatch]):
        rows = pa.Table.from_batches(batches)
        self.ids, self.counts = rows["c"].to_numpy(), rows["n"].to_numpy()
        self.vectors = np.frombuffer(b"".join(rows["v"].to_pylist()), dtype="<f8").reshape(len(rows), -1)
        cells = rows["cells"].combine_chunks()
        order = np.argsort(cells.flatten().to_numpy(), kind="stable")
        numbers, starts = np.unique(cells.flatten().to_numpy()[order], return_index=True)
        owners = np.repeat(np.arange(len(rows)), cells.value_lengths().to_numpy())[order]
        self.of_cell: dict[int, np.ndarray] = dict(zip(numbers.tolist(), np.split(owners, starts[1:]), strict=True))


class _Cell:
    """The classes at home in one cell, how many rows each is linked with, and which of them are known to be connected.

    Links ``(class, class, 0)`` that span the components come out as they are found, and ``(class, None, rows linked)``.
    """

    def __init__(self, home: _Classes, at: np.ndarray, cosine: float):
        self.own, self.ids, self.weight, self.cosine = home.vectors[at], home.ids[at], home.counts[at], cosine
        self.linked, self.label = np.zeros(len(at), dtype=np.int64), np.arange(len(at))

    def _spans(self, near: np.ndarray, start: int | None, names: np.ndarray) -> Iterator[tuple]:
        label = self.label
        for k in np.flatnonzero(near.any(axis=1)):
            others = np.flatnonzero(near[k])
            roots, places = np.unique(label[others], return_index=True)
            if start is not None:
                fresh = roots != label[start + k]
                roots, places = roots[fresh], places[fresh]
            for p in places:
                yield int(names[k]), int(self.ids[others[p]]), 0
            if len(roots):
                goal = label[start + k] if start is not None else roots[0]
                label[np.isin(label, roots)] = goal

    def meet_each_other(self) -> Iterator[tuple]:
        for start in range(0, len(self.ids), BLOCK):
            rows = slice(start, start + BLOCK)
            near = np.triu(self.own[rows] @ self.own.T >= self.cosine, start + 1)
            self.linked[rows] += near @ self.weight
            self.linked += self.weight[rows] @ near
            yield from self._spans(near, start, self.ids[rows])

    def meet(self, visitors: _Classes, at: np.ndarray) -> Iterator[tuple]:
        near = visitors.vectors[at] @ self.own.T >= self.cosine
        if not near.any():
            return
        names = visitors.ids[at]
        theirs = near @ self.weight
        self.linked += visitors.counts[at] @ near
        for k in np.flatnonzero(theirs):
            yield int(names[k]), None, int(theirs[k])
        yield from self._spans(near, None, names)

    def totals(self) -> Iterator[tuple]:
        for k in np.flatnonzero(self.linked):
            yield int(self.ids[k]), None, int(self.linked[k])


def _pairs_of_shelf(home: list[pa.RecordBatch], visitors: Iterator[list[pa.RecordBatch]], cosine: float) -> Iterator[tuple]:
    """``(class, None, rows linked)`` and links ``(class, class, 0)`` that span the components of one shelf.

    ``home`` are the classes at home: those of one cell meet each other and every visitor of the cell once.
    """
    classes = _Classes(home)
    cells = {cell: _Cell(classes, at, cosine) for cell, at in classes.of_cell.items()}
    for cell in cells.values():
        yield from cell.meet_each_other()
    for rows in visitors:
        coming = _Classes(rows)
        for cell, at in coming.of_cell.items():
            if cell in cells:  # a block of a full cell may hold nobody
                yield from cells[cell].meet(coming, at)
    for cell in cells.values():
        yield from cell.totals()


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Rows that follow each other in one group, at home or visiting, with ``(d, shelf, block, visiting)``."""
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in ("d", "shelf", "block", "visiting")])
        starts = np.flatnonzero(np.r_[batch.num_rows > 0, (keys[1:] != keys[:-1]).any(axis=1)])
        for start, end in zip(starts, [*starts[1:], len(keys)], strict=False):
            yield tuple(keys[start].tolist()), batch.slice(start, end - start)


def _shelves(homes: DataFrame) -> DataFrame:
    """``d, cell, shelf, blocks`` of every cell that classes are at home in.

    Cells that follow each other share a shelf of about ``SHELF`` classes, so that a class that visits several of them travels
    once. A cell of more than ``BLOCK`` has a shelf of its own, below zero, which is dealt to blocks.
    """
    held = homes.groupBy("d", "cell").agg(F.count("*").alias("k")).withColumn("blocks", F.ceil(F.col("k") / BLOCK).cast("int"))
    until = F.sum(F.when(F.col("blocks") == 1, F.col("k")).otherwise(0)).over(Window.partitionBy("d").orderBy("cell"))
    size = F.greatest(F.lit(BLOCK), F.least(F.lit(SHELF), F.floor(F.lit(SHELF_BYTES) / (8 * F.col("d")))))
    shelf = F.when(F.col("blocks") > 1, -1 - F.col("cell")).otherwise(F.floor((until - 1) / size))
    return held.select("d", "cell", shelf.cast("bigint").alias("shelf"), "blocks")


def near_duplicate_vectors(
    vectors: DataFrame, cosine: float = COSINE, recall: float = RECALL, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` of every row.

    Vectors of one dimension link if their cosine in double precision is at least ``cosine``. Null vectors, zero vectors and
    those with null or non-finite components link with nothing. ``n_links`` counts the other rows a row is linked with,
    ``component_id`` is the smallest id it reaches, itself included, ``kept`` says whether that is its own. Rows that repeat
    and equal vectors link with each other; a row without id counts and connects, but cannot be a ``component_id`` and is not
    kept. An empty table gives no rows; other columns are ignored.

    Equal vectors are one class with a count. Each class is at home in the cell of the product of both halves' codes and
    visits the nearest cells, those of higher number up to the limit of the traversal, so that two classes meet once at most.
    A cell compares its own classes and visitors by matrix products and hands on sums and links that span its components,
    never its pairs. Cells that follow each other share a shelf, to which a visitor of several of them travels once; a full
    cell is dealt to blocks, to each of which its visitors come. Nothing below ``cosine`` links.
    """
    value = F.col(vector_col).cast("array<double>")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(finite & F.exists(value, lambda x: x != 0), F.lit(False))
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), F.when(usable, value).alias("v"))
    grouped = rows.where("v IS NOT NULL").groupBy("v").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    classes = materialise(grouped.withColumn("c", F.monotonically_increasing_id()))
    sizes = {r["d"]: r["count"] for r in classes.groupBy(F.size("v").alias("d")).count().collect()}
    index = {}
    for d, count in sizes.items():
        sample = classes.where(F.size("v") == d).orderBy(F.xxhash64("v"), "c").limit(SAMPLE_ROWS).select("v").toArrow()
        flat = sample.column("v").combine_chunks().flatten().to_numpy().reshape(-1, d)
        index[d] = MultiIndex(_units(flat), count, cosine, recall)

    def placed(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            dims = np.array([len(v) for v in batch["v"]])
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                units = _units([batch["v"][i] for i in at])
                (one, _), (two, _) = index[d].margins(units)
                for k, i in enumerate(at):
                    yield batch["c"][i], batch["n"][i], int(d), index[d].code(one[k], two[k]), units[k].astype("<f8").tobytes()

    def visited(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            dims = np.array(batch["d"])
            for d in np.unique(dims):
                at, own, shelf_of = np.flatnonzero(dims == d), index[d], held[d]
                units = np.frombuffer(b"".join(batch["v"][i] for i in at), dtype="<f8").reshape(len(at), -1)
                (_, one), (_, two) = own.margins(units)
                for k, i in enumerate(at):
                    cells = np.sort(own.code(*reached(one[k], two[k], own.limit)))
                    cells = cells[(cells > batch["cell"][i]) & (shelf_of[cells] != EMPTY)]
                    shelves = shelf_of[cells]
                    ends = [*np.flatnonzero(shelves[1:] != shelves[:-1]) + 1, len(cells)]
                    start = 0
                    for end in ends if len(cells) else ():
                        yield batch["c"][i], batch["n"][i], int(d), int(shelves[start]), cells[start:end].tolist(), batch["v"][i]
                        start = end

    schema = "c bigint, n bigint, d int, cell bigint, v binary"
    homes = materialise(map_rows(classes.select("c", "n", "v"), placed, schema, rows=512))
    shelves = materialise(_shelves(homes))
    held = {d: np.full(own.cells(), EMPTY) for d, own in index.items()}  # as many numbers as there are cells
    listed = shelves.select("d", "cell", "shelf").toArrow()
    dims, cells, numbers = (listed.column(c).to_numpy() for c in listed.column_names)
    for d, shelf_of in held.items():
        shelf_of[cells[dims == d]] = numbers[dims == d]
    visits = map_rows(homes, visited, "c bigint, n bigint, d int, shelf bigint, cells array<bigint>, v binary", rows=512)
    block = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    at_home = homes.join(broadcast_if_small(shelves), ["d", "cell"]).withColumn("block", block).withColumn("cells", F.array("cell"))
    # of two vectors at home in different blocks, the one of the lower block visits the other's
    between = at_home.where("block + 1 < blocks").withColumn("to", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1)))
    full = broadcast_if_small(materialise(shelves.where("blocks > 1").select("d", "shelf", "blocks")))
    coming = visits.join(full, ["d", "shelf"], "left")
    coming = coming.withColumn("to", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    columns = ["d", "shelf", "block", "visiting", "c", "n", "v", "cells"]
    groups = at_home.withColumn("visiting", F.lit(False)).select(columns)
    for frame in (between, coming):
        groups = groups.unionByName(frame.withColumn("block", F.col("to")).withColumn("visiting", F.lit(True)).select(columns))
    groups = groups.repartition("d", "shelf", "block").sortWithinPartitions("d", "shelf", "block", "visiting", "c")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for _, runs in groupby(_runs(batches), key=lambda run: run[0][:3]):
            sides = groupby(runs, key=lambda run: run[0][3])
            visiting, first = next(sides)
            if visiting:  # a block that no vector has its home in
                continue
            home = [rows for _, rows in first]
            coming = (rows for _, rest in sides for _, rows in rest)
            at_once = max(1, BLOCK // ROWS_PER_BATCH)
            yield from _pairs_of_shelf(home, iter(lambda: list(islice(coming, at_once)), []), cosine)

    found = materialise(map_rows(groups, compared, "c bigint, other bigint, k bigint", arrow=True))
    roots = component_roots(found.where("other IS NOT NULL").select(F.col("c").alias("a"), F.col("other").alias("b")))
    counts = found.where("other IS NULL").groupBy("c").agg(F.sum("k").alias("k"))
    facts = classes.select("c", "n", "first").join(counts, "c", "left").join(roots, F.col("c") == F.col("node"), "left")
    facts = facts.select("c", "n", "first", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("root", "c").alias("root"))
    least = facts.groupBy("root").agg(F.min("first").alias("component_id"))
    facts = facts.join(least, "root").select("c", (F.col("k") + F.col("n") - 1).alias("n_links"), "component_id", F.lit(True).alias("known"))
    of_class = classes.select("c", "v").join(facts, "c").drop("c")  # vectors take part in no join before
    made = rows.join(of_class, "v", "left")
    component = F.when(F.col("known"), F.col("component_id")).otherwise(F.col("vec_id"))
    return made.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
