"""Exact top-k inner-product search as a Voronoi join."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slicedigest.llm.batches import map_rows, small_batches
from slicedigest.runtime import materialise

PIVOTS = 64
"""Vectors per dimension that span the cells: the lowest by a hash of their id."""
BLOCK = 4_096
"""Candidates searched at once."""
GROUP = 1_024
"""Queries that share a group of cells, unless one cell has more."""
ASKED = 256
"""Queries that one matrix product takes."""
VECTORS = pa.list_(pa.float64())
CELLS = pa.schema([("id", pa.int64()), ("v", VECTORS), ("d", pa.int32()), ("query", pa.bool_()), ("cell", pa.int32()), ("far", pa.float64())])
ROUTED = pa.schema([("id", pa.int64()), ("v", VECTORS), ("part", pa.int32()), ("block", pa.int32()), ("query", pa.bool_())])
FOUND = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024) -> DataFrame:
    """``id`` and ``v`` (``floor(scale * x)`` per component); vectors that are null or hold null or non-finite parts go."""
    v = F.col(f"`{vector_col}`")
    fine = v.isNotNull() & ~F.exists(v, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    made = F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("double"))
    return vectors.where(fine).select(F.col(f"`{id_col}`").cast("bigint").alias("id"), made.alias("v")).where("id IS NOT NULL")


class _Cells:
    """Pivots per dimension in the space where the inner product orders like a distance.

    With M the largest squared norm of a candidate, a candidate x becomes (x, sqrt(M - |x|^2)) and a query q becomes (q, 0).
    Then |q' - x'|^2 = |q|^2 + M - 2 q.x, so the nearest are those of the highest inner product.
    """

    def __init__(self, pivots: dict[int, np.ndarray], largest: dict[int, float]):
        self.pivots, self.largest = pivots, largest

    def lifted(self, rows: np.ndarray, query: bool) -> np.ndarray:
        norm = (rows * rows).sum(axis=1)
        extra = np.zeros(len(rows)) if query else np.sqrt(np.maximum(0, self.largest[rows.shape[1]] - norm))
        return np.column_stack([rows, extra])

    def nearest(self, rows: np.ndarray, query: bool) -> tuple[np.ndarray, np.ndarray]:
        at, pivots = self.lifted(rows, query), self.pivots[rows.shape[1]]
        square = (at * at).sum(axis=1)[:, None] - 2 * at @ pivots.T + (pivots * pivots).sum(axis=1)
        cell = square.argmin(axis=1)
        return cell, np.linalg.norm(at - pivots[cell], axis=1)


def _matrix(vectors: pa.ListArray, width: int) -> np.ndarray:
    return vectors.flatten().to_numpy().reshape(len(vectors), width)


def _by_dimension(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """The rows of each dimension, and their vectors as a matrix."""
    lengths = batch.column("v").value_lengths().to_numpy()
    for d in np.unique(lengths).tolist():
        some = batch.filter(pa.array(lengths == d))
        yield d, some, _matrix(some.column("v"), d)


def _picked(rows: pa.RecordBatch, at: np.ndarray, schema: pa.Schema, **more: np.ndarray | float) -> pa.RecordBatch:
    """Ids and vectors of the rows ``at``, with ``more`` columns: an array, or one value for all."""
    some = rows.select(["id", "v"]).take(pa.array(at))
    columns = [some.column("id"), some.column("v").cast(VECTORS)]
    columns += [pa.array(np.broadcast_to(more[f.name], len(at)), type=f.type) for f in schema if f.name in more]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def _sides(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors, all of one dimension."""
    vectors = rows["v"].combine_chunks()
    return rows["id"].to_numpy(), _matrix(vectors, len(vectors[0]) if len(vectors) else 0)


def _best(asked: np.ndarray, queries: np.ndarray, ids: np.ndarray, table: np.ndarray, k: int) -> pa.Table:
    """Each query's ``k`` highest scores among the candidates, ties to the smaller id, the query itself left out."""
    scores = queries @ table.T  # whole numbers below 2^53, so exact
    scores[asked[:, None] == ids] = -np.inf
    least = np.partition(scores, -k, axis=1)[:, -k] if len(ids) > k else np.full(len(asked), -np.inf)
    q, c = np.nonzero((scores >= least[:, None]) & (scores > -np.inf))
    order = np.lexsort((ids[c], -scores[q, c], q))
    q, c = q[order], c[order]
    kept = np.arange(len(q)) - np.searchsorted(q, q) < k
    q, c = q[kept], c[kept]
    return pa.table([asked[q], ids[c], scores[q, c].astype(np.int64)], schema=FOUND)


def _slack(x: np.ndarray | float) -> np.ndarray | float:
    """Room for rounding: bounds are doubles, scores are exact integers."""
    return 1e-6 * (1 + np.abs(x))


def top_k(vectors: DataFrame, k: int = 10, query_every: int = 100, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score``: the ``k`` highest integer inner products of each query.

    Queries are the rows whose id is divisible by ``query_every``; every other usable row is a candidate, and a query is never
    its own. Vectors meet only those of their dimension. Ties go to the smaller id. Rows that repeat an id are candidates
    each, but come out once per score; null ids take no part; an empty table gives no rows; other columns are ignored.

    Queries and candidates go to the cells of pivots. Summaries per cell (the farthest query, the ``k + 1`` nearest
    candidates) bound how far a cell's queries must look; a candidate is sent to a group of cells only if its distance to its
    own pivot allows a query there to reach it. Candidates are dealt to blocks of bounded size by a hash, so equal vectors and
    full cells spread, each block is solved by one matrix product, and blocks leave ``k`` rows per query.
    """
    spark = vectors.sparkSession
    base = materialise(quantised(vectors, id_col, vector_col))
    shape = base.groupBy(F.size("v").alias("d")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)).alias("m")
    ).collect()
    schema = "query_id bigint, rank int, vec_id bigint, score bigint"
    if not shape:
        return spark.createDataFrame([], schema)
    order = F.xxhash64(F.lit("pivot"), "id")
    picked = {r["d"]: base.where(F.size("v") == r["d"]).orderBy(order, "id").limit(PIVOTS).collect() for r in shape}
    largest = {r["d"]: float(r["m"]) for r in shape}
    space = _Cells({}, largest)
    for d, rows in picked.items():
        space.pivots[d] = space.lifted(np.array([r["v"] for r in rows], dtype=float).reshape(len(rows), d), False)

    def assign(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d, some, rows in _by_dimension(batch):
                asked = np.flatnonzero(some.column("id").to_numpy() % query_every == 0)
                for at, query in ((np.arange(len(rows)), False), (asked, True)):
                    cell, far = space.nearest(rows[at], query)
                    yield _picked(some, at, CELLS, d=d, query=query, cell=cell, far=far)

    small_batches(spark)
    cells = materialise(base.mapInArrow(assign, "id bigint, v array<double>, d int, query boolean, cell int, far double"))
    bounds = cells.where("query").groupBy("d", "cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()

    def closest(batches: Iterable[dict]) -> Iterator[tuple]:
        kept: dict[tuple, list] = {}
        for batch in batches:
            for key in zip(batch["d"], batch["cell"], batch["far"], strict=True):
                kept.setdefault(key[:2], []).append(key[2])
            for key, far in kept.items():
                kept[key] = sorted(far)[: k + 1]
        for (d, cell), far in kept.items():
            for x in far:
                yield d, cell, x

    near = map_rows(cells.where("NOT query").select("d", "cell", "far"), closest, "d int, cell int, far double")
    ranked = near.withColumn("r", F.row_number().over(Window.partitionBy("d", "cell").orderBy("far"))).where(F.col("r") <= k + 1)
    summary: dict[tuple[int, int], list[float]] = {}
    for r in ranked.collect():  # at most PIVOTS * (k + 1) distances per dimension
        summary.setdefault((r["d"], r["cell"]), []).append(r["far"])

    reach: dict[tuple[int, int], float] = {}
    groups: dict[tuple[int, int], int] = {}
    filled, number, last = 0, -1, None
    for r in sorted(bounds, key=lambda r: (r["d"], r["cell"])):
        d, cell = r["d"], r["cell"]
        pivots = space.pivots[d]
        limits = [r["far"] + np.linalg.norm(pivots[cell] - pivots[other]) + x for (e, other), far in summary.items() if e == d for x in far]
        reach[d, cell] = float(sorted(limits)[k]) if len(limits) > k else float("inf")
        if d != last or filled + r["n"] > GROUP:
            number, filled, last = number + 1, 0, d
        groups[d, cell] = number
        filled += r["n"]
    farthest = {(r["d"], r["cell"]): r["far"] for r in bounds}
    count = sum(r["n"] for r in shape)
    blocks = max(1, -(-count // BLOCK))

    def route(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted: dict[int, list] = {}
        for (d, cell), limit in reach.items():
            wanted.setdefault(d, []).append((cell, limit + farthest[d, cell] + _slack(limit), groups[d, cell]))
        for batch in batches:
            for d, some, rows in _by_dimension(batch):
                query, cell = (some.column(c).to_numpy(zero_copy_only=False) for c in ("query", "cell"))
                asked, offered = np.flatnonzero(query), np.flatnonzero(~query)
                part = np.array([groups[d, c] for c in cell[asked].tolist()], dtype=np.int64)
                every = np.tile(np.arange(blocks), len(asked))
                yield _picked(some, asked.repeat(blocks), ROUTED, part=part.repeat(blocks), block=every, query=True)
                lifted = space.lifted(rows[offered], False)
                to: dict[int, np.ndarray] = {}
                for c, limit, group in wanted.get(d, ()):
                    near = np.linalg.norm(lifted - space.pivots[d][c], axis=1) <= limit
                    to[group] = to.get(group, False) | near
                for group, near in to.items():
                    at = offered[near]
                    own = some.column("id").to_numpy()[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    yield _picked(some, at, ROUTED, part=group, block=(own >> np.uint64(20)) % np.uint64(blocks), query=False)

    def solve(rows: pa.Table) -> pa.Table:
        (asked, queries), (ids, table) = (_sides(rows.filter(pc.equal(rows["query"], side))) for side in (True, False))
        starts = range(0, len(asked) if len(ids) else 0, ASKED)
        return pa.concat_tables(
            [FOUND.empty_table(), *[_best(asked[i : i + ASKED], queries[i : i + ASKED], ids, table, k) for i in starts]]
        )

    routed = cells.mapInArrow(route, "id bigint, v array<double>, part int, block int, query boolean")
    found = routed.groupBy("part", "block").applyInArrow(solve, "query_id bigint, vec_id bigint, score bigint").distinct()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
