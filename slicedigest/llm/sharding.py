"""A uniform shuffle into shards of exact size by a hypergeometric communication matrix."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slicedigest.runtime import materialise

SEED = 20_240_607
PART_ROWS = 2_000
"""Rows a part of the input should have, as long as there are at most ``PARTS`` of them."""
PARTS = 4_096
LARGEST_PART_ROWS = 100_000
"""Rows a part may come to have beyond that."""


def part_count(rows: int) -> int:
    return max(1, min(PARTS, math.ceil(rows / PART_ROWS)), math.ceil(rows / LARGEST_PART_ROWS))


def shard_sizes(rows: int, shards: int) -> np.ndarray:
    """Sizes that differ by one at most, the larger first."""
    return np.array([rows // shards + (i < rows % shards) for i in range(shards)], dtype=np.int64)


def communication_matrix(parts: np.ndarray, sizes: np.ndarray, seed: int = SEED) -> np.ndarray:
    """How many rows each part sends to each shard: rows sum to the parts, columns to the shards.

    A uniform shuffle lets each part's rows take places without replacement from those left, which is a multivariate
    hypergeometric draw, taken here shard by shard.
    """
    rng = np.random.default_rng(seed)
    left = sizes.astype(np.int64).copy()
    out = np.zeros((len(parts), len(sizes)), dtype=np.int64)
    for p, n in enumerate(parts):
        rest, places = int(n), int(left.sum())
        for k in range(len(sizes)):
            places -= int(left[k])
            out[p, k] = _hypergeometric(rng, int(left[k]), places, rest)
            rest -= int(out[p, k])
        left -= out[p]
    return out


def _hypergeometric(rng: np.random.Generator, good: int, bad: int, draws: int) -> int:
    """One draw. From a billion places on, numpy has none and the normal limit is taken; the sums stay exact."""
    if draws == 0 or good == 0:
        return 0
    if good + bad < 1_000_000_000:
        return int(rng.hypergeometric(good, bad, draws))
    total = good + bad
    share = good / total
    drawn = round(rng.normal(draws * share, math.sqrt(draws * share * (1 - share) * (total - draws) / (total - 1))))
    return min(good, draws, max(0, draws - bad, drawn))


def _hashed(purpose: str, seed: int, key: list[Column]) -> Column:
    return F.xxhash64(F.lit(purpose), F.lit(seed), *key)


def shuffle_into_shards(df: DataFrame, shards: int, key: list[str], seed: int = SEED) -> DataFrame:
    """All rows of ``df`` with ``shard`` and ``slot``: a uniform shuffle into shards whose sizes differ by one at most.

    Rows are dealt to parts by a hash of ``key``, which should tell rows apart: rows with equal keys can stand for each other
    and share a part. The driver draws from the parts' sizes how many rows each part sends to each shard. Each part is put in
    hashed order and sends its rows on by these counts; each shard is put in an order that an independent hash gives, block by
    block of that hash's range, which numbers its slots from 0 without gaps. Everything follows from keys and seed, so a task
    that runs again gives the same rows. Shards and slots are found for the hashes alone and meet the rows by their place in
    their part, so a row moves once. Driver and plan hold ``parts * shards`` counts, never rows. Columns named ``shard`` or
    ``slot`` are replaced; null keys are values like others; an empty table gives no rows.
    """
    names = [c for c in df.columns if c not in ("shard", "slot")]
    ids = [F.col(f"`{c}`") for c in key]
    parts = part_count(df.count())
    blocks = math.ceil(parts / shards)
    in_part = F.pmod(_hashed("part", seed, ids), F.lit(parts)).cast("int").alias("_part")
    in_block = F.pmod(_hashed("block", seed, ids), F.lit(blocks)).cast("int").alias("_block")
    orders = _hashed("local", seed, ids).alias("_local"), _hashed("order", seed, ids).alias("_order")
    place = F.row_number().over(Window.partitionBy("_part").orderBy("_local", "_order"))

    hashes = materialise(df.select(in_part, in_block, *orders))
    counted = {r["_part"]: r["count"] for r in hashes.groupBy("_part").count().collect()}
    sizes = np.array([counted.get(p, 0) for p in range(parts)], dtype=np.int64)
    matrix = communication_matrix(sizes, shard_sizes(int(sizes.sum()), shards), seed)
    until = df.sparkSession.createDataFrame(
        [(p, np.cumsum(row).tolist()) for p, row in enumerate(matrix)], "_part int, _until array<bigint>"
    )
    shard = F.size(F.filter("_until", lambda x: x < F.col("_place")))
    dealt = materialise(hashes.withColumn("_place", place).join(until, "_part").withColumn("_shard", shard).drop("_until"))

    held = {(r["_shard"], r["_block"]): r["count"] for r in dealt.groupBy("_shard", "_block").count().collect()}
    first, offsets = 0, []
    for shard in range(shards):
        first = 0
        for block in range(blocks):
            offsets.append((shard, block, first))
            first += held.get((shard, block), 0)
    starts = df.sparkSession.createDataFrame(offsets, "_shard int, _block int, _first bigint")
    inner = F.row_number().over(Window.partitionBy("_shard", "_block").orderBy("_order", "_local"))
    slot = (F.col("_first") + F.col("_inner") - 1).alias("slot")
    placed = dealt.withColumn("_inner", inner).join(F.broadcast(starts) if len(offsets) <= 100_000 else starts, ["_shard", "_block"])
    # per part the shard and slot of each place, in runs of bounded length
    after = F.expr(f"(_place - 1) div {LARGEST_PART_ROWS} * {LARGEST_PART_ROWS}")
    targets = placed.select("_part", after.alias("_after"), F.struct("_place", F.col("_shard").alias("shard"), slot).alias("_to"))
    targets = targets.groupBy("_part", "_after").agg(F.array_sort(F.collect_list("_to")).alias("_targets"))

    row = F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row")  # no name in it can clash with those used here
    rows = df.select(row, in_part, *orders).withColumn("_place", place).select("_row", "_part", "_place")
    here = (rows["_part"] == targets["_part"]) & (F.col("_place") > F.col("_after")) & (F.col("_place") <= F.col("_after") + LARGEST_PART_ROWS)
    to = F.get("_targets", (F.col("_place") - F.col("_after") - 1).cast("int"))
    return rows.join(targets, here).select("_row.*", to["shard"].alias("shard"), to["slot"].alias("slot"))
