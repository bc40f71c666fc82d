"""Digest trees: where two tables differ, found from sums of sums before any row is compared."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.columns import named
from slicedigest.operators.digest import digest_cube, digest_of_cube, row_limbs
from slicedigest.runtime import broadcast_if_small, materialise

BITS = 4
"""Bits of the key's hash that a level adds: a node has up to 16 children."""
LEAF_ROWS = 4096
"""Rows a leaf should have."""
MOST_LEVELS = 15
RANGES = 64
"""Most nodes whose children are read as ranges that reach the scan; those of more are found by a join."""


def tree_levels(rows: int, leaf_rows: int = LEAF_ROWS) -> int:
    """How many levels below the root give leaves of about ``leaf_rows`` rows."""
    return max(1, min(MOST_LEVELS, math.ceil(math.log(max(1, rows / leaf_rows), 1 << BITS))))


def leaf_of(key: Sequence[str], levels: int) -> Column:
    """The leaf of a row: the first bits of its key's hash, so that a node's descendants are a range."""
    return F.shiftrightunsigned(F.xxhash64(*[named(c) for c in key]), 64 - BITS * levels)


def digest_tree(df: DataFrame, key: Sequence[str], columns: Sequence[str], levels: int, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return ``level, node, rows, digest, row_digest`` of every node that has rows, the root at level 0.

    One scan sums rows up per leaf; upper nodes add these sums up, and none is larger than its number of leaves. Trees are
    comparable if they have the same key, columns and levels. Stored by level and in order of nodes, a comparison reads few of it.
    """
    if not 1 <= levels <= MOST_LEVELS:
        raise ValueError(f"a tree has 1 to {MOST_LEVELS} levels")
    cube = digest_cube(df, columns, {"leaf": leaf_of(key, levels)}, kinds=kinds)
    every = cube.select("*", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level"))
    nodes = every.withColumn("node", F.expr(f"shiftright(leaf, {BITS} * ({levels} - level))"))
    return digest_of_cube(nodes, ["level", "node"])


def differing_nodes(left: DataFrame, right: DataFrame, levels: int) -> DataFrame:
    """Return ``level, node, left_rows, right_rows`` of the nodes whose digests differ, from the root down.

    Only children of nodes that differ are read, so ``n`` changed leaves cost at most ``16 * n`` nodes a level. Equal tables
    end at the root. Trees of different algorithms or versions are refused. Each level is a job of its own, so trees should be
    stored or materialised first.
    """
    pick = lambda tree, side: tree.select(
        "level", "node", F.col("rows").alias(f"{side}_rows"), F.struct("digest", "row_digest").alias(side), F.struct("algorithm", "version", "scope").alias(f"{side}_id")
    )
    sides = [pick(left, "left"), pick(right, "right")]
    found: list[DataFrame] = []
    for level in range(levels + 1):
        near = [_below(side.where(F.col("level") == level), found[-1] if found else None) for side in sides]
        both = near[0].join(near[1], ["level", "node"], "full_outer")
        same_kind = F.coalesce(F.col("left_id") == F.col("right_id"), F.lit(True))
        checked = F.when(same_kind, F.col("left").eqNullSafe(F.col("right"))).otherwise(F.raise_error("digests of two algorithms or versions").cast("boolean"))
        rows = [F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in ("left_rows", "right_rows")]
        found.append(materialise(both.where(~checked).select("level", "node", *rows)))
        if found[-1].isEmpty():
            break
    return reduce(DataFrame.unionByName, found)


def _below(nodes: DataFrame, above: DataFrame | None) -> DataFrame:
    if above is None:
        return nodes
    few = [r["node"] for r in above.select("node").limit(RANGES + 1).collect()]
    if len(few) <= RANGES:
        spans = [F.col("node").between(n << BITS, (n << BITS) + (1 << BITS) - 1) for n in sorted(few)]
        return nodes.where(reduce(Column.__or__, spans, F.lit(False)))
    parents = broadcast_if_small(above.select(F.col("node").alias("__above")))
    return nodes.join(parents, F.shiftright("node", BITS) == F.col("__above"), "left_semi")


def changed_rows(
    before: DataFrame, after: DataFrame, differing: DataFrame, key: Sequence[str], columns: Sequence[str], levels: int, kinds: dict[str, str] | None = None
) -> DataFrame:
    """Return per key of the differing leaves whose rows are not the same: ``before_rows`` and ``after_rows`` that the other
    side lacks, and ``change``: ``changed``, ``removed`` or ``added``.

    Rows outside the differing leaves are hashed by their key alone and go no further. Rows are compared by digest and number,
    so rows and keys may repeat; null is a key like others. A key's equal rows are counted per task before they move.
    """
    leaves = broadcast_if_small(materialise(differing.where(F.col("level") == levels).select(F.col("node").alias("__leaf"))))
    keys = {f"__k{n}": named(c) for n, c in enumerate(key)}

    def counted(df: DataFrame, sign: int) -> DataFrame:
        near = df.join(leaves, leaf_of(key, levels) == F.col("__leaf"), "left_semi")
        limbs = [f"__r{n}" for n in range(4)]
        return row_limbs(near, columns, keys, kinds).select(*keys, *limbs, F.lit(sign).cast("bigint").alias("n"))

    rows = counted(before, 1).unionByName(counted(after, -1))
    moved = rows.groupBy(*keys, *[f"__r{n}" for n in range(4)]).agg(F.sum("n").alias("n")).where("n <> 0")
    per_key = moved.groupBy(*keys).agg(
        F.sum(F.greatest("n", F.lit(0))).alias("before_rows"), F.sum(F.greatest(-F.col("n"), F.lit(0))).alias("after_rows")
    )
    change = F.when((F.col("before_rows") > 0) & (F.col("after_rows") > 0), "changed").when(F.col("before_rows") > 0, "removed").otherwise("added")
    return per_key.select(*[F.col(k).alias(c) for k, c in zip(keys, key)], "before_rows", "after_rows", change.alias("change"))
