"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.runtime import materialise

ROWS_PER_TASK = 50_000
"""Links that a task holds at least before a round uses more tasks."""
BROADCAST_LINKS = 200_000
"""While a graph has no more links than this, the least neighbours, at most one per link, are broadcast."""


def component_roots(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node that it reaches, itself included."""
    links = shortened(edges)
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        links.select(F.col("v").alias("node"), F.col("v").alias("root"))
    ).distinct()


def partial_roots(links: DataFrame) -> DataFrame:
    """``(node, root)`` from links that `shortened` left after some rounds: nodes of one root are connected, but connected
    nodes may still have several roots. A node without a smaller neighbour has no row."""
    return links.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))


def shortened(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """Links ``(u, v)``, ``u > v``, with the components of ``edges(a, b)``: stars, or what ``rounds`` rounds leave.

    Rounds of two joins, each written to the checkpoint folder: every node links its larger neighbours to its smallest
    neighbour, then its smaller ones to the smallest, until each component is a star. Only counts and sums reach the driver,
    and the minimum of a neighbourhood is summed up before it is shuffled, so a node may have any number of neighbours.
    """
    links = materialise(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u > v").distinct())
    seen = _state(links)
    while seen[0] and rounds != 0:
        few = seen[0] <= BROADCAST_LINKS
        turned = _small_star(_large_star(links, few), few)
        links = materialise(turned.coalesce(-(-seen[0] // ROWS_PER_TASK)))
        now = _state(links)
        if now == seen:
            break
        seen = now
        rounds = None if rounds is None else rounds - 1
    return links


def _state(links: DataFrame) -> tuple:
    """What a round leaves unchanged only if it changes no link: each round replaces links by links to smaller nodes."""
    row = links.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.sum(F.xxhash64("v").cast("decimal(38,0)"))
    ).first()
    return tuple(row)


def _least(links: DataFrame, few: bool) -> DataFrame:
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    return F.broadcast(least) if few else least


def _large_star(links: DataFrame, few: bool) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    joined = both.where("v > u").join(_least(both, few), "u")
    return joined.select(F.col("v").alias("u"), F.least("u", "m").alias("v")).where("u > v")


def _small_star(links: DataFrame, few: bool) -> DataFrame:
    moved = links.join(_least(links, few), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    kept = links.groupBy("u").agg(F.min("v").alias("v"))
    return moved.unionByName(kept).where("u > v").distinct()
