"""Changed rows found through digest trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from slicedigest.operators.tree import changed_rows, differing_nodes, digest_tree, tree_levels
from slicedigest.runtime import materialise

KEY = ["l_orderkey", "l_linenumber"]

_AFTER = """SELECT * REPLACE (CASE WHEN l_orderkey % 997 = 3 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity) FROM lineitem WHERE l_orderkey % 1499 <> 7
    UNION ALL SELECT * REPLACE (-l_orderkey AS l_orderkey) FROM lineitem WHERE l_orderkey % 1999 = 5"""


def _after(lineitem):
    moved = lineitem.where("l_orderkey % 1499 <> 7").withColumn("l_quantity", F.expr("CASE WHEN l_orderkey % 997 = 3 THEN l_quantity + 1 ELSE l_quantity END"))
    return moved.unionByName(lineitem.where("l_orderkey % 1999 = 5").withColumn("l_orderkey", -F.col("l_orderkey")))


def _trees(spark, sf):
    before = table(spark, sf, "lineitem")
    after = _after(before)
    levels = tree_levels(before.count(), 64)
    return before, after, levels, [materialise(digest_tree(t, KEY, before.columns, levels)) for t in (before, after)]


@query(
    f"""WITH a AS ({_AFTER}), gone AS (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM a), new AS (SELECT * FROM a EXCEPT ALL SELECT * FROM lineitem),
    n AS (SELECT l_orderkey, l_linenumber, 1 AS b, 0 AS a FROM gone UNION ALL SELECT l_orderkey, l_linenumber, 0, 1 FROM new),
    k AS (SELECT l_orderkey, l_linenumber, sum(b)::BIGINT AS before_rows, sum(a)::BIGINT AS after_rows FROM n GROUP BY ALL)
    SELECT *, CASE WHEN before_rows > 0 AND after_rows > 0 THEN 'changed' WHEN before_rows > 0 THEN 'removed' ELSE 'added' END AS change FROM k"""
)
def digest_tree_changed_rows(spark, sf):
    before, after, levels, trees = _trees(spark, sf)
    return changed_rows(before, after, differing_nodes(*trees, levels), KEY, before.columns, levels)


@query(
    f"""WITH a AS ({_AFTER}) SELECT 0 AS level, 0::BIGINT AS node, (SELECT count(*) FROM lineitem) AS left_rows, (SELECT count(*) FROM a) AS right_rows
    WHERE EXISTS (SELECT * FROM lineitem EXCEPT ALL SELECT * FROM a) OR EXISTS (SELECT * FROM a EXCEPT ALL SELECT * FROM lineitem)"""
)
def digest_tree_root(spark, sf):
    _, _, levels, trees = _trees(spark, sf)
    return differing_nodes(*trees, levels).where("level = 0")
