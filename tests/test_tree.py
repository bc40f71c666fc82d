"""Digest trees: planted changes are found from few nodes, with repeated rows, nulls and hot keys."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from slicedigest.functions.columns import named
from slicedigest.operators import tree
from slicedigest.operators.digest import digest_frame
from slicedigest.operators.tree import changed_rows, differing_nodes, digest_tree, tree_levels

LEVELS = 3


def test_levels():
    assert [tree_levels(n, 10) for n in (0, 10, 160, 161, 2560, 2561, 10**30)] == [1, 1, 1, 2, 2, 3, 15]


@pytest.fixture(scope="module")
def rows(spark):
    frame = spark.range(20_000).select(F.col("id").alias("k"), (F.col("id") * 7 % 13).cast("string").alias("v `x`"))
    hot = spark.range(5_000).select(F.lit(None).cast("bigint").alias("k"), (F.col("id") % 3).cast("string").alias("v `x`"))
    return frame.unionByName(hot)


def built(frame):
    return digest_tree(frame, ["k"], frame.columns, LEVELS)


def test_the_root_is_the_table_and_equal_tables_end_there(rows):
    nodes = built(rows)
    root, whole = nodes.where("level = 0").first(), digest_frame(rows).first()
    assert (root["rows"], root["digest"], root["row_digest"]) == (whole["rows"], whole["digest"], whole["row_digest"])
    for level in range(LEVELS + 1):
        assert nodes.where(F.col("level") == level).agg(F.sum("rows")).first()[0] == 25_000
    assert differing_nodes(nodes, built(rows.repartition(5)), LEVELS).collect() == []
    with pytest.raises(Exception, match="two algorithms"):
        differing_nodes(nodes, nodes.withColumn("version", F.lit(99)), LEVELS).collect()
    empty = built(rows.where("false"))
    assert empty.collect() == []
    assert differing_nodes(empty, empty, LEVELS).collect() == []
    assert differing_nodes(nodes, empty, LEVELS).where("level = 0").first()["right_rows"] == 0


@pytest.mark.parametrize("ranges", [64, 0])
def test_planted_changes(spark, rows, tmp_path, monkeypatch, ranges):
    monkeypatch.setattr(tree, "RANGES", ranges)
    after = rows.where("k IS NULL OR k <> 17").withColumn("v `x`", F.when(F.col("k") == 4711, "new").otherwise(named("v `x`")))
    after = after.unionByName(spark.createDataFrame([(30_000, "x"), (None, "0"), (99, "x")], after.schema))
    stored = []
    for name, frame in (("before", rows), ("after", after)):
        built(frame).repartition(4, "level").sortWithinPartitions("level", "node").write.partitionBy("level").parquet(str(tmp_path / name))
        stored.append(spark.read.parquet(str(tmp_path / name)))
    found = differing_nodes(*stored, LEVELS)
    per_level = Counter(r["level"] for r in found.collect())
    assert per_level[0] == 1 and all(per_level[n] <= 5 for n in range(LEVELS + 1)) and per_level[LEVELS] == 5
    got = {(r["k"], r["before_rows"], r["after_rows"], r["change"]) for r in changed_rows(rows, after, found, ["k"], rows.columns, LEVELS).collect()}
    assert got == {(17, 1, 0, "removed"), (4711, 1, 1, "changed"), (30_000, 0, 1, "added"), (None, 0, 1, "added"), (99, 0, 1, "added")}


def test_ranges_of_children_reach_the_scan(spark, rows, tmp_path):
    built(rows).write.partitionBy("level").parquet(str(tmp_path / "t"))
    nodes = spark.read.parquet(str(tmp_path / "t")).where("level = 2")
    plan = tree._below(nodes, spark.createDataFrame([(3,)], "node bigint"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(node,48)" in plan and "LessThanOrEqual(node,63)" in plan and "level" in plan.split("PartitionFilters")[1][:60]
