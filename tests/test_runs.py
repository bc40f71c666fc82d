"""Runs that meet what is not theirs, what is broken, and what an earlier run has left."""

import pytest
from pyspark.sql import functions as F

from checks.rows import ORDER_DATES, _orders_profile
from slicedigest.operators.run import Source, run
from slicedigest.sources import records

SF = "/root/testdata/sf0.001"
SOURCES = {"orders": Source(f"{SF}/orders.parquet", ORDER_DATES)}
RECEIPT = "by_year.receipt"


def _receipt(spark, folder):
    return records.read_records(spark, f"{folder}/{RECEIPT}", records.RECEIPT)[0].collect()


def test_a_dry_run_plans_and_writes_nothing(spark, tmp_path):
    done = run(spark, [_orders_profile(500, 5000)], SOURCES, str(tmp_path), dry_run=True)
    report = done.reports.first()
    assert report["outcome"] == "planned" and report["total_rows"] == 1500 and report["reasons"] == ["no-receipt"]
    assert done.published == () and list(tmp_path.iterdir()) == []


def test_what_a_lost_run_left_goes_with_the_next_publication(spark, tmp_path):
    def lost(made, path):
        records.mark(spark, f"{path}/half.xlsx")
        raise KeyboardInterrupt  # not an error of the profile: the driver is gone

    with pytest.raises(KeyboardInterrupt):
        run(spark, [_orders_profile(500, 5000)], SOURCES, str(tmp_path), writer=lost)
    assert len(list((tmp_path / "by_year").iterdir())) == 1
    good = run(spark, [_orders_profile(500, 5000)], SOURCES, str(tmp_path))
    assert good.published == ("by_year",)
    (kept,) = (tmp_path / "by_year").iterdir()
    assert _receipt(spark, tmp_path)[0]["location"].endswith(kept.name)

    def broken(made, path):
        records.mark(spark, f"{path}/half.xlsx")
        raise OSError("disk full")

    before = _receipt(spark, tmp_path)
    bad = run(spark, [_orders_profile(500, 5000)], SOURCES, str(tmp_path), frozenset({"by_year"}), broken)
    assert bad.reports.first()["outcome"] == "failed" and bad.reports.first()["error"] == "OSError: disk full"
    assert [p.name for p in (tmp_path / "by_year").iterdir()] == [kept.name] and _receipt(spark, tmp_path) == before


def test_a_source_that_vanished_fails_its_profile_and_names_clash_before_reading(spark, tmp_path):
    spark.read.parquet(f"{SF}/orders.parquet").write.parquet(f"{tmp_path}/orders.parquet")
    sources, out = {"orders": Source(f"{tmp_path}/orders.parquet", ORDER_DATES)}, f"{tmp_path}/out"
    assert run(spark, [_orders_profile(500, 5000)], sources, out).published == ("by_year",)
    (tmp_path / "orders.parquet").rename(tmp_path / "moved.parquet")
    gone = run(spark, [_orders_profile(500, 5000)], sources, out)
    assert gone.selection.first()["reasons"] == ["sidecar-missing-or-unreadable"]
    assert gone.reports.first()["outcome"] == "failed" and gone.published == ()
    with pytest.raises(ValueError):
        run(spark, [_orders_profile(500, 5000)], {"other": sources["orders"]}, out)


def test_records_survive_a_write_cut_short(spark, tmp_path):
    path, row = f"{tmp_path}/r", lambda n: spark.range(n, n + 1).select(F.lit("x").alias("alias"), F.col("id").alias("rows"))
    read = lambda: [r["rows"] for r in records.read_records(spark, path, records.SOURCES)[0].collect()]
    records.write_records(row(1), path)
    with pytest.raises(Exception):
        records.write_records(row(2).select("alias", F.raise_error(F.lit("lost")).cast("bigint").alias("rows")), path)
    assert read() == [1]
    records.write_records(row(3), path)
    (tmp_path / "r").rename(tmp_path / "r.next")  # cut short between the two renames
    assert read() == [3]
    records.write_records(row(4), path)
    assert read() == [4] and sorted(p.name for p in tmp_path.iterdir()) == ["r"]
