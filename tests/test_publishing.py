"""Workbooks appear at their names when the job is through, or not at all."""

from __future__ import annotations

import json
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from slicedigest.sources import xlsx
from slicedigest.sources.xlsx import XlsxWriter, published_workbooks, read_workbooks


def batches(books, fail_after=None):
    schema = pa.schema([("workbook", pa.string()), ("sheet", pa.string()), ("cells", pa.list_(pa.string()))])
    for n, book in enumerate(books):
        if n == fail_after:
            raise RuntimeError("lost")
        yield pa.RecordBatch.from_pylist([{"workbook": book, "sheet": "s", "cells": [f"n{r}", "stext"]} for r in range(50)], schema=schema)


def files(folder):
    return sorted(str(p.relative_to(folder)) for p in folder.rglob("*") if p.is_file())


def test_failed_and_losing_attempts_leave_nothing(spark, tmp_path):
    writer = XlsxWriter(str(tmp_path))
    with pytest.raises(RuntimeError):
        writer.write(batches(["a.xlsx", "b.xlsx"], fail_after=1))
    loser, winner, other = writer.write(batches(["a.xlsx", "b.xlsx"])), writer.write(batches(["a.xlsx", "b.xlsx"])), writer.write(batches(["c.xlsx"]))
    assert all(f.startswith("_staging-") for f in files(tmp_path)) and len(loser.books) == 2
    writer.commit([winner, None, other])
    assert files(tmp_path) == [f"_published-{writer.job}.json", "a.xlsx", "b.xlsx", "c.xlsx"]
    for line in (tmp_path / f"_published-{writer.job}.json").read_text().splitlines():
        one = json.loads(line)
        data = (tmp_path / one["workbook"]).read_bytes()
        assert (one["bytes"], one["crc32"]) == (len(data), zlib.crc32(data))
    assert {r["state"] for r in published_workbooks(spark, str(tmp_path)).collect()} == {"whole"}
    (tmp_path / "a.xlsx").write_bytes((tmp_path / "a.xlsx").read_bytes()[:-1])
    (tmp_path / "b.xlsx").rename(tmp_path / "d.xlsx")
    states = {r["workbook"]: r["state"] for r in published_workbooks(spark, str(tmp_path)).collect()}
    assert states == {"a.xlsx": "changed", "b.xlsx": "missing", "c.xlsx": "whole", "d.xlsx": "unlisted"}
    assert published_workbooks(spark, str(tmp_path / "nowhere")).collect() == []


def test_a_commit_that_fails_takes_back_what_it_moved(tmp_path, monkeypatch):
    writer = XlsxWriter(str(tmp_path))
    one, two = writer.write(batches(["a.xlsx", "b.xlsx"])), writer.write(batches(["a.xlsx"]))
    with pytest.raises(ValueError, match="two tasks"):
        writer.commit([one, two])
    short = xlsx.Written([one.books[0], (*one.books[1][:2], one.books[1][2] + 1, 0)])
    with pytest.raises(OSError, match="bytes"):
        writer.commit([short])
    with monkeypatch.context() as m:
        m.setattr(xlsx.json, "dumps", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            writer.commit([one])
    assert all(f.startswith("_staging-") for f in files(tmp_path))
    writer.abort([])
    assert files(tmp_path) == [] and not list(tmp_path.iterdir())


def test_a_job_that_fails_publishes_nothing(spark, tmp_path):
    xlsx.register(spark)
    rows = spark.range(400).select(
        F.concat(F.lit("b"), F.col("id") % 8, F.lit(".xlsx")).alias("workbook"), F.lit("s").alias("sheet"), F.lit(0).alias("sheet_index"), F.col("id").alias("row"),
        F.array(F.concat(F.lit("n"), F.col("id"))).alias("cells"),
    ).repartition(8, "workbook").sortWithinPartitions("workbook", "row")
    broken = rows.withColumn("cells", F.when(F.col("row") == 399, F.array(F.raise_error("no"))).otherwise(F.col("cells")))
    with pytest.raises(Exception, match="no"):
        broken.write.format("xlsx").mode("append").save(f"file://{tmp_path}")
    assert files(tmp_path) == []
    rows.write.format("xlsx").mode("append").save(f"file://{tmp_path}")
    assert [f for f in files(tmp_path) if not f.startswith("_published-")] == [f"b{n}.xlsx" for n in range(8)]
    assert read_workbooks(spark, str(tmp_path)).where("row IS NOT NULL").count() == 400
    assert [r["state"] for r in published_workbooks(spark, str(tmp_path)).collect()] == ["whole"] * 8
