"""Conversion rules, date decoding and names on edge values."""

import datetime as dt
import time
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.columns import free_name, named
from slicedigest.functions.names import column_problem, render, template_tokens, workbook_problem, worksheet_problem
from slicedigest.functions.kinds import require_instants
from slicedigest.operators.bucket import bucket_counts, decode_errors, first_refusal
from slicedigest.operators.convert import conversion_changes, to_cells
from slicedigest.options import DateColumn, Limits, Naming, Partitioning, Profile, Sheet, SortKey, Source, check_profiles
from slicedigest.plans.naming import claim_names


def one(df):
    return tuple(df.first())


def test_every_rule(spark):
    df = spark.createDataFrame(
        [(True, 1.5, 7, Decimal("1.2500"), "", b"\xff\x00", dt.datetime(1969, 12, 31, 23, 59, 59, 500000), dt.date(1899, 12, 31), 1500000, None)],
        "b boolean, f float, i tinyint, m decimal(18,4), s string, x binary, t timestamp_ntz, d date, u bigint, e void",
    )
    got = one(to_cells(df, kinds={"u": "duration[us]"}))
    assert got == (-1.0, 1.5, 7.0, 1.25, None, "ff00", dt.datetime(1969, 12, 31, 23, 59, 59), dt.date(1899, 12, 31), 1.5, None)
    assert to_cells(df).schema["x"].dataType == T.StringType()


def test_cut_happens_after_hex_and_counts_characters(spark):
    df = spark.createDataFrame([("é" * 32_800, b"\x01" * 20_000)], "s string, x binary")
    s, x = one(to_cells(df))
    assert len(s) == len(x) == 32_767
    assert conversion_changes(df).first()["moved"] == ["s", "x"]
    assert not conversion_changes(to_cells(df)).first()["changed"]


def test_not_finite_becomes_null_and_zero_stays(spark):
    df = spark.createDataFrame([(float("nan"),), (float("inf"),), (float("-inf"),), (-0.0,), (None,)], "f double")
    assert [r[0] for r in to_cells(df).collect()] == [None, None, None, 0.0, None]


def test_zoned_instant_keeps_its_wall_clock(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-01-01 02:00:00.7 UTC' AS t")
    assert one(to_cells(df, zones={"t": "America/Mexico_City"})) == (dt.datetime(2025, 12, 31, 20, 0, 0),)
    assert one(to_cells(df)) == (dt.datetime(2026, 1, 1, 2, 0, 0),)


def test_nanosecond_columns(spark):
    df = spark.createDataFrame([(-1_500_000_001, 1_000_000_000)], "t bigint, d bigint")
    assert one(to_cells(df, kinds={"t": "datetime[ns]", "d": "duration[ns]"})) == (dt.datetime(1969, 12, 31, 23, 59, 58), 1.0)


def test_literal_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["*", "^a$", "a.b"])
    assert one(to_cells(df)) == (1.0, 2.0, 3.0) and to_cells(df).columns == ["*", "^a$", "a.b"]
    assert one(df.select(named("a.b"))) == (3,)
    assert free_name(["__key", "__KEY_1"], "__key") == "__key_2"


@pytest.mark.parametrize(
    ("value", "spec", "key"),
    [
        (6901, DateColumn.integer("YYMM", 1970), 20690100),
        (7001, DateColumn.integer("YYMM", 1970), 19700100),
        (101, DateColumn.integer("YYMM", 1970), 20010100),
        (20240229, DateColumn.integer("YYYYMMDD"), 20240200),
        (202402, DateColumn.integer("YYYYMM"), 20240200),
    ],
)
def test_integer_dates(spark, value, spec, key):
    df = spark.createDataFrame([(value,)], "v bigint")
    assert bucket_counts(df, "v", spec, "month").first()["key"] == key


@pytest.mark.parametrize(
    ("value", "fmt", "reason"),
    [(20251345, "YYYYMMDD", "month"), (20230229, "YYYYMMDD", "day"), (-1, "YYYYMM", "negative"), (1_000_000, "YYYYMM", "digits"), (12, "YYYYMM", "year"), (19000229, "YYYYMMDD", "day")],
)
def test_refused_integers(spark, value, fmt, reason):
    df = spark.createDataFrame([(5, value)], "n bigint, v bigint")
    row = decode_errors(df, "v", DateColumn.integer(fmt), [F.col("n")]).first()
    assert (row["ordinal"], row["value"], row["reason"]) == (5, str(value), reason)


def test_earliest_refusal_wins(spark):
    df = spark.createDataFrame([(0, 202401), (1, None), (2, -5)], "n bigint, v bigint")
    spec = DateColumn.integer("YYYYMM")
    assert first_refusal(df, "v", spec, "error", F.col("n")).first()["reason"] == "null"
    assert first_refusal(df, "v", spec, "separate", F.col("n")).first()["ordinal"] == 2
    assert first_refusal(df.where("n = 0"), "v", spec, "error", F.col("n")).first() is None


def test_zone_moves_a_row_to_the_year_before(spark):
    df = spark.sql("SELECT TIMESTAMP '2026-01-01 02:00:00 UTC' AS t")
    at = lambda spec: bucket_counts(df, "t", spec, "day").first()["key"]
    assert at(DateColumn.datetime(zone="America/Mexico_City")) == 20251231 and at(DateColumn.datetime()) == 20260101


def test_schema_refusals(spark):
    naive = spark.sql("SELECT TIMESTAMP_NTZ '2026-01-01 02:00:00' AS t, 1.5D AS f")
    with pytest.raises(TypeError, match="instant"):
        bucket_counts(naive, "t", DateColumn.datetime(zone="Europe/Madrid"), "day")
    with pytest.raises(TypeError):
        bucket_counts(naive, "f", DateColumn.integer("YYYYMM"), "month")
    with pytest.raises(ValueError, match="months only"):
        bucket_counts(spark.createDataFrame([(202401,)], "v int"), "v", DateColumn.integer("YYYYMM"), "day")


@pytest.mark.parametrize(
    "make",
    [
        lambda: DateColumn.integer("YYMM"),
        lambda: DateColumn.integer("YYYYMM", 1970),
        lambda: DateColumn.integer("YYMM", 9950),
        lambda: Limits(0, 10),
        lambda: Limits(1_048_576, 10),
        lambda: Partitioning(year_split_months=(6, 6, 1)),
        lambda: Partitioning(year_split_months=(6, 4)),
        lambda: Partitioning(year_split_months=(3, 6, 1)),
        lambda: Naming(worksheet="{part_index}"),
        lambda: Naming(workbook="{profile.__class__}"),
        lambda: Profile("a b", (Sheet("x", "d"),)),
        lambda: Profile("p", ()),
        lambda: Profile("p", (Sheet("x"),)),
        lambda: Profile("p", (Sheet("x", "d", (SortKey("a"), SortKey("a"))),)),
        lambda: Profile("p", (Sheet("x", "d"), Sheet("y", "d")), naming=Naming(worksheet="{period_label}")),
        lambda: check_profiles({"x": Source("x.parquet")}, [Profile("p", (Sheet("x", "d"),))]),
        lambda: check_profiles({"x": Source("x"), "X": Source("y")}, []),
    ],
)
def test_options_are_checked(make):
    with pytest.raises(ValueError):
        make()


@pytest.mark.parametrize(
    ("name", "problem"),
    [("ok 2025-01~06", None), ("", "empty"), ("x" * 32, "too-long"), ("a/b", "forbidden-character"), ("a\tb", "control-character"), ("'a", "apostrophe"), ("HISTORY", "reserved")],
)
def test_worksheet_names(spark, name, problem):
    assert one(spark.createDataFrame([(name,)], "n string").select(worksheet_problem(F.col("n")))) == (problem,)


@pytest.mark.parametrize(
    ("name", "problem"),
    [("a.xlsx", None), ("..", "traversal"), ("a|b.xlsx", "forbidden-character"), ("a.xlsx ", "trailing"), ("CON.xlsx", "device-name"), ("lpt9", "device-name"), ("console.xlsx", None)],
)
def test_workbook_names(spark, name, problem):
    assert one(spark.createDataFrame([(name,)], "n string").select(workbook_problem(F.col("n")))) == (problem,)


def test_name_claims():
    assert claim_names(["a", "A", "a_2", "b"]) == ["a", "A_2", "a_2_2", "b"]
    long = "x" * 31
    assert claim_names([long, long, long[:29] + "_2"]) == [long, "x" * 29 + "_2", "x" * 29 + "_3"]


def test_name_claims_do_not_slow_down():
    started = time.monotonic()
    given = claim_names(["x" * 31, "X" * 31] * 10_000)
    assert time.monotonic() - started < 10  # seconds; minutes where each claim counts from one
    assert given[-1] == "X" * 25 + "_20000" and len({g.lower() for g in given}) == len(given)
    assert claim_names(["İ" * 31, "i" * 31, "İ" * 31, "ς" * 31, "Σ" * 31]) == ["İ" * 31, "i" * 31, "İ" * 29 + "_2", "ς" * 31, "Σ" * 31]


def test_templates(spark):
    assert template_tokens("{a}-{b:03d}") == {"a", "b"}
    df = spark.createDataFrame([(12345, "s")], "n int, t string")
    assert one(df.select(render("{t}_{n:03d}{{}}", {"t": F.col("t"), "n": F.col("n")}, {"n"}))) == ("s_12345{}",)
    with pytest.raises(ValueError):
        render("{t:03d}", {"t": F.col("t")}, set())
    with pytest.raises(KeyError):
        render("{other}", {}, set())


def test_column_names():
    assert column_problem(["a", "b"]) is None and "case" in column_problem(["a", "A"]) and "no name" in column_problem(["a", ""])


def test_record_times_are_instants(spark):
    schema = spark.sql("SELECT TIMESTAMP '2026-01-01 00:00:00' AS a, TIMESTAMP_NTZ '2026-01-01 00:00:00' AS b").schema
    require_instants(schema, ["a"])
    with pytest.raises(TypeError, match="b"):
        require_instants(schema, ["a", "b"])
