"""Digests against hashes computed cell by cell in plain Python, their algebra, and what moves them."""

import datetime as dt
import random
import struct
from decimal import Decimal

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.digests import TAGS
from slicedigest.operators.digest import blank_digests, combine, compare_columns, digest_by, digest_columns, digest_frame
from slicedigest.operators.xxh3 import digest_by_xxh3, digest_columns_xxh3

SCHEMA = T.StructType(
    [
        T.StructField("i", T.LongType()),
        T.StructField("f", T.DoubleType()),
        T.StructField("s", T.StringType()),
        T.StructField("d", T.DateType()),
        T.StructField("t", T.TimestampNTZType()),
        T.StructField("b", T.BooleanType()),
        T.StructField("x", T.BinaryType()),
        T.StructField("m", T.DecimalType(18, 4)),
    ]
)
KINDS = ["integer", "float", "string", "date", "datetime", "boolean", "binary", "decimal"]
EPOCH = dt.datetime(1970, 1, 1)


def rows(n, seed=1):
    rng = random.Random(seed)
    maybe = lambda v: None if rng.random() < 0.15 else v
    out = []
    for _ in range(n):
        out.append(
            (
                maybe(rng.randrange(-(2**63), 2**63)),
                maybe(rng.choice([0.0, -0.0, float("nan"), float("inf"), rng.uniform(-1e9, 1e9)])),
                maybe(rng.choice(["", "a", "ünïcødé €", "x" * rng.randrange(80), "\x00\x01"])),
                maybe(dt.date(1, 1, 1) + dt.timedelta(days=rng.randrange(3_000_000))),
                maybe(EPOCH + dt.timedelta(microseconds=rng.randrange(-(10**15), 10**16))),
                maybe(rng.random() < 0.5),
                maybe(bytes(rng.randrange(256) for _ in range(rng.randrange(40)))),
                maybe(Decimal(rng.randrange(-(10**12), 10**12)).scaleb(-4)),
            )
        )
    return out


def plain_decimal(value):
    text = f"{value:f}"
    return "0" if value == 0 else text.rstrip("0").rstrip(".") if "." in text else text


def xx_cell(value, kind, side):
    seed = lambda tag: xxhash.xxh64_intdigest(struct.pack("<i", 2 * tag + side), 42)
    if value is None:
        return seed(0)
    data = {
        "integer": lambda v: struct.pack("<q", v),
        "float": lambda v: struct.pack("<d", float("nan") if v != v else v or 0.0),
        "string": str.encode,
        "date": lambda v: struct.pack("<q", (v - EPOCH.date()).days),
        "datetime": lambda v: struct.pack("<q", (v - EPOCH) // dt.timedelta(microseconds=1)),
        "boolean": lambda v: struct.pack("<q", int(v)),
        "binary": bytes,
        "decimal": lambda v: plain_decimal(v).encode(),
    }[kind](value)
    return xxhash.xxh64_intdigest(data, seed(TAGS[kind]))


def xx_frame(data):
    total = row_total = 0
    for row in data:
        lanes = [[xx_cell(v, k, side) for v, k in zip(row, KINDS)] for side in (0, 1)]
        hashed = []
        for side in (0, 1):
            h = xxhash.xxh64_intdigest(struct.pack("<i", 2 * 16 + side), 42)
            for cell in lanes[side]:
                h = xxhash.xxh64_intdigest(struct.pack("<Q", cell), h)
            hashed.append(h)
        own = hashed[0] * 2**64 + hashed[1]
        row_total += own
        total += own + sum(hi * 2**64 + lo for hi, lo in zip(*lanes))
    return f"{total % 2**128:032x}", f"{row_total % 2**128:032x}"


def xxh3_frame(data):
    def cell(v, kind):
        if v is None:
            return b"\x00"
        payload = {
            "integer": lambda: str(v).encode(),
            "float": lambda: struct.pack("<d", float("nan") if v != v else v or 0.0),
            "string": lambda: v.encode(),
            "date": lambda: struct.pack("<q", (v - EPOCH.date()).days),
            "datetime": lambda: struct.pack("<q", (v - EPOCH) // dt.timedelta(microseconds=1)),
            "boolean": lambda: b"\x01" if v else b"\x00",
            "binary": lambda: v,
            "decimal": lambda: plain_decimal(v).encode(),
        }[kind]()
        return bytes([TAGS[kind]]) + payload

    total = row_total = 0
    for row in data:
        hashes = [xxhash.xxh3_128_digest(cell(v, k)) for v, k in zip(row, KINDS)]
        own = xxhash.xxh3_128_intdigest(b"".join(hashes))
        row_total += own
        total += own + sum(int.from_bytes(h, "big") for h in hashes)
    return f"{total % 2**128:032x}", f"{row_total % 2**128:032x}"


def test_built_in_digest_equals_plain_python(spark):
    data = rows(300)
    got = digest_frame(spark.createDataFrame(data, SCHEMA).repartition(5)).first()
    assert (got["digest"], got["row_digest"]) == xx_frame(data) and got["rows"] == 300


def test_xxh3_digest_equals_plain_python(spark):
    data = rows(300)
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    got = digest_by_xxh3(df, {}, df.columns).first()
    assert (got["digest"], got["row_digest"], got["rows"]) == (*xxh3_frame(data), 300)
    empty = digest_by_xxh3(df.where("false"), {}, df.columns).first()
    assert (empty["digest"], empty["rows"]) == ("0" * 32, 0)
    assert {r["column"]: r["value_count"] for r in digest_columns_xxh3(df).collect()} == dict.fromkeys(df.columns, 300)


@pytest.mark.parametrize("seed", range(4))
def test_any_partition_adds_up_to_the_whole(spark, seed):
    df = spark.createDataFrame(rows(200, seed), SCHEMA).withColumn("part", F.floor(F.rand(seed) * (3 + seed * 7)).cast("int")).cache()
    columns = SCHEMA.names
    whole = digest_frame(df, columns).first()
    total = combine(digest_by(df, {"part": F.col("part")}, columns, bounded=True), []).first()
    assert (total["digest"], total["row_digest"], total["rows"]) == (whole["digest"], whole["row_digest"], 200)
    less = combine(digest_by(df.where("part > 0"), {"part": F.col("part")}, columns), []).first()
    assert less["digest"] != whole["digest"]


def test_what_moves_the_digest(spark):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "n int, s string")
    same = spark.createDataFrame([(3, None), (1, "a"), (2, "b")], "n bigint, s string")
    swapped = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "n int, s string")
    edited = spark.createDataFrame([(1, "a"), (2, "b"), (3, "")], "n int, s string")
    d = lambda df, columns=None: digest_frame(df, columns).first()
    assert d(base)["digest"] == d(same)["digest"]
    columns = lambda df: {r["column"]: r["digest"] for r in digest_columns(df).collect()}
    assert columns(base) == columns(swapped) and d(base)["row_digest"] != d(swapped)["row_digest"]
    assert d(base)["digest"] != d(edited)["digest"]
    assert d(base)["digest"] != d(base, ["s", "n"])["digest"]
    assert d(base)["digest"] != d(base.withColumn("extra", F.lit(1)))["digest"]
    assert d(base.toDF("x", "y"))["digest"] == d(base)["digest"]


def test_nulls_of_every_type_and_normal_forms_agree(spark):
    df = spark.range(1).select(
        F.lit(None).cast("int").alias("a"), F.lit(None).cast("string").alias("b"), F.lit(None).alias("c"), F.lit(0.0).alias("d"), F.lit(-0.0).alias("e")
    )
    got = {r["column"]: r["digest"] for r in digest_columns(df).collect()}
    assert got["a"] == got["b"] == got["c"] and got["d"] == got["e"] != got["a"]


def test_declared_kinds(spark):
    big = spark.createDataFrame([(Decimal(2**64 - 1),), (Decimal(7),)], "u decimal(20,0)")
    seven = spark.createDataFrame([(7,)], "u bigint")
    only = digest_columns(big.where("u = 7"), kinds={"u": "uint64"}).first()["digest"]
    assert only == digest_columns(seven).first()["digest"] != digest_columns(big.where("u = 7")).first()["digest"]
    ticks = spark.createDataFrame([(1500,)], "t bigint")
    in_ms = digest_columns(ticks, kinds={"t": "duration[ms]"}).first()["digest"]
    in_us = digest_columns(ticks.select((F.col("t") * 1000).alias("t")), kinds={"t": "duration[us]"}).first()["digest"]
    assert in_ms == in_us


def test_wide_table_column_by_column(spark):
    wide = spark.range(50).select(*[(F.col("id") * n).alias(f"c{n}") for n in range(120)])
    got = digest_columns(wide).collect()
    one = digest_columns(wide.select("c77")).first()
    assert len(got) == 120 and next(r for r in got if r["column"] == "c77")["digest"] == one["digest"]


def test_nested_types_are_refused_by_name(spark):
    with pytest.raises(TypeError, match="embedding"):
        digest_frame(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet"))


def test_combine_refusals(spark):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    parts = digest_by(df, {"p": F.col("p")}, ["id"])
    mixed = parts.withColumn("scope", F.when(F.col("p") == 0, "column").otherwise(F.col("scope")))
    assert combine(mixed, []).first()["refusal"] == "mixed-identity"
    partial = parts.withColumn("row_digest", F.when(F.col("p") == 0, F.col("row_digest")))
    assert combine(partial, []).first()["refusal"] == "partial-row-digest"
    assert combine(parts.drop("row_digest").withColumn("row_digest", F.lit(None).cast("string")), []).first()["row_digest"] is None


def test_compare_columns_names_added_and_removed(spark):
    a, b = spark.range(3).select("id", F.lit(1).alias("x")), spark.range(3).select("id", F.lit(1).alias("y"))
    got = {r["column"]: r["change"] for r in compare_columns(digest_columns(a), digest_columns(b)).collect()}
    assert got == {"id": "same", "x": "removed", "y": "added"}


def test_any_number_of_blank_rows(spark):
    counts = [0, 1, 199, 2**31 // 12, 2**31, 3_582_000_000, 2**48 + 70_001]
    sheets = spark.createDataFrame([(n, w) for n in counts for w in (6, 11)], "missing bigint, width int")
    found = {(r["missing"], r["width"]): r for r in blank_digests(sheets, F.col("width")).collect()}
    for (count, width), r in found.items():
        for name in ("digest", "row_digest"):
            assert int(r[name], 16) == count * int(found[1, width][name], 16) % 2**128
    nothing = digest_by(spark.range(199).select(*[F.lit(None).cast("string").alias(f"c{n}") for n in range(6)]), {}, [f"c{n}" for n in range(6)]).first()
    assert nothing["digest"] == found[199, 6]["digest"] and nothing["row_digest"] == found[199, 6]["row_digest"]
