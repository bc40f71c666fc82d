"""The xxh3-128 digest, byte for byte as stored records have it, for checking against them.

Cells are encoded and hashed in Arrow batches inside tasks; each task gives one partial sum per key and column, and
Spark adds those up. Slower than the built-in digest, and interchangeable with it wherever records are compared.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence
from decimal import Decimal

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.columns import named
from slicedigest.functions.digests import LIMBS, TAGS, carry, from_hex, to_hex
from slicedigest.functions.kinds import kinds_of

ALGORITHM = "binary-aggregate-xxh3-128"
VERSION = 2
SPACE = 1 << 128


def _packed(value: int) -> bytes:
    return struct.pack("<q", value)


def _plain(value: Decimal) -> bytes:
    text = f"{value:f}"
    if "." in text:
        text = text.rstrip("0").rstrip(".")
    return b"0" if value == 0 else text.encode()


def _double(value: float) -> bytes:
    return struct.pack("<d", float("nan") if value != value else value or 0.0)


PAYLOADS = {
    "float": _double,
    "string": str.encode,
    "date": _packed,
    "datetime": _packed,
    "instant": _packed,
    "time": _packed,
    "integer": lambda v: str(v).encode(),
    "uint64": lambda v: str(int(v)).encode(),
    "boolean": lambda v: b"\x01" if v else b"\x00",
    "binary": bytes,
    "decimal": _plain,
    "interval": lambda v: str(v).encode(),
    "duration[us]": lambda v: str(v).encode(),
    "duration[ms]": lambda v: str(v * 1000).encode(),
    "duration[ns]": _packed,
    "datetime[ns]": _packed,
}
STORED = {"date": pa.int32(), "datetime": pa.int64(), "instant": pa.int64(), "interval": pa.int64(), "time": pa.int64()}


def cell_hashes(values: pa.Array, kind: str) -> list[bytes]:
    """Return the sixteen hash bytes of every cell of a column."""
    nothing = xxhash.xxh3_128_digest(b"\x00")
    if kind == "null":
        return [nothing] * len(values)
    if kind in STORED:
        values = values.cast(STORED[kind]) if kind == "date" else values.view(STORED[kind])
    tag, payload, digest = bytes([TAGS[kind]]), PAYLOADS[kind], xxhash.xxh3_128_digest
    return [nothing if v is None else digest(tag + payload(v)) for v in values.to_pylist()]


def partial_sums(df: DataFrame, keys: dict[str, Column], columns: Sequence[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Return ``keys, position, rows, digest`` per task; position -1 is the row digest."""
    found = list(kinds_of(df.select(*[named(c) for c in columns]).schema, kinds).values())
    flat = df.select(*[k.alias(f"__k{n}") for n, k in enumerate(keys.values())], *[named(c).alias(f"__c{n}") for n, c in enumerate(columns)])
    width, depth = len(columns), len(keys)
    key_fields = flat.schema.fields[:depth]
    out = T.StructType([*[T.StructField(name, f.dataType) for name, f in zip(keys, key_fields)], T.StructField("position", T.IntegerType()), T.StructField("rows", T.LongType()), T.StructField("digest", T.StringType())])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list[int]] = {}
        key_types: list[pa.DataType] = []
        for batch in batches:
            key_types = [batch.column(n).type for n in range(depth)]
            cells = [cell_hashes(batch.column(depth + n), kind) for n, kind in enumerate(found)]
            owners = list(zip(*[batch.column(n).to_pylist() for n in range(depth)])) if depth else [()] * batch.num_rows
            for owner, row in zip(owners, zip(*cells)):
                total = sums.setdefault(owner, [0] * (width + 2))
                for n, cell in enumerate(row):
                    total[n] += int.from_bytes(cell, "big")
                total[width] += xxhash.xxh3_128_intdigest(b"".join(row))
                total[width + 1] += 1
        if not sums:
            return
        lines = [(*owner, n if n < width else -1, total[width + 1], f"{total[n] % SPACE:032x}") for owner, total in sums.items() for n in range(width + 1)]
        types = [*key_types, pa.int32(), pa.int64(), pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*lines), types)], names=out.names)

    return flat.mapInArrow(add_up, out)


def digest_by_xxh3(df: DataFrame, keys: dict[str, Column], columns: Sequence[str], kinds: dict[str, str] | None = None) -> DataFrame:
    """Return the row count, frame digest and row digest of every key group; without keys always one row."""
    parts = partial_sums(df, keys, columns, kinds)
    limbs = list(enumerate(from_hex("digest")))
    total = parts.groupBy(*keys).agg(
        F.expr("coalesce(sum(rows) FILTER (WHERE position = -1), 0L) AS rows"),
        *[F.expr(f"coalesce(sum({limb}), 0L) AS __f{n}") for n, limb in limbs],
        *[F.expr(f"coalesce(sum({limb}) FILTER (WHERE position = -1), 0L) AS __r{n}") for n, limb in limbs],
    )
    whole = lambda p: F.expr(to_hex(carry([f"__{p}{n}" for n in range(LIMBS)])))
    return total.select(
        *keys, "rows", whole("f").alias("digest"), whole("r").alias("row_digest"), F.lit(ALGORITHM).alias("algorithm"), F.lit(VERSION).alias("version"), F.lit("dataframe").alias("scope")
    )


def digest_columns_xxh3(df: DataFrame, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return ``position, column, value_count, digest`` of every column."""
    names = F.array(*[F.lit(c) for c in df.columns])
    parts = partial_sums(df, {}, df.columns, kinds).where(F.col("position") >= 0)
    total = parts.groupBy("position").agg(F.sum("rows").alias("value_count"), *[F.expr(f"sum({limb}) AS __c{n}") for n, limb in enumerate(from_hex("digest"))])
    digest = F.expr(to_hex(carry([f"__c{n}" for n in range(LIMBS)])))
    return total.select("position", F.element_at(names, F.col("position") + 1).alias("column"), "value_count", digest.alias("digest"))
