"""Describing tables: what a later run or check needs to know without the table."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.kinds import kinds_of, type_flags
from slicedigest.operators.convert import CONVERSION, CONVERSION_VERSION, to_cells
from slicedigest.operators.digest import digest_all, digest_columns, digest_frame
from slicedigest.operators.select import instants_in_zones


def describe_columns(df: DataFrame, columns: list[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return one row per column: type, family flags, value and null counts, digest. One pass over the table."""
    columns = columns or df.columns
    found = kinds_of(df.select(*[F.col(f"`{c}`") for c in columns]).schema, kinds)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    facts = F.array(
        *[
            F.struct(F.lit(types[name]).alias("type"), F.lit(kind).alias("kind"), *[F.lit(v).alias(k) for k, v in type_flags(kind).items()])
            for name, kind in found.items()
        ]
    )
    digests = digest_columns(df, columns, kinds)
    return digests.withColumn("__f", F.element_at(facts, F.col("position") + 1)).select(
        "position", "column", "__f.*", "value_count", "null_count", "digest", "algorithm", "version", "scope"
    )


def describe_converted(df: DataFrame, kinds: dict[str, str] | None = None, zones: dict[str, str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Return the converted table and its description, stamped with the conversion's identity."""
    converted = to_cells(df, kinds, zones)
    described = describe_columns(converted).withColumns({"conversion": F.lit(CONVERSION), "conversion_version": F.lit(CONVERSION_VERSION)})
    return converted, described


RECORD = "struct<rows:bigint,digest:string,row_digest:string,algorithm:string,version:int>"
COLUMN = "struct<position:int,column:string,type:string,kind:string,value_count:bigint,null_count:bigint,digest:string>"
CONVERTED = "struct<id:string,version:string,algorithm:string,hasher_version:int,schema:string,rows:bigint,digest:string,row_digest:string>"


def describe_table(path: str, df: DataFrame, kinds: dict[str, str] | None = None, zones: dict[str, str] | None = None) -> DataFrame:
    """Return one row for a file: the source's digests and columns, and the converted table's record in ``conversions``.

    Source and converted table are digested in one pass each; the converted schema is kept as JSON (`stored_schema`).
    """
    converted = to_cells(df, kinds, zones)
    found = kinds_of(df.schema, kinds)
    facts = {f.name: (f.dataType.simpleString(), found[f.name]) for f in df.schema.fields}
    names = F.create_map(*[F.lit(v) for name, (kind, _) in facts.items() for v in (name, kind)])
    families = F.create_map(*[F.lit(v) for name, (_, family) in facts.items() for v in (name, family)])
    column = F.struct("position", "column", names[F.col("column")].alias("type"), families[F.col("column")].alias("kind"), "value_count", "null_count", "digest")
    whole = F.col("scope") == "dataframe"
    source = digest_all(df, kinds=kinds).agg(
        F.max(F.when(whole, F.struct(F.col("value_count").alias("rows"), "digest", "row_digest", "algorithm", "version"))).cast(RECORD).alias("source"),
        F.array_sort(F.collect_list(F.when(~whole, column))).cast(f"array<{COLUMN}>").alias("columns"),
    )
    second = digest_frame(converted).select(
        F.array(
            F.struct(
                F.lit(CONVERSION).alias("id"), F.lit(CONVERSION_VERSION).alias("version"), "algorithm", F.col("version").alias("hasher_version"),
                F.lit(converted.schema.json()).alias("schema"), "rows", "digest", "row_digest",
            )
        ).cast(f"array<{CONVERTED}>").alias("conversions")
    )
    return source.crossJoin(second).select(F.lit(path).alias("path"), "source", "columns", "conversions")  # one row each


def stored_schema(text: str) -> T.StructType:
    """Read back the schema that a description or a fragment's record keeps."""
    return T.StructType.fromJson(json.loads(text))


def describe_many(spark: SparkSession, paths: list[str], zones: list[str] | None = None, **facts) -> DataFrame:
    """Describe Parquet sources; one row per path, with ``error`` and no digests for one that cannot be read.

    Adds the source's file time, in UTC and as wall clock in each of ``zones``, and when it was described. Each source is a job
    of its own, so that one that is damaged leaves the others alone; what comes back to the driver is a row per source.
    """
    now = F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
    shape = f"path string, stem string, source {RECORD}, columns array<{COLUMN}>, conversions array<{CONVERTED}>, error string, modified timestamp"
    rows = []
    for path in paths:
        stem = path.rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet")
        try:
            files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
            modified = files.agg(F.max("modificationTime").alias("m")).first()["m"]
            row = describe_table(path, spark.read.parquet(path), **facts).first()
            rows.append((path, stem, row["source"], row["columns"], row["conversions"], None, modified))
        except Exception as error:  # whatever is wrong with one source is its own row
            rows.append((path, stem, None, None, None, f"{type(error).__name__}: {str(error).splitlines()[0][:500]}", None))
    described = spark.createDataFrame(rows, shape).withColumn("described", now)
    return described.withColumn("modified_in_zones", instants_in_zones(F.col("modified"), zones or ["UTC"]))
