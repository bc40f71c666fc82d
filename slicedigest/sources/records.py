"""Descriptions, manifests, receipts and reports as JSON, one record per line, read with a fixed schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.operators.describe import COLUMN, CONVERTED, RECORD
from slicedigest.operators.export import Export

SCHEMA_VERSION = 1
MANIFEST = (
    "schema_version int, profile string, alias string, workbook string, sheet string, workbook_index int, sheet_index int, kind string, "
    "period_label string, part_index int, rows bigint, cells bigint, header array<string>, digest string, row_digest string, "
    "algorithm string, version int, scope string"
)
SOURCES = (
    "schema_version int, alias string, rows bigint, digest string, row_digest string, algorithm string, version int, scope string, "
    "conversion_version string, total_and_disjoint boolean"
)
RECEIPT = (
    "schema_version int, profile string, owner string, config_id string, exported timestamp, config_hash string, planner_version string, "
    "location string, sources map<string, struct<modified: timestamp, described: timestamp>>"
)
DESCRIPTION = (
    f"schema_version int, path string, stem string, modified timestamp, modified_in_zones map<string, timestamp>, described timestamp, "
    f"source {RECORD}, columns array<{COLUMN}>, conversions array<{CONVERTED}>, error string"
)


def write_records(df: DataFrame, path: str) -> None:
    """Write records; every one carries the version of its shape. Those that are there stay until the new ones are whole.

    The new ones are written beside them and take their place by renaming, which a file system does at once and an object store
    file by file. A run that ends in between leaves whole records, old or new, where `read_records` finds them.
    """
    spark, new, old = df.sparkSession, f"{path}{NEXT}", f"{path}.old"
    found = place(spark, path)
    if found == new:
        _move(spark, new, path)
    remove(spark, new)
    remove(spark, old)
    df.withColumn("schema_version", F.lit(SCHEMA_VERSION)).write.json(new)
    if found is not None:
        _move(spark, path, old)
    _move(spark, new, path)
    remove(spark, old)


NEXT = ".next"


def place(spark: SparkSession, path: str) -> str | None:
    """Return the folder that holds the records of a path, or None: that of a write cut short just before its last step counts."""
    new = f"{path}{NEXT}"
    return path if exists(spark, path) else new if exists(spark, f"{new}/_SUCCESS") else None


def read_records(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Return the records this version can read, and the raw text of those it cannot."""
    path = place(spark, path) or path
    raw = spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)
    good = F.col("_corrupt_record").isNull() & F.coalesce(F.col("schema_version") == SCHEMA_VERSION, F.lit(False))
    texts = spark.read.text(path)
    version = F.get_json_object("value", "$.schema_version").try_cast("int")
    unreadable = texts.where(~F.coalesce(version == SCHEMA_VERSION, F.lit(False)))
    return raw.where(good).drop("_corrupt_record", "schema_version"), unreadable


def _named(spark: SparkSession, path: str):
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), made


def exists(spark: SparkSession, path: str) -> bool:
    """Say whether a file or folder is there, on whatever file system its path names."""
    files, made = _named(spark, path)
    return files.exists(made)


def matches(spark: SparkSession, path: str) -> bool:
    """Say whether a path, or a pattern of paths as Spark's readers take them, names anything."""
    files, made = _named(spark, path)
    return bool(files.globStatus(made))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Return the names of what lies in a folder, none where there is no such folder."""
    files, made = _named(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(made)) if files.exists(made) else []


def mark(spark: SparkSession, path: str) -> None:
    """Leave an empty file."""
    files, made = _named(spark, path)
    files.create(made).close()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder, if it is there."""
    files, made = _named(spark, path)
    files.delete(made, True)


def _move(spark: SparkSession, path: str, to: str) -> None:
    files, made = _named(spark, path)
    if not files.rename(made, _named(spark, to)[1]):
        raise OSError(f"{path} could not be renamed to {to}")


def publish_records(export: Export, receipt: DataFrame, path: str) -> None:
    """Write the manifest, then the sources, and the receipt last: it marks the export as complete."""
    write_records(export.fragments, f"{path}/{export.profile.name}.manifest")
    write_records(export.sources, f"{path}/{export.profile.name}.sources")
    write_records(receipt, f"{path}/{export.profile.name}.receipt")
