"""Parquet sources, and exports as Parquet folders of sheets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.operators.export import Export, SourceTable
from slicedigest.operators.order import read_with_ordinal
from slicedigest.options import DateColumn


def read_source(spark: SparkSession, path: str, date_columns: dict[str, DateColumn] | None = None, **facts) -> SourceTable:
    """Read a Parquet source with its row ordinal."""
    return SourceTable(read_with_ordinal(spark.read.parquet(path)), source_stem(path), date_columns or {}, **facts)


def source_stem(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    return name[: -len(".parquet")] if name.endswith(".parquet") else name


def source_files(spark: SparkSession, path: str) -> DataFrame:
    """Return ``path, stem, modified, length`` of a source's files without opening them."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    stem = F.regexp_replace(F.regexp_extract("path", "([^/]+)$", 1), r"\.parquet$", "")
    return files.select("path", stem.alias("stem"), F.col("modificationTime").alias("modified"), "length")


def ordered_sheets(export: Export, alias: str) -> DataFrame:
    """Return one source's rows with each sheet whole in one task and in its final order.

    A sheet's row limit bounds what one task holds, whatever the source's skew.
    """
    arranged = export.arranged[alias]
    rows = export.placed[alias]
    return (
        rows.repartition("workbook", "sheet")
        .sortWithinPartitions("workbook", "sheet", *arranged.order)
        .select(*[F.col(f"`{c}`") for c in arranged.columns], "workbook", "sheet")
    )


def write_parquet_sheets(export: Export, path: str) -> None:
    """Write ``path/<alias>/workbook=…/sheet=…``, one file per sheet; a planned sheet without rows gets an empty file."""
    for alias in export.arranged:
        ordered_sheets(export, alias).write.mode("overwrite").partitionBy("workbook", "sheet").parquet(f"{path}/{alias}")
    empty = export.plan.where(F.col("rows") == 0).select("alias", "workbook", "sheet").collect()  # at most one per source
    for row in empty:
        arranged = export.arranged[row["alias"]]
        nothing = arranged.frame.select(*[F.col(f"`{c}`") for c in arranged.columns]).limit(0)
        nothing.coalesce(1).write.mode("append").parquet(f"{path}/{row['alias']}/workbook={row['workbook']}/sheet={row['sheet']}")


def read_parquet_sheets(spark: SparkSession, path: str, alias: str, schema: T.StructType) -> DataFrame:
    """Read a written source back; names are text even where a sheet is called ``2025``."""
    whole = T.StructType([*schema.fields, T.StructField("workbook", T.StringType()), T.StructField("sheet", T.StringType())])
    return spark.read.schema(whole).parquet(f"{path}/{alias}")
