"""Row ordinals and exact positions without collecting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicedigest.functions.columns import idiv, named
from slicedigest.options import SortKey
from slicedigest.runtime import broadcast_if_small, materialise

FILE = "__file"
ROW = "__row"


def read_with_ordinal(df: DataFrame) -> DataFrame:
    """Add the file and the row number in it to a freshly read Parquet frame.

    Together they order the rows of any number of files the same way on every run, with no shuffle.
    """
    return df.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))


def file_offsets(df: DataFrame) -> DataFrame:
    """Return the number of rows ahead of each file, files taken in path order."""
    sizes = df.groupBy(FILE).agg(F.count("*").alias("rows"))
    before = Window.orderBy(FILE).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(FILE, "rows", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint")).alias("offset"))


def global_ordinal(df: DataFrame, name: str) -> DataFrame:
    """Number the rows of all files through, from zero. Costs a scan of no data column and a join on the file."""
    offsets = broadcast_if_small(materialise(file_offsets(df).select(FILE, "offset")))
    return df.join(offsets, FILE).withColumn(name, F.col("offset") + F.col(ROW)).drop("offset")


def sort_column(value: Column, key: SortKey) -> Column:
    if key.descending:
        return value.desc_nulls_first() if key.nulls_first else value.desc_nulls_last()
    return value.asc_nulls_first() if key.nulls_first else value.asc_nulls_last()


def with_positions(df: DataFrame, groups: Sequence[str], order: Sequence[Column], position: str) -> DataFrame:
    """Number the rows of each group from zero in the given order.

    Rows are range-partitioned on (group, order), so a group of any size is spread over as many tasks as its share of
    the data needs; equal sort keys split too as long as the order ends in something unique. Range bounds come from a
    sample, so the ranked rows are checkpointed once: the per-task counts and the final numbers then see the same ranges.
    """
    placed = materialise(
        df.repartitionByRange(*[F.col(g).asc() for g in groups], *order)
        .sortWithinPartitions(*[F.col(g).asc() for g in groups], *order)
        .withColumn("__place", F.monotonically_increasing_id())
    )
    # monotonically_increasing_id holds the task in the upper bits and the row's place in the task in the lower 33.
    task = F.shiftright("__place", 33)
    placed = placed.withColumn("__task", task)
    earlier = Window.partitionBy(*groups).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(*groups, "__task")
        .agg(F.count("*").alias("__n"), F.min("__place").alias("__first"))
        .select(
            *[F.col(g).alias(f"__g{n}") for n, g in enumerate(groups)],
            F.col("__task").alias("__gt"),
            (F.coalesce(F.sum("__n").over(earlier), F.lit(0).cast("bigint")) - F.col("__first")).alias("__shift"),
        )
    )
    same = F.col("__task") == F.col("__gt")
    for n, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{n}"))
    # At most one record per task and per group that starts in it.
    starts = broadcast_if_small(materialise(starts))
    kept = [named(c) for c in df.columns]
    return placed.join(starts, same).select(*kept, (F.col("__place") + F.col("__shift")).alias(position))


def part_of(position: Column, rows: Column, parts: Column) -> Column:
    """Return which of ``parts`` even pieces a position falls in; the larger pieces come first."""
    base = idiv(rows, parts)
    extra = F.pmod(rows, parts)
    edge = extra * (base + 1)
    # A piece past the edge has rows, so its size is at least one whenever that branch is taken.
    small = F.greatest(base, F.lit(1).cast("bigint"))
    return F.when(position < edge, idiv(position, base + 1)).otherwise(extra + idiv(position - edge, small)).cast("int")


def part_start(part: Column, rows: Column, parts: Column) -> Column:
    """Return the position the given piece starts at."""
    return part * idiv(rows, parts) + F.least(part.cast("bigint"), F.pmod(rows, parts).cast("bigint"))


def part_rows(part: Column, rows: Column, parts: Column) -> Column:
    return idiv(rows, parts) + (part < F.pmod(rows, parts)).cast("bigint")
