"""The two ceilings: rows per sheet and cells per workbook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.columns import idiv
from slicedigest.options import MAX_COLUMNS, MAX_DATA_ROWS


def sheet_cells(columns: Column, rows: Column) -> Column:
    """Cells of a sheet, header row included."""
    return columns.cast("bigint") * (rows + 1)


def sheet_capacity(columns: Column, max_rows: Column, budget: Column) -> Column:
    """Most data rows one sheet may hold; below one the budget cannot pay for a header and a row."""
    return F.least(max_rows.cast("bigint"), idiv(budget.cast("bigint"), F.greatest(columns.cast("bigint"), F.lit(1).cast("bigint"))) - 1)


def minimum_sheets(rows: Column, capacity: Column) -> Column:
    """Fewest sheets that hold the rows; no rows still take one header-only sheet."""
    one = F.lit(1).cast("bigint")
    return F.greatest(one, idiv(rows + capacity - 1, F.greatest(capacity, one)))


def balanced_sizes(rows: Column, parts: Column) -> Column:
    """Sizes of an even split as an array, larger pieces first."""
    base, extra = idiv(rows, parts), F.pmod(rows, parts)
    return F.transform(F.sequence(F.lit(1).cast("bigint"), parts.cast("bigint")), lambda n: base + (n <= extra).cast("bigint"))


def oversized_shape(columns: Column, rows: Column) -> Column:
    """Return why a sheet cannot exist at all, or null."""
    return F.when(columns < 1, "no-columns").when(columns > MAX_COLUMNS, "too-many-columns").when(rows > MAX_DATA_ROWS, "too-many-rows")


def with_capacity(inputs: DataFrame) -> DataFrame:
    """Add ``capacity`` to rows of ``columns, max_rows, budget``."""
    return inputs.withColumn("capacity", sheet_capacity(F.col("columns"), F.col("max_rows"), F.col("budget")))


def one_workbook(inputs: DataFrame) -> DataFrame:
    """Return ``profile, one_workbook``: whether every source fits one sheet and all sheets fit one workbook."""
    fits = (F.col("rows") == 0) | (F.col("rows") <= F.col("capacity"))
    return (
        with_capacity(inputs)
        .groupBy("profile")
        .agg(
            F.bool_and(fits).alias("__fits"),
            F.sum(sheet_cells(F.col("columns"), F.col("rows"))).alias("cells"),
            F.max("budget").alias("__budget"),
        )
        .select("profile", "cells", (F.col("__fits") & (F.col("cells") <= F.col("__budget"))).alias("one_workbook"))
    )


def balanced_share_cost(columns: Column, rows: Column, workbooks: Column, max_rows: Column) -> Column:
    """Cells one source takes in the largest of ``workbooks`` even shares; here only ``max_rows`` caps a sheet."""
    share = idiv(rows + workbooks - 1, workbooks)
    sheets = idiv(share + max_rows - 1, max_rows.cast("bigint"))
    return F.when(rows > 0, columns.cast("bigint") * (share + sheets)).otherwise(F.lit(0).cast("bigint"))


def minimum_workbooks(inputs: DataFrame) -> DataFrame:
    """Return ``profile, workbooks``: the fewest even workbooks whose largest fits the budget, null when none do.

    The cost falls as workbooks are added, so the answer is found by halving an interval of candidates. Each step is
    arithmetic over the profile's few sources, held in one array.
    """
    sources = inputs.groupBy("profile").agg(
        F.collect_list(F.struct(F.col("columns").cast("bigint").alias("columns"), F.col("rows").cast("bigint").alias("rows"))).alias("sources"),
        F.max(F.col("budget").cast("bigint")).alias("budget"),
        F.max(F.col("max_rows").cast("bigint")).alias("max_rows"),
        F.greatest(F.max(F.col("rows").cast("bigint")), F.lit(1).cast("bigint")).alias("most"),
    )

    def cost(k: Column) -> Column:
        zero = F.lit(0).cast("bigint")
        return F.aggregate("sources", zero, lambda total, s: total + balanced_share_cost(s["columns"], s["rows"], k, F.col("max_rows")))

    def halve(interval: Column, _: Column) -> Column:
        low, high = interval["low"], interval["high"]
        middle = idiv(low + high, 2)
        fits = cost(middle) <= F.col("budget")
        return F.when(low >= high, interval).otherwise(
            F.struct(F.when(fits, low).otherwise(middle + 1).alias("low"), F.when(fits, middle).otherwise(high).alias("high"))
        )

    start = F.struct(F.lit(1).cast("bigint").alias("low"), F.col("most").alias("high"))
    found = F.aggregate(F.sequence(F.lit(1), F.lit(64)), start, halve)["low"]
    return sources.select("profile", F.when(cost(F.col("most")) <= F.col("budget"), found).alias("workbooks"))
