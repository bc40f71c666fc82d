"""Giving every row its sheet.

Groups that fit one sheet need no row position: a row's key decides, through a broadcast of the plan's keys. Only groups
cut by rows are ranked, and the piece a rank falls in is arithmetic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.calendar import day_of, month_of, year_of
from slicedigest.functions.columns import idiv
from slicedigest.operators.order import part_of, part_rows, part_start, with_positions
from slicedigest.runtime import broadcast_if_small


def group_keys(plan: DataFrame, grain: str) -> DataFrame:
    """Return ``key, group_no, group_rows, parts``: every key a calendar group covers. The calendar bounds its size."""
    groups = plan.where(F.col("part") == 0)
    year, month = F.lit("year"), F.lit("month")
    if grain == "month":
        number = lambda key, missing: year_of(key) * 12 + F.when(F.col("precision") == year, missing).otherwise(month_of(key)) - 1
        months = F.sequence(number(F.col("first"), 1), number(F.col("last"), 12))
        keys = F.transform(months, lambda m: (idiv(m, 12) * 10000 + (F.pmod(m, F.lit(12)) + 1) * 100).cast("int"))
    else:
        date = lambda key: F.make_date(year_of(key), month_of(key), day_of(key))
        keys = F.transform(
            F.sequence(date(F.col("first")), date(F.col("last"))),
            lambda d: (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int"),
        )
    undated = F.array(F.lit(None).cast("int"))
    return groups.select(F.explode(F.when(F.col("kind") == "undated", undated).otherwise(keys)).alias("key"), "group_no", "group_rows", "parts")


def workbook_part(position: Column, rows: Column, workbooks: Column, max_rows: Column) -> Column:
    """Return the sheet number a position falls in when rows are balanced across workbooks, then across sheets."""
    book = part_of(position, rows, workbooks)
    share = part_rows(book, rows, workbooks)
    sheets = lambda count: idiv(count + max_rows - 1, max_rows)
    inside = part_of(position - part_start(book, rows, workbooks), share, sheets(share))
    base, extra = idiv(rows, workbooks), F.pmod(rows, workbooks)
    before = F.least(book.cast("bigint"), extra) * sheets(base + 1) + F.greatest(book - extra, F.lit(0).cast("bigint")) * sheets(base)
    return (before + inside).cast("int")


def assign_groups(rows: DataFrame, plan: DataFrame, key: str, order: Sequence[Column], grain: str) -> DataFrame:
    """Add ``group_no`` and ``part`` to the rows of one calendar source.

    ``plan`` holds the source's sheets, materialised; ``key`` is the row key column; ``order`` ends in something unique.
    A row no group covers keeps a null group, so a hole in the plan shows instead of losing rows.
    """
    fitting, ranked = split_groups(rows, plan, key, order, grain, not plan.where(F.col("parts") > 1).isEmpty())
    return fitting if ranked is None else fitting.unionByName(ranked)


def split_groups(rows: DataFrame, plan: DataFrame, key: str, order: Sequence[Column], grain: str, cut: bool) -> tuple[DataFrame, DataFrame | None]:
    """Return what `assign_groups` does in two frames: rows of groups that are one sheet, and of those ``cut`` by rows."""
    keys = group_keys(plan, grain).withColumnRenamed("key", "__covered")
    found = rows.join(broadcast_if_small(keys), F.col(key).eqNullSafe(F.col("__covered")), "left").drop("__covered")
    kept = [*rows.columns, "group_no"]
    if not cut:
        return found.select(*kept, F.lit(0).alias("part")), None
    whole = F.coalesce(F.col("parts"), F.lit(1)) == 1
    ranked = with_positions(found.where(~whole), ["group_no"], order, "__position")
    part = part_of(F.col("__position"), F.col("group_rows"), F.col("parts").cast("bigint"))
    return found.where(whole).select(*kept, F.lit(0).alias("part")), ranked.select(*kept, part.alias("part"))


def assign_slices(rows: DataFrame, plan: DataFrame, order: Sequence[Column], max_rows: int, across_workbooks: bool = False) -> DataFrame:
    """Add ``group_no`` and ``part`` to the rows of a source that is one sheet or even slices of one sorted order."""
    facts = plan.agg(F.count("*").alias("n"), F.max("group_rows").alias("rows"), F.max("workbook_index").alias("books"), F.max("parts").alias("parts")).first()
    numbered = rows.withColumn("group_no", F.lit(1))
    if facts["n"] <= 1:
        return numbered.withColumn("part", F.lit(0))
    total = F.lit(facts["rows"]).cast("bigint")
    ranked = with_positions(numbered, ["group_no"], order, "__position")
    if across_workbooks:
        part = workbook_part(F.col("__position"), total, F.lit(facts["books"]).cast("bigint"), F.lit(max_rows).cast("bigint"))
    else:
        part = part_of(F.col("__position"), total, F.lit(facts["parts"]).cast("bigint"))
    return ranked.withColumn("part", part).drop("__position")


def with_sheet(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """Add the workbook and sheet each assigned row of one source goes to."""
    sheets = broadcast_if_small(plan.select("group_no", "part", "workbook", "sheet", "sheet_index"))
    return assigned.join(sheets, ["group_no", "part"], "left")


def partition_check(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """Return where the rows that reached a sheet differ from what it was planned to hold.

    Together with a null group this is the total-and-disjoint check: a row gets exactly one (group, part) by
    construction, so equal counts everywhere mean every row is in exactly one sheet.
    """
    got = assigned.groupBy("group_no", "part").agg(F.count("*").alias("found"))
    want = plan.select("group_no", "part", F.col("rows").alias("planned"))
    both = want.join(got, ["group_no", "part"], "full_outer")
    zero = F.lit(0).cast("bigint")
    counted = both.select("group_no", "part", F.coalesce("planned", zero).alias("planned"), F.coalesce("found", zero).alias("found"))
    return counted.where(F.col("planned") != F.col("found"))
