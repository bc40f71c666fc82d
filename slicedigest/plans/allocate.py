"""Packing sheets into workbooks in order.

Sheets are packed as runs of equal ones: a group cut into parts has at most two sizes. How many equal sheets still fit,
and how many whole workbooks the rest fill, is division; so the sequential fold is over calendar groups, and the sheets
themselves, which grow with the data, are laid out in parallel afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slicedigest.functions.columns import idiv
from slicedigest.operators.order import part_rows, part_start
from slicedigest.plans.fold import running_values

ORDER = ["__class", "__first", "source_pos", "group_no"]


def with_order(groups: DataFrame) -> DataFrame:
    """Add the output order of a profile's groups: period, then source, then group; undated after all."""
    sign = F.when(F.col("descending"), -1).otherwise(1)
    return groups.withColumns(
        {
            "__class": F.when(F.col("kind") == "undated", 1).otherwise(0),
            "__first": F.coalesce(sign * F.col("first"), F.lit(0)),
        }
    )


def with_starts(groups: DataFrame) -> DataFrame:
    """Add ``group_start``, the rows of the same source that come before a group."""
    before = Window.partitionBy("profile", "alias").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    return groups.withColumn("group_start", F.coalesce(F.sum("rows").over(before), F.lit(0).cast("bigint")))


def next_fit(runs: str, budget: str) -> str:
    """Return SQL placing ordered runs of equal sheets: per run its first workbook, how many fit there, how many per further one."""
    fits = f"least(r.count, ({budget} - acc.used) div r.cost)"
    per = f"greatest({budget} div r.cost, 1L)"
    rest = f"(r.count - {fits})"
    opened = f"(({rest} + {per} - 1) div {per})"
    used = f"CASE WHEN {rest} = 0 THEN acc.used + r.count * r.cost ELSE ({rest} - ({opened} - 1) * {per}) * r.cost END"
    return running_values(
        runs,
        "r",
        f"named_struct('book', acc.book, 'fits', {fits}, 'per', {per})",
        "struct<book:int,fits:bigint,per:bigint>",
        {"book": "1", "used": "0L"},
        {"book": f"cast(acc.book + {opened} AS int)", "used": used},
    )


def pack(groups: DataFrame) -> DataFrame:
    """Lay groups out as sheets with ``workbook_index`` and ``sheet_index``.

    Wants ``source_pos, stem, columns, budget, descending`` beside the group columns.
    """
    ordered = with_starts(with_order(groups))
    cost = "cast(columns AS bigint)"
    sizes = (
        f"array(struct(0 AS run, 0L AS first_part, rows % parts AS count, {cost} * (rows div parts + 2) AS cost), "
        f"struct(1 AS run, rows % parts AS first_part, parts - rows % parts AS count, {cost} * (rows div parts + 1) AS cost))"
    )
    runs = ordered.select("*", F.inline(F.expr(sizes))).where(F.col("count") > 0)
    rest = [c for c in runs.columns if c not in (*ORDER, "run", "profile", "budget", "descending")]
    listed = runs.groupBy("profile").agg(
        F.array_sort(F.collect_list(F.struct(*ORDER, "run", *rest))).alias("runs"), F.max("budget").alias("budget")
    )
    spots = F.arrays_zip(F.col("runs").alias("run"), F.expr(next_fit("runs", "budget")).alias("spot"))
    placed = listed.select("profile", F.inline(spots)).select("profile", "run.*", "spot.*")
    sheets = placed.select("*", F.expr("explode(sequence(0L, count - 1)) AS __n"))
    book = "CASE WHEN __n < fits THEN book ELSE book + 1 + (__n - fits) div per END"
    sheets = sheets.select("*", F.expr("cast(first_part + __n AS int) AS part"), F.expr(f"cast({book} AS int) AS workbook_index"))
    place = Window.partitionBy("profile", "workbook_index").orderBy(*ORDER, "part")
    return sheets.select(
        "profile",
        "source_pos",
        "alias",
        "stem",
        "columns",
        "group_no",
        F.col("rows").alias("group_rows"),
        "part",
        F.col("parts").cast("int").alias("parts"),
        "kind",
        "first",
        "last",
        "precision",
        part_rows(F.col("part"), F.col("rows"), F.col("parts")).alias("rows"),
        (F.col("group_start") + part_start(F.col("part"), F.col("rows"), F.col("parts"))).alias("start"),
        "workbook_index",
        F.row_number().over(place).alias("sheet_index"),
    )


def balanced_workbook_sheets(inputs: DataFrame, workbooks: DataFrame) -> DataFrame:
    """Lay out profiles balanced across workbooks: even workbooks, and even sheets inside each.

    ``part`` runs through all sheets of a source. A source without rows has one header-only sheet in the first workbook.
    """
    sized = inputs.join(workbooks, "profile").where(F.col("workbooks").isNotNull())
    books = sized.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("workbooks") - 1)).alias("__book"))
    books = books.withColumns(
        {
            "__share": part_rows(F.col("__book"), F.col("rows"), F.col("workbooks")),
            "__share_start": part_start(F.col("__book"), F.col("rows"), F.col("workbooks")),
        }
    )
    empty_once = (F.col("rows") == 0) & (F.col("__book") == 0)
    sheets = idiv(F.col("__share") + F.col("max_rows") - 1, F.col("max_rows").cast("bigint"))
    books = books.withColumn("__sheets", F.when(empty_once, F.lit(1).cast("bigint")).otherwise(sheets)).where(F.col("__sheets") > 0)
    out = books.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("__sheets") - 1)).alias("__n"))
    rows, count, most = F.col("rows").cast("bigint"), F.col("workbooks"), F.col("max_rows").cast("bigint")
    whole, extra = idiv(rows, count), F.pmod(rows, count)
    of_share = lambda share: idiv(share + most - 1, most)
    before = F.least(F.col("__book"), extra) * of_share(whole + 1) + F.greatest(F.col("__book") - extra, F.lit(0).cast("bigint")) * of_share(whole)
    in_book = Window.partitionBy("profile", "__book").orderBy("source_pos", "__n")
    nothing = F.lit(None).cast("int")
    return out.select(
        "profile",
        "source_pos",
        "alias",
        "stem",
        "columns",
        F.lit(1).alias("group_no"),
        F.col("rows").alias("group_rows"),
        (before + F.col("__n")).cast("int").alias("part"),
        F.lit(1).alias("parts"),
        F.lit("period").alias("kind"),
        nothing.alias("first"),
        nothing.alias("last"),
        F.lit(None).cast("string").alias("precision"),
        part_rows(F.col("__n"), F.col("__share"), F.col("__sheets")).alias("rows"),
        (F.col("__share_start") + part_start(F.col("__n"), F.col("__share"), F.col("__sheets"))).alias("start"),
        (F.col("__book") + 1).cast("int").alias("workbook_index"),
        F.row_number().over(in_book).alias("sheet_index"),
    )
