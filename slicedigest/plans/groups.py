"""From bucket counts to groups: the stretches of calendar that become one sheet, or several when too large."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.plans.capacity import minimum_sheets, with_capacity
from slicedigest.plans.fold import running_values

GROUP = "struct<first:int,last:int,precision:string,rows:bigint,sealed:boolean>"
SOURCE = ["profile", "alias"]
FACTS = ["source_pos", "stem", "columns", "budget", "descending"]


def base_totals(counts: DataFrame, carried: str | None = None) -> DataFrame:
    """Roll counts of ``profile, alias, base_period, key, rows`` up to the base period.

    Adds ``months``, the twelve month counts of a year, which an oversized year is cut by. Undated rows keep a null key.
    """
    base = F.expr("CASE WHEN base_period = 'year' THEN key - key % 10000 ELSE key END").alias("key")
    monthly = ", ".join(f"coalesce(sum(rows) FILTER (WHERE key div 100 % 100 = {m}), 0L)" for m in range(1, 13))
    extra = [F.first(carried).alias(carried)] if carried else []
    return counts.groupBy(*SOURCE, "base_period", base).agg(F.sum("rows").alias("rows"), F.expr(f"array({monthly})").alias("months"), *extra)


def grid_sums(months: str, grid: str) -> str:
    """Return SQL for a year's months summed over each cell of a grid, January first."""
    return f"transform(sequence(0, cast(12 div {grid} - 1 AS int)), c -> aggregate(slice({months}, c * {grid} + 1, {grid}), 0L, (a, x) -> a + x))"


def fitting_grid(months: str, grids: str, capacity: str) -> str:
    """Return SQL for the first grid in which every cell fits, else the last one."""
    fits = f"filter({grids}, g -> forall({grid_sums(months, 'g')}, n -> n <= {capacity}))"
    return f"coalesce(try_element_at({fits}, 1), element_at({grids}, -1))"


def year_cells(key: str, months: str, grid: str) -> str:
    """Return SQL for an oversized year's nonempty grid cells as sealed groups."""
    cell = (
        f"named_struct('first', cast({key} + (i * {grid} + 1) * 100 AS int), 'last', cast({key} + (i + 1) * {grid} * 100 AS int), "
        "'precision', 'month', 'rows', n, 'sealed', true)"
    )
    return f"filter(transform({grid_sums(months, grid)}, (n, i) -> {cell}), cell -> cell.rows > 0)"


def base_groups(totals: DataFrame, capacity: str, grids: str) -> DataFrame:
    """Explode base totals into groups; an oversized year becomes the cells of its grid."""
    precision = "CASE base_period WHEN 'year' THEN 'year' WHEN 'year-month' THEN 'month' ELSE 'day' END"
    whole = (
        f"named_struct('first', cast(key AS int), 'last', cast(key AS int), 'precision', CASE WHEN key IS NOT NULL THEN {precision} END, "
        "'rows', rows, 'sealed', key IS NULL)"
    )
    oversized = f"key IS NOT NULL AND base_period = 'year' AND rows > {capacity}"
    grid = F.expr(f"CASE WHEN {oversized} THEN {fitting_grid('months', grids, capacity)} END")
    groups = F.expr(f"CASE WHEN __grid IS NOT NULL THEN {year_cells('key', 'months', '__grid')} ELSE cast(array({whole}) AS array<{GROUP}>) END")
    kept = [c for c in totals.columns if c not in ("key", "rows", "months")]
    return totals.withColumn("__grid", grid).select(*kept, F.inline(groups))


def greedy_runs(groups: str, capacity: str) -> str:
    """Return SQL numbering the merged run of each group in an ordered array.

    A run takes whole groups while they fit; a sealed or oversized group closes it and stands alone. Nothing fills an
    earlier run. The fold is sequential over the calendar periods of one source, which the calendar itself bounds.
    """
    alone = f"(g.sealed OR g.rows > {capacity})"
    fresh = f"({alone} OR NOT acc.open OR acc.used + g.rows > {capacity})"
    return running_values(
        groups,
        "g",
        f"acc.run + cast({fresh} AS int)",
        "int",
        {"run": "0", "used": "0L", "open": "false"},
        {"run": f"acc.run + cast({fresh} AS int)", "used": f"CASE WHEN {fresh} THEN g.rows ELSE acc.used + g.rows END", "open": f"NOT {alone}"},
    )


def merge_groups(groups: DataFrame) -> DataFrame:
    """Merge the groups of greedy profiles and number every source's groups in output order, undated last.

    ``groups`` carries ``o`` with ``algorithm, descending, capacity``. A merged span runs from its smallest to its
    largest key whichever way the periods are ordered.
    """
    item = F.expr(
        "struct(first IS NULL AS undated, coalesce(CASE WHEN o.descending THEN -first ELSE first END, 0) AS ord, first, last, precision, rows, "
        "sealed OR o.algorithm <> 'calendar_greedy' AS sealed)"
    )
    listed = groups.groupBy(*SOURCE).agg(F.array_sort(F.collect_list(item)).alias("items"), F.first("o").alias("o"))
    runs = F.expr(greedy_runs("items", "o.capacity")).alias("run")
    numbered = listed.select(*SOURCE, "o", F.inline(F.arrays_zip(runs, F.col("items").alias("item"))))
    return numbered.groupBy(*SOURCE, F.col("run").alias("group_no")).agg(
        F.expr("CASE WHEN bool_or(item.undated) THEN 'undated' ELSE 'period' END").alias("kind"),
        F.min("item.first").alias("first"),
        F.max("item.last").alias("last"),
        F.max("item.precision").alias("precision"),
        F.sum("item.rows").alias("rows"),
        F.first("o").alias("o"),
    )


def calendar_groups(inputs: DataFrame, counts: DataFrame) -> DataFrame:
    """Plan every source of every calendar profile.

    ``inputs``: one row per (profile, alias) with the options; ``counts``: ``profile, alias, key, rows``.
    Returns groups with ``parts``: more than one marks an oversized group that is cut by rows.
    """
    usable = with_capacity(inputs).where((F.col("algorithm") != "balanced") & ((F.col("capacity") >= 1) | (F.col("rows") == 0)))
    option = F.struct("algorithm", "grids", "capacity", *FACTS).alias("o")
    options = usable.select(*SOURCE, "base_period", option)
    totals = base_totals(counts.select(*SOURCE, "key", "rows").join(options, SOURCE), carried="o")
    groups = base_groups(totals, "o.capacity", "o.grids")
    # A source without rows has no counts: one group of no rows stands for it, so that it keeps its header-only sheet.
    nothing = options.join(counts.select(*SOURCE).distinct(), SOURCE, "left_anti").select(
        *SOURCE, "base_period", "o", F.inline(F.expr(f"cast(array(struct(null, null, null, 0L, true)) AS array<{GROUP}>)"))
    )
    merged = merge_groups(groups.unionByName(nothing.select(groups.columns)))
    merged = merged.withColumn("kind", F.when((F.col("kind") == "undated") & (F.col("rows") == 0), "period").otherwise(F.col("kind")))
    parts = minimum_sheets(F.col("rows"), F.col("o.capacity"))
    kind = F.when((parts > 1) & (F.col("kind") == "period"), "overflow").otherwise(F.col("kind"))
    return merged.select(
        *SOURCE, "group_no", kind.alias("kind"), "first", "last", "precision", "rows", parts.alias("parts"), *[F.col(f"o.{c}") for c in FACTS]
    )


def single_groups(inputs: DataFrame) -> DataFrame:
    """One sheet per source, for profiles that fit one workbook."""
    return _unsplit(inputs, "single", F.lit(1).cast("bigint"))


def balanced_groups(inputs: DataFrame) -> DataFrame:
    """Even slices of each source's one sorted order, as few as its sheet capacity allows."""
    sized = with_capacity(inputs).where((F.col("capacity") >= 1) | (F.col("rows") == 0))
    return _unsplit(sized, "period", minimum_sheets(F.col("rows"), F.col("capacity")))


def _unsplit(inputs: DataFrame, kind: str, parts: Column) -> DataFrame:
    nothing = F.lit(None).cast("int")
    return inputs.select(
        *SOURCE,
        F.lit(1).alias("group_no"),
        F.lit(kind).alias("kind"),
        nothing.alias("first"),
        nothing.alias("last"),
        F.lit(None).cast("string").alias("precision"),
        F.col("rows").cast("bigint").alias("rows"),
        parts.cast("bigint").alias("parts"),
        *FACTS,
    )
