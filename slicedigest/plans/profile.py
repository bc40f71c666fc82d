"""The whole plan of any number of profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.options import Naming, Profile
from slicedigest.plans.allocate import balanced_workbook_sheets, pack
from slicedigest.plans.capacity import minimum_workbooks, one_workbook, oversized_shape, sheet_cells, with_capacity
from slicedigest.plans.groups import balanced_groups, calendar_groups, single_groups
from slicedigest.plans.naming import name_plan

OPTIONS = (
    "profile string, source_pos int, alias string, max_rows bigint, budget bigint, algorithm string, "
    "balance_across string, base_period string, descending boolean, grids array<int>, oversized string, null_dates string"
)


def profile_options(spark: SparkSession, profiles: list[Profile]) -> DataFrame:
    """Return one row per (profile, source) with the options the plan needs."""
    rows = [
        (
            profile.name,
            position,
            sheet.source,
            profile.limits.rows,
            profile.limits.cells,
            profile.partitioning.algorithm,
            profile.partitioning.balance_across,
            profile.partitioning.base_period,
            profile.partitioning.calendar and profile.partitioning.period_order == "descending",
            list(profile.partitioning.year_split_months),
            profile.partitioning.oversized,
            profile.partitioning.null_dates,
        )
        for profile in profiles
        for position, sheet in enumerate(profile.sheets)
    ]
    return spark.createDataFrame(rows, OPTIONS)


def plan_inputs(options: DataFrame, shapes: DataFrame) -> DataFrame:
    """Join options to ``alias, stem, columns, rows``."""
    return options.join(shapes, "alias")


def plan_sheets(inputs: DataFrame, counts: DataFrame, across: set[str] | None = None) -> DataFrame:
    """Lay out every profile's sheets over counts of ``profile, alias, key, rows``; no names yet.

    A profile that fits one workbook takes one sheet per source whatever its algorithm. ``across`` may name the kinds of
    layout in use (``calendar``, ``worksheets``, ``workbooks``) so that the others are left out of the query.
    """
    across = across or {"calendar", "worksheets", "workbooks"}
    decided = inputs.join(one_workbook(inputs).select("profile", "one_workbook"), "profile")
    single, split = decided.where(F.col("one_workbook")), decided.where(~F.col("one_workbook"))
    groups = single_groups(single)
    if "calendar" in across:
        groups = groups.unionByName(calendar_groups(split, counts))
    if "worksheets" in across:
        worksheets = split.where((F.col("algorithm") == "balanced") & (F.col("balance_across") == "worksheets"))
        groups = groups.unionByName(balanced_groups(worksheets))
    sheets = pack(groups)
    if "workbooks" in across:
        workbooks = split.where((F.col("algorithm") == "balanced") & (F.col("balance_across") == "workbooks"))
        sheets = sheets.unionByName(balanced_workbook_sheets(workbooks, minimum_workbooks(workbooks)))
    return sheets.withColumn("cells", sheet_cells(F.col("columns"), F.col("rows")))


def plan_profiles(inputs: DataFrame, counts: DataFrame, naming: dict[str, Naming] | Naming, across: set[str] | None = None) -> DataFrame:
    """Return the named plan: one row per sheet, written by nothing yet."""
    return name_plan(plan_sheets(inputs, counts, across), naming)


REFUSALS = ("budget-below-one-row", "oversized-period", "null-dates", "no-workbook-count-fits")


def possible_refusals(profile: Profile) -> set[str]:
    """Return the refusals a profile's own options allow, so that the others need no query."""
    rule = profile.partitioning
    found = {"budget-below-one-row"}
    if rule.calendar and rule.oversized == "error":
        found.add("oversized-period")
    if rule.calendar and rule.null_dates == "error":
        found.add("null-dates")
    if not rule.calendar and rule.balance_across == "workbooks":
        found.add("no-workbook-count-fits")
    return found


def plan_refusals(inputs: DataFrame, counts: DataFrame, reasons: set[str] | None = None) -> DataFrame:
    """Return why a profile cannot be planned, as rows ``profile, alias, reason, key, rows``."""
    reasons = reasons or set(REFUSALS)
    sized = with_capacity(inputs)
    rows = F.col("rows").cast("bigint").alias("rows")
    nothing = F.lit(None).cast("int")
    found = sized.where((F.col("capacity") < 1) & (F.col("rows") > 0)).select(
        "profile", "alias", F.lit("budget-below-one-row").alias("reason"), nothing.alias("key"), rows
    )
    wide = oversized_shape(F.col("columns"), F.lit(0))
    found = found.unionByName(sized.select("profile", "alias", wide.alias("reason"), nothing.alias("key"), rows).where(F.col("reason").isNotNull()))
    if reasons == {"budget-below-one-row"}:
        return found
    decided = sized.join(one_workbook(inputs).select("profile", "one_workbook"), "profile")
    split = decided.where(~F.col("one_workbook") & (F.col("capacity") >= 1))
    if "oversized-period" in reasons:
        strict = split.where((F.col("algorithm") != "balanced") & (F.col("oversized") == "error"))
        groups = calendar_groups(strict, counts).where(F.col("parts") > 1)
        found = found.unionByName(groups.select("profile", "alias", F.lit("oversized-period").alias("reason"), F.col("first").alias("key"), "rows"))
    if "null-dates" in reasons:
        dated = inputs.where((F.col("algorithm") != "balanced") & (F.col("null_dates") == "error")).select("profile", "alias")
        nulls = counts.where(F.col("key").isNull()).join(dated, ["profile", "alias"])
        found = found.unionByName(nulls.select("profile", "alias", F.lit("null-dates").alias("reason"), nothing.alias("key"), "rows"))
    if "no-workbook-count-fits" in reasons:
        books = split.where((F.col("algorithm") == "balanced") & (F.col("balance_across") == "workbooks"))
        never = minimum_workbooks(books).where(F.col("workbooks").isNull())
        hopeless = books.join(never.select("profile"), "profile")
        found = found.unionByName(hopeless.select("profile", "alias", F.lit("no-workbook-count-fits").alias("reason"), nothing.alias("key"), rows))
    return found
