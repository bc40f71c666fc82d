"""What a run did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def workbook_totals(fragments: DataFrame) -> DataFrame:
    """Return sheets, rows and cells of every workbook."""
    return fragments.groupBy("profile", "workbook").agg(F.count("*").alias("sheets"), F.sum("rows").alias("rows"), F.sum("cells").alias("cells"))


def run_report(fragments: DataFrame, verdicts: DataFrame, sources: DataFrame, reasons: DataFrame) -> DataFrame:
    """Return one report per profile: totals, every source with its failures and why it was rebuilt, and the outcome.

    A source line lists how many of its sheets failed, so its size does not grow with them.
    """
    kinds = fragments.select("profile", "alias", "workbook", "sheet", "rows", "cells").join(
        verdicts.select("alias", "workbook", "sheet", "kind"), ["alias", "workbook", "sheet"], "left"
    )
    kind = F.coalesce("kind", F.lit("not-verified"))
    lines = (
        kinds.groupBy("profile", "alias")
        .agg(
            F.count("*").alias("sheets"),
            F.sum("rows").alias("rows_found"),
            F.sum("cells").alias("cells"),
            F.count_if(kind != "valid").alias("failed"),
        )
        .join(sources.select("alias", F.col("rows").alias("rows_expected")), "alias", "left")
    )
    books = fragments.groupBy("profile", "workbook").agg(F.lit(1).alias("one")).groupBy("profile").agg(F.count("*").alias("workbooks"))
    per_profile = lines.groupBy("profile").agg(
        F.sum("rows_found").alias("total_rows"),
        F.sum("cells").alias("total_cells"),
        F.sum("sheets").alias("sheets"),
        F.sum("failed").alias("failed"),
        F.bool_and(F.col("rows_found") == F.col("rows_expected")).alias("rows_match"),
        F.array_sort(F.collect_list(F.struct("alias", "sheets", "rows_found", "rows_expected", "failed"))).alias("sources"),
    )
    outcome = F.when((F.col("failed") == 0) & F.col("rows_match"), "published").otherwise("verification-failed")
    return (
        per_profile.join(books, "profile")
        .join(reasons.select("profile", "reasons"), "profile", "left")
        .withColumn("outcome", outcome)
    )


def latest_reports(reports: DataFrame) -> DataFrame:
    """Return each profile's most recent report."""
    return reports.groupBy("profile").agg(F.max_by(F.struct(*[c for c in reports.columns if c != "profile"]), "generated").alias("r")).select("profile", "r.*")
