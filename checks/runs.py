"""Descriptions that selection reads, whole runs, digests of one pass, and operators that only small tables reach."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import functions as F

from checks import sql
from checks.cells import LINEITEM, ORDERS, _column_union, as_cells
from checks.plan_sql import plan_ctes
from checks.registry import query, table
from checks.rows import FAN_IN, ORDER_DATES, ORDERS_COUNTS, _fan_in, _orders_profile
from slicedigest.operators.describe import describe_many, stored_schema
from slicedigest.operators.digest import digest_all
from slicedigest.operators.export import export
from slicedigest.operators.report import latest_reports
from slicedigest.operators.run import REPORT, Source, run
from slicedigest.operators.select import stale_sources
from slicedigest.operators.verify import verify_manifest
from slicedigest.options import DateColumn, Sheet
from slicedigest.runtime import materialise, use_checkpoint_dir
from slicedigest.sources import records
from slicedigest.sources.xlsx import read_back_sheets, read_workbooks, write_workbooks


def _folder(spark, name):
    return f"{use_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    f"""SELECT 'column' AS scope, position, "column", value_count, null_count, digest, NULL AS row_digest FROM ({_column_union(LINEITEM, 'lineitem')})
    UNION ALL SELECT 'dataframe', NULL, NULL, rows, NULL, digest, row_digest FROM ({sql.digest_select(LINEITEM, '', '', 'lineitem')})"""
)
def digest_all_lineitem(spark, sf):
    return digest_all(table(spark, sf, "lineitem")).select("scope", "position", "column", "value_count", "null_count", "digest", "row_digest")


DESCRIBED = {"orders": ORDERS, "lineitem": LINEITEM}


@query(
    " UNION ALL ".join(
        f"SELECT '{t}' AS stem, s.rows AS rows, s.digest AS digest, c.digest AS converted_digest, {len(cells)} AS columns, true AS schema_kept, false AS failed, "
        f"'' AS signals, 'conversion-version' AS signals_later FROM ({sql.digest_select(cells, '', '', t)}) s, ({sql.digest_select(as_cells(cells), '', '', t)}) c"
        for t, cells in DESCRIBED.items()
    )
    + " UNION ALL SELECT 'nowhere', NULL, NULL, NULL, NULL, NULL, true, 'sidecar-missing-or-unreadable', 'sidecar-missing-or-unreadable'"
)
def described_tables_selected(spark, sf):
    paths = [f"{sf}/{t}.parquet" for t in (*DESCRIBED, "nowhere")]
    folder = _folder(spark, "descriptions")
    records.write_records(describe_many(spark, paths, ["UTC", "Europe/Madrid"]), folder)
    read = materialise(records.read_records(spark, folder, records.DESCRIPTION)[0])
    sources = read.select(F.col("stem").alias("alias"), "path", F.coalesce("modified", "described").alias("modified"))
    usable = read.where("error IS NULL")
    older = F.transform("conversions", lambda c: c.withField("version", F.lit("3.0")))
    now = stale_sources(sources, usable).select("alias", F.array_join("signals", ",").alias("signals"))
    later = stale_sources(sources, usable.withColumn("conversions", older)).select("alias", F.array_join("signals", ",").alias("signals_later"))
    schemas = {r["path"]: stored_schema(r["s"]).names for r in usable.select("path", F.col("conversions")[0]["schema"].alias("s")).collect()}
    kept = F.lit(None).cast("boolean")
    for path, names in schemas.items():
        kept = F.when(F.col("path") == path, F.array(*[F.lit(n) for n in names]) == F.transform("columns", lambda c: c["column"])).otherwise(kept)
    out = read.select(
        "stem", F.col("source.rows").alias("rows"), F.col("source.digest").alias("digest"), F.col("conversions")[0]["digest"].alias("converted_digest"),
        F.size("columns").alias("columns"), kept.alias("schema_kept"), F.col("error").isNotNull().alias("failed"),
    )
    out = out.withColumn("columns", F.when(~F.col("failed"), F.col("columns")))
    return out.join(now, out["stem"] == now["alias"]).drop("alias").join(later, out["stem"] == later["alias"]).drop("alias")


@query(
    f"""{plan_ctes(ORDERS_COUNTS, 500, 5000)}, t AS (SELECT count(*) AS sheets, sum(rows)::BIGINT AS total_rows, sum(cols * (rows + 1))::BIGINT AS total_cells, count(DISTINCT workbook) AS workbooks FROM plan)
    SELECT 1 AS run, 'by_year' AS profile, 'no-receipt' AS reasons, total_rows, total_cells, sheets, 0::BIGINT AS failed, workbooks, 'published' AS outcome, 'by_year' AS published, 'by_year' AS receipt FROM t
    UNION ALL SELECT 2, 'by_year', '', NULL, NULL, NULL, NULL, NULL, NULL, '', 'by_year'
    UNION ALL SELECT 3, 'by_year', 'forced', total_rows, total_cells, sheets, 0, workbooks, 'published', 'by_year', 'by_year' FROM t"""
)
def runs_of_orders(spark, sf):
    folder, sources = _folder(spark, "runs"), {"orders": Source(f"{sf}/orders.parquet", ORDER_DATES)}
    out = None
    for n, forced in ((1, frozenset()), (2, frozenset()), (3, frozenset({"by_year"}))):
        done = run(spark, [_orders_profile(500, 5000)], sources, folder, forced)
        receipt = records.read_records(spark, f"{folder}/by_year.receipt", records.RECEIPT)[0]
        rows = (
            done.selection.select("profile", F.array_join("reasons", ",").alias("reasons"))
            .join(done.reports.select("profile", "total_rows", "total_cells", "sheets", "failed", "workbooks", "outcome"), "profile", "left")
            .join(receipt.select(F.col("owner").alias("profile"), F.col("profile").alias("receipt")), "profile", "left")
            .withColumns({"run": F.lit(n), "published": F.lit(",".join(done.published))})
        )
        rows = materialise(rows)
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    f"""{plan_ctes(ORDERS_COUNTS, 500, 5000, whole=True)}, t AS (SELECT count(*) AS sheets, sum(rows)::BIGINT AS total_rows, count(DISTINCT workbook) AS workbooks FROM plan),
    r (run, profile, reasons, outcome, error, exports) AS (VALUES
      (1, 'by_year', 'no-receipt', 'published', NULL, 1), (1, 'gone', 'no-receipt,sidecar-missing-or-unreadable', 'failed', 'not there', 0), (1, 'taken', 'no-receipt', 'failed', 'files-without-receipt', 1),
      (2, 'by_year', 'resolved-config-hash', 'published', NULL, 1), (2, 'gone', 'no-receipt,sidecar-missing-or-unreadable', 'failed', 'not there', 0), (2, 'taken', 'no-receipt', 'failed', 'files-without-receipt', 1),
      (3, 'by_year', 'forced', 'planned', NULL, 1), (3, 'gone', 'no-receipt,sidecar-missing-or-unreadable', 'failed', 'not there', 0), (3, 'taken', 'no-receipt', 'failed', 'files-without-receipt', 1),
      (4, 'by_year', 'forced', 'failed', 'foreign-receipt', 1), (4, 'gone', 'no-receipt,sidecar-missing-or-unreadable', 'failed', 'not there', 0), (4, 'taken', 'no-receipt', 'failed', 'files-without-receipt', 1))
    SELECT r.*, CASE WHEN outcome <> 'failed' THEN total_rows END AS total_rows, CASE WHEN outcome <> 'failed' THEN sheets END AS sheets,
      CASE WHEN outcome <> 'failed' THEN workbooks END AS workbooks FROM r, t"""
)
def runs_after_changes(spark, sf):
    """A first run, one with another zone registered, a dry one, and one of another configuration; reports are read back."""
    folder, zoned = _folder(spark, "changed-runs"), {"o_orderdate": DateColumn.datetime(wall_zone="Europe/Madrid")}
    profiles = [replace(_orders_profile(500, 5000), name="by_year"), replace(_orders_profile(500, 5000), name="taken")]
    profiles.append(replace(_orders_profile(500, 5000), name="gone", sheets=(Sheet("nowhere", "o_orderdate"),)))
    records.mark(spark, f"{folder}/taken/notes.txt")
    out = None
    for n, dates, more in ((1, ORDER_DATES, {}), (2, zoned, {}), (3, zoned, {"dry_run": True}), (4, zoned, {"config_id": "another"})):
        sources = {"orders": Source(f"{sf}/orders.parquet", dates), "nowhere": Source(f"{folder}/nowhere.parquet", dates)}
        done = run(spark, profiles, sources, folder, frozenset({"by_year"} if n > 2 else ()), **more)
        written = latest_reports(spark.read.schema(REPORT).json([f"{folder}/reports/{p.name}" for p in profiles]))
        left = [(p.name, len(records.names_in(spark, f"{folder}/{p.name}"))) for p in profiles]
        error = F.when(F.col("profile") == "gone", F.when(F.col("error").isNotNull(), "not there")).otherwise(F.col("error"))
        rows = (done.reports if n == 3 else written).select(
            F.lit(n).alias("run"), "profile", F.array_join("reasons", ",").alias("reasons"), "outcome", error.alias("error"), "total_rows", "sheets", "workbooks"
        )
        rows = materialise(rows.join(spark.createDataFrame(left, "profile string, exports int"), "profile"))
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    f"""{plan_ctes(FAN_IN, 5000, 60000)} SELECT alias, count(*) AS sheets, 0 AS failed, sum(rows)::BIGINT AS rows_found, sum(rows)::BIGINT AS rows_expected, true AS rows_match, 'valid' AS reassembly, true AS valid
    FROM plan GROUP BY alias"""
)
def fan_in_workbooks_verified(spark, sf):
    profile, sources = _fan_in(spark, sf)
    made = export(profile, sources)
    folder = _folder(spark, "fan-in")
    write_workbooks(made, folder)
    schemas = {alias: a.frame.select(*a.columns).schema for alias, a in made.arranged.items()}
    back = materialise(read_back_sheets(read_workbooks(spark, folder), schemas, made.fragments))
    return verify_manifest(made.fragments, made.sources, back, every_sheet_seen=True).select(
        "alias", "sheets", F.col("failed").cast("int").alias("failed"), "rows_found", "rows_expected", "rows_match", "reassembly", "valid"
    )
