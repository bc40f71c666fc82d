"""Workbook files, stored records, and guards and cells that few tables reach."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.plan_sql import plan_ctes
from checks.registry import query, table
from checks.rows import ORDER_DATES, ORDERS_COUNTS, _fragment_sql, _orders_profile
from slicedigest.operators.convert import impose_schema, to_cells
from slicedigest.operators.export import export
from slicedigest.operators.order import FILE
from slicedigest.operators.verify import verify_fragments
from slicedigest.plans.capacity import oversized_shape
from slicedigest.plans.naming import resolve_collisions
from slicedigest.runtime import use_checkpoint_dir
from slicedigest.sources import records
from slicedigest.sources.parquet import read_source, source_files
from slicedigest.sources.xlsx import read_back_sheets, read_workbooks, write_workbooks, written_headers


def _folder(spark):
    return f"{use_checkpoint_dir(spark)}/books-{uuid.uuid4().hex}"


def _written(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    made = export(_orders_profile(500, 5000), {"orders": source})
    folder = _folder(spark)
    write_workbooks(made, folder)
    arranged = made.arranged["orders"]
    return made, read_workbooks(spark, folder), arranged.frame.select(*arranged.columns).schema


@query(_fragment_sql(500, 5000, "workbook, sheet, 'valid' AS kind, d.rows AS found_rows, digest AS actual_digest"))
def workbooks_round_trip(spark, sf):
    made, cells, schema = _written(spark, sf)
    back = read_back_sheets(cells, schema, made.fragments)
    return verify_fragments(made.fragments, back, every_sheet_seen=True).select("workbook", "sheet", "kind", "found_rows", "actual_digest")


@query(_fragment_sql(500, 5000, "alias, workbook, sheet, kind, period_label, d.rows, digest, row_digest", whole=True))
def manifest_round_trip(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    made = export(_orders_profile(500, 5000), {"orders": source})
    folder = _folder(spark)
    records.write_records(made.fragments, folder)
    back, _ = records.read_records(spark, folder, records.MANIFEST)
    return back.select("alias", "workbook", "sheet", "kind", "period_label", "rows", "digest", "row_digest")


@query(f"""{plan_ctes(ORDERS_COUNTS, 500, 5000)} SELECT workbook, sheet, rows FROM plan ORDER BY workbook, sheet LIMIT 3""")
def three_sheets_read(spark, sf):
    """The rows of three sheets of many, read by the names of sheets and workbooks; other workbooks are not opened."""
    made = export(_orders_profile(500, 5000), {"orders": read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)})
    folder = _folder(spark)
    write_workbooks(made, folder)
    wanted = made.plan.select("workbook", "sheet").orderBy("workbook", "sheet").limit(3).collect()
    books, sheets = (sorted({r[c] for r in wanted}) for c in ("workbook", "sheet"))
    cells = read_workbooks(spark, folder, sheets, books).where(F.col("row") > 0)
    return cells.groupBy("workbook", "sheet").agg(F.count("*").alias("rows"))


STEMS = "region nation customer supplier part orders lineitem".split()


@query(" UNION ALL ".join(f"SELECT '{t}' AS stem, count(*) AS rows, true AS dated FROM {t}" for t in STEMS))
def source_files_listed(spark, sf):
    """Every file of the sources with its time, and the rows that a read of the source finds in it."""
    found = None
    for stem in STEMS:
        source = read_source(spark, f"{sf}/{stem}.parquet")
        rows = source.frame.groupBy(F.regexp_extract(FILE, "([^/]+)$", 1).alias("file")).agg(F.count("*").alias("rows"))
        found = rows if found is None else found.unionByName(rows)
    files = source_files(spark, sf).select("stem", F.regexp_extract("path", "([^/]+)$", 1).alias("file"), F.col("modified").isNotNull().alias("dated"))
    return files.join(found, "file").select("stem", "rows", "dated")


@query(
    f"""{plan_ctes(ORDERS_COUNTS, 500, 5000)}
    SELECT workbook, sheet, 'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS header FROM plan"""
)
def written_headers_orders(spark, sf):
    _, cells, _ = _written(spark, sf)
    return written_headers(cells).select("workbook", "sheet", F.array_join("header", ",").alias("header"))


@query(
    """SELECT p_partkey, CASE WHEN p_size * 400 > 16384 THEN 'too-many-columns' WHEN p_partkey * 997 > 1048575 THEN 'too-many-rows' END AS problem FROM part"""
)
def sheet_guards_part(spark, sf):
    return table(spark, sf, "part").select("p_partkey", oversized_shape(F.col("p_size") * 400, F.col("p_partkey") * 997).alias("problem"))


@query(
    """WITH s AS (SELECT p_size AS workbook_index, p_partkey AS sheet_index, rpad(p_brand || CASE WHEN p_partkey % 2 = 0 THEN ' x' ELSE ' X' END, 31, 'y') AS name FROM part),
    n AS (SELECT *, row_number() OVER (PARTITION BY workbook_index, lower(name) ORDER BY sheet_index) AS n FROM s)
    SELECT workbook_index, sheet_index, CASE WHEN n = 1 THEN name ELSE left(name, 31 - length('_' || n)) || '_' || n END AS sheet FROM n"""
)
def sheet_collisions_part(spark, sf):
    name = F.rpad(F.concat("p_brand", F.when(F.col("p_partkey") % 2 == 0, " x").otherwise(" X")), 31, "y")
    sheets = table(spark, sf, "part").select(
        F.lit("p").alias("profile"), F.col("p_size").alias("workbook_index"), F.col("p_partkey").alias("sheet_index"), name.alias("sheet")
    )
    return resolve_collisions(sheets, F.lit(True)).select("workbook_index", "sheet_index", "sheet")


@query(
    """SELECT event_id::DOUBLE AS event_id, (user_id * 1000 + 7) / 1000.0 AS short, (event_id * 1000003) / 1000000.0 AS middle, event_id * 7919 / 1e9 AS long,
    (event_id % 100000) + 0.25 AS gap, hour(ts) * 10000 + minute(ts) * 100 + second(ts) AS clock FROM events"""
)
def durations_and_times_events(spark, sf):
    spark.conf.set("spark.sql.timeType.enabled", "true")
    ev = table(spark, sf, "events")
    seconds = (F.col("event_id") % 100000).cast("decimal(18,6)") + F.lit("0.25").cast("decimal(18,6)")
    ticks = ev.select(
        "event_id",
        (F.col("user_id") * 1000 + 7).alias("short"),
        (F.col("event_id") * 1000003).alias("middle"),
        (F.col("event_id") * 7919).alias("long"),
        F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds).alias("gap"),
        F.date_format("ts", "HH:mm:ss").alias("clock"),
    )
    typed = T.StructType([*ticks.schema.fields[:-1], T.StructField("clock", T.TimeType(6))])
    cells = to_cells(impose_schema(ticks, typed), {"short": "duration[ms]", "middle": "duration[us]", "long": "duration[ns]"})
    c = F.col("clock")
    return cells.withColumn("clock", F.hour(c) * 10000 + F.minute(c) * 100 + F.second(c).cast("int"))
