"""Ordinals, positions, row assignment, whole exports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import sql
from checks.cells import LINEITEM, ORDERS, as_cells
from checks.layout import inputs_of, key_of, order_counts, order_counts_sql
from checks.plan_sql import plan_ctes
from checks.registry import query, table
from slicedigest.operators.assign import assign_groups, assign_slices, partition_check, with_sheet
from slicedigest.operators.digest import combine, digest_by
from slicedigest.operators.export import arrange, export, make_plan
from slicedigest.operators.order import global_ordinal, read_with_ordinal, sort_column, with_positions
from slicedigest.options import DateColumn, Limits, Naming, Partitioning, Profile, Sheet, SortKey
from slicedigest.plans.profile import plan_profiles
from slicedigest.runtime import materialise, use_checkpoint_dir
from slicedigest.sources.parquet import read_parquet_sheets, read_source, write_parquet_sheets

ORDER_DATES = {"o_orderdate": DateColumn.datetime()}


@query("SELECT o_orderkey, row_number() OVER () - 1 AS ordinal FROM orders")
def source_ordinal(spark, sf):
    return global_ordinal(read_with_ordinal(table(spark, sf, "orders")), "ordinal").select("o_orderkey", "ordinal")


@query(
    """WITH l AS (SELECT *, row_number() OVER () - 1 AS ordinal FROM lineitem)
    SELECT ordinal, l_returnflag, row_number() OVER (PARTITION BY l_returnflag ORDER BY l_shipdate DESC, l_extendedprice, ordinal) - 1 AS position FROM l"""
)
def positions_in_hot_groups(spark, sf):
    li = read_with_ordinal(table(spark, sf, "lineitem")).select("l_returnflag", "l_shipdate", "l_extendedprice", F.col("__row").alias("ordinal"))
    order = [F.col("l_shipdate").desc(), F.col("l_extendedprice").asc(), F.col("ordinal").asc()]
    return with_positions(li, ["l_returnflag"], order, "position").select("ordinal", "l_returnflag", "position")


@query(
    """WITH e AS (SELECT event_id, CASE WHEN event_type = 'click' THEN NULL ELSE value > 50 END AS high, ts FROM events)
    SELECT event_id, row_number() OVER (ORDER BY high DESC NULLS FIRST, ts ASC NULLS LAST, event_id) - 1 AS position,
      CASE WHEN high THEN -1.0::DOUBLE WHEN NOT high THEN 0.0::DOUBLE END AS high_cell FROM e"""
)
def sort_by_source_values(spark, sf):
    ev = table(spark, sf, "events").select("event_id", F.when(F.col("event_type") != "click", F.col("value") > 50).alias("high"), "ts", F.lit(1).alias("g"))
    order = [sort_column(F.col("high"), SortKey("high", True, True)), sort_column(F.col("ts"), SortKey("ts")), F.col("event_id").asc()]
    placed = with_positions(ev, ["g"], order, "position")
    return placed.select("event_id", "position", F.when(F.col("high"), F.lit(-1.0)).when(~F.col("high"), F.lit(0.0)).alias("high_cell"))


STATUS_COUNTS = order_counts_sql(undated=True).replace("replace(o_orderpriority, ' ', '-')", "'all'")


def _plan(spark, sf, limit, budget, **options):
    counts = order_counts(spark, sf, undated=True).groupBy(F.lit("all").alias("profile"), "alias", "key").agg(F.sum("rows").alias("rows"))
    counts = materialise(counts)
    return materialise(plan_profiles(inputs_of(counts, limit, budget, **options), counts, Naming(), {"calendar"}))


ASSIGNED = """, r AS (SELECT o_orderkey, o_orderstatus AS alias, CASE WHEN o_custkey % 10 <> 0 THEN year(o_orderdate) * 10000 + month(o_orderdate) * 100 END AS key, o_totalprice
    FROM orders),
  p AS (SELECT alias, start, rows, workbook, sheet FROM plan),
  o AS (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY key IS NULL, {sign}key, o_totalprice DESC, o_orderkey) - 1 AS pos FROM r)
  SELECT o.o_orderkey, o.alias, p.workbook, p.sheet FROM o JOIN p ON o.alias = p.alias AND o.pos >= p.start AND o.pos < p.start + p.rows"""


def _assigned(spark, sf, plan, descending=False):
    orders = table(spark, sf, "orders")
    key = F.when(F.col("o_custkey") % 10 != 0, key_of(orders, "o_orderdate"))
    rows = orders.select("o_orderkey", F.col("o_orderstatus").alias("alias"), key.alias("__key"), "o_totalprice")
    first = F.col("__key").desc_nulls_last() if descending else F.col("__key").asc_nulls_last()
    order = [first, F.col("o_totalprice").desc(), F.col("o_orderkey").asc()]
    out = None
    for alias in ("F", "O", "P"):
        mine = plan.where(F.col("alias") == alias)
        placed = with_sheet(assign_groups(rows.where(F.col("alias") == alias), mine, "__key", order, "month"), mine)
        out = placed if out is None else out.unionByName(placed)
    return out


@query(plan_ctes(STATUS_COUNTS, 40, 700, base="year-month", algorithm="calendar_periods", whole=True) + ASSIGNED.format(sign=""))
def assign_overflow_rows(spark, sf):
    plan = _plan(spark, sf, 40, 700, base="year-month", algorithm="calendar_periods")
    return _assigned(spark, sf, plan).select("o_orderkey", "alias", "workbook", "sheet")


@query(plan_ctes(STATUS_COUNTS, 300, 6000, whole=True) + ASSIGNED.format(sign=""))
def assign_greedy_rows(spark, sf):
    return _assigned(spark, sf, _plan(spark, sf, 300, 6000)).select("o_orderkey", "alias", "workbook", "sheet")


@query("SELECT o_orderstatus AS alias, count(*) AS rows, count(*) AS in_sheets, 0::BIGINT AS wrong_sheets FROM orders GROUP BY 1")
def partition_is_total_and_disjoint(spark, sf):
    plan = _plan(spark, sf, 40, 700, base="year-month", algorithm="calendar_periods")
    placed = materialise(_assigned(spark, sf, plan))
    rows = placed.groupBy("alias").agg(F.count("*").alias("rows"), F.count("sheet").alias("in_sheets"))
    wrong = None
    for alias in ("F", "O", "P"):
        mine = plan.where(F.col("alias") == alias)
        one = partition_check(placed.where(F.col("alias") == alias), mine).agg(F.count("*").alias("wrong_sheets")).select(F.lit(alias).alias("alias"), "wrong_sheets")
        wrong = one if wrong is None else wrong.unionByName(one)
    return rows.join(wrong, "alias")


@query(
    """WITH o AS (SELECT *, ntile(9) OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS part FROM orders)
    SELECT part::INT AS part, count(*) AS rows, min(o_totalprice) AS low, max(o_totalprice) AS high FROM o GROUP BY 1"""
)
def balanced_slices(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    n = orders.count()
    rows = orders.sparkSession.range(9).select(
        F.col("id").cast("int").alias("part"), F.lit(n).cast("bigint").alias("group_rows"), F.lit(9).alias("parts"), F.lit(1).alias("workbook_index")
    )
    placed = assign_slices(orders, rows, [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()], 1_000_000)
    return placed.groupBy("part").agg(F.count("*").alias("rows"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))


def _orders_profile(limit=2000, budget=20000, **options):
    options = {"base_period": "year", **options}
    sheet = Sheet("orders", "o_orderdate", (SortKey("o_totalprice", descending=True),))
    return Profile("by_year", (sheet,), Limits(limit, budget), Partitioning(**options))


ORDERS_COUNTS = "SELECT 'by_year' AS profile, 'orders' AS alias, 0 AS pos, 6 AS cols, year(o_orderdate) * 10000 + month(o_orderdate) * 100 AS key, count(*) AS rows FROM orders GROUP BY ALL"


def _fragment_sql(limit, budget, columns="'orders' AS alias, workbook, sheet, kind, period_label, d.rows, digest, row_digest", **options):
    # A position's sheet is the last one that starts at or before it; sheets without rows start where the next one does.
    placed = """SELECT o.*, p.workbook, p.sheet FROM numbered o ASOF JOIN filled p ON o.pos >= p.start"""
    digests = sql.digest_select(as_cells(ORDERS), "workbook, sheet", "workbook, sheet", f"({placed})")
    return f"""{plan_ctes(ORDERS_COUNTS, limit, budget, **options)},
      numbered AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY year(o_orderdate), month(o_orderdate), o_totalprice DESC, ordinal) - 1 AS pos
        FROM (SELECT *, row_number() OVER () AS ordinal FROM orders)),
      filled AS MATERIALIZED (SELECT workbook, sheet, start FROM plan WHERE rows > 0), d AS MATERIALIZED ({digests})
      SELECT {columns} FROM plan JOIN d USING (workbook, sheet)"""


FRAGMENT = ["alias", "workbook", "sheet", "kind", "period_label", "rows", "digest", "row_digest"]


@query(_fragment_sql(500, 5000, whole=True))
def export_orders(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    return export(_orders_profile(500, 5000), {"orders": source}).fragments.select(*FRAGMENT)


@query(_fragment_sql(100, 1300, base="year-month"))
def export_orders_overflow(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    return export(_orders_profile(100, 1300, base_period="year-month"), {"orders": source}).fragments.select(*FRAGMENT)


EVENT_CELLS = [
    ("event_id::DOUBLE", "float"),
    ("date_trunc('second', ts)", "datetime"),
    ("user_id::DOUBLE", "float"),
    ("event_type", "string"),
    ("value", "float"),
    ("props", "string"),
]
FAN_IN = f"""SELECT 'all' AS profile, 'orders' AS alias, 0 AS pos, 6 AS cols, year(o_orderdate) * 10000 + month(o_orderdate) * 100 AS key, count(*) AS rows FROM orders GROUP BY ALL
  UNION ALL SELECT 'all', 'lineitem', 1, 11, year(l_shipdate) * 10000 + month(l_shipdate) * 100, count(*) FROM lineitem GROUP BY ALL
  UNION ALL SELECT 'all', 'events', 2, 6, year(ts) * 10000 + month(ts) * 100, count(*) FROM events GROUP BY ALL"""


def _fan_in(spark, sf):
    sources = {
        "orders": read_source(spark, f"{sf}/orders.parquet", ORDER_DATES),
        "lineitem": read_source(spark, f"{sf}/lineitem.parquet", {"l_shipdate": DateColumn.datetime()}),
        "events": read_source(spark, f"{sf}/events.parquet", {"ts": DateColumn.datetime()}),
    }
    profile = Profile("all", (Sheet("orders", "o_orderdate"), Sheet("lineitem", "l_shipdate"), Sheet("events", "ts")), Limits(5000, 60000), Partitioning())
    return profile, sources


@query(f"{plan_ctes(FAN_IN, 5000, 60000, whole=True)} SELECT alias, workbook, sheet, kind, rows, start, cols * (rows + 1) AS cells FROM plan")
def preview_fan_in(spark, sf):
    profile, sources = _fan_in(spark, sf)
    plan = make_plan(profile, {s.source: arrange(sources[s.source], s, profile) for s in profile.sheets}, sources)[2]
    return plan.select("alias", "workbook", "sheet", "kind", "rows", "start", "cells")


@query(
    f"SELECT 'orders' AS alias, * FROM ({sql.digest_select(as_cells(ORDERS), '', '', 'orders')}) UNION ALL "
    f"SELECT 'lineitem', * FROM ({sql.digest_select(as_cells(LINEITEM), '', '', 'lineitem')}) UNION ALL "
    f"SELECT 'events', * FROM ({sql.digest_select(EVENT_CELLS, '', '', 'events')})"
)
def fan_in_reassembles(spark, sf):
    profile, sources = _fan_in(spark, sf)
    return combine(export(profile, sources).fragments, ["alias"]).select("alias", "rows", "digest", "row_digest")


@query(_fragment_sql(500, 5000, "workbook, sheet, d.rows, digest, row_digest", whole=True))
def write_and_read_back(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    made = export(_orders_profile(500, 5000), {"orders": source})
    folder = f"{use_checkpoint_dir(spark)}/export-{uuid.uuid4().hex}"
    write_parquet_sheets(made, folder)
    arranged = made.arranged["orders"]
    schema = arranged.frame.select(*arranged.columns).schema
    back = read_parquet_sheets(spark, folder, "orders", schema)
    return digest_by(back, {"workbook": F.col("workbook"), "sheet": F.col("sheet")}, arranged.columns, bounded=True).select("workbook", "sheet", "rows", "digest", "row_digest")
