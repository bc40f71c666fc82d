"""Calendar, label and name checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query, table
from slicedigest.functions import calendar as cal
from slicedigest.functions import names
from slicedigest.functions.labels import period_label
from slicedigest.operators.select import fingerprint
from slicedigest.operators.bucket import bucket_counts, decode_errors, distinct_dates, first_refusal
from slicedigest.options import DateColumn
from slicedigest.plans.groups import base_totals, grid_sums

MONTH_KEY = "(year({0}) * 10000 + month({0}) * 100)::INT"
DAY_KEY = "(year({0}) * 10000 + month({0}) * 100 + day({0}))::INT"


@query(f"SELECT {MONTH_KEY.format('o_orderdate')} AS key, count(*) AS rows FROM orders GROUP BY 1")
def bucket_orders_month(spark, sf):
    return bucket_counts(table(spark, sf, "orders"), "o_orderdate", DateColumn.datetime(), "month")


@query(f"SELECT {DAY_KEY.format('ts::DATE')} AS key, count(*) AS rows FROM events GROUP BY 1")
def bucket_events_day(spark, sf):
    ev = table(spark, sf, "events").select(F.to_date("ts").alias("day"))
    return bucket_counts(ev, "day", DateColumn.date(), "day")


@query(
    f"""SELECT {DAY_KEY.format('z')} AS key, count(*) AS rows FROM
    (SELECT (ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Mexico_City' AS z FROM events) GROUP BY 1"""
)
def bucket_events_day_zone(spark, sf):
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    ev = table(spark, sf, "events").select(F.timestamp_micros(micros).alias("at"))
    return bucket_counts(ev, "at", DateColumn.datetime(zone="America/Mexico_City"), "day")


@query(f"SELECT CASE WHEN o_custkey % 10 = 0 THEN NULL ELSE {MONTH_KEY.format('o_orderdate')} END AS key, count(*) AS rows FROM orders GROUP BY 1")
def bucket_orders_undated(spark, sf):
    orders = table(spark, sf, "orders").withColumn("d", F.when(F.col("o_custkey") % 10 != 0, F.col("o_orderdate")))
    return bucket_counts(orders, "d", DateColumn.datetime(), "month")


def _int_dates(spark, sf):
    y, m, d = F.year("l_shipdate"), F.month("l_shipdate"), F.dayofmonth("l_shipdate")
    return table(spark, sf, "lineitem").select(
        (F.pmod(y, F.lit(100)) * 100 + m).alias("YYMM"),
        (y * 100 + m).alias("YYYYMM"),
        (F.pmod(y, F.lit(100)) * 10000 + m * 100 + d).alias("YYMMDD"),
        (y.cast("bigint") * 10000 + m * 100 + d).alias("YYYYMMDD"),
    )


@query(
    " UNION ALL ".join(
        f"SELECT '{fmt}' AS fmt, {(DAY_KEY if fmt.endswith('DD') else MONTH_KEY).format('l_shipdate')} AS key, count(*) AS rows FROM lineitem GROUP BY 2"
        for fmt in ("YYMM", "YYYYMM", "YYMMDD", "YYYYMMDD")
    )
)
def int_date_decode(spark, sf):
    ints = _int_dates(spark, sf)
    out = None
    for fmt in ("YYMM", "YYYYMM", "YYMMDD", "YYYYMMDD"):
        spec = DateColumn.integer(fmt, 1970 if len(fmt.rstrip("MD")) == 2 else None)
        one = bucket_counts(ints, fmt, spec, spec.precision).select(F.lit(fmt).alias("fmt"), "key", "rows")
        out = one if out is None else out.unionByName(one)
    return out


ODD_DATE = "CASE WHEN o_custkey % 13 = 0 THEN -o_orderkey WHEN o_custkey % 17 = 0 THEN NULL ELSE (year(o_orderdate) - CASE WHEN o_custkey % 19 = 0 THEN year(o_orderdate) ELSE 0 END) * 10000 + (1 + o_orderkey % 14) * 100 + (1 + o_custkey % 31) END"
ODD_REASON = """CASE WHEN v IS NULL THEN NULL WHEN v < 0 THEN 'negative' WHEN v // 10000 = 0 THEN 'year' WHEN v // 100 % 100 NOT BETWEEN 1 AND 12 THEN 'month'
  WHEN v % 100 > day(last_day(make_date(v // 10000, v // 100 % 100, 1))) THEN 'day' END"""


def _odd_dates(spark, sf):
    year = F.year("o_orderdate") - F.when(F.col("o_custkey") % 19 == 0, F.year("o_orderdate")).otherwise(0)
    built = year * 10000 + (1 + F.col("o_orderkey") % 14) * 100 + (1 + F.col("o_custkey") % 31)
    odd = F.when(F.col("o_custkey") % 13 == 0, -F.col("o_orderkey")).when(F.col("o_custkey") % 17 != 0, built)
    return table(spark, sf, "orders").select("o_orderkey", odd.cast("bigint").alias("booked"))


@query(
    f"""WITH o AS (SELECT o_orderkey, ({ODD_DATE})::BIGINT AS v FROM orders)
    SELECT 'booked' AS "column", o_orderkey AS ordinal, v::VARCHAR AS value, {ODD_REASON} AS reason FROM o WHERE {ODD_REASON} IS NOT NULL"""
)
def decode_errors_orders(spark, sf):
    return decode_errors(_odd_dates(spark, sf), "booked", DateColumn.integer("YYYYMMDD"), [F.col("o_orderkey")])


@query(
    f"""WITH o AS (SELECT o_orderkey, ({ODD_DATE})::BIGINT AS v FROM orders), r AS (SELECT *, CASE WHEN v IS NULL THEN 'null' ELSE {ODD_REASON} END AS reason FROM o)
    SELECT 'booked' AS "column", o_orderkey AS ordinal, v::VARCHAR AS value, reason FROM r WHERE reason IS NOT NULL ORDER BY o_orderkey LIMIT 1"""
)
def first_refusal_orders(spark, sf):
    return first_refusal(_odd_dates(spark, sf), "booked", DateColumn.integer("YYYYMMDD"), "error", F.col("o_orderkey"))


@query("SELECT o_orderdate AS value, min(o_orderkey) AS first_row FROM orders GROUP BY 1")
def first_seen_dates(spark, sf):
    return distinct_dates(table(spark, sf, "orders"), "o_orderdate", F.col("o_orderkey"))


@query(
    """SELECT l_partkey % 100 AS yy, count(*) AS rows, (1900 + (l_partkey % 100) + CASE WHEN l_partkey % 100 < 50 THEN 100 ELSE 0 END) AS from_1950,
    (1900 + (l_partkey % 100) + CASE WHEN l_partkey % 100 < 70 THEN 100 ELSE 0 END) AS from_1970, 2000 + l_partkey % 100 AS from_2000 FROM lineitem GROUP BY l_partkey % 100"""
)
def two_digit_years(spark, sf):
    yy = F.col("l_partkey") % 100
    counted = table(spark, sf, "lineitem").groupBy(yy.alias("yy")).agg(F.count("*").alias("rows"))
    return counted.withColumns({f"from_{start}": cal.two_digit_year(F.col("yy"), start) for start in (1950, 1970, 2000)})


@query(
    f"""SELECT o_orderkey, {DAY_KEY.format('o_orderdate')} AS key, year(o_orderdate) AS y, month(o_orderdate) AS m, day(o_orderdate) AS d,
    (year(o_orderdate) * 10000)::INT AS year_key, {MONTH_KEY.format('o_orderdate')} AS month_key,
    ((month(o_orderdate) - 1) // 6 * 6 + 1)::INT AS g6, ((month(o_orderdate) - 1) // 4 * 4 + 1)::INT AS g4,
    ((month(o_orderdate) - 1) // 3 * 3 + 1)::INT AS g3, ((month(o_orderdate) - 1) // 2 * 2 + 1)::INT AS g2 FROM orders"""
)
def calendar_keys(spark, sf):
    orders = table(spark, sf, "orders")
    key = cal.decode_key(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType, DateColumn.datetime(), "day")
    k = F.col("key")
    return orders.select("o_orderkey", key.alias("key")).select(
        "o_orderkey",
        "key",
        cal.year_of(k).alias("y"),
        cal.month_of(k).alias("m"),
        cal.day_of(k).alias("d"),
        cal.coarsen(k, "year").alias("year_key"),
        cal.coarsen(k, "month").alias("month_key"),
        *[cal.grid_start(cal.month_of(k), g).alias(f"g{g}") for g in (6, 4, 3, 2)],
    )


TOKEN = "strftime({0}, '{1}')"


def _label_sql(fmt):
    return f"""strftime(a, '%Y-{fmt}') || CASE WHEN date_trunc('month', a) = date_trunc('month', b) THEN ''
      WHEN year(a) = year(b) THEN '~' || strftime(b, '{fmt}') ELSE '~' || strftime(b, '%Y-{fmt}') END"""


@query(
    f"""WITH s AS (SELECT o_custkey, min(o_orderdate) AS a, max(o_orderdate) AS b FROM orders GROUP BY 1)
    SELECT o_custkey, CASE WHEN year(a) = year(b) THEN strftime(a, '%Y') ELSE strftime(a, '%Y') || '~' || strftime(b, '%Y') END AS years,
      {_label_sql('%m')} AS months, {_label_sql('%b')} AS short_months,
      CASE WHEN a::DATE = b::DATE THEN strftime(a, '%Y-%m-%d') ELSE strftime(a, '%Y-%m-%d') || '~' || strftime(b, '%Y-%m-%d') END AS days FROM s"""
)
def period_labels(spark, sf):
    orders = table(spark, sf, "orders")
    key = cal.decode_key(F.col("o_orderdate"), orders.schema["o_orderdate"].dataType, DateColumn.datetime(), "day")
    spans = orders.groupBy("o_custkey").agg(F.min(key).alias("a"), F.max(key).alias("b"))
    at = lambda precision, fmt="numeric": period_label(cal.coarsen(F.col("a"), precision), cal.coarsen(F.col("b"), precision), F.lit(precision), fmt)
    return spans.select(
        "o_custkey", at("year").alias("years"), at("month").alias("months"), at("month", "abbreviated").alias("short_months"), at("day").alias("days")
    )


@query(
    f"""WITH c AS (SELECT l_returnflag AS alias, CASE WHEN l_suppkey % 10 = 0 THEN NULL ELSE year(l_shipdate) * 10000 END::INT AS key, count(*) AS rows FROM lineitem GROUP BY 1, 2)
    SELECT * FROM c"""
)
def base_year_totals(spark, sf):
    return _flag_totals(spark, sf).select("alias", "key", "rows")


def _flag_totals(spark, sf):
    li = table(spark, sf, "lineitem")
    key = F.when(F.col("l_suppkey") % 10 != 0, cal.decode_key(F.col("l_shipdate"), li.schema["l_shipdate"].dataType, DateColumn.datetime(), "month"))
    counts = li.groupBy(F.lit("p").alias("profile"), F.col("l_returnflag").alias("alias"), F.lit("year").alias("base_period"), key.alias("key")).agg(F.count("*").alias("rows"))
    return base_totals(counts)


@query(
    """SELECT l_returnflag AS alias, (year(l_shipdate) * 10000)::INT AS key, g AS grid, ((month(l_shipdate) - 1) // g)::INT AS cell, count(*) AS rows
    FROM lineitem, (SELECT unnest([6, 4, 3, 2, 1]) AS g) WHERE l_suppkey % 10 <> 0 GROUP BY 1, 2, 3, 4"""
)
def year_grid_rows(spark, sf):
    totals = _flag_totals(spark, sf).where(F.col("key").isNotNull())
    grids = totals.select("alias", "key", "months", F.explode(F.array(*[F.lit(g) for g in (6, 4, 3, 2, 1)])).alias("grid"))
    cells = grids.select("alias", "key", "grid", F.posexplode(F.expr(grid_sums("months", "grid"))).alias("cell", "rows"))
    return cells.where(F.col("rows") > 0)


SHEET_PROBLEM = """CASE WHEN n IS NULL OR n = '' THEN 'empty' WHEN length(n) > 31 THEN 'too-long' WHEN regexp_matches(n, '[/\\\\?*:\\[\\]]') THEN 'forbidden-character'
  WHEN regexp_matches(n, '[\\x00-\\x1f\\x7f]') THEN 'control-character' WHEN n LIKE '''%' OR n LIKE '%''' THEN 'apostrophe' WHEN lower(n) = 'history' THEN 'reserved' END"""
BOOK_PROBLEM = """CASE WHEN n IS NULL OR n = '' THEN 'empty' WHEN n IN ('.', '..') THEN 'traversal' WHEN regexp_matches(n, '[<>:"/\\\\|?*]') THEN 'forbidden-character'
  WHEN regexp_matches(n, '[\\x00-\\x1f\\x7f]') THEN 'control-character' WHEN n LIKE '%.' OR n LIKE '% ' THEN 'trailing'
  WHEN regexp_matches(lower(split_part(n, '.', 1)), '^(con|prn|aux|nul|com[1-9]|lpt[1-9])$') THEN 'device-name' END"""


@query(
    f"""WITH w AS (SELECT doc_id, unnest(string_split(text, ' ')) AS n FROM documents)
    SELECT {SHEET_PROBLEM} AS sheet_problem, {BOOK_PROBLEM} AS book_problem, regexp_full_match(n, '[A-Za-z0-9][A-Za-z0-9_-]*') AS identifier,
    count(*) AS words, min(n) AS sample FROM w GROUP BY 1, 2, 3"""
)
def name_problems_words(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("n"))
    n = F.col("n")
    return (
        words.groupBy(names.worksheet_problem(n).alias("sheet_problem"), names.workbook_problem(n).alias("book_problem"), names.is_identifier(n).alias("identifier"))
        .agg(F.count("*").alias("words"), F.min("n").alias("sample"))
    )


@query(
    """SELECT page_id, CASE WHEN p = '' THEN 'empty' WHEN regexp_matches(p, '^[/\\\\]') THEN 'absolute' WHEN substr(p, 2, 1) = ':' THEN 'drive' WHEN contains(p, '://') THEN 'scheme'
      WHEN regexp_matches(p, '(^|[/\\\\])\\.\\.([/\\\\]|$)') THEN 'parent' END AS problem, CASE WHEN length(url || p) > 60 THEN 'path-too-long' END AS length_problem
    FROM (SELECT page_id, url, CASE page_id % 5 WHEN 0 THEN url WHEN 1 THEN replace(url, 'http', '/') WHEN 2 THEN replace(url, '://', '/../') WHEN 3 THEN 'c:' || url ELSE replace(url, '://', '/') END AS p FROM pages)"""
)
def path_problems_pages(spark, sf):
    url = F.col("url")
    p = (
        F.when(F.col("page_id") % 5 == 0, url)
        .when(F.col("page_id") % 5 == 1, F.replace(url, F.lit("http"), F.lit("/")))
        .when(F.col("page_id") % 5 == 2, F.replace(url, F.lit("://"), F.lit("/../")))
        .when(F.col("page_id") % 5 == 3, F.concat(F.lit("c:"), url))
        .otherwise(F.replace(url, F.lit("://"), F.lit("/")))
    )
    pages = table(spark, sf, "pages").select("page_id", "url", p.alias("p"))
    return pages.select(
        "page_id", names.relative_path_problem(F.col("p")).alias("problem"), names.path_problem(F.concat("url", "p"), 60).alias("length_problem")
    )


@query("SELECT p_partkey, 'acme ' || p_brand || ' ' || lpad(p_size::VARCHAR, 3, '0') || ' of ' || p_partkey AS name FROM part")
def template_names_part(spark, sf):
    tokens = {"source": F.col("p_brand"), "part_index": F.col("p_size"), "sheet_index": F.col("p_partkey")}
    text = names.render("{source} {part_index:03d} of {sheet_index}", tokens, {"part_index", "sheet_index"})
    return table(spark, sf, "part").select("p_partkey", names.prefixed("acme", text).alias("name"))


@query("""SELECT c_custkey, sha256('{"nation":"' || c_nationkey || '","segment":"' || c_mktsegment || '"}') AS fingerprint FROM customer""")
def row_fingerprints(spark, sf):
    options = F.create_map(F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return table(spark, sf, "customer").select("c_custkey", fingerprint(options).alias("fingerprint"))
