"""Conversion, description and digest checks."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks import sql
from checks.registry import query, table
from slicedigest.operators.convert import conversion_changes, dropped_cells, identity_conversion, impose_schema, to_cells
from slicedigest.operators.describe import describe_columns, describe_table
from slicedigest.operators.digest import combine, compare_columns, digest_by, digest_columns, digest_frame

ORDERS = [
    ("o_orderkey", "integer"),
    ("o_custkey", "integer"),
    ("o_orderstatus", "string"),
    ("o_totalprice", "float"),
    ("o_orderdate", "datetime"),
    ("o_orderpriority", "string"),
]
LINEITEM = [
    ("l_orderkey", "integer"),
    ("l_partkey", "integer"),
    ("l_suppkey", "integer"),
    ("l_linenumber", "integer"),
    ("l_quantity", "float"),
    ("l_extendedprice", "float"),
    ("l_discount", "float"),
    ("l_tax", "float"),
    ("l_returnflag", "string"),
    ("l_linestatus", "string"),
    ("l_shipdate", "datetime"),
]


def as_cells(columns):
    """The same columns after conversion: every number a float."""
    return [(f"({c})::DOUBLE" if k == "integer" else c, "float" if k == "integer" else k) for c, k in columns]


@query(
    """SELECT l_orderkey::DOUBLE AS l_orderkey, l_partkey::DOUBLE AS l_partkey, l_linenumber::DOUBLE AS l_linenumber,
    l_quantity, l_extendedprice, CASE WHEN l_discount IS NULL THEN NULL ELSE l_discount END AS l_discount, l_returnflag,
    date_trunc('second', l_shipdate) AS l_shipdate, CASE WHEN l_quantity > 25 THEN -1.0::DOUBLE ELSE 0.0::DOUBLE END AS bulky,
    (l_shipdate::DATE) AS day, round(l_tax * 100)::DOUBLE AS tax_points FROM lineitem"""
)
def convert_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_returnflag",
        "l_shipdate",
        (F.col("l_quantity") > 25).alias("bulky"),
        F.to_date("l_shipdate").alias("day"),
        F.round(F.col("l_tax") * 100).cast("decimal(10,0)").alias("tax_points"),
    )
    return to_cells(li)


@query(
    """SELECT event_id::DOUBLE AS event_id, date_trunc('second', ts) AS ts, date_trunc('second', ts - INTERVAL 20000 DAY) AS early,
    CASE WHEN event_type = 'click' THEN NULL ELSE value END AS value, props FROM events"""
)
def convert_events(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id",
        "ts",
        (F.col("ts") - F.expr("INTERVAL 20000 DAY")).alias("early"),
        F.when(F.col("event_type") == "click", F.lit(float("nan"))).otherwise(F.col("value")).alias("value"),
        "props",
    )
    return to_cells(ev)


@query(
    """SELECT (count(*) > 0) AS changed, true AS schema_changed,
    concat_ws(',', CASE WHEN bool_or(date_trunc('second', ts) <> ts) THEN 'ts' END, CASE WHEN bool_or(event_type = 'click') THEN 'value' END) AS moved
    FROM events"""
)
def convert_flags(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id", "ts", F.when(F.col("event_type") == "click", F.lit(float("inf"))).otherwise(F.col("value")).alias("value"), "event_type"
    )
    return conversion_changes(ev).select("changed", "schema_changed", F.array_join("moved", ",").alias("moved"))


@query("SELECT page_id::DOUBLE AS page_id, substr(lower(hex(encode(html))), 1, 32767) AS html FROM pages")
def hex_cut_pages(spark, sf):
    return to_cells(table(spark, sf, "pages").select("page_id", F.encode("html", "UTF-8").alias("html")))


@query(
    """SELECT doc_id::DOUBLE AS doc_id, nullif(substr(text, 1, 32767), '') AS text, CASE WHEN lang = 'de' THEN NULL ELSE lang END AS lang
    FROM documents"""
)
def text_cut_documents(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", F.when(F.col("lang") == "de", "").otherwise(F.col("lang")).alias("lang"))
    return to_cells(docs)


@query("SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier")
def convert_nothing(spark, sf):
    return identity_conversion(table(spark, sf, "supplier"))


PRICE_TEXT = "CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice::VARCHAR || ' EUR' ELSE o_totalprice::VARCHAR END"


def _texts(spark, sf):
    text = F.col("o_totalprice").cast("string")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 7 == 0, F.concat(text, F.lit(" EUR"))).otherwise(text).alias("price"),
        F.when(F.col("o_custkey") % 11 == 0, "x").alias("nothing"),
    )


WANTED = T.StructType([T.StructField("o_orderkey", T.LongType()), T.StructField("price", T.DoubleType()), T.StructField("nothing", T.NullType())])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price FROM orders")
def impose_schema_orders(spark, sf):
    return impose_schema(_texts(spark, sf), WANTED).drop("nothing")


@query(
    f"""WITH bad AS (
      SELECT 'price' AS "column", 'does-not-fit' AS reason, o_orderkey AS "row", {PRICE_TEXT} AS value FROM orders WHERE o_orderkey % 7 = 0
      UNION ALL SELECT 'nothing', 'content-in-empty-column', o_orderkey, 'x' FROM orders WHERE o_custkey % 11 = 0),
    placed AS (SELECT *, count(*) OVER (PARTITION BY "column", reason) AS dropped,
      row_number() OVER (PARTITION BY "column", reason ORDER BY "row") AS place FROM bad)
    SELECT "column", reason, dropped, (place - 1)::INT AS place, "row", value FROM placed WHERE place <= 5"""
)
def dropped_cells_orders(spark, sf):
    found = dropped_cells(_texts(spark, sf), WANTED, F.col("o_orderkey"))
    return found.select("column", "reason", "dropped", F.posexplode("first").alias("place", "cell")).select(
        "column", "reason", "dropped", "place", F.col("cell.row").alias("row"), F.col("cell.value").alias("value")
    )


def _column_union(cells, source, names=None):
    lanes = sql.lanes_select(cells, ", ".join(f"({e}) IS NULL AS n{i}" for i, (e, _) in enumerate(cells)), source)
    names = names or [e for e, _ in cells]
    parts = [
        f"""SELECT {i} AS position, '{name}' AS "column", count(*) AS value_count, count_if(n{i}) AS null_count,
        {sql.hex128(sql.lane_sum(f"h{i}"), sql.lane_sum(f"l{i}"))} AS digest FROM lanes"""
        for i, name in enumerate(names)
    ]
    return f"WITH lanes AS ({lanes}) " + " UNION ALL ".join(parts)


@query(_column_union(ORDERS, "orders"))
def column_digests_orders(spark, sf):
    return digest_columns(table(spark, sf, "orders")).select("position", "column", "value_count", "null_count", "digest")


EVENTS_NULLED = "(SELECT event_id, ts, CASE WHEN user_id % 10 = 0 THEN NULL ELSE value END AS value, event_type, value > 50 AS high FROM events)"


@query(
    f"""WITH f AS ({_column_union([("event_id", "integer"), ("ts", "datetime"), ("value", "float"), ("event_type", "string"), ("high", "boolean")], EVENTS_NULLED)})
    SELECT *, "column" IN ('event_id', 'value') AS is_numeric, "column" = 'value' AS is_float, "column" = 'event_id' AS is_integer,
      false AS is_decimal, "column" = 'event_type' AS is_text, "column" = 'high' AS is_boolean FROM f"""
)
def describe_events(spark, sf):
    ev = table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.when(F.col("user_id") % 10 == 0, None).otherwise(F.col("value")).alias("value"),
        "event_type",
        (F.col("value") > 50).alias("high"),
    )
    return describe_columns(ev).drop("type", "kind", "algorithm", "version", "scope")


SUPPLIER = [("s_suppkey", "integer"), ("s_name", "string"), ("s_nationkey", "integer"), ("s_acctbal", "float")]


@query(
    f"""SELECT s.rows, s.digest AS source_digest, c.digest AS converted_digest, c.row_digest AS converted_row_digest
    FROM ({sql.digest_select(SUPPLIER, "", "", "supplier")}) s, ({sql.digest_select(as_cells(SUPPLIER), "", "", "supplier")}) c"""
)
def describe_supplier_file(spark, sf):
    d = describe_table(f"{sf}/supplier.parquet", table(spark, sf, "supplier"))
    c = F.col("conversions")[0]
    return d.select(
        F.col("source.rows").alias("rows"),
        F.col("source.digest").alias("source_digest"),
        c["digest"].alias("converted_digest"),
        c["row_digest"].alias("converted_row_digest"),
    )


@query(sql.digest_select(as_cells(LINEITEM), "(year(l_shipdate) * 10000 + month(l_shipdate) * 100)::INT AS key", "key", "lineitem"))
def fragment_digests_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    cells = to_cells(li)
    key = (F.year("l_shipdate") * 10000 + F.month("l_shipdate") * 100).cast("int")
    return digest_by(cells, {"key": key}, cells.columns, bounded=True).drop("algorithm", "version", "scope")


@query(sql.digest_select(LINEITEM, "", "", "lineitem"))
def frame_digest_lineitem(spark, sf):
    return digest_frame(table(spark, sf, "lineitem")).select("rows", "digest", "row_digest")


DOCUMENTS = [("doc_id", "integer"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "integer")]


@query(sql.digest_select(DOCUMENTS, "source AS part", "part", "documents"))
def text_digests_documents(spark, sf):
    docs = table(spark, sf, "documents")
    return digest_by(docs, {"part": F.col("source")}, docs.columns).drop("algorithm", "version", "scope")


@query(f"SELECT (SELECT count(DISTINCT (o_orderstatus, o_orderpriority)) FROM orders) AS parts, * FROM ({sql.digest_select(ORDERS, '', '', 'orders')})")
def combine_equals_whole(spark, sf):
    orders = table(spark, sf, "orders")
    parts = digest_by(orders, {"s": F.col("o_orderstatus"), "p": F.col("o_orderpriority")}, orders.columns)
    return combine(parts, []).select("parts", "rows", "digest", "row_digest")


@query(
    f"""WITH parts AS ({sql.digest_select(ORDERS, "o_orderstatus AS s, o_orderpriority AS p", "s, p", "orders")})
    SELECT s, count(*) AS parts, CASE WHEN s = 'F' THEN 'mixed-identity' WHEN s = 'O' THEN 'partial-row-digest' END AS refusal FROM parts GROUP BY s"""
)
def combine_refuses(spark, sf):
    orders = table(spark, sf, "orders")
    parts = digest_by(orders, {"s": F.col("o_orderstatus"), "p": F.col("o_orderpriority")}, orders.columns)
    first = F.col("p").startswith("1")
    parts = parts.withColumn("version", F.when(first & (F.col("s") == "F"), 99).otherwise(F.col("version")))
    parts = parts.withColumn("row_digest", F.when(~(first & (F.col("s") == "O")), F.col("row_digest")))
    return combine(parts, ["s"]).select("s", "parts", "refusal")


@query(f"SELECT count(*) AS rows, '{'0' * 32}' AS digest, '{'0' * 32}' AS row_digest FROM orders WHERE o_totalprice < 0")
def empty_part_is_zero(spark, sf):
    orders = table(spark, sf, "orders")
    return digest_frame(orders.where(F.col("o_totalprice") < 0)).select("rows", "digest", "row_digest")


CUSTOMER = [("c_custkey", "integer"), ("c_name", "string"), ("c_nationkey", "integer"), ("c_acctbal", "float"), ("c_mktsegment", "string")]


@query(
    f"""WITH a AS ({_column_union(CUSTOMER, "customer")}), b AS ({_column_union(CUSTOMER, "(SELECT * REPLACE (CASE WHEN c_nationkey = 3 THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal) FROM customer)")})
    SELECT "column", a.digest AS left_digest, b.digest AS right_digest, CASE WHEN a.digest = b.digest THEN 'same' ELSE 'changed' END AS change
    FROM a JOIN b USING ("column") """
)
def digest_diff_customer(spark, sf):
    before = table(spark, sf, "customer")
    after = before.withColumn("c_acctbal", F.when(F.col("c_nationkey") == 3, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return compare_columns(digest_columns(before), digest_columns(after))


@query(
    f"""WITH f AS ({_column_union(as_cells(ORDERS), "orders", [c for c, _ in ORDERS])})
    SELECT "column", digest AS left_digest, digest AS right_digest, 'same' AS change FROM f"""
)
def convert_twice_orders(spark, sf):
    once = to_cells(table(spark, sf, "orders"))
    return compare_columns(digest_columns(once), digest_columns(to_cells(once)))
