"""Verification, selection, reconciliation and reports, over records made from the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import sql
from checks.cells import ORDERS
from checks.registry import query, table
from slicedigest.functions.digests import ALGORITHM, VERSION
from slicedigest.operators import report, select, verify
from slicedigest.operators.digest import blank_digests, digest_by
from slicedigest.runtime import materialise, use_checkpoint_dir

MONTH = "(year(o_orderdate) * 100 + month(o_orderdate))::VARCHAR"


def header():
    return F.array(*[F.lit(c) for c, _ in ORDERS])


def _sheets(df):
    return df.withColumns({"workbook": F.col("o_orderstatus"), "sheet": F.date_format("o_orderdate", "yyyyMM")})


def manifest_of(spark, sf):
    """A recorded export of orders: one workbook per status, one sheet per month."""
    orders = _sheets(table(spark, sf, "orders"))
    d = digest_by(orders, {"workbook": F.col("workbook"), "sheet": F.col("sheet")}, [c for c, _ in ORDERS], bounded=True)
    return d.withColumns({"alias": F.col("workbook"), "header": header()})


def read_back(spark, sf):
    """The same export as found later: prices changed, every March of one workbook gone, a year renamed, a year unreadable."""
    orders = table(spark, sf, "orders")
    hit = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 100 == 7)
    orders = orders.withColumn("o_totalprice", F.when(hit, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice")))
    orders = _sheets(orders).where(~((F.col("workbook") == "O") & F.col("sheet").endswith("03")))
    d = digest_by(orders, {"workbook": F.col("workbook"), "sheet": F.col("sheet")}, [c for c, _ in ORDERS], bounded=True)
    found = F.when((F.col("workbook") == "P") & F.col("sheet").startswith("1999"), F.array(F.lit("other"))).otherwise(header())
    return d.withColumns({"header": found, "unreadable": (F.col("workbook") == "P") & F.col("sheet").startswith("1998")})


KEYS = f"o_orderstatus AS workbook, {MONTH} AS sheet"
DAMAGED = "(SELECT * REPLACE (CASE WHEN o_orderstatus = 'F' AND o_orderkey % 100 = 7 THEN o_totalprice + 0.01 ELSE o_totalprice END AS o_totalprice) FROM orders)"
VERDICTS = f"""e AS ({sql.digest_select(ORDERS, KEYS, "workbook, sheet", "orders")}),
  a AS (SELECT * FROM ({sql.digest_select(ORDERS, KEYS, "workbook, sheet", DAMAGED)}) WHERE NOT (workbook = 'O' AND sheet LIKE '%03')),
  v AS (SELECT e.workbook AS alias, e.workbook, e.sheet, CASE WHEN a.sheet IS NULL THEN 'workbook-missing' WHEN e.workbook = 'P' AND e.sheet LIKE '1999%' THEN 'columns-differ'
      WHEN e.workbook = 'P' AND e.sheet LIKE '1998%' THEN 'workbook-unreadable' WHEN a.digest <> e.digest THEN 'digest-mismatch' ELSE 'valid' END AS kind,
      e.rows AS expected_rows, a.rows AS found_rows, e.digest AS expected_digest, a.digest AS found FROM e LEFT JOIN a ON e.workbook = a.workbook AND e.sheet = a.sheet)"""


@query(
    f"""WITH {VERDICTS} SELECT alias, workbook, sheet, kind, expected_rows, found_rows, expected_digest,
    CASE WHEN kind IN ('valid', 'digest-mismatch') THEN found END AS actual_digest FROM v"""
)
def verify_damaged_export(spark, sf):
    return verify.verify_fragments(manifest_of(spark, sf), read_back(spark, sf))


@query(f"WITH {VERDICTS} SELECT workbook, sheet, 'valid' AS kind FROM v")
def verify_clean_export(spark, sf):
    """The export written to files in another row order and read back."""
    folder = f"{use_checkpoint_dir(spark)}/clean-{uuid.uuid4().hex}"
    sheets = _sheets(table(spark, sf, "orders"))
    sheets.orderBy(F.desc("o_totalprice")).write.partitionBy("workbook").parquet(folder)
    back = spark.read.schema(sheets.schema).parquet(folder)
    d = digest_by(back, {"workbook": F.col("workbook"), "sheet": F.col("sheet")}, [c for c, _ in ORDERS], bounded=True)
    return verify.verify_fragments(manifest_of(spark, sf), d.withColumn("header", header())).select("workbook", "sheet", "kind")


@query(f"WITH {VERDICTS} SELECT workbook, sheet, CASE WHEN workbook = 'F' THEN 'unsupported-hasher' WHEN kind IN ('columns-differ', 'workbook-unreadable') THEN kind WHEN workbook = 'O' AND sheet LIKE '%03' THEN 'workbook-missing' ELSE 'valid' END AS kind FROM v")
def verify_old_hasher(spark, sf):
    manifest = manifest_of(spark, sf)
    old = manifest.withColumn("version", F.when(F.col("workbook") == "F", 0).otherwise(F.col("version")))
    return verify.verify_fragments(old, read_back(spark, sf)).select("workbook", "sheet", "kind")


@query(
    f"""WITH {VERDICTS} SELECT alias, count(*) AS sheets, count_if(kind <> 'valid') AS failed, sum(expected_rows)::BIGINT AS rows_found, sum(expected_rows)::BIGINT AS rows_expected,
    true AS rows_match, 'valid' AS reassembly, count_if(kind <> 'valid') = 0 AS valid FROM v GROUP BY alias"""
)
def verify_manifest_orders(spark, sf):
    manifest = materialise(manifest_of(spark, sf))
    orders = table(spark, sf, "orders")
    sources = digest_by(orders, {"alias": F.col("o_orderstatus")}, [c for c, _ in ORDERS])
    return verify.verify_manifest(manifest, sources, read_back(spark, sf))


@query(
    """SELECT o_orderstatus AS alias, count(*) - CASE WHEN o_orderstatus = 'O' THEN count_if(month(o_orderdate) = 3) ELSE 0 END AS rows_found, count(*) AS rows_expected,
    o_orderstatus <> 'O' AS rows_match, CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'O' THEN 'digest-mismatch' ELSE 'valid' END AS reassembly FROM orders GROUP BY o_orderstatus"""
)
def reassembly_finds_dropped_sheets(spark, sf):
    manifest = manifest_of(spark, sf).where(~((F.col("workbook") == "O") & F.col("sheet").endswith("03")))
    sources = digest_by(table(spark, sf, "orders"), {"alias": F.col("o_orderstatus")}, [c for c, _ in ORDERS])
    return verify.reassembly(manifest, sources.withColumn("total_and_disjoint", F.col("alias") != "P"))


@query(
    f"""WITH {VERDICTS}, f AS (SELECT *, row_number() OVER (PARTITION BY alias ORDER BY workbook, sheet) AS place, count(*) OVER (PARTITION BY alias) AS failed FROM v WHERE kind <> 'valid')
    SELECT alias, place, workbook, sheet, kind, failed FROM f WHERE place <= 3"""
)
def first_failures_orders(spark, sf):
    return verify.first_failures(materialise(verify.verify_fragments(manifest_of(spark, sf), read_back(spark, sf))))


CONV = [("conv_id", "integer"), ("turn", "integer"), ("role", "string")]


@query(
    f"""WITH t AS (SELECT CASE WHEN last THEN NULL ELSE conv_id END AS conv_id, CASE WHEN last THEN NULL ELSE turn END AS turn, CASE WHEN last THEN NULL ELSE role END AS role, workbook, sheet
      FROM (SELECT *, conv_id % 7 AS workbook, conv_id AS sheet, turn = max(turn) OVER (PARTITION BY conv_id) AS last FROM conversations))
    {sql.digest_select(CONV, "workbook::VARCHAR AS workbook, sheet::VARCHAR AS sheet", "workbook, sheet", "t")}"""
)
def restore_trailing_rows(spark, sf):
    talk = table(spark, sf, "conversations").select("conv_id", "turn", "role", (F.col("conv_id") % 7).cast("string").alias("workbook"), F.col("conv_id").cast("string").alias("sheet"))
    recorded = talk.groupBy("workbook", "sheet").agg(F.count("*").alias("rows"), F.max("turn").alias("__last"))
    # What a sheet shows when its last turn is an empty line: one row less.
    short = talk.join(recorded.select("sheet", "__last"), "sheet").where(F.col("turn") < F.col("__last"))
    padded = verify.pad_sheets(short.select("conv_id", "turn", "role", "workbook", "sheet"), recorded.select("workbook", "sheet", "rows"), ["conv_id", "turn", "role"])
    return digest_by(padded, {"workbook": F.col("workbook"), "sheet": F.col("sheet")}, ["conv_id", "turn", "role"]).select("workbook", "sheet", "rows", "digest", "row_digest")


def _blank_sql(width: int, workbook: str, keys: str, source: str) -> str:
    """Digests of 200 blank rows less one for every row: a blank row's lanes times their number."""
    lanes = [[f"{sql.seed(sql.TAGS['null'], side)}::UBIGINT"] * width for side in (0, 1)]
    of = lambda lane: f"sum({lane}::HUGEINT)::UHUGEINT * 199::UHUGEINT"
    blank = "".join(f", {sql.row(lane, side)} AS r{side}" for side, lane in enumerate(lanes))
    cells = [f"{width}::HUGEINT * {sql.seed(sql.TAGS['null'], side)}::HUGEINT" for side in (0, 1)]
    whole = [f"({of(f'(r{side}::HUGEINT + {cells[side]})')})" for side in (0, 1)]
    return f"""SELECT '{workbook}' AS workbook, sheet, count(*) * 199 AS rows, {sql.hex128(*whole)} AS digest, {sql.hex128(of('r0'), of('r1'))} AS row_digest
      FROM (SELECT {keys} AS sheet FROM {source}), (SELECT 1{blank}) GROUP BY sheet"""


@query(f"{_blank_sql(6, 'orders', 'o_orderpriority', 'orders')} UNION ALL {_blank_sql(11, 'lineitem', 'l_returnflag || l_linestatus', 'lineitem')}")
def blank_rows_restored(spark, sf):
    """Sheets that are short of 199 blank rows for each of theirs: millions of rows from one record per sheet."""
    sheets = [("orders", F.col("o_orderpriority")), ("lineitem", F.concat("l_returnflag", "l_linestatus"))]
    frames = [table(spark, sf, t).select(F.lit(t).alias("workbook"), k.alias("sheet")) for t, k in sheets]
    found = frames[0].unionByName(frames[1]).groupBy("workbook", "sheet").agg(F.count("*").alias("rows"))
    recorded = found.withColumn("rows", F.col("rows") * 200)
    width = F.when(F.col("workbook") == "orders", len(table(spark, sf, "orders").columns)).otherwise(len(table(spark, sf, "lineitem").columns))
    return blank_digests(verify.missing_rows(found, recorded), width).select("workbook", "sheet", "rows", "digest", "row_digest")


@query(
    """WITH r AS (SELECT conv_id, count(*) AS expected, count_if(role = 'user') + CASE WHEN conv_id % 5 = 0 THEN count(*) ELSE 0 END AS found FROM conversations GROUP BY 1)
    SELECT (conv_id % 7)::VARCHAR AS workbook, conv_id::VARCHAR AS sheet, expected, found::BIGINT AS found, greatest(expected - found, 0)::BIGINT AS missing, found > expected AS too_many FROM r"""
)
def row_extent_conversations(spark, sf):
    talk = table(spark, sf, "conversations")
    by = talk.groupBy("conv_id").agg(F.count("*").alias("rows"), F.count_if(F.col("role") == "user").alias("u"))
    keys = [(F.col("conv_id") % 7).cast("string").alias("workbook"), F.col("conv_id").cast("string").alias("sheet")]
    found = F.col("u") + F.when(F.col("conv_id") % 5 == 0, F.col("rows")).otherwise(0)
    return verify.missing_rows(by.select(*keys, found.alias("rows")), by.select(*keys, "rows"))


@query(
    f"""WITH e AS ({sql.digest_select(ORDERS, KEYS, "workbook, sheet", "orders")}), a AS ({sql.digest_select(ORDERS, KEYS, "workbook, sheet", DAMAGED)})
    SELECT e.workbook || e.sheet AS path, CASE WHEN e.sheet LIKE '1995%' THEN 'no-excel-digest' WHEN e.sheet LIKE '1996%' THEN 'unsupported-conversion' WHEN e.sheet LIKE '1997%' THEN 'unsupported-hasher'
      WHEN a.digest <> e.digest THEN 'digest-mismatch' ELSE 'valid' END AS kind FROM e JOIN a USING (workbook, sheet)"""
)
def validate_against_descriptions(spark, sf):
    path = F.concat("workbook", "sheet").alias("path")
    year = F.substring("sheet", 1, 4)
    description = manifest_of(spark, sf).select(
        path,
        "header",
        "rows",
        F.when(year != "1995", F.col("digest")).alias("digest"),
        "algorithm",
        F.when(year == "1997", 0).otherwise(F.col("version")).alias("version"),
        F.when(year == "1996", "3.0").otherwise("4.0").alias("conversion_version"),
    )
    orders = table(spark, sf, "orders")
    hit = (F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 100 == 7)
    changed = _sheets(orders.withColumn("o_totalprice", F.when(hit, F.col("o_totalprice") + 0.01).otherwise(F.col("o_totalprice"))))
    found = digest_by(changed, {"path": F.concat("workbook", "sheet")}, [c for c, _ in ORDERS], bounded=True).withColumn("header", header())
    return verify.validate_against_description(description, found)


@query(
    """SELECT 'workbook-not-listed' AS rule, p_brand AS subject FROM part GROUP BY p_brand HAVING bool_and(p_size < 51 AND p_brand LIKE '%7')
    UNION ALL SELECT 'sheet-claimed-twice', min(p_brand || '!' || p_type || p_size) FROM part GROUP BY lower(p_brand), lower(p_type || p_size) HAVING count(*) > 1
    UNION ALL SELECT 'alias-repeated', min(upper(p_type)) FROM part GROUP BY lower(p_type) HAVING count(*) > 1
    UNION ALL SELECT 'sidecar-not-listed', p_name FROM part WHERE p_name LIKE 'large%'"""
)
def manifest_rules(spark, sf):
    part = table(spark, sf, "part")
    manifest = part.select(F.col("p_brand").alias("workbook"), F.concat("p_type", "p_size").alias("sheet"), F.upper("p_type").alias("alias"))
    books = part.where(~F.col("p_brand").endswith("7")).select(F.col("p_brand").alias("name")).distinct()
    sources = part.select(F.upper("p_type").alias("alias"), F.col("p_name").alias("sidecar"))
    sidecars = part.where(~F.col("p_name").startswith("large")).select(F.upper("p_name").alias("name")).distinct()
    return verify.manifest_violations(manifest, books, sources, sidecars)


# Sources are customers; they are described when they were last ordered from, and their file changed then or a little later.
SOURCE_ROWS = """SELECT c_custkey AS k, 'c' || c_custkey AS alias, max(o_orderdate) AS d, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL"""
SIGNALS = f"""s AS ({SOURCE_ROWS}), sig AS (SELECT *, CASE WHEN n = 0 THEN ['sidecar-missing-or-unreadable'] ELSE list_filter([
    CASE WHEN k % 3 = 1 THEN 'source-changed' END, CASE WHEN k % 5 = 0 OR k % 7 = 0 THEN 'conversion-version' END, CASE WHEN k % 11 = 0 OR k % 7 = 0 THEN 'hasher-version' END], lambda x: x IS NOT NULL) END AS signals FROM s)"""


def _source_records(spark, sf):
    at = F.col("d").cast("timestamp")
    last = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderdate").alias("d"))
    k = F.col("c_custkey")
    customers = table(spark, sf, "customer").select("c_custkey").join(last, "c_custkey", "left")
    # A changed file is an hour older; the others differ below the second only.
    moved = F.when(k % 3 == 1, at - F.expr("INTERVAL 1 HOUR")).otherwise(at + F.expr("INTERVAL '0.25' SECOND"))
    sources = customers.select(F.concat(F.lit("c"), k).alias("alias"), F.concat(F.lit("c"), k).alias("path"), moved.alias("modified"))
    version = F.when(k % 5 == 0, "3.0").otherwise("4.0")
    record = F.struct(F.lit("to-excel").alias("id"), version.alias("version"), F.lit(ALGORITHM).alias("algorithm"), F.when(k % 11 == 0, 0).otherwise(VERSION).alias("hasher_version"))
    plain = F.struct(F.lit("none").alias("id"), F.lit("1.0").alias("version"), F.lit(ALGORITHM).alias("algorithm"), F.lit(VERSION).alias("hasher_version"))
    listed = F.when(k % 7 == 0, F.array(plain)).otherwise(F.array(plain, record))
    descriptions = customers.where(F.col("d").isNotNull()).select(F.concat(F.lit("c"), k).alias("path"), at.alias("modified"), at.alias("described"), listed.alias("conversions"))
    return sources, descriptions


@query(f"WITH {SIGNALS} SELECT alias, array_to_string(signals, ',') AS signals FROM sig")
def stale_sources_customers(spark, sf):
    found = select.stale_sources(*_source_records(spark, sf))
    return found.select("alias", F.array_join("signals", ",").alias("signals"))


# Profiles are nations over their customers. An export was made at the end of 2000; supplier records say what it was made with.
@query(
    f"""WITH {SIGNALS}, m AS (SELECT 'n' || c_nationkey AS profile, sig.* FROM sig JOIN customer ON c_custkey = k),
    p AS (SELECT 'n' || n_nationkey AS profile, n_nationkey AS n FROM nation),
    late AS (SELECT profile, max(d) AS d FROM m GROUP BY 1),
    own AS (SELECT p.*, list_filter([CASE WHEN n % 6 = 0 THEN 'forced' END, CASE WHEN n % 4 = 3 THEN 'no-receipt' END,
      CASE WHEN n % 4 <> 3 AND d > TIMESTAMP '2000-12-31' + n * INTERVAL 1 DAY * 10 THEN 'described-after-export' END, CASE WHEN n % 4 <> 3 AND n % 5 = 0 THEN 'config-modified' END,
      CASE WHEN n % 4 <> 3 AND n % 3 = 0 THEN 'resolved-config-hash' END, CASE WHEN n % 4 <> 3 AND n % 2 = 0 THEN 'planner-version' END], lambda x: x IS NOT NULL) AS own FROM p LEFT JOIN late USING (profile)),
    x AS (SELECT profile, unnest(signals) AS r, k FROM m), f AS (SELECT profile, r, min(k * 10 + list_position(['sidecar-missing-or-unreadable', 'source-changed', 'conversion-version', 'hasher-version'], r)) AS o FROM x GROUP BY 1, 2),
    t AS (SELECT profile, list(r ORDER BY o) AS theirs FROM f GROUP BY 1)
    SELECT profile, array_to_string(own, ',') AS signals, array_to_string(list_concat(own, coalesce(theirs, [])), ',') AS reasons, len(own) + len(coalesce(theirs, [])) > 0 AS stale
    FROM own LEFT JOIN t USING (profile)"""
)
def stale_profiles_nations(spark, sf):
    signals = select.stale_sources(*_source_records(spark, sf))
    members = table(spark, sf, "customer").select(
        F.concat(F.lit("n"), "c_nationkey").alias("profile"), F.col("c_custkey").cast("int").alias("source_pos"), F.concat(F.lit("c"), "c_custkey").alias("alias")
    )
    n = F.col("n_nationkey").cast("int")
    exported = F.timestamp_add("DAY", n * 10, F.lit("2000-12-31").cast("timestamp"))
    nation = table(spark, sf, "nation").withColumn("profile", F.concat(F.lit("n"), "n_nationkey"))
    receipts = nation.where(n % 4 != 3).select(
        "profile", exported.alias("exported"), F.when(n % 3 == 0, "old").otherwise("now").alias("config_hash"), F.when(n % 2 == 0, "0").otherwise("1").alias("planner_version")
    )
    later = F.when(n % 5 == 0, exported + F.expr("INTERVAL 1 SECOND")).otherwise(exported + F.expr("INTERVAL '0.5' SECOND"))
    current = nation.select("profile", later.alias("config_modified"), F.lit("now").alias("config_hash"), (n % 6 == 0).alias("forced"))
    out = select.stale_profiles(members, signals, receipts, current)
    return out.select("profile", F.array_join("signals", ",").alias("signals"), F.array_join("reasons", ",").alias("reasons"), "stale")


# A profile is a customer's nation; its folder lists every customer as a workbook, of which the manifest names the richer ones.
@query(
    """SELECT 'n' || c_nationkey AS profile, c_name || '.xlsx' AS name FROM customer WHERE c_acctbal < 0
    UNION ALL SELECT 'n' || s_nationkey, s_name || '.json' FROM supplier WHERE s_acctbal < 0"""
)
def delete_set_nations(spark, sf):
    customer = table(spark, sf, "customer").select(F.concat(F.lit("n"), "c_nationkey").alias("profile"), F.concat("c_name", F.lit(".xlsx")).alias("name"), F.col("c_acctbal").alias("b"))
    supplier = table(spark, sf, "supplier").select(F.concat(F.lit("n"), "s_nationkey").alias("profile"), F.concat("s_name", F.lit(".json")).alias("name"), F.col("s_acctbal").alias("b"))
    profiles = table(spark, sf, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("profile"))
    own = [F.concat("profile", F.lit(e)) for e in (".manifest.json", ".receipt.json", ".lock")]
    bookkeeping = profiles.select("profile", F.explode(F.array(*own, F.lit("reports"))).alias("name"))
    listing = customer.select("profile", "name").unionByName(supplier.select("profile", "name")).unionByName(bookkeeping)
    nested = F.concat("name", F.lit("/part"))
    keep = select.keep_set(profiles, customer.where(F.col("b") >= 0), supplier.where(F.col("b") >= 0).select("profile", nested.alias("name")))
    return select.delete_set(listing, keep)


@query(
    """WITH f AS (SELECT c_nationkey AS n, count_if(c_acctbal < -900) AS files FROM customer GROUP BY 1)
    SELECT 'n' || n_nationkey AS profile, CASE WHEN n_nationkey % 3 = 0 AND n_nationkey % 2 = 0 THEN 'foreign-receipt' WHEN n_nationkey % 3 <> 0 AND coalesce(files, 0) > 0 THEN 'files-without-receipt' END AS reason
    FROM nation LEFT JOIN f ON n = n_nationkey"""
)
def ownership_nations(spark, sf):
    nation = table(spark, sf, "nation").withColumn("profile", F.concat(F.lit("n"), "n_nationkey"))
    current = nation.select("profile", F.lit("id").alias("config_id"))
    even = F.col("n_nationkey") % 2 == 0
    receipts = nation.where(F.col("n_nationkey") % 3 == 0).select("profile", F.when(even, "other").otherwise("id").alias("config_id"), F.col("profile").alias("owner"))
    files = table(spark, sf, "customer").where(F.col("c_acctbal") < -900).select(F.concat(F.lit("n"), "c_nationkey").alias("profile"), F.col("c_name").alias("name"))
    kept = nation.select("profile", F.explode(F.array(F.lit("reports"), F.concat("profile", F.lit(".lock")))).alias("name"))
    return select.ownership(current, receipts, files.unionByName(kept))


@query("SELECT user_id AS profile, max(ts) AS generated, arg_max(event_type, ts) AS outcome FROM events GROUP BY 1")
def latest_reports_users(spark, sf):
    ev = table(spark, sf, "events").select(F.col("user_id").alias("profile"), F.col("ts").alias("generated"), F.col("event_type").alias("outcome"))
    return report.latest_reports(ev)


REPORT_FRAGMENTS = "SELECT 'p' || (l_suppkey % 5) AS profile, l_returnflag AS alias, l_linestatus || year(l_shipdate) AS workbook, month(l_shipdate)::VARCHAR AS sheet, count(*) AS rows, 11 * (count(*) + 1) AS cells FROM lineitem GROUP BY ALL"


def _report_fragments(spark, sf):
    li = table(spark, sf, "lineitem")
    keys = [
        F.concat(F.lit("p"), F.col("l_suppkey") % 5).alias("profile"),
        F.col("l_returnflag").alias("alias"),
        F.concat("l_linestatus", F.year("l_shipdate")).alias("workbook"),
        F.month("l_shipdate").cast("string").alias("sheet"),
    ]
    return li.groupBy(*keys).agg(F.count("*").alias("rows"), (11 * (F.count("*") + 1)).alias("cells"))


@query(f"SELECT profile, workbook, count(*) AS sheets, sum(rows)::BIGINT AS rows, sum(cells)::BIGINT AS cells FROM ({REPORT_FRAGMENTS}) GROUP BY 1, 2")
def workbook_totals_lineitem(spark, sf):
    return report.workbook_totals(_report_fragments(spark, sf))


@query(
    f"""WITH f AS (SELECT * FROM ({REPORT_FRAGMENTS.replace("'p' || (l_suppkey % 5) AS profile, l_returnflag AS alias", "l_linestatus AS profile, l_returnflag || l_linestatus AS alias")})),
    l AS (SELECT profile, alias, count(*) AS sheets, sum(rows) AS rows, sum(cells) AS cells, count_if(sheet = '2' AND profile = 'F') AS failed FROM f GROUP BY 1, 2)
    SELECT profile, sum(rows)::BIGINT AS total_rows, sum(cells)::BIGINT AS total_cells, sum(sheets)::BIGINT AS sheets, sum(failed)::BIGINT AS failed, true AS rows_match,
      (SELECT count(DISTINCT workbook) FROM f WHERE f.profile = l.profile) AS workbooks, count(*) AS sources, 'forced,source-changed' AS reasons,
      CASE WHEN sum(failed) = 0 THEN 'published' ELSE 'verification-failed' END AS outcome FROM l GROUP BY profile"""
)
def run_report_lineitem(spark, sf):
    li = table(spark, sf, "lineitem").withColumn("alias", F.concat("l_returnflag", "l_linestatus"))
    keys = [F.col("l_linestatus").alias("profile"), F.col("alias"), F.concat("l_linestatus", F.year("l_shipdate")).alias("workbook"), F.month("l_shipdate").cast("string").alias("sheet")]
    fragments = materialise(li.groupBy(*keys).agg(F.count("*").alias("rows"), (11 * (F.count("*") + 1)).alias("cells")))
    bad = (F.col("sheet") == "2") & (F.col("profile") == "F")
    verdicts = fragments.select("alias", "workbook", "sheet", F.when(bad, "digest-mismatch").otherwise("valid").alias("kind"))
    reasons = fragments.select("profile").distinct().withColumn("reasons", F.array(F.lit("forced"), F.lit("source-changed")))
    made = report.run_report(fragments, verdicts, li.groupBy("alias").agg(F.count("*").alias("rows")), reasons)
    return made.withColumns({"sources": F.size("sources").cast("bigint"), "reasons": F.array_join("reasons", ",")})


@query(
    """SELECT event_id, strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'America/Mexico_City', '%Y-%m-%d %H:%M:%S') AS mexico,
    strftime((ts AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/Madrid', '%Y-%m-%d %H:%M:%S') AS madrid FROM events"""
)
def instants_in_zones_events(spark, sf):
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    ev = table(spark, sf, "events").select("event_id", F.timestamp_micros(micros).alias("at"))
    zoned = select.instants_in_zones(F.col("at"), ["America/Mexico_City", "Europe/Madrid"])
    text = lambda z: F.date_format(F.col("z")[z], "yyyy-MM-dd HH:mm:ss")
    return ev.select("event_id", zoned.alias("z")).select("event_id", text("America/Mexico_City").alias("mexico"), text("Europe/Madrid").alias("madrid"))


@query("SELECT user_id, '{' || string_agg('\"' || event_type || '\":' || n, ',' ORDER BY event_type) || '}' AS counts FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) GROUP BY 1")
def canonical_json_users(spark, sf):
    counted = table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"))
    maps = counted.groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    return maps.select("user_id", select.canonical_map(F.col("m")).alias("counts"))


@query(
    """SELECT 'name-differs-by-case' AS rule, min(w) AS subject FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents) WHERE w <> '' GROUP BY lower(w) HAVING count(DISTINCT w) > 1"""
)
def case_collisions_words(spark, sf):
    words = table(spark, sf, "documents").select(F.explode(F.split("text", " ")).alias("w")).where(F.col("w") != "").distinct()
    return verify.repeated(words, [F.lower("w")], "name-differs-by-case", F.col("w"))
