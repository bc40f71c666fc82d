"""Capacity and plan checks. Every plan is made from counts over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.plan_sql import PLAN_COLUMNS, plan_select
from checks.registry import query, table
from slicedigest.functions.calendar import decode_key
from slicedigest.options import DateColumn, Naming
from slicedigest.plans import capacity as cap
from slicedigest.plans.groups import calendar_groups
from slicedigest.plans.profile import plan_profiles, plan_refusals, plan_sheets
from slicedigest.runtime import materialise

GRIDS = "array(6, 4, 3, 2, 1)"


def key_of(df, column, grain="month"):
    return decode_key(F.col(column), df.schema[column].dataType, DateColumn.datetime(), grain)


def order_counts(spark, sf, undated=False, grain="month"):
    """Profiles are order priorities, sources order statuses; a tenth of the customers may be undated."""
    orders = table(spark, sf, "orders")
    key = key_of(orders, "o_orderdate", grain)
    if undated:
        key = F.when(F.col("o_custkey") % 10 != 0, key)
    profile = F.replace(F.col("o_orderpriority"), F.lit(" "), F.lit("-"))
    counts = orders.groupBy(profile.alias("profile"), F.col("o_orderstatus").alias("alias"), key.alias("key")).agg(F.count("*").alias("rows"))
    return materialise(counts)


def order_counts_sql(undated=False, grain="month"):
    day = " + day(o_orderdate)" if grain == "day" else ""
    key = f"year(o_orderdate) * 10000 + month(o_orderdate) * 100{day}"
    if undated:
        key = f"CASE WHEN o_custkey % 10 <> 0 THEN {key} END"
    return f"""SELECT replace(o_orderpriority, ' ', '-') AS profile, o_orderstatus AS alias, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS pos,
      CASE o_orderstatus WHEN 'F' THEN 6 WHEN 'O' THEN 4 ELSE 9 END AS cols, {key} AS key, count(*) AS rows FROM orders GROUP BY ALL"""


def inputs_of(counts, limit, budget, algorithm="calendar_greedy", base="year", descending=False, oversized="balanced_rows", nulls="separate", across="worksheets"):
    """Plan inputs with the same options for every profile found in the counts."""
    alias = F.col("alias")
    return materialise(
        counts.groupBy("profile", "alias").agg(F.sum("rows").alias("rows")).select(
            "profile",
            F.when(alias == "F", 0).when(alias == "O", 1).otherwise(2).alias("source_pos"),
            "alias",
            alias.alias("stem"),
            F.when(alias == "F", 6).when(alias == "O", 4).otherwise(9).alias("columns"),
            "rows",
            F.lit(limit).cast("bigint").alias("max_rows"),
            F.lit(budget).cast("bigint").alias("budget"),
            F.lit(algorithm).alias("algorithm"),
            F.lit(across).alias("balance_across"),
            F.lit(base).alias("base_period"),
            F.lit(descending).alias("descending"),
            F.expr(GRIDS).alias("grids"),
            F.lit(oversized).alias("oversized"),
            F.lit(nulls).alias("null_dates"),
        )
    )


def planned(spark, sf, limit, budget, undated=False, grain="month", **options):
    counts = order_counts(spark, sf, undated, grain)
    plan = plan_profiles(inputs_of(counts, limit, budget, **options), counts, Naming(), {"calendar"})
    return plan.select(*PLAN_COLUMNS)


@query(plan_select(order_counts_sql(), 60, 1200, whole=True))
def plan_greedy_years(spark, sf):
    return planned(spark, sf, 60, 1200)


@query(plan_select(order_counts_sql(undated=True), 100, 1500, base="year-month", descending=True, whole=True))
def plan_greedy_months_descending(spark, sf):
    return planned(spark, sf, 100, 1500, undated=True, base="year-month", descending=True)


@query(plan_select(order_counts_sql(), 150, 1600, algorithm="calendar_periods", whole=True))
def plan_year_periods(spark, sf):
    return planned(spark, sf, 150, 1600, algorithm="calendar_periods")


@query(plan_select(order_counts_sql(undated=True), 12, 200, base="year-month", algorithm="calendar_periods", whole=True))
def plan_overflow_months(spark, sf):
    return planned(spark, sf, 12, 200, undated=True, base="year-month", algorithm="calendar_periods")


@query(plan_select(order_counts_sql(grain="day"), 40, 700, base="year-month-day", whole=True))
def plan_greedy_days(spark, sf):
    return planned(spark, sf, 40, 700, grain="day", base="year-month-day")


@query(plan_select(order_counts_sql(), 1048575, 10000000))
def plan_one_workbook(spark, sf):
    return planned(spark, sf, 1048575, 10000000)


def nation_shapes(spark, sf, limit, budget):
    """Profiles are regions, sources their nations, rows their customers."""
    nation = F.broadcast(table(spark, sf, "nation").select("n_nationkey", "n_regionkey"))  # twenty-five rows
    counted = table(spark, sf, "customer").groupBy("c_nationkey").agg(F.count("*").alias("rows"))
    shapes = counted.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return shapes.select(
        F.concat(F.lit("region"), "n_regionkey").alias("profile"),
        F.col("c_nationkey").cast("int").alias("source_pos"),
        F.concat(F.lit("n"), "c_nationkey").alias("alias"),
        F.concat(F.lit("n"), "c_nationkey").alias("stem"),
        (5 + F.col("c_nationkey") % 7).cast("int").alias("columns"),
        "rows",
        F.lit(limit).cast("bigint").alias("max_rows"),
        F.lit(budget).cast("bigint").alias("budget"),
        F.lit(False).alias("descending"),
    )


NATIONS = """SELECT 'region' || n_regionkey AS profile, c_nationkey AS pos, 'n' || c_nationkey AS alias, (5 + c_nationkey % 7)::INT AS cols, count(*) AS n
  FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL"""


@query(
    f"""SELECT profile, alias, n AS rows, least(40, 300 // cols - 1)::BIGINT AS capacity, greatest(1, ceil(n / least(40, 300 // cols - 1)))::BIGINT AS sheets,
    (cols * (n + 1))::BIGINT AS cells FROM ({NATIONS})"""
)
def capacity_nations(spark, sf):
    shapes = cap.with_capacity(nation_shapes(spark, sf, 40, 300))
    return shapes.select(
        "profile",
        "alias",
        "rows",
        "capacity",
        cap.minimum_sheets(F.col("rows"), F.col("capacity")).alias("sheets"),
        cap.sheet_cells(F.col("columns"), F.col("rows")).alias("cells"),
    )


@query(
    """WITH p AS (SELECT c_nationkey, ntile(7) OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS part FROM customer)
    SELECT c_nationkey AS nation, (part - 1)::INT AS part, count(*) AS rows FROM p GROUP BY 1, 2"""
)
def even_split_nations(spark, sf):
    counted = table(spark, sf, "customer").groupBy(F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("n"))
    sizes = counted.select("nation", F.posexplode(cap.balanced_sizes(F.col("n"), F.lit(7).cast("bigint"))).alias("part", "rows"))
    return sizes.where(F.col("rows") > 0)


@query(
    f"""SELECT profile, sum(cols * (n + 1))::BIGINT AS cells, bool_and(n <= least(70, 3000 // cols - 1)) AND sum(cols * (n + 1)) <= 3000 AS one_workbook
    FROM ({NATIONS}) GROUP BY profile"""
)
def one_workbook_regions(spark, sf):
    return cap.one_workbook(nation_shapes(spark, sf, 70, 3000))


@query(
    f"""WITH s AS ({NATIONS}), k AS (SELECT unnest(range(1, (SELECT max(n) + 1 FROM s))) AS k),
    cost AS (SELECT profile, k, sum(cols * (ceil(n / k) + ceil(ceil(n / k) / 25))) AS cost FROM s, k GROUP BY ALL)
    SELECT profile, min(k) FILTER (WHERE cost <= 500)::BIGINT AS workbooks FROM cost GROUP BY profile"""
)
def balanced_workbook_counts(spark, sf):
    return cap.minimum_workbooks(nation_shapes(spark, sf, 25, 500))


BALANCED_SHEETS = f"""WITH RECURSIVE s0 AS (SELECT *, greatest(1, ceil(n / least(9, 200 // cols - 1)))::BIGINT AS parts FROM ({NATIONS})),
  s AS (SELECT *, unnest(range(parts)) AS part FROM s0),
  q AS (SELECT *, n // parts + CASE WHEN part < n % parts THEN 1 ELSE 0 END AS rows, row_number() OVER (PARTITION BY profile ORDER BY pos, part) AS i FROM s),
  pack AS (SELECT profile, i, 1 AS book, cols * (rows + 1) AS used FROM q WHERE i = 1
    UNION ALL SELECT q.profile, q.i, CASE WHEN used + cols * (rows + 1) > 200 THEN book + 1 ELSE book END, CASE WHEN used + cols * (rows + 1) > 200 THEN cols * (rows + 1) ELSE used + cols * (rows + 1) END
    FROM pack p JOIN q ON q.profile = p.profile AND q.i = p.i + 1)"""


@query(
    f"""{BALANCED_SHEETS} SELECT profile, alias, part::INT AS part, rows, book AS workbook_index, row_number() OVER (PARTITION BY profile, book ORDER BY i) AS sheet_index,
    (sum(rows) OVER (PARTITION BY profile, alias ORDER BY i) - rows)::BIGINT AS start FROM q JOIN pack USING (profile, i)"""
)
def plan_balanced_sheets(spark, sf):
    return _balanced(spark, sf, 9, 200, "worksheets").select("profile", "alias", "part", "rows", "workbook_index", "sheet_index", "start")


def _balanced(spark, sf, limit, budget, across):
    inputs = nation_shapes(spark, sf, limit, budget).withColumns(
        {"algorithm": F.lit("balanced"), "balance_across": F.lit(across), "base_period": F.lit("year"), "grids": F.expr(GRIDS)}
    )
    return plan_sheets(materialise(inputs), None, {across})


@query(
    f"""WITH s AS ({NATIONS}), k AS (SELECT unnest(range(1, (SELECT max(n) + 1 FROM s))) AS k),
    cost AS (SELECT profile, k, sum(cols * (ceil(n / k) + ceil(ceil(n / k) / 5))) AS cost FROM s, k GROUP BY ALL),
    pick AS (SELECT profile, min(k) AS k FROM cost WHERE cost <= 700 GROUP BY profile),
    b AS (SELECT *, unnest(range(k)) AS book FROM s JOIN pick USING (profile)),
    share AS (SELECT *, n // k + CASE WHEN book < n % k THEN 1 ELSE 0 END AS share FROM b),
    sh AS (SELECT *, ceil(share / 5)::BIGINT AS m, unnest(range(ceil(share / 5)::BIGINT)) AS j FROM share WHERE share > 0),
    r AS (SELECT *, share // m + CASE WHEN j < share % m THEN 1 ELSE 0 END AS rows FROM sh)
    SELECT profile, alias, (row_number() OVER (PARTITION BY profile, alias ORDER BY book, j) - 1)::INT AS part, rows, (book + 1)::INT AS workbook_index,
      row_number() OVER (PARTITION BY profile, book ORDER BY pos, j) AS sheet_index, (sum(rows) OVER (PARTITION BY profile, alias ORDER BY book, j) - rows)::BIGINT AS start FROM r"""
)
def plan_balanced_workbooks(spark, sf):
    return _balanced(spark, sf, 5, 700, "workbooks").select("profile", "alias", "part", "rows", "workbook_index", "sheet_index", "start")


@query(
    f"""WITH c AS ({order_counts_sql(undated=True)}), m AS (SELECT profile, alias, key, rows FROM c)
    SELECT profile, alias, CASE WHEN key IS NULL THEN 'undated' ELSE 'overflow' END AS kind, key::INT AS key, rows FROM m WHERE rows > CASE alias WHEN 'F' THEN 13 WHEN 'O' THEN 13 ELSE 10 END"""
)
def oversized_groups(spark, sf):
    counts = order_counts(spark, sf, undated=True)
    inputs = inputs_of(counts, 13, 100, "calendar_periods", "year-month")
    groups = calendar_groups(inputs, counts).where(F.col("parts") > 1)
    return groups.select("profile", "alias", "kind", F.col("first").alias("key"), "rows")


@query(
    f"""WITH c AS ({order_counts_sql(undated=True)})
    SELECT profile, alias, 'oversized-period' AS reason, key::INT AS key, rows FROM c WHERE rows > CASE alias WHEN 'F' THEN 13 WHEN 'O' THEN 13 ELSE 10 END
    UNION ALL SELECT profile, alias, 'null-dates', NULL, rows FROM c WHERE key IS NULL"""
)
def plan_refusals_orders(spark, sf):
    counts = order_counts(spark, sf, undated=True)
    return plan_refusals(inputs_of(counts, 13, 100, "calendar_periods", "year-month", oversized="error", nulls="error"), counts)


@query(
    f"""WITH c AS ({NATIONS}) SELECT profile, alias, 'budget-below-one-row' AS reason, NULL::INT AS key, n AS rows FROM c WHERE 15 // cols - 1 < 1"""
)
def budget_refusals_nations(spark, sf):
    return plan_refusals(nation_shapes(spark, sf, 25, 15), None, {"budget-below-one-row"})
