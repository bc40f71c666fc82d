"""The oracles of plans, on more sheets and workbooks than the smallest tables give."""

import duckdb

from checks.layout import inputs_of, nation_shapes
from checks.plan_sql import PLAN_COLUMNS, plan_select
from checks.registry import ORACLES
from run_checks import canonical
from slicedigest.options import Naming
from slicedigest.plans.capacity import minimum_workbooks
from slicedigest.plans.profile import plan_profiles


def test_names_keep_every_digit_of_long_numbers(spark):
    counted = spark.createDataFrame([("p", "F", 20240100, 1500)], "profile string, alias string, key int, rows bigint")
    made = plan_profiles(inputs_of(counted, 1, 12), counted, Naming(), {"calendar"}).select(*PLAN_COLUMNS).toPandas()
    assert {"p_2024-01_1500.xlsx", "p_2024-01_001.xlsx"} <= set(made["workbook"])
    assert {"F 2024-01_p1500", "F 2024-01_p01"} <= set(made["sheet"])
    counts = "SELECT 'p' AS profile, 'F' AS alias, 0 AS pos, 6 AS cols, 20240100 AS key, 1500::BIGINT AS rows"
    want = duckdb.sql(plan_select(counts, 1, 12, whole=True)).df()
    assert canonical(made) == canonical(want)


def test_workbook_counts_are_not_limited(spark, tmp_path):
    con = duckdb.connect()
    con.execute("CREATE TABLE nation AS SELECT 0 AS n_nationkey, 0 AS n_regionkey")
    con.execute("CREATE TABLE customer AS SELECT i::BIGINT AS c_custkey, 0 AS c_nationkey FROM range(250000) t(i)")
    for t in ("nation", "customer"):
        con.execute(f"COPY {t} TO '{tmp_path}/{t}.parquet' (FORMAT parquet)")
    made = minimum_workbooks(nation_shapes(spark, str(tmp_path), 25, 500)).toPandas()
    assert made["workbooks"][0] > 2000
    assert canonical(made) == canonical(con.execute(ORACLES["balanced_workbook_counts"]).df())
