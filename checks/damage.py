"""Exports whose workbooks are damaged after they were written, and exports with a source that has no rows."""

from __future__ import annotations

import io
import re
import uuid
import zipfile

from pyspark.sql import functions as F

from checks.plan_sql import plan_ctes
from checks.registry import query
from checks.rows import ORDER_DATES, ORDERS_COUNTS, _orders_profile
from slicedigest.operators.export import export
from slicedigest.operators.verify import reassembly, verify_fragments
from slicedigest.options import DateColumn, Limits, Partitioning, Profile, Sheet
from slicedigest.runtime import use_checkpoint_dir
from slicedigest.sources.parquet import read_source
from slicedigest.sources.xlsx import _filesystem, full_path, read_back_sheets, read_workbooks, write_workbooks

STRAY = "zz_stray.xlsx"


def first_sheet(edit):
    """A change of a workbook's first sheet, given as text."""

    def change(data: bytes) -> bytes:
        out = io.BytesIO()
        with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as new:
            for name in old.namelist():
                text = old.read(name)
                new.writestr(name, edit(text.decode()) if name == "xl/worksheets/sheet1.xml" else text)
        return out.getvalue()

    return change


DAMAGE = {
    2: first_sheet(lambda t: re.sub(r'(<row r="2"><c><v>)([^<]*)', lambda m: f"{m[1]}{float(m[2]) + 1}", t)),  # another number
    3: first_sheet(lambda t: re.sub(r'(<c s="1"><v>)[^<]*', r"\g<1>1e300", t, count=1)),  # a date that no calendar has
    4: first_sheet(lambda t: t.replace('<row r="2">', '<row r="two">')),  # a row without a number
    5: lambda data: data[: len(data) // 2],  # a file cut off
}


@query(
    f"""{plan_ctes(ORDERS_COUNTS, 100, 1300)},
    ranked AS (SELECT workbook, row_number() OVER (ORDER BY workbook) - 1 AS n FROM (SELECT DISTINCT workbook FROM plan)),
    s AS (SELECT workbook, sheet, n, row_number() OVER (PARTITION BY workbook ORDER BY sheet_index) AS k FROM plan JOIN ranked USING (workbook))
    SELECT workbook, sheet, CASE WHEN n = 0 THEN 'workbook-missing' WHEN n = 2 AND k = 1 THEN 'digest-mismatch'
      WHEN n IN (3, 4) AND k = 1 OR n = 5 THEN 'workbook-unreadable' ELSE 'valid' END AS kind FROM s
    UNION ALL SELECT '{STRAY}', sheet, 'unexpected' FROM s WHERE n = 1"""
)
def verify_damaged_workbooks(spark, sf):
    source = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    made = export(_orders_profile(100, 1300), {"orders": source})
    folder = f"{use_checkpoint_dir(spark)}/damaged-{uuid.uuid4().hex}"
    write_workbooks(made, folder)
    fs, root = _filesystem(full_path(spark, folder))
    books = [r["workbook"] for r in made.plan.select("workbook").distinct().orderBy("workbook").limit(6).collect()]
    fs.delete_file(f"{root}/{books[0]}")
    fs.copy_file(f"{root}/{books[1]}", f"{root}/{STRAY}")
    for n, change in DAMAGE.items():
        path = f"{root}/{books[n]}"
        with fs.open_input_file(path) as file:
            data = change(file.read())
        with fs.open_output_stream(path) as file:
            file.write(data)
    arranged = made.arranged["orders"]
    schema = arranged.frame.select(*arranged.columns).schema
    back = read_back_sheets(read_workbooks(spark, folder), schema, made.fragments)
    return verify_fragments(made.fragments, back, every_sheet_seen=True).select("workbook", "sheet", "kind")


EMPTY_BESIDE = f"{ORDERS_COUNTS} UNION ALL SELECT 'by_year', 'lineitem', 1, 11, NULL, 0"


@query(
    f"""{plan_ctes(EMPTY_BESIDE, 500, 5000)} SELECT alias, workbook, sheet, kind, period_label, rows::BIGINT AS rows, 'valid' AS reassembly, 'valid' AS verdict FROM plan"""
)
def export_beside_empty_source(spark, sf):
    orders = read_source(spark, f"{sf}/orders.parquet", ORDER_DATES)
    nothing = read_source(spark, f"{sf}/lineitem.parquet", {"l_shipdate": DateColumn.datetime()})
    nothing = type(nothing)(nothing.frame.where("l_orderkey < 0"), nothing.stem, nothing.date_columns)
    profile = _orders_profile(500, 5000)
    profile = Profile(profile.name, (*profile.sheets, Sheet("lineitem", "l_shipdate")), Limits(500, 5000), Partitioning(base_period="year"))
    made = export(profile, {"orders": orders, "lineitem": nothing})
    folder = f"{use_checkpoint_dir(spark)}/beside-{uuid.uuid4().hex}"
    write_workbooks(made, folder)
    schemas = {alias: a.frame.select(*a.columns).schema for alias, a in made.arranged.items()}
    back = read_back_sheets(read_workbooks(spark, folder), schemas, made.fragments)
    verdicts = verify_fragments(made.fragments, back, every_sheet_seen=True).select("alias", "workbook", "sheet", F.col("kind").alias("verdict"))
    whole = reassembly(made.fragments, made.sources).select("alias", "reassembly")
    rows = made.fragments.select("alias", "workbook", "sheet", "kind", "period_label", "rows")
    return rows.join(verdicts, ["alias", "workbook", "sheet"]).join(whole, "alias").select(
        "alias", "workbook", "sheet", "kind", "period_label", "rows", "reassembly", "verdict"
    )
