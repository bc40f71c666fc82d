"""Whole exports on small made tables: skew, order, empty and odd sources, files read back, damage found."""

import datetime as dt
import tempfile
import zipfile

import pytest
from pyspark.sql import functions as F

from slicedigest.operators import export as export_module
from slicedigest.operators.assign import partition_check
from slicedigest.operators.digest import combine
from slicedigest.operators.export import ExportRefused, SourceTable, export, preview
from slicedigest.operators.order import with_positions
from slicedigest.operators.verify import reassembly, verify_fragments, verify_manifest
from slicedigest.options import DateColumn, Limits, Naming, Partitioning, Profile, Sheet, SortKey
from slicedigest.runtime import materialise, use_checkpoint_dir
from slicedigest.sources import records
from slicedigest.sources.parquet import read_parquet_sheets, read_source, write_parquet_sheets
from slicedigest.sources.xlsx import read_back_sheets, read_workbooks, written_headers, write_workbooks

BOOKED = {"booked": DateColumn.date()}


def source(df, ordinal="n", **facts):
    return SourceTable(df, "stem", {**BOOKED, **facts.pop("dates", {})}, (ordinal,), **facts)


def skewed(spark, n=3000):
    """A third of all rows in one month, a tenth undated, one sort value for most rows."""
    day = F.when(F.col("id") % 3 == 0, F.lit("2025-03-05")).when(F.col("id") % 10 == 1, None).otherwise(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 500).cast("int")).cast("string"))
    return spark.range(n).select(F.col("id").alias("n"), day.cast("date").alias("booked"), (F.col("id") % 100 == 0).alias("flag"), F.concat(F.lit("t"), F.col("id") % 7).alias("text"), (F.col("id") * 1.5).alias("amount"))


def one_source(limits, rule, sort=(), column="booked"):
    return Profile("p", (Sheet("a", column if rule.calendar else None, sort),), limits, rule)


RULES = [
    Partitioning("calendar_greedy", base_period="year"),
    Partitioning("calendar_periods", base_period="year-month", period_order="descending"),
    Partitioning("calendar_greedy", base_period="year-month-day"),
    Partitioning("balanced"),
    Partitioning("balanced", balance_across="workbooks"),
]


@pytest.mark.parametrize("rule", RULES, ids=lambda r: f"{r.algorithm}-{r.base_period}-{r.balance_across}")
def test_every_row_is_in_one_sheet_and_digests_add_up(spark, rule):
    made = export(one_source(Limits(200, 3000), rule, (SortKey("flag", descending=True),)), {"a": source(skewed(spark))})
    assert partition_check(made.placed["a"].where("sheet IS NOT NULL"), made.plan).count() == 0
    assert made.placed["a"].where("sheet IS NULL").count() == 0
    total, whole = combine(made.fragments, ["alias"]).first(), made.sources.first()
    assert (total["digest"], total["row_digest"], total["rows"]) == (whole["digest"], whole["row_digest"], 3000)
    assert reassembly(made.fragments, made.sources).first()["reassembly"] == "valid"
    # Rows meet their sheets in order: what a sheet holds is a consecutive stretch of the whole order.
    order = made.arranged["a"].order
    placed = with_positions(made.placed["a"].withColumn("g", F.lit(1)), ["g"], order, "pos")
    spans = placed.groupBy("workbook", "sheet").agg(F.min("pos").alias("lo"), F.max("pos").alias("hi"), F.count("*").alias("c"))
    joined = spans.join(made.plan.select("workbook", "sheet", "start", "rows"), ["workbook", "sheet"])
    assert joined.where("lo <> start OR hi <> start + rows - 1 OR c <> rows").count() == 0


def test_order_is_decided_on_source_values(spark):
    df = spark.createDataFrame([(0, True), (1, False), (2, None), (3, True)], "n bigint, flag boolean").withColumn("booked", F.lit("2025-01-01").cast("date"))
    made = export(one_source(Limits(), RULES[0], (SortKey("flag", nulls_first=True),)), {"a": source(df)})
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    write_parquet_sheets(made, folder)
    back = read_parquet_sheets(spark, folder, "a", made.arranged["a"].frame.select("flag", "booked").schema)
    assert [r["flag"] for r in back.collect()] == [None, 0.0, -1.0, -1.0]


def test_window_dates_sort_by_decoded_order(spark):
    df = spark.createDataFrame([(0, 6912), (1, 7001), (2, 101)], "n bigint, period int").withColumn("booked", F.lit("2025-01-01").cast("date"))
    made = export(one_source(Limits(), RULES[0], (SortKey("period"),)), {"a": source(df, dates={"period": DateColumn.integer("YYMM", 1970)})})
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    write_parquet_sheets(made, folder)
    back = read_parquet_sheets(spark, folder, "a", made.arranged["a"].frame.select("period", "booked").schema)
    assert [r["period"] for r in back.collect()] == [7001.0, 101.0, 6912.0]


def test_refusals_name_row_and_column(spark):
    df = skewed(spark, 100)
    with pytest.raises(ExportRefused, match="booked.*null"):
        export(one_source(Limits(), Partitioning(null_dates="error")), {"a": source(df)})
    with pytest.raises(ExportRefused, match="oversized-period"):
        export(one_source(Limits(5, 1000), Partitioning(base_period="year-month", oversized="error")), {"a": source(df)})
    with pytest.raises(ExportRefused, match="budget-below-one-row"):
        export(one_source(Limits(5, 7), Partitioning()), {"a": source(df)})
    named = Naming(workbook="con.xlsx")
    with pytest.raises(ExportRefused, match="device-name"):
        export(Profile("p", (Sheet("a", "booked"),), naming=named), {"a": source(df)})


SPECIAL = [
    "plain", " padded ", "=SUM(1+1)", "line\r\nbreak", "tab\tand\x00null\x1f", "<a href='x'>&amp;</a>", "_x0041_ stays", "é é", "👩‍👩‍👧", " ‮", "１", "x" * 32_767,
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [
        (n, text, dt.date(1890 + 20 * n, 2, 28), dt.datetime(1960, 1, 1, 23, 59, 59) + dt.timedelta(days=2000 * n), n / 3 if n % 4 else None, None)
        for n, text in enumerate(SPECIAL)
    ]
    rows.append((len(rows), None, None, None, None, None))
    df = spark.createDataFrame(rows, "n bigint, `*` string, `^date$` date, `ünïcødé` timestamp_ntz, `a.b` double, nothing void")
    df = df.withColumn("booked", F.when(F.col("n") < 12, F.lit("2025-01-01").cast("date")))
    empty = spark.createDataFrame([], "n bigint, id bigint, booked date")
    profile = Profile("odd", (Sheet("a", "booked"), Sheet("b", "booked")), Limits(), Partitioning(base_period="year"))
    made = export(profile, {"a": source(df), "b": source(empty)})
    folder = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    write_workbooks(made, folder)
    return made, folder


def test_workbooks_hold_every_text_date_and_empty_sheet(spark, odd):
    made, folder = odd
    cells = read_workbooks(spark, folder)
    headers = {r["sheet"]: r["header"] for r in written_headers(cells).collect()}
    assert headers == {"a Data": ["*", "^date$", "ünïcødé", "a.b", "nothing", "booked"], "b Data": ["id", "booked"]}
    schema = made.arranged["a"].frame.select(*[F.col(f"`{c}`") for c in made.arranged["a"].columns]).schema
    mine = made.fragments.where("alias = 'a'")
    back = read_back_sheets(cells.where("sheet = 'a Data'"), schema, mine)
    assert verify_fragments(mine, back).first()["kind"] == "valid"
    assert made.fragments.where("alias = 'b'").first()["digest"] == "0" * 32


def edit_book(folder, change):
    """Rewrite the one workbook with its first sheet's XML changed."""
    import os

    name = next(f for f in os.listdir(folder) if f.endswith(".xlsx"))
    out = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    with zipfile.ZipFile(f"{folder}/{name}") as old, zipfile.ZipFile(f"{out}/{name}", "w") as new:
        for item in old.namelist():
            data = old.read(item)
            new.writestr(item, change(data.decode()).encode() if item.endswith("sheet1.xml") else data)
    return out


@pytest.mark.parametrize(
    ("change", "kind"),
    [
        (lambda x: x.replace("plain", "plane"), "digest-mismatch"),
        (lambda x: x.replace("ünïcødé", "unicode"), "columns-differ"),
        (lambda x: x.replace("<c><v>", '<c t="str"><v>text ', 1), "workbook-unreadable"),
        (lambda x: x.replace("</sheetData>", "<row><c><v>1</v></c></row></sheetData>"), "workbook-unreadable"),
        (lambda x: x[: len(x) // 2], "workbook-unreadable"),
        (lambda x: x.replace('<row r="14"><c/><c/><c/><c/><c/><c/></row>', ""), "valid"),
    ],
    ids=["one cell", "header", "wrong type", "extra row", "cut off", "trailing empty row lost"],
)
def test_damage_to_a_workbook_is_named(spark, odd, change, kind):
    made, folder = odd
    schema = made.arranged["a"].frame.select(*[F.col(f"`{c}`") for c in made.arranged["a"].columns]).schema
    mine = made.fragments.where("alias = 'a'")
    cells = read_workbooks(spark, edit_book(folder, change))
    back = read_back_sheets(cells.where("sheet = 'a Data' OR row IS NULL"), schema, mine)
    assert verify_fragments(mine, back).where("workbook IS NOT NULL AND alias = 'a'").first()["kind"] == kind


def test_dropped_fragment_fails_the_source(spark):
    made = export(one_source(Limits(200, 3000), RULES[0]), {"a": source(skewed(spark))})
    first = made.fragments.orderBy("workbook", "sheet").first()
    rest = made.fragments.where(F.col("sheet") != first["sheet"])
    actual = made.fragments.select("workbook", "sheet", "header", "rows", "digest")
    good = verify_manifest(made.fragments, made.sources, actual).first()
    bad = verify_manifest(rest, made.sources, actual).first()
    assert good["valid"] and not bad["valid"] and not bad["rows_match"] and bad["reassembly"] == "digest-mismatch"


def test_preview_writes_nothing_and_counts_every_row(spark):
    plan = preview(one_source(Limits(200, 3000), RULES[1]), {"a": source(skewed(spark))})
    assert plan.agg(F.sum("rows")).first()[0] == 3000


def test_records_of_another_version_are_unreadable(spark):
    folder = f"{use_checkpoint_dir(spark)}/records-test"
    made = export(one_source(Limits(), RULES[0]), {"a": source(skewed(spark, 50))})
    records.write_records(made.sources.withColumns({"conversion_version": F.lit("4.0"), "total_and_disjoint": F.lit(True)}), folder)
    spark.createDataFrame([('{"schema_version": 99, "alias": "x"}',), ("not json",)], "value string").write.mode("append").text(folder)
    good, unreadable = records.read_records(spark, folder, records.SOURCES)
    assert [r["alias"] for r in good.collect()] == ["a"] and unreadable.count() == 2


@pytest.mark.parametrize("digests", [False, True])
def test_counting_sorts_no_rows(spark, monkeypatch, digests):
    orders = read_source(spark, "/root/testdata/sf0.001/orders.parquet", {"o_orderdate": DateColumn.datetime()})
    profile = Profile("p", (Sheet("orders", "o_orderdate"),), Limits(500, 5000), Partitioning())
    plans = []
    monkeypatch.setattr(export_module, "materialise", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or materialise(df))
    counts = export_module.count_sources(profile, {"orders": export_module.arrange(orders, profile.sheets[0], profile)}, digests)
    assert counts.where("refused IS NOT NULL").isEmpty() and counts.count() > 12
    assert plans and not any("SortAggregate" in p or "Sort [" in p for p in plans)
