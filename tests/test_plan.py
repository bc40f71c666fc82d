"""Plan shapes that the published examples pin, and plan properties."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from slicedigest.options import Limits, Naming, Partitioning, Profile, Sheet
from slicedigest.plans.capacity import minimum_workbooks
from slicedigest.plans.profile import plan_inputs, plan_profiles, plan_refusals, profile_options
from slicedigest.runtime import materialise


def by_month(dates):
    return Counter(d.year * 10000 + d.month * 100 if d else None for d in dates)


MULTI = by_month([dt.date(2022, 1, 3) + dt.timedelta(days=3 * n) for n in range(600)])
COUNTS = {
    "tiny": {20250100: 3},
    "single_row": {20250300: 1},
    "multi_year": MULTI,
    "undated": {20250300: 14, 20250900: 6, None: 10},
    "all_undated": {None: 12},
    "overflow": {20250500: 2500},
    "int_yymm": {19700100: 1, 19991200: 1, 20000100: 2, 20691200: 2},
    "int_yyyymmdd": {20240200: 2, 20241200: 1, 20250100: 1},
    "zoned": {20251200: 2, 20260100: 1},
    "wall_clock": {20250100: 6},
    "odd_names": {20250100: 3},
    "empty": {},
}
COLUMNS = {"multi_year": 4, "overflow": 4, "wall_clock": 2, "odd_names": 5}


def profile(name, sources, cells, rows=1_048_575, **rule):
    sheets = tuple(Sheet(s, None if rule.get("algorithm") == "balanced" else "booked") for s in sources)
    return Profile(name, sheets, Limits(rows, cells), Partitioning(**rule), Naming(collision="suffix"))


PROFILES = [
    profile("by_year", ["tiny", "single_row", "multi_year"], 800, base_period="year"),
    profile("by_month_descending", ["multi_year"], 400, algorithm="calendar_periods", base_period="year-month", period_order="descending"),
    profile("fan_in", ["tiny", "odd_names"], 10_000_000, base_period="year-month"),
    profile("undated_last", ["undated", "all_undated"], 60, base_period="year", period_order="descending"),
    profile("tight_limits", ["overflow"], 4000, 400, base_period="year-month"),
    profile("int_and_zoned_dates", ["int_yymm", "int_yyyymmdd", "zoned", "wall_clock"], 40, base_period="year"),
    profile("empty_source", ["empty"], 10_000_000, base_period="year"),
    profile("even_sheets", ["multi_year", "tiny", "empty"], 800, 50, algorithm="balanced"),
    profile("even_books", ["multi_year", "tiny", "empty"], 800, 50, algorithm="balanced", balance_across="workbooks"),
    profile("one_row_books", ["tiny", "single_row"], 12, algorithm="balanced", balance_across="workbooks"),
]


def prepared(spark, profiles):
    shapes = spark.createDataFrame([(a, a, COLUMNS.get(a, 3), sum(c.values())) for a, c in COUNTS.items()], "alias string, stem string, columns int, rows bigint")
    rows = [(p.name, s.source, k, n) for p in profiles for s in p.sheets for k, n in COUNTS[s.source].items()]
    counts = spark.createDataFrame(rows, "profile string, alias string, key int, rows bigint")
    return materialise(plan_inputs(profile_options(spark, profiles), shapes)), materialise(counts)


@pytest.fixture(scope="module")
def plan(spark):
    inputs, counts = prepared(spark, PROFILES)
    rows = plan_profiles(inputs, counts, {p.name: p.naming for p in PROFILES}).orderBy("profile", "workbook_index", "sheet_index").collect()
    return {p.name: [r for r in rows if r["profile"] == p.name] for p in PROFILES}


def shape(rows):
    return [(r["workbook_index"], r["period_label"], r["rows"]) for r in rows]


def test_by_year(plan):
    assert shape(plan["by_year"]) == [
        (1, "2022", 121), (2, "2023", 122), (3, "2024", 122), (3, "2025", 3), (3, "2025", 1), (4, "2025", 122), (5, "2026", 113),
    ]
    assert [r["workbook"] for r in plan["by_year"]][2] == "by_year_2024~2025_003.xlsx"
    assert [r["sheet"] for r in plan["by_year"]][3:5] == ["tiny 2025", "single_row 2025"]


def test_by_month_descending(plan):
    books = list(dict.fromkeys(r["workbook"] for r in plan["by_month_descending"]))
    assert books == [
        "by_month_descending_2026-04~12_001.xlsx",
        "by_month_descending_2025-08~2026-03_002.xlsx",
        "by_month_descending_2024-11~2025-07_003.xlsx",
        "by_month_descending_2024-03~10_004.xlsx",
        "by_month_descending_2023-06~2024-02_005.xlsx",
        "by_month_descending_2022-09~2023-05_006.xlsx",
        "by_month_descending_2022-01~08_007.xlsx",
    ]


def test_one_workbook_when_all_fits(plan):
    assert [(r["workbook"], r["sheet"], r["rows"], r["kind"]) for r in plan["fan_in"]] == [
        ("fan_in_Data_001.xlsx", "tiny Data", 3, "single"), ("fan_in_Data_001.xlsx", "odd_names Data", 3, "single"),
    ]
    assert [(r["sheet"], r["rows"]) for r in plan["empty_source"]] == [("empty Data", 0)]


def test_undated_last_under_descending(plan):
    assert shape(plan["undated_last"]) == [(1, "2025-07~12", 6), (2, "2025-01~06", 14), (3, "Undated", 10), (4, "Undated", 12)]


def test_overflow(plan):
    rows = plan["tight_limits"]
    assert [r["rows"] for r in rows] == [358] + [357] * 6 and [r["part_index"] for r in rows] == list(range(1, 8))
    assert [r["workbook_index"] for r in rows] == [1, 1, 2, 2, 3, 3, 4] and rows[0]["sheet"] == "overflow 2025-05_p01"


def test_spans_of_many_years(plan):
    assert shape(plan["int_and_zoned_dates"]) == [(1, "1970~2069", 6), (1, "2024~2025", 4), (2, "2025~2026", 3), (2, "2025", 6)]


def test_balanced(plan):
    sheets = [r for r in plan["even_sheets"] if r["alias"] == "multi_year"]
    assert [r["rows"] for r in sheets] == [50] * 12 and [r["start"] for r in sheets] == list(range(0, 600, 50))
    assert [r["rows"] for r in plan["even_sheets"] if r["alias"] == "empty"] == [0]
    books = [r for r in plan["even_books"] if r["alias"] == "multi_year"]
    assert sum(r["rows"] for r in books) == 600 and max(r["rows"] for r in books) <= 50
    per_book = Counter()
    for r in books:
        per_book[r["workbook_index"]] += r["rows"]
    assert max(per_book.values()) - min(per_book.values()) <= 1
    assert [(r["workbook_index"], r["alias"], r["rows"]) for r in plan["one_row_books"]] == [(1, "tiny", 1), (1, "single_row", 1), (2, "tiny", 1), (3, "tiny", 1)]


def test_every_plan_conserves_rows_stays_in_budget_and_has_distinct_names(plan):
    for p in PROFILES:
        rows = plan[p.name]
        for sheet in p.sheets:
            assert sum(r["rows"] for r in rows if r["alias"] == sheet.source) == sum(COUNTS[sheet.source].values())
        cells = Counter()
        for r in rows:
            cells[r["workbook"]] += r["cells"]
        assert max(cells.values()) <= p.limits.cells and max(r["rows"] for r in rows) <= p.limits.rows
        assert len({(r["workbook"].lower(), r["sheet"].lower()) for r in rows}) == len(rows) and all(r["problem"] is None for r in rows)


def test_refusals(spark):
    strict = [
        profile("oversized", ["overflow"], 4000, 400, base_period="year-month", oversized="error"),
        profile("dated", ["undated"], 60, base_period="year", null_dates="error"),
        profile("narrow", ["multi_year"], 7, base_period="year"),
        profile("never", ["multi_year", "tiny"], 9, algorithm="balanced", balance_across="workbooks"),
    ]
    inputs, counts = prepared(spark, strict)
    got = {(r["profile"], r["alias"], r["reason"]) for r in plan_refusals(inputs, counts).collect()}
    assert ("oversized", "overflow", "oversized-period") in got and ("dated", "undated", "null-dates") in got
    assert ("narrow", "multi_year", "budget-below-one-row") in got and {r for r in got if r[0] == "oversized"} == {("oversized", "overflow", "oversized-period")}
    assert minimum_workbooks(inputs.where("profile = 'never'")).first()["workbooks"] is None


def test_collision_policies(spark):
    same = Naming(worksheet="same", overflow_worksheet="same", collision="suffix")
    p = Profile("p", (Sheet("multi_year", "booked"),), Limits(100, 3000), Partitioning("calendar_periods", base_period="year-month"), same)
    inputs, counts = prepared(spark, [p])
    names = [r["sheet"] for r in plan_profiles(inputs, counts, same).orderBy("sheet_index").collect()]
    assert names[:3] == ["same", "same_2", "same_3"] and len(set(names)) == 60
    refused = plan_profiles(inputs, counts, Naming(worksheet="same", overflow_worksheet="same", collision="error")).where(F.col("problem") == "collision")
    assert refused.count() == 60
