"""Workbooks that are damaged, paths, the writer's plan, folds over many items, descriptions and runs."""

import io
import re
import time
import zipfile
from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In
from pyspark.sql import types as T

from checks.rows import ORDER_DATES, _orders_profile
from slicedigest.functions.calendar import check_zone
from slicedigest.functions.names import column_problem
from slicedigest.operators.describe import describe_many, stored_schema
from slicedigest.operators.digest import digest_all, digest_columns, digest_frame
from slicedigest.operators.export import ExportRefused, export
from slicedigest.operators.run import Source, resolved, run
from slicedigest.operators.select import config_hash
from slicedigest.operators.verify import verify_fragments
from slicedigest.options import DateColumn, Limits, Partitioning, Profile, Sheet
from slicedigest.plans.allocate import next_fit
from slicedigest.plans.groups import greedy_runs
from slicedigest.runtime import broadcast_if_small
from slicedigest.sources import records
from slicedigest.sources.parquet import read_source
from slicedigest.sources import xlsx
from slicedigest.sources.xlsx import full_path, read_back_sheets, read_rows, read_workbooks, rich_text, workbook_rows, write_workbooks

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    source = read_source(spark, f"{SF}/orders.parquet", ORDER_DATES)
    made = export(_orders_profile(500, 5000), {"orders": source})
    folder = tmp_path_factory.mktemp("books")
    write_workbooks(made, str(folder))
    arranged = made.arranged["orders"]
    return made, folder, arranged.frame.select(*arranged.columns).schema


def verdicts(spark, made, folder, schema):
    back = read_back_sheets(read_workbooks(spark, str(folder)), schema, made.fragments)
    return {(r["workbook"], r["sheet"]): r["kind"] for r in verify_fragments(made.fragments, back, every_sheet_seen=True).collect()}


def test_paths_with_and_without_a_scheme(spark, written):
    made, folder, schema = written
    assert full_path(spark, "/a/b") == full_path(spark, "file:/a/b") == "file:///a/b"
    plain = verdicts(spark, made, folder, schema)
    assert set(plain.values()) == {"valid"} and plain == verdicts(spark, made, f"file:{folder}", schema)


def test_paths_that_executors_share(spark, tmp_path):
    sc = spark.sparkContext
    cluster = SimpleNamespace(_jvm=sc._jvm, _jsc=sc._jsc, master="spark://host:7077", getCheckpointDir=lambda: "/shared/ck")
    session = SimpleNamespace(sparkContext=cluster, conf=SimpleNamespace(get=lambda name, default=None: "/shared/ck"))
    assert full_path(session, "/shared/ck/books-1") == "file:///shared/ck/books-1"
    for own in ("/tmp/books-1", "/shared/ck/../books-1", "/shared/ckbooks-1"):
        with pytest.raises(ValueError, match="own disk"):
            full_path(session, own)
    sc._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.books.link./ck", f"file://{tmp_path}")
    assert full_path(spark, "viewfs://books/ck/books-1/a") == f"file://{tmp_path}/books-1/a"


def test_plain_paths_where_a_view_is_the_default_file_system(spark, tmp_path):
    sc = spark.sparkContext
    conf = sc._jvm.org.apache.hadoop.conf.Configuration(sc._jsc.hadoopConfiguration())
    conf.set("fs.defaultFS", "viewfs://plain/")
    conf.set("fs.viewfs.mounttable.plain.link./ck", f"file://{tmp_path}")
    jsc = SimpleNamespace(hadoopConfiguration=lambda: conf)
    cluster = SimpleNamespace(_jvm=sc._jvm, _jsc=jsc, master="spark://host:7077", getCheckpointDir=lambda: "viewfs://plain/ck")
    session = SimpleNamespace(sparkContext=cluster, conf=SimpleNamespace(get=lambda name, default=None: "/ck"))
    assert full_path(session, "/ck/books-1/a") == full_path(session, "viewfs://plain/ck/books-1/a") == f"file://{tmp_path}/books-1/a"


def test_rows_move_once_on_their_way_to_a_workbook(spark, written):
    plan = workbook_rows(written[0])._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Exchange hashpartitioning\(workbook", final)) == 1
    assert "Window" not in final


def test_any_flipped_bit_ends_in_verdicts(spark, written, tmp_path):
    made, folder, schema = written
    book = sorted(folder.glob("*.xlsx"))[0]
    data = book.read_bytes()
    rng = np.random.default_rng(11)
    manifest = made.fragments.where(F.col("workbook") == book.name)
    sheets = {r["sheet"] for r in manifest.select("sheet").collect()}
    copies = []
    for n, at in enumerate([*rng.integers(0, len(data), 60), 0, len(data) - 1, len(data) - 30]):
        broken = bytearray(data)
        broken[at] ^= 1 << int(rng.integers(8))
        (tmp_path / f"{n}.xlsx").write_bytes(broken)
        copies.append(manifest.withColumn("workbook", F.lit(f"{n}.xlsx")))
    (tmp_path / "none.xlsx").write_bytes(b"")
    (tmp_path / "half.xlsx").write_bytes(data[: len(data) // 2])
    whole = copies[0]
    for c in copies[1:]:
        whole = whole.unionByName(c)
    back = read_back_sheets(read_workbooks(spark, str(tmp_path)), schema, whole)
    found = verify_fragments(whole, back, every_sheet_seen=True).collect()
    recorded = [r for r in found if r["kind"] != "unexpected"]
    assert len(recorded) == len(copies) * len(sheets)
    assert {r["kind"] for r in recorded} <= {"valid", "digest-mismatch", "workbook-unreadable", "workbook-missing", "columns-differ"}
    assert "workbook-unreadable" in {r["kind"] for r in recorded}


def sheet_xml(rows):
    return io.BytesIO(f'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>{rows}</sheetData></worksheet>'.encode())


@pytest.mark.parametrize("rows", ['<row r="2"/><row r="2"/>', '<row r="9999999"/>', '<row><c r="XFE1"><v>1</v></c></row>', '<row><c r="B1"/><c r="A1"/></row>', '<row r="x"/>'])
def test_rows_outside_the_format_are_refused(rows):
    with pytest.raises(ValueError):
        list(read_rows(sheet_xml(rows), []))


ODD_TEXTS = ["", " ", "a&b<c>d&amp;", "_x000A_ _x000a_ _xZZZZ_ __x0001_x0002_", "\ufffe\uffff", "ü 漢字 😀", "\r\n\t", *[f"a{chr(n)}b" for n in range(0x21)]]


def test_spark_makes_the_xml_of_a_row(spark, written):
    cells = [*["s" + t for t in ODD_TEXTS], "n1.0", "n-1.0E10", "d36046.25", None]
    made = spark.createDataFrame([(n, c) for n, c in enumerate(cells)], "n int, cell string").orderBy("n").select(xlsx.cell_xml(F.col("cell")))
    assert [r[0] for r in made.collect()] == [xlsx.cells_xml([c]) for c in cells]
    rows = xlsx.xml_rows(written[0])
    assert rows.columns == ["workbook", "sheet", "xml"]
    want = [(r["workbook"], r["sheet"], xlsx.cells_xml(r["cells"])) for r in workbook_rows(written[0]).collect()]
    assert sorted(map(tuple, rows.collect())) == sorted(want)


@pytest.mark.parametrize("piece", [1, 7, 64, 1 << 16])
def test_sheets_are_parsed_in_pieces(monkeypatch, piece):
    monkeypatch.setattr(xlsx, "PIECE", piece)
    rows = '<row r="2"><c r="B2" s="1"><v>1.5</v></c><c t="s"><v>0</v></c></row><!-- </row> --><row/><row r="9"><c t="inlineStr"><is><t>x&amp;y</t></is></c><c/></row>'
    assert list(read_rows(sheet_xml(rows), ["one"])) == [(1, [None, "d1.5", "sone"]), (2, []), (8, ["sx&y", None])]
    assert list(read_rows(sheet_xml(""), [])) == []
    with pytest.raises(SyntaxError):
        list(read_rows(sheet_xml("<row><c></row>"), []))
    with pytest.raises(SyntaxError):
        list(read_rows(io.BytesIO(sheet_xml("<row/>").getvalue()[:-3]), []))


def sheet_written(rows):
    stream = io.BytesIO()
    book = xlsx.WorkbookFile(stream)
    book.start("s")
    for cells in rows:
        book.add(xlsx.cells_xml(cells))
    book.close()
    return zipfile.ZipFile(stream).read("xl/worksheets/sheet1.xml")


WRITTEN_ROWS = [["sa", "sb"], ["n1.0", None, "d36046.25"], ["s" + t for t in ODD_TEXTS], [], ["n-1.0E10"], ["s<row r=\"2\">", "s</row>"], ["n2.0"]]


@pytest.mark.parametrize("piece", [1, 7, 1 << 16])
def test_sheets_as_written_are_read_without_the_parser(monkeypatch, piece):
    monkeypatch.setattr(xlsx, "PIECE", piece)
    data = sheet_written(WRITTEN_ROWS)
    with monkeypatch.context() as m:
        m.setattr(xlsx, "_parsed_rows", lambda *_: pytest.fail("parsed"))
        assert list(read_rows(io.BytesIO(data), [])) == list(enumerate(WRITTEN_ROWS))
    assert list(xlsx._parsed_rows(io.BytesIO(data), [])) == list(enumerate(WRITTEN_ROWS))


CHANGES = [
    ('<row r="5">', '<row r="5" spans="1:1">'), ('<row r="5">', '<row r="4">'), ('<row r="5">', '<row r="05">'), ('<row r="5">', '<row r="x">'),
    ("-1.0E10", "\r\n-1"), ("-1.0E10", "<!-- </row> -->7"), ("-1.0E10", "<![CDATA[</row>]]>"), ("-1.0E10", "&#55;"), ("-1.0E10", "]]>"),
    ("-1.0E10", ""), ("-1.0E10", "\x01"), ("<c><v>-1.0E10", '<c s="2"><v>-1.0E10'), ("<c><v>-1.0E10", '<c t="s"><v>0'), ("<c/>", "<c></c>"),
    ("</sheetData>", '</sheetData><mergeCells count="0"/>'), ("</sheetData>", ""), ("</worksheet>", "</worksheet>x"), ('<row r="5">', "<row>"),
]


@pytest.mark.parametrize("old, new", CHANGES)
def test_sheets_in_other_forms_are_read_as_the_parser_does(old, new):
    data = sheet_written(WRITTEN_ROWS).decode().replace(old, new, 1).encode()

    def seen(read):
        try:
            return list(read(io.BytesIO(data), ["shared"]))
        except (SyntaxError, ValueError) as error:
            return type(error)

    assert seen(read_rows) == seen(xlsx._parsed_rows)


def test_phonetic_guides_are_not_content():
    rows = '<row><c t="inlineStr"><is><r><t>to</t></r><rPh sb="0" eb="1"><t>guide</t></rPh><r><t>kyo</t></r></is></c></row>'
    assert list(read_rows(sheet_xml(rows), [])) == [(0, ["stokyo"])]
    assert rich_text(None) == ""


def test_only_named_sheets_are_read(spark, written):
    made, folder, _ = written
    name = made.plan.select("sheet").orderBy("sheet").first()["sheet"]
    assert {r["sheet"] for r in read_workbooks(spark, str(folder), [name]).select("sheet").distinct().collect()} == {name}


def test_workbooks_need_no_processes_beside_the_driver(spark, written, tmp_path, monkeypatch):
    made, _, schema = written
    monkeypatch.setattr(xlsx, "register", lambda _: pytest.fail("a Python data source keeps processes beside the driver"))
    write_workbooks(made, str(tmp_path / "books"))
    assert set(verdicts(spark, made, tmp_path / "books", schema).values()) == {"valid"}
    assert not list((tmp_path / "books").glob("_staging-*"))


def test_a_task_that_fails_publishes_nothing(written, tmp_path, monkeypatch):
    made, rows = written[0], xlsx.workbook_rows
    cells = F.when(F.col("row") == 0, F.col("cells")).otherwise(F.array(F.raise_error("no")))
    monkeypatch.setattr(xlsx, "workbook_rows", lambda export: rows(export).withColumn("cells", cells))
    with pytest.raises(Exception, match="no"):
        write_workbooks(made, str(tmp_path))
    assert not [p for p in tmp_path.rglob("*") if p.is_file()]


def test_only_named_workbooks_are_opened(spark, written):
    made, folder, _ = written
    book, sheet = made.plan.select("workbook", "sheet").orderBy("workbook", "sheet").first()
    reader = xlsx.XlsxReader(str(folder), frozenset([sheet]), frozenset([book]))
    assert [(path.rsplit("/", 1)[-1], name) for path, name, _ in opened(reader)] == [(book, sheet)]
    wanted = (F.col("workbook") == book) & (F.col("sheet") == sheet)
    plain = sorted(read_workbooks(spark, str(folder)).where(wanted).collect())
    assert sorted(read_workbooks(spark, str(folder), [sheet], [book]).collect()) == plain != []
    spark.conf.set(xlsx.PUSHDOWN, "true")
    try:
        assert sorted(read_workbooks(spark, str(folder), [sheet], [book]).collect()) == plain
    finally:
        spark.conf.unset(xlsx.PUSHDOWN)


def opened(reader):
    return [s for p in reader.partitions() for s in p.sheets]


def test_reads_are_planned_by_sheet(spark, written, monkeypatch):
    made, folder, _ = written
    planned = {(r["workbook"], r["sheet"]) for r in made.plan.select("workbook", "sheet").collect()}
    every = opened(xlsx.XlsxReader(str(folder)))
    assert {(path.rsplit("/", 1)[-1], sheet) for path, sheet, _ in every} == planned and len(every) == len(planned)
    monkeypatch.setattr(xlsx, "SPLIT_BYTES", 0)
    assert len(xlsx.XlsxReader(str(folder)).partitions()) == len(planned)
    monkeypatch.setattr(xlsx, "SPLIT_BYTES", 1 << 30)
    monkeypatch.setattr(xlsx, "LEAST_TASKS", 1)
    assert len(xlsx.XlsxReader(str(folder)).partitions()) == 1


def test_filters_decide_what_is_opened(spark, written):
    made, folder, _ = written
    book, sheet = made.plan.select("workbook", "sheet").orderBy("workbook", "sheet").first()
    reader = xlsx.FilteringXlsxReader(str(folder))
    row = GreaterThan(("row",), 0)
    assert list(reader.pushFilters([EqualTo(("workbook",), book), In(("sheet",), (sheet, "none")), row])) == [In(("sheet",), (sheet, "none")), row]
    assert [(path.rsplit("/", 1)[-1], name) for path, name, _ in opened(reader)] == [(book, sheet)]
    wanted = (F.col("workbook") == book) & (F.col("sheet") == sheet)
    plain = read_workbooks(spark, str(folder)).where(wanted).collect()
    spark.conf.set(xlsx.PUSHDOWN, "true")
    try:
        found = read_workbooks(spark, str(folder)).where(wanted)
        assert sorted(found.collect()) == sorted(plain) != []
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"workbook#\d+ = ", plan) and re.search(r"sheet#\d+ = ", plan)
        assert found.rdd.getNumPartitions() == 1
    finally:
        spark.conf.unset(xlsx.PUSHDOWN)


def test_shared_texts_are_read_when_first_asked_for(tmp_path):
    texts = ["", "plain", "é \U0001d11e", "x" * 1000] * 500
    items = "".join(f"<si><t>{t}</t></si>" for t in texts)
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as archive:
        archive.writestr("xl/sharedStrings.xml", f'<sst xmlns="{xlsx.MAIN}">{items}</sst>')
    shared = xlsx.SharedTexts(zipfile.ZipFile(tmp_path / "a.zip"))
    assert shared.ends is None
    assert [shared[i] for i in range(len(shared))] == texts
    for bad in (-1, len(texts)):
        with pytest.raises(IndexError):
            shared[bad]
    with zipfile.ZipFile(tmp_path / "b.zip", "w") as archive:
        archive.writestr("other", "")
    assert len(xlsx.SharedTexts(zipfile.ZipFile(tmp_path / "b.zip"))) == 0


def plain_next_fit(runs, budget):
    book, used, out = 1, 0, []
    for count, cost in runs:
        fits, per = min(count, (budget - used) // cost), max(budget // cost, 1)
        out.append((book, fits, per))
        rest = count - fits
        opened = -(-rest // per)
        used = used + count * cost if rest == 0 else (rest - (opened - 1) * per) * cost
        book += opened
    return out


@pytest.mark.parametrize("count", [0, 1, 2, 17, 1000, 100_000])
def test_folds_over_any_number_of_runs(spark, count):
    rng = np.random.default_rng(count)
    runs = [(int(a), int(b)) for a, b in zip(rng.integers(1, 4, count), rng.integers(1, 60, count))]
    frame = spark.createDataFrame([(runs,)], "runs array<struct<count:bigint,cost:bigint>>").withColumn("budget", F.lit(100).cast("bigint"))
    start = time.time()
    got = frame.select(F.expr(next_fit("runs", "budget")).alias("spots")).first()["spots"]
    assert [tuple(s) for s in got] == plain_next_fit(runs, 100)
    items = spark.createDataFrame([([(n, n % 7 == 0) for n, _ in runs],)], "items array<struct<rows:bigint,sealed:boolean>>")
    numbers = items.select(F.expr(greedy_runs("items", "5L")).alias("n")).first()["n"]
    assert len(numbers) == count and numbers == sorted(numbers)
    assert time.time() - start < 30


def test_refusals_count_all_reasons(spark):
    source = read_source(spark, f"{SF}/orders.parquet", ORDER_DATES)
    sheet = Sheet("orders", "o_orderdate")
    strict = Profile("p", (sheet,), Limits(3, 100), Partitioning("calendar_periods", base_period="year-month", oversized="error"))
    with pytest.raises(ExportRefused, match=r"in all$"):
        export(strict, {"orders": source})


def test_an_unknown_zone_is_refused_before_any_job(spark):
    check_zone(spark, "Europe/Madrid")
    with pytest.raises(ValueError, match="unknown time zone"):
        check_zone(spark, "Europe/Nowhere")
    source = read_source(spark, f"{SF}/orders.parquet", {"o_orderdate": DateColumn.datetime(zone="Mars/Base")})
    with pytest.raises(ValueError, match="unknown time zone"):
        export(_orders_profile(500, 5000), {"orders": source})


def test_column_names_that_differ_by_case():
    assert column_problem([f"c{i}" for i in range(16_384)]) is None
    assert "A" in column_problem(["a", "b", "A"])


def test_broadcasts_are_measured_by_rows_and_bytes(spark):
    hinted = lambda df: "ResolvedHint" in df._jdf.queryExecution().analyzed().toString()
    df = spark.range(100).withColumn("t", F.repeat(F.lit("x"), 100))
    assert hinted(broadcast_if_small(df)) and not hinted(broadcast_if_small(df, limit=99)) and not hinted(broadcast_if_small(df, size=5000))


@pytest.mark.parametrize("width", [1, 7, 8, 9, 30])
def test_digests_of_one_pass(spark, width):
    df = spark.range(50).select(*[F.when(F.col("id") % (n + 2) != 0, F.col("id") * n).alias(f"c{n}") for n in range(width)])
    for frame in (df, df.where("false")):
        rows = digest_all(frame).collect()
        whole = next(r for r in rows if r["scope"] == "dataframe")
        want = digest_frame(frame).first()
        assert (whole["value_count"], whole["digest"], whole["row_digest"]) == (want["rows"], want["digest"], want["row_digest"])
        assert [r["column"] for r in sorted((r for r in rows if r["scope"] == "column"), key=lambda r: r["position"])] == df.columns
        assert sum(int(r["digest"], 16) for r in digest_columns(frame).collect()) + int(want["row_digest"], 16) - int(want["digest"], 16) & (1 << 128) - 1 == 0


def test_descriptions_keep_damaged_sources_apart(spark, tmp_path):
    (tmp_path / "bad.parquet").write_bytes(b"PAR1 not a parquet file PAR1")
    rows = {r["stem"]: r for r in describe_many(spark, [f"{SF}/orders.parquet", str(tmp_path / "bad.parquet"), "/nowhere/x.parquet"], ["Asia/Tokyo"]).collect()}
    assert rows["orders"]["error"] is None and rows["orders"]["source"]["rows"] == 1500
    assert rows["bad"]["error"] and rows["x"]["error"] and rows["bad"]["source"] is None
    assert (rows["orders"]["modified_in_zones"]["Asia/Tokyo"] - rows["orders"]["modified"]).total_seconds() == 9 * 3600
    schema = stored_schema(rows["orders"]["conversions"][0]["schema"])
    assert isinstance(schema, T.StructType) and schema.names == [c["column"] for c in rows["orders"]["columns"]]


def test_a_run_whose_check_fails_leaves_its_report_only(spark, tmp_path):
    sources, profile = {"orders": Source(f"{SF}/orders.parquet", ORDER_DATES)}, _orders_profile(500, 5000)
    good = run(spark, [profile], sources, str(tmp_path))
    assert good.published == ("by_year",)
    before = records.read_records(spark, f"{tmp_path}/by_year.receipt", records.RECEIPT)[0].collect()

    def careless(made, path):
        write_workbooks(made, path)
        from pathlib import Path

        book = sorted(Path(path).glob("*.xlsx"))[0]
        with zipfile.ZipFile(book) as old:
            parts = {n: old.read(n) for n in old.namelist()}
        parts["xl/worksheets/sheet1.xml"] = re.sub(rb'(<row r="2"><c><v>)[^<]*', rb"\g<1>7", parts["xl/worksheets/sheet1.xml"])
        with zipfile.ZipFile(book, "w") as new:
            for n, content in parts.items():
                new.writestr(n, content)

    bad = run(spark, [profile], sources, str(tmp_path), frozenset({"by_year"}), careless)
    assert bad.published == () and bad.reports.first()["outcome"] == "verification-failed" and bad.reports.first()["failed"] == 1
    assert records.read_records(spark, f"{tmp_path}/by_year.receipt", records.RECEIPT)[0].collect() == before
    assert spark.read.json(f"{tmp_path}/reports/by_year").count() == 2
    changed = run(spark, [_orders_profile(400, 5000)], sources, str(tmp_path))
    assert changed.selection.first()["reasons"] == ["resolved-config-hash"] and changed.published == ("by_year",)


def test_a_changed_date_column_changes_the_fingerprint():
    profile = Profile("p", (Sheet("orders", "o_orderdate"),), Limits(), Partitioning())
    of = lambda column, path="a": config_hash(resolved(profile, {"orders": Source(path, {"o_orderdate": column}), "other": Source(path)}))
    same = of(DateColumn.datetime())
    assert same == of(DateColumn.datetime()) and len(same) == 64
    assert len({same, of(DateColumn.datetime(), "b"), of(DateColumn.datetime("UTC")), of(DateColumn.date())}) == 4
