"""Names of workbooks and sheets, their problems and their collisions."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slicedigest.functions.calendar import coarsen
from slicedigest.functions.labels import sheet_label, workbook_label
from slicedigest.functions.names import SHEET_NAME_LIMIT, prefixed, render, workbook_problem, worksheet_problem
from slicedigest.options import Naming
from slicedigest.runtime import materialise

NUMBERS = {"workbook_index", "sheet_index", "part_index"}


BOOK = ["profile", "workbook_index"]


def with_workbook_label(sheets: DataFrame, naming: dict[str, Naming] | Naming) -> DataFrame:
    """Add ``workbook_label``: a workbook's whole coverage at the coarsest grain present, and whether undated rows are in it."""
    book = Window.partitionBy(*BOOK)
    rank = F.when(F.col("precision") == "year", 0).when(F.col("precision") == "month", 1).when(F.col("precision") == "day", 2)
    spans = sheets.withColumns(
        {
            "__rank": F.min(rank).over(book),
            "__lo": F.min("first").over(book),
            "__hi": F.max("last").over(book),
            "__undated": F.max((F.col("kind") == "undated").cast("int")).over(book) == 1,
        }
    )
    precision = F.when(F.col("__rank") == 0, "year").when(F.col("__rank") == 1, "month").when(F.col("__rank") == 2, "day")
    # Coarsening keeps order, so the extremes can be taken before it.
    spans = spans.withColumns(
        {"__precision": precision, "__lo": coarsen(F.col("__lo"), precision), "__hi": coarsen(F.col("__hi"), precision)}
    )
    label = _by_profile(
        naming,
        lambda rule: workbook_label(F.col("__lo"), F.col("__hi"), F.col("__precision"), F.col("__undated"), rule.month_format),
    )
    return spans.withColumn("workbook_label", label).drop("__rank", "__lo", "__hi", "__undated", "__precision")


def with_workbook_name(sheets: DataFrame, naming: dict[str, Naming] | Naming) -> DataFrame:
    """Add ``workbook`` and ``workbook_problem``; two workbooks of one name are always a problem."""
    tokens = {"profile": F.col("profile"), "period_label": F.col("workbook_label"), "workbook_index": F.col("workbook_index")}
    named = sheets.withColumn("workbook", _by_profile(naming, lambda rule: render(rule.workbook, tokens, NUMBERS)))
    same = Window.partitionBy("profile", F.lower("workbook"))
    collides = F.min("workbook_index").over(same) != F.max("workbook_index").over(same)
    return named.withColumn("workbook_problem", F.coalesce(workbook_problem(F.col("workbook")), F.when(collides, "collision")))


def _by_profile(naming: dict[str, Naming] | Naming, build: Callable[[Naming], Column]) -> Column:
    """Build one expression per distinct rule, however many profiles share it."""
    if isinstance(naming, Naming):
        return build(naming)
    users: dict[Naming, list[str]] = {}
    for profile, rule in naming.items():
        users.setdefault(rule, []).append(profile)
    rules = list(users)
    chosen = build(rules[-1])
    for rule in rules[:-1]:
        chosen = F.when(F.col("profile").isin(users[rule]), build(rule)).otherwise(chosen)
    return chosen


def raw_sheet_names(sheets: DataFrame, naming: dict[str, Naming] | Naming) -> DataFrame:
    """Add the label of each sheet's coverage and its rendered, prefixed name before collisions are resolved."""

    def label(rule: Naming) -> Column:
        return sheet_label(F.col("kind"), F.col("first"), F.col("last"), F.col("precision"), rule.month_format)

    def name(rule: Naming) -> Column:
        tokens = {
            "source": F.col("alias"),
            "source_stem": F.col("stem"),
            "profile": F.col("profile"),
            "period_label": F.col("__label"),
            "sheet_index": F.col("sheet_index"),
            "part_index": F.coalesce(F.col("part_index"), F.lit(1)),
        }
        templates = {"single": rule.single_worksheet, "overflow": rule.overflow_worksheet}
        text = None
        for kind, template in templates.items():
            hit = F.col("kind") == kind
            if kind == "single":
                tokens_here = {k: v for k, v in tokens.items() if k != "part_index"}
                text = F.when(hit, render(template, tokens_here, NUMBERS))
            else:
                text = text.when(hit, render(template, tokens, NUMBERS))
        return prefixed(rule.prefix, text.otherwise(render(rule.worksheet, tokens, NUMBERS)))

    covered = F.col("first").isNotNull() | (F.col("kind") == "undated")
    return (
        sheets.withColumn("part_index", F.when(F.col("kind") == "overflow", F.col("part") + 1))
        .withColumn("__label", _by_profile(naming, label))
        .withColumn("sheet", _by_profile(naming, name))
        .withColumn("period_label", F.when(covered, F.col("__label")))
        .drop("__label")
    )


def claim_names(names: list[str]) -> list[str]:
    """Give repeated names ``_2``, ``_3`` and so on in order, shortening the stem, clear of every name given so far.

    A number that was taken once stays taken, so the search for a name goes on where the last one for its like ended.
    """
    taken: set[str] = set()
    reached: dict[str, int] = {}
    out = []
    for name in names:
        given, n = name, 1
        if name.lower() in taken:
            like = name.lower() if name.isascii() else name  # other letters may change their number or form with the case
            n = reached.get(like, 1)
            while given.lower() in taken:
                n += 1
                given = name[: SHEET_NAME_LIMIT - len(f"_{n}")] + f"_{n}"
            reached[like] = n
        taken.add(given.lower())
        out.append(given)
    return out


def resolve_collisions(sheets: DataFrame, suffix: Column) -> DataFrame:
    """Settle sheet names that repeat within a workbook, compared without case; adds ``collision``.

    Only workbooks in which a name repeats go through the sequential claim; a workbook's cell budget bounds its sheets.
    """
    marked = sheets.withColumn("__same", F.count("*").over(Window.partitionBy(*BOOK, F.lower("sheet"))))
    marked = marked.withColumn("__settle", suffix & (F.max("__same").over(Window.partitionBy(*BOOK)) > 1))
    marked = marked.withColumn("collision", (F.col("__same") > 1) & ~F.col("__settle")).drop("__same")

    def settle_book(book: pa.Table) -> pa.Table:
        book = book.sort_by("sheet_index")
        at = book.schema.get_field_index("sheet")
        return book.set_column(at, book.schema.field(at), pa.array(claim_names(book["sheet"].to_pylist()), book.schema.field(at).type))

    clean = marked.where(~F.col("__settle"))
    settled = marked.where("__settle").groupBy(*BOOK).applyInArrow(settle_book, marked.schema)
    return clean.unionByName(settled).drop("__settle")


def name_plan(sheets: DataFrame, naming: dict[str, Naming] | Naming) -> DataFrame:
    """Add ``workbook, sheet, period_label, part_index`` and ``problem``, the first thing wrong with a name."""
    rendered = raw_sheet_names(with_workbook_name(with_workbook_label(sheets, naming), naming), naming)
    rendered = materialise(rendered.withColumn("__invalid", worksheet_problem(F.col("sheet"))))
    settled = resolve_collisions(rendered, _by_profile(naming, lambda rule: F.lit(rule.collision == "suffix")))
    problem = F.coalesce("__invalid", F.when(F.col("collision"), "collision"), "workbook_problem")
    return settled.withColumn("problem", problem).drop("__invalid", "collision", "workbook_problem", "workbook_label")
