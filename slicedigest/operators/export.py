"""One profile from its sources to a written, digested and recorded export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.calendar import check_zone, chronology
from slicedigest.functions.columns import free_name, named
from slicedigest.functions.digests import ALGORITHM, VERSION
from slicedigest.functions.kinds import kinds_of
from slicedigest.functions.names import column_problem
from slicedigest.operators.assign import assign_slices, group_keys, split_groups, with_sheet
from slicedigest.operators.bucket import bucket_key, refused_row
from slicedigest.operators.convert import cell_rule
from slicedigest.operators.digest import digest_by, digest_cube, digest_of_cube
from slicedigest.operators.order import FILE, ROW, sort_column
from slicedigest.options import DateColumn, Profile, Sheet
from slicedigest.plans.profile import plan_inputs, plan_profiles, plan_refusals, possible_refusals, profile_options
from slicedigest.runtime import broadcast_if_small, materialise


EXACT_CELLS = 1 << 30
"""Most cells of a sheet whose digests may be added up in one step; more are added per task first."""


class ExportRefused(Exception):
    """The data or the limits do not allow this export; the message names the first reasons."""


@dataclass(frozen=True)
class SourceTable:
    """A source as the export sees it.

    ``ordinal`` names the columns that order the rows uniquely and are not exported: the file and row number of a Parquet
    scan, unless the caller has better ones.
    """

    frame: DataFrame
    stem: str
    date_columns: dict[str, DateColumn]
    ordinal: tuple[str, ...] = (FILE, ROW)
    kinds: dict[str, str] | None = None
    zones: dict[str, str] | None = None

    @property
    def columns(self) -> list[str]:
        return [c for c in self.frame.columns if c not in self.ordinal]


@dataclass(frozen=True)
class OrderKey:
    """A column that orders rows and the direction it sorts in."""

    column: str
    sorted: Callable[[Column], Column]


@dataclass(frozen=True)
class Arranged:
    """Converted columns with, beside them, the key and sort values of the unconverted ones.

    ``counting`` is the narrow view the plan is made from: the key, and the row's refusal if it has one. ``digesting`` has the
    converted columns too, with the names of key and refusal in ``marks``.
    """

    frame: DataFrame
    counting: DataFrame
    digesting: DataFrame
    marks: tuple[str, str]
    columns: list[str]
    key: str | None
    sorts: list[OrderKey]
    grain: str

    @property
    def order(self) -> list[Column]:
        return [s.sorted(named(s.column)) for s in self.sorts]


def arrange(source: SourceTable, sheet: Sheet, profile: Profile) -> Arranged:
    """Convert a source and carry what orders it in one projection.

    The order is decided on source values: a converted boolean, for one, sorts the other way round.
    """
    df, rule = source.frame, profile.partitioning
    if column_problem(source.columns):
        raise ValueError(f"source {sheet.source!r}: {column_problem(source.columns)}")
    kinds = kinds_of(df.select(*[named(c) for c in source.columns]).schema, source.kinds)
    zones = source.zones or {}
    dated = [c.zone for c in source.date_columns.values() if getattr(c, "zone", None)]
    for zone in {*zones.values(), *dated}:
        check_zone(df.sparkSession, zone)
    out = [cell_rule(named(c), kind, zones.get(c, "UTC")).cell.alias(c) for c, kind in kinds.items()]
    taken = list(source.columns)

    def helper(wanted: str, value: Column) -> str:
        name = free_name(taken, wanted)
        taken.append(name)
        out.append(value.alias(name))
        return name

    key = None
    sorts: list[OrderKey] = []
    cells = list(out)
    bucket, refused = F.lit(None).cast("int"), F.lit(None).cast("string")
    if rule.calendar:
        spec = source.date_columns[sheet.partition_column]
        bucket = bucket_key(df, sheet.partition_column, spec, rule.grain)
        refused = refused_row(df, sheet.partition_column, spec, rule.null_dates, F.struct(*[named(c) for c in source.ordinal]))
        key = helper("__key", bucket)
        sorts.append(OrderKey(key, Column.desc_nulls_last if rule.period_order == "descending" else Column.asc_nulls_last))
    for entry in sheet.sort:
        value = named(entry.column)
        if entry.column in source.date_columns:
            value = chronology(value, df.schema[entry.column].dataType, source.date_columns[entry.column])
        sorts.append(OrderKey(helper("__sort", value), partial(sort_column, key=entry)))
    sorts += [OrderKey(helper("__ordinal", named(c)), Column.asc) for c in source.ordinal]
    marks = free_name(source.columns, "__bucket"), free_name(source.columns, "__refused")
    counting = df.select(bucket.alias("key"), refused.alias("refused"))
    digesting = df.select(*cells, bucket.alias(marks[0]), refused.alias(marks[1]))
    return Arranged(df.select(*out), counting, digesting, marks, source.columns, key, sorts, rule.grain)


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def count_sources(profile: Profile, arranged: dict[str, Arranged], digests: bool = False) -> DataFrame:
    """Return ``profile, alias, key, rows, refused`` for every source, materialised: all the plan needs of the rows.

    ``refused`` is the earliest row that stops the export, as JSON. Such a row has no key, so a source shows one at most. With
    ``digests`` the same scan sums up what the rows of each key hash to (`digest_cube`).

    The scan only notes whether a key has such rows: with the least of a struct or text Spark would sort all rows to add them up.
    The earliest is looked for in the sources that have one.
    """
    frames = []
    for alias, a in arranged.items():
        if digests:
            key, refusal = (named(m) for m in a.marks)
            counted = digest_cube(a.digesting, a.columns, {"key": key}, {"clean": refusal.isNull()})
        else:
            counted = a.counting.groupBy("key").agg(F.count("*").alias("rows"), F.min(F.col("refused").isNull()).alias("clean"))
        kept = [c for c in counted.columns if c not in ("key", "rows", "clean")]
        frames.append(counted.select(F.lit(profile.name).alias("profile"), F.lit(alias).alias("alias"), "key", "rows", "clean", *kept))
    counts = materialise(_union(frames))
    stopped = [r["alias"] for r in counts.where(~F.col("clean")).select("alias").distinct().collect()]
    if not stopped:
        return counts.withColumn("refused", F.lit(None).cast("string")).drop("clean")
    least = []
    for alias in stopped:
        first = arranged[alias].counting.where(F.col("refused").isNotNull()).groupBy("key").agg(F.to_json(F.min("refused")).alias("refused"))
        least.append(first.select(F.lit(alias).alias("__alias"), F.col("key").alias("__key"), "refused"))
    found = (F.col("alias") == F.col("__alias")) & F.col("key").eqNullSafe(F.col("__key"))
    return materialise(counts.join(_union(least), found, "left").drop("clean", "__alias", "__key"))


COUNTS = ["profile", "alias", "key", "rows", "refused"]


def source_shapes(counts: DataFrame, sources: dict[str, SourceTable]) -> DataFrame:
    """Return ``alias, stem, columns, rows``; a source without rows keeps its line."""
    spark = counts.sparkSession
    known = spark.createDataFrame([(a, s.stem, len(s.columns)) for a, s in sources.items()], "alias string, stem string, columns int")
    rows = counts.groupBy("alias").agg(F.sum("rows").alias("rows"))
    return known.join(rows, "alias", "left").select("alias", "stem", "columns", F.coalesce("rows", F.lit(0).cast("bigint")).alias("rows"))


def make_plan(
    profile: Profile, arranged: dict[str, Arranged], sources: dict[str, SourceTable], digests: bool = False
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Return the counts, the plan inputs and the named plan, all materialised and none of them row-sized."""
    counts = count_sources(profile, arranged, digests)
    spark = counts.sparkSession
    used = {sheet.source: sources[sheet.source] for sheet in profile.sheets}
    inputs = materialise(plan_inputs(profile_options(spark, [profile]), source_shapes(counts, used)))
    rule = profile.partitioning
    across = {"calendar"} if rule.calendar else {rule.balance_across}
    return counts, inputs, materialise(plan_profiles(inputs, counts.select(COUNTS), profile.naming, across))


def preview(profile: Profile, sources: dict[str, SourceTable]) -> DataFrame:
    """Return the plan a run would write, having written nothing."""
    return make_plan(profile, {s.source: arrange(sources[s.source], s, profile) for s in profile.sheets}, sources)[2]


def check_refusals(profile: Profile, inputs: DataFrame, counts: DataFrame, plan: DataFrame) -> None:
    """Raise for the first row that refuses, a plan that cannot be made, or a name that is not allowed."""
    rows = counts.where(F.col("refused").isNotNull()).select("alias", "refused").collect()  # one per source at most
    if rows:
        columns = {s.source: s.partition_column for s in profile.sheets}
        raise ExportRefused("; ".join(f"source {r['alias']!r} column {columns[r['alias']]!r}: {r['refused']}" for r in rows))
    reasons = plan_refusals(inputs, counts, possible_refusals(profile))
    _refuse(reasons, F.concat(F.col("alias"), F.lit(": "), F.col("reason"), F.lit(" at "), F.coalesce(F.col("key").cast("string"), F.lit("all"))))
    bad = plan.where(F.col("problem").isNotNull())
    _refuse(bad, F.concat(F.col("workbook"), F.lit("!"), F.col("sheet"), F.lit(": "), F.col("problem")))


SHOWN = 5
"""Reasons a refusal spells out; it gives the number of all of them."""


def _refuse(rows: DataFrame, text: Column) -> None:
    first = rows.select(text.alias("text")).orderBy("text").limit(SHOWN).collect()
    if first:
        count = rows.count() if len(first) == SHOWN else len(first)
        shown = "; ".join(r["text"] for r in first)
        raise ExportRefused(shown if count <= SHOWN else f"{shown}; {count} in all")


@dataclass(frozen=True)
class Placed:
    """A source's rows with their sheet, those among them whose sheet holds only some rows of its keys, and for the other
    sheets the cube's keys that they hold: ``workbook, sheet, key``, without ``key`` where one sheet holds all."""

    rows: DataFrame
    cut: DataFrame | None
    whole: DataFrame | None


def place_rows(profile: Profile, alias: str, arranged: Arranged, plan: DataFrame) -> Placed:
    """Return one source's arranged rows with ``workbook, sheet, sheet_index``."""
    mine = plan.where(F.col("alias") == alias)
    facts = mine.agg(F.count("*").alias("sheets"), F.bool_or(F.col("kind") == "single").alias("single"), F.max("parts").alias("parts")).first()
    if profile.partitioning.calendar and not facts["single"]:
        fitting, ranked = split_groups(arranged.frame, mine, arranged.key, arranged.order, arranged.grain, (facts["parts"] or 1) > 1)
        keys = group_keys(mine, arranged.grain).where("parts = 1").select("key", "group_no")
        whole = keys.join(mine.where("part = 0").select("group_no", "workbook", "sheet"), "group_no").select("workbook", "sheet", "key")
        rows = with_sheet(fitting, mine)
        if ranked is None:
            return Placed(rows, None, whole)
        cut = with_sheet(ranked, mine)
        return Placed(rows.unionByName(cut), cut, whole)
    books = not profile.partitioning.calendar and not facts["single"] and profile.partitioning.balance_across == "workbooks"
    rows = with_sheet(assign_slices(arranged.frame, mine, arranged.order, profile.limits.rows, books), mine)
    if facts["sheets"] == 1:
        return Placed(rows, None, mine.select("workbook", "sheet"))
    return Placed(rows, rows, None)


def fragment_digests(alias: str, arranged: Arranged, placed: Placed, cube: DataFrame, bounded: bool) -> DataFrame:
    """Return the digest of every sheet of one source: from the cube's sums where sheets hold whole keys, else from its rows."""
    sheet, found = ["workbook", "sheet"], []
    if placed.whole is not None:
        mine = cube.where(F.col("alias") == alias)
        if "key" in placed.whole.columns:
            keys = placed.whole.withColumnRenamed("key", "__covered")
            held = mine.join(broadcast_if_small(keys), F.col("key").eqNullSafe(F.col("__covered")))
        else:
            held = mine.crossJoin(F.broadcast(placed.whole))  # one row
        found.append(digest_of_cube(held, sheet))
    if placed.cut is not None:
        found.append(digest_by(placed.cut, {c: F.col(c) for c in sheet}, arranged.columns, bounded=bounded))
    return _union(found).withColumn("alias", F.lit(alias))


@dataclass(frozen=True)
class Export:
    """A planned and digested export. ``placed`` holds each source's rows with their sheet, ready to write."""

    profile: Profile
    plan: DataFrame
    fragments: DataFrame
    sources: DataFrame
    placed: dict[str, DataFrame]
    arranged: dict[str, Arranged]


def export(profile: Profile, sources: dict[str, SourceTable], check: bool = True) -> Export:
    """Plan a profile, give every row its sheet, and digest every sheet and every whole source.

    One scan counts the rows of each calendar key and sums up what they hash to. Sheets of whole keys add these sums up along
    the plan, so no row is hashed again for them; rows are read once more only where a key is cut into several sheets. The
    digest of a whole source adds up all of its keys, planned or not: keys that the plan misses or takes twice show as a
    difference to the sum of the fragments.
    """
    arranged = {s.source: arrange(sources[s.source], s, profile) for s in profile.sheets}
    counts, inputs, plan = make_plan(profile, arranged, sources, digests=True)
    if check:
        check_refusals(profile, inputs, counts, plan)
    placed = {alias: place_rows(profile, alias, a, plan) for alias, a in arranged.items()}
    bounded = profile.limits.cells <= EXACT_CELLS
    digests = [fragment_digests(alias, arranged[alias], p, counts, bounded) for alias, p in placed.items()]
    fragments = materialise(record_fragments(plan, _union(digests), arranged))
    return Export(profile, plan, fragments, whole_digests(counts, list(arranged)), {a: p.rows for a, p in placed.items()}, arranged)


def whole_digests(cube: DataFrame, aliases: list[str]) -> DataFrame:
    """Return ``alias, rows, digest`` and so on of every source; one without rows hashes to zero."""
    known = cube.sparkSession.createDataFrame([(a,) for a in aliases], "alias string")
    return digest_of_cube(known.join(cube, "alias", "left"), ["alias"])


def record_fragments(plan: DataFrame, digests: DataFrame, arranged: dict[str, Arranged]) -> DataFrame:
    """Return the manifest's fragment rows: the plan with what each sheet hashes to. An empty sheet hashes to zero."""
    header = F.lit(None).cast("array<string>")
    for alias, a in arranged.items():
        header = F.when(F.col("alias") == alias, F.array(*[F.lit(c) for c in a.columns])).otherwise(header)
    zero = F.lit("0" * 32)
    found = digests.select("alias", "workbook", "sheet", "digest", "row_digest", "algorithm", "version", "scope")
    return plan.join(found, ["alias", "workbook", "sheet"], "left").select(
        "profile",
        "alias",
        "workbook",
        "sheet",
        "workbook_index",
        "sheet_index",
        "kind",
        "period_label",
        "part_index",
        "rows",
        "cells",
        header.alias("header"),
        F.coalesce("digest", zero).alias("digest"),
        F.coalesce("row_digest", zero).alias("row_digest"),
        F.coalesce("algorithm", F.lit(ALGORITHM)).alias("algorithm"),
        F.coalesce("version", F.lit(VERSION)).alias("version"),
        F.coalesce("scope", F.lit("dataframe")).alias("scope"),
    )
