"""One run over profiles: select, export, write, verify, report, and the receipt last."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slicedigest.operators.describe import describe_many
from slicedigest.operators.export import Export, arrange, check_refusals, export, make_plan
from slicedigest.operators.report import run_report
from slicedigest.operators.select import PLANNER_VERSION, config_hash, delete_set, keep_set, ownership, stale_profiles, stale_sources
from slicedigest.operators.verify import reassembly, verify_fragments
from slicedigest.options import DateColumn, Profile, check_profiles
from slicedigest.runtime import materialise
from slicedigest.sources import records
from slicedigest.sources.parquet import read_source
from slicedigest.sources.xlsx import read_back_sheets, read_workbooks, write_workbooks


@dataclass(frozen=True)
class Source:
    """A Parquet source of a run and the date columns registered for it."""

    path: str
    date_columns: dict[str, DateColumn] = field(default_factory=dict)


@dataclass(frozen=True)
class Run:
    """What a run decided and did. ``reports`` has a row per profile that was out of date, ``selection`` one per profile."""

    selection: DataFrame
    reports: DataFrame
    published: tuple[str, ...]


REPORT = (
    "profile string, total_rows bigint, total_cells bigint, sheets bigint, failed bigint, rows_match boolean, "
    "sources array<struct<alias:string,sheets:bigint,rows_found:bigint,rows_expected:bigint,failed:bigint>>, workbooks bigint, "
    "reasons array<string>, outcome string, error string, generated timestamp"
)
PUBLISHED, FAILED, PLANNED, UNSOUND = "published", "failed", "planned", "verification-failed"
"""Outcomes: sound and published, refused or broken off, planned by a dry run, written but not found whole."""
DESCRIPTIONS, REPORTS = "descriptions", "reports"


def refresh_descriptions(spark: SparkSession, sources: dict[str, Source], folder: str, write: bool = True) -> DataFrame:
    """Return current descriptions of the sources; those that are missing, changed or of an older version are made anew.

    The file times of a source are listed each time; only stale sources are read. Descriptions stay below ``folder``. A source
    that is not there has a description that says so; it is looked for again each time.
    """
    path = f"{folder}/{DESCRIPTIONS}"
    known = records.read_records(spark, path, records.DESCRIPTION)[0] if records.place(spark, path) else None
    every = {s.path for s in sources.values()}
    paths = {p for p in every if records.matches(spark, p)}
    if known is not None:
        known = materialise(known.where(F.col("error").isNull() & F.col("path").isin(sorted(paths))))
    if known is not None and paths:
        times = [
            spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(p).agg(F.max("modificationTime").alias("modified")).select(F.lit(p).alias("path"), "modified")
            for p in sorted(paths)
        ]
        now = times[0]
        for more in times[1:]:
            now = now.unionByName(more)
        found = stale_sources(now.select(F.col("path").alias("alias"), "path", "modified"), known)
        stale = {r["path"] for r in found.where(F.size("signals") > 0).select("path").collect()}  # a row per source
    else:
        stale = paths
    if not stale and every == paths:
        return known
    made = describe_many(spark, sorted(stale | (every - paths)))
    whole = made if known is None else made.unionByName(known.where(~F.col("path").isin(sorted(stale))).select(made.columns))
    whole = materialise(whole)
    if write:
        records.write_records(whole, path)
    return whole


def resolved(profile: Profile, sources: dict[str, Source]) -> dict:
    """Return all that decides what a profile publishes: its own options, and the paths and date columns of its sources."""
    kinds = {s.source: {c: type(d).__name__ for c, d in sources[s.source].date_columns.items()} for s in profile.sheets}
    return {"profile": asdict(profile), "sources": {s.source: asdict(sources[s.source]) for s in profile.sheets}, "date_kinds": kinds}


def run(
    spark: SparkSession,
    profiles: list[Profile],
    sources: dict[str, Source],
    folder: str,
    forced: frozenset[str] = frozenset(),
    writer: Callable[[Export, str], None] = write_workbooks,
    config_id: str | None = None,
    dry_run: bool = False,
) -> Run:
    """Rebuild the profiles that are out of date below ``folder``.

    Sources are described where needed, stale profiles are exported into a folder of their own, read back and judged. A profile
    whose sheets are all valid and add up to their sources is published: manifest, sources, and the receipt last, which names
    the folder; earlier exports are then deleted. Any other leaves its report only, and the receipt and files of the last good
    export stay as they were.

    A profile that cannot be exported, be it for its data, its source, its names or an error while writing, gets a report with
    the outcome ``failed`` and does not stop the others. So does one whose folder is not its own: the receipt there belongs to
    another configuration (``config_id``, the profile's name by default) or owner, or there is no receipt but files that no run
    has announced. Every export is announced by an empty file before it is written, so what a lost run leaves is known and
    goes with the next publication; files that nobody announced are never deleted.

    A dry run gives the same selection and a report of what would be written, and writes nothing below ``folder``. One run may
    work on a folder at a time. Profiles or sources that contradict each other raise before anything is read.
    """
    check_profiles(sources, profiles)
    if taken := sorted({p.name for p in profiles} & {DESCRIPTIONS, REPORTS}):
        raise ValueError(f"profile name {taken[0]!r} is that of a folder of the run itself")
    descriptions = refresh_descriptions(spark, sources, folder, write=not dry_run)
    by_alias = spark.createDataFrame([(a, s.path) for a, s in sources.items()], "alias string, path string")
    described = materialise(by_alias.join(descriptions.where("error IS NULL"), "path").select("alias", "path", "modified", "described", "conversions"))
    signals = stale_sources(by_alias.join(described.select("alias", "modified"), "alias", "left"), described.drop("alias"))
    members = spark.createDataFrame([(p.name, n, s.source) for p in profiles for n, s in enumerate(p.sheets)], "profile string, source_pos int, alias string")
    receipts = _receipts(spark, [p.name for p in profiles], folder)
    hashes = {p.name: config_hash(resolved(p, sources)) for p in profiles}
    options = [(p.name, None, hashes[p.name], p.name in forced, config_id or p.name) for p in profiles]
    current = spark.createDataFrame(options, "profile string, config_modified timestamp, config_hash string, forced boolean, config_id string")
    selection = materialise(stale_profiles(members, signals, receipts, current.drop("config_id")))
    listed = [(p.name, n) for p in profiles for n in _unannounced(spark, folder, p.name)]
    foreign = ownership(current.select("profile", "config_id"), receipts, spark.createDataFrame(listed, "profile string, name string"))
    refused = {r["profile"]: r["reason"] for r in foreign.where("reason IS NOT NULL").collect()}  # a row per profile
    reports, published = spark.createDataFrame([], REPORT), []
    for row in selection.where("stale").select("profile", "reasons").collect():  # a row per profile
        profile = next(p for p in profiles if p.name == row["profile"])
        job = _Job(spark, profile, sources, folder, hashes[profile.name], row["reasons"], config_id or profile.name)
        if profile.name in refused:
            report = job.failure(refused[profile.name])
        else:
            try:
                report = job.planned() if dry_run else job.rebuilt(described, writer)
            except Exception as error:  # whatever is wrong with one profile is its own report
                report = job.failure(f"{type(error).__name__}: {(str(error).splitlines() or [''])[0][:500]}")
        if not dry_run:
            report.write.mode("append").json(f"{folder}/{REPORTS}/{profile.name}")
        if report.first()["outcome"] == PUBLISHED:
            published.append(profile.name)
            job.reconcile()
        reports = reports.unionByName(report)
    return Run(selection, reports, tuple(published))


def _receipts(spark: SparkSession, names: list[str], folder: str) -> DataFrame:
    """Return the receipts found in the profiles' places, each under the name of its place."""
    found = spark.createDataFrame([], records.RECEIPT).drop("schema_version")
    for name in names:
        if records.place(spark, f"{folder}/{name}.receipt"):
            read = records.read_records(spark, f"{folder}/{name}.receipt", records.RECEIPT)[0]
            found = found.unionByName(read.withColumn("profile", F.lit(name)))
    return materialise(found)


def _announced(spark: SparkSession, folder: str, name: str) -> list[str]:
    return records.names_in(spark, f"{folder}/{name}.exports")


def _unannounced(spark: SparkSession, folder: str, name: str) -> list[str]:
    return sorted(set(records.names_in(spark, f"{folder}/{name}")) - set(_announced(spark, folder, name)))


@dataclass
class _Job:
    """One profile that is out of date."""

    spark: SparkSession
    profile: Profile
    sources: dict[str, Source]
    folder: str
    fingerprint: str
    reasons: list[str]
    config_id: str

    def __post_init__(self) -> None:
        self.started = F.lit(datetime.now(timezone.utc).isoformat()).cast("timestamp")
        self.export_name = uuid.uuid4().hex

    def _reported(self, report: DataFrame) -> DataFrame:
        """The report in its full shape, kept: what it does not say is null."""
        fields = self.spark.createDataFrame([], REPORT).schema
        known = {"profile": F.lit(self.profile.name), "generated": self.started, "reasons": F.array(*[F.lit(r) for r in self.reasons])}
        value = lambda name: F.col(name) if name in report.columns else known.get(name, F.lit(None))
        return materialise(report.select(*[value(f.name).cast(f.dataType).alias(f.name) for f in fields]))

    def failure(self, error: str) -> DataFrame:
        """The report of a profile that could not be exported; what was written of it goes."""
        self._discard(self.export_name)
        return self._reported(self.spark.createDataFrame([(FAILED, error)], "outcome string, error string"))

    def _used(self):
        named = {s.source: self.sources[s.source] for s in self.profile.sheets}
        return {alias: read_source(self.spark, s.path, s.date_columns) for alias, s in named.items()}

    def planned(self) -> DataFrame:
        """The report of an export that was planned only."""
        profile, used = self.profile, self._used()
        counts, inputs, plan = make_plan(profile, {s.source: arrange(used[s.source], s, profile) for s in profile.sheets}, used)
        check_refusals(profile, inputs, counts, plan)
        return self._reported(
            plan.agg(
                F.sum("rows").alias("total_rows"), F.sum("cells").alias("total_cells"), F.count("*").alias("sheets"),
                F.count_distinct("workbook").alias("workbooks"), F.lit(PLANNED).alias("outcome"),
            )
        )

    def rebuilt(self, described: DataFrame, writer: Callable[[Export, str], None]) -> DataFrame:
        """Export, write, read back and judge the profile; publish it if all is well. Returns its report."""
        spark, profile = self.spark, self.profile
        made = export(profile, self._used())
        location = f"{self.folder}/{profile.name}/{self.export_name}"
        records.mark(spark, f"{self.folder}/{profile.name}.exports/{self.export_name}")
        writer(made, location)
        schemas = {alias: a.frame.select(*a.columns).schema for alias, a in made.arranged.items()}
        back = read_back_sheets(read_workbooks(spark, location), schemas, made.fragments)
        verdicts = materialise(verify_fragments(made.fragments, back, every_sheet_seen=True))
        strays = verdicts.where(F.col("kind") == "unexpected").count()
        whole = reassembly(made.fragments, made.sources)
        why = spark.createDataFrame([(profile.name, self.reasons)], "profile string, reasons array<string>")
        sound = whole.where(~F.col("rows_match") | (F.coalesce("reassembly", F.lit("valid")) != "valid")).isEmpty() and strays == 0
        report = run_report(made.fragments, verdicts, made.sources, why)
        report = self._reported(report.withColumn("outcome", F.col("outcome") if sound else F.lit(UNSOUND)))
        if report.first()["outcome"] != PUBLISHED:
            self._discard(self.export_name)
            return report
        stamps = F.map_from_entries(F.collect_list(F.struct("alias", F.struct("modified", "described"))))
        mine = described.where(F.col("alias").isin([s.source for s in profile.sheets]))
        receipt = mine.agg(stamps.alias("sources")).select(
            F.lit(profile.name).alias("profile"), F.lit(profile.name).alias("owner"), F.lit(self.config_id).alias("config_id"), self.started.alias("exported"),
            F.lit(self.fingerprint).alias("config_hash"), F.lit(PLANNER_VERSION).alias("planner_version"), F.lit(location).alias("location"), "sources",
        )
        records.publish_records(made, receipt, self.folder)
        return report

    def reconcile(self) -> None:
        """Delete what announced exports have left beside the one just published."""
        listing = self.spark.createDataFrame([(self.profile.name, n) for n in _announced(self.spark, self.folder, self.profile.name)], "profile string, name string")
        kept = self.spark.createDataFrame([(self.profile.name, self.export_name)], "profile string, name string")
        keep = keep_set(kept.select("profile"), kept, kept.where("false"))
        for row in delete_set(listing, keep).collect():  # a row per earlier export of this profile
            self._discard(row["name"])

    def _discard(self, name: str) -> None:
        records.remove(self.spark, f"{self.folder}/{self.profile.name}/{name}")
        records.remove(self.spark, f"{self.folder}/{self.profile.name}.exports/{name}")
