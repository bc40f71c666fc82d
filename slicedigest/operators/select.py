"""Deciding what is out of date, what a run may touch and what it would replace, over records alone."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.digests import ALGORITHM, VERSION
from slicedigest.functions.kinds import require_instants
from slicedigest.operators.convert import CONVERSION, CONVERSION_VERSION

# Fixed values of the layout.
REPORTS = "reports"
MANIFEST_SUFFIX = ".manifest.json"
RECEIPT_SUFFIX = ".receipt.json"
LOCK_SUFFIX = ".lock"
PLANNER_VERSION = "1"


def same_second(left: Column, right: Column) -> Column:
    """Compare instants without what stores keep below the second."""
    return F.date_trunc("second", left) == F.date_trunc("second", right)


def _later(left: Column, right: Column) -> Column:
    return F.date_trunc("second", left) > F.date_trunc("second", right)


def _fired(*signals: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), F.lit(name)) for test, name in signals]))


def conversion_record(conversions: Column, identifier: str = CONVERSION) -> Column:
    """Return the record of one conversion from a description's list, found by identifier; null when absent."""
    return F.try_element_at(F.filter(conversions, lambda c: c["id"] == identifier), F.lit(1))


def stale_sources(sources: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Return each source with the signals that call for describing it again.

    ``sources``: ``alias, path, modified``. ``descriptions``: ``path, modified, described, conversions`` with
    ``conversions`` an array of ``id, version, algorithm, hasher_version``; an unreadable one counts as missing.
    A source is changed when its time differs at all: a restored older file is a change too.
    """
    require_instants(sources.schema, ["modified"])
    require_instants(descriptions.schema, ["modified", "described"])
    record = conversion_record(F.col("conversions"))
    d = descriptions.select(
        "path", F.col("modified").alias("__recorded"), "described", record.alias("__record"), F.lit(True).alias("__known")
    )
    both = sources.join(d, "path", "left")
    known = F.coalesce("__known", F.lit(False))
    current_hash = (F.col("__record.algorithm") == ALGORITHM) & (F.col("__record.hasher_version") == VERSION)
    signals = F.when(~known, F.array(F.lit("sidecar-missing-or-unreadable"))).otherwise(
        _fired(
            (~same_second(F.col("modified"), F.col("__recorded")), "source-changed"),
            (~F.coalesce(F.col("__record.version") == CONVERSION_VERSION, F.lit(False)), "conversion-version"),
            (~F.coalesce(current_hash, F.lit(False)), "hasher-version"),
        )
    )
    return both.select(*sources.columns, "described", signals.alias("signals"))


def stale_profiles(
    members: DataFrame, source_signals: DataFrame, receipts: DataFrame, current: DataFrame, planner_version: str = PLANNER_VERSION
) -> DataFrame:
    """Return every profile with its own signals, all distinct reasons in the order checked, and whether it is stale.

    ``members``: ``profile, source_pos, alias``. ``source_signals``: from ``stale_sources``. ``receipts``: ``profile,
    exported, config_hash, planner_version``. ``current``: ``profile, config_modified, config_hash, forced``.
    """
    require_instants(receipts.schema, ["exported"])
    require_instants(current.schema, ["config_modified"])
    # A profile keeps only the first place each signal was seen at, so any number of sources comes down to four records.
    seen = members.join(source_signals.select("alias", "signals", "described"), "alias", "left").select(
        "profile", "source_pos", "described", F.posexplode_outer("signals").alias("at", "signal")
    )
    firsts = seen.groupBy("profile", "signal").agg(F.min(F.struct("source_pos", "at")).alias("first"), F.max("described").alias("described"))
    listed = F.array_sort(F.collect_list(F.when(F.col("signal").isNotNull(), F.struct("first", "signal"))))
    sources = firsts.groupBy("profile").agg(F.transform(listed, lambda s: s["signal"]).alias("theirs"), F.max("described").alias("__described"))
    r = receipts.select(
        "profile",
        "exported",
        F.col("config_hash").alias("__receipt_hash"),
        F.col("planner_version").alias("__receipt_planner"),
        F.lit(True).alias("__has_receipt"),
    )
    all_ = current.join(sources, "profile", "left").join(r, "profile", "left")
    has = F.coalesce("__has_receipt", F.lit(False))
    own = _fired(
        (F.col("forced"), "forced"),
        (~has, "no-receipt"),
        (has & _later(F.col("__described"), F.col("exported")), "described-after-export"),
        (has & _later(F.col("config_modified"), F.col("exported")), "config-modified"),
        (has & (F.col("config_hash") != F.col("__receipt_hash")), "resolved-config-hash"),
        (has & (F.col("__receipt_planner") != planner_version), "planner-version"),
    )
    theirs = F.coalesce("theirs", F.array().cast("array<string>"))
    decided = all_.select("profile", own.alias("signals"), F.array_distinct(F.concat(own, theirs)).alias("reasons"))
    return decided.withColumn("stale", F.size("reasons") > 0)


def config_hash(options: object) -> str:
    """Return the fingerprint of options given as plain values: compact JSON with sorted keys, hashed with SHA-256."""
    return hashlib.sha256(json.dumps(options, sort_keys=True, separators=(",", ":"), ensure_ascii=False).encode()).hexdigest()


def canonical_map(values: Column) -> Column:
    """Render a map column as JSON with its keys in order."""
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(values))))


def fingerprint(values: Column) -> Column:
    """Return the SHA-256 of a map column's canonical JSON: `config_hash` for options that are rows of a table."""
    return F.sha2(canonical_map(values), 256)


def keep_set(profiles: DataFrame, workbooks: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Return ``profile, name``: what a publish must not delete. Of a nested name the first segment counts."""
    listed = workbooks.select("profile", "name").unionByName(sidecars.select("profile", "name"))
    own = [F.concat("profile", F.lit(s)) for s in (MANIFEST_SUFFIX, RECEIPT_SUFFIX, LOCK_SUFFIX)]
    books = profiles.select("profile", F.explode(F.array(*own, F.lit(REPORTS))).alias("name"))
    return listed.select("profile", F.substring_index("name", "/", 1).alias("name")).unionByName(books).distinct()


def delete_set(listing: DataFrame, keep: DataFrame) -> DataFrame:
    """Return what lies in a profile's folder and is no longer part of it. Deleting is left to the caller."""
    return listing.select("profile", "name").join(keep, ["profile", "name"], "left_anti")


def ownership(current: DataFrame, receipts: DataFrame, listing: DataFrame) -> DataFrame:
    """Return why a profile's folder is not its own, or null.

    ``current``: ``profile, config_id``; ``receipts``: ``profile`` (whose folder), ``config_id, owner``; ``listing``:
    ``profile, name``.
    """
    r = receipts.select("profile", F.col("config_id").alias("__id"), F.col("owner").alias("__owner"), F.lit(True).alias("__has"))
    ignored = (F.col("name") == REPORTS) | (F.col("name") == F.concat("profile", F.lit(LOCK_SUFFIX)))
    files = listing.where(~ignored).groupBy("profile").agg(F.count("*").alias("unexplained"))
    both = current.join(r, "profile", "left").join(files, "profile", "left")
    has = F.coalesce("__has", F.lit(False))
    reason = F.when(has & ((F.col("__id") != F.col("config_id")) | (F.col("__owner") != F.col("profile"))), "foreign-receipt").when(
        ~has & (F.coalesce("unexplained", F.lit(0)) > 0), "files-without-receipt"
    )
    return both.select("profile", reason.alias("reason"))


def instants_in_zones(instant: Column, zones: list[str]) -> Column:
    """Return an instant's wall clock in each zone, keyed by zone."""
    names = F.array(*[F.lit(z) for z in zones])
    return F.map_from_arrays(names, F.array(*[F.from_utc_timestamp(instant, z) for z in zones]))
