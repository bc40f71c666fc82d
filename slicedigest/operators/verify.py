"""Checking an export from its records alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.columns import named
from slicedigest.functions.digests import ALGORITHM, VERSION
from slicedigest.operators.convert import CONVERSION_VERSION
from slicedigest.operators.digest import combine, digest_by

SHEET = ["workbook", "sheet"]


def read_back_digests(sheets: DataFrame, columns: list[str], keys: list[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Digest sheets as they were read back: one record per sheet, no row leaves its task."""
    keys = keys or SHEET
    return digest_by(sheets, {k: F.col(k) for k in keys}, columns, kinds, bounded=True)


def missing_rows(actual: DataFrame, manifest: DataFrame) -> DataFrame:
    """Return per sheet the rows read, the rows recorded, and how many trailing empty rows to restore."""
    got = actual.select(*SHEET, F.col("rows").alias("found"))
    both = manifest.select(*SHEET, F.col("rows").alias("expected")).join(got, SHEET, "left")
    found = F.coalesce("found", F.lit(0).cast("bigint"))
    return both.select(
        *SHEET,
        "expected",
        found.alias("found"),
        F.greatest(F.col("expected") - found, F.lit(0).cast("bigint")).alias("missing"),
        (found > F.col("expected")).alias("too_many"),
    )


def blank_rows(missing: DataFrame, schema: T.StructType) -> DataFrame:
    """Return the all-null rows sheets are short of, one record per missing row."""
    one = F.lit(1).cast("bigint")
    rows = missing.where(F.col("missing") > 0).select(*SHEET, F.explode(F.sequence(one, F.col("missing"))).alias("__n"))
    return rows.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields], *SHEET)


def pad_sheets(sheets: DataFrame, manifest: DataFrame, columns: list[str]) -> DataFrame:
    """Return sheets as read plus the trailing all-null rows each is short of; the rows read are not touched."""
    counted = sheets.groupBy(*SHEET).agg(F.count("*").alias("rows"))
    kept = sheets.select(*[named(c) for c in columns], *SHEET)
    schema = T.StructType(kept.schema.fields[: len(columns)])
    return kept.unionByName(blank_rows(missing_rows(counted, manifest), schema))


def verdict_kind(expected: Column, actual: Column) -> Column:
    """Return the verdict of a sheet from its two records; the first thing wrong decides.

    ``expected`` and ``actual`` are structs; ``actual`` is null when the sheet was not found and has ``unreadable`` set
    when cells did not fit or rows were too many.
    """
    return (
        F.when((expected["algorithm"] != ALGORITHM) | (expected["version"] != VERSION), "unsupported-hasher")
        .when(actual.isNull(), "workbook-missing")
        .when(F.coalesce(actual["unreadable"], F.lit(False)) & actual["header"].isNull(), "workbook-unreadable")
        .when(~expected["header"].eqNullSafe(actual["header"]), "columns-differ")
        .when(F.coalesce(actual["unreadable"], F.lit(False)), "workbook-unreadable")
        .when(expected["digest"] != actual["digest"], "digest-mismatch")
        .otherwise("valid")
    )


def verify_fragments(manifest: DataFrame, actual: DataFrame, every_sheet_seen: bool = False) -> DataFrame:
    """Join recorded and read-back sheets and judge each; a sheet nobody recorded is listed as unexpected.

    ``actual``: ``workbook, sheet, header, rows, digest`` and, if known, ``unreadable``. Where a sheet without rows leaves
    nothing to group, ``every_sheet_seen`` is false and such a sheet counts as found.
    """
    if "unreadable" not in actual.columns:
        actual = actual.withColumn("unreadable", F.lit(False))
    zero_digest = F.lit("0" * 32)
    a = actual.select(*SHEET, F.struct("header", "rows", "digest", "unreadable").alias("a"))
    e = manifest.select(*SHEET, "alias", F.struct("header", "rows", "digest", "row_digest", "algorithm", "version").alias("e"))
    both = e.join(a, SHEET, "full_outer")
    # An empty recorded sheet has no rows to group, so its record is made here.
    empty = F.struct(F.col("e.header").alias("header"), F.col("e.rows").alias("rows"), zero_digest.alias("digest"), F.lit(False).alias("unreadable"))
    if not every_sheet_seen:
        both = both.withColumn("a", F.when(F.col("a").isNull() & (F.col("e.rows") == 0), empty).otherwise(F.col("a")))
    kind = F.when(F.col("e").isNull(), "unexpected").otherwise(verdict_kind(F.col("e"), F.col("a")))
    return both.select(
        "alias",
        *SHEET,
        kind.alias("kind"),
        F.col("e.rows").alias("expected_rows"),
        F.col("a.rows").alias("found_rows"),
        F.col("e.digest").alias("expected_digest"),
        F.when(kind.isin("valid", "digest-mismatch"), F.col("a.digest")).alias("actual_digest"),
    )


def reassembly(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """Check, from records only, that each source's fragments add up to its rows and its whole digest.

    ``sources``: ``alias, rows, digest, row_digest`` and, if known, ``conversion_version`` and ``total_and_disjoint``.
    """
    for name, default in (("conversion_version", F.lit(CONVERSION_VERSION)), ("total_and_disjoint", F.lit(True))):
        if name not in sources.columns:
            sources = sources.withColumn(name, default)
    parts = combine(manifest, ["alias"])
    both = sources.select(
        "alias",
        F.col("rows").alias("rows_expected"),
        F.col("digest").alias("expected_digest"),
        F.col("row_digest").alias("expected_row_digest"),
        "conversion_version",
        "total_and_disjoint",
    ).join(parts, "alias", "left")
    rows = F.coalesce("rows", F.lit(0).cast("bigint"))
    kind = (
        F.when(F.col("conversion_version") != CONVERSION_VERSION, "unsupported-conversion")
        .when(~F.col("total_and_disjoint"), F.lit(None))
        .when(F.col("refusal").isNotNull(), "unsupported-hasher")
        .when(F.col("parts").isNull(), "digest-mismatch")
        .when(F.col("digest").eqNullSafe(F.col("expected_digest")) & F.col("row_digest").eqNullSafe(F.col("expected_row_digest")), "valid")
        .otherwise("digest-mismatch")
    )
    return both.select("alias", rows.alias("rows_found"), "rows_expected", (rows == F.col("rows_expected")).alias("rows_match"), kind.alias("reassembly"))


def verify_manifest(manifest: DataFrame, sources: DataFrame, actual: DataFrame, every_sheet_seen: bool = False) -> DataFrame:
    """Return one line per source: sheets checked, sheets that failed, rows and reassembly, and whether all holds."""
    verdicts = verify_fragments(manifest, actual, every_sheet_seen)
    per_source = verdicts.groupBy("alias").agg(F.count("*").alias("sheets"), F.count_if(F.col("kind") != "valid").alias("failed"))
    whole = reassembly(manifest, sources).join(per_source, "alias", "left")
    fine = (F.coalesce("failed", F.lit(0)) == 0) & F.col("rows_match") & F.coalesce(F.col("reassembly") == "valid", F.lit(True))
    return whole.withColumn("valid", fine)


def validate_against_description(description: DataFrame, actual: DataFrame) -> DataFrame:
    """Judge whole outputs against descriptions alone: both keyed by ``path``.

    ``description``: ``path, header, rows, digest, algorithm, version, conversion_version`` with a null digest where the
    source was described without one.
    """
    both = description.select("path", F.struct(*[c for c in description.columns if c != "path"]).alias("e")).join(
        actual.select("path", F.struct("header", "digest").alias("a")), "path", "left"
    )
    kind = (
        F.when(F.col("e.conversion_version").isNull(), "no-excel-digest")
        .when(F.col("e.conversion_version") != CONVERSION_VERSION, "unsupported-conversion")
        .when(F.col("e.digest").isNull(), "no-excel-digest")
        .when((F.col("e.algorithm") != ALGORITHM) | (F.col("e.version") != VERSION), "unsupported-hasher")
        .when(F.col("a").isNull(), "workbook-missing")
        .when(~F.col("e.header").eqNullSafe(F.col("a.header")), "columns-differ")
        .when(F.col("e.digest") != F.col("a.digest"), "digest-mismatch")
        .otherwise("valid")
    )
    return both.select("path", kind.alias("kind"))


def manifest_violations(manifest: DataFrame, workbooks: DataFrame, sources: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Return every broken integrity rule of a manifest as ``rule, subject``; none means it is sound.

    ``workbooks`` and ``sidecars`` list names in ``name``; ``sources`` has ``alias, sidecar``.
    """
    unlisted = manifest.select("workbook").distinct().join(workbooks.select(F.col("name").alias("workbook")), "workbook", "left_anti")
    out = unlisted.select(F.lit("workbook-not-listed").alias("rule"), F.col("workbook").alias("subject"))
    out = out.unionByName(repeated(manifest, [F.lower("workbook"), F.lower("sheet")], "sheet-claimed-twice", F.concat_ws("!", "workbook", "sheet")))
    out = out.unionByName(repeated(workbooks, [F.lower("name")], "workbook-differs-by-case", F.col("name")))
    claimed = sidecars.select(F.lower("name").alias("__name"))
    lost = sources.join(claimed, F.lower("sidecar") == F.col("__name"), "left_anti")
    out = out.unionByName(lost.select(F.lit("sidecar-not-listed").alias("rule"), F.col("sidecar").alias("subject")))
    out = out.unionByName(repeated(sources, [F.lower("alias")], "alias-repeated", F.col("alias")))
    strays = manifest.select("alias").distinct().join(sources.select("alias").distinct(), "alias", "left_anti")
    return out.unionByName(strays.select(F.lit("fragment-of-unknown-source").alias("rule"), F.col("alias").alias("subject")))


def repeated(df: DataFrame, folded: list[Column], rule: str, subject: Column) -> DataFrame:
    """Return names that occur more than once when compared without case; counted before anything is shuffled."""
    seen = df.groupBy(*[c.alias(f"__k{n}") for n, c in enumerate(folded)]).agg(F.count("*").alias("__n"), F.min(subject).alias("subject"))
    return seen.where(F.col("__n") > 1).select(F.lit(rule).alias("rule"), "subject")


def first_failures(verdicts: DataFrame, n: int = 3) -> DataFrame:
    """Return the first ``n`` failed sheets of each source with how many failed in all."""
    failed = verdicts.where(F.col("kind") != "valid")
    counts = failed.groupBy("alias").agg(F.count("*").alias("failed"))
    place = F.row_number().over(Window.partitionBy("alias").orderBy(*SHEET))
    return failed.withColumn("place", place).where(F.col("place") <= n).join(counts, "alias").select("alias", "place", *SHEET, "kind", "failed")
