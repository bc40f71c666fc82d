"""Additive digests of columns, rows, fragments and whole tables.

Every aggregate is a sum, so Spark combines it before the shuffle and a hot group costs one small record per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.columns import named
from slicedigest.functions.digests import (
    ALGORITHM,
    LIMBS,
    VERSION,
    carry,
    cell_lanes,
    from_hex,
    limbs_of,
    quoted,
    row_lanes,
    to_hex,
)
from slicedigest.functions.kinds import kinds_of


def _identity(frame: DataFrame, scope: str) -> DataFrame:
    return frame.withColumns({"algorithm": F.lit(ALGORITHM), "version": F.lit(VERSION), "scope": F.lit(scope)})


def _lanes(df: DataFrame, columns: Sequence[str], keys: Sequence[Column], kinds: dict[str, str] | None) -> tuple[DataFrame, list[str]]:
    found = kinds_of(df.select(*[named(c) for c in columns]).schema, {k: v for k, v in (kinds or {}).items() if k in columns})
    cells: list[Column] = []
    for n, name in enumerate(columns):
        hi, lo = cell_lanes(quoted(name), found[name])
        cells += [F.expr(f"{hi} AS __hi{n}"), F.expr(f"{lo} AS __lo{n}")]
    key_names = [f"__key{n}" for n in range(len(keys))]
    return df.select(*[key.alias(name) for key, name in zip(keys, key_names)], *cells), key_names


def row_limbs(df: DataFrame, columns: Sequence[str], keys: dict[str, Column], kinds: dict[str, str] | None = None) -> DataFrame:
    """Return keys plus ``__f0..3`` (all cells and the row) and ``__r0..3`` (the row) for each row."""
    hashed, key_names = _lanes(df, columns, list(keys.values()), kinds)
    width = len(columns)
    row = row_lanes([f"__hi{n}" for n in range(width)], [f"__lo{n}" for n in range(width)])
    hashed = hashed.select("*", *[F.expr(f"{text} AS __{side}{width}") for text, side in zip(row, ("hi", "lo"))])
    parts = [limbs_of(f"__hi{n}", f"__lo{n}") for n in range(width + 1)]
    frame_limbs = [F.expr(" + ".join(cell[limb] for cell in parts) + f" AS __f{limb}") for limb in range(LIMBS)]
    row_only = [F.expr(f"{parts[width][limb]} AS __r{limb}") for limb in range(LIMBS)]
    return hashed.select(*[F.col(k).alias(name) for k, name in zip(key_names, keys)], *frame_limbs, *row_only)


def _sums(prefixes: Sequence[str]) -> list[Column]:
    return [F.expr(f"coalesce(sum({p}{n}), 0L) AS {p}{n}") for p in prefixes for n in range(LIMBS)]


def _carried(prefix: str) -> list[str]:
    return carry([f"{prefix}{n}" for n in range(LIMBS)])


def _hex(prefix: str, name: str, only_if: str = "true") -> Column:
    return F.expr(f"CASE WHEN {only_if} THEN {to_hex(_carried(prefix))} END AS {name}")


def sum_row_limbs(limbs: DataFrame, keys: Sequence[str], bounded: bool) -> DataFrame:
    """Add row limbs up per key and render both digests.

    A bigint limb sum is exact for 2^31 / (columns + 1) rows. Sheets stay far below that (``bounded``). Anything else is
    added per task first and carried back to 32 bits, so the second sum is over one small record per task and key.
    """
    if not bounded:
        task = limbs.withColumn("__task", F.spark_partition_id())
        partial = task.groupBy(*keys, "__task").agg(F.count("*").alias("rows"), *_sums(["__f", "__r"]))
        limbs = partial.select(
            *keys,
            "rows",
            *[F.expr(f"{c} AS __f{n}") for n, c in enumerate(_carried("__f"))],
            *[F.expr(f"{c} AS __r{n}") for n, c in enumerate(_carried("__r"))],
        )
        count = F.coalesce(F.sum("rows"), F.lit(0).cast("bigint"))
    else:
        count = F.count("*")
    total = limbs.groupBy(*keys).agg(count.alias("rows"), *_sums(["__f", "__r"]))
    return total.select(
        *keys,
        "rows",
        _hex("__f", "digest"),
        _hex("__r", "row_digest"),
    )


def digest_by(
    df: DataFrame,
    keys: dict[str, Column],
    columns: Sequence[str],
    kinds: dict[str, str] | None = None,
    bounded: bool = False,
) -> DataFrame:
    """Return the row count, frame digest and row digest of every key group."""
    return _identity(sum_row_limbs(row_limbs(df, columns, keys, kinds), list(keys), bounded), "dataframe")


def digest_frame(df: DataFrame, columns: Sequence[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return one row: the digest of the whole table. An empty table digests to zero."""
    return digest_by(df, {}, columns or df.columns, kinds)


def digest_cube(
    df: DataFrame,
    columns: Sequence[str],
    keys: dict[str, Column],
    least: dict[str, Column] | None = None,
    kinds: dict[str, str] | None = None,
) -> DataFrame:
    """Return per key ``rows``, the digest of its rows as limb sums that still add up, and the least of other columns.

    Sums per key can be added along any grouping of the keys (`digest_of_cube`), so one scan serves every digest of whole keys:
    of sheets, of workbooks and of the table. Each task's sums are carried back to 32 bits before they meet, so no number of
    rows overflows them.
    """
    least = least or {}
    limbs = row_limbs(df, columns, {**keys, **least}, kinds).withColumn("__task", F.spark_partition_id())
    names, smallest = list(keys), [F.min(c).alias(c) for c in least]
    sums = [F.expr(f"{c} AS {p}{n}") for p in CUBE for n, c in enumerate(_carried(p))]
    partial = limbs.groupBy(*names, "__task").agg(F.count("*").alias("rows"), *smallest, *_sums(CUBE)).select(*names, "rows", *least, *sums)
    total = partial.groupBy(*names).agg(F.sum("rows").alias("rows"), *smallest, *_sums(CUBE))
    return total.select(*names, "rows", *least, *sums)


CUBE = ("__f", "__r")
"""Prefixes of the limbs of a cube: of all cells and the row, and of the row alone."""


def digest_of_cube(cube: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``rows`` and both digests per key, added up from the cells of a `digest_cube`; exact for 2^31 cells a key."""
    total = cube.groupBy(*keys).agg(F.coalesce(F.sum("rows"), F.lit(0).cast("bigint")).alias("rows"), *_sums(CUBE))
    return _identity(total.select(*keys, "rows", _hex("__f", "digest"), _hex("__r", "row_digest")), "dataframe")


def blank_digests(sheets: DataFrame, width: Column | int, count: str = "missing") -> DataFrame:
    """Return each row's digest of ``count`` all-null rows of ``width`` columns, without making the rows.

    A null has one digest whatever its type, so a blank row's limbs follow from its width alone and are multiplied by the count,
    sixteen bits of it at a time, so that no count overflows them. ``width`` may be a column; its different values are
    collected, one per shape of a source.
    """
    if isinstance(width, int):
        widths, chosen = [width], None
    else:
        sheets = sheets.withColumn("__width", width)
        widths, chosen = [r["__width"] for r in sheets.select("__width").distinct().orderBy("__width").collect()], "__width"
    one = []
    for prefix, of in (("__f", _blank_frame), ("__r", _blank_row)):
        for limb in range(LIMBS):
            if chosen is None:
                value = of(widths[0])[limb]
            else:
                value = "CASE " + " ".join(f"WHEN {chosen} = {w} THEN {of(w)[limb]}" for w in widths) + " END" if widths else "0L"
            one.append(F.expr(f"{value} AS __one{prefix}{limb}"))
    kept = [c for c in sheets.columns if c not in ("__width",)]
    scaled = sheets.select(*kept, *one, *[F.lit(0).cast("bigint").alias(f"{p}{n}") for p in CUBE for n in range(LIMBS)])
    # A limb of one row is below 2^32 times the width and one, which leaves room for a digit of 16 bits and a carry.
    for shift in (48, 32, 16, 0):
        digit = f"(shiftright(cast(`{count}` AS bigint), {shift}) & 65535L)"
        sums = [carry([f"({p}{n} * 65536L + __one{p}{n} * {digit})" for n in range(LIMBS)]) for p in CUBE]
        held = [f"__one{p}{n}" for p in CUBE for n in range(LIMBS)]
        scaled = scaled.select(*kept, *held, *[F.expr(f"{c} AS {p}{n}") for p, of in zip(CUBE, sums) for n, c in enumerate(of)])
    return _identity(scaled.select(*kept, F.col(count).alias("rows"), _hex("__f", "digest"), _hex("__r", "row_digest")), "dataframe")


def _blank_row(width: int) -> list[str]:
    hi, lo = cell_lanes("NULL", "null")
    return limbs_of(*row_lanes([hi] * width, [lo] * width))


def _blank_frame(width: int) -> list[str]:
    cell = limbs_of(*cell_lanes("NULL", "null"))
    return [f"({width}L * {c} + {r})" for c, r in zip(cell, _blank_row(width), strict=True)]


BLOCK = 8
"""Columns summed side by side, so that a row becomes one record per so many columns and not one per column."""


def _cell_totals(df: DataFrame, columns: Sequence[str], kinds: dict[str, str] | None, with_row: bool) -> DataFrame:
    """Return per position the values, nulls and carried limb sums ``__c0..3`` of each column, from one pass.

    ``with_row`` adds the row's own hash at the position behind the last column.
    """
    width = len(columns)
    nil = [named(c).isNull().cast("bigint") for c in columns]
    hashed, _ = _lanes(df, columns, nil, kinds)
    places = width
    if with_row:
        row = row_lanes([f"__hi{n}" for n in range(width)], [f"__lo{n}" for n in range(width)])
        hashed = hashed.select("*", *[F.expr(f"{text} AS __{side}{width}") for text, side in zip(row, ("hi", "lo"))], F.lit(0).cast("bigint").alias(f"__key{width}"))
        places += 1
    cells = [f"struct(__key{n} AS nil, __hi{n} AS hi, __lo{n} AS lo)" for n in range(places)]
    cells += ["struct(0L AS nil, 0L AS hi, 0L AS lo)"] * (-len(cells) % BLOCK)
    blocks = [f"struct({', '.join(f'{c} AS c{i}' for i, c in enumerate(cells[n : n + BLOCK]))})" for n in range(0, len(cells), BLOCK)]
    block = hashed.select(F.expr(f"posexplode(array({', '.join(blocks)}))").alias("block", "b"))
    limbs = [limbs_of(f"b.c{i}.hi", f"b.c{i}.lo") for i in range(BLOCK)]
    # Blocks meet a partial aggregate in the same task, so only blocks x tasks records are shuffled.
    partial = (
        block.select("block", *[F.expr(f"b.c{i}.nil AS __n{i}") for i in range(BLOCK)], *[F.expr(f"{t} AS __c{i}_{n}") for i, c in enumerate(limbs) for n, t in enumerate(c)])
        .withColumn("__task", F.spark_partition_id())
        .groupBy("block", "__task")
        .agg(F.count("*").alias("values"), *[F.sum(f"__n{i}").alias(f"__n{i}") for i in range(BLOCK)], *_sums([f"__c{i}_" for i in range(BLOCK)]))
    )
    carried = lambda i: ", ".join(f"{c} AS l{n}" for n, c in enumerate(_carried(f"__c{i}_")))
    spread = F.expr(f"posexplode(array({', '.join(f'struct(__n{i} AS nil, {carried(i)})' for i in range(BLOCK))})) AS (place, c)")
    cell = partial.select("block", "values", spread).withColumn("position", (F.col("block") * BLOCK + F.col("place")).cast("int"))
    cell = cell.where(F.col("position") < places).select("position", "values", "c.*")
    no_row = F.expr("struct(0L AS values, 0L AS nil, " + ", ".join(f"0L AS l{n}" for n in range(LIMBS)) + ")")
    # An empty table has no block: its columns and its row digest to zero all the same.
    zero = df.sparkSession.range(places).select(F.col("id").cast("int").alias("position"), no_row.alias("z")).select("position", "z.*")
    total = cell.unionByName(zero).groupBy("position").agg(F.sum("values").alias("values"), F.sum("nil").alias("nil"), *_sums(["l"]))
    return total.select("position", "values", "nil", *[F.expr(f"{c} AS __c{n}") for n, c in enumerate(_carried("l"))])


def _per_column(total: DataFrame, columns: Sequence[str]) -> DataFrame:
    names = F.array(*[F.lit(c) for c in columns])
    return total.where(F.col("position") < len(columns)).select(
        F.lit("column").alias("scope"), "position", F.element_at(names, F.col("position") + 1).alias("column"),
        F.col("values").alias("value_count"), F.col("nil").alias("null_count"), _hex("__c", "digest"), F.lit(None).cast("string").alias("row_digest"),
    )


def digest_all(df: DataFrame, columns: Sequence[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return the digests of every column and of the whole table from one pass.

    A row of ``scope`` ``column`` per column with its position, value and null counts, and one of ``dataframe`` with the row
    count, the frame digest and ``row_digest``. The row's own hash is summed like one more column, and the frame digest is the
    sum of all of them.
    """
    columns = list(columns or df.columns)
    width = len(columns)
    total = _cell_totals(df, columns, kinds, True)
    whole = total.agg(
        F.max("values").alias("values"),
        *[F.expr(f"sum(__c{n}) AS __f{n}") for n in range(LIMBS)],
        *[F.expr(f"sum(CASE WHEN position = {width} THEN __c{n} END) AS __r{n}") for n in range(LIMBS)],
    ).select(
        F.lit("dataframe").alias("scope"), F.lit(None).cast("int").alias("position"), F.lit(None).cast("string").alias("column"),
        F.col("values").alias("value_count"), F.lit(None).cast("bigint").alias("null_count"), _hex("__f", "digest"), _hex("__r", "row_digest"),
    )
    return _per_column(total, columns).unionByName(whole).withColumns({"algorithm": F.lit(ALGORITHM), "version": F.lit(VERSION)})


def digest_columns(df: DataFrame, columns: Sequence[str] | None = None, kinds: dict[str, str] | None = None) -> DataFrame:
    """Return one row per column: position, name, value and null counts, digest; all from one pass that hashes no rows."""
    columns = list(columns or df.columns)
    found = _per_column(_cell_totals(df, columns, kinds, False), columns).withColumns({"algorithm": F.lit(ALGORITHM), "version": F.lit(VERSION)})
    return found.select("position", "column", "value_count", "null_count", "digest", "algorithm", "version", "scope")


def combine(parts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add part digests up per key.

    ``refusal`` says why parts are not terms of one sum: mixed algorithm, version or scope, or only some with a row
    digest. The digests are null then. A key without parts has no row: the digest of nothing is not known here.
    """
    identity = F.struct("algorithm", "version", "scope")
    frame = [F.expr(f"{limb} AS __f{n}") for n, limb in enumerate(from_hex("digest"))]
    row = [F.expr(f"{limb} AS __r{n}") for n, limb in enumerate(from_hex("row_digest"))]
    total = (
        parts.select(*keys, "rows", "algorithm", "version", "scope", "row_digest", identity.alias("__id"), *frame, *row)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("parts"),
            F.count("row_digest").alias("__with_rows"),
            F.min("__id").alias("__first"),
            F.max("__id").alias("__last"),
            F.sum("rows").alias("rows"),
            *_sums(["__f", "__r"]),
        )
    )
    refusal = F.expr(
        "CASE WHEN __first <> __last THEN 'mixed-identity' WHEN __with_rows > 0 AND __with_rows < parts THEN 'partial-row-digest' END AS refusal"
    )
    return total.select("*", refusal).select(
        *keys,
        "parts",
        "rows",
        _hex("__f", "digest", "refusal IS NULL"),
        _hex("__r", "row_digest", "refusal IS NULL AND __with_rows > 0"),
        F.col("__first.algorithm").alias("algorithm"),
        F.col("__first.version").alias("version"),
        F.col("__first.scope").alias("scope"),
        "refusal",
    )


def compare_columns(left: DataFrame, right: DataFrame) -> DataFrame:
    """Return, for two sets of column digests, which columns moved, appeared or went."""
    l = left.select("column", F.col("digest").alias("left_digest"))
    r = right.select("column", F.col("digest").alias("right_digest"))
    change = (
        F.when(F.col("left_digest").isNull(), "added")
        .when(F.col("right_digest").isNull(), "removed")
        .when(F.col("left_digest") != F.col("right_digest"), "changed")
        .otherwise("same")
    )
    return l.join(r, "column", "full_outer").select("column", "left_digest", "right_digest", change.alias("change"))
