"""Cell-safe conversion: what a table becomes when every value must fit a spreadsheet cell."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.calendar import wall_clock
from slicedigest.functions.columns import idiv, named
from slicedigest.functions.kinds import TICKS, kinds_of

# Fixed values of the format.
CELL_CHARACTERS = 32_767
TRUE_CELL = -1.0
FALSE_CELL = 0.0
CONVERSION = "to-excel"
CONVERSION_VERSION = "4.0"


@dataclass(frozen=True)
class CellRule:
    """One column's conversion: the cell, and when a value moved (beyond its change of type)."""

    cell: Column
    moved: Column | None = None


def whole_second(wall: Column) -> Column:
    """Floor a zoneless timestamp to its second without passing through the session zone."""
    fraction = F.pmod(F.date_part(F.lit("SECOND"), wall), F.lit(1).cast("decimal(8,6)"))
    return wall - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), fraction)


def _text(text: Column) -> CellRule:
    return CellRule(F.nullif(F.substring(text, 1, CELL_CHARACTERS), F.lit("")), (F.length(text) > CELL_CHARACTERS) | (text == ""))


def _datetime(wall: Column) -> CellRule:
    whole = whole_second(wall)
    return CellRule(whole, whole != wall)


def cell_rule(value: Column, kind: str, zone: str = "UTC") -> CellRule:
    """Return the rule of a column's kind; ``zone`` is the wall clock an instant column was written in."""
    if kind == "boolean":
        return CellRule(F.when(value, F.lit(TRUE_CELL)).when(~value, F.lit(FALSE_CELL)))
    if kind == "float":
        wide = value.cast("double")
        lost = F.isnan(wide) | (F.abs(wide) == F.lit(float("inf")))
        return CellRule(F.when(~lost, wide), lost)
    if kind in ("integer", "uint64", "decimal"):
        return CellRule(value.cast("double"))
    if kind == "string":
        return _text(value)
    if kind == "binary":
        return _text(F.lower(F.hex(value)))
    if kind.startswith("duration["):
        return CellRule(value.cast("bigint") / F.lit(float(TICKS[kind[9:11]])))
    if kind == "interval":
        return CellRule(value.cast("decimal(20,6)").cast("double"))
    if kind == "datetime":
        return _datetime(value)
    if kind == "instant":
        return _datetime(wall_clock(value, zone))
    if kind == "datetime[ns]":
        micros = idiv(value - F.pmod(value, F.lit(1000).cast("bigint")), 1000)
        wall = F.timestamp_add("MICROSECOND", micros, F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))
        return _datetime(wall)
    return CellRule(value)


def _rules(df: DataFrame, kinds: dict[str, str] | None, zones: dict[str, str] | None) -> dict[str, CellRule]:
    found = kinds_of(df.schema, kinds)
    zones = zones or {}
    return {name: cell_rule(named(name), kind, zones.get(name, "UTC")) for name, kind in found.items()}


def to_cells(df: DataFrame, kinds: dict[str, str] | None = None, zones: dict[str, str] | None = None) -> DataFrame:
    """Convert every column in one projection; names and order stay. Converting twice changes nothing more."""
    return df.select(*[rule.cell.alias(name) for name, rule in _rules(df, kinds, zones).items()])


def conversion_changes(df: DataFrame, kinds: dict[str, str] | None = None, zones: dict[str, str] | None = None) -> DataFrame:
    """Return one row: ``changed``, ``schema_changed``, and ``moved``, the columns in which a value moved."""
    rules = _rules(df, kinds, zones)
    after = to_cells(df, kinds, zones).schema
    schema_changed = [f.dataType for f in df.schema.fields] != [f.dataType for f in after.fields]
    watched = [(name, rule.moved) for name, rule in rules.items() if rule.moved is not None]
    flags = df.agg(F.lit(1).alias("__one"), *[F.coalesce(F.bool_or(moved), F.lit(False)).alias(f"__m{n}") for n, (_, moved) in enumerate(watched)])
    moved = F.array_compact(F.array(*[F.when(F.col(f"__m{n}"), F.lit(name)) for n, (name, _) in enumerate(watched)])) if watched else F.array().cast("array<string>")
    return flags.select(moved.alias("moved")).select(
        (F.lit(schema_changed) | (F.size("moved") > 0)).alias("changed"),
        F.lit(schema_changed).alias("schema_changed"),
        "moved",
    )


def identity_conversion(df: DataFrame) -> DataFrame:
    """The conversion that changes nothing."""
    return df


def impose_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring read-back columns to the recorded types by name; a cell that does not fit reads as null."""
    present = {name: field for name, field in zip(df.columns, df.schema.fields)}
    out = []
    for field in schema.fields:
        value = named(field.name)
        if field.name not in present:
            raise ValueError(f"the table read back has no column {field.name!r}")
        if isinstance(field.dataType, T.NullType):
            out.append(F.lit(None).alias(field.name))
        elif present[field.name].dataType == field.dataType:
            out.append(value.alias(field.name))
        else:
            out.append(value.try_cast(field.dataType).alias(field.name))
    return df.select(*out)


def dropped_cells(df: DataFrame, schema: T.StructType, ordinal: Column, first: int = 5) -> DataFrame:
    """Return, per column, how many cells would silently read as null, and the first few of them.

    Covers cells that do not fit the wanted type and content in a column declared empty.
    """
    types = dict(zip(df.columns, [f.dataType for f in df.schema.fields]))
    checks = []
    for field in schema.fields:
        value = named(field.name)
        if isinstance(field.dataType, T.NullType):
            bad, reason = value.isNotNull(), "content-in-empty-column"
        elif types[field.name] == field.dataType:
            continue
        else:
            bad, reason = value.isNotNull() & value.try_cast(field.dataType).isNull(), "does-not-fit"
        checks.append(F.when(bad, F.struct(F.lit(field.name).alias("column"), F.lit(reason).alias("reason"), ordinal.cast("bigint").alias("row"), value.cast("string").alias("value"))))
    if not checks:
        return df.sparkSession.createDataFrame([], "column string, reason string, dropped bigint, first array<struct<row:bigint,value:string>>")
    found = df.select(F.explode(F.array_compact(F.array(*checks))).alias("cell")).select("cell.*")
    # Spark cuts each task to its first rows before the shuffle, so a column that is bad throughout stays cheap.
    place = F.row_number().over(Window.partitionBy("column", "reason").orderBy("row"))
    firsts = (
        found.withColumn("__n", place)
        .where(F.col("__n") <= first)
        .groupBy("column", "reason")
        .agg(F.array_sort(F.collect_list(F.struct("row", "value"))).alias("first"))
    )
    return found.groupBy("column", "reason").agg(F.count("*").alias("dropped")).join(firsts, ["column", "reason"])
