"""The declared kind of a column: what its values are, where the stored type alone does not say."""

from __future__ import annotations

from pyspark.sql import types as T

# Ticks per second of the durations and instants that Parquet hands over as plain 64-bit integers.
TICKS = {"ms": 1_000, "us": 1_000_000, "ns": 1_000_000_000}
DECLARED = {"null", "uint64", "duration[ms]", "duration[us]", "duration[ns]", "datetime[ns]"}


def kind_of(dtype: T.DataType, declared: str | None = None) -> str:
    """Return the kind a column is digested and converted under; nested types are refused."""
    if declared is not None:
        if declared not in DECLARED:
            raise ValueError(f"unknown declared kind {declared!r}, expected one of {sorted(DECLARED)}")
        return declared
    if isinstance(dtype, T.NullType):
        return "null"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, T.IntegralType):
        return "integer"
    if isinstance(dtype, T.FractionalType) and not isinstance(dtype, T.DecimalType):
        return "float"
    if isinstance(dtype, T.DecimalType):
        return "decimal"
    if isinstance(dtype, (T.StringType, T.CharType, T.VarcharType)):
        return "string"
    if isinstance(dtype, T.BinaryType):
        return "binary"
    if isinstance(dtype, T.DateType):
        return "date"
    if isinstance(dtype, T.TimestampNTZType):
        return "datetime"
    if isinstance(dtype, T.TimestampType):
        return "instant"
    if isinstance(dtype, T.DayTimeIntervalType):
        return "interval"
    if dtype.typeName() == "time" or type(dtype).__name__ == "TimeType":
        return "time"
    raise TypeError(f"type {dtype.simpleString()} is not a flat scalar")


def kinds_of(schema: T.StructType, declared: dict[str, str] | None = None) -> dict[str, str]:
    """Return the kind of every column, refusing nested columns by name before any job runs."""
    declared = declared or {}
    unknown = set(declared) - set(schema.names)
    if unknown:
        raise KeyError(f"kinds declared for columns that do not exist: {sorted(unknown)}")
    found = {}
    for field in schema.fields:
        try:
            found[field.name] = kind_of(field.dataType, declared.get(field.name))
        except TypeError as error:
            raise TypeError(f"column {field.name!r}: {error}") from None
    return found


def type_flags(kind: str) -> dict[str, bool]:
    """Return the type-family flags of a description. A decimal is numeric, a boolean is not."""
    integer = kind in ("integer", "uint64")
    return {
        "is_numeric": integer or kind in ("float", "decimal"),
        "is_float": kind == "float",
        "is_integer": integer,
        "is_decimal": kind == "decimal",
        "is_text": kind == "string",
        "is_boolean": kind == "boolean",
    }


def require_instants(schema: T.StructType, columns: list[str]) -> None:
    """Refuse record timestamps that name no instant; two zoneless times cannot be compared."""
    loose = [c for c in columns if not isinstance(schema[c].dataType, T.TimestampType)]
    if loose:
        raise TypeError(f"columns {loose} must be instants with a zone")
