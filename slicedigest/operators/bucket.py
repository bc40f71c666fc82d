"""Calendar buckets: the key of each row, the counts the plan works on, and the rows that refuse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slicedigest.functions.calendar import decode_key, decode_reason, require_type
from slicedigest.functions.columns import named
from slicedigest.options import DateColumn

KEY = "__key"


def bucket_key(df: DataFrame, column: str, spec: DateColumn, grain: str) -> Column:
    """Return the key expression of a date column; null marks an undated row."""
    if column not in df.columns:
        raise ValueError(f"the table has no column {column!r}; it holds {df.columns}")
    dtype = df.schema[column].dataType
    require_type(dtype, spec, column)
    return decode_key(named(column), dtype, spec, grain)


def bucket_counts(df: DataFrame, column: str, spec: DateColumn, grain: str) -> DataFrame:
    """Return ``key, rows``: at most one row per calendar period, plus the undated one."""
    return df.groupBy(bucket_key(df, column, spec, grain).alias("key")).agg(F.count("*").alias("rows"))


def distinct_dates(df: DataFrame, column: str, ordinal: Column) -> DataFrame:
    """Return each dated value once with the earliest row that has it."""
    return df.where(named(column).isNotNull()).groupBy(named(column).alias("value")).agg(F.min(ordinal).alias("first_row"))


def decode_errors(df: DataFrame, column: str, spec: DateColumn, ordinal: Sequence[Column]) -> DataFrame:
    """Return every row whose value names no date: column, row ordinal, value, reason."""
    dtype = df.schema[column].dataType
    require_type(dtype, spec, column)
    reason = decode_reason(named(column), dtype, spec)
    return df.select(
        F.lit(column).alias("column"),
        *[c.alias(f"ordinal_{n}" if len(ordinal) > 1 else "ordinal") for n, c in enumerate(ordinal)],
        named(column).cast("string").alias("value"),
        reason.alias("reason"),
    ).where(F.col("reason").isNotNull())


def refused_row(df: DataFrame, column: str, spec: DateColumn, null_dates: str, ordinal: Column) -> Column:
    """Return, for a row that stops an export, its ordinal, value and reason: undecodable, or null where nulls are refused."""
    dtype = df.schema[column].dataType
    require_type(dtype, spec, column)
    reason = decode_reason(named(column), dtype, spec)
    if null_dates == "error":
        reason = F.when(named(column).isNull(), "null").otherwise(reason)
    row = F.struct(ordinal.alias("ordinal"), named(column).cast("string").alias("value"), reason.alias("reason"))
    return F.when(reason.isNotNull(), row)


def first_refusal(df: DataFrame, column: str, spec: DateColumn, null_dates: str, ordinal: Column) -> DataFrame:
    """Return the earliest row that stops an export; no row when nothing refuses. One aggregate over the table."""
    refused = refused_row(df, column, spec, null_dates, ordinal)
    return (
        df.agg(F.min(refused).alias("r"))
        .where(F.col("r").isNotNull())
        .select(F.lit(column).alias("column"), "r.ordinal", "r.value", "r.reason")
    )
