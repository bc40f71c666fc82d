"""Calendar keys as integer column arithmetic.

A key packs a period as ``year * 10000 + month * 100 + day``; a field finer than the key's grain is zero and a
missing date has a null key. Integer order on keys is calendar order.
"""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from slicedigest.functions.columns import idiv
from slicedigest.options import INT_WIDTHS, MAX_YEAR, MIN_YEAR, DateColumn


def utc_wall_clock(instant: Column) -> Column:
    """Return an instant's UTC reading without a zone, whatever the session zone is."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"))


def wall_clock(instant: Column, zone: str) -> Column:
    """Return the wall clock an instant shows in a zone."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_wall_clock(instant))


def check_zone(spark: SparkSession, zone: str) -> None:
    """Raise on the driver, before any job, when the zone is unknown."""
    try:
        spark.sparkContext._jvm.java.time.ZoneId.of(zone)
    except Exception:
        raise ValueError(f"unknown time zone {zone!r}") from None


def year_of(key: Column) -> Column:
    return idiv(key, 10000).cast("int")


def month_of(key: Column) -> Column:
    return F.pmod(idiv(key, 100), F.lit(100)).cast("int")


def day_of(key: Column) -> Column:
    return F.pmod(key, F.lit(100)).cast("int")


def pack(year: Column, month: Column, day: Column | None = None) -> Column:
    packed = year * 10000 + month * 100
    return (packed if day is None else packed + day).cast("int")


def coarsen(key: Column, precision: Column | str) -> Column:
    """Return the period of the given precision that holds a key."""
    wanted = F.lit(precision) if isinstance(precision, str) else precision
    unit = F.when(wanted == "year", 10000).when(wanted == "month", 100).otherwise(1)
    return (key - F.pmod(key, unit)).cast("int")


def two_digit_year(yy: Column, start: int) -> Column:
    """Return the one year of the hundred from ``start`` that ends in these two digits."""
    return F.lit(start) + F.pmod(yy - start, F.lit(100))


def grid_start(month: Column, months: int | Column) -> Column:
    """Return the first month of the grid cell a month falls in; every grid starts in January."""
    size = F.lit(months) if isinstance(months, int) else months
    return (idiv(month - 1, size) * size + 1).cast("int")


def require_type(dtype: T.DataType, spec: DateColumn, name: str) -> None:
    """Refuse, from the schema alone, a column that cannot carry the declared dates."""
    if spec.kind == "date":
        ok = isinstance(dtype, T.DateType)
    elif spec.kind == "datetime":
        ok = isinstance(dtype, (T.TimestampType, T.TimestampNTZType))
        if spec.zone is not None and isinstance(dtype, T.TimestampNTZType):
            raise TypeError(f"column {name!r} names no instant, so it cannot be moved into zone {spec.zone!r}")
    else:
        ok = isinstance(dtype, T.IntegralType) or (isinstance(dtype, T.DecimalType) and dtype.scale == 0)
    if not ok:
        raise TypeError(f"column {name!r} is {dtype.simpleString()} and was declared {spec.kind}")


def _int_year(value: Column, spec: DateColumn) -> Column:
    """Return the year of an integer date whose value has already been found in range."""
    tail = INT_WIDTHS[spec.fmt] - (2 if spec.window is not None else 4)
    year = idiv(value, 10**tail)
    return year if spec.window is None else two_digit_year(year, spec.window)


def _date_of(value: Column, dtype: T.DataType, spec: DateColumn) -> Column:
    if isinstance(dtype, T.DateType):
        return value
    if isinstance(dtype, T.TimestampNTZType):
        return F.to_date(value)
    return F.to_date(wall_clock(value, spec.zone or spec.wall_zone))


def decode_reason(value: Column, dtype: T.DataType, spec: DateColumn) -> Column:
    """Return why a value names no date, or null when it does or is itself null."""
    if spec.kind != "int":
        year = F.year(_date_of(value, dtype, spec))
        return F.when(value.isNotNull() & ~year.between(MIN_YEAR, MAX_YEAR), "year")
    # Each test uses the value once where it can: a long predicate would not be compiled.
    width = INT_WIDTHS[spec.fmt]
    tail = width - (2 if spec.window is not None else 4)
    exact = value.try_cast("bigint")
    reason = F.when(value < 0, "negative").when(value >= 10**width, "digits")
    if spec.window is None:
        reason = reason.when(exact < 10**tail, "year")
    reason = reason.when(~F.pmod(idiv(exact, 10 ** (tail - 2)), F.lit(100)).isin(list(range(1, 13))), "month")
    if tail == 4:
        day = F.pmod(exact, F.lit(100))
        year = _int_year(exact, spec)
        leap = (F.pmod(year, F.lit(4)) == 0) & ((F.pmod(year, F.lit(100)) != 0) | (F.pmod(year, F.lit(400)) == 0))
        longest = F.element_at(F.expr("array(31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)"), F.pmod(idiv(exact, 100), F.lit(100)).cast("int"))
        reason = reason.when((day == 0) | (day > longest), "day").when((F.pmod(exact, F.lit(10_000)) == 229) & ~leap, "day")
    return reason


def decode_key(value: Column, dtype: T.DataType, spec: DateColumn, grain: str) -> Column:
    """Return the packed key at month or day grain; null for a null or a value that names no date."""
    if grain == "day" and spec.precision == "month":
        raise ValueError(f"format {spec.fmt} names months only and cannot be cut by days")
    if spec.kind == "int":
        exact = value.try_cast("bigint")
        tail = F.pmod(exact, F.lit(10_000)) if spec.precision == "day" else F.pmod(exact, F.lit(100)) * 100
        key = _int_year(exact, spec) * 10_000 + tail
        key = (key if grain == "day" else key - F.pmod(key, F.lit(100))).cast("int")
    else:
        date = _date_of(value, dtype, spec)
        key = pack(F.year(date), F.month(date), F.dayofmonth(date) if grain == "day" else None)
    return F.when(value.isNotNull() & decode_reason(value, dtype, spec).isNull(), key)


def chronology(value: Column, dtype: T.DataType, spec: DateColumn) -> Column:
    """Return what a registered date column sorts by: decoded order for integers, the full value otherwise."""
    if spec.kind != "int":
        return value
    return decode_key(value, dtype, spec, spec.precision)
