"""Period labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from slicedigest.functions.calendar import month_of, year_of

# Fixed values of the format.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
RANGE = "~"
UNDATED = "Undated"
UNSPLIT = "Data"


def month_token(month: Column, month_format: str) -> Column:
    if month_format == "numeric":
        return F.lpad(month.cast("string"), 2, "0")
    return F.element_at(F.array(*[F.lit(name) for name in MONTHS]), month)


def year_token(year: Column) -> Column:
    return F.lpad(year.cast("string"), 4, "0")


def _key_text(key: Column, precision: Column, month_format: str) -> Column:
    """Spell one key. Its eight digits are the year, month and day, so one replacement serves every precision."""
    digits = F.lpad(key.cast("string"), 8, "0")
    shape = F.when(precision == "year", "$1").when(precision == "month", "$1-$2").otherwise("$1-$2-$3")
    text = F.regexp_replace(digits, F.lit("(....)(..)(..)"), shape)
    if month_format == "numeric":
        return text
    month = F.concat(F.substring(digits, 1, 4), F.lit("-"), month_token(month_of(key), month_format))
    return F.when(precision == "month", month).otherwise(text)


def period_label(first: Column, last: Column, precision: Column, month_format: str = "numeric") -> Column:
    """Return the label of an inclusive span of keys; one period is named without a range."""
    same_year = (precision == "month") & (year_of(first) == year_of(last))
    end = F.when(same_year, month_token(month_of(last), month_format)).otherwise(_key_text(last, precision, month_format))
    start = _key_text(first, precision, month_format)
    return F.when(precision.isNotNull(), F.concat(start, F.when(first == last, F.lit("")).otherwise(F.concat(F.lit(RANGE), end))))


def sheet_label(kind: Column, first: Column, last: Column, precision: Column, month_format: str = "numeric") -> Column:
    """Return the label token of a sheet: undated, unsplit, or its coverage."""
    return (
        F.when(kind == "undated", F.lit(UNDATED))
        .when(first.isNull(), F.lit(UNSPLIT))
        .otherwise(period_label(first, last, precision, month_format))
    )


def workbook_label(first: Column, last: Column, precision: Column, undated: Column, month_format: str = "numeric") -> Column:
    """Return the label token of a workbook from its widest coverage at the coarsest grain present."""
    covered = period_label(first, last, precision, month_format)
    return (
        F.when(first.isNull(), F.when(undated, F.lit(UNDATED)).otherwise(F.lit(UNSPLIT)))
        .when(undated, F.concat(covered, F.lit("_" + UNDATED)))
        .otherwise(covered)
    )
