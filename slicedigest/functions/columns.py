"""Reading column names literally."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """Return the column of exactly this name; ``*``, dots and back-ticks in it have no special meaning."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(taken: Iterable[str], wanted: str) -> str:
    """Return ``wanted``, suffixed until no existing column has it (compared without case, as Spark resolves)."""
    used = {name.casefold() for name in taken}
    name, n = wanted, 0
    while name.casefold() in used:
        n += 1
        name = f"{wanted}_{n}"
    return name


def idiv(left: Column, right: Column | int) -> Column:
    """Integer division; exact where a division of doubles would round."""
    return F.call_function("div", left, F.lit(right) if isinstance(right, int) else right)
