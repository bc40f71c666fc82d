"""What may be called what, and the templates names come from."""

from __future__ import annotations

import re
from collections import Counter
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the destinations.
SHEET_NAME_LIMIT = 31
PATH_LIMIT = 260
SHEET_FORBIDDEN = "/\\?*:[]"
WORKBOOK_FORBIDDEN = '<>:"/\\|?*'
RESERVED_SHEETS = ["history"]
DEVICE_NAMES = (
    ["con", "prn", "aux", "nul"]
    + [f"com{n}" for n in range(1, 10)]
    + [f"lpt{n}" for n in range(1, 10)]
)
IDENTIFIER = r"\A[A-Za-z0-9][A-Za-z0-9_-]*\z"
CONTROLS = "[\\x00-\\x1f\\x7f]"


def _any_of(characters: str) -> str:
    return "[" + re.escape(characters) + "]"


def identifier_problem(value: str) -> str | None:
    """Return what is wrong with an alias or profile name given as an argument."""
    return None if re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_-]*", value) else "letters, digits, '_' and '-' only, starting with a letter or digit"


def column_problem(columns: list[str]) -> str | None:
    """Return why column names cannot head a worksheet: one is empty, or two differ only by case."""
    if any(not name for name in columns):
        return "a column has no name"
    folded = Counter(name.lower() for name in columns)
    twice = sorted({name for name in columns if folded[name.lower()] > 1})
    return f"columns differ only by case: {twice}" if twice else None


def is_identifier(value: Column) -> Column:
    return value.rlike(IDENTIFIER)


def worksheet_problem(name: Column) -> Column:
    """Return the first rule a worksheet name breaks, or null."""
    return (
        F.when(name.isNull() | (name == ""), "empty")
        .when(F.length(name) > SHEET_NAME_LIMIT, "too-long")
        .when(name.rlike(_any_of(SHEET_FORBIDDEN)), "forbidden-character")
        .when(name.rlike(CONTROLS), "control-character")
        .when(name.startswith("'") | name.endswith("'"), "apostrophe")
        .when(F.lower(name).isin(RESERVED_SHEETS), "reserved")
    )


def workbook_problem(name: Column) -> Column:
    """Return the first rule a workbook name breaks, or null."""
    return (
        F.when(name.isNull() | (name == ""), "empty")
        .when(name.isin(".", ".."), "traversal")
        .when(name.rlike(_any_of(WORKBOOK_FORBIDDEN)), "forbidden-character")
        .when(name.rlike(CONTROLS), "control-character")
        .when(name.endswith(".") | name.endswith(" "), "trailing")
        .when(F.lower(F.substring_index(name, ".", 1)).isin(DEVICE_NAMES), "device-name")
    )


def path_problem(path: Column, limit: int = PATH_LIMIT) -> Column:
    return F.when(F.length(path) > limit, "path-too-long")


def relative_path_problem(path: Column) -> Column:
    """Return why a path is not safe below a destination folder, or null."""
    return (
        F.when(path.isNull() | (path == ""), "empty")
        .when(path.rlike(r"\A[/\\]"), "absolute")
        .when(path.rlike(r"(?s)\A.:"), "drive")
        .when(path.contains("://"), "scheme")
        .when(path.rlike(r"(\A|[/\\])\.\.([/\\]|\z)"), "parent")
    )


def template_tokens(template: str) -> set[str]:
    """Return the tokens a template names; reaching into a value is refused."""
    tokens = set()
    for _, field, _, conversion in string.Formatter().parse(template):
        if field is None:
            continue
        if "." in field or "[" in field or conversion:
            raise ValueError(f"template field {field!r} may name a token, never reach into it")
        tokens.add(field)
    return tokens


def render(template: str, tokens: dict[str, Column], numbers: set[str]) -> Column:
    """Return a template as one string column; number tokens may ask for zero padding such as ``03d``."""
    template_tokens(template)
    pieces = []
    for text, field, spec, _ in string.Formatter().parse(template):
        if text:
            pieces.append(F.lit(text))
        if field is None:
            continue
        if field not in tokens:
            raise KeyError(field)
        value = tokens[field].cast("string")
        if spec:
            match = re.fullmatch(r"(0?)(\d*)d", spec)
            if field not in numbers or not match:
                raise ValueError(f"format {spec!r} does not fit token {field!r}")
            if match[2]:
                width = int(match[2])
                fill = "0" if match[1] else " "
                value = F.when(F.length(value) >= width, value).otherwise(F.lpad(value, width, fill))
        pieces.append(value)
    return F.concat(*pieces) if pieces else F.lit("")


def prefixed(prefix: str, name: Column) -> Column:
    return F.concat(F.lit(prefix + " "), name) if prefix else name
