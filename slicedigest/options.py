"""What a caller can ask for. Small frozen records, checked when they are made."""

from __future__ import annotations

from dataclasses import dataclass, field

from slicedigest.functions.names import identifier_problem, template_tokens

# Fixed values of the format.
MAX_DATA_ROWS = 1_048_575
MAX_COLUMNS = 16_384
MIN_YEAR = 1
MAX_YEAR = 9999
BASE_PERIODS = ("year", "year-month", "year-month-day")
YEAR_GRIDS = (6, 4, 3, 2, 1)
INT_WIDTHS = {"YYMM": 4, "YYYYMM": 6, "YYMMDD": 6, "YYYYMMDD": 8}
WORKBOOK_TOKENS = {"profile", "period_label", "workbook_index"}
SHEET_TOKENS = {"source", "source_stem", "profile", "period_label", "sheet_index"}
OVERFLOW_TOKENS = SHEET_TOKENS | {"part_index"}


def _one_of(what: str, value: object, allowed: tuple) -> None:
    if value not in allowed:
        raise ValueError(f"{what} is {value!r}, expected one of {allowed}")


@dataclass(frozen=True)
class DateColumn:
    """How a column is read as a calendar date.

    ``zone`` is a named zone that an instant is moved into first; without it the wall clock is taken as it stands.
    ``wall_zone`` says which wall clock an instant column was written in, because Spark does not keep it.
    """

    kind: str
    zone: str | None = None
    wall_zone: str = "UTC"
    fmt: str | None = None
    window: int | None = None

    def __post_init__(self) -> None:
        _one_of("kind", self.kind, ("date", "datetime", "int"))
        if self.kind != "int":
            if self.fmt is not None or self.window is not None:
                raise ValueError("fmt and window belong to integer dates only")
            return
        _one_of("fmt", self.fmt, tuple(INT_WIDTHS))
        two_digit = self.fmt in ("YYMM", "YYMMDD")
        if two_digit and self.window is None:
            raise ValueError(f"format {self.fmt} has a two-digit year and needs a window")
        if not two_digit and self.window is not None:
            raise ValueError(f"format {self.fmt} has a four-digit year and takes no window")
        if self.window is not None and not MIN_YEAR <= self.window <= MAX_YEAR - 99:
            raise ValueError(f"window {self.window} leaves the years {MIN_YEAR}-{MAX_YEAR}")

    @classmethod
    def date(cls) -> DateColumn:
        return cls("date")

    @classmethod
    def datetime(cls, zone: str | None = None, wall_zone: str = "UTC") -> DateColumn:
        return cls("datetime", zone=zone, wall_zone=wall_zone)

    @classmethod
    def integer(cls, fmt: str, window: int | None = None) -> DateColumn:
        return cls("int", fmt=fmt, window=window)

    @property
    def precision(self) -> str:
        return "month" if self.kind == "int" and not self.fmt.endswith("DD") else "day"


@dataclass(frozen=True)
class SortKey:
    column: str
    descending: bool = False
    nulls_first: bool = False


@dataclass(frozen=True)
class Limits:
    """``rows``: data rows per sheet. ``cells``: cells per workbook, header rows included."""

    rows: int = MAX_DATA_ROWS
    cells: int = 10_000_000

    def __post_init__(self) -> None:
        if not 1 <= self.rows <= MAX_DATA_ROWS:
            raise ValueError(f"rows per sheet must lie in 1..{MAX_DATA_ROWS}")
        if self.cells < 1:
            raise ValueError("cells per workbook must be positive")


def check_grids(grids: tuple[int, ...]) -> None:
    """Refuse a grid list that is not a strictly descending choice of the known grids ending in 1."""
    if not grids or grids[-1] != 1 or any(g not in YEAR_GRIDS for g in grids) or any(a <= b for a, b in zip(grids, grids[1:])):
        raise ValueError(f"year grids {grids} must descend strictly within {YEAR_GRIDS} and end in 1")


@dataclass(frozen=True)
class Partitioning:
    algorithm: str = "calendar_greedy"
    balance_across: str = "worksheets"
    base_period: str = "year"
    period_order: str = "ascending"
    year_split_months: tuple[int, ...] = YEAR_GRIDS
    oversized: str = "balanced_rows"
    null_dates: str = "separate"

    def __post_init__(self) -> None:
        _one_of("algorithm", self.algorithm, ("balanced", "calendar_greedy", "calendar_periods"))
        _one_of("balance_across", self.balance_across, ("worksheets", "workbooks"))
        _one_of("base_period", self.base_period, BASE_PERIODS)
        _one_of("period_order", self.period_order, ("ascending", "descending"))
        _one_of("oversized", self.oversized, ("balanced_rows", "error"))
        _one_of("null_dates", self.null_dates, ("separate", "error"))
        check_grids(tuple(self.year_split_months))

    @property
    def calendar(self) -> bool:
        return self.algorithm != "balanced"

    @property
    def grain(self) -> str:
        """Grain of the row key: months serve the year base too, because an oversized year is cut by months."""
        return "day" if self.base_period == "year-month-day" else "month"


@dataclass(frozen=True)
class Naming:
    workbook: str = "{profile}_{period_label}_{workbook_index:03d}.xlsx"
    single_worksheet: str = "{source} Data"
    worksheet: str = "{source} {period_label}"
    overflow_worksheet: str = "{source} {period_label}_p{part_index:02d}"
    month_format: str = "numeric"
    prefix: str = ""
    collision: str = "suffix"

    def __post_init__(self) -> None:
        _one_of("month_format", self.month_format, ("numeric", "abbreviated"))
        _one_of("collision", self.collision, ("suffix", "error"))
        for template, allowed in (
            (self.workbook, WORKBOOK_TOKENS),
            (self.single_worksheet, SHEET_TOKENS),
            (self.worksheet, SHEET_TOKENS),
            (self.overflow_worksheet, OVERFLOW_TOKENS),
        ):
            unknown = template_tokens(template) - allowed
            if unknown:
                raise ValueError(f"template {template!r} uses unavailable tokens {sorted(unknown)}")


@dataclass(frozen=True)
class Sheet:
    """One source's part in a profile."""

    source: str
    partition_column: str | None = None
    sort: tuple[SortKey, ...] = ()


@dataclass(frozen=True)
class Profile:
    name: str
    sheets: tuple[Sheet, ...]
    limits: Limits = field(default_factory=Limits)
    partitioning: Partitioning = field(default_factory=Partitioning)
    naming: Naming = field(default_factory=Naming)

    def __post_init__(self) -> None:
        problem = identifier_problem(self.name)
        if problem:
            raise ValueError(f"profile name {self.name!r}: {problem}")
        if not self.sheets:
            raise ValueError(f"profile {self.name!r} names no source")
        for sheet in self.sheets:
            if identifier_problem(sheet.source):
                raise ValueError(f"source alias {sheet.source!r}: {identifier_problem(sheet.source)}")
            if self.partitioning.calendar != (sheet.partition_column is not None):
                raise ValueError(f"source {sheet.source!r}: a partition column is given exactly when the algorithm is a calendar one")
            columns = [key.column for key in sheet.sort]
            if len(set(columns)) != len(columns):
                raise ValueError(f"source {sheet.source!r} sorts twice by one column")
        if len(self.sheets) > 1:
            for template in (self.naming.worksheet, self.naming.overflow_worksheet):
                if "source" not in template_tokens(template):
                    raise ValueError(f"template {template!r} must name the source when several share a workbook")


@dataclass(frozen=True)
class Source:
    """A named input: where it lies and which of its columns may be read as dates."""

    path: str
    date_columns: dict[str, DateColumn] = field(default_factory=dict)


def check_profiles(sources: dict[str, Source], profiles: list[Profile]) -> None:
    """Refuse references to sources or date columns nobody declared, and names that differ only by case."""
    for what, names in (("source alias", list(sources)), ("profile name", [p.name for p in profiles])):
        folded = [name.casefold() for name in names]
        if len(set(folded)) != len(folded):
            raise ValueError(f"two entries share one {what}, compared without case")
    for profile in profiles:
        for sheet in profile.sheets:
            if sheet.source not in sources:
                raise ValueError(f"profile {profile.name!r} uses undeclared source {sheet.source!r}")
            spec = sources[sheet.source].date_columns.get(sheet.partition_column)
            if profile.partitioning.calendar and spec is None:
                raise ValueError(f"{sheet.partition_column!r} is not a registered date column of {sheet.source!r}")
            if profile.partitioning.calendar:
                check_base_period(spec, profile.partitioning.base_period)


def check_base_period(spec: DateColumn, base_period: str) -> None:
    """A value that only names a month cannot fall on a day."""
    if base_period == "year-month-day" and spec.precision == "month":
        raise ValueError(f"format {spec.fmt} names months only and cannot be cut by days")
