"""Cell digests that add up.

A cell's digest is 128 bits in two 64-bit lanes, each one ``xxhash64`` over (lane, type tag, value) and so part of
generated code. A row's digest chains the digests of its cells in column order. Sums are kept as four 32-bit limbs,
most significant first: one limb sum stays exact in a bigint for 2^31 rows, and carries are resolved at the end.
"""

from __future__ import annotations

ALGORITHM = "xxh64-pair-128"
VERSION = 1
LIMBS = 4
MASK = 0xFFFFFFFF

# The type tag of each kind.
TAGS = {
    "null": 0,
    "float": 1,
    "string": 2,
    "date": 3,
    "datetime": 4,
    "instant": 4,
    "time": 5,
    "integer": 6,
    "uint64": 6,
    "boolean": 7,
    "binary": 8,
    "decimal": 9,
    "interval": 10,
    "duration[ms]": 10,
    "duration[us]": 10,
    "datetime[ns]": 11,
    "duration[ns]": 12,
}
ROW_TAG = 16


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def normal_form(value: str, kind: str) -> str:
    """Return what a cell is digested as, equal for values that are the same under the kind. All here is SQL text."""
    if kind == "float":
        # -0.0 equals 0.0; xxhash64 itself folds every NaN into one.
        return f"CASE WHEN {value} = 0 THEN 0.0D ELSE cast({value} AS double) END"
    if kind == "boolean":
        return f"cast(cast({value} AS int) AS bigint)"
    if kind in ("integer", "duration[us]", "duration[ns]", "datetime[ns]"):
        return f"cast({value} AS bigint)"
    if kind == "duration[ms]":
        return f"cast({value} AS bigint) * 1000"
    if kind == "uint64":
        return f"cast({value} AS string)"
    if kind == "date":
        return f"cast(unix_date({value}) AS bigint)"
    if kind == "decimal":
        # Plain decimal text without trailing zeros.
        text = f"cast({value} AS string)"
        return f"CASE WHEN {value} = 0 THEN '0' WHEN contains({text}, '.') THEN rtrim('.', rtrim('0', {text})) ELSE {text} END"
    return value


def tagged(tag: int, side: int) -> int:
    """Return what is hashed ahead of a value: the type tag and the lane in one literal."""
    return 2 * tag + side


def cell_lanes(value: str, kind: str) -> tuple[str, str]:
    """Return both lanes of a cell's digest; every null has one digest whatever its column's type."""
    lanes = []
    for side in (0, 1):
        nothing = f"xxhash64({tagged(TAGS['null'], side)})"
        if kind == "null":
            lanes.append(nothing)
            continue
        start = tagged(TAGS[kind], side)
        hashed = f"xxhash64({start}, {normal_form(value, kind)})"
        if kind == "uint64":
            # Like any other integer where the value fits one, its decimal text above.
            hashed = f"CASE WHEN {value} <= {2**63 - 1}L THEN xxhash64({start}, try_cast({value} AS bigint)) ELSE {hashed} END"
        lanes.append(f"CASE WHEN {value} IS NULL THEN {nothing} ELSE {hashed} END")
    return lanes[0], lanes[1]


def row_lanes(his: list[str], los: list[str]) -> tuple[str, str]:
    return tuple(f"xxhash64({tagged(ROW_TAG, side)}, {', '.join(cells)})" for side, cells in enumerate((his, los)))


def limbs_of(hi: str, lo: str) -> list[str]:
    return [f"shiftrightunsigned({hi}, 32)", f"({hi} & {MASK}L)", f"shiftrightunsigned({lo}, 32)", f"({lo} & {MASK}L)"]


def carry(limbs: list[str]) -> list[str]:
    """Bring limb sums back to 32 bits each, dropping what passes 2^128."""
    out: list[str] = []
    over = "0L"
    for limb in reversed(limbs):
        out.append(f"(({limb} + {over}) & {MASK}L)")
        over = f"shiftright({limb} + {over}, 32)"
    return out[::-1]


def to_hex(limbs: list[str]) -> str:
    """Render carried limbs as 32 lowercase hex digits."""
    return "lower(concat(" + ", ".join(f"lpad(hex({limb}), 8, '0')" for limb in limbs) + "))"


def from_hex(digest: str) -> list[str]:
    return [f"cast(conv(substring({digest}, {1 + 8 * n}, 8), 16, 10) AS bigint)" for n in range(LIMBS)]
