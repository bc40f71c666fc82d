"""SQL text shared by the oracles: the digests, spelled out as DuckDB arithmetic."""

from __future__ import annotations

import struct

import xxhash

# Fixed values of XXH64.
P1 = 11400714785074694791
P2 = 14029467366897019727
P3 = 1609587929392839161
P4 = 9650029242287828579
P5 = 2870177450012600261
M64 = 18446744073709551616

TAGS = {"null": 0, "float": 1, "string": 2, "date": 3, "datetime": 4, "integer": 6, "boolean": 7, "row": 16}


def seed(tag: int, side: int) -> int:
    """The chain value after hashing the literal that goes ahead of a value."""
    return xxhash.xxh64_intdigest(struct.pack("<i", 2 * tag + side), 42)


def mul(x: str, p: int) -> str:
    return f"((({x})::UHUGEINT * {p}::UHUGEINT) & {M64 - 1}::UHUGEINT)::UBIGINT"


def add(x: str, y: str) -> str:
    return f"((({x})::UHUGEINT + ({y})::UHUGEINT) & {M64 - 1}::UHUGEINT)::UBIGINT"


def rotl(x: str, r: int) -> str:
    return let(f"({x})::UHUGEINT << {r}", "rx", f"((rx & {M64 - 1}::UHUGEINT) | (rx >> 64))::UBIGINT")


def let(x: str, name: str, body: str) -> str:
    return f"list_transform([{x}], lambda {name}: {body})[1]"


def fmix(h: str) -> str:
    a = let(h, "fa", mul("xor(fa, fa >> 33)", P2))
    b = let(a, "fb", mul("xor(fb, fb >> 29)", P3))
    return let(b, "fc", "xor(fc, fc >> 32)")


def _round(acc: str, w: str) -> str:
    return mul(rotl(add(acc, mul(w, P2)), 31), P1)


def _word8(acc: str, w: str) -> str:
    return add(mul(rotl(f"xor({acc}, {mul(rotl(mul(w, P2), 31), P1)})", 27), P1), str(P4))


def hash8(start: str, bits: str) -> str:
    """XXH64 of one 64-bit value; ``start`` is the seed."""
    return fmix(_word8(add(start, str((P5 + 8) % M64)), bits))


def bits_of(x: str) -> str:
    """The unsigned bits of a signed bigint."""
    return f"(({x})::HUGEINT & {M64 - 1}::HUGEINT)::UBIGINT"


def _le(hx: str, at: str, size: int) -> str:
    pairs = " || ".join(f"substr({hx}, ({at}) * 2 + {2 * n + 1}, 2)" for n in reversed(range(size)))
    return f"('0x' || {pairs})::UBIGINT"


def hash_text(start: int, text: str) -> str:
    """XXH64 of a string's UTF-8 bytes."""
    n = "(length(hx) // 2)"
    stripes = f"({n} // 32 * 4)"
    lanes = []
    for j, init in enumerate(((start + P1 + P2) % M64, (start + P2) % M64, start, (start - P1) % M64)):
        lanes.append(f"list_reduce(ws[{j + 1}:{stripes}:4], lambda acc, w: {_round('acc', 'w')}, {init}::UBIGINT)")
    merged = add(add(rotl("v[1]", 1), rotl("v[2]", 7)), add(rotl("v[3]", 12), rotl("v[4]", 18)))
    for j in range(1, 5):
        merged = add(mul(f"xor({merged}, {mul(rotl(mul(f'v[{j}]', P2), 31), P1)})", P1), str(P4))
    long = let(f"[{', '.join(lanes)}]", "v", merged)
    h = add(f"CASE WHEN {n} >= 32 THEN {long} ELSE {(start + P5) % M64}::UBIGINT END", n)
    h = f"list_reduce(ws[{stripes} + 1:], lambda acc, w: {_word8('acc', 'w')}, {h})"
    words = f"list_transform(regexp_extract_all(hx, '.{{16}}'), lambda p: {_le('p', '0', 8)})"
    h = let(words, "ws", h)
    tail4 = f"CASE WHEN {n} % 8 >= 4 THEN [{_le('hx', f'{n} // 8 * 8', 4)}] ELSE []::UBIGINT[] END"
    step4 = add(mul(rotl(f"xor(acc, {mul('w', P1)})", 23), P2), str(P3))
    h = f"list_reduce({tail4}, lambda acc, w: {step4}, {h})"
    last = f"list_transform(range({n} // 4 * 4, {n}), lambda p: {_le('hx', 'p', 1)})"
    h = f"list_reduce({last}, lambda acc, w: {mul(rotl(f'xor(acc, {mul(chr(119), P5)})', 11), P1)}, {h})"
    return let(f"lower(hex(encode({text})))", "hx", fmix(h))


def cell(expr: str, kind: str, side: int) -> str:
    """The digest lane of a cell as an unsigned 64-bit value."""
    start = seed(TAGS[kind], side)
    value = {
        "integer": bits_of(f"({expr})::BIGINT"),
        "boolean": bits_of(f"({expr})::INT::BIGINT"),
        "float": bits_of(f"(CASE WHEN ({expr}) = 0 THEN 0.0::DOUBLE ELSE ({expr})::DOUBLE END)::BIT::BIGINT"),
        "datetime": bits_of(f"epoch_us({expr})"),
        "date": bits_of(f"(({expr})::DATE - DATE '1970-01-01')::BIGINT"),
        "string": None,
    }[kind]
    hashed = hash_text(start, expr) if kind == "string" else hash8(f"{start}::UBIGINT", value)
    return f"CASE WHEN ({expr}) IS NULL THEN {seed(TAGS['null'], side)}::UBIGINT ELSE {hashed} END"


def row(lanes: list[str], side: int) -> str:
    """Chain a row's cell lanes: each hash seeds the next."""
    return f"list_reduce([{', '.join(lanes)}], lambda s, l: {hash8('s', 'l')}, {seed(TAGS['row'], side)}::UBIGINT)"


def hex128(hi: str, lo: str) -> str:
    """Render sums of the high and low lanes, themselves sums of unsigned 64-bit values, modulo 2^128."""
    carry = f"(({hi})::UHUGEINT + ({lo})::UHUGEINT // {M64}::UHUGEINT) % {M64}::UHUGEINT"
    return f"lower(lpad(to_hex(({carry})::UBIGINT), 16, '0') || lpad(to_hex((({lo})::UHUGEINT % {M64}::UHUGEINT)::UBIGINT), 16, '0'))"


def lanes_select(cells: list[tuple[str, str]], keys: str, source: str) -> str:
    """SELECT keys, h0, l0, h1, l1, … and hr, lr over a source; cells are (expression, kind)."""
    inner = ", ".join(f"{cell(e, k, 0)} AS h{n}, {cell(e, k, 1)} AS l{n}" for n, (e, k) in enumerate(cells))
    names = lambda p: [f"{p}{n}" for n in range(len(cells))]
    return f"SELECT *, {row(names('h'), 0)} AS hr, {row(names('l'), 1)} AS lr FROM (SELECT {keys}{', ' if keys else ''}{inner} FROM {source})"


def lane_sum(column: str) -> str:
    return f"coalesce(sum({column}::HUGEINT), 0)::UHUGEINT"


def digest_select(cells: list[tuple[str, str]], keys: str, key_names: str, source: str) -> str:
    """SELECT key_names, rows, digest, row_digest grouped by the keys."""
    n = len(cells)
    total = lambda p: " + ".join([lane_sum(f"{p}{i}") for i in range(n)] + [lane_sum(f"{p}r")])
    group = f" GROUP BY {key_names}" if key_names else ""
    lead = f"{key_names}, " if key_names else ""
    return (
        f"SELECT {lead}count(*) AS rows, {hex128(total('h'), total('l'))} AS digest, "
        f"{hex128(lane_sum('hr'), lane_sum('lr'))} AS row_digest FROM ({lanes_select(cells, keys, source)}){group}"
    )
