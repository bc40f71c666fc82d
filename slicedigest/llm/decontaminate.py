"""Benchmark decontamination by templates: questions whose numbers, names or units were changed are still found."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows

WINDOW = 8
"""Tokens per template window."""
LITERALS = 4
"""Fewest tokens of a window that are words, not placeholders."""
COVER = 0.5
"""Least part of an item's windows that a document must hold."""
LEAST_TOKENS = 4
"""Tokens an item without a countable window must have; a shorter one says too little to be told from ordinary text."""
WINDOW_LIMIT = 2_000_000
"""Most benchmark windows that are sent to every executor (16 bytes each); more meet the documents in a shuffled join."""
TEXT_LIMIT = 64
"""Most characters of benchmark texts that are sent, for each window of that limit."""

# Spelled numbers, and units of measure and money.
NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split()
UNITS = (
    "mm cm m km in ft yd mi mg g kg lb lbs oz ml l s sec min h hr hrs ms kb mb gb tb w kw kwh v hz usd eur gbp "
    "meter meters metre metres kilometer kilometers mile miles inch inches foot feet yard yards gram grams kilogram kilograms "
    "pound pounds ounce ounces liter liters litre litres second seconds minute minutes hour hours day days week weeks month "
    "months year years dollar dollars cent cents euro euros percent degree degrees"
).split()

# Thai to Khmer, kana, Han and its extensions, whose words no space parts; each character is a token.
UNSPACED = "\u0e01-\u0eff\u1000-\u109f\u1780-\u17ff\u3041-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"(?![\d_])(?=\w)[{UNSPACED}]|[^\W\d_{UNSPACED}]+(?:['’][^\W\d_{UNSPACED}]+)*" r"|\d+(?:[.,:/]\d+)*|[$€£%°]|[.!?\n]")
_ENDS = frozenset(".!?\n")
_SYMBOLS = frozenset("$€£%°")
_NUMBERS, _UNITS = frozenset(NUMBERS), frozenset(UNITS)
NUM, NAME, UNIT = "<num>", "<name>", "<unit>"
SLOTS = (NUM, NAME, UNIT)
CHARS = 1 << 17
"""Characters of several texts that are hashed together; a longer text goes alone."""


def _lower(text: str) -> str:
    """The text in lower case, character by character where that would change its length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def template(text: str) -> tuple[list[str], list[str]]:
    """The text's template and the tokens that it was made from.

    Digits and spelled numbers become ``<num>``; units where a number stands before them, and the signs of money, percent and
    degree anywhere, ``<unit>``; a capitalised word that does not start a sentence ``<name>``, unless more of it is in capitals.
    Other words are lowered; what lies between tokens is dropped.
    """
    kinds, words, low_text, fresh = [], [], _lower(text), True
    for match in _TOKEN.finditer(text):
        token, low = match[0], low_text[match.start() : match.end()]
        if token in _ENDS:
            fresh = True
            continue
        if low in _NUMBERS or _classes()[ord(token[0])] == _DIGIT:
            kinds.append(NUM)
        elif token in _SYMBOLS or (low in _UNITS and kinds and kinds[-1] == NUM):
            kinds.append(UNIT)
        elif not fresh and token != low and token[1:] == low[1:] and len(token) > 1:
            kinds.append(NAME)
        else:
            kinds.append(low)
        words.append(low)
        fresh = False
    return kinds, words


_LETTER, _DIGIT, _SIGN, _END, _QUOTE, _POINT, _SINGLE = 1, 2, 3, 4, 5, 6, 7
_ODD = 0x9E3779B97F4A7C15


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """What each code point is to `_TOKEN`."""
    found = np.zeros(0x110000, dtype=np.uint8)
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    for kind, pattern in ((_LETTER, r"[^\W\d_]"), (_SINGLE, rf"(?![\d_])(?=\w)[{UNSPACED}]"), (_DIGIT, r"\d"), (_SIGN, r"[$€£%°]"), (_END, r"[.!?\n]"), (_QUOTE, r"['’]"), (_POINT, r"[,:/]")):
        found[[ord(c) for c in re.findall(pattern, every)]] = kind
    return found


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as were asked for."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            with np.errstate(over="ignore"):
                for name, base in (("up", _ODD), ("down", pow(_ODD, -1, 1 << 64))):
                    powers = np.full(2 * n, base, dtype=np.uint64)
                    powers[0] = 1
                    setattr(self, name, powers.cumprod(dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _token_arrays(text: str) -> tuple[np.ndarray, ...]:
    """Per token of the text: its hash in lower case, class, start, and whether it is a word with just its first letter large."""
    raw, low = (np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in (text, _lower(text)))
    kind = np.concatenate([[0], _classes()[raw], [0]]).astype(np.uint8)  # a border on either side
    here, before, behind = kind[1:-1], kind[:-2], kind[2:]
    quote = (here == _QUOTE) & (before == _LETTER) & (behind == _LETTER)
    point = ((here == _POINT) | (raw == ord("."))) & (before == _DIGIT) & (behind == _DIGIT)
    here[quote], here[point] = _LETTER, _DIGIT
    run = (here == _LETTER) | (here == _DIGIT)
    starts = np.flatnonzero((run & (here != before)) | (here == _SIGN) | (here == _END) | (here == _SINGLE))
    ends = starts + 1
    ends[run[starts]] = np.flatnonzero(run & (here != behind)) + 1
    up, down = _POWERS.upto(len(raw) + 1)
    with np.errstate(over="ignore"):
        value = _mixed((low.astype(np.uint64) + np.uint64(1)) * np.uint64(_ODD)) * up[: len(raw)]
        sums = np.zeros(len(raw) + 1, dtype=np.uint64)
        np.cumsum(value, out=sums[1:])
        hashes = _mixed((sums[ends] - sums[starts]) * down[starts])
    large = np.concatenate([[0], np.cumsum(raw != low)])
    capital = (raw[starts] != low[starts]) & (large[ends] - large[starts] == 1) & (ends - starts > 1)
    return hashes, here[starts], starts, capital


def _hash(word: str) -> np.uint64:
    return _token_arrays(word)[0][0]


@lru_cache(maxsize=1)
def _known() -> tuple[np.ndarray, np.ndarray, dict[str, np.uint64]]:
    slots = {s: np.uint64(i + 1) for i, s in enumerate(SLOTS)}
    return *(np.sort(np.array([_hash(w) for w in words], dtype=np.uint64)) for words in (NUMBERS, UNITS)), slots


def _among(hashes: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which hashes are in a short sorted array; a table of their lowest bits settles most."""
    table = np.zeros(1 << 16, dtype=bool)
    table[(known & np.uint64(0xFFFF)).astype(np.int64)] = True
    out = table[(hashes & np.uint64(0xFFFF)).astype(np.int64)]
    out[out] = _found(hashes[out], known)
    return out


def _found(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in a sorted array."""
    if not len(known):
        return np.zeros(len(values), dtype=bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def all_hashes(texts: list[str], lengths: tuple[int, ...] = ()) -> list[tuple[np.ndarray, np.ndarray, dict[int, np.ndarray]]]:
    """For each text the hash of every window of its template, and whether the window holds enough words to count.

    For other ``lengths`` of windows, those of whole short items, there are just the hashes.

    The same template as `template` makes, for the characters of many texts at once: a token's hash is a difference of running
    sums, and a window's hash is made of its tokens'.
    """
    numbers, units, slots = _known()
    joined = "\n".join(texts)
    h, kind, starts, capital = _token_arrays(joined)
    kept = np.flatnonzero(kind != _END)
    inner = np.zeros(len(kept), dtype=bool)  # not the first of a sentence
    inner[kept > 0] = kind[kept[kept > 0] - 1] != _END
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts[kept], side="right")
    h, kind, capital = h[kept], kind[kept], capital[kept]
    number = (kind == _DIGIT) | _among(h, numbers)
    behind = np.zeros(len(kept), dtype=bool)
    behind[1:] = number[:-1] & (owner[1:] == owner[:-1])
    unit = ~number & ((kind == _SIGN) | (_among(h, units) & behind))
    name = ~number & ~unit & inner & capital
    for slot, where in ((NUM, number), (UNIT, unit), (NAME, name)):
        h[where] = slots[slot]
    n = max(0, len(kept) - WINDOW + 1)
    total = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(WINDOW if n else 0):
            total += h[i : i + n] * np.uint64(pow(_ODD, i + 1, 1 << 64))
        total = _mixed(total)
    filled = np.concatenate([[0], np.cumsum(number | unit | name)])
    good = WINDOW - (filled[WINDOW:] - filled[:-WINDOW]) >= LITERALS if n else np.zeros(0, dtype=bool)
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    last = np.maximum(first[:-1], first[1:] - WINDOW + 1)
    out = [(total[a:b].view(np.int64), good[a:b], {}) for a, b in zip(first[:-1].tolist(), last.tolist(), strict=True)]
    if lengths:
        up, down = _POWERS.upto(len(h) + 2)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * up[1 : len(h) + 1], dtype=np.uint64)])
            for n in lengths:
                whole = _mixed((sums[n:] - sums[:-n]) * down[: max(0, len(h) - n + 1)] + np.uint64(n)).view(np.int64)
                for (_, _, more), a, b in zip(out, first[:-1].tolist(), first[1:].tolist(), strict=True):
                    more[n] = whole[a : max(a, b - n + 1)]
    return out


def window_hashes(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    return [(hashes, good) for hashes, good, _ in all_hashes(texts)]


def _in_parts(texts: list[str]) -> Iterator[list[str]]:
    """Texts in order, together as long as they have ``CHARS`` characters at most."""
    part, size = [], 0
    for text in texts:
        if part and size + len(text) > CHARS:
            yield part
            part, size = [], 0
        part.append(text)
        size += len(text)
    if part:
        yield part


@dataclass
class Item:
    """A benchmark item's template, words, and places of its windows by hash.

    An item without a countable window has one window, its whole template; with too few words it must come word by word.
    """

    kinds: list[str]
    words: list[str]
    places: dict[int, list[int]]
    windows: int
    length: int = WINDOW
    whole: bool = False
    verbatim: bool = False


def prepared(text: str) -> Item:
    """Template, words and countable windows of an item's text."""
    kinds, words = template(text)
    ((hashes, good, _),) = all_hashes([text])
    places: dict[int, list[int]] = {}
    for i in np.flatnonzero(good):
        places.setdefault(int(hashes[i]), []).append(int(i))
    n = len(kinds)
    if not places and n >= LEAST_TOKENS:
        ((_, _, whole),) = all_hashes([text], (n,))
        return Item(kinds, words, {int(whole[n][0]): [0]}, 1, n, True, n - sum(k in SLOTS for k in kinds) < LITERALS)
    return Item(kinds, words, places, int(good.sum()))


def consistent(item: Item, at: list[int], words: list[str], kinds: list[str], shift: int) -> bool:
    """Whether slots were refilled by a rule: per kind of slot, all but one of the values become one value each.

    Different values may become equal, and one value may become several, as equal numbers may have different roles. An item
    that is one window has no value to spare, and none to change if its words are too few.
    """
    if item.verbatim:
        return all(item.words[i] == words[i + shift] for i in at)
    became: dict[tuple[str, str], set[str]] = {}
    for i in at:
        if item.kinds[i] in SLOTS:
            became.setdefault((item.kinds[i], item.words[i]), set()).add(words[i + shift])
    return sum(len(refills) > 1 for refills in became.values()) <= (not item.whole)


def find_item(item: Item, hashes: np.ndarray, more: dict[int, np.ndarray], kinds: list[str], words: list[str]) -> tuple[int, int, int, int] | None:
    """The best place of an item in a document: windows held, changed slots, first and last token.

    Windows that sit at one shift belong together; shifts are tried from the one that holds most, and joined by those that
    hold windows the first lacks, at most an item's length away. A shift whose slots are filled inconsistently does not count.
    """
    by_shift: dict[int, set[int]] = {}
    n = item.length
    if item.whole:
        hashes = more[n]
    for h, own in item.places.items():
        for p in np.flatnonzero(hashes == h):
            for i in own:
                if kinds[p : p + n] == item.kinds[i : i + n]:
                    by_shift.setdefault(int(p) - i, set()).add(i)
    best = None
    order = sorted(by_shift, key=lambda s: (-len(by_shift[s]), s))
    usable = {}
    for s in order:
        tokens = sorted({i + j for i in by_shift[s] for j in range(n)})
        if consistent(item, tokens, words, kinds, s):
            usable[s] = tokens
    for lead in usable:
        near = [s for s in usable if abs(s - lead) <= len(item.kinds)]
        held = set().union(*(by_shift[s] for s in near))
        changed = sum(item.words[i] != words[i + lead] for i in usable[lead])
        first = min(usable[s][0] + s for s in near)
        last = max(usable[s][-1] + s for s in near)
        if best is None or len(held) > best[0]:
            best = (len(held), changed, first, last)
        if len(held) == item.windows:
            break
    return best


SCHEMA = "doc_id bigint, item_id bigint, windows bigint, item_windows bigint, changed_slots bigint, first_token bigint, last_token bigint"


def _report(doc: int | None, found: Iterable[tuple[int, Item]], hashes: np.ndarray, more: dict, kinds: list[str], words: list[str], cover: float) -> Iterator[tuple]:
    for item_id, item in found:
        place = find_item(item, hashes, more, kinds, words)
        if place and place[0] >= cover * item.windows:
            yield doc, item_id, place[0], item.windows, *place[1:]


def contaminated(docs: DataFrame, benchmark: DataFrame, cover: float = COVER, window_limit: int = WINDOW_LIMIT) -> DataFrame:
    """One row per document and benchmark item that the document holds, as such or with other numbers, names or units.

    Texts become templates (`template`); the item's windows of eight template tokens, of which at least four are words, are
    looked up by hash among the document's and then compared token by token. A document holds an item if it has at least
    ``cover`` of its windows at places that belong together and whose slots are filled consistently (`find_item`). An
    item without such a window is one window as long as its template, and its slots must be filled consistently throughout; if
    it has less than four words, none may differ. Items of less than ``LEAST_TOKENS`` tokens are not looked for. In scripts
    without spaces each character is a token. Null and empty texts hold nothing; a null ``doc_id`` is reported as null, an
    item without an id is left out; rows that repeat are reported each, items that repeat under one id once; other columns
    are ignored; empty tables give no rows.

    Documents are never shuffled while the benchmark's windows number at most ``window_limit``, which is counted first: they
    are then sent to the executors. A larger benchmark meets the documents' windows in a join, and only texts of pairs that
    share enough windows are compared. Both ways give the same rows.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), "text").where("item_id IS NOT NULL AND text IS NOT NULL")
    items = items.groupBy("item_id").agg(F.min("text").alias("text"))

    def windows(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for item_id, text in zip(batch["item_id"], batch["text"], strict=True):
                item = prepared(text)
                for h in item.places:
                    yield item_id, h, item.windows, item.length if item.whole else None

    held = map_rows(items, windows, "item_id bigint, h bigint, n bigint, length int")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").where("text IS NOT NULL")
    looked_for = items.join(held.select("item_id").distinct(), "item_id", "left_semi")
    chars = looked_for.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    if chars <= TEXT_LIMIT * window_limit and held.count() <= window_limit:
        texts = [(r["item_id"], r["text"]) for r in looked_for.collect()]  # no longer than was counted
        return map_rows(rows, _scan(texts, cover), SCHEMA, rows=256)

    lengths = tuple(sorted(r["length"] for r in held.select("length").distinct().where("length IS NOT NULL").collect()))

    def hashed(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            keys = iter(batch["key"])
            for part in _in_parts(batch["text"]):
                for hashes, good, more in all_hashes(part, lengths):
                    key = next(keys)
                    for h in set(np.concatenate([hashes[good], *more.values()]).tolist()):
                        yield key, h

    keyed = rows.withColumn("key", F.xxhash64("text"))
    have = map_rows(keyed.select("key", "text").dropDuplicates(["key"]), hashed, "key bigint, h bigint")
    shared = have.join(held, "h").groupBy("key", "item_id", "n").agg(F.count("*").alias("c"))
    # windows that repeat in an item share a hash, so one hash may stand for several of its windows
    most = held.groupBy("item_id").agg(F.count("*").alias("hashes"))
    pairs = shared.join(most, "item_id").where(F.col("c") + F.col("n") - F.col("hashes") >= F.lit(cover) * F.col("n")).select("key", "item_id")
    joined = keyed.join(pairs, "key").join(items.withColumnRenamed("text", "item_text"), "item_id")

    def verify(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc, text, item_id, item_text in zip(*(batch[c] for c in ("doc_id", "text", "item_id", "item_text")), strict=True):
                kinds, words = template(text)
                item = prepared(item_text)
                hashes, _, more = all_hashes([text], (item.length,) if item.whole else ())[0]
                yield from _report(doc, [(item_id, item)], hashes, more, kinds, words, cover)

    return map_rows(joined.select("doc_id", "text", "item_id", "item_text"), verify, SCHEMA, rows=256)


def _scan(texts: list[tuple[int, str]], cover: float):
    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        items = {i: prepared(t) for i, t in texts}
        owners: dict[int, list[int]] = {}
        for i, item in items.items():
            for h, places in item.places.items():
                owners.setdefault(h, []).extend([i] * len(places))  # once per window that has the hash
        lengths = tuple(sorted({item.length for item in items.values() if item.whole}))
        known = np.array(sorted(owners), dtype=np.int64)
        mask = np.zeros(1 << 22, dtype=bool)  # a first look that costs less than the search
        mask[known & 0x3FFFFF] = True
        for batch in batches:
            docs = iter(batch["doc_id"])
            for part in _in_parts(batch["text"]):
                for text, (hashes, good, more) in zip(part, all_hashes(part, lengths), strict=True):
                    doc = next(docs)
                    every = [hashes[mask[hashes & 0x3FFFFF] & good], *(w[mask[w & 0x3FFFFF]] for w in more.values())]
                    maybe = np.concatenate(every) if lengths else every[0]
                    hit = set(maybe[_found(maybe, known)].tolist())
                    held = Counter()
                    for h in hit:
                        held.update(owners[h])
                    found = [(i, items[i]) for i, n in sorted(held.items()) if n >= cover * items[i].windows]
                    if found:
                        yield from _report(doc, found, hashes, more, *template(text), cover)

    return run
