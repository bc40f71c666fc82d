"""Near copies by exact similarity of word shingles, for the corpus pipeline."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.llm.components import component_roots, partial_roots, shortened
from slicedigest.llm.simhash import SEED, links, majority_bits
from slicedigest.runtime import materialise

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 4
"""Texts meet if one of 32 bands of 4 least hashes agrees: 1 - (1 - 0.8 ** 4) ** 32 of the pairs at 0.8, all but 5 in 10^8."""
FIRST_BANDS = 8
"""Bands of the first round, which leaves one component of most families."""
LIKELY = 0.74
"""Share of equal least hashes from which the first round tries a pair. What it does not try is left to the second."""
PART = 2048
"""Texts of a cell that one group holds; a larger cell is dealt to several."""
NARROW = 2048
"""Sets of more shingles keep 32 bits of each in the second round, others 16."""

_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _shingle_hashes(text: str, shingle: int) -> tuple[int, np.ndarray]:
    """A hash of the text's words in order (0 if it has none) and the hashes of its shingles, repeats included."""
    import xxhash

    words = text.encode().lower().split()
    if not words:
        return 0, np.empty(0, dtype=np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)]
    key = np.uint64(xxhash.xxh64_intdigest(joined, SEED + 1)).view(np.int64)
    return int(key), np.array(hashes, dtype=np.uint64)


def shingles(text: str, shingle: int = SHINGLE) -> tuple[int, np.ndarray]:
    """A hash of the text's words in order (0 if it has none) and the sorted different hashes of its shingles."""
    key, hashes = _shingle_hashes(text, shingle)
    return key, np.unique(hashes)


def least_hashes(hashes: np.ndarray) -> np.ndarray:
    """The least value of the shingles under each of the 128 hash functions."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(0, len(hashes), 2048):
            least = np.minimum(least, (hashes[i : i + 2048, None] * _FACTORS).min(axis=0))
    return least


def band_cells(hashes: np.ndarray) -> list[int]:
    """One cell per band of least hashes; none for a text without words."""
    return _cells_of(least_hashes(hashes)) if len(hashes) else []


def _cells_of(least: np.ndarray) -> list[int]:
    import xxhash

    keys = [xxhash.xxh64_intdigest(band.tobytes(), i) for i, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype=np.uint64).view(np.int64).tolist()


def _signature(least: np.ndarray) -> bytes:
    """One byte of each least hash; the share of equal bytes of two texts estimates their similarity."""
    with np.errstate(over="ignore"):
        return (least * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(56)).astype(np.uint8).tobytes()


def similar(a: np.ndarray, b: np.ndarray, similarity: float = SIMILARITY) -> bool:
    """Whether the sets' intersection has at least ``similarity`` of their union."""
    if min(len(a), len(b)) < similarity * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return common >= similarity * (len(both) - common)


def text_key(text: str = "text") -> F.Column:
    """What tells texts apart, in 128 bits; null text differs from empty text."""
    return F.unhex(F.coalesce(F.md5(F.encode(text, "UTF-8")), F.lit("00")))


def likely_pairs(ids: list[int], signatures: np.ndarray, least: float = LIKELY) -> Iterator[tuple[int, int]]:
    """Pairs that span the texts of one group: each text with the most alike of those taken in before it."""
    best, source = np.full(len(ids), -1), np.zeros(len(ids), dtype=np.int64)
    rest = np.arange(1, len(ids))
    at = 0
    while len(rest):
        equal = (signatures[rest] == signatures[at]).sum(axis=1)
        more = equal > best[rest]
        best[rest[more]], source[rest[more]] = equal[more], at
        place = int(best[rest].argmax())
        at = int(rest[place])
        if best[at] >= least * signatures.shape[1]:
            yield ids[at], ids[source[at]]
        rest = np.delete(rest, place)


class _Group:
    """The texts of one part of a cell: their components so far and their sets, whole or in fewer bits.

    Equal shingles stay equal in fewer bits, so the count of common ones can only be too large and no pair is missed.
    """

    def __init__(self, rows: list[tuple], similarity: float):
        self.ids = [r[0] for r in rows]
        self.roots = np.array([r[1] for r in rows], dtype=np.int64)
        self.outside = np.array([r[2] for r in rows], dtype=bool)
        self.home = np.array([r[3] for r in rows], dtype=bool)
        self.sizes = np.array([r[4] for r in rows], dtype=np.int64)
        self.sets = [np.frombuffer(r[5], dtype=f"<u{r[6]}") for r in rows]
        self.width = np.array([r[6] for r in rows])
        self.similarity = similarity

    def common(self, i: int, others: np.ndarray) -> np.ndarray:
        """How many shingles of each of ``others`` the text ``i`` has, or more."""
        found = np.zeros(len(others), dtype=np.int64)
        narrow = self.width[others] == 2 if self.width[i] > 2 else np.ones(len(others), dtype=bool)
        for chosen, wide in ((np.flatnonzero(narrow), False), (np.flatnonzero(~narrow), True)):
            if not len(chosen):
                continue
            parts = [self.sets[j] for j in others[chosen]]
            joined = np.concatenate(parts)
            if wide:
                own = self.sets[i]
                place = np.minimum(np.searchsorted(own, joined), len(own) - 1)
                hit = own[place] == joined
            else:
                table = np.zeros(1 << 16, dtype=bool)
                table[self.sets[i].astype(np.uint16)] = True
                hit = table[joined.astype(np.uint16)]
            starts = np.concatenate([[0], np.cumsum([len(p) for p in parts])[:-1]])
            found[chosen] = np.add.reduceat(hit.astype(np.int64), starts)
        return found

    def pairs(self) -> Iterator[tuple[int, int]]:
        """Pairs at the similarity between different components, one at least for any two components that have one.

        A text outside the cell's main component meets all texts that are at home in this part.
        """
        for i in np.flatnonzero(self.outside):
            others = np.flatnonzero(self.home & (self.roots != self.roots[i]))
            if self.home[i]:
                others = others[~self.outside[others] | (others > i)]
            low, high = np.minimum(self.sizes[others], self.sizes[i]), np.maximum(self.sizes[others], self.sizes[i])
            others = others[low >= self.similarity * high]
            if not len(others):
                continue
            common = self.common(i, others)
            near = others[common >= self.similarity * (self.sizes[others] + self.sizes[i] - common)]
            for j in near:
                if self.roots[j] != self.roots[i]:
                    yield self.ids[i], self.ids[j]
                    self.roots[self.roots == self.roots[j]] = self.roots[i]


def _by_group(columns: list[str], solve: Callable[[list[tuple]], Iterable[tuple]]) -> Callable[[Iterable[dict]], Iterator[tuple]]:
    """Rows sorted by cell and part, handed to ``solve`` one group at a time."""

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        key, held = None, []
        for batch in batches:
            for row in zip(batch["cell"], batch["part"], *[batch[c] for c in columns], strict=True):
                if row[:2] != key:
                    yield from solve(held)
                    key, held = row[:2], []
                held.append(row[2:])
        yield from solve(held)

    return run


def near_copies(docs: DataFrame, similarity: float = SIMILARITY, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id``, ``text_key`` and ``component`` of every row of ``docs(doc_id, text)``.

    Rows link whose sets of five-word shingles have a Jaccard similarity of at least ``similarity``; words are those of
    `simhash.fingerprint`. Texts of fewer words are one shingle, texts without words are copies of each other. Texts of equal
    words meet as one class. Pairs come from the SimHash operator, whose links need no band in common, and from bands of least
    hashes; every link is confirmed on the whole sets.

    The first round tries what is most likely: SimHash links, and in the cells of some bands each text with its likeliest
    partner. Afterwards only cells that hold several components matter. In each, the texts outside its main component meet
    all others, with sets in fewer bits, which may pass a pair too many but none too few; what passes is confirmed. Cells of
    pairs that failed there are gone through once more with whole sets. Sets move once per such cell, never once per pair.
    """

    def sketched(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for doc, key, text in zip(batch["doc_id"], batch["text_key"], batch["text"], strict=True):
                c, hashes = _shingle_hashes(text or "", shingle)
                if not len(hashes):
                    yield doc, key, c, None, [], b""
                    continue
                least = least_hashes(hashes)
                yield doc, key, c, int(np.uint64(majority_bits(hashes)).view(np.int64)), _cells_of(least), _signature(least)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_key().alias("text_key"), F.col("text"))
    made = materialise(map_rows(rows, sketched, "doc_id bigint, text_key binary, c bigint, fp bigint, cells array<bigint>, sig binary"))
    classes = made.groupBy("c").agg(F.min(F.struct("text_key", "fp", "cells", "sig")).alias("m")).select("c", "m.*")
    cells = classes.select("c", F.posexplode("cells").alias("band", "cell"))
    sizes = cells.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    members = materialise(cells.join(sizes, "cell"))
    linked = materialise(_simhash_pairs(made.where("fp IS NOT NULL").select("c", "fp").distinct()))
    met = members.select("c").unionByName(linked.select(F.explode(F.array("a", "b")).alias("c"))).distinct()
    meeting = materialise(classes.join(met, "c", "left_semi").select("c", "text_key", "sig"))

    # the whole sets of the classes that meet another
    wanted = rows.select("text_key", "text").join(meeting.select("c", "text_key"), "text_key").dropDuplicates(["c"])

    def whole(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for c, text in zip(batch["c"], batch["text"], strict=True):
                hashes = shingles(text or "", shingle)[1]
                few = np.sort(hashes.astype("<u2" if len(hashes) <= NARROW else "<u4"))
                yield c, len(hashes), hashes.astype("<u8").tobytes(), few.tobytes(), few.itemsize

    sets = materialise(map_rows(wanted.select("c", "text"), whole, "c bigint, size int, held binary, few binary, width int", rows=256))

    def confirm(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for a, b, one, two in zip(batch["a"], batch["b"], batch["one"], batch["two"], strict=True):
                yield a, b, similar(np.frombuffer(one, dtype="<u8"), np.frombuffer(two, dtype="<u8"), similarity)

    def confirmed(pairs: DataFrame) -> DataFrame:
        both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a < b").distinct()
        both = both.join(sets.select(F.col("c").alias("a"), F.col("held").alias("one"), F.col("size").alias("k")), "a")
        both = both.join(sets.select(F.col("c").alias("b"), F.col("held").alias("two"), F.col("size").alias("m")), "b")
        both = both.where(F.least("k", "m") >= similarity * F.greatest("k", "m"))
        return materialise(map_rows(both.select("a", "b", "one", "two"), confirm, "a bigint, b bigint, ok boolean"))

    tried = confirmed(linked.unionByName(_first_round(members, meeting)))
    links = shortened(tried.where("ok").select("a", "b"), rounds=3)
    roots = partial_roots(links)
    placed = members.select("cell", "c").join(roots, members.c == roots.node, "left").select("cell", "c", F.coalesce("root", "c").alias("root"))
    placed = materialise(placed)
    tried = confirmed(_across(placed, sets.select("c", "size", F.col("few").alias("held"), "width"), similarity))
    edges = links.select(F.col("u").alias("a"), F.col("v").alias("b")).unionByName(tried.where("ok").select("a", "b"))
    failed = tried.where("NOT ok")
    if not failed.isEmpty():  # whole sets are needed only where fewer bits misled
        misled = failed.select(F.explode(F.array("a", "b")).alias("c")).distinct()
        again = placed.join(placed.join(misled, "c", "left_semi").select("cell").distinct(), "cell", "left_semi")
        edges = edges.unionByName(_across(again, sets.select("c", "size", "held", F.lit(8).alias("width")), similarity))
    roots = component_roots(edges)
    return made.join(roots, made.c == roots.node, "left").select("doc_id", "text_key", F.coalesce("root", "c").alias("component"))


def _simhash_pairs(classes: DataFrame) -> DataFrame:
    """Pairs of classes whose fingerprints the SimHash operator links, and each class with another of its fingerprint."""
    firsts = materialise(classes.groupBy("fp").agg(F.min("c").alias("first")))
    same = classes.join(firsts, "fp").where("c <> first").select(F.col("c").alias("a"), F.col("first").alias("b"))
    found = links(firsts.select("fp")).distinct()
    one, two = (firsts.select(F.col("fp").alias(x), F.col("first").alias(f"first_{x}")) for x in "ab")
    return same.unionByName(found.join(one, "a").join(two, "b").select(F.col("first_a").alias("a"), F.col("first_b").alias("b")))


def _part(c: str, n: str) -> F.Column:
    return F.pmod(F.xxhash64(F.lit("part"), c), F.ceil(F.col(n) / PART).cast("bigint")).cast("int")


def _first_round(members: DataFrame, meeting: DataFrame) -> DataFrame:
    """In cells of the first bands each text with its likeliest partner; parts of a large cell share one text of it."""

    def solve(held: list[tuple]) -> Iterator[tuple]:
        own = dict(held)
        if len(own) > 1:
            yield from likely_pairs(list(own), np.frombuffer(b"".join(own.values()), dtype=np.uint8).reshape(len(own), -1))

    first = members.where(F.col("band") < FIRST_BANDS)
    dealt = first.select("cell", _part("c", "n").alias("part"), "c")
    parts = F.ceil(F.col("n") / PART).cast("int")
    shared = first.where(F.col("n") > PART).groupBy("cell", parts.alias("parts")).agg(F.min("c").alias("c"))
    shared = shared.select("cell", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "c")
    groups = dealt.unionByName(shared).join(meeting.select("c", "sig"), "c")
    groups = groups.repartition("cell", "part").sortWithinPartitions("cell", "part", "c")
    return map_rows(groups, _by_group(["c", "sig"], solve), "a bigint, b bigint")


def _across(placed: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Pairs between the components of every cell that holds several; each text stays in one part, texts outside the cell's
    main component come to all of its parts."""
    counts = placed.groupBy("cell", "root").agg(F.count("*").alias("k"))
    main = counts.groupBy("cell").agg(F.max(F.struct("k", "root")).alias("m"), F.count("*").alias("roots"), F.sum("k").alias("n"))
    open_cells = main.where("roots > 1").select("cell", F.col("m.root").alias("main"), "n")
    held = placed.join(open_cells, "cell").withColumn("outside", F.col("root") != F.col("main"))
    own = _part("c", "n")
    parts = F.ceil(F.col("n") / PART).cast("int")
    home = held.select("cell", own.alias("part"), "c", "root", "outside", F.lit(True).alias("home"))
    away = held.where("outside").where(F.col("n") > PART)
    away = away.select("cell", own.alias("own"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), "c", "root", "outside")
    away = away.where("part <> own").select("cell", "part", "c", "root", "outside", F.lit(False).alias("home"))
    groups = home.unionByName(away).join(sets, "c")
    groups = groups.repartition("cell", "part").sortWithinPartitions("cell", "part", "c")
    columns = ["c", "root", "outside", "home", "size", "held", "width"]

    def solve(rows: list[tuple]) -> Iterator[tuple]:
        return _Group(rows, similarity).pairs() if len(rows) > 1 else iter(())

    return map_rows(groups, _by_group(columns, solve), "a bigint, b bigint")
