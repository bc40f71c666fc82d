"""A quality score from how well zstandard dictionaries of good and of bad text compress a document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows

CHUNK = 512
"""Bytes compressed at once, so that a dictionary counts as much at a long text's end as at its start."""
LEVEL = 3
DICTIONARY_BYTES = 65_536
SAMPLE_ROWS = 4_000
"""Most labelled rows per label from which dictionaries are built, and again from which the score is calibrated."""
SAMPLE_CHUNKS = 8
"""Chunks that one labelled text adds to a dictionary's sample, spread evenly over it."""


@dataclass(frozen=True)
class QualityModel:
    """Two dictionaries and the weights that turn their features into a probability."""

    good: bytes
    bad: bytes
    weights: tuple[float, ...]


def held_out(doc_id: str = "doc_id") -> F.Column:
    """Rows never learnt from: the CRC-32 of the id as text leaves 1 when divided by 3. A null id is not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def chunks(text: str) -> list[bytes]:
    raw = text.encode()
    return [raw[i : i + CHUNK] for i in range(0, len(raw), CHUNK)]


class _Sizes:
    """Compressed sizes of whole texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes):
        import zstandard

        self._by = []
        for data in (good, bad):
            book = zstandard.ZstdCompressionDict(data)
            book.precompute_compress(level=LEVEL)
            self._by.append(zstandard.ZstdCompressor(level=LEVEL, dict_data=book, write_content_size=False, write_dict_id=False))

    def features(self, text: str) -> tuple[float, float, float]:
        """The normalised size difference, the size of the smaller form per byte, and a term that fades with the length."""
        parts = chunks(text)
        n = sum(map(len, parts)) or 1
        good, bad = (sum(len(c.compress(p)) for p in parts) for c in self._by)
        return (good - bad) / n, min(good, bad) / n, n**-0.5


def _design(features: np.ndarray) -> np.ndarray:
    d, size, fade = features.T
    return np.column_stack([np.ones(len(d)), 10 * d, 10 * d * fade, 10 * size, 10 * size**2, fade])


def probability(features: np.ndarray, weights: tuple[float, ...]) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(_design(features) @ np.array(weights), -30, 30)))


def _calibrate(features: np.ndarray, labels: np.ndarray, counts: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, ...]:
    """Weights of a logistic regression by Newton's method; each row counts ``counts`` times."""
    x, w = _design(features), np.zeros(6)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (counts * (labels - p)) - ridge * w
        hess = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(6)
        step = np.linalg.solve(hess, grad)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def _dictionary(samples: list[bytes], size: int) -> bytes:
    """A trained dictionary, or plain sample text where there are too few samples to train on."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:].rjust(8, b" ")


def fit_quality(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, dictionary_bytes: int = DICTIONARY_BYTES) -> QualityModel | None:
    """Learn from labelled rows that are not held out; None if one of the labels has none.

    Per label at most ``2 * sample_rows`` rows are taken, in the order of a hash of their id; half of them, told apart by
    another hash, build the dictionaries and half calibrate the score. All learnable labels are counted, and a sampled row
    stands for its label's full count over the sampled one, so the sample's bound does not move the score. Texts are cut and compressed on the executors: the
    driver gets at most ``SAMPLE_CHUNKS`` chunks of a text, or three numbers for it.
    """
    marks = labels.select(F.col("doc_id").alias("i"), F.col("quality").cast("int").alias("q")).where("q in (0, 1)").where(~held_out("i"))
    full = {r["q"]: r["count"] for r in marks.distinct().groupBy("q").count().collect()}
    order = F.xxhash64(F.lit("quality"), "i")
    taken = [marks.where(F.col("q") == q).groupBy("i").agg(F.min("q").alias("q")).orderBy(order, "i").limit(2 * sample_rows) for q in (0, 1)]
    chosen = taken[0].unionByName(taken[1]).select("i", "q", (F.pmod(F.xxhash64(F.lit("half"), "i"), F.lit(2)) == 0).alias("build"))
    rows = docs.select(F.col("doc_id").alias("i"), F.col("text")).join(F.broadcast(chosen), "i")  # at most 4 * sample_rows ids

    def pieces(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for i, q, text in zip(batch["i"], batch["q"], batch["text"], strict=True):
                parts = chunks(text or "")
                for k in sorted({len(parts) * j // SAMPLE_CHUNKS for j in range(SAMPLE_CHUNKS)} if parts else ()):
                    yield i, q, k, parts[k]

    got = map_rows(rows.where("build").select("i", "q", "text"), pieces, "i bigint, q int, k int, part binary").collect()
    samples: dict[int, list[bytes]] = {0: [], 1: []}
    for row in sorted(got, key=lambda r: (r["i"], r["k"], bytes(r["part"]))):
        samples[row["q"]].append(bytes(row["part"]))
    if not samples[0] or not samples[1]:
        return None
    good, bad = _dictionary(samples[1], dictionary_bytes), _dictionary(samples[0], dictionary_bytes)

    def measured(batches: Iterable[dict]) -> Iterator[tuple]:
        sizes = _Sizes(good, bad)
        for batch in batches:
            for i, q, text in zip(batch["i"], batch["q"], batch["text"], strict=True):
                yield i, q, *sizes.features(text or "")

    rest = map_rows(rows.where("not build").select("i", "q", "text"), measured, "i bigint, q int, a double, b double, c double").collect()
    if len({r["q"] for r in rest}) < 2:
        return None
    rest.sort(key=tuple)
    stands_for = {q: n / min(n, 2 * sample_rows) for q, n in full.items()}
    counts = np.array([stands_for[r["q"]] for r in rest])
    counts *= len(counts) / counts.sum()
    return QualityModel(good, bad, _calibrate(np.array([r[2:] for r in rest]), np.array([r["q"] for r in rest], dtype=float), counts))


def score_quality(docs: DataFrame, model: QualityModel | None) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row, from its whole text alone.

    A higher score means that label 1 is likelier; ``predicted`` is 1 from 0.5 on. Null text is scored as empty. Without a
    model every score is 0.5. Repeated rows are scored each; other columns are ignored.
    """

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        sizes = _Sizes(model.good, model.bad) if model else None
        for batch in batches:
            if sizes is None:
                scores = [0.5] * len(batch["text"])
            else:
                scores = probability(np.array([sizes.features(t or "") for t in batch["text"]]), model.weights).tolist()
            for doc, out, s in zip(batch["doc_id"], batch["held_out"], scores, strict=True):
                yield doc, out, s, int(s >= 0.5)

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), held_out().alias("held_out"), "text")
    return map_rows(rows, run, "doc_id bigint, held_out boolean, score double, predicted int")
