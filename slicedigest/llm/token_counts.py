"""Token counts per section from one encoding of the whole text."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.llm.encode import added_tokens, default_ranks, encoder

RULES = ("start", "most", "share")
SCHEMA = "doc_id bigint, section int, start bigint, end bigint, tokens double, crossing bigint, doc_tokens bigint"


def line_spans(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines, each with its line feed; an empty text has one empty line."""
    ends = np.flatnonzero(np.frombuffer(text, dtype=np.uint8) == 10) + 1
    if not len(ends) or ends[-1] != len(text):
        ends = np.append(ends, len(text))
    return np.concatenate([[0], ends[:-1]]), ends


def attribute(token_ends: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per span and how many of the tokens that touch it reach beyond it, for ordered, disjoint spans.

    Adds an entry at the end for what lies in no span. Token and span bounds are in the same unit.
    """
    token_starts = np.concatenate([[0], token_ends[:-1]])
    k = len(starts)
    counts, crossing = np.zeros(k + 1), np.zeros(k + 1, dtype=np.int64)
    if not len(token_ends):
        return counts, crossing
    first = np.searchsorted(ends, token_starts, side="right")  # first span that ends behind the token's start
    last = np.searchsorted(starts, token_ends, side="left") - 1  # last span that starts before its end
    inside = (first == last) & (starts[np.minimum(first, k - 1)] <= token_starts) & (token_ends <= ends[np.minimum(first, k - 1)]) if k else np.zeros(len(first), bool)
    np.add.at(counts, first[inside], 1)
    for t in np.flatnonzero(~inside):
        touched = [s for s in range(first[t], last[t] + 1) if ends[s] > starts[s]] if k else []
        parts = [(int(min(token_ends[t], ends[s]) - max(token_starts[t], starts[s])), s) for s in touched]
        parts = [(n, s) for n, s in parts if n > 0]
        for _, s in parts:
            crossing[s] += 1
        length = int(token_ends[t] - token_starts[t])
        outside = length - sum(n for n, _ in parts)
        if not parts:
            counts[k] += 1
        elif rule == "share":
            for n, s in parts:
                counts[s] += n / length
            counts[k] += outside / length
        elif rule == "most":
            n, s = max(parts, key=lambda p: (p[0], -p[1]))
            counts[s if n >= outside else k] += 1
        else:
            s = parts[0][1]
            counts[s if starts[s] <= token_starts[t] else k] += 1
    return counts, crossing


def section_tokens(docs: DataFrame, rule: str = "most", ranks_path: str | None = None, spans: str | None = None) -> DataFrame:
    """Attribute each token of every text to the section it lies in; one row per section.

    The whole text is encoded once; a token's span follows from the byte lengths of the tokens before it, and tokens meet
    sections in an ordered interval join. Sections are the text's lines, each with its line feed, or the column ``spans``,
    an array of structs with ``start`` and ``end`` (code points, end exclusive), taken in order of their start; the first of
    two that overlap keeps what they share, and null or empty entries hold nothing. A token that crosses a bound goes, by
    ``rule``: ``start`` to the section that has its first byte; ``most`` to the one that has most of its bytes, the earlier
    of equals; ``share`` to all of them by bytes. Tokens in no section count for a row of section null, given where there are
    some. ``crossing`` counts the tokens that touch the section and reach beyond it. Null text is empty; other columns are
    ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    path = ranks_path or default_ranks()
    columns = [F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text")]
    if spans:
        columns.append(F.expr(f"transform(`{spans}`, x -> struct(cast(x.start as bigint) as start, cast(x.end as bigint) as end))").alias("spans"))

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        bpe = encoder(path, added_tokens(path))
        for batch in batches:
            given = batch.get("spans") or [None] * len(batch["text"])
            for doc, text, own in zip(batch["doc_id"], batch["text"], given, strict=True):
                raw = (text or "").encode()
                ids = np.frombuffer(bpe.ids(text or ""), dtype="<u4")
                token_ends = np.cumsum(bpe.byte_lengths[ids])
                is_start = (np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80
                chars = np.concatenate([[0], np.cumsum(is_start)])
                if spans is None:
                    starts, ends = line_spans(raw)
                    points = chars[starts], chars[ends]
                else:
                    total = int(chars[-1])
                    points = _disjoint(own, total)
                    at = np.append(np.flatnonzero(is_start), len(raw))
                    starts, ends = at[points[0]], at[points[1]]
                counts, crossing = attribute(token_ends, starts, ends, rule)
                for s in range(len(starts)):
                    yield doc, s, int(points[0][s]), int(points[1][s]), float(counts[s]), int(crossing[s]), len(ids)
                if counts[-1]:
                    yield doc, None, None, None, float(counts[-1]), 0, len(ids)

    return map_rows(docs.select(*columns), run, SCHEMA)


def _disjoint(spans: list | None, total: int) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, at = [], [], 0
    known = [s for s in spans or [] if s and s["start"] is not None and s["end"] is not None]
    for s in sorted(known, key=lambda s: (s["start"], s["end"])):
        start = min(max(s["start"], at), total)
        end = max(start, min(s["end"], total))
        starts.append(start)
        ends.append(end)
        at = max(at, end)
    return np.array(starts, dtype=np.int64), np.array(ends, dtype=np.int64)
