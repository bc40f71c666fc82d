"""Embedding near-duplicates, token links and the conversation trie against plain versions."""

import hashlib
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import edge_tables  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from slicedigest.llm import multi_index, prefix_trie, token_links  # noqa: E402

SF = "/root/testdata/sf0.001"


# embeddings


def plain_links(rows, least=0.95):
    """``(vec_id, n_links, component_id, kept)`` of every row by comparing all pairs."""
    usable = [i for i, (_, v) in enumerate(rows) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {i: np.array(rows[i][1]) / np.linalg.norm(rows[i][1]) for i in usable}
    near = {i: [j for j in usable if j != i and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= least] for i in usable}
    out = []
    for i, (own, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        first = min((rows[j][0] for j in seen if rows[j][0] is not None), default=None)
        out.append((own, len(near.get(i, ())), first, own is not None and own == first))
    return out


def clustered(rng, size, groups, each, noise):
    rows = []
    for _ in range(groups):
        center = rng.standard_normal(size)
        rows += [center + noise * rng.standard_normal(size) for _ in range(rng.integers(1, each))]
    return [v.tolist() for v in rows]


def frame_of(spark, rows):
    made = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    return made.select("*", *[F.lit("x").alias(c) for c in ("n", "c", "cell", "block", "first", "root", "component_id")])


def key(rows):
    return sorted(rows, key=str)


def test_vectors_with_odd_rows(spark):
    rng = np.random.default_rng(1)
    vectors = clustered(rng, 16, 40, 8, 0.07) + clustered(rng, 3, 5, 4, 0.05) + clustered(rng, 1, 3, 3, 0.1)
    rows = list(enumerate(vectors))
    rows += [(1000, None), (1001, [0.0] * 16), (1002, [None, 1.0]), (1003, [float("nan")] * 16), (1004, [float("inf"), 1.0]), (1005, [])]
    rows += [(3, vectors[3]), (None, vectors[3]), (None, [1.0] * 7), (2000, [1e-200] * 16), (2001, [1e200] * 16), (2002, [-0.0, 1.0]), (2003, [0.0, 1.0])]
    found = multi_index.near_duplicate_vectors(frame_of(spark, rows), recall=1.0)
    assert key(tuple(r) for r in found.collect()) == key(plain_scaled(rows))
    assert multi_index.near_duplicate_vectors(edge_tables.empty(frame_of(spark, rows))).collect() == []


def plain_scaled(rows):
    """`plain_links` with vectors brought to size one, as squares of the smallest and largest overflow."""
    return plain_links([(i, [x / max(map(abs, v)) for x in v] if v and all(x is not None and np.isfinite(x) for x in v) and any(v) else v) for i, v in rows])


@pytest.mark.parametrize("block", [2048, 8])
def test_hot_cells_in_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    monkeypatch.setattr(multi_index, "OCCUPANCY", 16)
    rng = np.random.default_rng(2)
    center = rng.standard_normal(24)
    vectors = clustered(rng, 24, 30, 6, 0.05) + [(center + 0.08 * rng.standard_normal(24)).tolist() for _ in range(150)]
    rows = list(enumerate(vectors))
    found = {r["vec_id"]: r["n_links"] for r in multi_index.near_duplicate_vectors(frame_of(spark, rows)).collect()}
    want = {i: n for i, n, _, _ in plain_links(rows)}
    assert all(found[i] <= want[i] for i in want)
    assert sum(found.values()) >= 0.99 * sum(want.values())


def test_recall_of_the_traversal_at_the_least_cosine():
    """Partners at exactly 0.95 in random directions, of vectors that the index was not fitted on."""
    rng = np.random.default_rng(3)
    sample, own, turned = (rng.standard_normal((n, 64)) for n in (3000, 2000, 2000))
    sample, own = (x / np.linalg.norm(x, axis=1)[:, None] for x in (sample, own))
    index = multi_index.MultiIndex(sample, 200_000, 0.95, 0.999)
    turned -= (turned * own).sum(axis=1)[:, None] * own
    partner = 0.95 * own + np.sqrt(1 - 0.95**2) * turned / np.linalg.norm(turned, axis=1)[:, None]
    (_, one), (_, two) = index.margins(own)
    (i, _), (j, _) = index.margins(partner)
    reached = one[np.arange(2000), i] + two[np.arange(2000), j] <= index.limit
    assert reached.mean() >= 0.99
    visits = [len(list(multi_index.multi_sequence(one[k], two[k], index.limit))) for k in range(50)]
    cells = len(index.halves[0].codes) * len(index.halves[1].codes)
    assert max(visits) < cells / 4


def test_neighbouring_cells_share_a_shelf(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "BLOCK", 10)
    monkeypatch.setattr(multi_index, "SHELF", 10)
    sizes = {(2, 0): 4, (2, 3): 6, (2, 4): 5, (2, 7): 25, (2, 8): 9, (2, 9): 1, (5, 1): 10}
    rows = [(d, cell) for (d, cell), k in sizes.items() for _ in range(k)]
    found = {(r["d"], r["cell"]): (r["shelf"], r["blocks"]) for r in multi_index._shelves(spark.createDataFrame(rows, "d int, cell bigint")).collect()}
    assert set(found) == set(sizes) and found[2, 7] == (-8, 3)
    assert {b for key, (_, b) in found.items() if key != (2, 7)} == {1}
    assert found[2, 0] == found[2, 3] != found[2, 4]
    for d, shelf in {(d, s) for (d, _), (s, b) in found.items() if b == 1}:
        assert sum(k for (e, c), k in sizes.items() if e == d and found[e, c][0] == shelf) <= 20


def test_visitors_of_several_cells_come_to_a_shelf_once():
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((12, 6))
    vectors[6:] = vectors[:6] + 0.01 * rng.standard_normal((6, 6))
    vectors /= np.linalg.norm(vectors, axis=1)[:, None]
    def rows(cells):
        return pa.RecordBatch.from_pylist([{"c": i, "n": 1, "v": vectors[i].astype("<f8").tobytes(), "cells": mine} for i, mine in cells.items()])

    home = [rows({i: [i % 3] for i in range(4)}), rows({i: [i % 3] for i in range(4, 6)})]
    visitors = [[rows({6: [0, 1], 7: [0, 2]})], [rows({8: [2, 9]}), rows({11: [2]})]]
    found = list(multi_index._pairs_of_shelf(home, iter(visitors), 0.95))
    assert {(min(a, b), max(a, b)) for a, b, _ in found if b is not None} == {(0, 6), (2, 8), (5, 11)}
    assert sorted(a for a, b, k in found if b is None and k == 1) == [0, 2, 5, 6, 8, 11]


def test_cells_come_nearest_first():
    rng = np.random.default_rng(4)
    one, two = rng.random(7), rng.random(5)
    found = list(multi_index.multi_sequence(one, two, 0.9))
    costs = [one[i] + two[j] for i, j in found]
    assert costs == sorted(costs)
    assert set(found) == {(i, j) for i in range(7) for j in range(5) if one[i] + two[j] <= 0.9}


# token links


def plain_alignment(text, a_encode, b_pieces):
    """Tokens of both as (id, bytes), and the groups, by walking both."""
    a, b = a_encode(text), b_pieces(text)
    whole = (" " + (text or "")).encode()
    if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], [], []
    groups, i, j, at_a, at_b, start_a, start_b = [], 0, 0, 0, 0, 0, 0
    while i < len(a) or j < len(b):
        if at_a <= at_b and i < len(a):
            at_a += len(a[i][1])
            i += 1
        else:
            at_b += len(b[j][1])
            j += 1
        if at_a == at_b:
            groups.append(([x for x, _ in a[start_a:i]], [x for x, _ in b[start_b:j]]))
            start_a, start_b = i, j
    return a, b, groups


def plain_token_links(rows):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    one = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    one.encode_special_tokens = True
    two = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = {c: b for b, c in byte_letters().items()}

    def a_encode(text):
        return [(i, bytes(byte_of[c] for c in one.id_to_token(i))) for i in one.encode(" " + text, add_special_tokens=False).ids] if text else []

    def b_pieces(text):
        out = []
        for i in two.encode(text or ""):
            piece = two.id_to_piece(i)
            out.append((i, bytes([int(piece[3:5], 16)]) if two.is_byte(i) else piece.replace("▁", " ").encode()))
        return out

    made = [(doc, *plain_alignment(text, a_encode, b_pieces)) for doc, text in rows]
    counts = Counter()
    for _, _, _, groups in made:
        counts.update({(x, y) for a, b in groups for x in a for y in b})
    best = {}
    for (x, _), n in counts.items():
        best[x] = max(best.get(x, 0), n)
    out = []
    for doc, a, b, groups in made:
        links = [(x, y) for one_side, other in groups for x in one_side for y in other]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if a else ""
        out.append((doc, len(a), len(b), len(groups), len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), digest))
    return out


def byte_letters():
    """The printable letter that byte-level vocabularies write for each byte."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(x for x in range(256) if x not in kept)}


LINK_COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_token_links_of_a_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    want = plain_token_links([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert key(tuple(r) for r in token_links.token_links(docs).select(LINK_COLUMNS).collect()) == key(want)


@pytest.mark.parametrize("limits", [{}, {"SLICE": 50, "HELD_PAIRS": 10}])
def test_token_links_of_odd_texts(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(token_links, name, value)
    odd = [(20, "<|endoftext|> and <s> </s> <unk> <0x41> as plain text"), (21, " leading"), (22, "double  space\tand\r\nlines \n"), (23, "▁ mark"), (24, "ﬁ ① é \U0001d11e"), (25, "\x00 nul")]
    docs = edge_tables.documents(spark)
    docs = docs.unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"), allowMissingColumns=True)
    found = token_links.token_links(docs).select(LINK_COLUMNS).collect()
    assert key(tuple(r) for r in found) == key(plain_token_links([*edge_tables.TEXTS, *odd]))
    assert token_links.token_links(edge_tables.empty(docs)).collect() == []


def test_products_of_sparse_matrices():
    rng = np.random.default_rng(5)

    def sparse(dense):
        indptr = np.concatenate([[0], np.cumsum((dense != 0).sum(axis=1))])
        row, column = np.nonzero(dense)
        return token_links.Csr(indptr, column, dense[row, column], dense.shape[1])

    def dense(made):
        out = np.zeros((made.rows, made.columns), dtype=np.int64)
        out[made.row_numbers(), made.indices] = made.values
        return out

    for _ in range(30):
        a, b = (rng.integers(0, 3, size) * (rng.random(size) < 0.4) for size in ((5, 7), (7, 4)))
        assert (dense(sparse(a).times(sparse(b))) == a @ b).all()
        assert (dense(sparse(a).transpose()) == a.T).all()


def test_overlaps_count_shared_bytes():
    made = token_links.align(np.array([2, 5, 6, 9]), np.array([3, 6, 7, 9]))
    assert list(zip(made.overlap.row_numbers().tolist(), made.overlap.indices.tolist(), made.overlap.values.tolist(), strict=True)) == [
        (0, 0, 2), (1, 0, 1), (1, 1, 2), (2, 1, 1), (3, 2, 1), (3, 3, 2)
    ]
    assert made.groups_a.columns == 2 and len(made.shared.indices) == 3 * 2 + 1 * 2


# conversations


def plain_trie(rows):
    own = {}
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(conv, []).append((role or "", text or ""))
    made = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = tuple(own.get(c - int(np.fmod(c, 100)), [])[:h] + turns[h:])
    nodes = {}
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(turns[:d], []).append(c)
    out = []
    for path, members in nodes.items():
        below = [q for q in nodes if q[: len(path)] == path]
        childless = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        ends = ",".join(str(c) for c in sorted(members) if made[c] == path)
        out.append((
            min(members), len(path), min(nodes[path[:-1]]) if path else None, len(members),
            sum(len(q) == len(path) + 1 for q in below), len(childless), sum((len(nodes[q]) - 1) * len(q[-1][1]) for q in below if q),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return out


def odd_conversations():
    rng = np.random.default_rng(6)
    words = ["", "yes", "no", "é 𝄞", None]
    rows = []
    for c in [*range(0, 60), *range(100, 130), 250, 399, -7, -250]:
        for t in range(int(rng.integers(1, 9))):
            rows.append((c, t, ["user", "assistant", None][t % 2], words[int(rng.integers(0, 2 if t < 3 else 5))]))
    rows += [(300 + i, t, "user", f"deep {t}") for i in (0, 1, 77) for t in range(70)]
    rows += [(5, None, "system", "first of all"), (None, 1, "user", "belongs to none")]
    return rows


@pytest.mark.parametrize("shard", [4096, 7, 1])
def test_trie_of_odd_conversations(spark, monkeypatch, shard):
    monkeypatch.setattr(prefix_trie, "SHARD", shard)
    rows = odd_conversations()
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    frame = frame.select("*", *[F.lit("x").alias(c) for c in ("pos", "key", "shard", "h", "base", "head", "size", "depth", "n")])
    found = [tuple(r) for r in prefix_trie.prefix_trie(frame).collect()]
    assert key(found) == key(plain_trie(rows))


def test_trie_of_repeated_rows_and_no_rows(spark):
    frame = spark.createDataFrame([(100, 1, "user", "a"), (100, 1, "user", "a"), (101, 1, "user", "a")], "conv_id bigint, turn bigint, role string, text string")
    rows = [(r["conv_id"], r["turn"], r["role"], r["text"]) for r in frame.collect()]
    assert key(tuple(r) for r in prefix_trie.prefix_trie(frame).collect()) == key(plain_trie(rows))
    assert prefix_trie.prefix_trie(edge_tables.empty(frame)).collect() == []
