"""The pipeline's stages do the whole job: near copies by similarity, decisions by row."""

import random
import sys
from itertools import combinations
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import edge_tables  # noqa: E402
import pytest  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from slicedigest.llm import shingle_copies  # noqa: E402
from slicedigest.llm.simhash import DISTANCE, majority_bits  # noqa: E402

SF = "/root/testdata/sf0.001"


def plain_shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def plain_components(texts, similarity=0.8):
    """For each text the place of the first text of its component."""
    sets, owner = [plain_shingles(t) for t in texts], list(range(len(texts)))

    def root(i):
        while owner[i] != i:
            i = owner[i]
        return i

    for i, j in combinations(range(len(texts)), 2):
        if len(sets[i] & sets[j]) >= similarity * len(sets[i] | sets[j]):
            one, two = root(i), root(j)
            owner[max(one, two)] = min(one, two)
    return [root(i) for i in range(len(texts))]


def edited(rng, words, n):
    out = list(words)
    for i in rng.sample(range(len(out)), n):
        out[i] = f"edit{rng.randrange(10**9)}"
    return out


def near_texts():
    """Families of 200-word texts with zero to six edited words, one family large enough for a crowded cell."""
    rng = random.Random(3)
    texts = []
    for family in range(12):
        base = [f"w{rng.randrange(10**6)}" for _ in range(200)]
        texts += [" ".join(edited(rng, base, k % 7)) for k in range(90 if family == 0 else 5)]
    rng.shuffle(texts)
    return [*texts, "short text", "Short  text", "short", "", " "]


def test_near_duplicate_stage_finds_pairs_from_similarity_08(spark):
    texts = near_texts()
    docs = spark.createDataFrame([(i, t, len(t)) for i, t in enumerate(texts)], "doc_id bigint, text string, n_chars bigint").repartition(3)
    want = {i for i, r in enumerate(plain_components(texts)) if r == i}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicate(spark, docs, SF).collect()} == want


@pytest.mark.parametrize("parts", [{}, {"PART": 16}, {"LIKELY": 2.0}, {"PART": 16, "NARROW": 0, "LIKELY": 2.0}])
def test_crowded_cells_leave_whole_components(spark, monkeypatch, parts):
    """Also dealt to many parts, with wide sets, and with nothing tried before cells are compared across components."""
    for name, value in parts.items():
        monkeypatch.setattr(shingle_copies, name, value)
    texts = near_texts()
    rows = shingle_copies.near_copies(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    groups = {}
    for r in rows:
        groups.setdefault(r["component"], set()).add(r["doc_id"])
    plain = {}
    for i, r in enumerate(plain_components(texts)):
        plain.setdefault(r, set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, plain.values()))


def test_near_duplicate_stage_keeps_one_row_of_repeated_rows_and_rows_without_id(spark):
    docs = edge_tables.documents(spark).unionByName(edge_tables.documents(spark).where("doc_id IS NULL"))
    rows = corpus_pipeline.near_duplicate(spark, docs, SF).collect()
    first = {}
    for doc, text in sorted(edge_tables.TEXTS, key=lambda r: (r[0] is None, r[0] or 0)):
        first.setdefault(" ".join((text or "").split()), (doc, text))
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in rows))) == sorted(map(str, first.values()))


def test_stages_judge_rows_by_their_text(spark, monkeypatch, tmp_path):
    item = "Alice walked seven miles from the old mill to the market and bought four baskets of ripe apples for her mother"
    clean = "Nothing here is taken from any list of questions although it has a few words of its own to say about that"
    rows = [(1, item), (1, clean), (None, item), (None, clean), (2, None), (None, None)]
    docs = spark.createDataFrame([(d, t, len(t or "")) for d, t in rows], "doc_id bigint, text string, n_chars bigint")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1)], "doc_id bigint, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    want = sorted(str(r) for r in rows if r[1] != item)
    assert sorted(str((r["doc_id"], r["text"])) for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect()) == want
    monkeypatch.setattr(corpus_pipeline, "score_quality", lambda d, m: d.select("doc_id", F.when(d.text == item, 0.1).otherwise(0.9).alias("score")))
    assert sorted(str((r["doc_id"], r["text"])) for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()) == want


def test_fewer_bits_never_miss_a_pair():
    rng = random.Random(5)
    for size in (3, 40, 3000):
        base = [rng.getrandbits(64) for _ in range(size)]
        sets = [sorted({*base[k * size // 40 :], *(rng.getrandbits(64) for _ in range(k * size // 50))}) for k in range(12)]
        for width in (2, 4, 8):
            kept = [shingle_copies.np.sort(shingle_copies.np.array(s, dtype="u8").astype(f"<u{width}")) for s in sets]
            rows = [(i, i, True, True, len(s), k.tobytes(), width) for i, (s, k) in enumerate(zip(sets, kept, strict=True))]
            group = shingle_copies._Group(rows, 0.8)
            for i in range(12):
                common = group.common(i, shingle_copies.np.arange(12))
                whole = [len(set(sets[i]) & set(s)) for s in sets]
                assert all(c >= w for c, w in zip(common, whole, strict=True))
                assert width < 8 or common.tolist() == whole


def test_simhash_links_need_no_band_in_common(spark):
    """A line that repeats makes fingerprints alike, while the sets, which count it once, share no band."""
    line = "one two three four five six seven eight nine ten eleven twelve " * 60
    texts = [line + " ".join(f"own{n}x{i}" for i in range(9)) for n in range(24)]
    hashes = [shingle_copies._shingle_hashes(t, shingle_copies.SHINGLE)[1] for t in texts]
    bands = [set(shingle_copies.band_cells(h)) for h in hashes]
    bits = [majority_bits(h) for h in hashes]
    apart = [(i, j) for i, j in combinations(range(24), 2) if not bands[i] & bands[j] and (bits[i] ^ bits[j]).bit_count() <= DISTANCE]
    i, j = apart[0]
    docs = spark.createDataFrame([(0, texts[i]), (1, texts[j]), (2, "another text of more than five words")], "doc_id bigint, text string")
    for similarity, components in ((0.3, 2), (0.9, 3)):
        found = shingle_copies.near_copies(docs, similarity=similarity)
        assert found.select("component").distinct().count() == components
