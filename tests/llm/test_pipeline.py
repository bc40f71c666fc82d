"""The pipeline against its stages' plain versions, and on odd tables."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
import edge_tables  # noqa: E402
from test_whole_stages import plain_components  # noqa: E402

import corpus_pipeline  # noqa: E402
from slicedigest.llm.quality import fit_quality, score_quality  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages_in_order_and_their_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = {r["doc_id"] for r in score_quality(docs, fit_quality(docs, labels)).collect() if r["score"] >= 0.5}
    made = docs
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, made, SF).write.parquet(f"{tmp_path}/{i}")
        made = spark.read.parquet(f"{tmp_path}/{i}")
        if name != "packing":
            assert made.columns == docs.columns
        rows = {r["doc_id"]: r["text"] for r in made.collect()} if name != "packing" else None
        if name == "quality":
            assert set(rows) == kept
        if name == "near_duplicate":
            ids = sorted(kept)
            kept = {ids[i] for i, first in enumerate(plain_components([texts[d] or "" for d in ids])) if first == i}
            assert set(rows) == kept
        if name == "decontamination":
            items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            assert set(rows) == {d for d in kept if not any(t in (texts[d] or "") for t in items)}
            kept = set(rows)
        if name == "secrets":
            assert set(rows) == kept
            assert all(("[secret]" in (t or "")) == (t != texts[d]) for d, t in rows.items())
        if name == "packing":
            assert {r["doc_id"] for r in made.collect()} == kept
    assert corpus_pipeline.run(spark, SF).count() == made.count()


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES[:4]])
def test_stages_on_odd_tables(spark, stage):
    docs = edge_tables.documents(spark)
    assert stage(spark, docs, SF).columns == docs.columns
    rows = stage(spark, docs, SF).collect()
    assert rows and all(r[c] == "x" for r in rows for c in edge_tables.CLASHING)
    assert stage(spark, edge_tables.empty(docs), SF).collect() == []
    assert corpus_pipeline.packing(spark, docs, SF).count() > len(edge_tables.TEXTS)
