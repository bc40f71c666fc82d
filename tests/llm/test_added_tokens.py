"""Ids of texts that hold added tokens equal those of the reference tokenizer at its defaults."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from slicedigest.llm.encode import added_tokens, default_ranks, encoder
from slicedigest.llm.packing import END_ID, pack_documents
from slicedigest.llm.token_counts import section_tokens

END = "<|endoftext|>"
TEXTS = [f"a {END} b", f"{END}{END}", f"x{END}\n{END}  y\n\nz", f"<|{END}|>", END.upper(), END[:-1], f"é{END}日本 {END}", "plain words\nonly", ""]


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_ids(reference):
    bpe = encoder(default_ranks(), added_tokens(default_ranks()))
    for text in TEXTS:
        ids = np.frombuffer(bpe.ids(text), dtype="<u4")
        assert ids.tolist() == reference.encode(text, add_special_tokens=False).ids, text
        assert bpe.byte_lengths[ids].sum() == len(text.encode())


def test_packing_and_sections(spark, reference):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    want = [reference.encode(t, add_special_tokens=False).ids for t in TEXTS]
    for r in pack_documents(docs).collect():
        ids = [*want[r["doc_id"]], END_ID]
        assert r["doc_tokens"] == len(ids)
        assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], dtype="<u4").tobytes())
    rows = section_tokens(docs).collect()
    for i, ids in enumerate(want):
        own = [r for r in rows if r["doc_id"] == i]
        assert all(r["doc_tokens"] == len(ids) for r in own) and sum(r["tokens"] for r in own) == len(ids)
