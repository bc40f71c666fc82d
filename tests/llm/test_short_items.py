"""Benchmark items without a countable window of eight tokens, against a plain search of templates."""

from __future__ import annotations

import pytest

pytest.importorskip("slicedigest.llm")

from slicedigest.llm.decontaminate import LITERALS, SLOTS, contaminated, template, window_hashes  # noqa: E402

ITEMS = {
    1: "What is the capital of France?",
    2: "Compute 3 + 4 * 7 - 12 / 5 for x.",
    3: "法国的首都是哪一座城市？",
    4: "Is 5 or 7 less than 5?",
    5: "Why not",
    6: "เมืองหลวงของฝรั่งเศสคือเมืองอะไร",
    7: "",
}
FILLER = "and so on it goes with words that are in no question at all "
DOCS = [
    (1, f"{FILLER}. What is the capital of France? {FILLER}"),
    (2, f"{FILLER}. What is the capital of Spain? {FILLER}"),
    (3, f"{FILLER}. What is the capital city of France? {FILLER}"),
    (4, f"{FILLER}. Compute 3 + 4 * 7 - 12 / 5 for x. {FILLER}"),
    (5, f"{FILLER}. Compute 3 + 4 * 7 - 12 / 6 for x. {FILLER}"),  # too few words to take other numbers for the same question
    (6, f"前文。请问法国的首都是哪一座城市？后文{FILLER}"),
    (7, f"前文。请问德国的首都是哪一座城市？后文{FILLER}"),
    (8, "Is 6 or 8 less than 6?"),
    (9, "Is 6 or 8 less than 9?"),  # what was one number became two
    (10, "Why not"),
    (11, f"ก่อนเมืองหลวงของฝรั่งเศสคือเมืองอะไรหลัง {FILLER}"),
    (12, FILLER * 50),
    (13, None),
    (14, ""),
    (None, "what is the capital of France"),
]


def plain(text: str | None, item: str) -> bool:
    kinds, words = template(item)
    own_kinds, own_words = template(text or "")
    n = len(kinds)
    if n < 4:
        return False
    for p in range(len(own_kinds) - n + 1):
        if own_kinds[p : p + n] == kinds:
            there = own_words[p : p + n]
            if sum(k not in SLOTS for k in kinds) < LITERALS:
                if there == words:
                    return True
            elif len({(k, w) for k, w in zip(kinds, words) if k in SLOTS}) == len({(k, w, t) for k, w, t in zip(kinds, words, there) if k in SLOTS}):
                return True
    return False


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_short_items_and_scripts_without_spaces(spark, limit):
    docs = spark.createDataFrame(DOCS, "doc_id bigint, text string")
    items = spark.createDataFrame(list(ITEMS.items()), "item_id bigint, text string")
    got = {(r["doc_id"], r["item_id"]) for r in contaminated(docs, items, window_limit=limit).collect()}
    short = {(d, i) for d, t in DOCS for i in (1, 2, 4, 5, 7) if plain(t, ITEMS[i])}
    assert {(d, i) for d, i in got if i in (1, 2, 4, 5, 7)} == short
    assert {(1, 1), (2, 1), (None, 1), (4, 2), (8, 4)} == short
    assert {(d, i) for d, i in got if i == 3} >= {(6, 3)} and {(d, i) for d, i in got if i == 6} == {(11, 6)}
    assert all(d in (6, 7) for d, i in got if i == 3)


def test_hashes_of_single_characters_follow_the_template():
    for text in (DOCS[5][1] * 3, DOCS[10][1] * 3, "カタカナとひらがな、漢字。abc漢字def 12漢3 ๑๒ ไทย_ก漢'字's"):
        kinds = template(text)[0]
        ((hashes, _),) = window_hashes([text])
        windows = [tuple(kinds[i : i + 8]) for i in range(len(kinds) - 7)]
        assert len(hashes) == len(windows) and len(set(hashes.tolist())) == len(set(windows))
