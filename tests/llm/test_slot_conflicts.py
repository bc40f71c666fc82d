"""Re-parameterised questions whose slots were not refilled one to one are found."""

import pytest

from slicedigest.llm.decontaminate import contaminated

ITEM = "a farmer buys 3 apples at the market and pays 5 dollars for them then after 3 days sells all of them to a friend in the town"
FOUND = [
    ITEM.replace("3", "4").replace("5", "4"),  # different values become equal
    ITEM.replace("3 apples", "4 apples").replace("3 days", "6 days"),  # equal values with different roles
    ITEM.replace("3 days", "9 days"),  # verbatim but for one repeated number
]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_one_conflict_does_not_hide_an_item(spark, limit):
    docs = spark.createDataFrame([*enumerate(FOUND), (9, "words of another kind " * 20)], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    assert {r["doc_id"] for r in contaminated(docs, items, window_limit=limit).collect()} == {0, 1, 2}
