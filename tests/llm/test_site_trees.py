"""Site trees against a plain count of what a host's pages share, and articles that must lose nothing."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

pytest.importorskip("slicedigest.llm")

from slicedigest.llm.site_style import THRESHOLD, extract, main_text  # noqa: E402


@pytest.mark.parametrize("depth", [150, 250, 20_000])
def test_deep_nesting_loses_nothing(depth):
    nest = "<div>" * depth + "<p>deep</p>" + "</div>" * depth
    assert extract(f"<div class=wrap><article>{nest}<p>after the nest</p></article></div><p>outside</p>") == "deep\nafter the nest"
    assert extract(f"<article>{'<div>' * depth}<script>no</script><nav>no</nav>{'</b>' * depth}<p>yes</p></article>") == "yes"
    assert extract(f"<article><p>first</p>{'<div>' * depth}<p>never closed") == "first\nnever closed"


def test_words_of_a_name_do_not_empty_an_article():
    kept = (
        "<header class='entry-header'><h1>Title</h1></header><div class='article-header'>Lead</div><h2 id='related-work'>Related work</h2>"
        "<div id='discussion'>Discussion</div><p class='notice-of-death'>Notice</p>"
    )
    gone = "".join(f"<div class='{c}'>no</div>" for c in ("related-posts", "ad-slot-2", "comment-list", "share buttons", "cookie-notice", "newsletter"))
    gone += "<div id='comments'>no</div><div role='complementary'>no</div><aside>no</aside><footer>no</footer><form>no</form>"
    assert extract(f"<body><article>{kept}{gone}</article>") == "Title\nLead\nRelated work\nDiscussion\nNotice"


def test_importance_alone_decides_where_markup_says_nothing(spark):
    """Pages of ``div`` with meaningless names; each name is filled with as many different texts as its number of values."""
    rng, n = random.Random(5), 16
    values = {"k1": 1, "k2": n, "k3": 2, "k4": 3, "k5": n, "k6": 1}
    texts = {k: [f"{k} text {i % v}" for i in range(n)] for k, v in values.items()}
    texts["k3"] = ["k3 text 1"] + ["k3 text 0"] * (n - 1)
    for one in texts.values():
        rng.shuffle(one)
    pages = [(i, "http://a.example/" + str(i), "<body>" + "".join(f"<div class={k}>{t[i]}</div>" for k, t in texts.items()) + "</body>") for i in range(n)]
    pages += [(n + i, f"http://b{i}.example/", html) for i, (_, _, html) in enumerate(pages)]  # alone on a host: nothing is known
    pages += pages[:3]  # equal pages count once

    def importance(k: str) -> float:
        return -sum(c / n * math.log(c / n) for c in Counter(texts[k]).values()) / math.log(n)

    low = {k for k in texts if importance(k) < THRESHOLD}
    assert low == {"k1", "k3", "k6"}
    got = sorted((r["page_id"], r["text"]) for r in main_text(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect())
    plain = lambda html, drop: "\n".join(t for k, t in re.findall(r"<div class=(\w+)>([^<]*)", html) if k not in drop)
    assert got == sorted((i, plain(html, low if "//a." in url else set())) for i, url, html in pages)
    assert all(extract(html) != plain(html, low) for _, _, html in pages[:n])  # without the tree the result differs
