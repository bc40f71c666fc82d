"""Pages, archives, vectors, shards and decontamination against plain versions of themselves."""

import hashlib
import struct
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import edge_tables  # noqa: E402

from slicedigest.llm.decontaminate import SLOTS, contaminated, template, window_hashes  # noqa: E402
from slicedigest.llm import knn, sharding  # noqa: E402
from slicedigest.llm.knn import top_k  # noqa: E402
from slicedigest.llm.sharding import communication_matrix, part_count, shard_sizes, shuffle_into_shards  # noqa: E402
from slicedigest.llm.site_style import branch_importance, extract, main_text  # noqa: E402
from slicedigest.llm.warc import ArchiveError, archive_frames, make_record, parse_record, read_archive, read_archives, resolve_revisits, write_archives  # noqa: E402

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a = "</p><article>x";</script></head><body class="has-sidebar">
<header class="site"><h1>Site</h1></header><nav><ul><li>Menu</ul></nav><div id="cookie-notice">We use cookies</div><form action=/s><input value=q>Search</form>
<div class="layout with-sidebar"><article class="post"><header><h1>Head &amp; line</h1></header><p>First   <b>bold</b>\n text<p>Second &eacute;<br>third
<div class="ad">Buy</div><ul><li>one<li>two</ul><aside>Related</aside><table><tr><td>a<td>b</table>
<div class="comments"><article class="comment"><p>I liked it</p></article></div></article><div class="sidebar"><p>More</p></div></div>
<footer>&copy; me</footer></body></html>"""
TEXT = "Head & line\nFirst bold text\nSecond é\nthird\none\ntwo\na\nb"


def test_extraction_by_markup():
    assert extract(PAGE) == TEXT
    assert extract("") == extract("<!-- a --><script>x") == ""
    assert extract("plain &lt;text&gt; <p>open <b>never closed") == "plain <text>\nopen never closed"
    assert extract("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert extract("<body><form><div class=ad><main><p>kept</p></main></div></form>") == "kept"
    assert extract("<body><div class=header>no</div><div class=entry-content><p>yes</p></div><p>outside</p>") == "yes"
    assert extract("<article><p>cut &am") == "cut &am"


def test_site_trees_remove_what_repeats(spark):
    page = "<html><body><div class=x1><p>Same on all pages of the site</p></div><div class=x2><p>Own text {0}</p><p>and more {0}</p></div><div class=x3>Same end</div></body></html>"
    rows = [(i, f"https://A.example.org:80/{i}", page.format(i)) for i in range(6)]
    rows += [(10 + i, f"https://b.example.org/{i}", page.format(0)) for i in range(6)]  # copies are one page and tell nothing
    rows += [(20, None, page.format(7)), (21, "nowhere", None), (22, "https://c.example.org/", "")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").select("*", *[F.lit("x").alias(c) for c in ("host", "path", "low", "text", "pages")])
    got = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    for i in range(6):
        assert got[i] == f"Own text {i}\nand more {i}"
        assert got[10 + i] == "Same on all pages of the site\nOwn text 0\nand more 0\nSame end"
    assert got[20].startswith("Same on all") and got[21] == got[22] == ""
    shares = {r["importance"] for r in branch_importance(frame.where("page_id < 6")).collect()}
    assert 0.0 in {round(s, 9) for s in shares} and 1.0 in {round(s, 9) for s in shares}
    assert main_text(frame.where("false")).collect() == []


def test_articles_of_the_table_come_out_whole(spark):
    import html as entities
    import re

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in main_text(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        inner = re.search(r"<article>(.*?)</article>", r["html"], re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub(r"</?b>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", inner)]
        want = "\n".join(b for b in blocks if b)
        assert got[r["page_id"]] == (want, len(want))


def warc_pages(spark):
    big, small = "<p>" + "long enough to be found again " * 60, "<p>short"
    rows = [(1, "http://a/1", big), (2, "http://a/2\r\nX: é", big), (7, None, big), (3, "u", small), (4, "u", small), (5, "u", None), (6, "", "é" * 700), (8, "u", "")]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("sha1", F.lit("clash")).repartition(3), rows


def test_archives_round_trip(spark, tmp_path):
    frame, rows = warc_pages(spark)
    write_archives(frame, f"file://{tmp_path}/a")
    got = {r["page_id"]: r for r in resolve_revisits(read_archives(spark, f"file://{tmp_path}/a")).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        raw = (html or "").encode()
        r = got[page]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(raw), hashlib.sha1(raw).hexdigest())
        revisit = page in (1, 2)
        assert (r["record_type"], r["refers_to_page"]) == (("revisit", 7) if revisit else ("response", None))
        assert bytes(r["payload"]) == (b"" if revisit else raw)
    write_archives(frame.where("false"), f"file://{tmp_path}/b")
    assert read_archives(spark, f"file://{tmp_path}/b").collect() == []


def one_archive(n=40):
    payloads = [f"<p>page {i} ".encode() + b"some shared words of a site " * 20 for i in range(n)]
    return payloads, list(archive_frames((make_record(i, f"http://h/{i}", p, hashlib.sha1(p).hexdigest(), None), p) for i, p in enumerate(payloads)))


def test_frames_decode_one_by_one_with_plain_and_packed_dictionaries():
    payloads, frames = one_archive()
    book = frames[0][8:]
    packed = zstandard.ZstdCompressor().compress(book)
    for first in (frames[0], struct.pack("<II", 0x184D2A5D, len(packed)) + packed):
        gap = struct.pack("<II", 0x184D2A53, 3) + b"abc"
        records = list(read_archive(first + gap.join(frames[1:])))
        assert [parse_record(r)[2] for _, r, _ in records] == payloads
        assert not any(e for _, _, e in records)
    assert list(read_archive(b"")) == []
    assert list(read_archive(b"no archive at all"))[0][2].startswith("no frame")


def test_damage_is_reported_and_never_fatal():
    payloads, frames = one_archive(12)
    whole = b"".join(frames)
    sound = {hashlib.sha1(p).hexdigest() for p in payloads}
    rng = np.random.default_rng(3)
    for at in rng.integers(0, len(whole), 150):
        data = bytearray(whole)
        data[at] ^= 1 << int(rng.integers(8))
        good = 0
        for _, record, error in read_archive(bytes(data)):
            if error is None:
                try:
                    good += hashlib.sha1(parse_record(record)[2]).hexdigest() in sound
                except ArchiveError:
                    pass
        assert good <= len(payloads)
    cut = list(read_archive(whole[: -len(frames[-1]) // 2]))
    assert cut[-1][2] and len(cut) >= 11


@pytest.mark.parametrize(
    "change",
    [
        lambda r: r.replace(b"WARC/1.1", b"HTTP/1.1"),
        lambda r: r.replace(b"Content-Length: ", b"Content-Length: 1", 1) if r.count(b"Content-Length") == 1 else r[:-1],
        lambda r: r.replace(b"WARC-Type", b"X-Type"),
        lambda r: r.replace(b"words", b"woods"),
        lambda r: r[:-3],
        lambda r: r.replace(b"WARC-Date: ", b"WARC-Date; "),
        lambda r: b"",
    ],
)
def test_wrong_records_are_refused(change):
    payload = b"a few words"
    record = make_record(1, "http://h/", payload, hashlib.sha1(payload).hexdigest(), None)
    assert parse_record(record)[2] == payload
    with pytest.raises(ArchiveError):
        parse_record(change(record))


def plain_top_k(rows, k=10):
    usable = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, a in usable:
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in usable if i != q and len(b) == len(a))[:k]
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("k", [1, 3, 40, 60])
def test_one_product_finds_the_best_of_many_queries(k):
    rng = np.random.default_rng(8)
    ids, table = np.arange(5, 45), rng.integers(-2, 3, (40, 4)).astype(float)
    asked, queries = np.array([7, 100, 3]), rng.integers(-2, 3, (3, 4)).astype(float)
    queries[1] = 0  # every candidate ties
    want = []
    for query, vector in zip(asked, queries):
        best = sorted((-int(v @ vector), int(i)) for i, v in zip(ids, table) if i != query)[:k]
        want += [(int(query), i, -score) for score, i in best]
    found = knn._best(asked, queries, ids, table, k)
    assert sorted(zip(*found.to_pydict().values())) == sorted(want)


def test_top_k_of_vectors_without_components(spark):
    rows = [(i, []) for i in range(12)] + [(100, [1.0, 2.0]), (101, [0.5, 0.25])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert {tuple(r) for r in top_k(frame, 3).collect()} == plain_top_k(rows, 3)


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(700)]
    rows += [(1000 + i, [0.5] * 8) for i in range(400)] + [(2000 + i, rng.normal(size=3).astype(np.float32).tolist()) for i in range(5)]
    rows += [(3000, None), (3001, [None] + [0.0] * 7), (3100, [float("nan")] * 8), (3200, [float("inf")] * 8), (3300, []), (3301, []), (None, [1.0] * 8), (3400, [0.0] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").select("*", *[F.lit("x").alias(c) for c in ("id", "v", "d", "cell", "far", "rank", "score")])
    got = {tuple(r) for r in top_k(frame).collect()}
    assert got == plain_top_k(rows)
    assert top_k(frame.where("false")).collect() == []
    assert top_k(frame.where("vec_id % 100 <> 0")).collect() == []


def test_rows_move_once_on_their_way_to_shards(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    lines = shuffle_into_shards(docs, 3, ["doc_id", "text"])._jdf.queryExecution().executedPlan().toString().splitlines()
    (at,) = [n for n, line in enumerate(lines) if "FileScan" in line]
    depth, above = lines[at].index("- "), []
    for line in reversed(lines[:at]):
        if "- " in line and line.index("- ") < depth:
            depth = line.index("- ")
            above.append(line[depth + 2 :].split()[0])
    assert above.count("Exchange") == 1 and "Window" in above


def test_rows_of_one_key_in_runs_of_bounded_length(spark, monkeypatch):
    monkeypatch.setattr(sharding, "LARGEST_PART_ROWS", 7)
    rows = spark.createDataFrame([(1, n) for n in range(50)] + [(n, n) for n in range(100, 130)] + [(None, 0)], "id bigint, other int")
    found = shuffle_into_shards(rows, 4, ["id"]).collect()
    assert sorted((r["id"] or 0, r["other"]) for r in found) == sorted((r["id"] or 0, r["other"]) for r in rows.collect())
    slots = defaultdict(list)
    for r in found:
        slots[r["shard"]].append(r["slot"])
    assert sorted(len(s) for s in slots.values()) == [20, 20, 20, 21]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_communication_matrix_has_exact_sums():
    rng = np.random.default_rng(4)
    for _ in range(50):
        parts = rng.integers(0, 40, int(rng.integers(1, 20)))
        sizes = shard_sizes(int(parts.sum()), int(rng.integers(1, 9)))
        matrix = communication_matrix(parts, sizes, int(rng.integers(1000)))
        assert (matrix >= 0).all() and (matrix.sum(axis=1) == parts).all() and (matrix.sum(axis=0) == sizes).all()
    large = communication_matrix(np.array([10**10, 5, 3 * 10**10]), shard_sizes(4 * 10**10 + 5, 24))
    assert (large >= 0).all() and (large.sum(axis=1) == [10**10, 5, 3 * 10**10]).all()
    counts = Counter(int(communication_matrix(np.array([2, 2]), np.array([2, 2]), s)[0, 0]) for s in range(3000))
    assert all(abs(counts[n] / 3000 - p) < 0.04 for n, p in ((0, 1 / 6), (1, 4 / 6), (2, 1 / 6)))


def test_shards(spark):
    docs = edge_tables.documents(spark)
    for frame in (docs, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), docs.where("false")):
        for seed in (1, 2):
            rows = shuffle_into_shards(frame, 7, ["doc_id", "text"], seed).select("doc_id", "text", "shard", "slot").collect()
            assert Counter((r["doc_id"], r["text"]) for r in rows) == Counter((r["doc_id"], r["text"]) for r in frame.select("doc_id", "text").collect())
            slots = defaultdict(list)
            for r in rows:
                slots[r["shard"]].append(r["slot"])
            assert all(sorted(s) == list(range(len(s))) for s in slots.values())
            assert sorted(map(len, slots.values()), reverse=True) == [n for n in shard_sizes(len(rows), 7).tolist() if n]


def test_shuffle_is_uniform_over_shards_and_slots(spark):
    frame = spark.range(6000).withColumnRenamed("id", "doc_id")
    assert part_count(6000) == 3
    rows = shuffle_into_shards(frame, 4, ["doc_id"], 9).toPandas()
    for half in (rows[rows["doc_id"] < 3000], rows[rows["doc_id"] >= 3000]):
        assert all(abs(n - 750) < 120 for n in half.groupby("shard").size())
    assert abs(np.corrcoef(rows["doc_id"], rows["slot"])[0, 1]) < 0.06
    again = shuffle_into_shards(frame.repartition(5), 4, ["doc_id"], 9).toPandas()
    assert set(map(tuple, rows.to_numpy())) == set(map(tuple, again.to_numpy()))


QUESTION = "Anna has 3 apples and gives 2 kg of them to her friend Ben, who sells each for 5 dollars. How much money does the friend of Anna get in all when 3 apples weigh 2 kg?"
SAME_RULE = "Zoe has 40 apples and gives 7 lbs of them to her friend Tom, who sells each for 11 euros. How much money does the friend of Zoe get in all when 40 apples weigh 7 lbs?"
BROKEN_RULE = "Zoe has 40 apples and gives 7 kg of them to her friend Tom, who sells each for 40 dollars. How much money does the friend of Kim get in all when 12 apples weigh 9 lbs?"


def test_templates():
    kinds, words = template("She paid $5 for twelve kg in Paris. The end")
    assert kinds == ["she", "paid", "<unit>", "<num>", "for", "<num>", "<unit>", "in", "<name>", "the", "end"]
    assert words[6] == "kg" and words[8] == "paris"


def test_window_hashes_follow_the_template():
    texts = [
        "",
        "A",
        "A b C d. E f g h i j",
        "İstanbul ΣΑΣ o'clock don't 'quoted' 1,234.5 5 kg $5 twelve km. The End of Things in Paris abc123 3:4/5 . 6 𝄞 x² five Km 7. kg Kg KG" * 3,
        "x'y'z 1.2.3. 4 \n New Line Here we go now again and Again 9 USD usd" * 2,
        edge_tables.LONG[:20_000],
    ]
    hash_of, window_of = {}, {}
    for text, (hashes, good), alone in zip(texts, window_hashes(texts), (window_hashes([t])[0] for t in texts), strict=True):
        kinds = template(text)[0]
        windows = [tuple(kinds[i : i + 8]) for i in range(len(kinds) - 7)]
        assert len(hashes) == len(windows) and (hashes == alone[0]).all() and (good == alone[1]).all()
        for window, h, g in zip(windows, hashes.tolist(), good, strict=True):
            assert hash_of.setdefault(window, h) == h and window_of.setdefault(h, window) == window
            assert g == (sum(k not in SLOTS for k in window) >= 4)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_reparameterised_questions_are_found(spark, limit):
    filler = "and so on it goes with words that are in no question at all " * 40
    docs = [
        (1, f"{filler}. {QUESTION} {filler}"),
        (2, f"{filler}.\n{SAME_RULE}\n{filler}"),
        (3, f"{filler}. {BROKEN_RULE} {filler}"),
        (4, filler),
        (5, None),
        (6, ""),
        (None, SAME_RULE),
        (7, QUESTION),
        (7, QUESTION),
        (8, QUESTION[:40] + filler),
        (9, f"{QUESTION} {filler} {SAME_RULE}"),
    ]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").select("*", *[F.lit("x").alias(c) for c in edge_tables.CLASHING])
    items = spark.createDataFrame([(50, QUESTION), (50, QUESTION), (51, "too short"), (52, None), (None, filler), (53, "")], "item_id bigint, text string").withColumn("h", F.lit(1))
    got = contaminated(frame, items, window_limit=limit).collect()
    assert Counter(r["doc_id"] for r in got) == Counter([1, 2, None, 7, 7, 9])
    assert {r["item_id"] for r in got} == {50}
    assert {r["doc_id"] for r in got if r["changed_slots"]} == {2, None}
    assert contaminated(frame.where("false"), items, window_limit=limit).collect() == []
    assert contaminated(frame, items.where("false"), window_limit=limit).collect() == []


def test_both_ways_find_the_same_in_the_table(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    one = Counter(map(tuple, contaminated(docs, items).collect()))
    assert one == Counter(map(tuple, contaminated(docs, items, window_limit=0).collect()))
    texts = {r["item_id"]: r["text"] for r in items.collect()}
    planted = {(r["doc_id"], i) for r in docs.collect() for i, t in texts.items() if t in (r["text"] or "")}
    assert planted <= {(r[0], r[1]) for r in one} and len(planted) > 10
