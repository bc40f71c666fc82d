"""Main text of web pages by site style trees."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from hashlib import blake2b
from html.parser import HTMLParser

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slicedigest.llm.batches import map_rows
from slicedigest.runtime import materialise

THRESHOLD = 0.25
"""A branch whose importance is less leaves the page."""
LEAST_PAGES = 4
"""Different pages a branch must have been seen on before its importance counts."""
BROADCAST_BRANCHES = 500_000
"""Most unimportant branches of all sites that are sent to every executor; more meet the pages in a join by host."""

# What an element is for, by its name or by the words in its class, id and role.
HIDDEN = "head script style noscript template iframe object embed svg math canvas video audio map select option datalist button textarea".split()
FURNITURE = "nav footer aside form header menu dialog fieldset label input".split()
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = (
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead "
    "title tr ul"
).split()
CLOSES_P = frozenset(BLOCKS) - {"br"}
NOISE_WORDS = (
    "ad ads adv advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion nav navbar navigation menu "
    "breadcrumb breadcrumbs footer header masthead sidebar aside widget cookie cookies consent gdpr notice notification alert popup "
    "modal overlay comment comments commentlist disqus respond reply replies discussion share sharing social follow related recommended "
    "recommendations newsletter subscribe subscription signup login search pagination pager copyright legal disclaimer complementary "
    "contentinfo dialog paywall toolbar skip"
).split()
MAIN_WORDS = "articlebody entry post story content main maincontent".split()
# Inside an article only whole class names count, made of the words above (but for its own header) and these.
OWN_WORDS = "header masthead banner".split()
FILLER_WORDS = (
    "area article articles bar block body bottom box button buttons center container content group inline inner item items label left link "
    "links list message outer page panel post posts reader right row section site slot story text thread title top unit user wrap wrapper"
).split()
ID_WORDS = (
    "ad ads advert adverts advertisement advertising adsense sponsored comments commentlist disqus respond newsletter cookie cookies consent "
    "gdpr sidebar nav navbar paywall"
).split()
ARTICLE_NOISE = "comment comments reply teaser related promo sponsored advert".split()
PLAIN = "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd blockquote pre table tbody thead tr td th a b i em strong span u s sub sup code figure figcaption header".split()

_HIDDEN, _FURNITURE, _VOID, _BLOCK = frozenset(HIDDEN), frozenset(FURNITURE), frozenset(VOID), frozenset(BLOCKS)
_NOISE, _MAIN, _ARTICLE_NOISE, _PLAIN = frozenset(NOISE_WORDS), frozenset(MAIN_WORDS), frozenset(ARTICLE_NOISE), frozenset(PLAIN)
_OWN, _FILLER, _ID = frozenset(OWN_WORDS), frozenset(FILLER_WORDS), frozenset(ID_WORDS)
_WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")
_SPACE = re.compile(r"\s+")


@dataclass
class Node:
    """An element of a page: its look (name and class), its children, and text as strings among them."""

    look: str
    tag: str
    words: frozenset[str] = frozenset()
    hidden: bool = False
    misplaced: bool = False
    holds_main: bool = False
    children: list[Node | str] = field(default_factory=list)


class _Builder(HTMLParser):
    """Builds the tree; mends what is left open the way browsers do for paragraphs, list items and table parts."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#page", "#page")
        self.stack = [self.root]
        self.open: Counter[str] = Counter()

    def _cut(self, at: int) -> None:
        for node in self.stack[at:]:
            self.open[node.tag] -= 1
        del self.stack[at:]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_within("p", ("td", "th", "button"))
        if tag in ("li", "dt", "dd", "tr", "td", "th", "option"):
            same = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}.get(tag, (tag,))
            for name in same:
                self._close_within(name, ("ul", "ol", "dl", "table", "select", "menu"))
        values = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "itemprop", "hidden", "style", "aria-hidden")}
        look = f"{tag}.{values.get('class', '').strip().lower()}" if values.get("class") else tag
        words = frozenset(w.lower() for k in ("class", "id", "role", "itemprop") for w in _WORDS.findall(values.get(k, "")))
        unseen = "hidden" in values or "display:none" in values.get("style", "").replace(" ", "").lower()
        misplaced = not words.isdisjoint(_NOISE) and _misplaced(values)
        node = Node(look, tag, words, unseen or tag in _HIDDEN, misplaced)
        self.stack[-1].children.append(node)
        if not node.hidden and (tag == "main" or (tag == "article" and not words & _ARTICLE_NOISE)):
            for above in reversed(self.stack):
                if above.holds_main:
                    break
                above.holds_main = True
                if above.hidden:
                    break
        if tag not in _VOID:
            self.stack.append(node)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _close_within(self, tag: str, borders: tuple[str, ...]) -> None:
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._cut(i)
                return
            if self.stack[i].tag in borders or self.stack[i].tag in ("article", "div", "section", "body", "blockquote") and tag == "p":
                return

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].tag == tag:
                self._cut(i)
                return

    def handle_data(self, data):
        self.stack[-1].children.append(data)


def _misplaced(values: dict[str, str]) -> bool:
    """Whether a class, role or id says as a whole that the element does not belong to the article around it.

    ``related-posts`` and ``ad-slot-2`` do, ``related-work``, ``article-header`` and the id ``discussion`` do not.
    """
    for key, told in (("class", _NOISE - _OWN), ("role", _NOISE - _OWN), ("id", _ID)):
        for name in values.get(key, "").split():
            words = [w.lower() for w in _WORDS.findall(name) if not w.isdigit()]
            if any(w in told for w in words) and all(w in told or w in _FILLER for w in words):
                return True
    return False


def parse_page(html: str) -> Node:
    """The page's tree. Cut off, nested or wrong markup never fails; a comment or declaration leaves nothing."""
    builder = _Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def furniture(node: Node, inside: bool) -> bool:
    """Whether what an element is for says that it is not the page's content.

    An article's own header is content, and so is whatever wraps an article or main element. Inside an article a word of a name
    is not enough, the name must say it as a whole (`_misplaced`).
    """
    if node.hidden:
        return True
    if node.tag in ("html", "body", "main") or (node.tag != "article" and node.holds_main):
        return False
    if node.tag == "article":
        return bool(node.words & _ARTICLE_NOISE)
    if inside:
        return (node.tag in _FURNITURE and node.tag != "header") or node.misplaced
    return node.tag in _FURNITURE or bool(node.words & _NOISE)


def _digest(*parts: str | int) -> int:
    raw = "\x1f".join(map(str, parts)).encode("utf-8", "surrogatepass")
    return int.from_bytes(blake2b(raw, digest_size=8).digest(), "big", signed=True)


def _names_content(node: Node) -> bool:
    return node.tag in ("article", "main") or "main" in node.words or bool(node.words & _MAIN)


def branches(root: Node) -> Iterator[tuple[int, Node]]:
    """Every branch that may be content with its place in the site's tree: a digest of the looks from the root."""
    todo = [(0, root, False)]
    while todo:
        path, node, inside = todo.pop()
        yield path, node
        for child in reversed(node.children):
            if not isinstance(child, str):
                within = inside or _names_content(child)
                if not furniture(child, within):
                    todo.append((_digest(path, child.look), child, within))


def page_facts(html: str) -> dict[tuple[int, str], int]:
    """For each branch of a page its style (``s``: the looks of its children) and its content (``c``: its own text)."""
    looks: dict[int, list[str]] = {}
    texts: dict[int, list[str]] = {}
    for path, node in branches(parse_page(html)):
        own = looks.setdefault(path, [])
        for child in node.children:
            if isinstance(child, str):
                texts.setdefault(path, []).append(child)
            elif not child.hidden and (not own or own[-1] != child.look):
                own.append(child.look)
    facts = {(path, "s"): _digest(*own) for path, own in looks.items()}
    for path, parts in texts.items():
        content = _SPACE.sub(" ", " ".join(parts)).strip()
        if content:
            facts[path, "c"] = _digest(content)
    return facts


def host_of(url: str) -> F.Column:
    """The host in lower case without port; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def branch_importance(pages: DataFrame) -> DataFrame:
    """The merged trees of all sites: ``host, path, pages, importance`` of every branch.

    Pages of one host whose html is equal count once. A branch's importance is the entropy of its style or of its content over
    its pages, whichever is more, to the base of their number: 1 if all differ, 0 if all agree. Counts are summed per task
    before they are shuffled, so one host may hold any part of the pages. Pages without a host belong to no site.
    """
    rows = pages.select(host_of("url").alias("host"), F.coalesce("html", F.lit("")).alias("html")).where("host <> ''")

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for host, page, html in zip(batch["host"], batch["page"], batch["html"], strict=True):
                for (path, kind), value in page_facts(html).items():
                    yield host, page, path, kind, value

    facts = map_rows(
        rows.select(F.xxhash64("host").alias("host"), F.xxhash64("html").alias("page"), "html"),
        run,
        "host bigint, page bigint, path bigint, kind string, value bigint",
    )
    counts = facts.distinct().groupBy("host", "path", "kind", "value").agg(F.count("*").alias("n"))
    n = F.col("n").cast("double")
    sums = counts.groupBy("host", "path", "kind").agg(F.sum("n").alias("pages"), F.sum(n * F.log(n)).alias("agreed"))
    m = F.col("pages").cast("double")
    entropy = F.when(m > 1, 1 - F.col("agreed") / (m * F.log(m))).otherwise(1.0)
    return sums.groupBy("host", "path").agg(F.max("pages").alias("pages"), F.max(entropy).alias("importance"))


def extract(html: str, low: frozenset[int] = frozenset()) -> str:
    """The page's main text, one line per block; ``low`` names branches of the site that carry little.

    Content is what the outermost articles hold, or else main elements, or else elements named like content, or else the whole
    page. Elements that are there for something else go (`furniture`). A low branch goes with all below it unless something
    in it is not low; plain paragraphs, headings and the like inside an article never count as template. A page that would lose
    all its text this way keeps its low branches.
    """
    root = parse_page(html)
    text = _render(root, low)
    return text if text or not low else _render(root, frozenset())


def _render(root: Node, low: frozenset[int]) -> str:
    out = _Lines()
    for wanted in (
        lambda n: n.tag == "article",
        lambda n: n.tag == "main" or ("main" in n.words and n.tag not in ("html", "body")),
        lambda n: bool(n.words & _MAIN) and n.tag in ("div", "section", "td"),
    ):
        found = list(_outermost(root, 0, wanted, low))
        for path, node in found:
            out.add(node, _templates(node, path, low, True), inside=True)
        if out.lines:
            return out.text()
    out.add(root, _templates(root, 0, low, False), inside=False)
    return out.text()


def _templates(root: Node, path: int, low: frozenset[int], inside: bool) -> set[int]:
    """Which elements below are low and so is all below them; plain ones inside an article never are."""
    dropped: set[int] = set()
    if not low:
        return dropped
    order, todo = [], [(root, path, -1)]
    while todo:
        node, path, above = todo.pop()
        todo += [(c, _digest(path, c.look), len(order)) for c in node.children if not isinstance(c, str) and not furniture(c, inside)]
        order.append((node, path, above))
    whole = [True] * len(order)
    for i in range(len(order) - 1, -1, -1):
        node, path, above = order[i]
        if whole[i] and path in low and not (inside and node.look in _PLAIN):
            dropped.add(id(node))
        elif above >= 0:
            whole[above] = False
    return dropped


def _outermost(root: Node, path: int, wanted, low: frozenset[int]) -> Iterator[tuple[int, Node]]:
    todo = [(path, root)]
    while todo:
        path, node = todo.pop()
        if node is not root and wanted(node):
            yield path, node
            continue
        for child in reversed(node.children):
            if not isinstance(child, str) and not furniture(child, False):
                todo.append((_digest(path, child.look) if low else 0, child))


class _Lines:
    """Collects text as blocks with single spaces."""

    def __init__(self):
        self.lines: list[str] = []
        self.open: list[str] = []

    def end(self) -> None:
        line = _SPACE.sub(" ", "".join(self.open)).strip()
        if line:
            self.lines.append(line)
        self.open = []

    def add(self, root: Node, dropped: set[int], inside: bool) -> None:
        todo: list[Node | str | None] = [root]
        while todo:
            node = todo.pop()
            if node is None:
                self.end()
            elif isinstance(node, str):
                self.open.append(node)
            else:
                if node.tag in _BLOCK:
                    self.end()
                    todo.append(None)
                todo += [c for c in reversed(node.children) if isinstance(c, str) or not (furniture(c, inside) or id(c) in dropped)]

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines)


def main_text(pages: DataFrame, threshold: float = THRESHOLD, least_pages: int = LEAST_PAGES) -> DataFrame:
    """``page_id``, ``url``, ``text`` and ``n_chars`` of every row of ``pages(page_id, url, html)``.

    Site trees are merged per host (`branch_importance`), and each page loses the branches whose importance on at least
    ``least_pages`` different pages of its host is below ``threshold``, besides what its markup names as no content
    (`extract`). Null or empty html gives an empty text; a page without a host is judged by its markup alone; rows that repeat
    come out as often; other columns are ignored. Pages are not shuffled while the low branches are few, which is counted
    first; beyond that they are joined by host, where Spark splits a host that is too large for a task.
    """
    low = materialise(branch_importance(pages).where((F.col("pages") >= least_pages) & (F.col("importance") < threshold)).select("host", "path"))
    few = low.count() <= BROADCAST_BRANCHES
    per_host = low.groupBy("host").agg(F.collect_list("path").alias("low"))  # a site's branches, never its pages
    rows = pages.select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url"), F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", F.xxhash64(host_of("url"))).join(F.broadcast(per_host) if few else per_host, "host", "left")

    def run(batches: Iterable[dict]) -> Iterator[tuple]:
        for batch in batches:
            for page, url, html, low in zip(*(batch[c] for c in ("page_id", "url", "html", "low")), strict=True):
                text = extract(html, frozenset(low or ()))
                yield page, url, text, len(text)

    return map_rows(rows.select("page_id", "url", "html", "low"), run, "page_id bigint, url string, text string, n_chars bigint", rows=256)
