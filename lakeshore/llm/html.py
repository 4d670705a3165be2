"""Main text of web pages by minimum-cut labelling.

A page is read into text blocks with their chain of elements. A classifier gives each block
the odds of being content from its surroundings (semantic elements, class and id words), its
length and its share of link text. The costs of both labels are the capacities to the two
terminals; neighbouring blocks and blocks of one parent are tied by edges whose capacity falls
with their distance in the element tree. The minimum cut is the cheapest labelling, so a short
paragraph follows its neighbours and a menu does not.

Character references are decoded, white space inside a block becomes one space, blocks are
trimmed and joined in page order by a newline; nothing else is changed, dropped or capped.

Defined results: a null or empty page has the empty text; markup that is never closed ends with
the page; repeated rows are extracted each; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import deque
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table
from .packing import _spans

BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog div dl dt
    fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu
    nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their text is never part of a page's text.
SILENT = frozenset("""head title script style noscript template svg math iframe object canvas audio video
    select button textarea datalist""".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
          "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: A p is closed by any block that opens inside it, the others only within their own container.
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
CONTENT = frozenset(["article", "main"])
BOILERPLATE = frozenset("nav footer aside form menu dialog search".split())
GOOD_WORDS = frozenset("article content main post story entry articlebody body text".split())
BAD_WORDS = frozenset("""ad ads advert advertisement advertising banner breadcrumb breadcrumbs byline
    comment comments commentlist consent cookie cookies copyright discussion disqus footer form gdpr header
    legal login masthead menu modal nav navbar navigation newsletter notice notices notification overlay
    pager pagination popup privacy promo promoted promotion recommended related replies respond reviews
    search share sharing sidebar sidenav signup skip social sponsor sponsored subscribe subscription tags
    toolbar topbar widget widgets""".split())
ROLES = {"main": 1, "article": 1, "navigation": -1, "banner": -1, "contentinfo": -1, "complementary": -1,
         "search": -1, "form": -1, "dialog": -1, "alert": -1, "menu": -1, "menubar": -1}
TIE = 1.5


#: What the elements around a block can add up to, from the innermost outwards; see _outwards.
LEANS = (-4.0, -2.0, 0.0, 1.0, 2.0, 3.0, 4.0)


class _Element:
    """An open element with what a page's reader asks of its ancestors, so that none is walked again:
    its nearest block, the open element of its tag outside it, and where each sum of leans ends."""

    __slots__ = ("tag", "parent", "depth", "silent", "link", "block", "outer", "inside", "ends")

    def __init__(self, tag, parent, lean=0, silent=False, weak=False, outer=None):
        self.tag, self.parent, self.outer = tag, parent, outer
        self.depth = parent.depth + 1 if parent else 0
        self.silent = silent or bool(parent and parent.silent)
        self.link = tag == "a" or bool(parent and parent.link)
        self.block = self if parent is None or tag in BLOCKS else parent.block
        self.inside = lean > 0 or bool(parent and parent.inside)
        ends = parent.ends if parent else dict(zip(LEANS, LEANS))
        self.ends = {x: ends[_outwards(x, tag, lean, weak)] for x in LEANS} if lean else ends


def _outwards(x: float, tag: str, lean: int, weak: bool) -> float:
    """The sum so far, past one more element that leans to content (1) or boilerplate (-1)."""
    if not x:  # the innermost element that says something
        return lean * (2.0 if weak else 4.0)
    if x < 0 < lean and tag in CONTENT and abs(x) < 4:
        return 1.0  # an article's own header
    return x - 1.0 if x > 0 > lean and not weak else x


def _lean(tag: str, attrs: dict) -> tuple[int, bool]:
    """1 content, -1 boilerplate, 0 says nothing; weak: a guess from a word alone."""
    role = (attrs.get("role") or "").lower()
    if role in ROLES:
        return ROLES[role], False
    if "hidden" in attrs or (attrs.get("aria-hidden") or "").lower() == "true":
        return -1, False
    words = set(re.split(r"[\s_-]+|(?<=[a-z])(?=[A-Z])", f"{attrs.get('class') or ''} {attrs.get('id') or ''}"))
    words = {w.lower() for w in words}
    if tag in BOILERPLATE:
        return -1, False
    if words & BAD_WORDS and tag not in ("body", "html"):
        return (-1, False) if tag not in CONTENT or words & {"comment", "comments", "ad", "promo"} else (1, False)
    if tag in CONTENT:
        return 1, False
    if tag == "header":
        return -1, True
    if words & GOOD_WORDS and tag != "body":
        return 1, True
    return 0, True


class PageReader(HTMLParser):
    """Blocks of a page: (text, letters in links, innermost element)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.top = _Element("#page", None)
        self.open: dict[str, _Element | None] = {}  # the innermost open element of each tag
        self.blocks: list[tuple[str, int, _Element]] = []
        self.parts: list[str] = []
        self.linked = 0
        self.holder = self.top

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.blocks.append((text, self.linked, self.holder))
        self.parts, self.linked = [], 0

    def _pop_to(self, element: _Element):
        """Close ``element`` and all inside it."""
        while self.top is not element.parent:
            self.open[self.top.tag] = self.top.outer
            self.top = self.top.parent

    def handle_starttag(self, tag, attrs):
        if tag == "body":
            while self.top.silent:
                self._pop_to(self.top)
        if tag in BLOCKS:
            self.flush()
            shut = CLOSES.get(tag, frozenset()) | {"p"}
            at = self.top.block  # only blocks are closed by a block
            while at.parent is not None and at.tag not in SCOPES.get(tag, frozenset()) and at.tag in shut:
                self._pop_to(at)
                at = at.parent.block
        if tag == "br":
            self.parts.append(" ")
        if tag in VOID:
            return
        lean, weak = _lean(tag, dict(attrs)) if tag in BLOCKS or attrs else (0, True)
        self.top = self.open[tag] = _Element(tag, self.top, lean, tag in SILENT, weak, self.open.get(tag))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag in BLOCKS:
            self.flush()
        at = self.open.get(tag)
        # an inline end tag closes nothing outside its block
        if at is not None and (tag in BLOCKS or at.depth > self.top.block.depth):
            self._pop_to(at)

    def handle_data(self, data):
        if self.top.silent or not data:
            return
        if not self.parts or data.strip():
            self.holder = self.top.block
        self.parts.append(data)
        if self.top.link:
            self.linked += len(data.strip())


def read_blocks(page: str) -> list[tuple[str, int, _Element]]:
    reader = PageReader()
    reader.feed(page)
    reader.close()
    reader.flush()
    return reader.blocks


def _odds(text: str, linked: int, element: _Element) -> float:
    """Log odds that a block is content."""
    lean, inside = element.ends[0.0], element.inside
    words = text.count(" ") + 1
    value = lean + min(2.0, words / 12) - 0.6
    value -= (2.0 if inside else 4.0) * min(1.0, linked / max(1, len(text)))
    if text[-1] in ".!?…\"'”»:;":
        value += 0.5
    if element.tag in ("h1", "h2", "h3") and lean >= 0:
        value += 1.0
    if "©" in text and lean <= 0:
        value -= 2.0
    return value


def _distance(a: _Element, b: _Element) -> int:
    steps = 0
    while a is not b:
        if a.depth >= b.depth:
            a = a.parent
        else:
            b = b.parent
        steps += 1
    return steps


def minimum_cut(odds: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """True for the nodes on the source (content) side of the minimum cut.

    A node's terminals hold the costs log(1 + e^odds) and log(1 + e^-odds); their common part
    flows at once, so the difference, the odds, is left at one of them. Dinic's algorithm.
    """
    n = len(odds)
    source, sink = n, n + 1
    heads: list[list[int]] = [[] for _ in range(n + 2)]
    to, room = [], []

    def edge(a, b, forth, back):
        heads[a].append(len(to))
        to.append(b)
        room.append(forth)
        heads[b].append(len(to))
        to.append(a)
        room.append(back)

    for i, x in enumerate(odds):
        if x > 0:
            edge(source, i, x, 0.0)
        elif x < 0:
            edge(i, sink, -x, 0.0)
    for a, b, c in edges:
        edge(a, b, c, c)
    while True:
        level = [-1] * (n + 2)
        level[source] = 0
        queue = deque([source])
        while queue:
            v = queue.popleft()
            for e in heads[v]:
                if room[e] > 1e-9 and level[to[e]] < 0:
                    level[to[e]] = level[v] + 1
                    queue.append(to[e])
        if level[sink] < 0:
            return [x >= 0 for x in level[:n]]
        nxt = [0] * (n + 2)
        path: list[int] = []
        v = source
        while True:
            if v == sink:
                flow = min(room[e] for e in path)
                cut = 0
                for k, e in enumerate(path):
                    room[e] -= flow
                    room[e ^ 1] += flow
                    if room[e] <= 1e-9:
                        cut = k
                        break
                for e in path[cut + 1:]:
                    room[e] -= flow
                    room[e ^ 1] += flow
                v = to[path[cut] ^ 1]
                del path[cut:]
                continue
            while nxt[v] < len(heads[v]):
                e = heads[v][nxt[v]]
                if room[e] > 1e-9 and level[to[e]] == level[v] + 1:
                    break
                nxt[v] += 1
            if nxt[v] < len(heads[v]):
                path.append(heads[v][nxt[v]])
                v = to[path[-1]]
            elif v == source:
                break
            else:
                level[v] = -1
                v = to[path.pop() ^ 1]


def main_text(page: str) -> str:
    """The content blocks of one page."""
    blocks = read_blocks(page)
    if not blocks:
        return ""
    odds = [_odds(*b) for b in blocks]
    edges, last = [], {}
    for i, (_, _, element) in enumerate(blocks):
        if i:
            edges.append((i - 1, i, TIE / (1 + _distance(blocks[i - 1][2], element))))
        parent = element.parent
        if parent in last and last[parent] < i - 1:
            edges.append((last[parent], i, TIE / 3))
        last[parent] = i
    keep = minimum_cut(odds, edges)
    return "\n".join(b[0] for b, k in zip(blocks, keep) if k)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` of every whole page."""
    id_type = pages.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lo, hi in _spans(batch["html"], 4_000_000):
                part = batch.iloc[lo:hi]
                texts = [main_text(h) for h in part["html"]]
                yield pd.DataFrame({"page_id": part["page_id"], "url": part["url"], "text": texts,
                                    "n_chars": [len(t) for t in texts]})

    return (pages.select(F.col(id_col).cast("string").alias("page_id"), F.col(url_col).cast("string").alias("url"),
                         F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
            .mapInPandas(run, "page_id string, url string, text string, n_chars long")
            .withColumn("page_id", F.col("page_id").cast(id_type)))


def op6_html(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))


QUERIES = {"op6_html": op6_html}
