"""Main text of web pages by line-block distribution.

1. Strip: tags split a page into lines (one for each block of text); scripts, styles,
   comments and elements that are boilerplate by their name, or by a class, id or role
   that as a whole says so, are taken out.  Elements end where HTML lets them end, also
   without an end tag; boilerplate that never ends stops at an article.  Character references are decoded, white space runs become one space.
2. Sum: a line weighs its characters outside links; a line in the page's article (or
   main) element, if there is one, at least `SURE`, all others then nothing.  Weights are
   summed over sliding windows of `WINDOW` lines.
3. Cut: a surge point is where the sums rise above the threshold, a dive point where
   they fall back.  The stretch with the most text is kept, with others that have at
   least a `SHARE` of it, and, on pages without an article element, the short lines beside
   it in the same container.  Lines inside the stretches that weigh nothing stay out.

The threshold is the smaller of `SURGE` and half the largest sum, so short articles are
found too.  Defined cases: null and empty pages give an empty text; a page cut off in
the middle is read to its end; repeated rows give repeated results; other columns are
ignored.
"""

from __future__ import annotations

import re
import sys
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.llm.common import map_arrow, texts_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW, SURGE, SURE, SHARE = 3, 90, 90, 0.3
SCHEMA = "page_id long, url string, text string, n_chars long"

TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(?P<raw>script|style|noscript|template|textarea|title|svg|iframe)\b"""
    r"""|<[!?][^>]*(?:>|\Z)"""
    r"""|</(?P<end>[a-zA-Z][a-zA-Z0-9-]*)"""
    r"""|<(?P<start>[a-zA-Z][a-zA-Z0-9-]*)""",
    re.DOTALL | re.IGNORECASE,
)
# One attribute up to its opening quote, or all of it if the value has none.
ATTRIBUTE = re.compile(r"""[\s/]*+(?:(?P<name>[^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:(?P<quote>["'])|(?P<bare>[^\s>]*+)))?+)?+""")
RAW_ENDS = {
    name: re.compile(f"</{name}[^>]*(?:>|\\Z)", re.IGNORECASE)
    for name in "script style noscript template textarea title svg iframe".split()
}
NAMING = re.compile(r"\b(class|id|role)\Z", re.IGNORECASE)
LETTERS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

# Elements of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Their end tag may be left out; a start tag of the second list ends an open one of the first, but for those inside the third.
OPTIONAL = frozenset("p li dt dd option optgroup tr td th thead tbody tfoot rt rp caption colgroup head body html".split())
IMPLIED = [
    ("li", "li", "ul ol menu dir"),
    ("dt dd", "dt dd", "dl"),
    ("option", "option optgroup", "select datalist"),
    ("optgroup", "optgroup", "select datalist"),
    ("td th caption colgroup", "td th tr thead tbody tfoot", "table"),
    ("tr", "tr thead tbody tfoot", "table"),
    ("thead tbody tfoot", "thead tbody tfoot", "table"),
    (
        "p",
        "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
        "hr main menu nav ol p pre search section table ul li dt dd",
        "button table td th caption",
    ),
    ("a", "a", "table td th"),
    ("head", "body", "html"),
]
ENDS: dict[str, list[tuple[frozenset[str], frozenset[str]]]] = {}
for _open, _by, _inside in IMPLIED:
    for _name in _by.split():
        ENDS.setdefault(_name, []).append((frozenset(_open.split()), frozenset(_inside.split())))
# An end tag does not look for its start beyond these, unless it is a table's own.
BARRIER = frozenset("table td th caption button".split())
TABLE = frozenset("table thead tbody tfoot tr td th caption".split())
# Elements that are never article text, and words of class, id or role that say the same.
OUTSIDE = frozenset(
    "head nav header footer aside form button select option datalist dialog menu object audio video canvas".split()
)
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
ADVERTS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion".split())
NOISE = COMMENTS | ADVERTS | frozenset(
    "nav navigation navbar menu sidebar side complementary header masthead footer contentinfo cookie cookies consent notice "
    "notices alert banner share sharing social related recommended newsletter subscribe signup popup modal overlay breadcrumb "
    "breadcrumbs pagination pager widget login search toolbar skip".split()
)
# Words that may stand beside a word of NOISE in one name without making it another thing.
BESIDE = frozenset(
    "item items list box block container wrapper wrap section area bar link links post posts article articles main site page "
    "top bottom left right body content form button buttons icon icons inner outer row col column primary secondary global "
    "thread author text meta slot unit zone".split()
)
WRAPPER = frozenset("content main article post entry page wrapper container body story".split())
# A line directly in one of these is text, wherever the element stands.
PROSE = frozenset("p li dd dt h1 h2 h3 h4 h5 h6 blockquote pre figcaption".split())


def tag_end(page: str, at: int, last: dict[str, int]) -> tuple[int, list[str]]:
    """Where the tag whose attributes begin at `at` ends (its `>`), and its class, id and role values.

    Quotes count only after `=`, as in HTML.  `last` has the place of the page's last quote of
    each kind: a quote that is never closed is an ordinary character, found without a search.
    """
    values = []
    while True:
        m = ATTRIBUTE.match(page, at)
        at, value, quote = m.end(), m["bare"], m["quote"]
        if quote and last[quote] >= at:
            to = page.index(quote, at)
            at, value = to + 1, page[at:to]
        if value and NAMING.search(m["name"]):
            values.append(value)
        if at == len(page) or page[at] == ">":
            return at, values


def noise_words(token: str) -> set[str]:
    """The noise words of one class, id or role, if the whole of it names noise (`ad-box`, not `share-price`)."""
    words = set(LETTERS.findall(CAMEL.sub("-", token).lower()))
    return words & NOISE if words <= NOISE | BESIDE else set()


def is_noise(name: str, values: list[str], in_article: bool) -> bool:
    if name in ("html", "body", "main", "h1"):
        return False
    if name in OUTSIDE:
        return not (name == "header" and in_article)
    tokens = {t for value in values for t in value.split()}
    found = {w for t in tokens for w in noise_words(t)}
    if name == "article":
        return bool(found & (COMMENTS | ADVERTS))
    if in_article:
        found -= {"header"}
    wrapper = name == "div" and any(t.lower() in WRAPPER for t in tokens)
    return bool(found) and not (wrapper and not found & {"comment", "comments", "ad", "ads"})


class Page:
    """The elements of a page as a tree, and its texts and block borders in order.

    Elements are numbered as they start; number 0 holds everything.  `closed` says whether
    an element has its own end (an end tag, or one that HTML implies).
    """

    def __init__(self, page: str):
        self.names, self.values, self.parents, self.closed = [""], [[]], [0], [False]
        self.items: list[tuple[str | None, int]] = []  # (text, or None for a border; the element)
        self.open: list[int] = []
        self.counts: dict[str, int] = {}
        self.read(page)

    @property
    def current(self) -> int:
        return self.open[-1] if self.open else 0

    def pop(self, own: bool) -> None:
        e = self.open.pop()
        self.counts[self.names[e]] -= 1
        self.closed[e] = own or self.names[e] in OPTIONAL
        if self.names[e] not in INLINE:
            self.items.append((None, e))

    def close(self, names: frozenset[str], inside: frozenset[str]) -> None:
        """End the nearest open element of these names and all within it, unless it lies beyond one of `inside`."""
        if not any(self.counts.get(n) for n in names):
            return
        for place in range(len(self.open) - 1, -1, -1):
            name = self.names[self.open[place]]
            if name in names:
                while len(self.open) > place:
                    self.pop(own=len(self.open) == place + 1)
                return
            if name in inside:
                return

    def start(self, name: str, values: list[str], closed: bool) -> None:
        for names, inside in ENDS.get(name, ()):
            self.close(names, inside)
        if name not in INLINE:
            self.items.append((None, self.current))
        if name in VOID or closed and name not in OPTIONAL | OUTSIDE and name in INLINE:
            return
        # Inline elements matter as links, as noise, and inside one of their own name.
        if name in INLINE and name != "a" and not values and not self.counts.get(name):
            return
        self.names.append(name)
        self.values.append(values)
        self.parents.append(self.current)
        self.closed.append(False)
        self.open.append(len(self.names) - 1)
        self.counts[name] = self.counts.get(name, 0) + 1

    def end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name not in INLINE:
            self.items.append((None, self.current))
        self.close(frozenset((name,)), frozenset() if name in TABLE else BARRIER)

    def read(self, page: str) -> None:
        at = 0
        last = {quote: page.rfind(quote) for quote in "\"'"}
        while m := TOKEN.search(page, at):
            if m.start() > at:
                self.items.append((page[at : m.start()], self.current))
            at = m.end()
            start, end, raw = m["start"], m["end"], m["raw"]
            closed, values = False, []
            if start or end or raw:
                to, values = tag_end(page, at, last)
                closed = page[at:to].endswith("/")
                at = min(to + 1, len(page))
            if raw:
                # Its content is no markup; it ends at its own end tag.
                stop = RAW_ENDS[raw.lower()].search(page, at)
                at = stop.end() if stop else len(page)
                if raw.lower() in ("textarea", "title", "iframe"):
                    self.items.append((None, self.current))
            elif start:
                self.start(start.lower(), values, closed)
            elif end:
                self.end(end.lower())
        if at < len(page):
            self.items.append((page[at:], self.current))

    def judge(self) -> None:
        """Of each element: whether it is left out, in an article, in a link; and its depth."""
        n = len(self.names)
        self.out, self.article, self.link, self.depth = [False] * n, [False] * n, [False] * n, [0] * n
        loose = [False] * n  # left out because of an element that never ends
        for e in range(1, n):
            up, name = self.parents[e], self.names[e]
            self.depth[e] = self.depth[up] + 1
            self.out[e], loose[e] = self.out[up], loose[up]
            noise = is_noise(name, self.values[e], self.article[up])
            if self.out[e] and loose[e] and name in ("article", "main") and not noise:
                self.out[e] = loose[e] = False
            elif not self.out[e] and noise:
                self.out[e], loose[e] = True, not self.closed[e]
            self.article[e] = not self.out[e] and (self.article[up] or name in ("article", "main"))
            self.link[e] = self.link[up] or name == "a"

    def lines(self) -> list[tuple[str, int, int]]:
        """(text, characters inside links, innermost block element) of each block of text that is not left out."""
        self.judge()
        found: list[tuple[str, int, int]] = []
        parts: list[str] = []
        linked, block = 0, 0
        for text, e in [*self.items, (None, 0)]:
            if text is None:
                line = " ".join(unescape("".join(parts)).split())
                if line:
                    found.append((line, linked, block))
                parts.clear()
                linked = 0
            elif not self.out[e]:
                parts.append(text)
                linked += len(text) if self.link[e] else 0
                while self.names[e] in INLINE and e:
                    e = self.parents[e]
                block = e
        return found

    def common(self, a: int, b: int) -> int:
        """The innermost element that holds both."""
        while a != b:
            if self.depth[a] >= self.depth[b]:
                a = self.parents[a]
            else:
                b = self.parents[b]
        return a

    def within(self, e: int, outer: int) -> bool:
        while self.depth[e] > self.depth[outer]:
            e = self.parents[e]
        return e == outer


def stretches(weights: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """(begin, end) of the stretches between surge and dive points, and the running total of the weights."""
    n = len(weights)
    total = np.concatenate(([0], np.cumsum(weights)))
    # Each line belongs to the windows that begin up to WINDOW - 1 lines before it.
    sums = total[np.minimum(n, np.arange(n) + WINDOW)] - total[:-1]
    if not sums.max():
        return [], total
    high = sums >= min(SURGE, sums.max() / 2)
    surge = np.flatnonzero(high & ~np.concatenate(([False], high[:-1])))
    dive = np.flatnonzero(high & ~np.concatenate((high[1:], [False])))
    found: list[tuple[int, int]] = []
    for a, b in zip(surge.tolist(), dive.tolist(), strict=True):
        b = min(n, b + WINDOW)  # the last high window's lines belong to the stretch
        if found and a <= found[-1][1]:
            found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    return found, total


def widened(page: Page, lines: list[tuple[str, int, int]], a: int, b: int) -> tuple[int, int]:
    """The stretch with the lines around it that belong to the same container.

    Short lines beside long ones, as items of a list or a last remark, make no surge of
    their own.  Lines are added on both sides up to one of links or out of the container
    that holds the stretch's heavy lines; if that is the body itself, only lines of prose.
    """
    # Windows reach beyond the heavy lines; what they caught there must belong too.
    heavy = [i for i in range(a, b) if len(lines[i][0]) - lines[i][1] >= SURGE // 2] or list(range(a, b))
    a, b = heavy[0], heavy[-1] + 1
    outer = lines[a][2]
    for i in heavy[1:]:
        outer = page.common(outer, lines[i][2])
    if page.names[outer] in PROSE:
        outer = page.parents[outer]
    whole = page.names[outer] in ("", "html", "body")

    def belongs(i: int) -> bool:
        text, linked, e = lines[i]
        return linked * 2 <= len(text) and page.within(e, outer) and (not whole or page.names[e] in PROSE)

    while a and belongs(a - 1):
        a -= 1
    while b < len(lines) and belongs(b):
        b += 1
    return a, b


def main_text(page: str | None) -> str:
    tree = Page(page or "")
    lines = tree.lines()
    if not lines:
        return ""
    marked = any(tree.article[e] for _, _, e in lines)
    weights = np.array(
        [
            max(len(text), SURE) if marked and tree.article[e] else 0 if marked or linked * 2 > len(text) else len(text) - linked
            for text, linked, e in lines
        ]
    )
    found, total = stretches(weights)
    if not found:
        return ""
    most = max(total[b] - total[a] for a, b in found)
    found = [(a, b) for a, b in found if total[b] - total[a] >= SHARE * most]
    if not marked:
        found = [widened(tree, lines, a, b) for a, b in found]
    kept = sorted({i for a, b in found for i in range(a, b) if weights[i]})
    return " ".join(lines[i][0] for i in kept)


def extract(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = df.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [main_text(page) for page in texts_of(batch.column("html"))]
        arrays = [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["page_id", "url", "text", "n_chars"])

    return map_arrow(rows, run, SCHEMA, "html")
