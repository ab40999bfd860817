"""Main text of web pages: parser events, text-to-tag ratio per line, Gaussian smoothing, threshold clustering.

The standard library's streaming parser turns a page into lines, one per block of
text. A line's ratio is its code points outside links over its tags; lines in
menus, headers, footers, sidebars, notices, adverts, forms and comments (known by
tag, role, class or id) have ratio 0. The ratios, of at most ``CAP`` each so that
one long line does not hide the others, are smoothed by a Gaussian. Lines above
the threshold, a share of the standard deviation, form clusters. The content region is
the heaviest ``article`` that holds most of the clusters' text, or ``main`` that holds half of it; else
what encloses the articles that hold most of it together; else the innermost element
that does. The page's text is what is content in that region: all of it in an ``article`` or ``main``,
and from the first to the last cluster elsewhere, with the headings before it.

Names such as ``has-sidebar`` tell how a page is laid out and mark nothing, and a
``main`` is content whatever the names around it. A name whose elements hold most of
the page's dense lines (of comments: all of them) marks nothing on that page. Outside an ``article`` or ``main``, lines of
links and copyright lines at the ends of the clusters go.

White space in a line becomes one space; lines are joined by one newline. A null or
empty page, or one without content, has an empty text. Broken markup never fails: what
stands open is closed by its parent. Time and memory are linear in the page, however
deep its elements nest. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from html.parser import HTMLParser
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches

SIGMA = 1.5
CAP = 400.0
THRESHOLD = 0.5  #: of the standard deviation of the smoothed ratios
MOST_SHARE = 0.6  #: of the clusters' text that the content region must hold
MAIN_SHARE = 0.5  #: that a ``main`` must hold
DENSE = 40  #: code points a tag from which on a line tells against a name

# The elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template title head svg math canvas iframe object audio video select option optgroup datalist textarea button".split())
BOILERPLATE = frozenset("nav footer dialog menu".split())
#: Boilerplate too, unless they hold most of the page: some page builders wrap everything in a form.
WRAPPERS = frozenset("aside form fieldset".split())
BLOCK = frozenset(
    "address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset(("article", "main"))
#: Elements that may be the content region.
REGIONS = frozenset("body center div section td".split())
#: An opening tag closes these, if they stand open in the same container.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
CONTAINERS = frozenset("ul ol dl table article main section div nav aside header footer form body html td th blockquote".split())
#: Words of a class, id or role that tell boilerplate.
NOISE = frozenset(
    "ad ads adv advert adverts advertisement advertising adsbygoogle banner breadcrumb breadcrumbs byline-share comment comments commentlist cookie cookies consent "
    "copyright disqus footer gdpr masthead menu menubar modal nav navbar navigation newsletter notice notices overlay pager pagination popup promo promotion "
    "reader-comments related replies reply respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription tags teaser "
    "toolbar tracking widget widgets contentinfo complementary search alert alertdialog dialog tooltip".split()
)
#: Of these, what readers write: it may outweigh the page's own text.
REPLIES = frozenset("comment comments commentlist disqus reader-comments replies reply respond comment-body".split())
HEADER = frozenset(("header", "pageheader", "topbar"))
#: Whole names of an ``article`` that is not the page's own.
NOT_ARTICLES = frozenset("ad advert comment comment-body promo related reply sponsored teaser".split())
#: A name with one of these parts describes the layout.
LAYOUT = frozenset("has no with without layout template".split())
COPYRIGHT = re.compile(r"(©|\(c\)\s|copyright\b)", re.IGNORECASE)
LINK_SHARE = 0.5  #: a line with more of its text in links is a line of links
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _named_words(value: str) -> set[str]:
    """Words of an attribute: whole names, and their parts at hyphens, underscores and capitals."""
    words = set()
    for name in value.split():
        words.add(name.lower())
        parts = {p.lower() for p in _PARTS.findall(name)}
        if not parts & LAYOUT:
            words |= parts
    return words


def is_barred(tag: str, attributes: list[tuple[str, str | None]], in_content: bool) -> bool:
    """Whether an element holds no content, by its tag or because it is hidden."""
    if tag in BOILERPLATE or tag == "header" and not in_content:
        return True
    if tag in ("html", "body", "article", "main"):
        return False
    for name, value in attributes:
        if name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.IGNORECASE):
            return True
    return False


def noise_names(tag: str, attributes: list[tuple[str, str | None]], in_content: bool) -> set[str]:
    """The words of an element's class, id or role that tell boilerplate."""
    if tag in ("html", "body", "main"):
        return set()
    named = [value for name, value in attributes if name in ("class", "id", "role") and value]
    if tag == "article":
        return {x.lower() for value in named for x in value.split()} & NOT_ARTICLES
    words = set().union(*map(_named_words, named)) & (NOISE if in_content else NOISE | HEADER)
    return words | {f"<{tag}>"} if tag in WRAPPERS else words


class Line(NamedTuple):
    text: str
    plain: int  #: code points outside links
    tags: int
    barred: bool
    element: int  #: the innermost element around it
    heading: bool


class Lines(HTMLParser):
    """Lines of a page, and its elements numbered as they open, so that an element holds the numbers up to its ``last``."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, int]] = []  # open elements: tag, number
        self.open: Counter[str] = Counter()
        self.hidden = self.barred = self.link = self.content = 0
        self.marks: list[tuple[int, int, int, int]] = []  # what each open element adds to the four counts
        self.named: list[tuple[int, set[str]]] = []  # elements with names that tell boilerplate
        self.lines: list[Line] = []
        self.tags = [""]  # by number; 0 is the page
        self.last = [0]
        self.main = [0]  # by number, the innermost main around it, or 0: names outside it do not count
        self._new_line()

    def _new_line(self):
        self.parts: list[str] = []
        self.plain = self.n_tags = 0
        self.heading = False

    def _break(self):
        text = " ".join("".join(self.parts).split())
        if text:
            element = self.stack[-1][1] if self.stack else 0
            self.lines.append(Line(text, self.plain, self.n_tags, self.barred > 0, element, self.heading))
            self._new_line()
        else:
            tags = self.n_tags
            self._new_line()
            self.n_tags = min(tags, 1)

    def _pop(self):
        tag, number = self.stack.pop()
        self.open[tag] -= 1
        self.last[number] = len(self.tags) - 1
        self._count(self.marks.pop(), -1)

    def _count(self, marks: tuple[int, int, int, int], sign: int):
        hidden, barred, link, content = marks
        self.hidden += sign * hidden
        self.barred += sign * barred
        self.link += sign * link
        self.content += sign * content

    def _close_to(self, at: int):
        while len(self.stack) > at:
            if self.stack[-1][0] in BLOCK:
                self._break()
            self._pop()

    def handle_starttag(self, tag, attrs):
        if tag == "p" or tag in BLOCK and tag != "br":
            self._close_open({"p"})
        if tag in CLOSES:
            self._close_open(CLOSES[tag])
        if tag in BLOCK:
            self._break()
        self.n_tags += 1
        if tag in VOID:
            return
        if not self.parts and tag in HEADINGS:
            self.heading = True
        barred = int(is_barred(tag, attrs, self.content > 0))
        number = len(self.tags)
        if names := noise_names(tag, attrs, self.content > 0):
            self.named.append((number, names))
        self.main.append(number if tag == "main" and not self.barred else self.main[self.stack[-1][1]] if self.stack else 0)
        self.stack.append((tag, number))
        self.open[tag] += 1
        self.tags.append(tag)
        self.last.append(0)
        self.marks.append((int(tag in HIDDEN), barred, int(tag == "a"), int(tag in CONTENT)))
        self._count(self.marks[-1], 1)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path", "use", "iframe"):
            self.handle_endtag(tag)

    def _close_open(self, tags: set[str]):
        """Close the innermost open element of these tags, unless a container stands between."""
        if not any(self.open[t] for t in tags):
            return
        for at in range(len(self.stack) - 1, -1, -1):
            tag = self.stack[at][0]
            if tag in tags:
                self._close_to(at)
                return
            if tag in CONTAINERS:
                return

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._break()
        if not self.open[tag]:
            return
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close_to(at)
                return
            if tag not in BLOCK and self.stack[at][0] in CONTAINERS:
                return  # a stray inline end closes nothing outside its container

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if not self.link:
                self.plain += len(data)

    def finish(self):
        if re.match(r"<[a-zA-Z/!?]", self.rawdata):  # a tag or comment cut off by the end is no text
            self.rawdata = ""
        self.close()
        self._close_to(0)
        self._break()
        self.last[0] = len(self.tags) - 1
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """The ratios under a Gaussian, edges repeated."""
    radius = int(np.ceil(3 * sigma))
    x = np.arange(-radius, radius + 1)
    kernel = np.exp(-(x**2) / (2 * sigma**2))
    return np.convolve(np.pad(ratios, radius, mode="edge"), kernel / kernel.sum(), mode="valid")


def _held(element: np.ndarray, weight: np.ndarray, last: np.ndarray) -> np.ndarray:
    """By element, the weight of the lines in it."""
    upto = np.concatenate([[0.0], np.bincount(element, weight, len(last)).cumsum()])
    return upto[last + 1] - upto[:-1]


def _noise(parser: Lines, element: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Which lines are no content: barred ones, and those under a name that tells boilerplate on this page."""
    lines = parser.lines
    barred = np.array([x.barred for x in lines], bool)
    if not parser.named:
        return barred
    inside = _held(element, np.array([0.0 if x.barred or x.plain < DENSE * max(1, x.tags) else x.plain for x in lines]), last)
    held: Counter[str] = Counter()
    end: dict[str, int] = {}
    for e, names in parser.named:
        for name in names:
            if e > end.get(name, -1):  # not inside another of that name
                held[name] += inside[e]
                end[name] = last[e]
    void = {name for name, x in held.items() if x and x >= (1.0 if name in REPLIES else MOST_SHARE) * inside[0]}
    around = np.zeros(len(last) + 1, np.int64)
    for e, names in parser.named:
        if names - void:
            around[e] += 1
            around[last[e] + 1] -= 1
    around = around.cumsum()
    main = np.array(parser.main)[element]
    return barred | (around[element] > np.where(main > 0, around[main], 0))


def _region(tags: list[str], inside: np.ndarray, last: np.ndarray) -> tuple[int, bool]:
    """The content region, and whether the page marks it as its content."""
    marked = [e for e, tag in enumerate(tags) if tag in CONTENT and inside[e] > 0]
    whole = [e for e in marked if inside[e] >= (MAIN_SHARE if tags[e] == "main" else MOST_SHARE) * inside[0]]
    if whole:  # the heaviest, the outermost of equals
        return max(whole, key=lambda e: (inside[e], -e)), True
    together, end = 0.0, -1
    for e in marked:
        if e > end:
            together += inside[e]
            end = last[e]
    if marked and together >= MOST_SHARE * inside[0]:  # parts of one text: what encloses them all
        return int(np.flatnonzero(last[: marked[0]] >= end)[-1]), False
    most = [e for e in np.flatnonzero(inside >= MOST_SHARE * inside[0]).tolist() if tags[e] in REGIONS]
    return most[-1] if inside[0] and most else 0, False  # numbers grow inwards, so the innermost


def main_text(html: str | None) -> str:
    """The main text of a page."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    lines = parser.finish()
    element, last = np.array([x.element for x in lines], np.int64), np.array(parser.last)
    good = ~_noise(parser, element, last)
    if not good.any():
        return ""
    ratios = np.array([min(CAP, x.plain / max(1, x.tags)) if g else 0.0 for x, g in zip(lines, good.tolist(), strict=True)])
    smooth = smoothed(ratios)
    chosen = good & (smooth >= THRESHOLD * smooth.std())
    if not chosen.any():
        return ""
    inside = _held(element, np.array([x.plain for x in lines], float) * chosen, last)
    region, marked = _region(parser.tags, inside, last)
    held = np.flatnonzero(good & (element >= region) & (element <= last[region])).tolist()
    if not marked:
        held = _between_clusters(lines, held, chosen)
    return "\n".join(lines[k].text for k in held)


def _between_clusters(lines: list[Line], held: list[int], chosen: np.ndarray) -> list[int]:
    """Of a region's lines those from the first to the last cluster's, without links and copyright at the ends, and the headings before them."""
    own = [k for k in held if chosen[k] and lines[k].plain >= LINK_SHARE * len(lines[k].text) and not COPYRIGHT.match(lines[k].text)]
    picked = own or [k for k in held if chosen[k]]
    if not picked:
        return held
    first, last = picked[0], picked[-1]
    before = [k for k in held if k < first]
    while before and lines[before[-1]].heading:
        first = before.pop()
    return [k for k in held if first <= k <= last]


def _setup() -> Callable:
    def extract(ids, urls, pages):
        texts = [main_text(p) for p in pages]
        return {"page_id": ids, "url": urls, "text": texts, "n_chars": [len(t) for t in texts]}

    return extract


def extract_pages(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html)."""
    out = map_batches(pages, ["page_id", "url", "html"], _setup, "page_id bigint, url string, text string, n_chars bigint")
    return out.select("page_id", "url", F.coalesce("text", F.lit("")).alias("text"), "n_chars")
