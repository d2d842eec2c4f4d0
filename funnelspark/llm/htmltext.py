"""Main text of web pages.

The page is read as a stream of parser events (``html.parser``).  Text between
two block-level tags is one line; each line counts its characters and the tags
seen since the line before; text inside links does not count.  The text-to-tag
ratio of the lines, smoothed with a Gaussian and as it is, is split into two
clusters on a bounded log scale (one very long line does not lift the border
above ordinary ones); lines in the upper cluster of either mark content.  What an element says is evidence beside that:
lines inside page furniture (menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts, styles, by element, role or class) never mark content.

The lines of a page's article elements are a region each, kept whole if one of
them marks content.  Where a page has no article the ratio alone decides: kept
are the lines of a container that holds a marking line itself, those of
containers inside it, stretches between marking lines unless they are mostly
links, and headings right before a kept line; so short paragraphs beside long
ones stay, and link lists and imprints around them go.

A class or id marks furniture when all words of one of its names speak of
furniture or of layout (``share-buttons``, not ``navigation-by-stars``); names of
headings, paragraphs and other pieces of text do not.  Furniture by class or id,
forms and buttons may be marked or closed wrongly: an article inside them counts
where the page has no other, and where nine tenths of the text lie in them,
those that hold over half of it are no furniture.

Character references are decoded, white space inside a line becomes one space,
and lines are joined by a line feed.  One pass over the pages, no shuffle.

Defined results: NULL, empty and text-free pages give an empty text; unclosed
or stray tags end with the page; repeated rows and NULL ids keep their rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import blocks

BLOCK = frozenset("""address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html li main nav ol optgroup option p pre search section summary
    table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
FURNITURE = frozenset("""nav footer aside form script style noscript template iframe object head title button select
    textarea svg canvas menu dialog search fieldset label audio video math""".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
#: Not sure to be furniture; end tags of elements around them close them.
LOOSE = frozenset(("form", "button", "fieldset", "label"))
SOFT, HARD = 1, 2
#: Words of a class or id that mark furniture; whole words only, split at marks and case changes.
MARKS = frozenset("""ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar
    navigation menu breadcrumb breadcrumbs sidebar aside widget footer masthead topbar cookie cookies consent gdpr notice
    notices alert popup modal overlay newsletter subscribe subscription signup share sharing social comment comments
    disqus reply replies respond related recommended recommendations pagination pager toolbar login search form""".split())
#: Words of layout that may stand beside them.
LAYOUT = frozenset("""area bar block body bottom box button buttons card center col column container content desktop element fixed global
    group header heading icon icons inline inner item items left line link links list main message mobile module outer page panel post
    posts article articles primary right row secondary section site slot small static sticky story stories text title top unit wide
    wrap wrapper zone""".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Pieces of text: a class or id of theirs is the author's, not the page's.
PIECES = HEADINGS | frozenset("address blockquote dd details dt figcaption figure li p pre summary td th tr".split())
#: A line lies in the nearest of these that is open.
CONTAINERS = frozenset("article body div dl html main ol section table ul".split())
PAGE = frozenset(("", "html", "body"))
RATIO_CAP = 100.0  # characters a tag from which a line is text without doubt
#: Elements a start tag closes when they are open and nothing like a container lies between.
CLOSES = {"p": {"p"}, "li": {"li", "p"}, "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}, "option": {"option"},
          "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"}}


class _Lines(HTMLParser):
    """Lines of a page: (text, tags before it, SOFT or HARD furniture or 0,
    article number, below zero inside soft furniture).  ``holders`` has the
    numbers of the containers around each, below zero for the page itself, the
    innermost last; ``links`` the characters of each inside links; ``heads``
    whether it is a heading.  Elements of the numbers ``cleared`` are no soft
    furniture."""

    def __init__(self, cleared: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.cleared = cleared
        self.soft: dict[int, int] = {}  # characters inside the elements that are soft furniture by themselves
        self.lines: list[tuple[str, int, int, int]] = []
        self.open: list[tuple[str, int, int]] = []  # element, furniture, article number
        self.held: list[str] = []
        self.holders: list[tuple[int, ...]] = []
        self.links: list[int] = []
        self.heads: list[bool] = []
        self.linked = 0  # of the line so far
        self.numbers: list[int] = []  # of the open elements
        self.started = 0
        self.tags = 0
        self.articles = 0

    def _end_line(self):
        text = " ".join("".join(self.held).split())
        self.held.clear()
        if text:
            furniture, article = (self.open[-1][1], self.open[-1][2]) if self.open else (0, 0)
            if furniture < HARD:
                for n in self.soft.keys() & set(self.numbers):
                    self.soft[n] += len(text)
            self.lines.append((text, self.tags, furniture, article))
            names = [x[0] for x in self.open]
            self.holders.append((0, *((-n if x in PAGE else n) for x, n in zip(names, self.numbers) if x in CONTAINERS)))
            self.links.append(min(self.linked, len(text)))
            self.heads.append(any(x in HEADINGS for x in names))
            self.tags = 0
        self.linked = 0

    def _furniture(self, tag: str, attrs, article: int) -> int:
        if tag in FURNITURE and tag not in LOOSE or tag == "header" and not article:
            return HARD
        if tag in ("html", "body", "main", "article"):
            return 0
        a = dict(attrs)
        if (a.get("role") or "").lower() in ROLES or "hidden" in a or a.get("aria-hidden") == "true":
            return HARD
        if tag in LOOSE:
            return SOFT
        for token in [] if tag in PIECES else f"{a.get('class') or ''} {a.get('id') or ''}".split():
            words = {w.lower() for w in WORD.findall(token) if not w.isdigit()}
            if words & MARKS and words <= MARKS | LAYOUT:
                return SOFT
        return 0

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        furniture, article = (self.open[-1][1], self.open[-1][2]) if self.open else (0, 0)
        block = tag in BLOCK or tag in FURNITURE
        if block:
            self._end_line()
            for i in range(len(self.open) - 1, -1, -1):  # what this tag closes by itself
                name = self.open[i][0]
                if name in CLOSES.get(tag, ("p",) if tag in BLOCK else ()):
                    del self.open[i:], self.numbers[i:]
                    furniture, article = (self.open[-1][1], self.open[-1][2]) if self.open else (0, 0)
                    break
                if name in BLOCK or name in FURNITURE:
                    break
        elif tag == "br":
            self.held.append(" ")
        if tag in VOID:
            return
        if tag == "article" or tag == "main" or ("itemprop", "articleBody") in attrs or ("role", "main") in attrs:
            if furniture == SOFT:
                self.articles += 1
                furniture, article = 0, -self.articles
            elif not article and not furniture:
                self.articles += 1
                article = self.articles
        own = self._furniture(tag, attrs, article)
        if own == SOFT:
            if self.started + 1 in self.cleared:
                own = 0
            else:
                self.soft[self.started + 1] = 0
        own = max(own, furniture)
        if own and not furniture and not block:  # furniture begins inside a line
            self._end_line()
        self.open.append((tag, own, article))
        self.started += 1
        self.numbers.append(self.started)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.tags += 1
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i][0] == tag:
                outer = self.open[i - 1][1] if i else 0
                if tag in BLOCK or tag in FURNITURE or self.open[i][1] != outer:
                    self._end_line()
                del self.open[i:], self.numbers[i:]
                return
            if self.open[i][0] in FURNITURE and (self.open[i][0] not in LOOSE or tag not in BLOCK and self.open[i][0] != "label"):
                return  # a stray end tag does not leave furniture

    def handle_data(self, data):
        self.held.append(data)
        if any(x[0] == "a" for x in self.open):
            self.linked += len(data.strip())

    def unknown_decl(self, data):
        pass

    def close(self):
        super().close()
        self._end_line()


def _smooth(x: np.ndarray, sigma: float) -> np.ndarray:
    reach = int(3 * sigma)
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, reach), k / k.sum(), "valid")


def _threshold(x: np.ndarray) -> float:
    """The border between two clusters of values (two-means from the ends)."""
    lo, hi = float(x.min()), float(x.max())
    for _ in range(32):
        cut = (lo + hi) / 2
        a, b = x[x < cut], x[x >= cut]
        if not len(a) or not len(b) or (a.mean(), b.mean()) == (lo, hi):
            break
        lo, hi = float(a.mean()), float(b.mean())
    return (lo + hi) / 2


def _parsed(html: str, cleared: frozenset[int] = frozenset()) -> _Lines:
    parser = _Lines(cleared)
    parser.feed(html)
    parser.close()
    return parser


def _kept(parser: _Lines, own: list[int], content: list[bool]) -> list[int]:
    """Of the lines ``own`` of a page without articles those to keep."""
    inner = {i: parser.holders[i][-1] for i in own}
    good = {inner[i] for i in own if content[i]}
    first, last = next(i for i in own if content[i]), next(i for i in reversed(own) if content[i])
    chars: dict[int, list[int]] = {}
    for i in own:
        sums = chars.setdefault(inner[i], [0, 0])
        sums[0] += len(parser.lines[i][0])
        sums[1] += parser.links[i]
    keep = [inner[i] in good or any(h > 0 and h in good for h in parser.holders[i])
            or first < i < last and 2 * chars[inner[i]][1] < chars[inner[i]][0] for i in own]
    for k in range(len(own) - 2, -1, -1):  # headings of what is kept
        keep[k] = keep[k] or parser.heads[own[k]] and keep[k + 1]
    return [i for i, k in zip(own, keep) if k]


def main_text(html: str | None, sigma: float = 1.5) -> str:
    if not html:
        return ""
    parser = _parsed(html)
    rest = sum(len(x[0]) for x in parser.lines if not x[2])
    whole = sum(len(x[0]) for x in parser.lines if x[2] < HARD)
    if 10 * rest < whole:
        parser = _parsed(html, frozenset(n for n, held in parser.soft.items() if 2 * held > whole))
    lines = parser.lines
    if any(x[3] > 0 and not x[2] for x in lines):  # articles inside soft furniture are comments or teasers there
        lines = [(text, tags, furniture or (SOFT if article < 0 else 0), article) for text, tags, furniture, article in lines]
    if not lines or all(x[2] for x in lines):
        return ""
    ratio = np.array([0.0 if x[2] else (len(x[0]) - linked) / max(1, x[1]) for x, linked in zip(lines, parser.links)])
    ratio = np.log1p(np.minimum(ratio, RATIO_CAP))
    smooth = _smooth(ratio, sigma)
    # By its surroundings or by itself: beside furniture and at the ends of a page smoothing lowers a line.
    upper = (smooth >= _threshold(smooth)) & (ratio > 0) | (ratio >= _threshold(ratio))
    content = [not x[2] and bool(u) for x, u in zip(lines, upper)]
    own = [i for i, x in enumerate(lines) if not x[2]]
    if not any(content):  # nothing stands out
        content[max(own, key=lambda i: (ratio[i], -i))] = True
    articles: dict[int, list[int]] = {}
    for i in own:
        if lines[i][3]:
            articles.setdefault(lines[i][3], []).append(i)
    if articles:
        picked = [r for r in articles.values() if any(content[i] for i in r)] or [max(articles.values(), key=lambda r: sum(ratio[i] for i in r))]
        kept = sorted(i for r in picked for i in r)
    else:
        kept = _kept(parser, own, content)
    return "\n".join(lines[i][0] for i in kept)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars for every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in blocks(batch, "html"):
                text = [main_text(h) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(text, pa.string()), pa.array(list(map(len, text)), pa.int64())],
                    ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), "html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")
