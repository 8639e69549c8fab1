"""Main text of web pages by text-to-tag ratios (operator 9)."""

from __future__ import annotations

import itertools
import math
import re
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Elements by their part in a page, and words in class, id and role that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset("script style template noscript head title iframe object svg canvas select textarea button".split())
ASIDE = frozenset("nav footer aside form dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol option p pre section summary table tbody td tfoot th "
    "thead tr ul".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# What a region can't be narrowed to: a paragraph, a heading, an item or a row is a part of one.
PARTS = HEADINGS | frozenset("p pre li dt dd tr blockquote figure figcaption caption summary address option".split())
ENDED_BY_SIBLING = {
    "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"},
    "option": {"select"},
}
MARKED = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent notice notices "
    "alert gdpr popup modal overlay newsletter subscribe signup login sidebar sidebars aside widget widgets menu menus nav navbar "
    "navigation breadcrumb breadcrumbs toolbar footer header masthead comment comments commentlist disqus discussion "
    "replies respond related recommended share sharing social pagination pager complementary contentinfo search".split()
)
REMARKS = frozenset("comment comments commentlist replies".split())

# Smoothing of the ratios, what a named element adds to the logarithm, and the share of the text a container has to hold.
RADIUS, SIGMA = 2, 1.0
HINT = math.log(4)
SHARE = 0.8
CHUNK = 1 << 16
_NAMES = re.compile(r"[a-z0-9]+")
NOWHERE = -1


class _Open:
    """An open element. ``doubt`` is the innermost doubtful mark around it, ``container`` its place in the tree of blocks."""

    __slots__ = ("tag", "aside", "named", "header", "doubt", "container")

    def __init__(self, tag, aside=False, named=False, header=False, doubt=NOWHERE, container=0):
        self.tag, self.aside, self.named, self.header, self.doubt, self.container = tag, aside, named, header, doubt, container


class _Line:
    """What lies between two block tags."""

    __slots__ = ("words", "tags", "linked", "aside", "named", "heading", "doubt", "container")

    def __init__(self, words, tags, linked, within, heading):
        self.words, self.tags, self.linked, self.heading = words, tags, linked, heading
        self.aside, self.named, self.doubt, self.container = within.aside, within.named, within.doubt, within.container


class _Lines(HTMLParser):
    """Parser events as lines, the tree of the blocks they lie in, and the tree of doubtful marks.

    All of it takes time in proportion to the page: elements are found by counts of the open ones, and what they inherit
    is a place in a tree.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = [_Open("")]
        self.blocks: list[int] = []  # places of open blocks
        self.counts: Counter = Counter()
        self.headings = 0
        self.lines: list[_Line] = []
        self.text: list[str] = []
        self.tags, self.linked, self.heading = 0, 0, False
        # Blocks: the one around each; whether it is named as content, part of a region, or the page itself.
        self.parents: list[int] = [NOWHERE]
        self.whole: list[bool] = [False]
        self.part: list[bool] = [False]
        self.plain: list[bool] = [True]
        # Doubtful marks: the next one outside, whether it is of remarks, and the innermost one of remarks.
        self.outer: list[int] = []
        self.remarks: list[bool] = []
        self.remark: list[int] = []

    def _break(self):
        words = " ".join("".join(self.text).split())
        if words or self.tags:
            self.lines.append(_Line(words, self.tags, self.linked, self.open[-1], self.heading))
        self.text, self.tags, self.linked, self.heading = [], 0, 0, False

    def _drop(self, depth: int):
        for element in self.open[depth:]:
            self.counts[element.tag] -= 1
            self.headings -= element.tag in HEADINGS
        del self.open[depth:]
        while self.blocks and self.blocks[-1] >= depth:
            self.blocks.pop()

    def _end_siblings(self, tag: str):
        """A block ends an open paragraph, and an item of a list or table the one before it."""
        for at in reversed(self.blocks):
            above = self.open[at].tag
            if above == "p" or above == tag and tag in ENDED_BY_SIBLING:
                self._break()
                self._drop(at)
                return
            if above in ENDED_BY_SIBLING.get(tag, ()) or above not in ENDED_BY_SIBLING:
                return

    def _doubt(self, above: int, remark: bool) -> int:
        self.outer.append(above)
        self.remarks.append(remark)
        self.remark.append(len(self.remarks) - 1 if remark else self.remark[above] if above >= 0 else NOWHERE)
        return len(self.outer) - 1

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            self._break()
            self._end_siblings(tag)
        self.tags += 1
        if tag in VOID:
            return
        above = self.open[-1]
        element = _Open(tag, above.aside, above.named, above.header, above.doubt, above.container)
        whole = {name for k, v in attrs if v and k in ("class", "id", "role", "aria-label") for name in v.lower().split()}
        names = {part for name in whole for part in _NAMES.findall(name)}
        named = tag in ("article", "main") or "main" in {v for k, v in attrs if k == "role"}
        if named:
            element.aside = element.aside or bool(names & REMARKS)
            # Only comments go on inside.
            element.doubt = self.remark[above.doubt] if above.doubt >= 0 else NOWHERE
            element.named = True
        elif tag not in ("html", "body"):
            element.header = element.header or tag == "header"
            element.aside = (
                element.aside or tag in ASIDE or tag in SILENT or bool(whole & MARKED) or tag == "header" and not element.named
            )
            if not element.aside and names & MARKED:
                element.doubt = self._doubt(above.doubt, bool(names & REMARKS))
        if tag not in SILENT and (element.aside, element.doubt) != (above.aside, above.doubt):
            self._break()
        if tag in BLOCKS or named or tag == "body":
            element.container = len(self.parents)
            self.parents.append(above.container)
            self.whole.append(named)
            self.part.append(tag in PARTS)
            self.plain.append(tag in ("html", "body"))
        if tag in BLOCKS:
            self.blocks.append(len(self.open))
        self.open.append(element)
        self.counts[tag] += 1
        self.headings += tag in HEADINGS

    def handle_endtag(self, tag):
        if self.counts[tag] > 0:
            at = len(self.open) - 1
            while self.open[at].tag != tag:
                at -= 1
            element = self.open[at]
            if tag in BLOCKS or (element.aside or element.doubt >= 0) and tag not in SILENT:
                self._break()
            self._drop(at)
        if tag in BLOCKS:
            self._break()
        self.tags += 1

    def handle_data(self, data):
        within = self.open[-1]
        if within.tag in SILENT:
            return
        # Inside an article a header keeps its headings.
        if within.header and not self.headings:
            return
        self.text.append(data)
        if self.headings and not data.isspace():
            self.heading = True
        if self.counts["a"] > 0:
            self.linked += len(data)


def _threshold(values: np.ndarray) -> float:
    """Where two clusters of the values meet."""
    low, high = values.min(), values.max()
    for _ in range(20):
        middle = (low + high) / 2
        below, above = values[values < middle], values[values >= middle]
        following = (below.mean() if len(below) else low, above.mean() if len(above) else high)
        if following == (low, high):
            break
        low, high = following
    return (low + high) / 2


def _settle(page: _Lines) -> None:
    """Lines below a doubtful mark are aside, unless what it marks holds half of the unlinked text that is not aside."""
    sums, total = [0] * len(page.outer), 0
    for line in page.lines:
        if not line.aside:
            size = max(0, len(line.words) - line.linked)
            total += size
            if line.doubt >= 0:
                sums[line.doubt] += size
    # Marks inside others come later.
    for mark in range(len(sums) - 1, -1, -1):
        if page.outer[mark] >= 0:
            sums[page.outer[mark]] += sums[mark]
    minor: list[bool] = []
    for mark, size in enumerate(sums):
        minor.append(2 * size < total or page.outer[mark] >= 0 and minor[page.outer[mark]])
    for line in page.lines:
        line.aside = line.aside or line.doubt >= 0 and minor[line.doubt]


def smoothed_ratios(lines: list[_Line]) -> np.ndarray:
    """Logarithms of the text-to-tag ratios, smoothed along the page. What is aside has the ratio 0."""
    values = [
        math.log1p(max(0, len(line.words) - line.linked) / max(1, line.tags)) + HINT * line.named
        if line.words and not line.aside
        else 0.0
        for line in lines
    ]
    steps = np.arange(-RADIUS, RADIUS + 1)
    kernel = np.exp(-(steps**2) / (2 * SIGMA**2))
    return np.convolve(np.pad(values, RADIUS, mode="edge"), kernel / kernel.sum(), mode="valid")


def _container(page: _Lines, masses: list[int], sizes: list[int]) -> int:
    """The innermost block of several lines that holds nearly all of the text of the upper cluster; none inside an article.

    ``masses`` and ``sizes`` are the text of the upper cluster and the number of lines of each block alone.
    """
    total, best = sum(masses), [NOWHERE] * len(masses)
    for block in range(len(masses) - 1, 0, -1):
        masses[page.parents[block]] += masses[block]
        sizes[page.parents[block]] += sizes[block]
    for block in range(1, len(masses)):
        above = page.parents[block]
        if best[above] < 0 or masses[block] > masses[best[above]]:
            best[above] = block
    found = inner = 0
    while not page.whole[inner] and best[inner] >= 0 and masses[best[inner]] >= SHARE * total:
        inner = best[inner]
        if page.part[inner]:
            break
        if sizes[inner] > 1 or page.whole[inner] or page.plain[inner]:
            found = inner
    return found


def main_text(html: str | None) -> str:
    """The article of a page: its blocks in order, joined by a space.

    The events of the parser make lines, one for each block. A line's text-to-tag ratio is the length of its unlinked text
    by its tags; what the page marks as navigation, notice, advert, form, comment and the like counts as tags only. A word that is
    just a part of a class name or id (``has-sidebar``) marks only what holds a minor part of the text, and no ``article`` or
    ``main`` inside, save for comments.

    The logarithms of the ratios are smoothed by a Gaussian along the page and split into two clusters. Being inside ``article`` or
    ``main`` adds a constant to the logarithm and decides nothing by itself. The region is the innermost block that holds nearly
    all text of the upper cluster. All of its lines are taken, headings and short ones included, but for links around them. If
    this is the page itself, the lines from the first to the last of the upper cluster are, with headings right before.
    """
    if not html:
        return ""
    page = _Lines()
    for at in range(0, len(html), CHUNK):
        page.feed(html[at : at + CHUNK])
    page.close()
    page._break()
    _settle(page)
    lines = page.lines
    usable = np.array([bool(line.words) and not line.aside for line in lines], bool)
    if not usable.any():
        return ""
    smooth = smoothed_ratios(lines)
    upper = usable & (smooth >= _threshold(smooth))
    masses, sizes = [0] * len(page.parents), [0] * len(page.parents)
    for line, good, high in zip(lines, usable, upper, strict=True):
        sizes[line.container] += bool(good)
        if high:
            masses[line.container] += max(0, len(line.words) - line.linked)
    if not sum(masses):
        return ""
    region = _container(page, masses, sizes)
    within = [block == region for block in range(len(masses))]
    for block in range(1, len(masses)):
        within[block] = within[block] or within[page.parents[block]]
    inside = usable & np.array([within[line.container] for line in lines], bool)
    high = np.flatnonzero(upper & inside)
    first, last = int(high[0]), int(high[-1])
    places = np.flatnonzero(inside).tolist()
    before, after = [at for at in places if at < first], [at for at in places if at > last]
    if page.plain[region]:
        # Nothing but the order of the lines tells the article from its surroundings.
        before = list(itertools.takewhile(lambda at: lines[at].heading, before[::-1]))[::-1]
        after = []
    links = lambda at: 2 * lines[at].linked >= len(lines[at].words)
    before = list(itertools.dropwhile(links, before))
    after = list(itertools.dropwhile(links, after[::-1]))[::-1]
    taken = before + [at for at in places if first <= at <= last] + after
    return " ".join(lines[at].words for at in taken)


def extracted(pages: DataFrame) -> DataFrame:
    """All columns of ``pages``, then ``text`` (see :func:`main_text`) and ``n_chars``, its code points.

    The whole of ``html`` is read; null is empty, and so is the text of a page without any. Columns of the input by
    these two names are replaced. Each page is worked on by itself, so there is nothing to shuffle.
    """
    own = [name for name in pages.columns if name not in ("text", "n_chars")]
    frame = pages.select(*own)
    at = own.index("html")

    def extract(batches):
        for batch in batches:
            texts = [main_text(html) for html in batch.column(at).to_pylist()]
            sizes = pa.array([len(text) for text in texts], pa.int64())
            columns = [*batch.columns, pa.array(texts, pa.string()), sizes]
            yield pa.record_batch(columns, [*batch.schema.names, "text", "n_chars"])

    return frame.mapInArrow(extract, StructType(list(frame.schema.fields)).add("text", "string").add("n_chars", "long"))


def main_texts(pages: DataFrame) -> DataFrame:
    return extracted(pages.select("page_id", "url", "html")).select("page_id", "url", "text", F.col("n_chars"))
