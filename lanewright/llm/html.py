"""Main text of web pages: parser events, text-to-tag ratios, smoothing, thresholds.

The standard library's parser streams its events into lines, one for each block of text;
elements that never hold an article's text (menus, headers, footers, sidebars, notices,
adverts, forms, scripts, reader comments) give no lines. Each line has a text-to-tag ratio:
its characters over its tags. The ratios are smoothed by a Gaussian and split by a
threshold into content and other lines. The content region is an article or main element,
if one holds most of the content's characters, else the innermost element that holds all of
them; all of its lines are the main text, so that a short paragraph between long ones is
never lost.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField, StructType

from lanewright.llm.batches import pieces, strings

#: Standard deviation of the smoothing, in lines, and its reach.
SIGMA, REACH = 1.0, 3
#: A line is content from this share of the smoothed ratios' standard deviation on.
THRESHOLD = 0.5
#: An article or main element is the region if it holds at least this share of the content's characters.
REGION_SHARE = 0.6

# fixed values: names of HTML
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rb rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
NEVER = frozenset(
    "nav footer aside form script style head title noscript template iframe object embed applet canvas svg math audio video "
    "button select option optgroup datalist textarea input dialog menu map frameset noframes".split()
)
ARTICLE = frozenset(["article", "main"])
#: Elements that an opening tag of another one closes: p and list items need no end tag.
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = frozenset("article aside body div dl footer form header html main nav ol section table td th ul".split())
#: Words of class, id and role that mark other elements as no part of an article.
OTHER_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner banners breadcrumb breadcrumbs comment comments commentlist cookie "
    "cookies consent copyright disqus footer gdpr header masthead menu menubar modal nav navbar navigation newsletter notice notices "
    "pager pagination paywall popup promo promoted promotion recommended related replies respond share sharing sidebar signup skip social sponsor "
    "sponsored subscribe subscription tags toolbar topbar widget widgets complementary contentinfo search alert alertdialog dialog".split()
)
#: Of these, names that an article's own parts may have too; they count outside articles only.
OUTSIDE_ONLY = frozenset(["header"])
SEPARATORS = re.compile(r"[^a-z]+")


def is_other(tag: str, attrs: list[tuple[str, str | None]], in_article: bool) -> bool:
    """Whether an element holds something else than an article's text."""
    if tag in NEVER or tag == "header" and not in_article:
        return True
    if tag in ("html", "body") or tag in ARTICLE:
        return False
    for name, value in attrs:
        if name in ("hidden",) or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and value and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return True
        if name in ("class", "id", "role") and value:
            words = set(SEPARATORS.split(re.sub(r"([a-z])([A-Z])", r"\1-\2", value).lower())) & OTHER_WORDS
            if words - OUTSIDE_ONLY or words and not in_article:
                return True
    return False


@dataclass
class Line:
    """One block's text, its tags and the elements around it."""

    path: tuple[int, ...]
    parts: list[str] = field(default_factory=list)
    tags: int = 0

    @property
    def text(self) -> str:
        return " ".join("".join(self.parts).split())


class Lines(HTMLParser):
    """Turns a page into lines; keeps the open elements and whether they are left out."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, bool]] = []  # tag, number, left out
        self.kinds: list[str] = []  # tag of each numbered element
        self.lines: list[Line] = []
        self.tags = 0
        self.fresh = True

    def left_out(self) -> bool:
        return bool(self.open) and self.open[-1][2]

    def pop_to(self, index: int) -> None:
        del self.open[index:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.fresh = True
        if tag in CLOSES_P:
            self.close_within("p", {"p"}, {"button"} | SCOPE)
        if tag in SAME:
            self.close_within(tag, SAME[tag], {"ul", "ol", "dl", "table", "select"})
        if tag == "body":  # text before it stays outside; a head that was never closed ends here
            while self.open and self.open[-1][0] in ("head", "title", "style", "noscript"):
                self.open.pop()
        if tag in VOID:
            return
        in_article = any(t in ARTICLE for t, _, _ in self.open)
        self.kinds.append(tag)
        self.open.append((tag, len(self.kinds) - 1, self.left_out() or is_other(tag, attrs, in_article)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in ("svg", "path"):
            self.handle_endtag(tag)

    def close_within(self, tag: str, closed: set[str], stop: frozenset[str] | set[str]) -> None:
        """Closes the nearest open element of ``closed``, unless one of ``stop`` stands between."""
        for k in range(len(self.open) - 1, -1, -1):
            name = self.open[k][0]
            if name in closed:
                self.pop_to(k)
                return
            if name in stop:
                return

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        if tag not in INLINE:
            self.fresh = True
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.pop_to(k)
                return
            if tag in INLINE and self.open[k][0] in SCOPE:
                return

    def handle_data(self, data: str) -> None:
        if self.left_out():
            return
        path = tuple(n for tag, n, _ in self.open if tag not in INLINE)
        if self.fresh or not self.lines or self.lines[-1].path != path:
            if not data.strip():
                return
            self.lines.append(Line(path))
            self.fresh = False
        self.lines[-1].parts.append(data)
        self.lines[-1].tags += self.tags
        self.tags = 0


def parse(html: str) -> tuple[list[Line], list[str]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    return [line for line in parser.lines if line.text], parser.kinds


def smoothed(ratios: np.ndarray) -> np.ndarray:
    """Gaussian average over neighbouring lines; at the ends over those that there are."""
    kernel = np.exp(-0.5 * (np.arange(-REACH, REACH + 1) / SIGMA) ** 2)
    sums = np.convolve(ratios, kernel)[REACH : REACH + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), kernel)[REACH : REACH + len(ratios)]


def content(lines: list[Line]) -> np.ndarray:
    """Which lines' smoothed text-to-tag ratios lie above the threshold."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    smooth = smoothed(ratios)
    return smooth >= THRESHOLD * smooth.std()


def region(lines: list[Line], kinds: list[str], chosen: np.ndarray) -> int | None:
    """The element that holds the content: an article or main element, else the innermost with all of it.

    None stands for the page.
    """
    weight: dict[int, int] = {}
    total = 0
    for line, yes in zip(lines, chosen):
        if yes:
            total += len(line.text)
            for n in line.path:
                weight[n] = weight.get(n, 0) + len(line.text)
    enough = [n for n, w in weight.items() if w >= REGION_SHARE * total]
    articles = [n for n in weight if kinds[n] in ARTICLE]
    if articles:  # the outermost article with the most content; a main element that holds several is one
        best = max(articles, key=lambda n: (weight[n], -n))
        if weight[best] >= REGION_SHARE * total or not enough:
            return best
    return _inner([n for n in enough if weight[n] == total], kinds)


def _inner(enough: list[int], kinds: list[str]) -> int | None:
    blocks = [n for n in enough if kinds[n] in SCOPE and kinds[n] not in ("td", "th")]
    return max(blocks) if blocks else None


def main_text(html: str) -> str:
    """The main text of a page; blocks are joined by a space."""
    lines, kinds = parse(html)
    if not lines:
        return ""
    inside = region(lines, kinds, content(lines))
    return " ".join(line.text for line in lines if inside is None or inside in line.path)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """The pages' other columns and ``text``, the main text; ``html`` is left out.

    A null or empty page, or one without main text, has an empty text. Repeated rows are
    taken one by one; an empty table gives an empty result.
    """
    at = pages.columns.index(html)
    rest = [k for k in range(len(pages.columns)) if k != at]
    schema = StructType([*(pages.schema.fields[k] for k in rest), StructField(text, StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, html):
            texts = pa.array([main_text(x) for x in strings(batch, html)], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in rest), texts], names=schema.names)

    return pages.mapInArrow(run, schema)
