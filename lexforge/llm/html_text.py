"""Main text of HTML pages.

The standard library's parser gives events; text is gathered in blocks, the lines of the page, each with its characters,
its tags and its place in the tree. The text-to-tag ratios of the lines are smoothed with a Gaussian and parted into two
clusters by a threshold; the lines of the upper cluster are content regions. The regions choose the element that holds the
article: the smallest one with (nearly) all of their text. Of that element every block counts, however short, except what
stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader comments. A wrapper that
is such by its class, id or role, or a form, is kept if it holds the main region: where the text beside all wrappers is less
than a fourth of the region within. Headings, paragraphs and other elements of running text are judged by whole words of
class and role only, never by their ids (which are often made of their words). Where a name only contains a word that
articles use as well (ad-hoc, related-work), the clusters decide: such lines go only if they are outside the content regions.

Where no element below the body holds the regions, the blocks from the first region to the last are taken, without those
that are mostly links.

Every event costs the same however deep the page is nested; a block keeps its element's number, not its path.

Defined results: null and empty html, and pages without text, give an empty text; markup errors never fail (what cannot
be parsed loses its first character and counts as text); repeated rows are extracted row by row; extra columns are ignored, whatever
their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexforge.llm.common import pieces, texts

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template head title nav header footer aside form menu button select option textarea iframe object svg canvas dialog audio video".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul".split())
#: An element of this kind ends when one of the given ones begins (HTML's optional end tags).
CLOSES = {"p": BLOCKS - {"body", "html"}, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "tbody", "tfoot"}, "td": {"td", "th", "tr", "tbody", "tfoot"}, "th": {"td", "th", "tr", "tbody", "tfoot"}, "option": {"option"}}
#: Elements beyond which an optional end tag is not looked for.
HOLDS = {"p": {"button", "td", "th", "table"}, "li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "option": {"select"}}
#: By tag, the kinds of open elements that it ends.
ENDS = {tag: [kind for kind, enders in CLOSES.items() if tag in enders] for tag in {t for enders in CLOSES.values() for t in enders}}
#: Elements that can hold an article; paragraphs, headings and inline elements cannot.
HOLDERS = frozenset("article main section div body td center table tbody tr blockquote html fieldset".split())
#: Words of class, id and role that mark what is not the article.
MARKS = frozenset("ad ads adv advert adverts advertisement advertising adsbygoogle banner banners sponsor sponsored sponsors promo promos promotion sidebar sidebars aside menu menus nav navbar navigation breadcrumb breadcrumbs header masthead footer foot footnav cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments commentlist disqus respond replies reply pagination pager toolbar widget widgets copyright complementary contentinfo search".split())
#: Of these, the words of reader comments: such a wrapper holds the main region only where no other text is left.
COMMENTS = frozenset("comment comments commentlist disqus respond replies reply".split())
#: Of these, the words that articles use too: as a part of a longer name they count only outside the content regions.
COMMON = frozenset("ad ads aside alert foot header login notice notices modal overlay popup promotion recommended related replies reply respond search share sharing signup social subscribe subscription toolbar widget widgets copyright banner".split())
#: Elements of running text.
RUNNING = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th blockquote pre figure figcaption table tr".split())
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
SIGMA = 1.5


@dataclass
class Block:
    text: str
    linked: int
    tags: int
    at: int  # number of the innermost element
    wrapper: int  # the innermost open element that is skipped for its marks only, or a form; 0 if none
    weak: int  # the innermost open element whose name only contains a common word; 0 if none


@dataclass(slots=True)
class Element:
    tag: str
    number: int
    skip: bool
    soft: bool = False
    weak: bool = False


@dataclass
class Lines(HTMLParser):
    """Parser events to blocks. Elements are numbered in the order of their beginnings, so a subtree is a range of numbers."""

    blocks: list[Block] = field(default_factory=list)

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.open: dict[str, list[int]] = {}  # places in the stack by tag
        self.tags = self.linked = self.links = self.hards = 0
        self.parts: list[str] = []
        self.wrap: list[int] = []  # open skipped elements
        self.weaks: list[int] = []  # open elements with such names
        self.outer: dict[int, int] = {}  # of skipped elements: the skipped element around it
        self.comments: set[int] = set()  # skipped elements in reader comments
        self.names, self.parent = [""], [0]  # by element number

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        if text and not self.hards:
            self.blocks.append(Block(text, self.linked, self.tags, self.stack[-1].number if self.stack else 0, self.wrap[-1] if self.wrap else 0, self.weaks[-1] if self.weaks else 0))
        self.parts, self.tags, self.linked = [], 0, 0

    def last(self, tags) -> int:
        """The highest place in the stack of any of the tags; -1 if none is open."""
        return max((places[-1] for t in tags if (places := self.open.get(t))), default=-1)

    def push(self, e: Element) -> None:
        self.open.setdefault(e.tag, []).append(len(self.stack))
        self.parent.append(self.stack[-1].number if self.stack else 0)
        self.stack.append(e)
        self.links += e.tag == "a"
        if e.weak:
            self.weaks.append(e.number)
        if e.skip:
            self.hards += not e.soft
            self.outer[e.number] = self.wrap[-1] if self.wrap else 0
            if self.outer[e.number] in self.comments:
                self.comments.add(e.number)
            self.wrap.append(e.number)

    def shown(self, e: Element) -> None:
        if e.skip:
            self.hards -= not e.soft
            self.wrap.remove(e.number)
            e.skip = False

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCKS:
            self.end_block()
        for kind in ENDS.get(tag, ()):
            if (i := self.last([kind])) > self.last(HOLDS[kind]):
                self.pop_to(i)
        self.tags += 1
        if tag in VOID:
            if tag in ("br", "hr"):
                self.parts.append(" ")
            return
        if tag in ("article", "main") and self.wrap:  # an article inside a form or page header is no part of it
            for i in [*self.open.get("form", []), *self.open.get("header", [])]:
                self.shown(self.stack[i])
        self.names.append(tag)
        number = len(self.names) - 1
        words, weak = (set(), False) if tag in ("html", "body", "article", "main") else marks(tag, attrs)
        skip = tag in SKIPPED or bool(words)
        if words & COMMENTS:
            self.comments.add(number)
        if skip and tag not in BLOCKS and not self.wrap:  # inline: the text before it stays with what follows
            self.push(Element(tag, number, True))
            self.saved = (self.parts, self.tags, self.linked)
            self.parts, self.tags, self.linked = [], 0, 0
        else:
            self.push(Element(tag, number, skip, skip and "" not in words and (tag == "form" or tag not in SKIPPED), weak and not skip))

    def pop_to(self, i: int) -> None:
        gone = self.stack[i:]
        block = any(e.tag in BLOCKS for e in gone)
        inline = any(e.skip and e.tag not in BLOCKS for e in gone)
        if inline and sum(e.skip for e in gone) == len(self.wrap) and hasattr(self, "saved"):
            self.parts, self.tags, self.linked = self.saved
            del self.saved
        if block:
            self.end_block()
        for e in reversed(gone):
            self.open[e.tag].pop()
            self.links -= e.tag == "a"
            if e.weak:
                self.weaks.pop()
            if e.skip:
                self.hards -= not e.soft
                self.wrap.pop()
        del self.stack[i:]

    def handle_endtag(self, tag: str) -> None:
        i = self.last([tag])
        if i >= 0 and (tag in BLOCKS or i >= self.last(("article", "main", "td", "th", "body"))):
            self.pop_to(i)
        elif tag in BLOCKS:
            self.end_block()

    def handle_data(self, data: str) -> None:
        self.parts.append(data)
        if self.links:
            self.linked += len(data.strip())


def marks(tag: str, attrs: list[tuple[str, str | None]]) -> tuple[set[str], bool]:
    """The words that mark an element ("" if it is not shown at all), and whether its names only contain common ones."""
    found, weak = set(), False
    for name, value in attrs:
        if name in ("class", "id", "role") and value and not (name == "id" and tag in RUNNING):
            for token in value.split():
                words = [w.lower() for w in WORD.findall(token)]
                hit = MARKS.intersection(words)
                if len(words) == 1:
                    found |= hit
                elif tag not in RUNNING:
                    found |= hit - COMMON
                    weak = weak or bool(hit & COMMON)
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            found.add("")
    return found, weak


def failed_at(error: BaseException) -> int:
    """Where in its text the parser stood when it failed."""
    at, trace = 0, error.__traceback__
    while trace is not None:
        if trace.tb_frame.f_code.co_name == "goahead":
            at = trace.tb_frame.f_locals.get("i", 0)
        trace = trace.tb_next
    return at


def parsed(html: str) -> Lines:
    parser = Lines()
    for end in (False, True):
        while True:
            try:
                parser.close() if end else parser.feed(html)
                break
            except (AssertionError, ValueError, IndexError) as e:  # broken declarations
                html, parser.rawdata = "", parser.rawdata[failed_at(e) + 1 :]
    parser.end_block()
    return parser


def blocks_of(html: str) -> tuple[list[Block], Lines]:
    """The blocks of a page without those in wrappers that hold no main region, and the parser that knows their elements."""
    parser = parsed(html)
    plain = [b for b in parser.blocks if not b.wrapper]
    size = lambda b: max(len(b.text) - b.linked, 0)
    for some in ([b for b in parser.blocks if b.wrapper not in parser.comments], parser.blocks if not plain else []):
        if len(some) > len(plain):
            inner: dict[int, int] = {}
            for b in some:
                if b.wrapper:
                    inner[b.wrapper] = inner.get(b.wrapper, 0) + size(b)
            best = max(inner, key=inner.get)  # the first of equal ones
            if inner[best] > 4 * sum(map(size, plain)):
                around = {0}
                while best:
                    around.add(best)
                    best = parser.outer[best]
                return [b for b in some if b.wrapper in around], parser
    return plain, parser


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut and weighted again."""
    reach = int(3 * sigma) + 1
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    full = np.convolve(ratio, kernel), np.convolve(np.ones(len(ratio)), kernel)
    return full[0][reach : reach + len(ratio)] / full[1][reach : reach + len(ratio)]


def threshold(values: np.ndarray) -> float:
    """Between the centres of two clusters (k-means from the extremes)."""
    low, high = values.min(), values.max()
    for _ in range(30):
        cut = (low + high) / 2
        upper = values >= cut
        if upper.all() or not upper.any():
            break
        now = values[~upper].mean(), values[upper].mean()
        if now == (low, high):
            break
        low, high = now
    return (low + high) / 2


def main_text(html: str | None) -> str:
    """The article's blocks, joined by empty lines."""
    blocks, page = blocks_of(html) if html else ([], None)
    if not blocks:
        return ""
    chars = np.array([len(b.text) - b.linked for b in blocks], float).clip(0)
    wave = smoothed(chars / np.array([max(b.tags, 1) for b in blocks]))
    upper = wave >= threshold(wave)
    region = np.flatnonzero(upper)
    # By element: the regions' text, the blocks and the last number within it; children come after their parents.
    names, parent = page.names, page.parent
    mass, many, last = [0.0] * len(names), [0] * len(names), list(range(len(names)))
    for i in region:
        mass[blocks[i].at] += chars[i]
    for b in blocks:
        many[b.at] += 1
    for k in range(len(names) - 1, 0, -1):
        mass[parent[k]] += mass[k]
        many[parent[k]] += many[k]
        last[parent[k]] = max(last[parent[k]], last[k])
    total = chars[region].sum()
    path, k = [], blocks[int(region[np.argmax(chars[region])])].at
    while k:
        if names[k] in HOLDERS and mass[k] >= 0.8 * total:
            path.append(k)
        k = parent[k]
    path.reverse()  # from the root downwards
    articles = [k for k in path if names[k] in ("article", "main")]
    holder = articles[-1] if articles else None
    while holder is None and path and names[path[-1]] not in ("html", "body"):
        if many[path[-1]] > 1 or len(path) < 2 or names[path[-2]] in ("html", "body"):
            holder = path[-1]
        path.pop()
    stays = [b.weak <= (holder or 0) or bool(up) for b, up in zip(blocks, upper)]  # such a name around the article says nothing
    if holder is not None:
        return "\n\n".join(b.text for b, stay in zip(blocks, stays) if stay and holder <= b.at <= last[holder])
    first, end = int(region[0]), int(region[-1]) + 1
    return "\n\n".join(b.text for b, stay in zip(blocks[first:end], stays[first:end]) if stay and b.linked <= 0.5 * len(b.text))


def extracted(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """key, url, text, n_chars: one row per page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, 128):
            out = [main_text(h) for h in texts(b.column("html"))]
            yield pa.RecordBatch.from_arrays([b.column(key), b.column("url"), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())], [key, "url", "text", "n_chars"])

    kind = pages.schema[key].dataType.simpleString()
    return pages.select(key, F.col("url").cast("string"), F.col("html").cast("string")).mapInArrow(run, f"`{key}` {kind}, url string, text string, n_chars long")


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))
