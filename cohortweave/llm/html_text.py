"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one per block element; the text lengths of a sliding window of lines give a
distribution along the page. The text surges where a window reaches the page's own threshold and
dives where the windows fall silent again; lines between the surge and the dive are kept. Lines of an article or
main element weigh more, and a run that reaches such an element holds all its lines. Lines that are mostly links
weigh nothing outside, but stay where a run holds them. Parts whose markup states that they are no article (menus,
footers, forms, notices, comments) count as silent lines, so they end a run as any gap does; they are never kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortweave.llm.blocks import bounded_batches, byte_pieces

WINDOW = 3  # lines in a window
LINK_SHARE = 0.5  # the text of a line with more of it in links has no weight

# Elements of the HTML standard by their part in a page.
UNSEEN = frozenset("script style noscript template svg math iframe object canvas head title select option datalist textarea button audio video map".split())
APART = frozenset("nav header footer aside form menu dialog fieldset figure".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul".split()
)
# Names in class, id and role of a part apart from the article: made of these words only, as in "site-footer" and "cookie_notice".
APART_NAME = re.compile(
    r"(?:(?:site|global)[_-])?(?:(?:ad|ads|adv|advert|adverts|advertisement|banner|breadcrumbs?|comment|comments|commentlist|consent|contentinfo|cookies?|copyright|disqus|"
    r"footer|gdpr|header|legal|login|menu|modal|nav|navbar|navigation|newsletter|notice|pagination|popup|promo|related|replies|respond|"
    r"search|share|sharing|sidebar|signup|social|sponsor|sponsored|subscribe|toolbar|widget|complementary|hidden)s?(?:[_-](?!$)|$))+",
    re.I,
)
SPACE = re.compile(r"\s+")
CUT_TAG = re.compile(r"<(?:[/!?]?[a-zA-Z][^>]*|[/!?])")  # markup that ends with the page


SUBSET = re.compile(r"\s*(?:<\?xml[^>]*>\s*)?<!doctype[^>\[]*\[[^\]]*\]\s*>", re.I)  # a doctype with declarations of its own


class _Lines(HTMLParser):
    """Lines of a page: (text, characters inside links, silent, inside a main element).

    What a text's place depends on is counted as elements open and close, so that a page's nesting costs nothing.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, bool, bool]] = []
        self.stack: list[tuple[str, bool]] = []  # tag, apart
        self.open: Counter[str] = Counter()
        self.apart = self.unseen = self.main = self.linked = 0
        self.spans_apart = 0  # inline elements apart, whose text is not part of the line around them
        self.text: list[str] = []

    def parse_marked_section(self, i: int, report: int = 1) -> int:
        try:
            return super().parse_marked_section(i, report)
        except AssertionError:  # of no known kind: a comment up to the next ">"
            return self.parse_bogus_comment(i)

    def _flush(self) -> None:
        text = SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            self.lines.append((text, self.linked, self.apart > 0, self.main > 0))
        self.text, self.linked = [], 0

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in CLOSES_P and self.open["p"]:
            self._close("p")
        if tag == "li" and self.stack and self.stack[-1][0] == "li":
            self._close("li")
        if tag not in INLINE:
            self._flush()
        if tag in VOID:
            return
        named = {k: v or "" for k, v in attrs}
        inside = self.main > 0
        apart = tag in APART and not (inside and tag in ("header", "figure", "footer"))
        apart = apart or "hidden" in named or named.get("aria-hidden") == "true"
        if tag not in ("html", "body", *MAIN):
            apart = apart or any(APART_NAME.fullmatch(x) for k in ("class", "id", "role") for x in named.get(k, "").split())
        if inside and tag in ("header", "footer"):
            apart = tag == "footer" or apart
        self.stack.append((tag, apart))
        self._count(tag, apart, 1)

    def _count(self, tag: str, apart: bool, by: int) -> None:
        self.open[tag] += by
        self.apart += by * apart
        self.spans_apart += by * (apart and tag in INLINE)
        self.unseen += by * (tag in UNSEEN)
        self.main += by * (tag in MAIN)

    def _close(self, tag: str) -> None:
        if not self.open[tag]:
            return
        i = len(self.stack) - 1
        while self.stack[i][0] != tag:
            i -= 1
        if tag not in INLINE or any(x[0] not in INLINE for x in self.stack[i:]):
            self._flush()
        for name, apart in self.stack[i:]:
            self._count(name, apart, -1)
        del self.stack[i:]

    def handle_endtag(self, tag: str) -> None:
        # An inline end tag does not reach outside its block.
        if tag in INLINE and self.open[tag]:
            for name, _ in reversed(self.stack):
                if name == tag:
                    break
                if name not in INLINE:
                    return
        self._close(tag)

    def handle_data(self, data: str) -> None:
        if self.unseen or self.spans_apart:
            return
        self.text.append(data)
        if self.open["a"]:
            self.linked += len(data)


def page_lines(page: str) -> list[tuple[str, int, bool, bool]]:
    """Lines of a page in order; unclosed elements and comments end with the page."""
    parser = _Lines()
    subset = SUBSET.match(page)
    page = page[subset.end() :] if subset else page
    last = page.rfind("<")
    if last >= 0 and CUT_TAG.fullmatch(page, last):
        page = page[:last]
    parser.feed(page)
    if parser.rawdata.startswith("<!--"):
        parser.rawdata = ""
    parser.close()
    parser._flush()
    return parser.lines


def main_text(page: str | None, window: int = WINDOW) -> str:
    """Lines between the surges and dives of the page's text, joined by newlines."""
    lines = page_lines(page or "")
    weights = []
    for text, linked, apart, main in lines:
        spoken = 0 if min(linked, len(text)) > LINK_SHARE * len(text) else len(text)
        weights.append(0 if apart else spoken + main * len(text))
    n = len(weights)
    sums = [sum(weights[max(0, i - window // 2) : i + window - window // 2]) for i in range(n)]
    threshold = max(1, sum(sums) // (4 * max(1, n)))
    blocks = [sum(weights[i : i + window]) for i in range(n)]
    keep = [False] * n
    i = 0
    while i < n:
        # Surge: a speaking line whose window reaches the threshold and is not alone below it.
        if weights[i] and blocks[i] >= threshold:
            start = end = i
            silent = 0
            while start and lines[start - 1][3]:  # short lines that open a main element
                start -= 1
            while end < n and silent < window:  # dive: a whole window of silent lines
                silent = 0 if weights[end] or lines[end][3] else silent + 1
                end += 1
            for j in range(start, end - silent):
                keep[j] = not lines[j][2]
            i = end
        else:
            i += 1
    return "\n".join(text for (text, _, _, _), k in zip(lines, keep) if k)


def extract(pages: DataFrame, key: str = "page_id", markup: str = "html", carry: tuple[str, ...] = ("url",)) -> DataFrame:
    """Per row of ``pages``: ``key``, the columns ``carry``, ``text`` and ``n_chars`` (code points).

    A NULL, empty or unparsable page gives an empty text. Pages are read one by one and whole;
    repeated rows and NULL keys stay.
    """
    bounded_batches(pages.sparkSession)
    names = [f"c{i}" for i in range(len(carry))]
    kinds = [pages.schema[c].dataType.simpleString() for c in (key, *carry)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in byte_pieces(batches, "markup"):
            texts = [main_text(x) for x in piece.column("markup").to_pylist()]
            columns = [piece.column(c) for c in ("key", *names)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())], names=["key", *names, "text", "n_chars"])

    rows = pages.select(F.col(key).alias("key"), *[F.col(c).alias(n) for c, n in zip(carry, names)], F.col(markup).cast("string").alias("markup"))
    fields = ", ".join(f"{n} {k}" for n, k in zip(("key", *names), kinds))
    out = rows.mapInArrow(run, f"{fields}, text string, n_chars long")
    return out.toDF(key, *carry, "text", "n_chars")
