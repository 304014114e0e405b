"""Main text of web pages by text-to-tag ratios.

Standard-library parser events give the page's lines (blocks of text), each with
its characters and the tags met since the line before. The ratios of the lines
are smoothed with a Gaussian over their neighbours and split in two clusters by a
threshold; regions of the page that reach the upper cluster are its content.
Regions are the page's sections, so that a short line inside the article stays;
a marked article is one region, and where one reaches the upper cluster the articles of
its size are the content, without the cards beside them. Smoothing stays within a
region, so that a long paragraph does not lift the menu beside it. What a page marks as
navigation, advert, form or comment is no candidate, nor are articles within an article,
which are its comments. Where only a name says so, no other article is on the page, and
the element holds one article or most of the text, its lines are candidates with a lower
ratio.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame

from prefshare.functions.flags import quoted
from prefshare.llm.common import rechunked, text_column

# Elements by their role in the HTML standard.
VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
NEVER_SHOWN = frozenset(
    "head title script style noscript template svg math iframe object canvas audio "
    "video select datalist textarea button".split()
)
# What can be in a head; anything else closes it.
IN_HEAD = frozenset(
    "base basefont bgsound head html link meta noframes noscript script style template "
    "title".split()
)
BOILERPLATE = frozenset("nav header footer aside form menu dialog".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr "
    "ul".split()
)
SECTIONS = frozenset("article main section div body td".split())
# Blocks that another block closes where their end tag is left out.
OPEN_ENDED = frozenset("p li dt dd h1 h2 h3 h4 h5 h6".split())
# Words in class, id and role that name what is not content.
HINTS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer gdpr header masthead "
    "menu modal nav navbar navigation newsletter notice popup promo promoted promotion "
    "related reply replies share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget".split()
)
# Words that name what readers wrote, and words that make them a setting of the page.
COMMENTS = frozenset("comment comments commentlist reply replies disqus".split())
SETTINGS = frozenset("open closed on off enabled disabled allowed".split())
# An article of less than this share of the longest one's text is a card beside it.
CARD = 0.25
SMOOTH = 2.0
# The weight of a ratio within an element that a hint speaks against.
HINTED = 0.5
CHUNK_BYTES = 2 << 20


@dataclass
class Line:
    """One block of text: its section and its text-to-tag ratio."""

    text: str
    section: int
    ratio: float
    heading: bool = False


@dataclass
class Hinted:
    """An element that a hint names, or an article within an article: the one around it
    (0: none), the article around it if it is within one, whether it is named as comments,
    and what it holds."""

    above: int
    within: int | None = None
    comments: bool = False
    chars: int = 0
    articles: int = 0
    mains: int = 0


class _Lines(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Open elements: (tag, hidden, section number, innermost hinted element).
        self.open: list[tuple[str, bool, int, int]] = []
        # Element 0 stands for the page.
        self.hinted = [Hinted(0)]
        self.sections = 0
        self.article = 0
        # Sections that are an article, and those that are a main element, with the
        # hinted element they stand in.
        self.articles: dict[int, int] = {}
        self.mains: dict[int, int] = {}
        # Blocks with section, tags before and whether they are a first heading; their
        # parts with hinted elements.
        self.blocks: list[tuple[list[tuple[str, int]], int, int, bool]] = []
        self.parts: list[tuple[str, int]] = []
        self.tags = 0

    def _flush(self) -> None:
        if self.parts:
            section = self.open[-1][2] if self.open else 0
            heading = bool(self.open) and self.open[-1][0] == "h1"
            self.blocks.append((self.parts, section, self.tags, heading))
            self.parts, self.tags = [], 0

    def _shown(self) -> list[bool]:
        """Which hinted elements are candidates, once it is known what they hold."""
        own: dict[tuple[int, int], int] = {}
        for parts, section, _, _ in self.blocks:
            for data, hint in parts:
                chars = len("".join(data.split()))
                self.hinted[hint].chars += chars
                own[section, hint] = own.get((section, hint), 0) + chars
        nested: dict[int, int] = {}
        for one in self.hinted[:0:-1]:
            above = self.hinted[one.above]
            above.chars += one.chars
            above.articles += one.articles
            above.mains += one.mains
            if one.within is not None:
                nested[one.within] = nested.get(one.within, 0) + 1
        total = self.hinted[0].chars
        # Text of the elements that mark content and that no hint speaks against.
        plain = any(not hint and own.get((s, 0)) for s, hint in self.articles.items())
        marked = sum(own.get((s, 0), 0) for s in (*self.articles, *self.mains))
        shown = [True]
        for one in self.hinted[1:]:
            if one.within is not None:
                # The only article in an article without text is the article itself.
                around = own.get((one.within, self.articles[one.within]), 0)
                holds = nested[one.within] == 1 and around < CARD * one.chars
                holds &= not one.comments
            else:
                marks = one.articles or one.mains
                holds = marks == 1 or not marks and 2 * one.chars > total
                holds &= not (one.comments or plain) and marked < one.chars
            shown.append(holds and shown[one.above])
        if total and not any(
            shown[hint] and data.strip() for parts, *_ in self.blocks for data, hint in parts
        ):
            # Nothing is left: names are wrong about an element that holds most.
            shown = [True]
            for one in self.hinted[1:]:
                holds = one.articles or one.mains or 2 * one.chars > total
                shown.append(bool(holds) and shown[one.above])
        return shown

    def _settle(self) -> None:
        """The lines, without those of hinted elements that are no candidates."""
        shown = self._shown()
        tags = 0
        for parts, section, more, heading in self.blocks:
            tags += more
            parts = [(data, hint) for data, hint in parts if shown[hint]]
            text = " ".join("".join(data for data, _ in parts).split())
            if text:
                hinted = any(hint and data.strip() for data, hint in parts)
                ratio = len(text) / max(1, tags) * (HINTED if hinted else 1)
                self.lines.append(Line(text, section, ratio, heading))
                tags = 0

    def _hidden(self, tag: str, attrs: list[tuple[str, str | None]]) -> bool:
        # The heading of an article is part of it.
        if tag in NEVER_SHOWN or tag in BOILERPLATE and not (
            tag == "header" and self.article
        ):
            return True
        for name, value in attrs:
            if name == "hidden" or name == "aria-hidden" and value == "true":
                return True
        return False

    def _hint(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool]:
        """Whether a name of the element speaks against it, and whether it names comments."""
        found = comments = False
        if tag in ("html", "body", "main"):
            return found, comments
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for token in value.lower().split():
                    words = [w for w in re.split("[^a-z]+", token) if w]
                    hinted = not HINTS.isdisjoint(words)
                    found |= hinted
                    comments |= bool(words) and words[0] in COMMENTS and SETTINGS.isdisjoint(words)
        return found or comments, comments

    def _close_head(self, tag: str) -> None:
        """The end tag of a head may be left out."""
        if tag == "body":
            for at in range(min(3, len(self.open))):
                if self.open[at][0] == "head":
                    self._pop(at)
                    return
        elif self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._pop(len(self.open) - 1)

    def handle_starttag(self, tag, attrs):
        self._close_head(tag)
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
            if self.open and self.open[-1][0] in OPEN_ENDED and (
                self.open[-1][0] == tag or self.open[-1][0] not in ("li", "dd", "dt")
            ):
                self._pop(len(self.open) - 1)
        elif tag == "br":
            self.parts.append((" ", 0))
        if tag in VOID:
            return
        above = self.open[-1] if self.open else ("", False, 0, 0)
        section, hint = above[2], above[3]
        hidden = above[1] or self._hidden(tag, attrs)
        named, comments = self._hint(tag, attrs)
        within = section if tag == "article" and section in self.articles else None
        if not hidden and (named or within is not None):
            self.hinted.append(Hinted(hint, within, comments))
            hint = len(self.hinted) - 1
        if tag == "article" or tag in SECTIONS and not (
            section in self.articles or section in self.mains
        ):
            self.sections += 1
            section = self.sections
            if tag == "article":
                self.articles[section] = hint
            elif tag == "main":
                self.mains[section] = hint
        self.article += tag == "article"
        if not hidden and within is None:
            self.hinted[hint].articles += tag == "article"
            self.hinted[hint].mains += tag == "main"
        if tag in BLOCKS or (hidden, hint) != (above[1], above[3]) or above[0] == "head":
            self.open.append((tag, hidden, section, hint))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _pop(self, at: int) -> None:
        self.article -= sum(tag == "article" for tag, *_ in self.open[at:])
        del self.open[at:]

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCKS:
            self._flush()
        for at in range(len(self.open) - 1, -1, -1):
            if self.open[at][0] == tag:
                self._pop(at)
                return
            # An end tag does not reach out of the section it stands in.
            if self.open[at][0] in SECTIONS and tag not in BLOCKS:
                return

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and data.strip():
            self._close_head("")
        if not self.open:
            self.parts.append((data, 0))
        elif not self.open[-1][1]:
            self.parts.append((data, self.open[-1][3]))

    def close(self):
        super().close()
        self._flush()
        self._settle()


def smoothed(values: list[float], sigma: float = SMOOTH) -> list[float]:
    """Gaussian means over neighbours; weights beyond three sigma are left out."""
    reach = math.ceil(3 * sigma)
    kernel = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(reach + 1)]
    out = []
    for i in range(len(values)):
        total = weight = 0.0
        for j in range(max(0, i - reach), min(len(values), i + reach + 1)):
            k = kernel[abs(i - j)]
            total += k * values[j]
            weight += k
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """The border between two clusters of values (two means in one dimension)."""
    low, high = min(values), max(values)
    for _ in range(20):
        border = (low + high) / 2
        under = [v for v in values if v < border]
        over = [v for v in values if v >= border]
        if not under or not over:
            break
        means = sum(under) / len(under), sum(over) / len(over)
        if means == (low, high):
            break
        low, high = means
    return (low + high) / 2


def main_text(html: str) -> str:
    """The content blocks of a page in page order, joined by a line feed."""
    page = _Lines()
    page.feed(html)
    page.close()
    if not page.lines:
        return ""
    regions: dict[int, list[float]] = {}
    for line in page.lines:
        regions.setdefault(line.section, []).append(line.ratio)
    regions = {section: smoothed(ratios) for section, ratios in regions.items()}
    border = threshold([v for values in regions.values() for v in values])
    content = {section for section, values in regions.items() if max(values) >= border}
    chars = dict.fromkeys(regions, 0)
    for line in page.lines:
        chars[line.section] += len(line.text)
    articles = {s for s in regions if s in page.articles and (not page.articles[s] or s in content)}
    mains = {s for s in regions if s in page.mains and (not page.mains[s] or s in content)}
    if content & (articles | mains):
        around = max((chars[s] for s in mains), default=0)
        longest = max((chars[s] for s in articles), default=0)
        if not content & articles or around > longest:
            content = articles | mains if around <= longest else {
                s for s in articles | mains if s in mains or chars[s] >= CARD * around
            }
        else:
            content = {s for s in articles if chars[s] >= CARD * longest}
    else:
        mains = set()
    return "\n".join(
        line.text
        for line in page.lines
        if line.section in content or line.heading and line.section in mains
    )


def extract_text(
    pages: DataFrame, page: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Per page: page_id, url, text, n_chars.

    A page that is null, empty or without content has an empty text. page_id and
    url may be null or repeat and are passed on; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rechunked(batches, "_html", CHUNK_BYTES):
            texts = [main_text(t) for t in text_column(batch, "_html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(batch.schema.get_field_index("page_id")),
                    batch.column(batch.schema.get_field_index("url")),
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(
        quoted(page).cast("bigint").alias("page_id"),
        quoted(url).cast("string").alias("url"),
        quoted(html).alias("_html"),
    )
    return rows.mapInArrow(
        run, "page_id bigint, url string, text string, n_chars bigint"
    )
