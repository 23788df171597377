"""Main text of web pages by text-to-tag ratio, smoothed and clustered.

The standard library's parser streams events. They build blocks: texts between
block-level tags, white space turned into one space, character references decoded.
Scripts, styles, menus, headers, footers, sidebars, notices, adverts, forms and
reader comments are set aside by tag, role or name; not so an element with a name,
or a form, that is wrapped around an article or main region. A name counts as a whole, by its
first or by its last part, but not as a state ("has-sidebar", "comments-open"). Headings and
paragraphs inside an article are its text: their ids, being anchors, set nothing aside, and
their classes only if they name as a whole what others have put there. Each block has a text-to-tag
ratio (characters outside links, per tag); the ratios are smoothed with a Gaussian over
neighbouring blocks. Blocks that share an article (or, where there is none, a
section) form a region, and a threshold between the two clusters of the regions'
ratios separates content from the rest. All blocks of a content region are kept, in
page order, each a line of the result.

Null and empty pages give empty text. Nothing is capped; a page without any tags is
one block. Unclosed and misnested tags are closed where HTML would close them, and a
tag that never ends is text. Equal rows give equal results; other columns are not read.
Time grows with the length of a page, however deep its tags are nested.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGMA = 1.0

# Element names of HTML by how they lay out text.
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img br".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_ASIDE = frozenset(
    "script style noscript template head title nav header footer aside button select textarea input option "
    "fieldset iframe object svg canvas audio video dialog menu map".split()
)
_MAIN = frozenset(["article", "main"])
_SECTION = frozenset("section div td body blockquote".split())
_CLOSED_BY_BLOCK = frozenset(["p"])
_CLOSED_BY_SAME = frozenset("li dt dd tr td th option p".split())
_ASIDE_ROLES = frozenset(
    "navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split()
)
_ASIDE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe signup login sidebar aside widget menu nav navbar "
    "navigation breadcrumb breadcrumbs header masthead footer comment comments respond reply replies disqus share "
    "sharing social related recommended pagination pager toolbar search form".split()
)
_TEXTS = frozenset("h1 h2 h3 h4 h5 h6 p".split())
#: Classes by which a paragraph of an article is no part of it.
_OTHERS_NAMES = frozenset(
    "ad ads adv advert adverts advertisement sponsor sponsored promo promotion cookie cookies consent gdpr "
    "newsletter subscribe signup comment comments reply replies share sharing".split()
)
_LISTS = ("ul", "ol", "table", "dl")
#: First and last parts of names that tell a state of the page or an element, not what it is.
_STATE_FIRST = frozenset("has no with without is".split())
_STATE_LAST = frozenset("open opened closed enabled disabled allowed active".split())
#: What a form holds only if it is wrapped around a page.
_IN_PAGES = frozenset("article main header footer nav h1".split())
_PART = re.compile(r"[^a-z0-9]+")
_SPACE = re.compile(r"\s+")


class _Blocks(HTMLParser):
    """Blocks of a page: (text, tags, characters in links, region, set aside)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, int, int | None]] = []  # tag, whether set aside, region it begins
        self.places: defaultdict[str, list[int]] = defaultdict(list)  # of each tag in ``open``, ascending
        self.blocks: list[tuple[str, int, int, int, int]] = []
        # Elements set aside by name or as forms: (the one around it, tag), and which are wrappers after all.
        self.named: list[tuple[int, str]] = [(0, "")]
        self.wrappers: set[int] = set()
        self.around_main: set[int] = set()  # those of them whose outer ones are wrappers as well
        self.inside = [0]
        self.regions = 1
        self.text: list[str] = []
        self.tags = self.linked = self.asides = self.links = 0
        self.sections, self.mains = [0], []

    def _end_block(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        if text:
            region = self.mains[-1] if self.mains else self.sections[-1]
            self.blocks.append((text, self.tags + 1, self.linked, region, -1 if self.asides else self.inside[-1]))
        self.text, self.tags, self.linked = [], 0, 0

    def _pop_to(self, at: int) -> None:
        for tag, aside, region in reversed(self.open[at:]):
            self.places[tag].pop()
            self.asides -= aside == _WHOLLY
            if aside == _UNLESS_WRAPPED:
                self.inside.pop()
            self.links -= tag == "a"
            if region is not None:
                (self.mains if tag in _MAIN else self.sections).pop()
        del self.open[at:]

    def _last(self, tag: str) -> int:
        places = self.places.get(tag)
        return places[-1] if places else -1

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag not in _INLINE:
            self._end_block()
            for closed in (*_CLOSED_BY_BLOCK, *([tag] if tag in _CLOSED_BY_SAME else [])):
                at = self._last(closed)
                nested = closed != "p" and any(self._last(around) > at for around in _LISTS)
                if at >= 0 and not nested:
                    self._pop_to(at)
        elif tag == "br":
            self.text.append(" ")
        self.tags += 1
        if tag in _VOID:
            return
        region = None
        if tag in _MAIN or tag in _SECTION:
            region = self.regions
            self.regions += 1
            (self.mains if tag in _MAIN else self.sections).append(region)
        aside = _set_aside(tag, attrs, bool(self.mains))
        self._unwrap(tag, attrs)
        self.asides += aside == _WHOLLY
        if aside == _UNLESS_WRAPPED:
            self.named.append((self.inside[-1], tag))
            self.inside.append(len(self.named) - 1)
        self.links += tag == "a"
        self.places[tag].append(len(self.open))
        self.open.append((tag, aside, region))

    def _unwrap(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        """Elements set aside by name or as forms that the new one shows to be wrappers."""
        if self.asides or len(self.inside) == 1:
            return
        if tag in _MAIN:
            # Comments are often articles within an article, or named for what they are.
            named = any(name in ("class", "id") and value and _named_aside(value) for name, value in attrs)
            if self._last("article") < 0 and not named:
                for at in range(len(self.inside) - 1, 0, -1):
                    number = self.inside[at]
                    if number in self.around_main:
                        break
                    self.around_main.add(number)
                    self.wrappers.add(number)
        elif tag in _IN_PAGES and self.named[self.inside[-1]][1] == "form":
            self.wrappers.add(self.inside[-1])

    def set_aside(self) -> list[bool]:
        """Whether each block is set aside, known when all elements are closed."""
        aside = [False]
        for number, (around, _) in enumerate(self.named[1:], 1):
            aside.append(number not in self.wrappers or aside[around])
        return [inside < 0 or aside[inside] for *_, inside in self.blocks]

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in _VOID and self.open and self.open[-1][0] == tag:
            self._pop_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag not in _INLINE:
            self._end_block()
        at = self._last(tag)
        if at >= 0:
            self._pop_to(at)

    def handle_data(self, data: str) -> None:
        self.text.append(data)
        if self.links:
            self.linked += len(data)

    def close(self) -> None:
        # No tag ends after the last ">". The parser would look for an end from each "<" there.
        rest = ""
        if self.cdata_elem is None:
            cut = self.rawdata.rfind(">") + 1
            self.rawdata, rest = self.rawdata[:cut], self.rawdata[cut:]
        super().close()
        if rest:
            self.handle_data(unescape(rest))
        self._end_block()


_NOT, _UNLESS_WRAPPED, _WHOLLY = range(3)


def _named_aside(value: str) -> bool:
    """Whether a name of a class or id stands for what is set aside."""
    for name in value.lower().split():
        parts = [part for part in _PART.split(name) if part]
        if parts and parts[0] not in _STATE_FIRST and parts[-1] not in _STATE_LAST:
            if parts[0] in _ASIDE_NAMES or parts[-1] in _ASIDE_NAMES:
                return True
    return False


def _set_aside(tag: str, attrs: list[tuple[str, str | None]], in_main: bool) -> int:
    if tag in _ASIDE:
        return _WHOLLY
    if tag in _MAIN or tag in ("html", "body"):
        return _NOT
    found = _UNLESS_WRAPPED if tag == "form" else _NOT
    for name, value in attrs:
        if not value:
            if name == "hidden":
                return _WHOLLY
        elif name == "role" and value.strip().lower() in _ASIDE_ROLES:
            return _WHOLLY
        elif name in ("class", "id"):
            if in_main and tag in _TEXTS:
                aside = name == "class" and not _OTHERS_NAMES.isdisjoint(value.lower().split())
            else:
                aside = _named_aside(value)
            found = _UNLESS_WRAPPED if aside else found
        elif name == "hidden" or (name == "aria-hidden" and value.lower() == "true"):
            return _WHOLLY
    return found


def _smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    reach = int(np.ceil(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratios)), kernel)[reach:-reach]
    return np.convolve(ratios, kernel)[reach:-reach] / weight


def _threshold(values: np.ndarray) -> float:
    """Between the two clusters of the values (least squares), or below all if they are alike."""
    ordered = np.sort(values)
    if len(ordered) < 2 or ordered[0] * 3 >= ordered[-1]:
        return ordered[0]
    total, best, cut = np.cumsum(ordered), -1.0, ordered[0]
    for i in range(1, len(ordered)):
        low, high = total[i - 1] / i, (total[-1] - total[i - 1]) / (len(ordered) - i)
        between = i * (len(ordered) - i) * (high - low) ** 2
        if between > best:
            best, cut = between, ordered[i]
    return cut


def main_text(html: str | None) -> str:
    if not html:
        return ""
    page = _Blocks()
    page.feed(html)
    page.close()
    blocks = [(*block[:4], aside) for block, aside in zip(page.blocks, page.set_aside(), strict=True)]
    if not blocks:
        return ""
    ratios = np.array([0.0 if aside else (len(text) - min(linked, len(text))) / tags for text, tags, linked, _, aside in blocks])
    smooth = _smoothed(np.log1p(ratios))
    best: dict[int, float] = {}
    for (_, _, _, region, aside), value in zip(blocks, smooth, strict=True):
        if not aside:
            best[region] = max(best.get(region, 0.0), float(value))
    if not best:
        return ""
    least = _threshold(np.array(list(best.values())))
    return "\n".join(text for text, _, _, region, aside in blocks if not aside and best[region] >= least)


def extracted(html: Column) -> Column:
    """The main text of a column of pages."""

    @F.arrow_udf("string")
    def extract(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for pages in batches:
            yield pa.array([main_text(page.as_py()) for page in pages], pa.string())

    return extract(html)


def pages_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every page."""
    found = pages.select("page_id", "url", extracted(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.char_length("text").cast("bigint"))
