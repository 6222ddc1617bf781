"""Main text of web pages by smoothed text-to-tag ratios.

One pass of the standard library's streaming parser turns a page into lines,
one per block element, each with its text-to-tag ratio. A Gaussian smooths the
ratios along the page, and the smoothed ratios fall into two clusters around a
threshold.

Lines inside menus, headers, footers, sidebars, notices, adverts, forms and
reader comments count for the ratios but are never content. Some of these are
known by their element; others by a name, as are forms, and names can mislead: an
element that is marked only so is no such part if it holds the article or a main
element, or all of the text or nearly so. The others form
regions: an article with all that is in it, or elsewhere the lines directly in
one container. Regions that reach the upper cluster are the content, whole, so
that short paragraphs next to long ones stay; if none reaches it, the highest.
Inside an article, parts whose name may as well be their subject are regions of
their own, compared by what their own lines give.
A main element always gives the highest region in it.
"""

from __future__ import annotations

import heapq
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that start a line of their own.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu"
    " nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
# Elements whose content is never main text.
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input"
    " label map menu nav noscript object option script select style svg template textarea title"
    " video".split()
)
# Elements whose content is no text at all.
SILENT = frozenset(
    "audio canvas datalist head iframe map object script select style svg template textarea title"
    " video".split()
)
# Words of class, id and role that mark parts beside the main text.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment"
    " comments consent contentinfo cookie cookies disqus dialog discussion feedback footer gdpr"
    " login masthead menu modal nav navbar navigation newsletter notice notices paywall popup"
    " promo promotion related replies responses search share sharing sidebar signup social"
    " sponsor sponsored subscribe toolbar widget".split()
)
#: Of these, what can as well be the subject of a part of an article.
HINTS = frozenset(
    "advertising banner consent cookie cookies dialog discussion feedback footer login menu"
    " navigation notice notices promotion related responses search share sharing social"
    " subscribe toolbar".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Marks of what the whole page can be laid out in.
WRAPPERS = HINTS | {"form", "masthead", "modal", "nav", "navbar", "popup", "sidebar", "signup", "widget"}
#: Marks of lists whose items are articles of their own.
LISTS = frozenset(
    "ad ads advert adverts advertisement comment comments discussion disqus feedback promo promotion related"
    " replies responses sponsor sponsored".split()
)
#: Name parts that only say what form a marked part has.
FORMS = frozenset(
    "area bar block body bottom box button card close container content frame group header holder icon id inline"
    " inner item items left link links list main module outer panel right row section slot space text title top"
    " unit wrap wrapper zone".split()
)
# An element marked by a name is the page's wrapper if its text is so many times
# that of all that is not marked.
NEARLY_ALL = 5
#: Of the marks, what an article element can be.
MARKED_ARTICLE = frozenset("ad advert comment promo related reply sponsored".split())
#: Name parts that only say that something else has such a part.
HAVING = frozenset("has have hide no not off on show with without".split())
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
# Elements that mark a main part; a page has many articles, but one main element.
MAIN = {"article": 1, "main": 2}
# Elements that hold a region of their own.
CONTAINER = frozenset("article div main section td".split())
# Elements that an open <p> does not outlive.
CLOSES_P = BLOCK - {"body", "html"}
SPACE = re.compile(r"\s+")
NAME = re.compile(r"[a-z]+")

RADIUS = 2
KERNEL = [math.exp(-(i * i) / 2) for i in range(RADIUS + 1)]


@dataclass
class _Part:
    """An element that a name, or being a form, marks as none of the main text."""

    parent: int
    words: frozenset[str]
    released: bool = False
    own: int = 0  # characters of its lines, without those of marked parts in it
    inside: int = 0  # with them


class _Lines(HTMLParser):
    """Collects the lines of a page, in time linear in its length."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # Text, tags, region, whether it is skipped, the main part it is in, and the
        # marked part it is in.
        self.lines: list[tuple[str, int, int, bool, int, int]] = []
        # Name, skipped, main part it is in, region of the lines directly inside,
        # whether the text inside is dropped, and the marked part it is in.
        self.open: list[tuple[str, bool, int, int, bool, int]] = []
        # Where elements of each name are open, and which blocks and borders are.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []
        self.borders: list[int] = []
        self.parts = [_Part(0, frozenset(), released=True)]
        self.text: list[str] = []
        self.tags = 0
        self.region = self.regions = 0
        self.hinted: set[int] = set()  # regions that HINTS name
        self.silent = 0  # open elements whose text is dropped
        self.skip, self.main, self.part = False, 0, 0
        self.last_end: int | None = None  # of a tag, once the whole page is known

    # An unfinished tag or comment at the end of the page is no text. The parser
    # would look for its end again from every "<" on.

    def close(self):
        self.last_end = self.rawdata.rfind(">")
        super().close()

    def _or_all(self, start: int, end: int, finished: bool = False) -> int:
        if end < 0 and self.last_end is not None and (finished or self.last_end < start):
            return len(self.rawdata)
        return end

    def parse_starttag(self, i):
        if self.last_end is not None and self.last_end < i:
            return len(self.rawdata)
        return self._or_all(i, super().parse_starttag(i))

    def parse_endtag(self, i):
        return self._or_all(i, super().parse_endtag(i))

    def parse_comment(self, i, report=1):
        return self._or_all(i, super().parse_comment(i, report), finished=True)

    def parse_pi(self, i):
        return self._or_all(i, super().parse_pi(i))

    def parse_html_declaration(self, i):
        try:
            end = super().parse_html_declaration(i)
        except AssertionError:  # a marked section without a name
            end = self.parse_bogus_comment(i)
        return self._or_all(i, end)

    def end_line(self) -> None:
        if self.text:
            text = SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                self.lines.append((text, self.tags, self.region, self.skip, self.main, self.part))
                if not self.skip:
                    self.parts[self.part].own += len(text)
            self.text = []
        self.tags = 0

    def _new_region(self) -> int:
        self.regions += 1
        return self.regions

    def _resume(self) -> None:
        """What is open after an end tag decides again."""
        _, skip, main, region, _, part = self.open[-1] if self.open else ("", False, 0, 0, False, 0)
        self._go_on(skip, main, region, part)

    def _go_on(self, skip: bool, main: int, region: int, part: int) -> None:
        if (skip, main, region, part) != (self.skip, self.main, self.region, self.part):
            self.end_line()
            self.skip, self.main, self.region, self.part = skip, main, region, part

    def _is_skipped(self, tag: str, attrs: list[tuple[str, str | None]]) -> tuple[bool, bool, set[str]]:
        """Whether an element is skipped for sure, whether there is a hint that it
        may be, and the marks that say so if it holds nothing else."""
        if tag in SKIPPED and tag != "form":
            return True, False, set()
        if tag == "header":  # of the page; one inside an article holds its title
            return not self.main, False, set()
        if tag in ("html", "body", "main"):
            return False, False, set()
        hinted = False
        marks = {"form"} if tag == "form" else set()
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                if name == "id" and tag in HEADINGS:  # the anchor of its words
                    continue
                for word in value.lower().split():
                    if not _is_mark(word, tag):
                        continue
                    if name == "role":
                        return True, False, set()
                    if not self.main or tag in MAIN or not _is_hint(word):
                        marks |= MARKS.intersection(NAME.findall(word))
                    else:
                        hinted = True
            elif name in ("hidden", "aria-modal") or name == "style" and value and HIDDEN.search(value):
                return True, False, set()
        return False, hinted, marks

    def _release(self, tag: str) -> None:
        """What holds an article or a main element is no marked part."""
        part = self.parts[self.part]
        while not part.released and (tag == "main" or part.words.isdisjoint(LISTS)):
            part.released = True
            part = self.parts[part.parent]

    def handle_starttag(self, tag, attrs):
        if tag in CLOSES_P:
            self._close_p()
        if tag in BLOCK or tag == "br":
            # A line break is white space inside its line.
            if tag == "br":
                self.text.append(" ")
            else:
                self.end_line()
        self.tags += 1
        if tag in VOID:
            return
        skipped, hinted, marks = self._is_skipped(tag, attrs)
        # An inline part that is skipped leaves the line around it whole.
        silent = tag in SILENT or (skipped or bool(marks)) and tag not in BLOCK
        self.silent += silent
        skip = self.skip or skipped and not silent
        part = self.part
        if marks and not silent and not skip:
            self.parts.append(_Part(part, frozenset(marks)))
            part = len(self.parts) - 1
        elif tag in MAIN and not skip:
            self._release(tag)
        main = max(self.main, MAIN.get(tag, 0))
        region = self.region
        # An inline part with a hint belongs to its line.
        hinted = hinted and tag in BLOCK
        own = hinted or tag == "article" or tag in CONTAINER and not self.main
        if own and not skip and self.region not in self.hinted:
            region = self._new_region()
            if hinted:
                self.hinted.add(region)
        place = len(self.open)
        self.open.append((tag, skip, main, region, silent, part))
        self.places.setdefault(tag, []).append(place)
        if tag in BLOCK:
            self.blocks.append(place)
        if tag in BLOCK or tag in SKIPPED:
            self.borders.append(place)
        self._go_on(skip, main, region, part)

    def handle_startendtag(self, tag, attrs):
        # HTML ignores the slash.
        self.handle_starttag(tag, attrs)

    def _close_p(self) -> None:
        """An open paragraph ends at the next block, even when inline elements
        inside it were left open."""
        if self.borders and self.open[self.borders[-1]][0] == "p":
            self.end_line()
            self._drop(self.borders[-1])

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.end_line()
        places = self.places.get(tag)
        if not places:
            return
        # An inline end tag does not reach out of its block.
        inline = tag not in BLOCK and tag not in SKIPPED
        if not inline or not self.blocks or self.blocks[-1] < places[-1]:
            self._drop(places[-1])

    def _drop(self, i: int) -> None:
        for place in range(len(self.open) - 1, i - 1, -1):
            tag, *_, silent, _ = self.open[place]
            self.silent -= silent
            self.places[tag].pop()
            for kind in (self.blocks, self.borders):
                if kind and kind[-1] == place:
                    kind.pop()
        del self.open[i:]
        self._resume()

    def handle_data(self, data):
        if not self.silent:
            self.text.append(data)

    def unmarked(self) -> list[int]:
        """The lines that may be content."""
        parts = self.parts
        inner: list[list[int]] = [[] for _ in parts]
        for i in range(len(parts) - 1, 0, -1):
            parts[i].inside += parts[i].own
            parts[parts[i].parent].inside += parts[i].inside
            inner[parts[i].parent].append(i)
        shown = 0
        heap: list[tuple[int, int]] = []
        todo = [0]
        while todo or heap:
            # What is not in a marked part, or in one that is released.
            while todo:
                i = todo.pop()
                shown += parts[i].own
                for j in inner[i]:
                    if parts[j].released:
                        todo.append(j)
                    else:
                        heapq.heappush(heap, (-parts[j].inside, j))
            if not heap:
                break
            size, i = heapq.heappop(heap)
            if not size:
                break
            if not shown or -size > NEARLY_ALL * shown and not parts[i].words.isdisjoint(WRAPPERS):
                parts[i].released = True
                todo.append(i)
        kept = [True] * len(parts)
        for i in range(1, len(parts)):
            kept[i] = parts[i].released and kept[parts[i].parent]
        return [i for i, line in enumerate(self.lines) if not line[3] and kept[line[5]]]


def _is_mark(word: str, tag: str) -> bool:
    parts = NAME.findall(word)
    if tag in MAIN:
        return word in MARKED_ARTICLE
    return bool(parts) and HAVING.isdisjoint(parts) and not MARKS.isdisjoint((parts[0], parts[-1]))


def _is_hint(word: str) -> bool:
    """Whether a mark has one meaning among others, or is only part of a name that
    has a subject of its own; two marks in a name have none."""
    parts = NAME.findall(word)
    marks = MARKS.intersection((parts[0], parts[-1]))
    subject = set(parts) - MARKS - FORMS
    return len(marks) == 1 and (marks <= HINTS or bool(subject))


def smoothed(ratios: list[float]) -> list[float]:
    """Gaussian weighted means; the weights are those of the lines there are."""
    out = []
    for i in range(len(ratios)):
        total = weight = 0.0
        for j in range(max(0, i - RADIUS), min(len(ratios), i + RADIUS + 1)):
            k = KERNEL[abs(i - j)]
            total += k * ratios[j]
            weight += k
        out.append(total / weight)
    return out


def threshold(values: list[float]) -> float:
    """Border between two clusters (two means, from the extremes on)."""
    low, high = min(values), max(values)
    while True:
        border = (low + high) / 2
        below = [v for v in values if v < border]
        above = [v for v in values if v >= border]
        if not below:
            return border
        moved = (sum(below) / len(below), sum(above) / len(above))
        if moved == (low, high) or moved[0] >= moved[1]:
            return border
        low, high = moved


def main_text(html: str | None) -> str:
    """The blocks of the main text, joined by two line feeds; empty if none.

    Inside a block white space becomes one space.
    """
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.end_line()
    lines = parser.lines
    kept = parser.unmarked()
    if not kept:
        return ""
    ratios = [len(line[0]) / max(1, line[1]) for line in lines]
    smooth = smoothed(ratios)
    highest: dict[int, float] = {}
    for i in kept:
        region = lines[i][2]
        highest[region] = max(highest.get(region, 0.0), smooth[i])
    # Long lines around a hinted region say nothing of it.
    for region in parser.hinted & highest.keys():
        highest[region] = max(smoothed([ratios[i] for i in kept if lines[i][2] == region]))
    border = threshold(smooth)
    inside = {lines[i][2] for i in kept if lines[i][4] == MAIN["main"]}
    # Without a region above the border, the highest one counts.
    least = min(border, max(highest[region] for region in inside or highest))
    content = {r for r, top in highest.items() if top >= (least if r in inside or not inside else border)}
    return "\n\n".join(lines[i][0] for i in kept if lines[i][2] in content)


def extract_main_text(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of ``pages``.

    A null or empty html gives an empty text. Null ids and urls are kept,
    repeated rows give repeated results, other columns are ignored, and an
    empty table gives no rows. A page is held whole by one task, in time linear in
    its length. An unfinished tag or comment at the end of a page is no text.
    """
    schema = T.StructType(
        [
            pages.schema["page_id"],
            pages.schema["url"],
            T.StructField("text", T.StringType()),
            T.StructField("n_chars", T.LongType()),
        ]
    )

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html.as_py()) for html in batch.column("html")]
            lengths = pa.array(map(len, texts), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), lengths],
                ["page_id", "url", "text", "n_chars"],
            )

    return pages.select("page_id", "url", "html").mapInArrow(extract, schema)
