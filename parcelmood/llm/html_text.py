"""HTML extraction (9): streaming parser events, text-to-tag ratios, Gaussian smoothing, threshold clustering.

One pass of the standard library's parser turns a page into blocks: the text between block-level tags, with the
number of tags that occurred in it and the container that holds it. A block's ratio of characters to tags, smoothed
over its neighbours, tells content from lists of links; blocks above the threshold (the ratios' standard deviation)
are content. Where the page has article or main elements, all those that hold content are taken whole, so short
paragraphs within them stay; of a main element around articles, the content blocks outside these stay as well. Other
pages give all text from the first content block to the last, and what lies around it up to the next block of links.
Elements that are furniture by their tag or role never count, nor do those that are by their class or id, unless they
hold most of the page's content or articles; inside an article only wrappers whose whole name says so are furniture.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelmood.llm.base import query, table

#: Blocks on either side that smoothing reaches, and its width.
REACH = 2
SIGMA = 1.0

#: Elements of HTML by what they do.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table "
    "tbody td tfoot th thead title tr ul".split()
)
CONTAINERS = frozenset("article body div main section table tbody td tr".split())
FURNITURE = frozenset(
    "annotation annotation-xml aside audio button canvas datalist dialog embed footer form head iframe input label menu nav noscript object "
    "script select style svg template textarea title video".split()
)
CLOSED_BY = {
    "p": BLOCK - {"html", "body", "head", "title"},
    "li": frozenset({"li"}), "dt": frozenset({"dt", "dd"}), "dd": frozenset({"dt", "dd"}),
    "tr": frozenset({"tr"}), "td": frozenset({"td", "th", "tr"}), "th": frozenset({"td", "th", "tr"}),
    "option": frozenset({"option"}),
}
ROLES = frozenset("banner complementary contentinfo dialog alert form menu menubar navigation search".split())
NAMES = frozenset(
    "ad ads adsense advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer header masthead menu modal nav navbar navigation newsletter notice notices popup promo promoted "
    "promotion related respond share sharing sidebar skip social sponsor sponsored subscribe toolbar widget".split()
)
#: Names of page parts: the whole class or id, or after a word of place; no-sidebar and navbar-fixed name other things.
PARTS = frozenset("banner footer header masthead menu nav navbar navigation sidebar toolbar".split())
PLACES = frozenset("bottom global left primary right secondary site top".split())
#: Inside an article a name counts for these wrappers only, and only if it says nothing but furniture and layout.
WRAPPERS = frozenset("div dl fieldset figure ol section span table ul".split())
LAYOUT = frozenset(
    "area bar block box btn button buttons card container content form group icons inner item items link links list "
    "outer panel post posts row section slot text title top unit widget wrap wrapper".split()
) | PLACES
_NAME_PARTS = re.compile(r"[^a-z0-9]+")
#: What an open element can be closed by, and the elements that such a search does not leave.
_CLOSES = {tag: frozenset(at for at, by in CLOSED_BY.items() if tag in by) for tag in BLOCK}
_SCOPES = CONTAINERS | {"ul", "ol", "dl"}


def _is_furniture(tag: str, attrs: list, inside_article: bool) -> bool:
    """By its tag, role or as hidden."""
    if tag in FURNITURE or (tag == "header" and not inside_article):
        return True
    if tag in ("html", "body", "article", "main") and not inside_article:
        return False
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "role" and (value or "").lower() in ROLES:
            return True
    return False


def _is_named_furniture(tag: str, attrs: list, inside_article: bool) -> bool:
    """By its class or id; the header of an article is none."""
    if tag in ("html", "body") or (tag in ("article", "main") and not inside_article):
        return False
    for name, value in attrs:
        if name not in ("class", "id") or not value:
            continue
        for whole in value.lower().split():
            parts = [x for x in _NAME_PARTS.split(whole) if x]
            telling = [x for x in parts if x not in PARTS and x in NAMES]
            if telling and not inside_article:
                return True
            # market-share or related-work name a topic, share-buttons and related-posts a part of the page
            if telling and tag in WRAPPERS and all(x in NAMES or x in LAYOUT for x in parts):
                return True
            if parts and parts[-1] in PARTS and all(x in PLACES for x in parts[:-1]):
                if not (inside_article and parts[-1] in ("header", "masthead")):
                    return True
    return False


class _Blocks(HTMLParser):
    """Blocks (text, tags, linked characters, furniture, names, container) in page order; containers as (parent, tag).

    ``names``: numbers of the open elements that are furniture by their name only. ``named``: how many there were.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, int, int, bool, tuple[int, ...], int]] = []
        self.containers: list[tuple[int, str]] = [(-1, "page")]
        self.named = 0
        #: for each container the number of ``named`` when it opened
        self.since: list[int] = [0]
        #: open elements: tag, furniture, names, container
        self._open: list[tuple[str, bool, tuple[int, ...], int]] = []
        #: how many elements of each tag are open, and the places of those that end or bound an implied close
        self._count: Counter[str] = Counter()
        self._bounds: list[int] = []
        self._parts: list[str] = []
        self._tags = self._linked = 0

    def _here(self) -> tuple[bool, tuple[int, ...], int]:
        return self._open[-1][1:] if self._open else (False, (), 0)

    def flush(self) -> None:
        text = " ".join("".join(self._parts).split())
        if text:
            self.blocks.append((text, self._tags, self._linked, *self._here()))
            self._tags = 0
        self._linked = 0
        self._parts.clear()

    def _pop_to(self, depth: int) -> None:
        self._count.subtract(x[0] for x in self._open[depth:])
        del self._open[depth:]
        while self._bounds and self._bounds[-1] >= depth:
            self._bounds.pop()

    def parse_html_declaration(self, i: int) -> int:
        """Comments, and any other declaration whatever is in it, up to its end; the text around it stays."""
        if self.rawdata.startswith("<!--", i):
            return self.parse_comment(i)
        if self.rawdata.startswith("<![CDATA[", i):
            end = self.rawdata.find("]]>", i)
            if end >= 0:
                return end + 3
        return self.parse_bogus_comment(i)

    def unknown_decl(self, data: str) -> None:
        pass

    def handle_starttag(self, tag: str, attrs: list) -> None:
        self._tags += 1
        if tag in BLOCK:
            self.flush()
        if tag == "br":
            self._parts.append(" ")
        if tag in VOID:
            return
        if closes := _CLOSES.get(tag):
            for depth in reversed(self._bounds):
                at = self._open[depth][0]
                if at in closes:
                    self._pop_to(depth)
                    break
                if at in _SCOPES:
                    break
        furniture, names, container = self._here()
        if not furniture:
            inside = self._count["article"] + self._count["main"] > 0
            furniture = _is_furniture(tag, attrs, inside)
            if not furniture and _is_named_furniture(tag, attrs, inside):
                names = (*names, self.named)
                self.flush()
                self.named += 1
            if furniture:
                self.flush()
        if tag in CONTAINERS:
            self.containers.append((container, tag))
            self.since.append(self.named)
            container = len(self.containers) - 1
        if tag in CLOSED_BY or tag in _SCOPES:
            self._bounds.append(len(self._open))
        self._open.append((tag, furniture, names, container))
        self._count[tag] += 1

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        # an element that is not open ends nothing, and is not searched for
        for depth in range(len(self._open) - 1, -1, -1) if self._count[tag] else ():
            if self._open[depth][0] == tag:
                # what ends furniture or a block ends the text before it
                outer = self._open[depth - 1][1:3] if depth else (False, ())
                if tag in BLOCK or self._open[-1][1:3] != outer:
                    self.flush()
                self._pop_to(depth)
                return
        if tag in BLOCK:
            self.flush()

    def handle_data(self, data: str) -> None:
        self._parts.append(data)
        if self._count["a"]:
            self._linked += len(" ".join(data.split()))


def _smoothed(values: list[float]) -> list[float]:
    kernel = [math.exp(-0.5 * (k / SIGMA) ** 2) for k in range(REACH + 1)]
    out = []
    for i in range(len(values)):
        weight = total = 0.0
        for k in range(-REACH, REACH + 1):
            if 0 <= i + k < len(values):
                weight += kernel[abs(k)]
                total += kernel[abs(k)] * values[i + k]
        out.append(total / weight)
    return out


def _content(blocks: list) -> list[int]:
    """Characters that each block adds to its region: its length if its smoothed ratio is above the threshold."""
    smooth = _smoothed([len(b[0]) / max(1, b[1]) for b in blocks])
    mean = sum(smooth) / len(smooth)
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / len(smooth))
    chars = [len(b[0]) if x >= spread and not b[3] else 0 for b, x in zip(blocks, smooth)]
    return chars if any(chars) else [0 if b[3] else len(b[0]) for b in blocks]


def _judged(parser: _Blocks) -> list[tuple[str, int, int, bool, int]]:
    """Blocks (text, tags, linked, furniture, container): a name does not count where it would take most of the page.

    That is more than half of the content, or, from around articles and main elements, more than half of their text.
    """
    plain = [(*b[:4], b[5]) for b in parser.blocks]
    if not parser.named:
        return plain
    chars = _content(plain)
    # of each container the outermost article or main around it
    outermost: list[int] = []
    for i, (parent, tag) in enumerate(parser.containers):
        above = outermost[parent] if parent >= 0 else -1
        outermost.append(above if above >= 0 else i if tag in ("article", "main") else -1)
    content, articles = [0] * parser.named, [0] * parser.named
    in_articles = 0
    for (text, _, _, furniture, names, container), n in zip(parser.blocks, chars):
        size = 0 if furniture or outermost[container] < 0 else len(text)
        in_articles += size
        for name in names:
            content[name] += n
            # the article opened after the name
            articles[name] += size if parser.since[outermost[container]] > name else 0
    total = sum(chars)
    void = {k for k in range(parser.named) if 2 * content[k] > total or 2 * articles[k] > in_articles > 0}
    return [(t, n, a, f or not void.issuperset(names), c) for t, n, a, f, names, c in parser.blocks]


def main_text(html: str | None) -> str:
    """The page's main text, blocks joined by two line ends; empty for null, empty and textless pages."""
    if not html:
        return ""
    parser = _Blocks()
    parser.feed(html)
    parser.close()
    parser.flush()
    if not parser.blocks:
        return ""
    blocks, containers = _judged(parser), parser.containers
    chars = _content(blocks)
    total = [0] * len(containers)
    any_text = [False] * len(containers)
    for (_, _, _, furniture, container), n in zip(blocks, chars):
        total[container] += n
        any_text[container] |= not furniture
    # a container comes after the one around it; the page is the first
    for i in range(len(containers) - 1, 0, -1):
        total[containers[i][0]] += total[i]
        any_text[containers[i][0]] |= any_text[i]
    found = [i for i, c in enumerate(containers) if c[1] in ("article", "main") and any_text[i]]
    if found:
        taken = _taken(found, total, containers)
        return "\n\n".join(b[0] for b, n in zip(blocks, chars) if not b[3] and (taken[b[4]] == 2 or (taken[b[4]] and n)))
    region = _region(blocks, chars)
    return "\n\n".join(blocks[i][0] for i in region if not blocks[i][3])


def _region(blocks: list, chars: list[int]) -> range:
    """From the first to the last content block, and outwards over headings, lists and short paragraphs.

    That is, up to a block at least half of whose characters are links; furniture in between does not end it.
    """
    full = [i for i, n in enumerate(chars) if n]
    if not full:
        return range(0)
    first, last = full[0], full[-1]
    own = lambda i: blocks[i][3] or 2 * blocks[i][2] < len(blocks[i][0])
    while first > 0 and own(first - 1):
        first -= 1
    while last + 1 < len(blocks) and own(last + 1):
        last += 1
    return range(first, last + 1)


def _taken(found: list[int], total: list[int], containers: list) -> list[int]:
    """What each container gives: 2 all its text, 1 its content blocks, 0 nothing.

    Articles with content blocks, and main elements with such blocks but without an article of the kind, give all of
    theirs; a main element gives its content blocks outside its articles too. If none has content blocks, all count.
    """
    held = {i for i in found if total[i]} or set(found)
    around = set()
    for i in held:
        if containers[i][1] == "article":
            parent = containers[i][0]
            while parent >= 0:
                around.add(parent)
                parent = containers[parent][0]
    taken = [0] * len(containers)
    for i, (parent, tag) in enumerate(containers):
        taken[i] = taken[parent] if parent >= 0 else 0
        if i in held and taken[i] < 2:
            taken[i] = 1 if tag == "main" and i in around else 2
    return taken


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Columns (page_id, url, text, n_chars), one row for each input row, repeated and null ids included.

    Null and empty pages, and pages without main text, give an empty text. No rows give no rows. Markup that is
    broken in any way gives the text that the parser finds; declarations are skipped. The work grows with a page's
    length, whatever its nesting. Further columns are not read.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    id_type = rows.schema["page_id"].dataType.simpleString()

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [main_text(h) for h in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())],
                names=["page_id", "url", "text", "n_chars"],
            )

    return rows.mapInArrow(texts, f"page_id {id_type}, url string, text string, n_chars bigint")


@query("op9_html_extraction")
def op9_html_extraction(spark, directory):
    return extract(table(spark, directory, "pages"))
