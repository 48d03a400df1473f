"""Main text of web pages by text-to-tag ratios.

A streaming parser (the standard library's) turns a page into block lines. A line knows its text, how many tags it holds and
whether it stands in a part that is never content (menus, forms, scripts and so on, by element). Parts that a whole token of class
or id marks are left out if they are short or mostly links. The lines' text-to-tag ratios are smoothed with a Gaussian; lines whose smoothed ratio reaches a threshold form
clusters, and the clusters are the content, wherever they stand. ``article`` and ``main`` only raise the ratio of their lines and
widen clusters: such an element is taken as a whole if a cluster touches it, and not at all if none does. Elsewhere the lines
between neighbouring clusters of one parent are taken, and the lines of a cluster's container before and behind it.

A tag without ``>`` and a comment without its end last to the end of the page; a tag with an open quote ends at the next ``>``. So each
construct is scanned once and any text takes linear time.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Elements of HTML by their role.
SILENT = frozenset("script style noscript template iframe object svg annotation head title select textarea datalist canvas".split())
ASIDE = frozenset("nav header footer aside form menu dialog button fieldset".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table "
    "tbody td tfoot th thead tr ul br".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTENT = frozenset(("article", "main"))
#: Elements that are a parent of lines.
CONTAINERS = frozenset("div section article main center td form fieldset details aside header footer nav hgroup".split())
#: What a head may hold: all else ends it, with or without an end tag.
IN_HEAD = frozenset("title script style noscript template base link meta".split())
ENDS_P = BLOCK - {"br"}
#: Words in class or id that mark a part beside the content, alone or together with words of places and boxes.
BESIDE = frozenset(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus "
    "footer header login menu modal nav navbar navigation newsletter notice pagination popup promo promoted related replies reply "
    "respond share sharing sidebar signup social sponsor sponsored subscribe teaser toolbar widget widgets".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())

PLACES = frozenset("area bar block box bottom container inner left list main outer primary right secondary section site sub top wrap wrapper".split())
#: Of these, words of parts that are beside the content also where they are long.
NEVER = frozenset("comment comments consent cookie cookies disqus replies respond".split())
#: Characters up to which a marked part is short, also on a page of little text.
SHORT = 500

_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")

SIGMA = 1.0
RADIUS = 2
#: Factor of the ratio of lines in an article or main element.
INSIDE = 2.0


@dataclass
class Line:
    """A block's text, its tags, and where it stands."""

    text: str
    tags: int
    region: int  # number of the article or main element around it, -1 if none
    beside: bool
    marks: tuple[str, ...] = ()  # tokens of class and id around it that mark a part beside the content
    linked: int = 0  # characters inside links
    parent: int = 0  # number of the container around it, 0 for the body
    above: int = 0  # and of the container around that


class _Lines(HTMLParser):
    """Builds lines from parser events; keeps a stack of open elements only."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Name, silent, beside, region, marks, in a link, parent, the container above it.
        self.stack: list[tuple[str, bool, bool, int, tuple[str, ...], bool, int, int]] = []
        self.parts: list[str] = []
        self.tags = 0
        self.linked = 0
        self.regions = 0
        self.containers = 0
        self.open: Counter[str] = Counter()  # elements of each name on the stack

    # The page is fed at once: what is unfinished stays so, and is not tried again from each later position.
    def _behind(self, close, start):
        end = self.rawdata.find(close, start)
        return end + len(close) if end >= 0 else len(self.rawdata)

    def parse_starttag(self, i):
        end = super().parse_starttag(i) if self.rawdata.find(">", i) >= 0 else -1
        return end if end >= 0 else self._behind(">", i)

    def parse_endtag(self, i):
        return super().parse_endtag(i) if self.rawdata.find(">", i) >= 0 else len(self.rawdata)

    def parse_comment(self, i, report=True):
        return self._behind("-->", i + 2)

    def parse_pi(self, i):
        return self._behind(">", i)

    def parse_html_declaration(self, i):
        return self._behind(">", i)

    def state(self):
        return self.stack[-1][1:] if self.stack else (False, False, -1, (), False, 0, 0)

    def flush(self):
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            _, beside, region, marks, _, parent, above = self.state()
            self.lines.append(Line(text, self.tags, region, beside, marks, self.linked, parent, above))
            self.tags = 0
        self.parts.clear()
        self.linked = 0

    def _end_head(self, tag):
        """The body, or anything but a head's own elements directly inside it, ends an open head."""
        if tag == "body" or (self.stack and self.stack[-1][0] == "head" and tag not in IN_HEAD):
            for i in range(min(len(self.stack), 3)):
                if self.stack[i][0] == "head":
                    self._pop(i)
                    return

    def handle_starttag(self, tag, attrs):
        self._end_head(tag)
        if tag in BLOCK:
            self.flush()
            if tag in ENDS_P:
                self._end_paragraph(tag)
        self.tags += 1
        if tag in VOID:
            return
        silent, beside, region, marks, link, parent, above = self.state()
        if tag in CONTENT and region < 0 and not beside:
            region = self.regions
            self.regions += 1
        inside = region >= 0
        # A page's header, but also an article's own one with its heading: only the former is beside.
        if not beside:
            beside = (tag in ASIDE and not (inside and tag == "header")) or self._marked(tag, attrs)
        if tag not in ("html", "body", "article", "main"):
            marks += tuple(t for t in _marking(attrs, inside) if t not in marks)
        if tag in CONTAINERS:
            self.containers += 1
            parent, above = self.containers, parent
        self.open[tag] += 1
        self.stack.append((tag, silent or tag in SILENT, beside, region, marks, link or tag == "a", parent, above))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def _marked(self, tag, attrs) -> bool:
        if tag in ("html", "body", "article", "main"):
            return False
        for name, value in attrs:
            if not value:
                if name == "hidden":
                    return True
            elif name == "role" and value.lower() in ROLES:
                return True
            elif name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
                return True
            elif name == "aria-hidden" and value.lower() == "true":
                return True
        return False

    def _end_paragraph(self, tag):
        """A block ends an open p; li, dt, dd, td and tr end their own kind."""
        ends = {"p"} | ({tag} if tag in ("li", "option") else set())
        ends |= {"dt", "dd"} if tag in ("dt", "dd") else {"td", "th"} if tag in ("td", "th") else set()
        if not any(self.open[t] for t in ends):
            return
        stops = {"ul", "ol", "dl", "table", "div", "article", "main", "section", "nav", "body", "aside", "form", "blockquote"}
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] in ends:
                self._pop(i)
                break
            if self.stack[i][0] in stops:
                break

    def _pop(self, i):
        """Ends element i; formatting elements that were left open inside it end with it."""
        self.open.subtract(x[0] for x in self.stack[i:])
        del self.stack[i:]

    def handle_endtag(self, tag):
        self.tags += 1
        if tag in BLOCK:
            self.flush()
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                self._pop(i)
                return

    def handle_data(self, data):
        if self.stack and self.stack[-1][0] == "head" and data.strip():
            self._pop(len(self.stack) - 1)
        silent, *_, link, _, _ = self.state()
        if not silent:
            self.parts.append(data)
            if link:
                self.linked += len(data)


def _marking(attrs, inside: bool) -> list[str]:
    """The tokens of class and id that mark a part beside the content; a header inside an article is its own."""
    out = []
    for name, value in attrs:
        if value and name in ("class", "id"):
            for token in value.split():
                words = set(_WORD.findall(_CAMEL.sub(" ", token).lower()))
                if words & BESIDE and words <= BESIDE | PLACES and not (inside and words & BESIDE == {"header"}):
                    out.append(" ".join(sorted(words)))
    return list(dict.fromkeys(out))


def unmarked(lines: list[Line]) -> list[int]:
    """Lines that stand in no part beside the content. Marks hold for parts that are short, mostly links, or never content.

    Parts of the same mark are judged together. Marks that would leave nothing do not hold.
    """
    able = [i for i, x in enumerate(lines) if not x.beside]
    sizes: dict[str, list[int]] = {}
    for i in able:
        for mark in lines[i].marks:
            size = sizes.setdefault(mark, [0, 0])
            size[0] += len(lines[i].text)
            size[1] += lines[i].linked
    total = sum(len(lines[i].text) for i in able)
    holds = {m for m, (n, linked) in sizes.items() if n <= max(SHORT, total // 2) or 2 * linked > n or not NEVER.isdisjoint(m.split())}
    return [i for i in able if holds.isdisjoint(lines[i].marks)] or able


def bridged(lines: list[Line], able: list[int], chosen: set[int]) -> set[int]:
    """``chosen`` and the lines between neighbouring clusters of one parent, or of two parents in one container below the body.

    Lines that are mostly links are left out if they have another parent.
    """
    out, last = set(chosen), None
    for n, i in enumerate(able):
        if i not in chosen:
            continue
        if last is not None and n > last + 1:
            a, b = lines[able[last]], lines[i]
            if a.parent == b.parent or {a.parent, a.above} & {b.parent, b.above} - {0}:
                between = ((k, lines[k]) for k in able[last + 1 : n])
                out |= {k for k, x in between if x.parent in (a.parent, b.parent) or 2 * x.linked <= len(x.text)}
        last = n
    return out | edges(lines, able, chosen)


def edges(lines: list[Line], able: list[int], chosen: set[int]) -> set[int]:
    """The lines of the same container, below the body, that adjoin the first and the last cluster; none that are mostly links."""
    at = [n for n, i in enumerate(able) if i in chosen]
    out: set[int] = set()
    for n, step in ((at[0], -1), (at[-1], 1)):
        edge = lines[able[n]]
        n += step
        while edge.parent and 0 <= n < len(able):
            line = lines[able[n]]
            if line.parent != edge.parent or line.region != edge.region or 2 * line.linked > len(line.text):
                break
            out.add(able[n])
            n += step
    return out


def page_lines(html: str) -> list[Line]:
    parser = _Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    return parser.lines


def smoothed(values: np.ndarray, sigma: float = SIGMA, radius: int = RADIUS) -> np.ndarray:
    """Gaussian smoothing; at the ends the kernel is cut and made to sum to 1 again."""
    if not len(values):
        return values
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    full = np.convolve(values, kernel)[radius : radius + len(values)]
    norm = np.convolve(np.ones(len(values)), kernel)[radius : radius + len(values)]
    return full / norm


def line_values(lines: list[Line], able: list[int]) -> np.ndarray:
    """The smoothed ratio of each line of ``able``; smoothing does not cross the edge of an article or main element."""
    ratios = np.array([len(lines[i].text) / max(1, lines[i].tags) * (INSIDE if lines[i].region >= 0 else 1.0) for i in able])
    region = np.array([lines[i].region for i in able])
    out = np.zeros(len(able))
    for r in np.unique(region):
        at = np.flatnonzero(region == r)
        out[at] = smoothed(ratios[at])
    return out


def content(lines: list[Line], widen: bool = True) -> list[int]:
    """Numbers of the lines that are content: those of the clusters, and the article or main elements that clusters touch.

    ``widen`` False: the lines of the clusters only.
    """
    able = unmarked(lines)
    if not able:
        return []
    values = line_values(lines, able)
    # Two clusters split at a share of the spread, so that a page of equal lines is one cluster; the largest is always in one.
    threshold = min(float(values.std()), float(values.max()) / 2)
    chosen = {i for i, v in zip(able, values, strict=True) if v >= threshold}
    if not widen:
        return sorted(chosen)
    chosen = bridged(lines, able, chosen)
    touched = {lines[i].region for i in chosen} - {-1}
    return [i for i in able if i in chosen or lines[i].region in touched]


def main_text(html: str | None) -> str:
    """The main text of one page; blocks are joined by a space. Empty for null, empty or textless pages."""
    if not html:
        return ""
    lines = page_lines(html)
    return " ".join(lines[i].text for i in content(lines))


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Columns of ``pages`` other than the html, ``text`` (never null) and ``n_chars``, its code points.

    One row per page, repeated ones too; a null page is an empty one. The whole html is parsed in one pass and one stage; there
    is no shuffle. Columns named ``text`` or ``n_chars`` are replaced.
    """
    kept = [c for c in pages.columns if c not in (html, "text", "n_chars")]
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in pages.schema.fields if f.name in kept)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(x) for x in batch.column(len(kept)).to_pylist()]
            arrays = [batch.column(i) for i in range(len(kept))]
            arrays += [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*kept, "text", "n_chars"])

    return pages.select(*kept, html).mapInArrow(work, ddl + "text string, n_chars long")
