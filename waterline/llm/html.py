"""Main text of web pages by text-to-tag ratios.

The standard library's parser streams events; a page becomes lines, one per block element, each with
its characters, tags and link characters. Lines in elements that are boilerplate by name are left
out at once. The ratio of text to tags per line is smoothed with a Gaussian, a threshold splits the
lines into two clusters, and the elements that hold the upper cluster are the content regions: all of
their lines are kept, short ones too, and elsewhere the lines of the upper cluster.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waterline.llm.tables import prepare

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section summary table tbody td tfoot"
    " th thead tr ul".split()
)
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
NOT_TEXT = frozenset(
    "aside button canvas datalist dialog footer form head iframe menu nav noscript object select script style svg"
    " template textarea title audio video".split()
)
# Elements that may stand in a page's head; any other ends it, written out or not.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
# Elements of other languages, in which a slash ends an element.
FOREIGN = frozenset(("svg", "math"))
CONTAINER = frozenset("article main section div td body".split())
# Elements whose start ends an open one of these, within the nearest of the fences.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
FENCES = frozenset("ul ol dl table body div article main section nav aside footer header form".split())
# Words in class, id and role that name boilerplate, and words that clear an element of it.
BOILERPLATE = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|banner\w*|breadcrumbs?|comments?|commentlist|consent|cookies?|disqus|footer|gdpr|header"
    r"|masthead|menus?|modal|nav|navbar|navigation|newsletter|notices?|pagination|pager|popup|promo\w*|related|replies|respond|search"
    r"|share|sharing|sidebars?|signup|skip|social|sponsor\w*|subscribe|subscription|toolbar|widgets?|alert|alertdialog"
    r"|complementary|contentinfo)(?:$|[\s_-])",
    re.I,
)
# Of these names, those that articles use for their own parts too: the clusters decide.
AMBIGUOUS = re.compile(r"(?:^|[\s_-])(?:header|search|related|share|sharing|social|alert|notices?)(?=$|[\s_-])", re.I)
# Headings above what readers wrote.
COMMENTS = re.compile(
    r"(?:\W*\d+\W+)?(?:(?:reader|user|visitor)s?['’]?s?\s+)?(?:comments?|responses?|replies)(?:\s+(?:section|\W*\d+\W*))?\W*"
    r"|(?:leave|post|write|add)\s+(?:a|your)\s+(?:comment|reply|response)\W*|join\s+the\s+conversation\W*",
    re.I,
)
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
SIGMA = 1.5


class _Line:
    __slots__ = ("parts", "tags", "links", "path", "heading", "text", "doubt", "level")

    def __init__(self, path: tuple[int, ...], level: int, doubt: int | None):
        self.parts, self.tags, self.links, self.path, self.heading, self.text, self.doubt = [], 1, 0, path, level > 0, "", doubt
        # of a heading: 1 to 6
        self.level = level


class LineParser(HTMLParser):
    """Collects the lines of a page that are not boilerplate by name."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self._open: list[tuple[str, bool, bool, bool]] = []  # name, hidden, counts as a container, in doubt by name
        self._path: tuple[int, ...] = ()
        self._names: dict[int, str] = {}
        # articles within articles, and articles that are items of a list
        self.nested: set[int] = set()
        self.listed: set[int] = set()
        self._hidden = self._links = self._headings = self._inside = self._headers = self._paragraphs = self._foreign = 0
        self._articles = self._items = 0
        self._doubts: list[int] = []
        self._doubted = 0
        self._line: _Line | None = None

    def _break(self) -> None:
        self._line = None

    def _close(self) -> None:
        name, hidden, container, doubt = self._open.pop()
        if doubt:
            self._doubts.pop()
        self._hidden -= hidden
        self._links -= name == "a"
        self._headings -= name in HEADING
        self._inside -= name in ("article", "main")
        self._headers -= name == "header"
        self._paragraphs -= name == "p"
        self._foreign -= name in FOREIGN
        self._articles -= name == "article"
        self._items -= name == "li"
        if container:
            self._path = self._path[:-1]

    def _end_head(self) -> None:
        if self._open and self._open[-1][0] == "head":
            self._close()

    def handle_starttag(self, tag, attrs):
        if tag not in IN_HEAD:
            self._end_head()
        if tag in BLOCK:
            self._break()
            while self._open and self._open[-1][0] == "p":
                self._close()
        elif self._line:
            self._line.tags += 1
            if tag == "br":
                self._line.parts.append("\n")
        if tag in VOID:
            return
        for ended in ENDS.get(tag, ()):
            for i in range(len(self._open) - 1, -1, -1):
                if self._open[i][0] == ended:
                    while len(self._open) > i:
                        self._close()
                    break
                if self._open[i][0] in FENCES:
                    break
        hidden = tag in NOT_TEXT or (tag == "header" and not self._inside)
        doubt = False
        # headings and inline elements are text whatever their names; anchors name an article's parts
        if not hidden and tag in BLOCK and tag not in HEADING and tag not in ("html", "body", "main"):
            read = ("class", "role") if self._inside else ("class", "id", "role")
            names = " ".join(_CAMEL.sub("-", v) for k, v in attrs if k in read and v)
            if names and BOILERPLATE.search(names):
                doubt = not BOILERPLATE.search(AMBIGUOUS.sub(" ", names))
                hidden = not doubt
        hidden = hidden or any(k == "hidden" or (k == "aria-hidden" and v == "true") for k, v in attrs)
        container = tag in CONTAINER
        if container:
            number = len(self._names)
            self._names[number] = tag
            self._path = (*self._path, number)
            if tag == "article":
                if self._articles:
                    self.nested.add(number)
                elif self._items:
                    self.listed.add(number)
        if doubt:
            self._doubted += 1
            self._doubts.append(self._doubted)
        self._open.append((tag, hidden, container, doubt))
        self._hidden += hidden
        self._links += tag == "a"
        self._headings += tag in HEADING
        self._inside += tag in ("article", "main")
        self._headers += tag == "header"
        self._paragraphs += tag == "p"
        self._foreign += tag in FOREIGN
        self._articles += tag == "article"
        self._items += tag == "li"

    def handle_startendtag(self, tag, attrs):
        # in HTML a slash ends void elements only, and those of other languages
        if tag not in FOREIGN and not self._foreign:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self._break()
        elif self._line:
            self._line.tags += 1
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                # text between is of unclosed inline elements
                if any(self._open[i][0] not in FENCES and self._open[j][0] in FENCES for j in range(i + 1, len(self._open))):
                    return
                while len(self._open) > i:
                    self._close()
                return

    def parse_html_declaration(self, i):
        try:
            end = super().parse_html_declaration(i)
        except AssertionError:
            end = -1
        # a marked section without a known name or an end is a comment up to the next ">"
        return self.parse_bogus_comment(i) if end < 0 and self.rawdata.startswith("<![", i) else end

    def handle_data(self, data):
        if not data.isspace():
            self._end_head()
        # of an article's header its headings and its lead
        if self._hidden or (self._headers and not self._headings and not self._paragraphs):
            return
        if self._line is None:
            if data.isspace():
                return
            level = next((int(name[1]) for name, *_ in reversed(self._open) if name in HEADING), 0) if self._headings else 0
            self._line = _Line(self._path, level, self._doubts[0] if self._doubts else None)
            self.lines.append(self._line)
        self._line.parts.append(data)
        if self._links:
            self._line.links += len(data.strip())

    def container(self, number: int) -> str:
        return self._names[number]


def smoothed(values: list[float], sigma: float = SIGMA) -> list[float]:
    """Gaussian smoothing; beyond the ends there is nothing."""
    reach = int(3 * sigma)
    weights = [math.exp(-(d * d) / (2 * sigma * sigma)) for d in range(-reach, reach + 1)]
    total = sum(weights)
    padded = [0.0] * reach + values + [0.0] * reach
    return [sum(w * padded[i + d] for d, w in enumerate(weights)) / total for i in range(len(values))]


def threshold(values: list[float]) -> float:
    """Where two clusters of the values part: the mean of their means, from the overall mean on."""
    ordered = sorted(values)
    sums = [0.0, *accumulate(ordered)]
    cut, parted = sums[-1] / len(ordered), None
    # each turn brings the values nearer to their means, so no parting comes back
    while (low := bisect_left(ordered, cut)) != parted and 0 < low < len(ordered):
        cut, parted = (sums[low] / low + (sums[-1] - sums[low]) / (len(ordered) - low)) / 2, low
    return cut


def by_readers(lines: list[_Line], dense: list[bool], parser: LineParser) -> list[bool]:
    """Lines that are reader comments: articles within an article or listed beside one, and what stands
    below a heading that announces comments, up to the end of its element or a heading as high."""
    # articles with dense text outside the articles within them
    own = {
        n
        for line, is_dense in zip(lines, dense, strict=True)
        if is_dense and parser.nested.isdisjoint(line.path)
        for n in line.path
        if parser.container(n) == "article"
    }
    beside = own - parser.listed - parser.nested
    out, under = [], None
    for line in lines:
        if under is not None and (line.path[: len(under.path)] != under.path or 0 < line.level <= under.level):
            under = None
        if line.heading and under is None and COMMENTS.fullmatch(line.text):
            under = line
        articles = [n for n in line.path if parser.container(n) == "article"]
        nested = any(n in parser.nested for n in articles) and articles[0] in own
        listed = bool(beside) and any(n in parser.listed for n in articles)
        out.append(under is not None or nested or listed)
    return out


def doubted(lines: list[_Line], dense: list[bool], parser: LineParser) -> set[int]:
    """The elements in doubt that are boilerplate: neither dense text nor headed and mostly not links.

    Beside an article or main part with dense text all of them are.
    """

    def within(line: _Line) -> bool:
        return any(parser.container(n) in ("article", "main") for n in line.path)

    if any(is_dense and within(line) for line, is_dense in zip(lines, dense, strict=True)):
        beside = {line.doubt for line in lines if line.doubt is not None and not within(line)}
    else:
        beside = set()
    whole: dict[int, list[int]] = {}
    for line, is_dense in zip(lines, dense, strict=True):
        if line.doubt is not None:
            sums = whole.setdefault(line.doubt, [0, 0, 0, 0])
            size = len(line.text)
            for i, n in enumerate((size, size * is_dense, line.links, line.heading)):
                sums[i] += n
    return beside | {n for n, (size, upper, links, headings) in whole.items() if 2 * links >= size or not (2 * upper >= size or headings)}


def main_text(html: str) -> str:
    """The article of one page; empty if the page has no text."""
    parser = LineParser()
    parser.feed(html)
    parser.close()
    lines = []
    for line in parser.lines:
        line.text = " ".join("".join(line.parts).split())
        if line.text:
            lines.append(line)
    if not lines:
        return ""
    own = [max(0, len(x.text) - x.links) / x.tags for x in lines]
    ratios = smoothed(own)
    cut = threshold(ratios)
    # a paragraph at an edge is smoothed with what is not there
    dense = [max(pair) >= cut for pair in zip(ratios, own, strict=True)]
    out, readers = doubted(lines, dense, parser), by_readers(lines, dense, parser)
    stays = [x.doubt not in out and not r for x, r in zip(lines, readers, strict=True)]
    lines, dense = [x for x, s in zip(lines, stays, strict=True) if s], [d for d, s in zip(dense, stays, strict=True) if s]
    held: dict[int, int] = {}
    for line, kept in zip(lines, dense, strict=True):
        if kept:
            for number in line.path:
                held[number] = held.get(number, 0) + len(line.text)
    whole = sum(len(x.text) for x, kept in zip(lines, dense, strict=True) if kept)
    # all lines of the articles with dense text, or of the main part, or of the deepest element that
    # holds nearly all of it; elsewhere the dense lines and the headings above them
    named = {n for n in held if parser.container(n) == "article"} or {n for n in held if parser.container(n) == "main"}
    regions = named or {max((n for n, size in held.items() if size >= 0.9 * whole), default=None)}
    kept, follows = [], False
    for line, is_dense in zip(reversed(lines), reversed(dense), strict=True):
        linked = line.links >= 0.8 * len(line.text)
        if regions == {None} or not regions.isdisjoint(line.path):
            # menus without a name: lines of nothing but links
            follows = bool(named) or is_dense or line.heading or not linked
        else:
            follows = not linked and (is_dense or (line.heading and follows))
        if follows:
            kept.append(line.text)
    return "\n".join(reversed(kept))


def _extract(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [main_text(html.as_py() or "") for html in batch.column(2)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def extract_pages(pages: DataFrame) -> DataFrame:
    """The main text of every page, one row per row.

    Nulls: a null page is an empty one and has an empty text; null ids and addresses stay null.
    Repeated rows stay. An empty table gives no rows. Other columns are not read. Pages are read
    whole; a task holds one batch of them.
    """
    prepare(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
