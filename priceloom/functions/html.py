"""HTML pages: a forgiving parser that runs once a page in an Arrow pass, what it found as columns, and regex forms of title and text."""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StringType, StructField, StructType


def _ranges(*names: str) -> ArrayType:
    return ArrayType(StructType([StructField(n, IntegerType()) for n in names]))


LINK = StructType([StructField("href", StringType()), StructField("text", StringType()), StructField("marked", BooleanType())])
#: A page's texts are held once, as pieces; cells and heads are ranges of pieces, rows of cells, tables of rows and heads (from 0, the end excluded).
PARSED = StructType([
    StructField("title", StringType()), StructField("pieces", ArrayType(StringType())), StructField("links", ArrayType(LINK)),
    StructField("cells", _ranges("first", "last")), StructField("heads", _ranges("first", "last")), StructField("rows", _ranges("first", "last")),
    StructField("tables", _ranges("first_row", "last_row", "first_head", "last_head")),
])

#: Open elements, of which more aren't told apart, and tables within tables; what is deeper counts for what is open.
MAX_DEPTH, MAX_TABLES = 512, 16
#: Bytes of source that are parsed at once: a task holds the parsed pages of so much.
PART_BYTES = 1 << 20

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
#: Elements whose text doesn't count as the page's.
_SILENT = frozenset("script style template rt rp".split())
_CELL, _GROUP = frozenset(("td", "th", "caption")), frozenset(("tbody", "thead", "tfoot"))
_TABLE = _CELL | _GROUP | {"table", "tr"}
#: Elements that a start tag ends when they are the innermost of their kind: implied end tags.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "optgroup": {"option", "optgroup"}} | dict.fromkeys(
    "address article aside blockquote center div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), {"p"}
)

_TAG = re.compile(r"<(?:(!--)|([!?])|(/?)([a-zA-Z][^\s/>]*))")
_ATTRIBUTE = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_COMMENT_END = re.compile(r"--!?>")


def _plain(text: str) -> str:
    """text with character references resolved; as it is where one has thousands of digits."""
    if "&" not in text:
        return text
    try:
        return entities.unescape(text)
    except ValueError:
        return text


@lru_cache(64)
def selector(said: str) -> tuple:
    """(tag or None, classes) of each step of a selector such as "div.results a.result", from the element up to its ancestors."""
    steps = []
    for step in reversed(said.split()):
        tag, *classes = step.split(".")
        steps.append((tag.lower() or None, frozenset(classes)))
    return tuple(steps)


class _Page:
    """One page: tokens are read from left to right, open elements kept on a stack.

    A start tag ends what it implies the end of; an end tag ends the innermost element of its name within the cell, row or table at
    hand, and is passed over without one. Text between a table's tags but outside its cells stands before the table. Nothing raises,
    and the time follows the length of the source.
    """

    def __init__(self, source: str, steps: tuple = ()):
        self.source, self.steps = source, steps
        self.pieces: list[str] = []
        self.cells, self.heads, self.rows, self.tables, self.links = [], [], [], [], []
        self.title: list[str] | None = None
        self.open: list[tuple] = []  # (tag, classes, what is to be closed)
        self.frames: list[int] = []  # places in open of table elements
        self.counts: dict[str, int] = {}
        self.moved: dict[int, int] = {}  # pieces that stand before a table: their place, and the table's
        self.silent, self.naming, self.link, self.held, self.endless = 0, False, None, [], set()
        self._scan()
        self._text()
        self._pop(0)
        if self.moved:
            self._move()

    def _scan(self) -> None:
        source, at, n = self.source, 0, len(self.source)
        while at < n:
            found = _TAG.search(source, at)
            if not found:
                self.held.append(source[at:])
                return
            if found.start() > at:
                self.held.append(source[at : found.start()])
            comment, other, slash, name = found.groups()
            at = found.end()
            if comment:
                self._text()
                end = _COMMENT_END.search(source, at - 2 if source.startswith(">", at) else at)
                at = end.end() if end else n
                if source.startswith("<!-->", found.start()):
                    at = found.end() + 1
            elif other:
                self._text()
                end = source.find(">", at)
                at = end + 1 if end >= 0 else n
            else:
                at, given = self._attributes(at, bool(slash))
                if at < 0:  # the source ends within the tag
                    return
                name = name.lower()
                if slash:
                    self._end(name)
                else:
                    self._start(name, given)
                    if name in _RAW:
                        at = self._raw(name, at)

    def _attributes(self, at: int, skip: bool) -> tuple[int, dict]:
        """The place after the tag's end, -1 if there is none, and its attributes by name, the first of each."""
        source, given = self.source, {}
        while True:
            found = _ATTRIBUTE.match(source, at)
            if not found:
                end = source.find(">", at)
                return (end + 1 if end >= 0 else -1), given
            at = found.end()
            if not skip and (name := found[1].lower()) in ("href", "class"):
                value = found[2] if found[2] is not None else found[3] if found[3] is not None else found[4]
                given.setdefault(name, _plain(value or ""))

    def _raw(self, name: str, at: int) -> int:
        """Takes the text up to the end tag of an element that holds text only; without one it is an element like others (script and style: to the end)."""
        end = None if name in self.endless else re.compile(f"</{name}(?=[\\s/>])", re.I).search(self.source, at)
        if end is None:
            self.endless.add(name)
            return len(self.source) if name in ("script", "style") else at
        self.held.append(self.source[at : end.start()])
        return end.start()

    def _text(self) -> None:
        """The text since the last tag becomes a piece."""
        if not self.held:
            return
        said = _plain("".join(self.held)).strip()
        self.held.clear()
        if not said or self.silent:
            return
        if self.naming:
            self.title.append(said)
        if self.link is not None:
            self.link[1].append(said)
        if self.frames:
            tag, _, mark = self.open[self.frames[-1]]
            if tag not in _CELL:
                self.moved[len(self.pieces)] = self._table()[2][-1]
        self.pieces.append(said)

    def _table(self) -> tuple | None:
        return next((self.open[i] for i in reversed(self.frames) if self.open[i][0] == "table"), None)

    def _push(self, tag: str, classes: frozenset, mark: object = None) -> None:
        if tag in _TABLE:
            self.frames.append(len(self.open))
        self.open.append((tag, classes, mark))
        self.counts[tag] = self.counts.get(tag, 0) + 1

    def _pop(self, to: int) -> None:
        """Ends all open elements from place `to` on."""
        while len(self.open) > to:
            tag, _, mark = self.open.pop()
            self.counts[tag] -= 1
            if tag in _TABLE:
                self.frames.pop()
                if tag == "table":
                    mark[1], mark[3] = len(self.rows), len(self.heads)
                elif tag == "tr":
                    mark[1] = len(self.cells)
                elif tag in _CELL:
                    mark[1] = len(self.pieces)
            elif tag in _SILENT:
                self.silent -= 1
            elif tag == "a":
                self.link = None
            elif tag == "title":
                self.naming = False

    def _within(self, tags: frozenset | set) -> int | None:
        """The place of the innermost open element of these names inside the innermost table element."""
        if not any(self.counts.get(t) for t in tags):
            return None
        floor = self.frames[-1] + 1 if self.frames else 0
        return next((i for i in range(len(self.open) - 1, floor - 1, -1) if self.open[i][0] in tags), None)

    def _of_table(self, tags: frozenset | set) -> int | None:
        """The place of the innermost open element of these names inside the innermost table."""
        for i in reversed(self.frames):
            if self.open[i][0] in tags:
                return i
            if self.open[i][0] == "table":
                return None
        return None

    def _start(self, tag: str, given: dict) -> None:
        self._text()
        for i in (self._within(_ENDS[tag]) if tag in _ENDS else None,):
            if i is not None:
                self._pop(i)
        if tag in _VOID:
            return
        classes = frozenset(given.get("class", "").split())
        if tag in _TABLE:
            self._start_in_table(tag, classes)
            return
        if tag == "a":
            before = self._within({"a"})
            if before is not None:
                self._pop(before)
            self.link = None
            if "href" in given:
                self.link = (given["href"], [], self._marked(classes))
                self.links.append(self.link)
        if len(self.open) >= MAX_DEPTH and tag not in ("a", "title") and tag not in _SILENT:
            return
        if tag == "title" and self.title is None:
            self.title, self.naming = [], True
        self.silent += tag in _SILENT
        self._push(tag, classes)

    def _start_in_table(self, tag: str, classes: frozenset) -> None:
        if tag == "table":
            if self.frames and self.open[self.frames[-1]][0] not in _CELL:
                self._end("table")  # a table can't stand in a table but in its cells
            if self.counts.get("table", 0) < MAX_TABLES:
                # The last place is that before which the table's stray texts stand.
                mark = [len(self.rows), 0, len(self.heads), 0, len(self.pieces)]
                self.tables.append(mark)
                self._push(tag, classes, mark)
            return
        if not self.counts.get("table"):
            return
        ended = self._of_table(_CELL if tag in ("td", "th") else _CELL | {"tr"} if tag == "tr" else _CELL | {"tr"} | _GROUP)
        outermost = ended
        while outermost is not None and tag not in ("td", "th"):
            self._pop(outermost)
            outermost = self._of_table(_CELL | {"tr"} if tag == "tr" else _CELL | {"tr"} | _GROUP)
        if ended is not None and tag in ("td", "th"):
            self._pop(ended)
        elif tag in ("td", "th") or ended is None:
            self._pop(self.frames[-1] + 1)  # what stands between a table's tags ends here
        mark = None
        if tag == "tr":
            mark = [len(self.cells), 0]
            self.rows.append(mark)
        elif tag in _CELL:
            mark = [len(self.pieces), 0]
            if tag != "caption" and self._of_table({"tr"}) is not None:
                self.cells.append(mark)
            if tag != "td":
                self.heads.append(mark)
        self._push(tag, classes, mark)

    def _end(self, tag: str) -> None:
        if tag in _TABLE:
            place = self._of_table({tag})
        else:
            place = self._within({tag})
        if place is not None or tag == "br":
            self._text()
            if place is not None:
                self._pop(place)

    def _marked(self, classes: frozenset) -> bool:
        """Whether the link that starts here is what the selector asks for."""
        if not self.steps:
            return False
        fits = lambda step, tag, own: step[0] in (None, tag) and step[1] <= own
        if not fits(self.steps[0], "a", classes):
            return False
        rest = list(self.steps[1:])
        for tag, own, _ in reversed(self.open):
            if rest and fits(rest[0], tag, own):
                del rest[0]
        return not rest

    def _move(self) -> None:
        """Puts stray texts before their tables. They leave no cell: of a cell's range only the beginning and the end move."""
        n = len(self.pieces)
        order = sorted(range(n), key=lambda i: (self.moved.get(i, i), i not in self.moved))
        place = np.empty(n + 1, np.int64)
        place[order] = np.arange(n)
        self.pieces = [self.pieces[i] for i in order]
        for mark in {id(m): m for m in chain(self.cells, self.heads)}.values():
            if mark[1] > mark[0]:
                first = int(place[mark[0] : mark[1]].min())
                mark[:] = first, first + mark[1] - mark[0]


def _column(pages: list[_Page | None]) -> pa.Array:
    """PARSED of pages; null for None."""
    empty = _Page("")
    told = [p or empty for p in pages]

    def listed(parts: list[list], values: pa.Array) -> pa.ListArray:
        return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(p) for p in parts])]), pa.int32()), values)

    def ranges(parts: list[list], *names: str) -> pa.ListArray:
        flat = np.array(list(chain.from_iterable(chain.from_iterable(p[: len(names)] for p in part) for part in parts)), np.int32).reshape(-1, len(names))
        return listed(parts, pa.StructArray.from_arrays([pa.array(flat[:, k]) for k in range(len(names))], list(names)))

    links = [link for p in told for link in p.links]
    made = pa.StructArray.from_arrays([pa.array([h for h, _, _ in links], pa.string()), pa.array([" ".join(t) for _, t, _ in links], pa.string()), pa.array([m for _, _, m in links], pa.bool_())], ["href", "text", "marked"])
    columns = [
        pa.array([" ".join(p.title or []) for p in told], pa.string()), listed([p.pieces for p in told], pa.array(list(chain.from_iterable(p.pieces for p in told)), pa.string())), listed([p.links for p in told], made),
        *(ranges([getattr(p, c) for p in told], "first", "last") for c in ("cells", "heads", "rows")), ranges([p.tables for p in told], "first_row", "last_row", "first_head", "last_head"),
    ]
    return pa.StructArray.from_arrays(columns, PARSED.fieldNames(), mask=pa.array([p is None for p in pages]))


def _parts(batch: pa.RecordBatch, html: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most 256 pages and about PART_BYTES of source: parsed pages take many times their source's size."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(html)), 0).to_numpy(zero_copy_only=False))
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, min(first + 256, int(np.searchsorted(ends, before + PART_BYTES, "right"))))
        yield batch.slice(first, last - first)
        first = last


def parse_pages(pages: DataFrame, html: str = "html", select: str = "") -> DataFrame:
    """pages without the html column, with parsed (PARSED): null for null. Each page is parsed once, and no source makes it fail.

    A link is an `a` with an href; marked tells whether it fits select, of tags, classes and descendants, such as "div.hits a.result".
    """
    rest = [c for c in pages.columns if c != html]
    schema = StructType([pages.schema[c] for c in rest] + [StructField("parsed", PARSED)])
    steps = selector(select)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _parts(batch, html):
                made = _column([None if x is None else _Page(x, steps) for x in part.column(html).to_pylist()])
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), made], schema.fieldNames())

    return pages.select(*rest, html).mapInArrow(run, schema)


def piece_text(pieces: Column, span: Column) -> Column:
    """The pieces of a range as one text."""
    return F.array_join(F.slice(pieces, span["first"] + 1, span["last"] - span["first"]), " ")


def page_text(parsed: Column) -> Column:
    """The page's whole text."""
    return F.array_join(parsed["pieces"], " ")


def title_of(html: Column) -> Column:
    return F.trim(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def text_of(html: Column) -> Column:
    """Scripts, styles and comments out, tags as spaces, white space as single spaces; entities stay."""
    bare = F.regexp_replace(html, r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?s)<[^>]*>", " "), r"\s+", " "))
