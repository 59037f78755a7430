"""Layout-aware rendering of HTML pages as text.

A small tree builder closes tags that the page leaves open (paragraphs, list items,
table rows and cells, options), visibility rules drop what a browser does not show,
and the renderer emits all that is left: blocks on lines of their own, lists with
their marks and depth, and table cells in aligned columns.

Pages are independent, so this is one pass without a shuffle; a page is handled
within its task whatever its size, in time proportional to it. Two limits keep the text in
proportion to the page as well. Cells with lines of more than ``WIDEST`` characters do not widen
the other cells of their column. Lists and tables that stand within ``DEEPEST`` others are shown as
blocks, item after item and cell after cell, without marks, indentation and columns. No text is lost by either.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WIDEST, DEEPEST = 120, 50

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_HIDDEN = frozenset(
    "head script style template noscript iframe object svg annotation annotation-xml audio video canvas datalist".split()
)
# What may stand in a head; anything else ends it.
_IN_HEAD = frozenset("head title meta link base basefont bgsound script style template noscript noframes".split())
# Inside svg and math a slash closes a tag, but for what stands in these.
_FOREIGN = frozenset(("svg", "math"))
_HTML_AGAIN = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
_BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
# Blocks set apart by an empty line.
_SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote article section figure".split())
# An opening tag ends these open ones, up to the nearest tag that encloses them.
_CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    **{t: ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"}) for t in ("thead", "tbody", "tfoot")},
}
_ENDS_PARAGRAPH = _BLOCK - {"td", "th", "tr", "thead", "tbody", "tfoot", "title", "option", "optgroup", "html", "body"}
_INVISIBLE_STYLE = re.compile(r"(^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(visible|initial|hidden|collapse)\b", re.I)
_BLANK = re.compile("[ \t\n\r\f]+")


# Nodes are told apart by identity: comparing them by value would walk all that is in them.
@dataclass(eq=False)
class _Node:
    tag: str
    visible: bool = True
    children: list[_Node | str] = field(default_factory=list)
    # Whether its own text shows; elements inside may differ.
    shown: bool = True
    foreign: bool = False


class _TreeBuilder(HTMLParser):
    """Builds the tree of a page; unknown end tags are ignored, open tags end with the page."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Node("html")
        self.open = [self.root]
        # Where the open elements of each tag stand among them, so that none has to be looked for.
        self.places: dict[str, list[int]] = {}

    def handle_starttag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        if tag == "html":
            return
        if tag == "body":
            self._end({"head"}, set())
        if tag not in _IN_HEAD:
            self._end_head()
        ends, within = _CLOSES.get(tag, (set(), set()))
        if tag in _ENDS_PARAGRAPH:
            self._end({"p"}, {"table", "td", "th", "button", "li", "dd"})
        self._end(ends, within)
        if tag == "tr" and self.open[-1].tag == "table":
            self._push(_Node("tbody"))
        if tag in ("td", "th") and self.open[-1].tag in ("table", "tbody", "thead", "tfoot"):
            self._push(_Node("tr"))
        given = {k: v or "" for k, v in attributes}
        hidden = (
            tag in _HIDDEN or "hidden" in given or (tag == "input") or bool(_INVISIBLE_STYLE.search(given.get("style", "")))
            or (tag == "dialog" and "open" not in given)
        )
        parent = self.open[-1]
        stated = _VISIBILITY.findall(given.get("style", ""))
        node = _Node(tag, not hidden)
        node.shown = stated[-1].lower() in ("visible", "initial") if stated else parent.shown
        node.foreign = tag in _FOREIGN or (parent.foreign and tag not in _HTML_AGAIN)
        parent.children.append(node)
        if tag not in _VOID:
            self._open(node)

    def handle_startendtag(self, tag: str, attributes: list[tuple[str, str | None]]) -> None:
        # A slash means nothing on other than void tags, svg, math and what stands in these.
        closed = tag in _FOREIGN or self.open[-1].foreign
        self.handle_starttag(tag, attributes)
        if closed and self.open[-1].tag == tag:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag in _VOID or tag in ("html", "body"):
            return
        at = self._last((tag,))
        outside = tag not in ("tr", "tbody", "thead", "tfoot", "table")
        # The end tag belongs outside the cell if a cell has been opened since.
        if at and not (outside and self._last(("td", "th", "table")) > at):
            self._close(at)

    def handle_data(self, data: str) -> None:
        if data.strip(" \t\n\r\f"):
            self._end_head()
        if self.open[-1].shown:
            self.open[-1].children.append(data)

    def _end_head(self) -> None:
        if self.open[-1].tag == "head":
            self._close(len(self.open) - 1)

    def _push(self, node: _Node) -> None:
        node.shown = self.open[-1].shown
        self.open[-1].children.append(node)
        self._open(node)

    def _open(self, node: _Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.open))
        self.open.append(node)

    def _close(self, at: int) -> None:
        """Closes the open element at a place and all that were opened in it."""
        while len(self.open) > at:
            self.places[self.open.pop().tag].pop()

    def _last(self, tags: Iterable[str]) -> int:
        """Place of the innermost open element of the tags, 0 without any."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end(self, tags: set[str], within: set[str]) -> None:
        """Closes the outermost open element of the tags inside the innermost one of ``within``."""
        border = self._last(within)
        found = []
        for tag in tags:
            places = self.places.get(tag, ())
            i = bisect_right(places, border)
            if i < len(places):
                found.append(places[i])
        if found:
            self._close(min(found))


class _Page:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = False
        self.blank = False

    def text(self, text: str) -> None:
        words = _BLANK.sub(" ", text)
        if words.startswith(" "):
            self.gap = True
        core = words.strip(" ")
        if core:
            if self.gap and self.line:
                self.line.append(" ")
            self.line.append(core)
            self.gap = words.endswith(" ")

    def end_line(self) -> None:
        if self.line:
            if self.blank and self.lines:
                self.lines.append("")
            self.lines.append("".join(self.line))
            self.blank = False
        self.line, self.gap = [], False

    def space(self) -> None:
        self.end_line()
        self.blank = True

    def verbatim(self, lines: list[str]) -> None:
        self.end_line()
        for line in lines:
            self.line = [line]
            self.end_line()


def render(html: str | None) -> str:
    """Visible text of a page; NULL and pages without any give ''."""
    builder = _TreeBuilder()
    builder.feed(html or "")
    builder.close()
    return "\n".join(_lines(builder.root))


def _lines(node: _Node, depth: int = 0) -> list[str]:
    """Lines of what stands in a node, walked without recursion but for lists and tables."""
    page = _Page()
    todo: list = [iter(node.children)]
    ends: list[str] = [""]
    while todo:
        child = next(todo[-1], None)
        if child is None:
            todo.pop()
            tag = ends.pop()
            if tag in _SPACED:
                page.space()
            elif tag in _BLOCK:
                page.end_line()
            continue
        if isinstance(child, str):
            page.text(child)
        elif not child.visible:
            continue
        elif child.tag == "br":
            page.end_line()
        elif child.tag == "hr":
            page.space()
            page.verbatim(["---"] if child.shown else [])
            page.space()
        elif child.tag in ("ul", "ol", "menu") and depth < DEEPEST:
            page.space() if depth == 0 else page.end_line()
            page.verbatim(_list(child, depth))
            page.space() if depth == 0 else page.end_line()
        elif child.tag == "table" and depth < DEEPEST:
            page.space()
            page.verbatim(_table(child, depth))
            page.space()
        elif child.tag == "pre":
            page.space()
            page.verbatim(_raw(child).strip("\n").split("\n"))
            page.space()
        else:
            if child.tag in _SPACED:
                page.space()
            elif child.tag in _BLOCK:
                page.end_line()
            todo.append(iter(child.children))
            ends.append(child.tag)
    page.end_line()
    return page.lines


def _list(node: _Node, depth: int) -> list[str]:
    out, number, loose = [], 0, _Node("li")
    for child in [*node.children, None]:
        item = isinstance(child, _Node) and child.tag == "li"
        if item or child is None:
            if loose.children:
                out += _lines(loose, depth + 1)
                loose = _Node("li")
            if child is not None and child.visible:
                number += 1
                mark = f"{number}. " if node.tag == "ol" else "- "
                lines = _lines(child, depth + 1)
                if not child.shown:
                    if not lines:
                        continue
                    mark = " " * len(mark)
                lines = lines or [""]
                out.append((mark + lines[0]).rstrip())
                out += [(" " * len(mark) + x).rstrip() for x in lines[1:]]
        else:
            loose.children.append(child)
    return out


def _table(node: _Node, depth: int) -> list[str]:
    rows, loose, todo = [], [], list(reversed(node.children))
    while todo:
        child = todo.pop()
        if isinstance(child, str):
            if child.strip():
                loose.append(child)
        elif child.visible and child.tag == "tr":
            cells = []
            for c in child.children:
                if isinstance(c, str):
                    loose += [c] if c.strip() else []
                elif c.visible:
                    (cells if c.tag in ("td", "th") else loose).append(c)
            rows.append([_lines(c, depth + 1) or [""] for c in cells])
        elif child.visible and child.tag in ("thead", "tbody", "tfoot"):
            todo += reversed(child.children)
        elif child.visible:
            loose.append(child)
    widths: list[int] = []
    for row in rows:
        widths += [0] * (len(row) - len(widths))
        for i, cell in enumerate(row):
            widths[i] = max(widths[i], *[len(x) if len(x) <= WIDEST else 0 for x in cell])
    # What stands in a table outside its cells is shown before it, as browsers do.
    out = _lines(_Node("div", True, loose), depth + 1) if loose else []
    for row in rows:
        for k in range(max(map(len, row), default=0)):
            line = "  ".join((cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(row, widths))
            out.append(line.rstrip())
    return [x for x in out if x]


def _raw(node: _Node) -> str:
    out, todo = [], [node]
    while todo:
        item = todo.pop()
        if isinstance(item, str):
            out.append(item)
        elif item.tag == "br":
            out.append("\n")
        elif item.visible:
            todo += reversed(item.children)
    return "".join(out)


def rendered(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """``(page_id, text, n_lines)`` per row of ``pages``; NULL html renders as '' with 0 lines."""
    source = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{html_col}`").cast("string").alias("html"))
    id_type = source.schema["page_id"].dataType.simpleString()
    return source.mapInArrow(_renderer, f"page_id {id_type}, text string, n_lines bigint")


def _renderer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [render(x.as_py()) for x in batch.column("html")]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("page_id"), pa.array(texts, pa.string()),
                pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
            ],
            names=["page_id", "text", "n_lines"],
        )
