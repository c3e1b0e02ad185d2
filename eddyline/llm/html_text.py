"""Visible text of HTML pages, laid out as a reader would see it.

A tree is built with the tags that HTML lets authors leave out (ends of paragraphs, list items, table
cells and rows, options and terms; the end of the head; ends of all that stands inside a closed
element), and what stands between the cells of a table moves in front of it, as in a browser.
Hidden parts are left out: scripts, styles, templates, the head, ``hidden`` and ``display:none``, closed
dialogs, all but the summary of closed details, inputs and media that show no text, and what is
``visibility:hidden`` as far as nothing inside is made visible again.  All other text is emitted: blocks
stand on lines of their own with the spacing between them, list items behind their mark or number,
preformatted text unchanged, and table cells in columns as wide as their widest line, a cell's blocks on
lines of their own, with the columns that a cell from an earlier row reaches into left free.

Null pages give null, empty pages and pages without visible text the empty text.  Broken markup never
fails: what is no tag is text, unmatched end tags are passed over, and nesting may be of any depth.
Whole pages are rendered, however long; where tags end is found in time that grows with the page's length,
however many of them are never closed.  Text is not indented further than ``DEEPEST`` lists, and tables
further inside one another than that are set as blocks.
"""

from __future__ import annotations

import bisect
import html
import re
import unicodedata
from collections import defaultdict
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements of HTML by what they do to the layout.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset(
    "head script style template title noscript noembed noframes iframe object audio video canvas "
    "svg datalist".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol "
    "optgroup option p pre search section summary table caption ul".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure".split())
#: An opening tag closes these if one is open inside the bound.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, {"html"}),
}
#: What may stand in the head; anything else ends it, as does text.
IN_HEAD = frozenset(
    "head base basefont bgsound link meta title style script noscript noframes template".split()
)
#: Blocks that end an open paragraph.
ENDS_PARAGRAPH = BLOCKS - {"body", "html", "li", "dt", "dd", "option", "optgroup", "caption"}
_TABLE_PARTS = frozenset("tr td th thead tbody tfoot caption colgroup col".split())
_ROW_PARTS = frozenset("tr td th".split())
_BETWEEN_CELLS = frozenset("table tr thead tbody tfoot".split())
#: An end tag does not reach beyond these.
WALLS = frozenset("table td th caption template".split())

#: Lists and tables further inside one another than this are neither indented nor aligned.
DEEPEST = 32

_NAME_ENDS, _QUOTE_OR_END = re.compile(r"[\s/>]"), re.compile(r"[>\"']")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
_MATTERS = re.compile(r"hidden|style|span|start|open|value", re.I)
_BLANKS = re.compile(r"[ \t\r\n\f]+")


@dataclass(slots=True)
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    if not _MATTERS.search(text):
        return {}
    return {
        name.lower(): html.unescape(value.strip("\"'")) for name, value in _ATTRIBUTE.findall(text)
    }


def _hidden(tag: str, attributes: dict[str, str]) -> bool:
    if tag in UNSEEN or "hidden" in attributes or (tag == "dialog" and "open" not in attributes):
        return True
    return bool(attributes) and bool(_NO_DISPLAY.search(attributes.get("style", "")))


def _visible(attributes: dict[str, str], before: bool) -> bool:
    """Whether text shows below an element, from its last word on it or else from outside."""
    said = _VISIBILITY.findall(attributes.get("style", "")) if attributes else ()
    return said[-1].lower() in ("visible", "initial") if said else before


class _Ahead:
    """The next match of a pattern at or behind a place; places ask in rising order, mostly."""

    def __init__(self, pattern: re.Pattern, page: str):
        self.pattern, self.page, self.known = pattern, page, (0, -1)

    def __call__(self, at: int) -> int:
        low, found = self.known
        if not low <= at <= found:
            match = self.pattern.search(self.page, at)
            found = match.start() if match else len(self.page)
            self.known = (at, found)
        return found


class Tags:
    """Where tags end.  Each quote is looked at once on the way to failure, so the work is linear."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.name_end, self.special = _Ahead(_NAME_ENDS, page), _Ahead(_QUOTE_OR_END, page)
        self.dead: set[int] = set()  # quotes behind which no tag ends

    def read(self, at: int) -> tuple[str, int, int] | None:
        """Name, start of the attributes and the closing ``>`` of the tag that begins at ``at``, if it does."""
        begin = at + 2 if self.page.startswith("/", at + 1) else at + 1
        if at > self.last or not (self.page[begin : begin + 1].isascii() and self.page[begin : begin + 1].isalpha()):
            return None
        behind = self.name_end(begin)
        passed, k = [], behind
        while True:
            k = self.special(k)
            if k >= len(self.page) or k in self.dead:
                break
            if self.page[k] == ">":
                return self.page[begin:behind], behind, k
            passed.append(k)
            k = self.page.find(self.page[k], k + 1) + 1
            if k == 0:
                break
        self.dead.update(passed)
        return None


def build(page: str) -> Node:
    """The tree of a page."""
    root = Node("html")
    open_nodes = [root]
    places: defaultdict[str, list[int]] = defaultdict(list)  # of the open nodes, by tag

    def push(node: Node) -> None:
        places[node.tag].append(len(open_nodes))
        open_nodes.append(node)

    def drop_from(k: int) -> None:
        for node in open_nodes[k:]:
            places[node.tag].pop()
        del open_nodes[k:]

    def nearest(names) -> int:
        """Place of the innermost open node of these names; 0 for none."""
        return max((places[name][-1] for name in names if places[name]), default=0)

    def close(names, bound) -> None:
        """Ends the open nodes of these names inside the innermost bound, and all that stands in them."""
        wall = nearest(bound)
        inside = [p[k] for p in map(places.__getitem__, names) if (k := bisect.bisect_right(p, wall)) < len(p)]
        if inside:
            drop_from(min(inside))

    def place(child: Node | str) -> None:
        """Into the open node; what may not stand between cells goes in front of their table."""
        loose = child.strip() if isinstance(child, str) else child.tag not in _TABLE_PARTS
        if loose and open_nodes[-1].tag in _BETWEEN_CELLS and places["table"]:
            open_nodes[places["table"][-1] - 1].children.insert(-1, child)
        else:
            open_nodes[-1].children.append(child)

    def end_head() -> None:
        if places["head"] and not places["template"]:
            close({"head"}, {"html"})

    def put_text(text: str) -> None:
        if text.strip(" \t\r\n\f"):
            end_head()
        if text:
            place(html.unescape(text))

    tags, text_from, at = Tags(page), 0, page.find("<")
    while at >= 0:
        if page.startswith(("<!", "<?"), at):
            put_text(page[text_from:at])
            ends = page.find("-->", at + 4) + 2 if page.startswith("<!--", at) else page.find(">", at)
            text_from = len(page) if ends < at else ends + 1
            at = page.find("<", text_from)
            continue
        found = tags.read(at)
        if found is None:  # no tag but text
            at = page.find("<", at + 1)
            continue
        put_text(page[text_from:at])
        name, behind, ends = found
        ending, tag, inner = page.startswith("/", at + 1), name.lower(), page[behind:ends]
        text_from = ends + 1
        if ending:
            if tag == "br":
                end_head()
                place(Node("br"))
            mine, wall = nearest((tag,)), nearest(WALLS)
            if mine and (mine >= wall or tag in ("table", "tr", "tbody", "thead", "tfoot")):
                drop_from(mine)
            at = page.find("<", text_from)
            continue
        if tag not in IN_HEAD:
            end_head()
        if tag in CLOSES:
            close(*CLOSES[tag])
        if tag in ENDS_PARAGRAPH:
            close({"p"}, WALLS | {"button", "li", "dd", "dt", "div", "blockquote"})
        if tag == "table" and open_nodes[-1].tag in _BETWEEN_CELLS:
            close({"table"}, WALLS - {"table"})  # a table between cells begins after the open one
        if tag in ("td", "th") and open_nodes[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr")
            open_nodes[-1].children.append(row)
            push(row)
        node = Node(tag, _attributes(inner) if inner else {})
        place(node)
        if tag in RAW:
            close_at = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?|$(?![\r\n])", re.I).search(page, text_from)
            text = page[text_from : close_at.start()]
            node.children.append(html.unescape(text) if tag == "textarea" else text)
            text_from = close_at.end()
        elif tag not in VOID and (not inner.rstrip().endswith("/") or tag in BLOCKS):
            push(node)
        at = page.find("<", text_from)
    put_text(page[text_from:])
    return root


class Lines:
    """Output lines with the blank lines owed between blocks."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.blank_owed = False
        self.lead: list[str] = []  # marks of the open list items, each used once, then blanks
        self.marks = 0  # how many of them, the innermost ones, are still to be used

    def text(self, text: str) -> None:
        if not text:
            return
        if text[0] == " " and (not self.current or self.current[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.current.append(text)

    def _put(self, line: str) -> None:
        if self.blank_owed and self.lines:
            self.lines.append("")
        self.blank_owed = False
        lead = "".join(self.lead[-DEEPEST:])
        for k in range(len(self.lead) - self.marks, len(self.lead)):
            self.lead[k] = " " * len(self.lead[k])
        self.marks = 0
        self.lines.append((lead + line).rstrip())

    def end_line(self, always: bool = False) -> None:
        line = "".join(self.current).strip(" ")
        self.current = []
        if line or always:
            self._put(line)

    def space(self) -> None:
        self.end_line()
        self.blank_owed = True

    def verbatim(self, text: str) -> None:
        for line in text.split("\n"):
            self._put(line)

    def result(self) -> str:
        self.end_line()
        return "\n".join(self.lines).strip("\n")


@dataclass(slots=True)
class Cell:
    """A cell, how many columns and rows it covers, and whether its own text shows."""

    node: Node
    columns: int
    rows: int
    visible: bool
    lines: list[str] = field(default_factory=list)


def _span(attributes: dict[str, str], name: str, most: int) -> int | None:
    text = attributes.get(name, "1").strip()
    return min(int(text[:6]), most) if text.isascii() and text.isdigit() else None


def _rows(table: Node, visible: bool) -> list[list[list[Cell]]]:
    """Cells by row, in groups that no cell reaches out of; rows of inner tables are not among them."""
    groups: list[list[list[Cell]]] = []
    loose: list[list[Cell]] | None = None  # rows that stand in the table itself
    for part in table.children:
        if isinstance(part, str) or _hidden(part.tag, part.attributes):
            continue
        if part.tag == "tr":
            if loose is None:
                loose = []
                groups.append(loose)
            group, rows, shown = loose, [part], visible
        elif part.tag in ("thead", "tbody", "tfoot"):
            group, loose = [], None
            groups.append(group)
            rows = [r for r in part.children if isinstance(r, Node) and r.tag == "tr"]
            shown = _visible(part.attributes, visible)
        else:
            continue
        for row in rows:
            if _hidden(row.tag, row.attributes):
                continue
            of_row = _visible(row.attributes, shown)
            cells = [c for c in row.children if isinstance(c, Node) and c.tag in ("td", "th")]
            group.append(
                [
                    # The most columns and rows that browsers let a cell cover; no rows
                    # means all that follow in the group.
                    Cell(
                        c,
                        _span(c.attributes, "colspan", 1000) or 1,
                        {None: 1, 0: 65534}.get(n := _span(c.attributes, "rowspan", 65534), n),
                        _visible(c.attributes, of_row),
                    )
                    for c in cells
                    if not _hidden(c.tag, c.attributes)
                ]
            )
    return groups


def _width(text: str) -> int:
    """Columns of a terminal that a text takes: wide characters two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text
    )


def _aligned(groups: list[list[list[Cell]]]) -> list[str]:
    """Rows of cells as lines with aligned columns; a cell over several columns widens none."""
    placed: list[list[tuple[int, Cell | None]]] = []
    widths: dict[int, int] = {}
    for group in groups:
        taken: dict[int, int] = {}  # rows that a column is still covered for, from a cell above
        for row in group:
            at, cells, below = 0, [], {k: n - 1 for k, n in taken.items() if n > 1}
            for cell in row:
                while at in taken:
                    cells.append((at, None))
                    at += 1
                cells.append((at, cell))
                if cell.columns == 1:
                    widths[at] = max([widths.get(at, 0), *map(_width, cell.lines)])
                for k in range(at, at + cell.columns) if cell.rows > 1 else ():
                    below[k] = cell.rows - 1
                at += cell.columns
            placed.append(cells)
            taken = below
    out = []
    for cells in placed:
        for k in range(max([1, *[len(cell.lines) for _, cell in cells if cell]])):
            parts = []
            for at, cell in cells:
                over = cell.columns if cell else 1
                room = sum(widths.get(c, 0) for c in range(at, at + over)) + 3 * (over - 1)
                text = cell.lines[k] if cell and k < len(cell.lines) else ""
                parts.append(text + " " * (room - _width(text)))
            out.append(" | ".join(parts).rstrip())
    return out


def render(root: Node) -> str:
    """The layout of a tree; a table is laid out after its cells, innermost first."""
    out, outputs = Lines(), []
    pre, visible = 0, True
    waiting: list[tuple] = [("open", root, None)]
    while waiting:
        what, node, extra = waiting.pop()
        if what == "text":
            if pre:
                parts = node.split("\n")
                for part in parts[:-1]:
                    out.current.append(part)
                    out._put("".join(out.current))
                    out.current = []
                out.current.append(parts[-1])
            else:
                out.text(_BLANKS.sub(" ", node))
        elif what == "visible":
            visible = extra
        elif what == "cell":
            # A cell's output so far becomes the lines of its place in the row, without empty ones.
            extra.lines = [line for line in out.result().split("\n") if line.strip()]
            out = outputs.pop()
        elif what == "table":
            out.space()
            for line in _aligned(extra):
                if line.strip(" |"):
                    out.verbatim(line)
            out.space()
        elif what == "close":
            tag = node.tag
            if tag == "pre":
                if out.current:
                    out._put("".join(out.current))
                    out.current = []
                pre -= 1
                out.space()
            elif tag == "li":
                out.end_line()
                out.lead.pop()
                out.marks = max(0, out.marks - 1)
            elif tag in SPACED:
                out.end_line() if extra else out.space()
            elif tag in BLOCKS or tag in _ROW_PARTS:
                out.end_line()
        elif isinstance(node, str):
            if visible:
                waiting.append(("text", node, None))
        elif what == "start":
            outputs.append(out)
            out = Lines()
            waiting += [("visible", None, visible), ("cell", None, extra)]
            visible = extra.visible
            waiting += [("open", c, None) for c in reversed(node.children)]
        elif _hidden(node.tag, node.attributes):
            continue
        elif node.tag == "br":
            out.end_line(always=True)
        elif node.tag == "hr":
            out.space()
            if visible:
                out.verbatim("---")
            out.space()
        elif node.tag == "input":
            continue
        elif node.tag == "table" and len(outputs) < DEEPEST:
            waiting.append(("visible", None, visible))
            visible = _visible(node.attributes, visible)
            groups = _rows(node, visible)
            captions = [c for c in node.children if isinstance(c, Node) and c.tag == "caption"]
            out.space()
            waiting.append(("table", None, groups))
            waiting += [
                ("start", cell.node, cell) for group in reversed(groups) for row in reversed(group) for cell in reversed(row)
            ]
            waiting += [("open", c, None) for c in reversed(captions)]
        else:
            tag, inner, children = node.tag, None, node.children
            waiting.append(("visible", None, visible))
            visible = _visible(node.attributes, visible)
            if tag == "pre":
                out.space()
                pre += 1
            elif tag == "li":
                out.end_line()
                number = node.attributes.get("mark")
                out.lead.append(f"{number}. " if number else "- ")
                out.marks += 1
            elif tag in ("ul", "ol", "menu", "dir"):
                inner = bool(out.lead)
                out.end_line() if inner else out.space()
                if tag == "ol":
                    at = _number(node.attributes.get("start"), 1)
                    for child in children:
                        if isinstance(child, Node) and child.tag == "li":
                            at = _number(child.attributes.get("value"), at)
                            child.attributes = {**child.attributes, "mark": str(at)}
                            at += 1
            elif tag in SPACED:
                out.space()
            elif tag in BLOCKS or tag in _ROW_PARTS:
                out.end_line()
            if tag == "details" and "open" not in node.attributes:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            waiting.append(("close", node, inner))
            waiting += [("open", c, None) for c in reversed(children)]
    return out.result()


def _number(text: str | None, otherwise: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*[-+]?[0-9]{1,9}\s*", text) else otherwise


def page_text(page: str | None) -> str | None:
    return None if page is None else render(build(page))


def extract(page: Column | str) -> Column:
    """The visible text of a column of pages."""

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([page_text(p.as_py()) for p in pages], pa.string())

    return extracted(page)
