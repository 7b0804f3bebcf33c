"""Layout-aware rendering of HTML: a small tree builder, then a walk that writes text.

The builder supplies implied end tags; the walk leaves out what a browser would
not show and writes the rest as text: a blank line between blocks, bullets and
numbers for lists, and tables with their cells aligned in columns, after row and
column spans. Time and output are linear in the page: tags are scanned once, the
builder knows the places of open elements by name, and a table whose spans or
widths would need far more blanks than it has text is written without them.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements by what the standard says of them.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist input annotation annotation-xml mphantom".split())
#: Of a drawing, the text elements show, and none of these.
UNDRAWN = frozenset("defs symbol clippath mask pattern marker metadata desc title script style".split())
#: The operands of these elements of a formula stand apart.
FORMULA_PARTS = frozenset("mfrac mroot msub msup msubsup munder mover munderover mmultiscripts mtable mtr mlabeledtr".split())
#: Tags that end an open drawing or formula, as far up as a place that holds HTML.
BREAKOUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
HTML_INSIDE = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table ul caption".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr article section".split())
CLOSES_P = BLOCK - frozenset("body html dd dt li legend caption".split())
#: An opening tag ends the open elements named, as far up as a boundary.
IMPLIED_END: dict[str, tuple[frozenset[str], frozenset[str]]] = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir table".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table"])),
    "tr": (frozenset("tr td th caption colgroup".split()), frozenset(["table"])),
    "td": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th"]), frozenset(["table", "tr"])),
    "thead": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tbody": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "tfoot": (frozenset("thead tbody tfoot tr td th caption colgroup".split()), frozenset(["table"])),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select", "datalist"])),
    "rt": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
    "rp": (frozenset(["rt", "rp"]), frozenset(["ruby"])),
}
#: An end tag never reaches beyond these.
SCOPE = frozenset("table td th caption html template".split())

#: End tags of these reach beyond an open cell.
TABLE_PARTS = frozenset("table tr thead tbody tfoot".split())
CELLS = frozenset("td th caption".split())
IN_HEAD = frozenset("head title meta link base script style template noscript".split())
#: Limits of layout, never of text: columns of indentation, and tables within tables that get columns of their own.
MAX_INDENT = 64
MAX_TABLES = 16

_OPEN = re.compile(r"<(?:(/?)([a-zA-Z][^\s/>\x00]*)|(!--)|[!?]|/(?=[^a-zA-Z]))")
_NAME = re.compile(r"[\s/]*+([^\s/>][^\s/>=]*+)?(\s*+=\s*+)?")
_BARE = re.compile(r"[^\s>]*+")
_COMMENT_END = re.compile(r"--!?>")
_STYLE = re.compile(r"(?:^|;)\s*+(display|visibility)\s*+:\s*+([a-z-]+)", re.IGNORECASE)
_LONG_NUMBER = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{8,});?")
_SPACES = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    #: Names and values as written; the first of a name counts.
    attributes: list[tuple[str, str]] = field(default_factory=list)
    children: list[Node | str] = field(default_factory=list)


def unescape(text: str) -> str:
    """Character references resolved; a number beyond all code points gives U+FFFD."""
    return html.unescape(_LONG_NUMBER.sub("\ufffd", text)) if "&" in text else text


def attributes_of(node: Node) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in node.attributes:
        out.setdefault(name.lower(), unescape(value))
    return out


def scan_attributes(source: str, at: int, absent: set[str]) -> tuple[int, list[tuple[str, str]]] | None:
    """The place after a tag's ``>`` and its attributes; None if the page ends in the tag.

    A quotation mark that is never closed is part of a value without quotes;
    ``absent`` holds the marks known not to come again.
    """
    found: list[tuple[str, str]] = []
    while True:
        m = _NAME.match(source, at)
        at = m.end()
        if at >= len(source):
            return None
        name, equals = m.groups()
        if name is None:
            return at + 1, found
        value = ""
        if equals:
            quote = source[at]
            stop = source.find(quote, at + 1) if quote in "\"'" and quote not in absent else -1
            if stop >= 0:
                value = source[at + 1 : stop]
                at = stop + 1
            else:
                if quote in "\"'":
                    absent.add(quote)
                bare = _BARE.match(source, at)
                value = bare[0]
                at = bare.end()
        found.append((name, value))


class _Stack:
    """Open elements, with the places of each name, so that no search walks the stack."""

    def __init__(self, root: Node) -> None:
        self.nodes = [root]
        self.places: dict[str, list[int]] = {}

    def push(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self.nodes))
        self.nodes.append(node)

    def innermost(self, names: frozenset[str]) -> int:
        """Place of the innermost open element of these names; 0 without one."""
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=0)

    def cut(self, place: int) -> None:
        while len(self.nodes) > place:
            self.places[self.nodes.pop().tag].pop()

    def close(self, names: frozenset[str], boundary: frozenset[str]) -> None:
        """End the open elements of these names, as far up as the boundary."""
        while (place := self.innermost(names)) > self.innermost(boundary):
            self.cut(place)

    def end(self, name: str) -> None:
        """An end tag: ends the innermost element of the name unless a scope lies between."""
        place = self.innermost(frozenset([name]))
        if place and place >= self.innermost(SCOPE - CELLS if name in TABLE_PARTS else SCOPE):
            self.cut(place)


def build_tree(source: str) -> Node:
    """The element tree; unknown tags are elements, stray end tags are dropped.

    As in a browser, a tag or comment that the page's end cuts off is dropped.
    """
    root = Node("#root")
    stack = _Stack(root)
    absent: set[str] = set()
    raw_ends: dict[str, re.Pattern[str]] = {}
    at = 0
    foreign = False
    while m := _OPEN.search(source, at):
        if m.start() > at:
            stack.nodes[-1].children.append(unescape(source[at : m.start()]))
        at = m.end()
        end, name, comment = m.groups()
        if comment:
            brief = next((x for x in (">", "->") if source.startswith(x, at)), None)
            stop = None if brief else _COMMENT_END.search(source, at)
            at = at + len(brief) if brief else stop.end() if stop else len(source)
            continue
        if not name:
            at = source.find(">", at) + 1 or len(source)
            continue
        if source.startswith(">", at):
            at, attributes = at + 1, []
        elif scanned := scan_attributes(source, at, absent):
            at, attributes = scanned
        else:
            at = len(source)
            break
        name = name.lower()
        if end:
            stack.end(name)
            continue
        if foreign and name in BREAKOUT:
            stack.close(frozenset(["svg", "math"]), HTML_INSIDE)
        foreign = foreign or name in ("svg", "math")
        if name in CLOSES_P:
            stack.close(frozenset(["p"]), SCOPE | {"button", "li", "dd", "dt"})
        if name in IMPLIED_END:
            stack.close(*IMPLIED_END[name])
        if name not in IN_HEAD and stack.places.get("head"):
            stack.close(frozenset(["head"]), frozenset())
        node = Node(name, attributes)
        stack.nodes[-1].children.append(node)
        if name in VOID or source[at - 2] == "/" and name not in BLOCK:
            continue
        if name in RAW:
            stop = raw_ends.setdefault(name, re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.IGNORECASE)).search(source, at)
            body = source[at : stop.start() if stop else len(source)]
            node.children.append(unescape(body) if name == "textarea" else body)
            at = source.find(">", stop.end()) + 1 or len(source) if stop else len(source)
            continue
        stack.push(node)
    if at < len(source):
        stack.nodes[-1].children.append(unescape(source[at:]))
    return root


_STATE_NAMES = frozenset(["hidden", "style", "display", "visibility", "popover", "open"])


def visibility(node: Node, drawn: bool = False) -> str:
    """``gone`` with all it holds, ``hidden`` or ``visible`` by its own word, or empty: as what holds it.

    What is hidden from assistive tools only (``aria-hidden``) is visible.
    """
    if node.tag in UNSEEN or drawn and node.tag in UNDRAWN:
        return "gone"
    if not any(name.lower() in _STATE_NAMES for name, _ in node.attributes):
        return "gone" if node.tag == "dialog" else ""
    a = attributes_of(node)
    style = {k.lower(): v.lower() for k, v in _STYLE.findall(a.get("style", ""))}
    display = style.get("display") or (a.get("display", "") if drawn else "")
    if display == "none" or not display and ("hidden" in a and a["hidden"].lower() != "until-found" or "popover" in a):
        return "gone"
    if node.tag == "dialog" and "open" not in a and not display:
        return "gone"
    seen = style.get("visibility") or (a.get("visibility", "") if drawn else "")
    return {"hidden": "hidden", "collapse": "hidden", "visible": "visible"}.get(seen, "")


def _hidden(node: Node) -> bool:
    return visibility(node) in ("gone", "hidden")


def shown_children(node: Node) -> list[Node | str]:
    """All children; of closed details the first summary alone."""
    if node.tag != "details" or any(name.lower() == "open" for name, _ in node.attributes):
        return node.children
    return [c for c in node.children if isinstance(c, Node) and c.tag == "summary"][:1]


def _text_of(node: Node) -> str:
    out, rest = [], [node]
    while rest:
        x = rest.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            rest += [c for c in reversed(x.children) if isinstance(c, str) or not _hidden(c)]
    return _SPACES.sub(" ", "".join(out)).strip()


def shown_options(select: Node) -> list[str]:
    """What a choice shows: a list all its options, with their groups' labels, else the selected one."""
    a = attributes_of(select)
    listed = "multiple" in a or a.get("size", "").isdigit() and int(a["size"]) > 1
    # (label, may be chosen, is selected)
    found: list[tuple[str, bool, bool]] = []
    rest = [(c, False) for c in reversed(select.children)]
    while rest:
        x, disabled = rest.pop()
        if isinstance(x, str) or _hidden(x):
            continue
        b = attributes_of(x)
        off = disabled or "disabled" in b
        if x.tag == "option":
            found.append((b.get("label") or _text_of(x), not off, "selected" in b))
            continue
        if x.tag == "optgroup" and listed and b.get("label"):
            found.append((b["label"], False, False))
        rest += [(c, off) for c in reversed(x.children)]
    if listed:
        return [label for label, _, _ in found if label]
    chosen = [f for f in found if f[2]][-1:] or [f for f in found if f[1]][:1]
    return [label for label, _, _ in chosen if label]


class _Writer:
    """Lines of text; collapses white space and holds back blank lines until text follows."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0
        self.indent = 0
        self.mark = ""

    def text(self, value: str, keep: bool = False) -> None:
        if keep:
            first, *more = value.replace("\r\n", "\n").split("\n")
            self._put(first)
            for line in more:
                self._end(always=True)
                self._put(line)
            return
        body = _SPACES.sub(" ", value)
        if body.startswith(" "):
            self.space = self.space or bool(self.line)
            body = body[1:]
        if not body:
            return
        ends = body.endswith(" ")
        self._put((" " if self.space and self.line else "") + (body[:-1] if ends else body))
        self.space = ends

    def _put(self, value: str) -> None:
        if value:
            self.line.append(value)

    def _end(self, always: bool = False) -> None:
        if self.line or always:
            if self.lines and self.gap:
                self.lines.append("")
            self.gap = 0
            self.lines.append(" " * min(self.indent - len(self.mark), MAX_INDENT) + self.mark + "".join(self.line))
            self.mark = ""
            self.line = []
        self.space = False

    def block(self, spaced: bool) -> None:
        self._end()
        self.gap = self.gap or int(spaced)

    def line_break(self) -> None:
        self._end(always=bool(self.line))

    def rows(self, lines: list[str]) -> None:
        for line in lines:
            self.line = [line]
            self._end()

    def written(self) -> list[str]:
        """The lines, without blank ones at either end."""
        self._end()
        return "\n".join(line.rstrip() for line in self.lines).strip("\n").split("\n")


@dataclass
class Cell:
    lines: list[str]
    across: int = 1
    down: int = 1


def span_of(value: str, most: int) -> int:
    """A span as the standard reads it: 1 if it is no number, at most ``most``."""
    return min(int(value[:9]), most) if value.isascii() and value.isdigit() else 1


def placed(rows: list[list[Cell]]) -> list[dict[int, Cell]] | None:
    """Each row's cells by column; None if spans take far more places than there are cells."""
    spare = 64 * sum(map(len, rows)) + 256
    free_again: dict[int, int] = {}
    out: list[dict[int, Cell]] = []
    for y, row in enumerate(rows):
        x, line = 0, {}
        for cell in row:
            while free_again.get(x, 0) > y:
                x += 1
                spare -= 1
            spare -= cell.across
            if spare < 0:
                return None
            line[x] = cell
            if cell.down > 1:
                free_again.update((c, max(y + cell.down, free_again.get(c, 0))) for c in range(x, x + cell.across))
            x += cell.across
        out.append(line)
    return out


def table_lines(rows: list[list[Cell]]) -> list[str]:
    """A table as lines: cells stand side by side, in columns as wide as their widest cell.

    A row with a cell that has blank lines inside (paragraphs, headings, lists)
    is layout: its cells follow one another, with blank lines between. A table
    whose blanks would exceed its text far is written without them.
    """
    grid = placed(rows)
    wide = grid is None
    grid = [dict(enumerate(row)) for row in rows] if grid is None else grid
    # only the columns up to a row's last cell with text are written
    grid = [{x: c for x, c in row.items() if any(c.lines)} for row in grid]
    layout = [any("" in c.lines for c in row.values()) for row in grid]
    width = [0] * (1 + max((x for row in grid for x in row), default=0))
    for row, apart in zip(grid, layout, strict=True):
        for x, c in row.items():
            if not apart and (c.across == 1 or x == max(row)):
                width[x] = max(width[x], 0 if c.across > 1 else max(map(len, c.lines)))
    before = [0, *accumulate(w + 3 for w in width)]
    text = sum(len(t) - t.count(" ") - t.count("|") for row in grid for c in row.values() for t in c.lines)
    blanks = sum(before[max(row)] * max(len(c.lines) for c in row.values()) for row in grid if row)
    wide = wide or blanks > 16 * text + 1024
    out: list[str] = []
    for row, apart in zip(grid, layout, strict=True):
        if not row:
            continue
        height = max(len(c.lines) for c in row.values())
        if apart or wide and height > 1:
            for _, cell in sorted(row.items()):
                out += [*([""] if out and out[-1] else []), *cell.lines, ""]
        elif wide:
            out.append(" | ".join(c.lines[0] for _, c in sorted(row.items())))
        else:
            for y in range(height):
                parts = [row[x].lines[y] if x in row and y < len(row[x].lines) else "" for x in range(max(row) + 1)]
                out.append(" | ".join(p.ljust(width[x]) for x, p in enumerate(parts)).rstrip())
    return out[:-1] if out and not out[-1] else out


def render(source: str) -> tuple[str, int, int]:
    """Visible text of a page, and how many list items and tables it shows."""
    out = _Writer()
    writers, lists, marks = [out], [], []
    # rows of each open table; None for one that lies too deep for columns of its own
    tables: list[list[list[Cell]] | None] = []
    items = shown = 0
    pre = 0
    # for each frame: inside a drawing, inside a text of it, or neither
    places = [""]
    # for each frame: whether its text is hidden
    unseen = [False]
    # a frame is a node with an iterator over its children; no recursion, so depth costs no call stack
    frames: list[tuple[Node, Iterator[Node | str]]] = [(tree := build_tree(source), iter(tree.children))]
    while frames:
        node, children = frames[-1]
        child = next(children, None)
        out = writers[-1]
        if isinstance(child, str):
            if unseen[-1]:
                continue
            if node.tag == "textarea":
                out.text(child.removeprefix("\r").removeprefix("\n"), keep=True)
            elif places[-1] != "drawing" and not (node.tag in ("table", "tr", "thead", "tbody", "tfoot", "colgroup") and not child.strip()):
                out.text(child, keep=pre > 0)
            continue
        if child is None:
            frames.pop()
            place = places.pop()
            unseen.pop()
            tag = node.tag
            if tag == "textarea":
                out.block(False)
            elif tag == "text" and place == "label" or tag == "svg" or node.tag in FORMULA_PARTS:
                out.text(" ")
            if tag in ("td", "th") and tables and tables[-1] is not None:
                a = attributes_of(node)
                cell = Cell(writers.pop().written(), max(1, span_of(a.get("colspan", "1"), 1000)), span_of(a.get("rowspan", "1"), 65534) or 65534)
                if not tables[-1]:
                    tables[-1].append([])
                tables[-1][-1].append(cell)
            elif tag == "table":
                lines = table_lines(tables.pop() or [])
                shown += bool(lines)
                out.block(True)
                out.rows(lines)
                out.block(True)
            elif tag in ("ul", "ol", "menu", "dir"):
                lists.pop()
                out.block(not lists)
            elif tag == "li":
                out.block(False)
                if marks:
                    out.indent -= marks.pop()
                out.mark = ""
            elif tag in ("blockquote", "dd"):
                out.block(tag in SPACED)
                out.indent -= 4
            elif tag in BLOCK:
                out.block(tag in SPACED)
            pre -= tag == "pre"
            continue
        state = visibility(child, bool(places[-1]))
        if state == "gone":
            continue
        tag = child.tag
        hidden = state == "hidden" or not state and unseen[-1]
        place = "drawing" if tag == "svg" else "label" if tag == "text" and places[-1] == "drawing" else "" if tag == "foreignobject" else places[-1]
        if tag == "select":
            for label in [] if hidden else shown_options(child):
                out.text(f" {label} ")
            continue
        if tag == "textarea":
            out.block(False)
        elif tag == "svg" or tag == "text" and place == "label" or node.tag in FORMULA_PARTS:
            out.text(" ")
        if tag == "br":
            out.line_break()
            continue
        if tag in ("td", "th") and tables:
            if tables[-1] is not None:
                writers.append(_Writer())
            else:
                out.block(False)
        elif tag == "tr" and tables:
            if tables[-1] is not None:
                tables[-1].append([])
        elif tag == "table":
            out.block(True)
            tables.append([] if len(tables) < MAX_TABLES else None)
        elif tag in ("ul", "ol", "menu", "dir"):
            out.block(not lists)
            start = attributes_of(child).get("start", "1") if tag == "ol" and child.attributes else "1"
            lists.append([tag, int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
        elif tag == "li":
            items += not hidden
            out.block(False)
            out.mark = f"{lists[-1][1]}. " if lists and lists[-1][0] == "ol" else "- "
            out.indent += len(out.mark)
            marks.append(len(out.mark))
            if hidden:
                out.mark = ""
            if lists:
                lists[-1][1] += 1
        elif tag in ("blockquote", "dd"):
            out.block(tag in SPACED)
            out.indent += 4
        elif tag in BLOCK:
            out.block(tag in SPACED)
        pre += tag == "pre"
        if tag not in VOID:
            frames.append((child, iter(shown_children(child))))
            places.append(place)
            unseen.append(hidden)
    return "\n".join(writers[0].written()), items, shown


def extract_text(pages: DataFrame, id_column: str = "page_id", html_column: str = "html") -> DataFrame:
    """``(page_id, text, n_items, n_tables)`` for every row of ``pages``.

    ``text`` is all visible text; a null or empty page gives an empty one, and an
    empty table no rows. Rows that repeat are rendered each; other columns are
    not read. Long and hostile pages take time in proportion to their length.
    """
    schema = "page_id long, text string, n_items long, n_tables long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [render(t.as_py() or "") for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.int64()), pa.array([m[2] for m in made], pa.int64())], ["page_id", "text", "n_items", "n_tables"])

    return pages.select(F.col(id_column).cast("long"), F.col(html_column).cast("string")).mapInArrow(run, schema)
