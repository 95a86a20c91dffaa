"""Layout-aware text of HTML pages.

A tree builder reads the markup, closes elements that HTML lets authors leave
open, and drops what a browser would not show.  The renderer walks the tree and
keeps the layout: blocks on lines of their own, blank lines between paragraphs,
list marks and indentation, preformatted text, and tables with aligned cells.
Pages are independent, so Spark maps the function over batches of rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Fixed values of HTML: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template title noscript noembed noframes iframe object canvas audio video datalist param source "
    "track meta link base area rp colgroup col".split()
)
#: The same inside SVG and MathML.
HIDDEN_FOREIGN = frozenset(
    "desc defs metadata symbol clippath mask pattern lineargradient radialgradient filter marker annotation annotation-xml mphantom".split()
)
#: Elements of SVG and MathML that hold HTML, and HTML start tags that end SVG and MathML elsewhere.
HOLDS_HTML = frozenset("foreignobject desc mi mo mn ms mtext annotation-xml".split())
LEAVES_FOREIGN = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p "
    "pre ruby s small span strong strike sub sup table tt u ul var".split()
)
#: Blocks with a blank line before and after, and blocks on lines of their own.
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl table figure fieldset hr".split())
BLOCK = SPACED | frozenset(
    "html body div section article aside header footer nav main address form li dt dd details summary dialog figcaption legend "
    "caption tr td th thead tbody tfoot center menu dir optgroup option hgroup search".split()
)
#: A start tag ends these open elements, up to the elements that shield them.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "caption", "colgroup"}, {"table"}),
    "body": ({"head"}, set()),
}
_ENDS_P = BLOCK - {"html", "body", "option", "optgroup", "tr", "td", "th", "thead", "tbody", "tfoot", "caption"}
#: Elements that an unmatched end tag inside them can't close past.
_SCOPES = frozenset({"table", "td", "th", "caption", "html"})
#: Elements deeper than this are siblings of the deepest ones, as browsers limit depth as well.
MAX_DEPTH = 256

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(?P<end>/)?(?P<tag>[A-Za-z][^\s/>\x00]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S
)
#: What ends without ">": comments and declarations up to the end of the page.
_OPEN = re.compile(r"<[!?].*(?P<tag>(?!))?", re.S)
_ATTR = re.compile(r"([^\s=>\"'/]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_INVISIBLE = re.compile(r"(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))", re.I)
_BLANKS = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "children", "kind")

    def __init__(self, tag: str, attrs: dict[str, str], kind: str = ""):
        self.tag, self.attrs, self.children = tag, attrs, []
        self.kind = kind  # math, svg, text (in an SVG text), or HTML


def _attributes(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTR.findall(source):
        out.setdefault(name.lower(), unescape(value.strip("\"'")) if value else "")
    return out


def parse(html: str) -> Node:
    """The element tree of a page; texts are strings among the children."""
    root = Node("html", {})
    stack = [root]
    at, n = 0, len(html)
    last = html.rfind(">")  # no tag begins after it
    while at < n:
        m = (_TOKEN if at <= last else _OPEN).search(html, at)
        if m is None:
            stack[-1].children.append(unescape(html[at:]))
            break
        if m.start() > at:
            stack[-1].children.append(unescape(html[at : m.start()]))
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if m["end"]:
            _end(stack, tag)
            continue
        node = _start(stack, tag, m["attrs"])
        if tag in RAW and not (node.kind and m["attrs"].endswith("/")):
            close = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            body = html[at : close.start() if close else n]
            node.children.append(unescape(body) if tag in ("textarea", "title") else body)
            at = close.end() if close else n
            if stack[-1] is node:
                stack.pop()
    return root


def _kind(parent: Node, tag: str) -> str:
    """The kind of an element ``tag`` in ``parent``."""
    if tag in ("svg", "math"):
        return tag
    if not parent.kind or parent.tag in HOLDS_HTML:
        return ""
    return "text" if parent.kind == "svg" and tag == "text" else parent.kind


def _start(stack: list[Node], tag: str, source: str) -> Node:
    if tag in LEAVES_FOREIGN:
        while _kind(stack[-1], tag):
            stack.pop()
    if kind := _kind(stack[-1], tag):
        node = Node(tag, _attributes(source), kind)
        stack[-1].children.append(node)
        if not source.endswith("/") and len(stack) < MAX_DEPTH:
            stack.append(node)
        return node
    if tag in _ENDS_P:
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "p":
                del stack[k:]
                break
            if stack[k].tag in _SCOPES or stack[k].tag == "button":
                break
    if tag in CLOSES:
        closed, shields = CLOSES[tag]
        low = len(stack)
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag in shields:
                break
            if stack[k].tag in closed:
                low = k
        del stack[low:]
    if tag == "a":  # no links in links
        for k in range(len(stack) - 1, 0, -1):
            if stack[k].tag == "a":
                del stack[k:]
                break
            if stack[k].tag in BLOCK:
                break
    if tag in ("td", "th"):  # a row is implied
        for k in range(len(stack) - 1, -1, -1):
            if stack[k].tag in ("tr", "td", "th"):
                break
            if stack[k].tag in ("table", "thead", "tbody", "tfoot"):
                row = Node("tr", {})
                stack[k].children.append(row)
                stack[k + 1 :] = [row]
                break
    node = Node(tag, _attributes(source) if source.strip("/ \t\n\r\f") else {})
    stack[-1].children.append(node)
    if tag not in VOID and len(stack) < MAX_DEPTH:
        stack.append(node)
    return node


def _end(stack: list[Node], tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br", {}))
        return
    for k in range(len(stack) - 1, 0, -1):
        if stack[k].tag == tag:
            del stack[k:]
            return
        if stack[k].tag in _SCOPES and tag not in CLOSES and tag != "table":
            return


def visible(node: Node) -> bool:
    if node.tag in HIDDEN or "hidden" in node.attrs:
        return False
    if node.kind and (node.tag in HIDDEN_FOREIGN or node.attrs.get("display") == "none" or node.attrs.get("visibility") in ("hidden", "collapse")):
        return False
    if node.tag == "dialog" and "open" not in node.attrs:
        return False
    return not ("style" in node.attrs and _INVISIBLE.search(node.attrs["style"]))


def shown(node: Node) -> list[Node | str]:
    """The children; of details that are closed, the first summary only."""
    if node.tag != "details" or "open" in node.attrs:
        return node.children
    return [x for x in node.children if not isinstance(x, str) and x.tag == "summary"][:1]


class Flow:
    """Lines of one block; blanks collapse at the seams of inline texts."""

    def __init__(self, in_list: bool = False) -> None:
        self.in_list = in_list  # lists in lists stand without blank lines around
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = True  # the line so far ends with a blank, or is empty
        self.gap = False  # a blank line is due before the next text

    def text(self, s: str) -> None:
        s = _BLANKS.sub(" ", s)
        if self.space and s[:1] == " ":
            s = s[1:]
        if s:
            self.line.append(s)
            self.space = s[-1] == " "

    def end_line(self) -> None:
        s = "".join(self.line).strip(" ")
        self.line, self.space = [], True
        if s:
            self.put([s])

    def put(self, lines: list[str]) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines.extend(lines)

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap = self.gap or spaced

    def line_break(self) -> None:
        if self.line:
            self.end_line()
        elif self.lines and not self.gap and self.lines[-1]:
            self.put([""])


def render(node: Node, flow: Flow, pre: bool = False) -> None:
    for child in shown(node):
        if isinstance(child, str):
            if node.kind == "svg" and node.tag != "foreignobject":
                continue  # shown in text elements only
            if pre:
                first, *rest = child.split("\n")
                flow.line.append(first)
                for more in rest:
                    flow.put(["".join(flow.line).rstrip()])
                    flow.line = [more]
                flow.space = False
            else:
                flow.text(child)
            continue
        tag = child.tag
        if not visible(child):
            continue
        if child.kind:
            _foreign(child, flow, pre)
        elif tag == "br":
            flow.line_break()
        elif tag == "hr":
            flow.block(True)
            flow.put(["---"])
            flow.gap = True
        elif tag == "input":
            if child.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                flow.text(" " + child.attrs.get("value", "") + " ")
        elif tag in ("ul", "ol", "menu", "dir"):
            _list(child, flow, tag == "ol")
        elif tag == "table":
            flow.block(True)
            if lines := _table(child):
                flow.put(lines)
            flow.gap = True
        elif tag in BLOCK:
            flow.block(tag in SPACED)
            if tag in ("blockquote", "dd", "pre"):
                inner = Flow()
                render(child, inner, pre or tag == "pre")
                lines = _closed(inner, tag == "pre")
                if lines:
                    flow.put(lines if tag == "pre" else ["  " + x if x else x for x in lines])
            else:
                render(child, flow, pre)
            flow.block(tag in SPACED)
        else:
            render(child, flow, pre or tag == "textarea")


def _foreign(node: Node, flow: Flow, pre: bool) -> None:
    """SVG texts and MathML rows on lines of their own; parts that are placed apart, a blank apart."""
    own = node.tag in ("text", "foreignobject", "mtr", "mlabeledtr") or (node.tag == "math" and node.attrs.get("display") == "block")
    apart = node.tag in ("mtd", "mfrac") or (node.tag == "tspan" and not node.attrs.keys().isdisjoint(("x", "y", "dx", "dy")))
    if own:
        flow.block(False)
    if apart:
        flow.text(" ")
    if node.tag == "mfrac":
        for part in node.children:
            render(_only(part), flow, pre)
            flow.text(" ")
    else:
        render(node, flow, pre)
    if own:
        flow.block(False)


def _closed(flow: Flow, pre: bool = False) -> list[str]:
    if pre:
        flow.put(["".join(flow.line).rstrip()])
        flow.line = []
    flow.end_line()
    lines = flow.lines
    while lines and not lines[0]:
        lines = lines[1:]
    while lines and not lines[-1]:
        lines = lines[:-1]
    return lines


def _list(node: Node, flow: Flow, ordered: bool) -> None:
    flow.block(not flow.in_list)
    start = node.attrs.get("start", "1")
    number = int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1
    for child in node.children:
        if isinstance(child, str):
            flow.text(child)
            continue
        if not visible(child):
            continue
        inner = Flow(in_list=True)
        render(child if child.tag == "li" else _only(child), inner)
        flow.end_line()
        lines = _closed(inner)
        if child.tag != "li":
            if lines:
                flow.put(["  " + x if x else x for x in lines])
            continue
        mark = f"{number}. " if ordered else "- "
        number += 1
        if lines:
            flow.put([(mark if k == 0 else " " * len(mark)) + x if x else x for k, x in enumerate(lines)])
    flow.block(not flow.in_list)


def _only(node: Node | str) -> Node:
    holder = Node("div", {})
    holder.children = [node]
    return holder


def _rows(node: Node) -> Iterator[Node]:
    for child in node.children:
        if isinstance(child, str):
            if child.strip():
                yield _only(child)
        elif visible(child):
            if child.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(child)
            else:
                yield child if child.tag == "tr" else _only(child)


def _table(node: Node) -> list[str]:
    """Cells of a column start at the same place; columns are two blanks apart."""
    before, grid = [], []
    for row in _rows(node):
        if row.tag != "tr":  # captions, and what isn't in a row: shown before it
            inner = Flow()
            render(row, inner)
            before.extend(_closed(inner))
            continue
        cells = []
        for cell in row.children:
            if isinstance(cell, str) and not cell.strip():
                continue
            if isinstance(cell, Node) and not visible(cell):
                continue
            inner, holder = Flow(), cell
            if isinstance(cell, str) or cell.tag not in ("td", "th"):
                holder = Node("td", {})
                holder.children = [cell]
            render(holder, inner)
            cells.append(_closed(inner))
            span = holder.attrs.get("colspan", "")
            cells.extend([[]] * (min(int(span), 1000) - 1 if re.fullmatch(r"\d{1,4}", span) else 0))
        if any(cells):
            grid.append(cells)
    widths: list[int] = []
    for cells in grid:
        for k, cell in enumerate(cells):
            if k == len(widths):
                widths.append(0)
            if k + 1 < len(cells) and cell:  # the last cell of a row needs no padding
                widths[k] = max(widths[k], max(map(len, cell)))
    lines = list(before)
    for cells in grid:
        for k in range(max(map(len, cells))):
            parts = [(cell[k] if k < len(cell) else "").ljust(w) for cell, w in zip(cells, widths, strict=False)]
            lines.append("  ".join(parts).rstrip())
    return lines


def page_text(html: str | None) -> str:
    """All visible text of a page, of formulas and SVG too; empty for null, empty and invisible pages."""
    if not html:
        return ""
    flow = Flow()
    render(parse(html), flow)
    return "\n".join(_closed(flow))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text) of every row; repeated rows give equal rows, null pages an
    empty text, an empty table an empty result; other columns are ignored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                texts = [page_text(h.as_py()) for h in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], names=["page_id", "text"])

    return pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html")).mapInArrow(
        run, "page_id long, text string"
    )


def op3_query(pages: DataFrame) -> DataFrame:
    return extract(pages)
