"""HTML extraction by layout: a tree builder with implied tags, then a renderer that emits
all visible text with block spacing, lists and aligned table cells.

Rules:

* implied tags: blocks end an open paragraph; li, dt/dd, tr, td/th, option and table sections
  end their predecessors; an end tag closes what is open inside its element, and is ignored
  if its element is not open; open elements end with the page. Cells and rows outside a
  row or table get one.
* invisible: head, script, style, template, noscript, datalist and embedded content; the
  ``hidden`` attribute; ``display: none``; ``visibility: hidden`` (a descendant may be visible
  again); the body of closed ``details``; options of a select other than the chosen one.
* white space collapses, except in pre and textarea. ``br`` ends a line; blocks start on a
  new line; paragraphs, headings, lists, tables and the like stand between empty lines.
* list items start with '- ' or their number and are indented by depth. Table columns
  are padded to equal width and separated by two spaces; a cell may have several lines, and
  one that spans columns is written across them.

Pages are independent, so they are rendered where they are read, without any shuffle; the
walk over the tree keeps its own stack, so deeply nested pages do not fail.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element groups of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HIDDEN = frozenset(
    "head script style template noscript datalist iframe object video audio canvas noembed noframes title".split())
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table ul".split())
SPACED = frozenset("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul".split())
ENDS_PARAGRAPH = BLOCK - {"html", "body", "dialog"}

# Start tag -> open elements it ends, and the elements that such a search does not leave.
_SECTIONS = frozenset("thead tbody tfoot caption colgroup".split())
_IMPLIED = {
    "li": (frozenset(["li"]), frozenset(["ul", "ol", "menu", "dir", "table", "td", "th"])),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl", "table", "td", "th"])),
    "option": (frozenset(["option"]), frozenset(["select"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "th": (frozenset(["td", "th", "caption", "colgroup"]), frozenset(["table"])),
    "tr": (frozenset(["td", "th", "tr", "caption", "colgroup"]), frozenset(["table"])),
    **{s: (_SECTIONS | {"td", "th", "tr"}, frozenset(["table"])) for s in sorted(_SECTIONS)},
}
_PARAGRAPH_BARRIER = frozenset("table td th caption button object".split())

# A quote opens a section only where the value of an attribute begins; elsewhere it is a character.
_VALUE = r"""\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)"""
_TOKEN = re.compile(
    rf"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|[^\s/>][^\s/>=]*+(?:{_VALUE})?+)*+>|[^>]*>)|<[!?/][^>]*>""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_DISPLAY_NONE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.I)
_WANTED = frozenset("hidden style open type start value colspan selected".split())


_RAW_END = {tag: re.compile(f"</{tag}", re.I | re.A) for tag in RAW}


class Node:
    __slots__ = ("tag", "attributes", "children")

    def __init__(self, tag: str, attributes: dict[str, str]):
        self.tag, self.attributes = tag, attributes
        self.children: list[Node | str] = []


def _attributes(text: str) -> dict[str, str]:
    found = {}
    for m in _ATTRIBUTE.finditer(text):
        name = m[1].lower()
        if name in _WANTED and name not in found:
            found[name] = html.unescape(m[2] or m[3] or m[4] or "")
    return found


class Builder:
    """Open elements from the root to the current one."""

    def __init__(self) -> None:
        self.root = Node("html", {})
        self.open = [self.root]
        self.count: Counter[str] = Counter()  # open elements by tag

    def text(self, data: str) -> None:
        if data:
            self.open[-1].children.append(data)

    def _cut(self, at: int) -> None:
        for node in self.open[at:]:
            self.count[node.tag] -= 1
        del self.open[at:]

    def _end(self, tags: frozenset[str], barrier: frozenset[str]) -> None:
        """End the outermost open element with one of ``tags`` on this side of a barrier."""
        if not any(self.count[t] > 0 for t in tags):
            return
        cut = None
        for i in range(len(self.open) - 1, 0, -1):
            tag = self.open[i].tag
            if tag in tags:
                cut = i
            elif tag in barrier:
                break
        if cut is not None:
            self._cut(cut)

    def _inside(self, tag: str, barrier: str) -> bool:
        if self.count[tag] <= 0:
            return False
        for node in reversed(self.open):
            if node.tag == tag:
                return True
            if node.tag == barrier:
                return False
        return False

    def _push(self, tag: str, attributes: dict[str, str]) -> None:
        node = Node(tag, attributes)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.count[tag] += 1

    def start(self, tag: str, attributes: dict[str, str]) -> None:
        if tag in ("html", "body"):
            for k, v in attributes.items():
                self.open[0].attributes.setdefault(k, v)
            self._end(frozenset(["head"]), frozenset())
            return
        if tag in ENDS_PARAGRAPH:
            self._end(frozenset(["p"]), _PARAGRAPH_BARRIER)
            if self.open[-1].tag == "head":
                self._cut(len(self.open) - 1)
        if tag in _IMPLIED:
            self._end(*_IMPLIED[tag])
            if tag in ("td", "th") and not self._inside("tr", "table"):
                self.start("tr", {})
            if tag == "tr" and not self._inside("table", ""):
                self._push("table", {})
        self._push(tag, attributes)

    def end(self, tag: str) -> None:
        if tag in ("html", "body") or self.count[tag] <= 0:
            return
        barrier = None if tag in ("table", "td", "th", "tr", "tbody", "thead", "tfoot") else ("td", "th", "table")
        for i in range(len(self.open) - 1, 0, -1):
            if self.open[i].tag == tag:
                self._cut(i)
                return
            if barrier and self.open[i].tag in barrier:
                return
            if not barrier and tag != "table" and self.open[i].tag == "table":
                return


def parse(page: str) -> Node:
    """Tree of a page. Whatever cannot be read as markup is text; nothing is rejected."""
    b, at, last = Builder(), 0, page.rfind(">")
    while at <= last:
        m = _TOKEN.search(page, at)
        if m is None:
            break
        if m.start() > at:
            b.text(html.unescape(page[at:m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            b.end(tag)
            continue
        rest = m[3]
        b.start(tag, _attributes(rest[:-1]) if len(rest) > 1 else {})
        if tag in RAW:
            closing = _RAW_END[tag].search(page, at)
            end = closing.start() if closing else len(page)
            if tag in ("textarea", "title"):
                b.text(html.unescape(page[at:end]))
            at = end
    if at < len(page):
        tail = page[at:]
        cut = re.search(r"<[a-zA-Z/!?]", tail)  # a tag that never ends is dropped
        b.text(html.unescape(tail[:cut.start()] if cut else tail))
    return b.root


class Writer:
    """Lines of text with pending breaks: 1 for a new line, 2 for an empty line before it."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.now: list[str] = []  # pieces of the current line
        self.pending = 0
        self.space = False
        self.indent = ""
        self.marker = ""

    def _end_line(self) -> None:
        self.lines.append("".join(self.now).rstrip(" "))
        self.now = []

    def _flush(self) -> None:
        if self.now:
            self._end_line()

    def need(self, breaks: int) -> None:
        self.space = False
        self.pending = max(self.pending, breaks)

    def newline(self) -> None:
        if self.now or (self.lines and not self.pending):
            self._end_line()
        self.space = False

    def _begin(self) -> None:
        if self.pending:
            self._flush()
            if self.pending > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.pending = 0
        if not self.now:
            lead = self.indent[:len(self.indent) - len(self.marker)] + self.marker if self.marker else self.indent
            self.now = [lead] if lead else []
            self.marker = ""

    def words(self, data: str) -> None:
        words = data.split()
        if not words:
            self.space = self.space or bool(data)
            return
        fresh = bool(self.pending) or not self.now
        self._begin()
        if not fresh and (self.space or data[0].isspace()):
            self.now.append(" ")
        self.now.append(" ".join(words))
        self.space = data[-1].isspace()

    def verbatim(self, data: str) -> None:
        first, *more = data.split("\n")
        if first or more:
            self._begin()
            self.now.append(first)
        for line in more:
            self._end_line()
            self.now = [x for x in (self.indent, line) if x]
        self.space = False

    def block(self, lines: list[str]) -> None:
        for line in lines:
            self.need(1)
            self._begin()
            self.now.append(line)
        self.need(1)

    def done(self) -> list[str]:
        self._flush()
        while self.lines and not self.lines[-1].strip():
            self.lines.pop()
        return self.lines


class Table:
    def __init__(self) -> None:
        self.rows: list[list[tuple[list[str], int]]] = []

    def lines(self) -> list[str]:
        width: list[int] = []
        for row in self.rows:
            at = 0
            for lines, span in row:
                width += [0] * (at + span - len(width))
                if span == 1:
                    width[at] = max(width[at], max(map(len, lines), default=0))
                at += span
        out = []
        for row in self.rows:
            for k in range(max((len(lines) for lines, _ in row), default=0)):
                line, at = "", 0
                for lines, span in row:
                    room = sum(width[at:at + span]) + 2 * (span - 1)
                    line += (lines[k] if k < len(lines) else "").ljust(room) + "  "
                    at += span
                out.append(line.rstrip())
        return [x for x in out if x]


def _number(text: str, default: int) -> int:
    return int(text) if re.fullmatch(r"-?[0-9]{1,9}", text.strip()) else default


def _chosen(select: Node) -> list[Node]:
    options, stack = [], list(reversed(select.children))
    while stack:
        x = stack.pop()
        if isinstance(x, Node):
            if x.tag == "option":
                options.append(x)
            else:
                stack += reversed(x.children)
    return ([o for o in options if "selected" in o.attributes] or options)[:1]


def render(root: Node) -> str:
    """Visible text of a tree."""
    out = Writer()
    writers, tables, lists = [], [], []
    stack: list[tuple] = [("in", root, True, False)]  # node, visible, white space kept
    while stack:
        what, node, shown, pre = stack.pop()
        if what == "out":
            tag = node.tag
            if tag == "table" and tables and tables[-1][0] is node:
                rows = tables.pop()[1]
                out.need(2)
                out.block(rows.lines())
                out.need(2)
            elif tag in ("td", "th") and writers and writers[-1][0] is node:
                cell, out = out.done(), writers.pop()[1]
                span = min(max(_number(node.attributes.get("colspan", ""), 1), 1), 1000)
                tables[-1][1].rows[-1].append((cell, span))
            else:
                if tag in ("ul", "ol", "menu", "dir"):
                    lists.pop()
                if tag == "li":
                    out.indent, out.marker = lists[-1][2] if lists else "", ""
                if tag in BLOCK:
                    out.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            continue
        if isinstance(node, str):
            if shown:
                out.verbatim(node) if pre else out.words(node)
            continue
        tag, attributes = node.tag, node.attributes
        if tag in HIDDEN or "hidden" in attributes:
            continue
        style = attributes.get("style", "")
        if style:
            if _DISPLAY_NONE.search(style):
                continue
            if m := _VISIBILITY.search(style):
                shown = m[1].lower() == "visible"
        if tag == "br":
            if shown:
                out.newline()
            continue
        children = node.children
        if tag == "input" or tag in VOID and tag != "hr":
            continue
        if tag == "select":
            children = _chosen(node)
        elif tag == "details" and "open" not in attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        elif tag == "table":
            tables.append((node, Table()))
        elif tag == "tr" and tables:
            tables[-1][1].rows.append([])
        elif tag in ("td", "th") and tables:
            if not tables[-1][1].rows:
                tables[-1][1].rows.append([])
            writers.append((node, out))
            out = Writer()
        elif tag in BLOCK:
            out.need(2 if tag in SPACED and not (tag in ("ul", "ol") and lists) else 1)
            if tag in ("ul", "ol", "menu", "dir"):
                lists.append([tag, _number(attributes.get("start", ""), 1), out.indent])
            elif tag == "li":
                kind, number, base = lists[-1] if lists else ("ul", 1, "")
                if kind == "ol":
                    number = _number(attributes.get("value", ""), number)
                    lists[-1][1] = number + 1
                out.marker = f"{number}. " if kind == "ol" else "- "
                out.indent = base + " " * len(out.marker)
        pre = pre or tag in ("pre", "textarea", "xmp")
        stack.append(("out", node, shown, pre))
        between = tag in ("table", "thead", "tbody", "tfoot", "tr")  # white space between cells
        for c in reversed(children):
            if not (between and isinstance(c, str) and not c.strip()):
                stack.append(("in", c, shown, pre))
    return "\n".join(out.done())


def visible_text(page: str | None) -> str | None:
    return None if page is None else render(parse(page))


def text_column(page: Column) -> Column:
    @F.arrow_udf("string")
    def extract(x: pa.Array) -> pa.Array:
        return pa.array([visible_text(v.as_py()) for v in x], pa.string())

    return extract(page)


def extracted_rows(pages: DataFrame, page: str = "html") -> DataFrame:
    """One row per row of ``pages``: page_id, text, n_chars, n_lines.

    A NULL page gives NULL text and counts of 0, an empty one empty text. Repeated rows are
    rendered alike; other columns are ignored.
    """
    rows = pages.select("page_id", text_column(F.col(f"`{page}`")).alias("text"))
    body = F.coalesce("text", F.lit(""))
    return rows.select("page_id", "text", F.char_length(body).cast("long").alias("n_chars"),
                       F.when(body == "", 0).otherwise(F.size(F.split(body, "\n"))).cast("long").alias("n_lines"))
