"""Visible text of HTML pages, laid out as a text browser would.

A tree builder with implied tags reads each page; a renderer walks the tree, drops what is
not visible, keeps block spacing and list marks, and aligns the cells of tables. Both are
bounded by one page and run in tasks, a batch of pages at a time.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import ship

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset(
    """script style template head title meta link base noscript iframe object embed canvas svg math audio video
    datalist noembed noframes param source track area map""".split()
)
BLOCK = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure
    footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary
    table ul caption tr optgroup option""".split()
)
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset".split())
HEADS = frozenset("head base link meta title style script noscript template".split())
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary table ul""".split()
)
#: A start tag ends the open elements named first, looked for up to those named second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"td", "th", "tr", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "th": ({"td", "th", "caption", "colgroup"}, {"tr", "table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption", "colgroup"}, {"table"}),
    "colgroup": ({"caption", "colgroup"}, {"table"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
#: A start tag of a table part ends what lies open in the part named second, as browsers do.
PARTS_IN = dict.fromkeys(("td", "th"), {"tr", "tbody", "thead", "tfoot", "table"}) | {
    "tr": {"tbody", "thead", "tfoot", "table"}
} | dict.fromkeys(("tbody", "thead", "tfoot", "caption", "colgroup"), {"table"})
ROWS = frozenset("table tbody thead tfoot tr".split())
#: End tags do not reach beyond these.
SCOPES = frozenset("table td th caption html template".split())
DEPTH = 200  # what is in deeper elements is read as content of the one at this depth

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
#: A tag with a quote that nothing closes ends at the next bracket.
_OPEN_QUOTE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
_BEGIN = re.compile(r"<[a-zA-Z!?]|</[a-zA-Z]")
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?")
_HIDING = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse)|content-visibility\s*:\s*hidden)", re.I)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("children", "hidden", "name", "span", "start")

    def __init__(self, name: str, hidden: bool = False, span: int = 1, start: int = 1) -> None:
        self.name, self.hidden, self.span, self.start = name, hidden, span, start
        self.children: list[Node | str] = []


def _made(name: str, attributes: str) -> Node:
    if not attributes or attributes.isspace():
        return Node(name)
    found = {}
    for key, value in _ATTRIBUTE.findall(attributes):
        found.setdefault(key.lower(), unescape(value.strip("\"'")))
    hidden = (
        "hidden" in found
        or bool(_HIDING.search(found.get("style", "")))
        or (name == "input" and found.get("type", "").lower() == "hidden")
        or (name in ("dialog",) and "open" not in found)
    )
    return Node(name, hidden, min(max(_number(found.get("colspan")), 1), MOST_COLUMNS), _number(found.get("start")))


MOST_COLUMNS = 1_000  # that one cell may span (fixed by the standard)
_NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})(?![0-9])")


def _number(value: str | None) -> int:
    """The whole number a value begins with, as browsers read it; 1 for none or one beyond all use."""
    found = _NUMBER.match(value or "")
    return int(found.group(1)) if found else 1


def parse(html: str) -> Node:
    """The element tree. Every text has one; end tags without a start are passed over."""
    root = Node("html")
    stack = [root]
    #: Where the stack holds elements of a name, but for the root.
    places: defaultdict[str, list[int]] = defaultdict(list)

    def nearest(names: set[str] | frozenset[str]) -> int:
        return max((places[n][-1] for n in names if places[n]), default=0)

    def push(node: Node) -> None:
        stack[-1].children.append(node)
        if len(stack) >= DEPTH:
            # The element itself stays empty; its content goes on where it stands, or nowhere.
            content = stack[-1].children if _seen(node) else []
            if node.name in ("td", "th"):
                content.append(" ")
            node = Node(node.name)
            node.children = content
        places[node.name].append(len(stack))
        stack.append(node)

    def cut(size: int) -> None:
        while len(stack) > size:
            node = stack.pop()
            places[node.name].pop()
            if len(stack) >= DEPTH and (node.name in BLOCK or node.name in ("td", "th")):
                node.children.append(Node("div") if node.name in BLOCK else " ")

    def close(names: set[str] | frozenset[str], stops: set[str] | frozenset[str]) -> None:
        while (k := nearest(names)) and k >= nearest(stops):
            cut(k)

    def text(part: str) -> None:
        if part:
            if stack[-1].name == "head" and not part.isspace():
                cut(len(stack) - 1)
            stack[-1].children.append(unescape(part) if "&" in part else part)

    at, end = 0, len(html)
    while at < end:
        begin = _BEGIN.search(html, at)
        place = begin.start() if begin else end
        text(html[at:place])
        # An unfinished tag at the end is dropped, as browsers do. Only a bracket can end one, so
        # where none is left no further beginning is looked at.
        found = begin and (_PART.match(html, place) or (html.find(">", place) >= 0 and _OPEN_QUOTE.match(html, place)))
        if not found:
            break
        at = found.end()
        name = found.group(2)
        if not name:
            if found.group(0).startswith("<![CDATA["):
                text(found.group(0)[9:].removesuffix("]]>"))
            continue
        name = name.lower()
        if found.group(1):
            if name == "p" and not places["p"]:
                stack[-1].children.append(Node("p"))
                continue
            k = nearest({name})
            if k and (name in ("table", "html", "body", "tr", "tbody", "thead", "tfoot") or k >= nearest(SCOPES)):
                cut(k)
            continue
        if name == "html" or (name == "body" and places["body"]):
            continue
        if stack[-1].name == "head" and name not in HEADS:
            cut(len(stack) - 1)
        if name in CLOSES_P:
            close({"p"}, SCOPES | {"button"})
        if name[0] == "h" and name[1:] in "123456" and len(name) == 2 and stack[-1].name in BLOCK and stack[-1].name[0] == "h" and stack[-1].name[1:].isdigit():
            cut(len(stack) - 1)
        if name in IMPLIED:
            close(*IMPLIED[name])
            if name in PARTS_IN and (k := nearest(PARTS_IN[name])):
                cut(k + 1)
            if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
                push(Node("tr"))
        node = _made(name, found.group(3).rstrip("/"))
        if name in VOID or name in RAW or (name == "form" and stack[-1].name in ROWS):
            # A form that begins between cells holds nothing; what follows is the table's.
            stack[-1].children.append(node)
        else:
            push(node)
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
            body = html[at : stop.start()] if stop else html[at:]
            at = stop.end() if stop else end
            node.children.append(unescape(body) if name in ("title", "textarea") else body)
    return root


def width(text: str) -> int:
    """Columns a text takes: wide East Asian signs take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class _Page:
    """Lines under construction: words run on until a block begins or ends."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.blank = False
        self.lead: list[str] = [""]
        self.mark = ""

    def words(self, text: str, kept: bool) -> None:
        if kept:
            first, *rest = text.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self.put(first)
            for more in rest:
                self.end(forced=True)
                self.put(more)
            return
        folded = _SPACE.sub(" ", text)
        if folded[:1] == " ":
            self.space = True
            folded = folded[1:]
        if not folded:
            return
        tail = folded[-1] == " "
        self.put(folded[:-1] if tail else folded)
        self.space = tail

    def put(self, text: str) -> None:
        if text:
            if self.space and self.line:
                self.line.append(" ")
            self.line.append(text)
            self.space = False

    def end(self, forced: bool = False) -> None:
        """Ends the line; an empty one counts only where it is forced."""
        text = "".join(self.line).rstrip(" ")
        self.line, self.space = [], False
        if not text and not forced and not self.mark:
            return
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        lead = "".join(self.lead)
        if self.mark:
            lead = lead[: len(lead) - len(self.mark)] + self.mark
            self.mark = ""
        self.lines.append((lead + text).rstrip(" "))

    def gap(self) -> None:
        self.end()
        self.blank = bool(self.lines)

    def text(self) -> str:
        self.end()
        return "\n".join(self.lines).strip("\n")


def _seen(node: Node) -> bool:
    return not node.hidden and node.name not in UNSEEN


def _table(page: _Page, table: Node) -> None:
    """Rows with cells of a column beginning at one place, two spaces apart.

    What has no place in a table, in its sections or rows comes before it, as browsers put
    it, a line for each row; in a hidden row it is hidden.
    """
    rows: list[list[tuple[str, int]]] = []

    def strays(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                if not child.isspace():
                    page.words(child, False)
            elif child.name in ("tr", "thead", "tbody", "tfoot", "colgroup"):
                page.end()
                if _seen(child):
                    strays(child)
                page.end()
            elif child.name in ("caption", "col", "td", "th"):
                page.end()
            else:
                _walk(page, child, False)

    def gather(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str) or not _seen(child):
                continue
            if child.name == "tr":
                rows.append([(_inner(c), c.span) for c in child.children if isinstance(c, Node) and c.name in ("td", "th") and _seen(c)])
            elif child.name in ("thead", "tbody", "tfoot"):
                gather(child)
            elif child.name == "caption":
                page.end()
                page.words(_inner(child), True)
                page.end()

    strays(table)
    page.end()
    gather(table)
    widths: dict[int, int] = {}
    for row in rows:
        column = 0
        for text, span in row:
            if span == 1:
                most = max(map(width, text.split("\n")), default=0)
                widths[column] = max(widths.get(column, 0), most)
            column += span
    for row in rows:
        cells, column = [], 0
        for text, span in row:
            room = sum(widths.get(c, 0) for c in range(column, column + span)) + 2 * (span - 1)
            cells.append((text.split("\n"), room))
            column += span
        for k in range(max((len(lines) for lines, _ in cells), default=0)):
            shown = [lines[k] if k < len(lines) else "" for lines, _ in cells]
            padded = [t + " " * (room - width(t)) for t, (_, room) in zip(shown, cells, strict=True)]
            page.put("  ".join(padded).rstrip(" "))
            page.end()


def _inner(node: Node) -> str:
    page = _Page()
    _walk_children(page, node, False)
    return page.text()


def _walk_children(page: _Page, node: Node, kept: bool) -> None:
    for child in node.children:
        if isinstance(child, str):
            page.words(child, kept)
        else:
            _walk(page, child, kept)


def _walk(page: _Page, node: Node, kept: bool) -> None:
    name = node.name
    if not _seen(node):
        return
    if name == "br":
        page.end(forced=True)
        return
    if name == "img" or name == "wbr":
        return
    block, spaced = name in BLOCK, name in SPACED and not (name in ("ul", "ol") and len(page.lead) > 1)
    if spaced:
        page.gap()
    elif block:
        page.end()
    if name == "hr":
        return
    if name == "table":
        _table(page, node)
    elif name in ("ul", "ol", "menu", "dir"):
        number = node.start
        for child in node.children:
            if isinstance(child, Node) and child.name == "li" and _seen(child):
                mark = f"{number}. " if name == "ol" else "- "
                number += 1
                page.end()
                page.lead.append(" " * len(mark))
                page.mark = mark
                _walk_children(page, child, kept)
                if page.line or page.mark:
                    page.end()
                page.lead.pop()
            elif isinstance(child, Node):
                _walk(page, child, kept)
            else:
                page.words(child, kept)
    elif name in ("blockquote", "dd"):
        page.end()
        page.lead.append("    ")
        _walk_children(page, node, kept)
        page.end()
        page.lead.pop()
    elif name == "q":
        page.put('"')
        _walk_children(page, node, kept)
        page.space = False
        page.put('"')
    elif name == "details":
        for child in node.children:
            if isinstance(child, Node) and child.name == "summary":
                _walk(page, child, kept)
            elif isinstance(child, Node):
                _walk(page, child, kept)
            else:
                page.words(child, kept)
    else:
        _walk_children(page, node, kept or name in ("pre", "listing", "xmp", "textarea"))
    if spaced:
        page.gap()
    elif block:
        page.end()


def render(html: str | None) -> str:
    """The visible text of a page; empty for null, empty and blank pages."""
    if not html or html.isspace():
        return ""
    page = _Page()
    _walk_children(page, parse(html.replace("\x00", "")), False)
    return page.text()


def extract_text(pages: DataFrame) -> DataFrame:
    """page_id and text, a row for each row of ``pages``.

    Null and empty pages have an empty text. Null ids and repeated rows stay; an empty
    table gives no rows. Only page_id and html are read. Rendering needs memory in
    proportion to one page; elements deeper than ``DEPTH`` are laid side by side, and
    hidden ones among them stay hidden.
    """
    ship(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"page_id": batch["page_id"], "text": [render(h) for h in batch["html"]]})

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html")).mapInPandas(
        run, "page_id long, text string"
    )
