"""HTML extraction by layout-aware rendering.

A page becomes a tree: start tags close what they imply to be closed, end tags close what stands
open inside them. The tree is then rendered as a browser would show it without styles: hidden parts
are left out, white space is collapsed, blocks stand on lines of their own with a blank line where
they have margins, list items are marked and indented, table cells are aligned in columns.

Both steps walk with stacks of their own, so depth is no limit.

Defined cases: null or empty html gives empty text; broken markup is read as far as it goes; pages
are rendered one by one, so ties and repeated rows change nothing; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plaintlens.llm.common import map_texts

SCHEMA = "doc_id long, text string, n_chars long, text_sha256 string"

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noscript noembed noframes iframe".split())
HIDDEN = frozenset(
    "head title script style template noscript noembed noframes iframe object datalist "
    "audio video canvas svg math map param source track".split()
)
#: Blocks without margins, and those with a blank line around them.
PLAIN_BLOCKS = frozenset(
    "html body div article section nav aside header footer main address form fieldset legend li "
    "dt dd details summary center figcaption hgroup search option optgroup tr caption tbody thead "
    "tfoot td th".split()
)
SPACED_BLOCKS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol menu dl table blockquote pre figure hr listing xmp".split()
)
BLOCKS = PLAIN_BLOCKS | SPACED_BLOCKS
LISTS = frozenset("ul ol menu".split())
#: Start tag -> open elements that it closes, and those behind which it does not look.
_BODY = frozenset("table td th caption button object body html".split())
_CLOSES = {
    "li": (frozenset(["li"]), LISTS | _BODY),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | _BODY),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | _BODY),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "td": (frozenset(["td", "th"]), frozenset(["table"])),
    "th": (frozenset(["td", "th"]), frozenset(["table"])),
    "tr": (frozenset(["tr", "caption", "colgroup"]), frozenset(["table"])),
    "tbody": (frozenset(["tbody", "thead", "tfoot", "caption", "colgroup"]), frozenset(["table"])),
}
_CLOSES["thead"] = _CLOSES["tfoot"] = _CLOSES["tbody"]
#: Blocks that end an open paragraph.
_ENDS_P = BLOCKS - frozenset("html body li option optgroup tr td th tbody thead tfoot caption".split())
_NO_P_BEYOND = frozenset("table td th caption button object".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<[!?/][^>]*(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]*))?")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_INVISIBLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*(hidden|collapse)", re.I)


@dataclass
class Element:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)  # elements and strings


def attributes_of(source: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        if value[:1] in "\"'" and value:
            value = value[1:-1]
        out.setdefault(name.lower(), html.unescape(value))
    return out


def build_tree(source: str) -> Element:
    """The element tree, a root of tag ``html`` whether or not the page names one."""
    root = Element("html")
    stack = [root]

    def close_within(tags: frozenset, barrier: frozenset) -> None:
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].tag in tags:
                del stack[depth:]
                return
            if stack[depth].tag in barrier:
                return

    position, size = 0, len(source)
    while position < size:
        found = _TOKEN.search(source, position)
        stop = found.start() if found else size
        if stop > position:
            stack[-1].children.append(html.unescape(source[position:stop]))
        if not found:
            break
        position = found.end()
        ending, tag, rest = found.group(1, 2, 3)
        if tag is None:
            continue  # comment, doctype, processing instruction
        tag = tag.lower()
        if ending:
            if tag == "p" and not any(e.tag == "p" for e in stack):
                stack[-1].children.append(Element("p"))
            else:
                cell = tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "html", "body")
                close_within(frozenset([tag]), frozenset(["td", "th", "caption"]) if cell else frozenset())
            continue
        if tag in ("html", "body"):
            own = next((e for e in stack if e.tag == tag), None)
            if own is not None:
                own.attributes = attributes_of(rest) | own.attributes
                continue
        if tag in _ENDS_P:
            close_within(frozenset(["p"]), _NO_P_BEYOND)
        if tag in ("td", "th") and not any(e.tag == "tr" for e in stack):
            if any(e.tag == "table" for e in stack):
                row = Element("tr")
                stack[-1].children.append(row)
                stack.append(row)
        if tag in _CLOSES:
            close_within(*_CLOSES[tag])
            if tag in ("tr", "tbody", "thead", "tfoot"):
                close_within(frozenset(["tr"]) if tag != "tr" else frozenset(), frozenset(["table"]))
        if tag[:1] == "h" and tag[1:] in "123456" and stack[-1].tag[:1] == "h" and stack[-1].tag[1:] in tuple("123456"):
            stack.pop()
        if tag == "body":
            close_within(frozenset(["head"]), frozenset())
        element = Element(tag, attributes_of(rest) if rest.strip(" /\n\t") else {})
        stack[-1].children.append(element)
        if tag in ("pre", "listing", "textarea") and source.startswith("\n", position):
            position += 1
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, position)
            inner = source[position : end.start() if end else size]
            element.children.append(html.unescape(inner) if tag in ("textarea", "title") else inner)
            position = (source.find(">", end.start()) + 1 or size) if end else size
        elif tag not in VOID:
            stack.append(element)
    return root


def is_hidden(element: Element, parent: Element | None) -> bool:
    own = element.attributes
    if element.tag in HIDDEN or "hidden" in own or _INVISIBLE.search(own.get("style", "")):
        return True
    if element.tag == "input":
        return own.get("type", "").lower() not in ("submit", "button", "reset")
    if element.tag == "dialog":
        return "open" not in own
    # a closed <details> shows its summary only
    return (
        parent is not None
        and parent.tag == "details"
        and "open" not in parent.attributes
        and element.tag != "summary"
    )


class Lines:
    """Text laid out in lines; remembers the break that the next text needs."""

    def __init__(self):
        self.lines: list[str] = []
        self.current: list[str] = []
        self.wanted = 0  # blank lines before the next text
        self.space = False  # a collapsed space is due
        self.mark = ""  # list mark for the next text

    def text(self, value: str, indent: str, keep: bool) -> None:
        if keep:
            first, *more = value.replace("\r\n", "\n").split("\n")
            if first:
                self._put(first, indent)
            for line in more:
                self.newline(force=True)
                if line:
                    self._put(line, indent)
            return
        value = _SPACE.sub(" ", value)
        inner = value.strip(" ")
        self.space |= value[:1] == " "
        if inner:
            self._put(inner, indent)
            self.space = value[-1] == " "

    def _put(self, value: str, indent: str) -> None:
        if not self.current:
            if self.lines and self.wanted:
                self.lines.append("")
            self.wanted = 0
            mark, self.mark = self.mark, ""
            self.current.append(indent[: len(indent) - len(mark)] + mark if mark else indent)
        elif self.space:
            self.current.append(" ")
        self.space = False
        self.current.append(value)

    def newline(self, force: bool = False) -> None:
        if self.current:
            self.lines.append("".join(self.current).rstrip(" "))
            self.current = []
        elif force:
            self.lines.append("")
        self.space = False

    def block(self, spaced: bool) -> None:
        self.newline()
        if spaced:
            self.wanted = 1

    def finished(self) -> list[str]:
        self.newline()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        start = next((i for i, line in enumerate(self.lines) if line), len(self.lines))
        return self.lines[start:]


@dataclass
class Table:
    out: Lines
    rows: list = field(default_factory=list)  # lists of (lines, columns taken)

    def text(self) -> list[str]:
        """Rows as lines, every column as wide as its widest single cell."""
        widths: dict[int, int] = {}
        for row in self.rows:
            at = 0
            for lines, span in row:
                if span == 1:
                    widths[at] = max([widths.get(at, 0), *map(len, lines)])
                at += span
        out = []
        for row in self.rows:
            for i in range(max((len(lines) for lines, _ in row), default=0)):
                parts, at = [], 0
                for lines, span in row:
                    width = sum(widths.get(c, 0) + 2 for c in range(at, at + span)) - 2
                    parts.append((lines[i] if i < len(lines) else "").ljust(width))
                    at += span
                out.append("  ".join(parts).rstrip())
        return out


def render(root: Element) -> str:
    """The visible text of a tree."""
    out = Lines()
    tables: list[Table] = []
    lists: list[list] = []  # [ordered, next number]
    indents = [""]
    pre = 0
    todo: list[tuple] = [("open", root, None)]
    while todo:
        step, node, parent = todo.pop()
        if isinstance(node, str):
            if parent is not None and parent.tag == "details" and "open" not in parent.attributes:
                continue
            out.text(node, indents[-1], pre > 0)
            continue
        tag = node.tag
        if step == "open":
            if is_hidden(node, parent):
                continue
            if tag == "br":
                out.newline(force=True)
                continue
            if tag == "input":
                out.text(f" {node.attributes.get('value', '')} ", indents[-1], False)
                continue
            if tag in BLOCKS and tag not in ("td", "th"):
                out.block(tag in SPACED_BLOCKS and not (tag in LISTS and lists))
            if tag in LISTS:
                start = node.attributes.get("start", "1")
                lists.append([tag == "ol", int(start) if re.fullmatch(r"-?\d{1,9}", start) else 1])
            elif tag == "li":
                ordered, number = lists[-1] if lists else (False, 0)
                mark = f"{number}. " if ordered else "- "
                if lists:
                    lists[-1][1] += 1
                indents.append(indents[-1] + " " * len(mark))
                out.mark = mark
            elif tag in ("dd", "blockquote"):
                indents.append(indents[-1] + "  ")
            elif tag in ("pre", "textarea", "listing", "xmp"):
                pre += 1
            elif tag == "table":
                tables.append(Table(out))
            elif tag == "tr" and tables:
                tables[-1].rows.append([])
            elif tag in ("td", "th") and tables:
                out = Lines()
                indents.append("")
            children = node.children
            if tag == "select":
                options = [c for c in children if isinstance(c, Element) and c.tag == "option"]
                chosen = [c for c in options if "selected" in c.attributes] or options[:1]
                children = [s for c in chosen for s in (" ", *c.children, " ")]
            todo.append(("close", node, parent))
            todo.extend(("open", child, node) for child in reversed(children))
            continue
        if tag in LISTS:
            lists.pop()
        elif tag == "li":
            indents.pop()
            out.mark = ""
        elif tag in ("dd", "blockquote"):
            indents.pop()
        elif tag in ("pre", "textarea", "listing", "xmp"):
            pre -= 1
        elif tag in ("td", "th") and tables:
            span = node.attributes.get("colspan", "1")
            span = int(span) if re.fullmatch(r"[1-9]\d{0,2}", span) else 1
            if not tables[-1].rows:
                tables[-1].rows.append([])
            tables[-1].rows[-1].append((out.finished(), span))
            out = tables[-1].out
            indents.pop()
        elif tag == "table":
            table = tables.pop()
            out = table.out
            for line in table.text():
                if line:
                    out.text(line, indents[-1], True)
                out.newline(force=not line)
        if tag in BLOCKS and tag not in ("td", "th"):
            out.block(tag in SPACED_BLOCKS and not (tag in LISTS and lists))
    return "\n".join(out.finished())


def visible_text(source: str) -> str:
    return render(build_tree(source))


def extract_text(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, text, n_chars, text_sha256. A narrow map, no shuffle."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("doc_id"),
        F.coalesce("html", F.lit("")).alias("text"),
    )

    def make():
        def work(_, batch: list[str]) -> dict:
            found = [visible_text(source) for source in batch]
            return {
                "text": pa.array(found, pa.string()),
                "n_chars": pa.array(map(len, found), pa.int64()),
                "text_sha256": [
                    hashlib.sha256(t.encode(errors="replace")).hexdigest() for t in found
                ],
            }

        return work

    return map_texts(rows, make, SCHEMA).withColumnRenamed("doc_id", "page_id")
