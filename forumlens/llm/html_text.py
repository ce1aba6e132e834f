"""Operator 1, HTML extraction by layout-aware rendering.

A page is cut into tags and text, a tree builder adds implied end tags, and
the tree is rendered: block elements start lines (paragraph-like ones with a
blank line), list items get their marker and indentation, table cells are
padded to columns, ``pre`` keeps its white space, everything else collapses
it.  Options of a list, labels of their groups and the values of buttons are
text too.  Only what is never shown is left out: head, scripts, styles,
templates, comments, typed form values, closed ``details`` and ``dialog``
content, elements with ``hidden`` or ``display:none``, and the text of those
with ``visibility:hidden`` except in parts that are ``visibility:visible``.

Building and rendering use explicit stacks, so nesting depth is not limited.

Defined results: null html gives null, empty or invisible html an empty
text; unclosed tags, quotes and comments end with the page; unknown tags are
inline; a very long page is one value of one row; an empty table gives an
empty one; repeated rows are each extracted; other columns are ignored.  If a
key is called as the output column, that gets underscores until it is free.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forumlens.llm.common import arrow_session

# fixed values: element classes of the HTML standard
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style template noscript iframe noembed noframes title textarea xmp".split())
NEVER = frozenset("head script style template noscript iframe noembed noframes title object audio video canvas "
                  "svg datalist map".split())
HEAD = frozenset("base link meta title style script template noscript head".split())
SPACED = frozenset("p blockquote pre ul ol dl table h1 h2 h3 h4 h5 h6 figure hr menu".split())
BLOCK = SPACED | frozenset("address article aside body center dd details dialog dir div dt fieldset figcaption "
                           "footer form header hgroup html legend li main nav optgroup option search section "
                           "summary caption tr tbody thead tfoot td th".split())
CLOSES_P = (SPACED | frozenset("address article aside center details dialog dir div dt dd fieldset figcaption "
                               "footer form header hgroup li main nav search section summary".split()))
SCOPE = frozenset("table td th caption button object template html".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# start tag: (open elements that it ends, where the search stops)
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu table td th".split())),
    "dt": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "dd": (frozenset(["dt", "dd"]), frozenset("dl table td th".split())),
    "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "th": (frozenset(["td", "th"]), frozenset(["tr", "table"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset("table tbody thead tfoot".split())),
    "tbody": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(["table"])),
    "thead": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("tbody thead tfoot tr td th caption".split()), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset()),
    "option": (frozenset(["option"]), frozenset("select optgroup datalist".split())),
    "optgroup": (frozenset("option optgroup".split()), frozenset("select datalist".split())),
}
TABLE_PARTS = frozenset("table tr td th tbody thead tfoot caption".split())
MAX_COLSPAN = 1000            # the standard's limit

_TOKEN = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)(?:>|\Z)|([^<]+|<)", re.S)
_ATTR = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_WS = re.compile(r"[ \t\n\r\f]+")
_UNSEEN = re.compile(r"display\s*:\s*none", re.I)
_VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
_NEEDS_ATTRS = frozenset("ol li td th details dialog textarea input option optgroup".split())
BUTTONS = frozenset("submit reset button".split())


class Node:
    __slots__ = ("tag", "attrs", "kids", "seen", "shown")

    def __init__(self, tag, attrs, seen=True, shown=None):
        self.tag, self.attrs, self.kids, self.seen = tag, attrs, [], seen
        self.shown = shown               # its own visibility; None: its parent's


def _attributes(raw: str) -> dict:
    return {m[1].lower(): unescape(m[2] or m[3] or m[4] or "") for m in _ATTR.finditer(raw)}


def build(html: str) -> Node:
    """The element tree, with implied end tags."""
    root = Node("#root", {})
    stack, count = [root], {}

    def pop_to(k):
        while len(stack) > k:
            count[stack.pop().tag] -= 1

    def end(tags, stop):
        if not any(count.get(t) for t in tags):
            return
        k = len(stack) - 1
        while k > 0 and stack[k].tag not in tags:
            if stack[k].tag in stop:
                return
            k -= 1
        if k > 0:
            pop_to(k)

    at, size = 0, len(html)
    while at < size:
        m = _TOKEN.match(html, at)
        at = m.end()
        text = m[7]
        if text is not None:
            if count.get("head") and not text.isspace():
                end(("head",), ())
            stack[-1].kids.append(unescape(text) if "&" in text else text)
            continue
        tag = m[2] or m[5]
        if tag is None:
            if m[0].startswith("<![CDATA["):
                stack[-1].kids.append(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            if tag == "br":
                stack[-1].kids.append(Node("br", {}))
            elif tag == "p" and not count.get("p"):
                stack[-1].kids.append(Node("p", {}))
            elif tag in HEADINGS:
                end(HEADINGS, SCOPE)
            else:
                end((tag,), ("table",) if tag in TABLE_PARTS and tag != "table"
                    else () if tag == "table" else ("td", "th", "caption", "table"))
            continue
        raw = m[3] if m[3] is not None else m[6] or ""
        if count.get("head") and tag not in HEAD:
            end(("head",), ())
        if tag in ENDS:
            end(*ENDS[tag])
        if tag in CLOSES_P and count.get("p"):
            end(("p",), SCOPE)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            pop_to(len(stack) - 1)
        low = raw.lower()
        attrs = _attributes(raw) if raw and (tag in _NEEDS_ATTRS or "hidden" in low or "none" in low
                                             or "visibility" in low) else {}
        seen = tag not in NEVER and "hidden" not in attrs and not _UNSEEN.search(attrs.get("style", ""))
        if tag == "dialog" and "open" not in attrs:
            seen = False
        style = _VISIBILITY.findall(attrs.get("style", ""))
        shown = style[-1].lower() in ("visible", "initial") if style else None
        node = Node(tag, attrs, seen, shown)
        stack[-1].kids.append(node)
        if tag in VOID:
            continue
        if tag in RAW:
            close = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
            stop = close.start() if close else size
            if tag in ("textarea", "xmp"):
                node.kids.append(unescape(html[at:stop]))
            at = html.find(">", stop) + 1 if close else size
            at = at or size
            continue
        stack.append(node)
        count[tag] = count.get(tag, 0) + 1
    return root


class Page:
    """Lines of rendered text."""

    def __init__(self):
        self.lines, self.now, self.gap, self.space = [], [], -1, False
        self.indent, self.marker = [], ""

    def block(self, gap: int) -> None:
        """End the line; the next one comes after ``gap`` blank lines."""
        if self.now:
            self.lines.append("".join(self.now).rstrip(" "))
            self.now, self.gap = [], 0
        self.gap, self.space = max(self.gap, gap), False

    def _begin(self) -> None:
        if self.lines and self.gap > 0:
            self.lines.append("")
        self.gap = 0
        pad = "".join(self.indent)
        if self.marker:
            pad = pad[:len(pad) - len(self.marker)] + self.marker
            self.marker = ""
        if pad:
            self.now.append(pad)

    def text(self, s: str) -> None:
        body = _WS.sub(" ", s)
        trim = body.strip(" ")
        if not trim:
            self.space = self.space or bool(self.now and body)
            return
        if not self.now:
            self._begin()
        elif self.space or body[0] == " ":
            self.now.append(" ")
        self.now.append(trim)
        self.space = body[-1] == " "

    def verbatim(self, s: str) -> None:
        for k, line in enumerate(s.split("\n")):
            if k:
                self.line_break()
            if line:
                if not self.now:
                    self._begin()
                self.now.append(line)

    def line_break(self) -> None:
        if not self.now:
            self._begin()
        self.lines.append("".join(self.now).rstrip(" "))
        self.now, self.gap, self.space = [], 0, False

    def done(self) -> list[str]:
        self.block(0)
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _number(value, default: int, low: int = 0, high: int = 1 << 30) -> int:
    m = re.match(r"\s*(-?\d{1,9})", value or "")
    return min(max(int(m[1]), low), high) if m else default


def table_lines(rows: list[list]) -> list[str]:
    """Aligned lines of rows of (lines, colspan, rowspan)."""
    placed, busy, width = [], {}, {}
    for row in rows:
        out, col, cells = [], 0, list(row)
        while cells or any(c >= col for c in busy):
            if busy.get(col):
                col += 1
                continue
            if not cells:
                col += 1
                continue
            lines, span, down = cells.pop(0)
            out.append((col, span, lines))
            if down > 1:
                busy.update({c: down for c in range(col, col + span)})
            if span == 1:
                width[col] = max(width.get(col, 0), max(map(len, lines), default=0))
            col += span
        busy = {c: n - 1 for c, n in busy.items() if n > 1}
        placed.append(out)
    for row in placed:
        for col, span, lines in row:
            if span > 1:
                have = sum(width.get(c, 0) + 2 for c in range(col, col + span)) - 2
                more = max(map(len, lines), default=0) - have
                if more > 0:
                    width[col + span - 1] = width.get(col + span - 1, 0) + more
    left, total = {}, 0
    for c in range(max(width, default=-1) + 1):
        left[c] = total
        total += width.get(c, 0) + (2 if width.get(c, 0) else 0)
    out = []
    for row in placed:
        for k in range(max((len(lines) for _, _, lines in row), default=0)):
            line = ""
            for col, _, lines in row:
                if k < len(lines) and lines[k]:
                    line = line.ljust(left.get(col, total)) + lines[k]
            out.append(line.rstrip(" "))
    return out


def render(root: Node) -> str:
    pages, tables, lists = [Page()], [], []
    pre = 0
    todo = [(root, False, True)]
    while todo:
        node, leaving, shown = todo.pop()
        page = pages[-1]
        if isinstance(node, str):
            if not shown:
                continue
            if pre:
                page.verbatim(node)
            else:
                page.text(node)
            continue
        tag = node.tag
        if not leaving:
            if not node.seen:
                continue
            shown = shown if node.shown is None else node.shown
            if tag == "br":
                if shown:
                    page.line_break()
                continue
            if tag == "input":
                if shown and node.attrs.get("type", "").strip().lower() in BUTTONS:
                    page.text(node.attrs.get("value", ""))
                continue
            if tag in ("textarea", "xmp"):
                if not shown:
                    continue
                page.block(0)
                page.verbatim(node.kids[0])
                page.block(0)
                continue
            kids = node.kids
            if tag == "details" and "open" not in node.attrs:
                kids = [k for k in kids if isinstance(k, Node) and k.tag == "summary"][:1]
            if tag in BLOCK and tag not in ("td", "th"):
                page.block(1 if tag in SPACED and not (lists and tag in ("ul", "ol", "menu")) else 0)
            if tag in ("ul", "ol", "menu"):
                page.indent.append("")
                lists.append([tag == "ol", _number(node.attrs.get("start"), 1, -(1 << 30))])
            elif tag == "li" and lists:
                ordered, n = lists[-1]
                n = _number(node.attrs.get("value"), n, -(1 << 30)) if ordered else n
                lists[-1][1] = n + 1
                page.marker = f"{n}. " if ordered else "- "
                page.indent.append(" " * len(page.marker))
            elif tag == "dd":
                page.indent.append("  ")
            elif tag == "table":
                tables.append([])
            elif tag == "tr" and tables:
                tables[-1].append([])
            elif tag in ("td", "th") and tables:
                pages.append(Page())
                lists.append([False, 1])
            elif tag == "pre":
                pre += 1
                if kids and isinstance(kids[0], str):
                    kids = [kids[0].removeprefix("\n"), *kids[1:]]
            elif tag == "img" or tag == "hr":
                continue
            elif tag == "optgroup" and shown:
                page.text(node.attrs.get("label", ""))
                page.block(0)
            elif tag == "option" and shown and node.attrs.get("label"):
                page.text(node.attrs["label"])
                kids = []                # the label is shown in its place
            todo.append((node, True, shown))
            todo.extend((k, False, shown) for k in reversed(kids))
            continue
        if tag in ("ul", "ol", "menu"):
            page.indent.pop()
            lists.pop()
        elif tag == "li" and lists:
            page.block(0)
            page.indent.pop()
            page.marker = ""
        elif tag == "dd":
            page.block(0)
            page.indent.pop()
        elif tag in ("td", "th") and tables:
            cell = pages.pop().done()
            lists.pop()
            if not tables[-1]:
                tables[-1].append([])
            tables[-1][-1].append((cell, _number(node.attrs.get("colspan"), 1, 1, MAX_COLSPAN),
                                   _number(node.attrs.get("rowspan"), 1, 1, 65534)))
            continue
        elif tag == "table":
            page.block(1)
            for line in table_lines(tables.pop()):
                page.verbatim(line)
                page.block(0)
        elif tag == "pre":
            pre -= 1
        if tag in BLOCK:
            page.block(1 if tag in SPACED and not (lists and tag in ("ul", "ol", "menu")) else 0)
    return "\n".join(pages[0].done())


def html_to_text(html: str) -> str:
    return render(build(html))


def extract(pages: DataFrame, *, html: str = "html", keys=("page_id",)) -> DataFrame:
    """``keys`` and ``text``, the rendered page, of every row."""
    arrow_session(pages)
    n, name = len(keys), "text"
    while name in keys:
        name += "_"
    kept = pages.select(*keys, F.col(html))

    def run(batches):
        for b in batches:
            out = [None if h is None else html_to_text(h) for h in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[:n], pa.array(out, pa.string())],
                                             names=[*keys, name])

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields[:n], T.StructField(name, T.StringType())]))
