"""Layout-aware text of HTML pages: a tree with implied tags, then its visible text.

Blocks stand on lines of their own, paragraphs and headings with an empty line between,
list items with their marks and indents, table cells in aligned columns (row and column
spans kept), preformatted text as it is.

Not visible: elements that are never shown (head, script, style, ..), `hidden`, inline
`display: none`, closed dialogs and details, and text under inline `visibility: hidden`,
which a child may make visible again. Style sheets aren't read. Text of a tag that the
page's end cuts off is no text.

The scanner reads each character a fixed number of times and the tree builder closes
elements by lists of their places, so time is in proportion to the page whatever it holds.
Indents stop growing at MOST_INDENT columns, and tables nested deeper than MOST_TABLES
are set as blocks; no text is lost by either.
"""

from __future__ import annotations

import html
import re
import unicodedata
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from mercato.session import table

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: Elements whose content is text up to their end tag; of DECODED ones with character references.
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "plaintext"}
DECODED = {"textarea", "title"}
NEVER = {"head", "script", "style", "template", "noscript", "title", "iframe", "noembed", "noframes", "datalist", "object", "svg", "audio", "video", "canvas", "select", "input"}
IN_HEAD = {"base", "link", "meta", "title", "style", "script", "noscript", "template", "noframes"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hgroup", "hr", "html", "legend", "li", "main", "menu", "nav", "ol", "p", "pre", "search", "section", "summary", "table", "ul", "caption", "xmp", "plaintext"}
SPACED = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "table", "dl", "figure", "fieldset", "xmp"}
LISTS = {"ul", "ol", "menu"}
VERBATIM = {"pre", "textarea", "xmp", "plaintext"}
TABLE_PARTS = {"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}
SPECIAL = BLOCK | TABLE_PARTS
#: start tag -> (open elements it closes, elements that bar the search)
IMPLIED_END = {
    "li": ({"li"}, LISTS | {"table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th", "caption"}, {"table", "tr"}),
    "th": ({"td", "th", "caption"}, {"table", "tr"}),
    "thead": (TABLE_PARTS, {"table"}),
    "tbody": (TABLE_PARTS, {"table"}),
    "tfoot": (TABLE_PARTS, {"table"}),
    "option": ({"option"}, {"select"}),
    "body": ({"head"}, set()),
}
CELL_BARS = ("table", "td", "th", "caption")
MOST_INDENT, MOST_TABLES = 80, 24
#: The most columns and rows of a cell; a row span of zero reaches the table's end.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"[\s/]*(?:([^\s=/>][^\s=/>]*|=[^\s=/>]*)\s*(=?)\s*)?")
_BARE = re.compile(r"[^\s>]*")
_SPACE = re.compile(r"[ \t\n\r\f]+")
_LONG_REFERENCE = re.compile(r"&#(?:[0-9]{8,}|[xX][0-9a-fA-F]{7,});?")
_DIGITS = re.compile(r"[ \t\n\f\r]*\+?([0-9]+)")


def _short_reference(m: re.Match) -> str:
    digits = m[0][2:].rstrip(";")
    kind, digits = ("x", digits[1:]) if digits[0] in "xX" else ("", digits)
    digits = digits.lstrip("0")
    return f"&#{kind}{digits or 0};" if len(digits) < 8 else "�"


def _unescape(s: str) -> str:
    if "&" not in s:
        return s
    return html.unescape(_LONG_REFERENCE.sub(_short_reference, s) if "&#" in s else s)


def _number(s: str, zero: int, most: int) -> int:
    """The number at the start of s, at most `most`; 1 where there is none."""
    m = _DIGITS.match(s)
    if not m:
        return 1
    digits = m[1].lstrip("0")
    return (min(int(digits), most) if len(digits) < 10 else most) if digits else zero


class Node:
    __slots__ = ("attrs", "children", "tag")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []

    def style(self, name: str) -> str:
        """The last inline declaration of a property, in lower case."""
        found = ""
        for part in self.attrs.get("style", "").split(";"):
            key, _, value = part.partition(":")
            if key.strip().lower() == name:
                found = value.lower().replace("!important", "").strip()
        return found

    def gone(self) -> bool:
        """Whether neither it nor anything in it is shown."""
        if self.tag in NEVER:
            return True
        if not self.attrs:
            return self.tag == "dialog"
        display = self.style("display")
        return display == "none" or not display and ("hidden" in self.attrs or self.tag == "dialog" and "open" not in self.attrs)


def _attributes(source: str, at: int) -> tuple[dict[str, str], int] | None:
    """(attributes, place behind the tag's end) from the place behind a tag's name; None if the page ends first."""
    out, n = {}, len(source)
    while at < n:
        m = _ATTR.match(source, at)
        at = m.end()
        if not m[1]:
            if source[at : at + 1] == ">":
                return out, at + 1
            if at >= n:
                return None
            at += 1
            continue
        value = ""
        if m[2]:
            quote = source[at : at + 1]
            if quote in ('"', "'"):
                end = source.find(quote, at + 1)
                if end < 0:
                    return None
                value, at = source[at + 1 : end], end + 1
            else:
                value = _BARE.match(source, at)[0]
                at += len(value)
        out.setdefault(m[1].lower(), _unescape(value))
    return None


def scan(source: str):
    """Tokens in order: ("text", text), ("start", tag, attributes), ("end", tag)."""
    at, n, held = 0, len(source), []
    while at < n:
        lt = source.find("<", at)
        if lt < 0:
            break
        after = source[lt + 1 : lt + 3]
        if after[:1].isalpha() and after[:1].isascii() or after[:1] == "/" and after[1:].isalpha() and after[1:].isascii():
            closing = after[0] == "/"
            name = _NAME.match(source, lt + 1 + closing)
            got = _attributes(source, name.end())
        elif after[:1] in ("!", "?", "/") and after:
            name, got = None, None
            if source.startswith("<!--", lt):
                end = source.find("-->", lt + 2)
                end = end + 3 if end >= 0 else n
            else:
                end = source.find(">", lt) + 1 or n
        else:  # a bare sign
            held.append(source[at : lt + 1])
            at = lt + 1
            continue
        held.append(source[at:lt])
        text = "".join(held)
        held = []
        if text:
            yield "text", _unescape(text)
        if name is None:
            at = end
            continue
        if got is None:
            return
        attrs, at = got
        tag = name[0].lower()
        if closing:
            yield "end", tag
            continue
        yield "start", tag, attrs
        if tag in RAW:
            end = None if tag == "plaintext" else re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
            body = source[at : end.start() if end else n]
            if body:
                yield "text", _unescape(body) if tag in DECODED else body
            yield "end", tag
            if not end:
                return
            got = _attributes(source, end.end())
            if got is None:
                return
            at = got[1]
    held.append(source[at:])
    text = "".join(held)
    if text:
        yield "text", _unescape(text)


class _Open:
    """The stack of open elements, with the places of each tag on it."""

    def __init__(self, root: Node):
        self.stack, self.places, self.special = [root], {}, [0]

    def last(self, tag: str) -> int:
        held = self.places.get(tag)
        return held[-1] if held else -1

    def bar(self, tags) -> int:
        return max(map(self.last, tags), default=-1)

    def push(self, node: Node) -> None:
        self.stack[-1].children.append(node)
        self.places.setdefault(node.tag, []).append(len(self.stack))
        if node.tag in SPECIAL:
            self.special.append(len(self.stack))
        self.stack.append(node)

    def close(self, at: int) -> None:
        """Close the element at this place and all in it."""
        while len(self.stack) > at:
            x = self.stack.pop()
            self.places[x.tag].pop()
            if x.tag in SPECIAL:
                self.special.pop()

    def first_above(self, tags, bars) -> int:
        """The outermost open element of tags inside the innermost bar, or -1."""
        bar, found = self.bar(bars), []
        for t in tags:
            held = self.places.get(t)
            if held and held[-1] > bar:
                found.append(held[bisect_right(held, bar)])
        return min(found, default=-1)


def parse(source: str) -> Node:
    """The tree; tags are never missing in it, though they may be in the source."""
    root = Node("#root", {})
    open_ = _Open(root)
    once: set[str] = set()
    for token in scan(source):
        if token[0] == "text":
            if open_.stack[-1].tag == "head" and token[1].strip():
                open_.close(len(open_.stack) - 1)
            open_.stack[-1].children.append(token[1])
            continue
        tag = token[1]
        if token[0] == "end":
            _end(open_, tag)
            continue
        if tag in ("html", "head", "body"):
            if tag in once:
                continue
            once.add(tag)
        if open_.stack[-1].tag == "head" and tag not in IN_HEAD:
            open_.close(len(open_.stack) - 1)
        if tag in IMPLIED_END:
            at = open_.first_above(*IMPLIED_END[tag])
            if at > 0:
                open_.close(at)
        if tag in BLOCK:
            p = open_.last("p")
            if p > open_.bar((*CELL_BARS, "button")):
                open_.close(p)
        if tag in ("td", "th") and open_.stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            open_.push(Node("tr", {}))
        node = Node(tag, token[2])
        if tag in VOID:
            open_.stack[-1].children.append(node)
        else:
            open_.push(node)
    return root


def _end(open_: _Open, tag: str) -> None:
    if tag == "br":
        open_.stack[-1].children.append(Node("br", {}))
        return
    at = open_.last(tag)
    if at < 1 or tag in ("html", "body"):
        return
    if tag not in SPECIAL:  # an end tag within another block doesn't close the element outside of it
        reaches = open_.special[-1] < at
    elif tag in TABLE_PARTS or tag == "table":
        reaches = open_.last("table") <= at
    else:
        reaches = open_.bar((*CELL_BARS, *LISTS) if tag == "li" else CELL_BARS) < at
    if reaches:
        open_.close(at)


class _Page:
    """Lines under way; wide blanks and empty lines are settled when text comes."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = self.space = False
        self.mark = ""

    def text(self, s: str) -> None:
        s = _SPACE.sub(" ", s)
        if s[:1] == " " and self.now:
            self.space = True
        words = s.strip(" ")
        if words:
            self.now.append((" " if self.space and self.now else "") + words)
            self.space = s[-1] == " "
        elif s and self.now:
            self.space = True

    def end(self, indent: str) -> None:
        if self.now:
            if self.blank and self.lines:
                self.lines.append("")
            self.blank = False
            self.lines.append(indent[: max(0, len(indent) - len(self.mark))] + self.mark + "".join(self.now) if self.mark else indent + "".join(self.now))
            self.now, self.mark = [], ""
        self.space = False


def _width(s: str) -> int:
    return len(s) if s.isascii() else sum(2 if unicodedata.east_asian_width(c) in "WF" else not unicodedata.combining(c) for c in s)


def grid(rows: list[list[tuple[str, int, int]]]) -> list[dict[int, str]]:
    """Rows of (text, column span, row span) as rows of column -> text, spanned places left out."""
    out: list[dict[int, str]] = []
    busy: list[tuple[int, int, int]] = []  # columns from, to, and the row before which cells above hold them
    for r, cells in enumerate(rows):
        line, at, k, now = {}, 0, 0, []
        for text, wide, high in cells:
            while k < len(busy) and busy[k][0] <= at:
                if busy[k][2] > r:
                    at = max(at, busy[k][1])
                    now.append(busy[k])
                k += 1
            line[at] = text
            if high > 1:
                if now and now[-1][1:] == (at, r + high):
                    now[-1] = (now[-1][0], at + wide, r + high)
                else:
                    now.append((at, at + wide, r + high))
            at += wide
        if cells:
            busy = now + busy[k:]
        out.append(line)
    return out


def _aligned(rows: list[list[tuple[str, int, int]]]) -> list[str]:
    """Rows of cells as lines; a cell may have lines of its own. Columns in which no cell begins take no room."""
    placed = grid(rows)
    place = {c: i for i, c in enumerate(sorted({c for line in placed for c in line}))}
    split = [{place[c]: t.split("\n") for c, t in line.items()} for line in placed]
    wide = [0] * len(place)
    for line in split:
        for c, parts in line.items():
            wide[c] = max(wide[c], *map(_width, parts))
    out = []
    for line in split:
        for i in range(max((len(parts) for parts in line.values() if parts != [""]), default=0)):
            cells = {c: parts[i] for c, parts in line.items() if i < len(parts) and parts[i]}
            out.append("  ".join((x := cells.get(c, "")) + " " * (wide[c] - _width(x)) for c in range(max(cells, default=-1) + 1)).rstrip(" "))
    return out


def render(root: Node) -> str:
    """Visible text of the tree; an explicit stack, so depth is no limit."""
    pages, tables = [_Page()], []
    lists: list[list] = []
    indents, verbatim = [""], 0
    work: list[tuple] = [(root, False, True)]
    in_ = lambda n: indents.append((indents[-1] + " " * n)[:MOST_INDENT])
    while work:
        x, leaving, shown = work.pop()
        page = pages[-1]
        if isinstance(x, str):
            if not shown:
                continue
            if verbatim:
                first, *more = x.split("\n")
                page.now.append(first) if first else None
                for line in more:
                    page.now = page.now or [""]
                    page.end(indents[-1])
                    page.now.append(line)
            elif not (tables and page is tables[-1]["outer"] and not x.strip()):
                page.text(x)
            continue
        tag = x.tag
        if not leaving:
            if x.gone():
                continue
            if x.attrs and (seen := x.style("visibility")):
                shown = {"hidden": False, "collapse": False, "visible": True}.get(seen, shown)
            work.append((x, True, shown))
            inner = x.children
            if tag in VERBATIM and inner and isinstance(inner[0], str) and inner[0][:1] == "\n":
                inner = [inner[0][1:], *inner[1:]]
            elif tag == "details" and "open" not in x.attrs:
                inner = [c for c in inner if isinstance(c, Node) and c.tag == "summary"]
            work.extend((c, False, shown) for c in reversed(inner))
            if tag == "br":
                page.now = page.now or [""]
                page.end(indents[-1])
            elif tag == "img":
                if shown:
                    page.text(x.attrs.get("alt", ""))
            elif tag in ("td", "th") and tables:
                if len(tables) > MOST_TABLES:
                    page.end(indents[-1])
                else:
                    pages.append(_Page())
                    indents.append("")
            elif tag == "tr" and tables:
                tables[-1]["rows"].append([])
            elif tag in BLOCK:
                page.end(indents[-1])
                if tag in SPACED or (tag in LISTS and not lists):
                    page.blank = True
                if tag == "hr":
                    if shown:
                        page.now = ["---"]
                        page.end(indents[-1])
                elif tag == "table":
                    tables.append({"rows": [], "outer": page})
                elif tag in LISTS:
                    start = x.attrs.get("start", "1")
                    lists.append(["ol" if tag == "ol" else "ul", int(start) if re.fullmatch(r"-?[0-9]{1,9}", start) else 1])
                elif tag == "li":
                    kind = lists[-1] if lists else ["ul", 1]
                    page.mark = (f"{kind[1]}. " if kind[0] == "ol" else "- ") if shown else ""
                    kind[1] += 1
                    in_(len(page.mark))
                elif tag in ("blockquote", "dd"):
                    in_(2)
            if tag in VERBATIM:
                verbatim += 1
            continue
        if tag in VERBATIM:
            verbatim -= 1
        if tag in ("td", "th") and tables:
            page.end("" if len(tables) <= MOST_TABLES else indents[-1])
            if len(tables) <= MOST_TABLES:
                pages.pop()
                indents.pop()
                rows = tables[-1]["rows"]
                if not rows:
                    rows.append([])
                wide = _number(x.attrs.get("colspan", ""), 1, MOST_COLUMNS)
                high = _number(x.attrs.get("rowspan", ""), MOST_ROWS, MOST_ROWS)
                rows[-1].append(("\n".join(page.lines), wide, high))
        elif tag in BLOCK:
            page.end(indents[-1])
            if tag == "table":
                for line in _aligned(tables.pop()["rows"]):
                    page.now = [line]
                    page.end(indents[-1])
            elif tag in LISTS:
                lists.pop()
            elif tag == "li":
                page.mark = ""
                indents.pop()
            elif tag in ("blockquote", "dd"):
                indents.pop()
            if tag in SPACED or (tag in LISTS and not lists):
                page.blank = True
    pages[0].end("")
    return "\n".join(x.rstrip() for x in pages[0].lines)


def text_of(source: str | None) -> str | None:
    return None if source is None else render(parse(source))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(page_id, text, n_lines), one row per row of pages.

    A null page has null text, an empty one empty text. Repeated rows get equal answers, an
    empty table none. A very long page is one tree in a worker's memory, made and set in
    time in proportion to its length. Other columns aren't read.
    """

    def work(batches):
        for b in batches:
            texts = [text_of(x.as_py()) for x in b.column(1)]
            lines = [None if t is None else t.count("\n") + bool(t) for t in texts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string()), pa.array(lines, pa.int64())], names=["page_id", "text", "n_lines"])

    return pages.select(F.col(id_col).cast("long"), html_col).mapInArrow(work, "page_id long, text string, n_lines long")


def op8_html_text(spark, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
