"""
Visible text of web pages, laid out in lines.

A page is cut into tags and text, a tree is built with the end and start tags that HTML lets authors
leave out and with misplaced content of tables in front of them, and the tree is walked once. Hidden parts give nothing; all other text is emitted, blocks
on lines of their own, list items behind their marks, table cells in aligned columns. Pages are
independent of each other: one scan, no shuffle, one page in memory besides its Arrow batch.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# The element sets of the HTML standard that matter for text.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD_ONLY = frozenset("base link meta noscript script style template title".split())
NEVER = frozenset("head script style template title iframe noembed noframes object video audio "
                  "canvas datalist".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table hr figure form "
                   "fieldset".split())
LINED = frozenset("address article aside body center dd details dialog dir div dt figcaption "
                  "footer header hgroup html legend li main menu nav option search section "
                  "summary caption tr tbody thead tfoot td th xmp listing".split())
CLOSES_P = (SPACED | LINED) - frozenset("body html option caption tr tbody thead tfoot td th"
                                        .split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LISTS = frozenset("ul ol menu dir".split())
SECTIONS = frozenset("tbody thead tfoot".split())
CELLS = frozenset("td th".split())
ROWED = SECTIONS | {"table", "tr"}              # hold only what lays out a table, and HELD
LAID = SECTIONS | CELLS | frozenset("caption colgroup col tr".split())
HELD = LAID | frozenset("form script style template".split())
UNSEEN = {"svg": frozenset("defs symbol desc metadata clippath mask marker pattern".split()),
          "math": frozenset({"annotation", "annotation-xml"})}
FORMATTING = frozenset("a b big code em font i nobr s small strike strong tt u".split())
BARRIER = frozenset("table td th caption html template object marquee".split())
# A start tag on the left ends the nearest open element on the right, if none of the last
# column is between them.
ENDS = {
    "li": (frozenset({"li"}), LISTS | BARRIER), "dt": (frozenset({"dt", "dd"}), {"dl"} | BARRIER),
    "dd": (frozenset({"dt", "dd"}), {"dl"} | BARRIER),
    "option": (frozenset({"option"}), {"select", "optgroup"} | BARRIER),
    "optgroup": (frozenset({"optgroup"}), {"select"} | BARRIER),
    "a": (frozenset({"a"}), BARRIER), "button": (frozenset({"button"}), BARRIER),
    "td": (CELLS, {"tr", "table"}), "th": (CELLS, {"tr", "table"}),
    "tr": (frozenset({"tr"}), SECTIONS | {"table"}),
    **{s: (SECTIONS | {"caption", "colgroup"}, {"table"}) for s in SECTIONS},
}

MOST_COLUMN = 40                # columns wider than this are not padded further
MOST_SPAN = 1000                # the standard's limit for colspan
NESTED_TABLES = 20              # tables deeper than this are laid out as plain blocks

_TOKEN = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*(?:>|\Z)|</(?![a-zA-Z])[^>]*(?:>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*)"
    r"(?P<rest>(?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(
    r"([^\s=>\"'/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_HIDDEN_STYLE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))",
                           re.I)
_SPACES = re.compile(r"[ \t\n\f\r]+")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list = field(default_factory=list)      # nodes and texts


class _Builder:
    """The open elements, and how many of each there are."""

    def __init__(self):
        self.root = Node("html")
        self.open = [self.root]
        self.count: dict[str, int] = {}
        self.beside: list[list] = []       # for each open table, the children it is one of

    def put(self, item: Node | str) -> None:
        """Into the open element; in front of the table what does not belong into its parts."""
        top, tag = self.open[-1].tag, item.tag if isinstance(item, Node) else ""
        blank = isinstance(item, str) and not item.strip(" \t\n\f\r")
        if top in ROWED and not blank and tag not in HELD and self.beside:
            self.beside[-1].insert(len(self.beside[-1]) - 1, item)
        else:
            self.open[-1].children.append(item)

    def push(self, node: Node) -> None:
        self.put(node)
        if node.tag == "table":
            self.beside.append(self.open[-1].children)
        self.open.append(node)
        self.count[node.tag] = self.count.get(node.tag, 0) + 1

    def pop_to(self, place: int) -> None:
        for node in self.open[place:]:
            self.count[node.tag] -= 1
            if node.tag == "table":
                self.beside.pop()
        del self.open[place:]

    def find(self, tags, barrier) -> int:
        """Place of the nearest open element of these, 0 if there is none before a barrier."""
        if any(self.count.get(t) for t in tags):
            for place in range(len(self.open) - 1, 0, -1):
                if self.open[place].tag in tags:
                    return place
                if self.open[place].tag in barrier:
                    return 0
        return 0

    def end(self, tags, barrier) -> None:
        if place := self.find(tags, barrier):
            self.pop_to(place)

    def leave_head(self) -> None:
        self.end({"head"}, frozenset())

    def leave_colgroup(self) -> None:
        if self.open[-1].tag == "colgroup":
            self.pop_to(len(self.open) - 1)

    @property
    def foreign(self) -> bool:
        return any(self.count.get(t) for t in UNSEEN)

    def lay_out(self, tag: str) -> None:
        """Before a part of a table, or a table: end what stands open between its parts."""
        if place := self.find(ROWED | LAID, frozenset({"template"})):
            if self.open[place].tag in ROWED:
                if tag == "table":
                    place = self.find({"table"}, frozenset()) - 1
                elif tag in ("caption", "colgroup", "col"):
                    place = self.find({"table"}, frozenset())
                self.pop_to(place + 1)
        if tag != "table":
            self.end({"caption"} if tag == "col" else {"caption", "colgroup"}, CELLS | {"table"})

    def start(self, tag: str, attributes: dict[str, str], closed: bool = False) -> None:
        if tag in ("html", "body"):
            if tag == "body":
                self.leave_head()
            # A second one only adds its attributes; what they hide is hidden.
            self.root.attributes.update({k: v for k, v in attributes.items()
                                         if k not in self.root.attributes})
            return
        if tag not in HEAD_ONLY and tag != "head":
            self.leave_head()
        if tag not in ("col", "template"):
            self.leave_colgroup()
        if self.count.get("table") and (tag in LAID or tag == "table"):
            self.lay_out(tag)
        if tag in CLOSES_P:
            self.end({"p"}, BARRIER | {"button"})
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.pop_to(len(self.open) - 1)
        if tag in ENDS:
            self.end(*ENDS[tag])
        if tag in SECTIONS or tag == "tr":
            self.end(CELLS, {"table"})
            self.end({"tr"}, {"table"})
        top = self.open[-1].tag
        if tag == "tr" and top == "table":
            self.push(Node("tbody"))
        if tag in CELLS and top != "tr":
            if top == "table":
                self.push(Node("tbody"))
            if self.open[-1].tag in SECTIONS:
                self.push(Node("tr"))
        if tag in ("text", "mtr", "mtd") and self.foreign:
            self.put(" ")
        node = Node(tag, attributes)
        if tag in VOID or closed or tag == "form" and self.open[-1].tag in ROWED:
            self.put(node)
        else:
            self.push(node)

    def finish(self, tag: str) -> None:
        if tag == "br":
            self.start("br", {})
        elif tag == "p" and not self.find({"p"}, BARRIER | {"button"}):
            self.start("p", {})
            self.pop_to(len(self.open) - 1)
        elif tag in ("html", "body"):
            self.leave_head()
        elif tag in FORMATTING:
            # Blocks opened inside stay open: only the formatting ends.
            if place := self.find({tag}, BARRIER):
                if any(n.tag in CLOSES_P for n in self.open[place + 1:]):
                    self.count[tag] -= 1
                    del self.open[place]
                else:
                    self.pop_to(place)
        else:
            tags = HEADINGS if tag in HEADINGS else {tag}
            own = {"template"} if tag == "table" else {"table"} if tag in \
                CELLS | SECTIONS | {"tr", "caption"} else BARRIER - tags
            self.end(tags, own)

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head" and text.strip(" \t\n\f\r"):
            self.leave_head()
        if self.count.get("svg") and not (self.count.get("text")
                                          or self.count.get("foreignobject")):
            return
        if not any(self.count.get(t) and any(map(self.count.get, unseen))
                   for t, unseen in UNSEEN.items()):
            if text.strip(" \t\n\f\r"):
                self.leave_colgroup()
            self.put(text)


def _attributes(rest: str) -> dict[str, str]:
    """Attributes by lower-case name; of repeated ones the first counts."""
    out: dict[str, str] = {}
    for name, *values in _ATTRIBUTE.findall(rest):
        out.setdefault(name.lower(), unescape(next((v for v in values if v), "")))
    return out


def parse(html: str) -> Node:
    """The tree of a page; anything is a page."""
    builder, at = _Builder(), 0
    while match := _TOKEN.search(html, at):
        if match.start() > at:
            builder.text(unescape(html[at:match.start()]))
        at = match.end()
        if tag := match["tag"]:
            tag = tag.lower()
            if match["end"]:
                builder.finish(tag)
                continue
            closed = builder.foreign and match["rest"].endswith("/")
            builder.start(tag, _attributes(match["rest"]) if match["rest"].strip(" /") else {},
                          closed)
            if closed:
                continue
            if tag in ("pre", "listing", "textarea") and html.startswith(("\n", "\r\n"), at):
                at = html.index("\n", at) + 1      # a first line end there does not count
            if tag in RAW:
                stop = re.compile(rf"</{tag}(?=[\s/>])", re.I).search(html, at)
                raw = html[at:stop.start() if stop else len(html)]
                builder.text(unescape(raw) if tag in ("textarea", "title") else raw)
                at = stop.start() if stop else len(html)
    if at < len(html):
        builder.text(unescape(html[at:]))
    return builder.root


def hidden(node: Node) -> bool:
    """Elements that a browser shows nothing of."""
    a = node.attributes
    return node.tag in NEVER or bool(a) and (
        "hidden" in a or bool(_HIDDEN_STYLE.search(a.get("style", "")))
    ) or node.tag == "dialog" and "open" not in a


class _Lines:
    """Lines of text; block breaks are kept back until text follows."""

    def __init__(self):
        self.out: list[str] = []
        self.line: list[str] = []
        self.breaks = 0              # line ends owed before the next text
        self.space = False
        self.indents: list[str] = []
        self.mark = ""

    def block(self, ends: int) -> None:
        if self.line:
            self.out.append("".join(self.line).rstrip(" "))
            self.line = []
            self.breaks = max(self.breaks, ends)
        elif self.out and not self.mark:
            self.breaks = max(self.breaks, ends)
        self.space = False

    def _begin(self) -> None:
        if not self.line:
            self.out += [""] * (self.breaks - 1) if self.out else []
            self.breaks = 0
            indent = "".join(self.indents)
            self.line.append(indent[:len(indent) - len(self.mark)] + self.mark)
            self.mark = ""

    def inline(self, text: str) -> None:
        for k, word in enumerate(_SPACES.split(text)):
            self.space |= k > 0
            if word:
                if self.line and self.space:
                    self.line.append(" ")
                self._begin()
                self.line.append(word)
                self.space = False

    def rows(self, rows: list[str]) -> None:
        """Lines as they stand, empty ones too."""
        for row in rows:
            self._begin()
            self.line.append(row)
            self.newline()

    def newline(self) -> None:
        self._begin()
        self.out.append("".join(self.line).rstrip(" "))
        self.line = []
        self.space = False

    def enter(self, width: int, mark: str = "") -> None:
        self.indents.append(" " * width)
        self.mark = (self.mark + mark) if mark else self.mark

    def leave(self) -> None:
        self.block(1)
        self.mark = ""
        self.indents.pop()

    def result(self) -> str:
        self.block(0)
        return "\n".join(self.out).strip("\n")


def _grid(table: Node) -> list[list[tuple[Node, int]]]:
    """Rows of (cell, first column), spans taken into account."""
    rows = []
    for part in table.children:
        if isinstance(part, Node) and not hidden(part):
            rows += [part] if part.tag == "tr" else [
                r for r in part.children if isinstance(r, Node) and r.tag == "tr"
                and not hidden(r)] if part.tag in SECTIONS else []
    taken: dict[int, int] = {}                        # column -> rows it is still taken for
    grid = []
    for row in rows:
        cells, column, spans = [], 0, []
        for cell in row.children:
            if not isinstance(cell, Node) or cell.tag not in CELLS or hidden(cell):
                continue
            while taken.get(column, 0) > 0:
                column += 1
            cells.append((cell, column))
            wide, high = (_span(cell.attributes.get(k, "1")) for k in ("colspan", "rowspan"))
            spans += [(c, high) for c in range(column, column + wide)]
            column += wide
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        taken.update({c: n - 1 for c, n in spans if n > 1})
        grid.append(cells)
    return grid


def _span(value: str) -> int:
    digits = re.match(r"\s*(\d{1,4})", value)
    return min(max(1, int(digits[1])), MOST_SPAN) if digits else 1


def _table(table: Node, lines: _Lines, depth: int) -> None:
    for part in table.children:
        if isinstance(part, Node) and part.tag == "caption" and not hidden(part):
            lines.rows(render(part, depth + 1).split("\n"))
    grid = [[(column, render(cell, depth + 1).split("\n")) for cell, column in row]
            for row in _grid(table)]
    widths: dict[int, int] = {}
    for row in grid:
        for column, text in row:
            widths[column] = max(widths.get(column, 0), min(MOST_COLUMN, max(map(len, text))))
    used = sorted(c for c, w in widths.items() if w)
    for row in grid:
        by_column = dict(row)
        for k in range(max([len(t) for _, t in row if any(t)], default=0)):
            parts = []
            for c in used:
                text = by_column.get(c, [])
                parts.append((text[k] if k < len(text) else "").ljust(widths[c]))
            lines.rows(["  ".join(parts).rstrip()])


def render(node: Node, depth: int = 0) -> str:
    """The lines of an element's visible text."""
    lines = _Lines()
    numbers: list[int] = []
    work: list = [(child, False) for child in reversed(node.children)]
    preserved = 0
    while work:
        item, ending = work.pop()
        if isinstance(item, str):
            if preserved:
                first, *more = item.replace("\r\n", "\n").split("\n")
                for k, row in enumerate([first, *more]):
                    if k:
                        lines.newline()
                    if row:
                        lines._begin()
                        lines.line.append(row)
            else:
                lines.inline(item)
            continue
        tag = item.tag
        if ending:
            if tag == "pre":
                preserved -= 1
            if tag in LISTS:
                numbers.pop()
            if tag in ("li", "dd", "blockquote"):
                lines.leave()
            lines.block(_gap(tag, numbers))
            continue
        if hidden(item):
            continue
        if tag == "br":
            lines.newline()
            continue
        gap = _gap(tag, numbers)
        if gap:
            lines.block(gap)
        if tag == "hr" or tag in VOID:
            continue
        if tag == "table" and depth < NESTED_TABLES:
            _table(item, lines, depth)
            lines.block(gap)
            continue
        if tag == "pre":
            preserved += 1
        elif tag in LISTS:
            start = re.match(r"\s*(-?\d{1,9})", item.attributes.get("start", ""))
            numbers.append((int(start[1]) if start else 1) if tag == "ol" else None)
        elif tag == "li":
            mark = "- "
            if numbers and numbers[-1] is not None:
                mark = f"{numbers[-1]}. "
                numbers[-1] += 1
            lines.enter(len(mark), mark)
        elif tag in ("dd", "blockquote"):
            lines.enter(4 if tag == "dd" else 2)
        if gap or tag in LISTS or tag == "pre":
            work.append((item, True))
        children = item.children
        if tag == "details" and "open" not in item.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        work += [(child, False) for child in reversed(children)]
    return lines.result()


def _gap(tag: str, numbers: list) -> int:
    """Line ends around an element: 2 leave an empty line; a list in a list has none."""
    if tag in LISTS:
        return 1 if len(numbers) > 0 else 2
    return 2 if tag in SPACED else 1 if tag in LINED else 0


def text_of(html: str) -> str:
    root = parse(html)
    return "" if hidden(root) else render(root)


def visible_text(html: Column) -> Column:
    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([None if p is None else text_of(p) for p in
                         (x.as_py() for x in pages)], pa.string())
    return extracted(html)


def extract(pages: DataFrame) -> DataFrame:
    """
    pages (html, ...) with all its columns and text, the visible text; a column text is replaced.

    Every row stays. A null page has a null text, an empty or wholly hidden one an empty text.
    Broken markup is read as far as it goes. Repeated rows are treated alike; no other column is
    looked at; an empty table gives an empty one.
    """
    return pages.withColumn("text", visible_text(F.col("html")))
