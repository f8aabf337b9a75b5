"""Layout-aware rendering of HTML pages to plain text.

A tree builder reads tags, comments and character references, adds the tags that HTML lets authors leave out (the end of a
paragraph before a block, of a list item before the next, of a row, a cell, an option, of the head; the row around a
lone cell) and closes what is left open. The tree is then laid out:

* hidden are the head, scripts, styles, templates, form values, elements with ``hidden``, with ``display:none`` or
  ``visibility:hidden`` (a descendant may be visible again, as in CSS), and closed ``details`` but their summary;
* blocks begin on a line of their own; paragraphs, headings, lists and tables keep one empty line around them;
* list items get a bullet or their number and are indented by depth;
* cells of a table are aligned in columns, the lines of a cell one below the other, ``colspan`` and ``rowspan`` counted; what stands
  before another cell is broken into lines of ``WIDEST`` characters, so columns stay in line (a longer word moves its line's rest);
* of an svg the text elements and foreign objects are shown, of a formula all tokens with a space between them; what they
  only define, name or annotate (``defs``, ``title``, ``annotation`` and the like) isn't, nor is a copy that ``use`` draws;
* white space collapses to one space but in ``pre``, ``xmp`` and ``textarea``; a no-break space stays a space.

Everything else that is text is emitted, boilerplate too: choosing among visible text is another operator's work. Pages are
rendered row by row inside tasks, without recursion, so nesting of any depth is read, in time that grows with the page: margins
and aligned tables go ``DEEPEST`` levels deep, what is nested deeper stands at the last margin or as plain blocks, all of it.

Defined results: a null page is an empty text; text without any tag is one paragraph; tags that are cut off at the end of
the page are dropped, an unfinished comment or script hides the rest; a number that isn't one, or has over nine digits, counts as
not given (a span is at most 1000 columns or 65534 rows); an empty table gives an empty result; rows that repeat a page are rendered each.
"""

import re
from bisect import bisect_right
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship

# Fixed values of the HTML standard: kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
HIDDEN = frozenset("head script style template title noscript datalist audio video canvas iframe object noembed noframes "
                   "rp area param source track".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure hr fieldset".split())
BLOCKS = SPACED | frozenset("address article aside body caption center dd details dialog dir div dt figcaption footer form "
                            "header hgroup html legend li listing main nav optgroup option plaintext search section "
                            "select summary tbody td textarea tfoot th thead tr xmp".split())
CLOSES_P = (BLOCKS - frozenset("body caption html li option optgroup select tbody td textarea tfoot th thead tr".split())
            | frozenset(["li"]))
LISTS = frozenset("ul ol menu dir".split())
CELLS = frozenset(["td", "th"])
SECTIONS = frozenset("tbody thead tfoot".split())
#: For a start tag: the open elements it ends, and the elements beyond which it doesn't look.
ENDS = {
    "li": ({"li"}, LISTS | {"table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}), "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "optgroup", "datalist"}), "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS | {"caption"}, {"tr", "table"}), "th": (CELLS | {"caption"}, {"tr", "table"}),
    "tr": ({"tr", "caption"} | CELLS, {"table"}),
    **{s: (SECTIONS | {"tr", "caption", "colgroup"} | CELLS, {"table"}) for s in SECTIONS},
    **{h: ({"h1", "h2", "h3", "h4", "h5", "h6"}, BLOCKS - SPACED | {"table", "ul", "ol", "blockquote"})
       for h in ("h1", "h2", "h3", "h4", "h5", "h6")},
}
#: Elements of svg and math that show nothing themselves, those in which HTML may stand, and the tags that end foreign content.
UNDRAWN = {
    "svg": frozenset("defs symbol clippath mask marker pattern lineargradient radialgradient filter desc metadata".split()),
    "math": frozenset("annotation annotation-xml mphantom".split()),
}
UNDRAWN["text"] = UNDRAWN["svg"]
HTML_INSIDE = {"svg": frozenset("foreignobject desc title".split()), "text": frozenset("foreignobject desc title".split()),
               "math": frozenset("mi mo mn ms mtext annotation-xml".split())}
TOKENS = HTML_INSIDE["math"]
BREAKS_OUT = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                       "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
P_SCOPE = frozenset("table td th caption button object template html body".split())

#: Characters of a line in a cell that has another one behind it.
WIDEST = 80
#: Levels of margins, and of tables within cells, that are laid out as such.
DEEPEST = 32

_NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})(?![0-9])")

_TAG = re.compile(r"""
    <!--(?:>|->|.*?--!?>|.*\Z) | <[!?][^>]*(?:>|\Z) |
    </(?P<end>[a-zA-Z][^\s/>]*)[^>]*(?:>|\Z) | </[^a-zA-Z][^>]*(?:>|\Z) |
    <(?P<start>[a-zA-Z][^\s/>]*)(?P<attrs>(?>(?:[^>"'=]+|=\s*"[^"]*"|=\s*'[^']*'|["'=])*))(?:>|\Z)
""", re.VERBOSE | re.DOTALL)
_ATTR = re.compile(r"""([^\s=/"'<>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_BARE_SLASH = re.compile(r"""=\s*[^\s"'>][^\s"'>]*/\Z""")
_SPACE = re.compile("[ \t\n\r\f]+")
_HIDE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.IGNORECASE)
_VISIBILITY = re.compile(r"(?:^|;)\s*visibility\s*:\s*(hidden|collapse|visible)\b", re.IGNORECASE)


class Node:
    #: ``foreign`` is svg, text (from a text element of an svg on), math, or empty for HTML.
    __slots__ = ("tag", "attrs", "children", "foreign")

    def __init__(self, tag: str, attrs: dict[str, str], foreign: str = ""):
        self.tag, self.attrs, self.children, self.foreign = tag, attrs, [], foreign


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), unescape(a or b or c))
    return out


def _number(text: str, otherwise: int) -> int:
    """The whole number a value begins with."""
    found = _NUMBER.match(text)
    return int(found[1]) if found else otherwise


class Builder:
    """Makes a tree of nodes and strings."""

    def __init__(self):
        self.root = Node("", {})
        self.open = [self.root]
        #: Places in ``open`` of each tag, and of all blocks, so that no lookup walks through the open elements.
        self.places: dict[str, list[int]] = {}
        self.blocks: list[int] = []

    def _enter(self, node: Node) -> None:
        at = len(self.open)
        self.open.append(node)
        self.places.setdefault(node.tag, []).append(at)
        if node.tag in BLOCKS:
            self.blocks.append(at)

    def _close(self, at: int) -> None:
        """Closes the open element at a place and all in it."""
        while len(self.open) > at:
            node = self.open.pop()
            self.places[node.tag].pop()
            if node.tag in BLOCKS:
                self.blocks.pop()

    def _last(self, tags) -> int:
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)

    def _end_nearest(self, tags, scope) -> None:
        """Closes the outermost open element of ``tags`` this side of ``scope``, with all in it."""
        if not self._last(tags):
            return
        border = self._last([t for t in scope if t not in tags])
        inside = [self.places[t] for t in tags if self.places.get(t)]
        found = min((p[k] for p in inside if (k := bisect_right(p, border)) < len(p)), default=0)
        if found:
            self._close(found)

    def foreign(self) -> str:
        """The kind of foreign content that a tag read now would belong to."""
        here = self.open[-1]
        return "" if here.foreign and here.tag in HTML_INSIDE[here.foreign] else here.foreign

    def start(self, tag: str, attrs: dict[str, str], closed: bool = False) -> Node:
        if tag in BREAKS_OUT or tag == "font" and not attrs.keys().isdisjoint(("color", "face", "size")):
            while self.foreign():
                self._close(len(self.open) - 1)
        kind = self.foreign()
        if kind or tag in ("svg", "math"):
            if self.open[-1].tag == "head":
                self._close(len(self.open) - 1)
            node = Node(tag, attrs, tag if tag in ("svg", "math") else "text" if (kind, tag) == ("svg", "text") else kind)
            self.open[-1].children.append(node)
            if not closed:
                self._enter(node)
            return node
        if self.open[-1].tag == "head" and tag not in HEAD:
            self._close(len(self.open) - 1)
        if tag in CLOSES_P:
            self._end_nearest(("p",), P_SCOPE)
        if tag in ENDS:
            self._end_nearest(*ENDS[tag])
        if tag in CELLS and self.open[-1].tag in ("table", *SECTIONS):
            self.start("tr", {})
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self._enter(node)
        return node

    def end(self, tag: str) -> None:
        own = self._last([tag])
        # The end of an inline element doesn't reach out of a block, and none but its own out of a table.
        border = max(self.blocks[-1] if tag not in BLOCKS and self.blocks else 0, self._last(["table"]) if tag != "table" else 0)
        if border > own:
            return
        if own:
            self._close(own)
        elif tag == "br":
            self.start("br", {})

    def text(self, text: str) -> None:
        if self.open[-1].tag == "head" and not text.isspace():
            self._close(len(self.open) - 1)
        self.open[-1].children.append(text)


def _self_closed(attrs: str | None) -> bool:
    """Whether a start tag ends in a slash that isn't part of a value without quotes."""
    return bool(attrs) and attrs.endswith("/") and not _BARE_SLASH.search(attrs)


def parse(html: str) -> Node:
    builder, at, size = Builder(), 0, len(html)
    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            builder.text(unescape(html[at:]))
            break
        found = _TAG.match(html, begin)
        if not found:  # a lone angle bracket is text
            builder.text(unescape(html[at:begin + 1]))
            at = begin + 1
            continue
        if begin > at:
            builder.text(unescape(html[at:begin]))
        if html.startswith("<![CDATA[", begin) and builder.open[-1].foreign:
            until = html.find("]]>", begin)
            builder.text(html[begin + 9:until if until >= 0 else size])
            at = until + 3 if until >= 0 else size
            continue
        at = found.end()
        if name := found["end"]:
            builder.end(name.lower())
        elif name := found["start"]:
            tag = name.lower()
            attrs = found["attrs"]
            node = builder.start(tag, _attributes(attrs) if attrs else {}, _self_closed(attrs))
            if tag in RAW and not node.foreign:
                close = re.compile(f"</{tag}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                until = close.start() if close else size
                if tag == "textarea":
                    builder.text(unescape(html[at:until]).removeprefix("\n"))
                elif tag == "xmp":
                    builder.text(html[at:until])
                at = until
    return builder.root


class _Lines:
    """Text being laid out: lines done, and the line begun."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.space = False
        self.gap = 0  # 1: a new line is due; 2: an empty line before it
        self.indent: list[str] = []
        self.mark = ""

    def add(self, text: str, keep: bool) -> None:
        if keep:
            for k, part in enumerate(text.split("\n")):
                if k:
                    self.new_line()
                if part:
                    self._begin()
                    self.line.append(part)
            return
        if not text:
            return
        words = _SPACE.sub(" ", text)
        if words == " ":
            self.space = self.space or bool(self.line) and not self.gap
            return
        lead = words[0] == " " or self.space
        self._begin()
        if lead and self.line_has_text:
            self.line.append(" ")
        self.line.append(words.strip(" "))
        self.space, self.line_has_text = words[-1] == " ", True

    line_has_text = False

    def _begin(self) -> None:
        if self.gap:
            self._flush()
            if self.gap > 1 and self.lines and self.lines[-1]:
                self.lines.append("")
            self.gap, self.space = 0, False
        if not self.line:
            margin = "".join(self.indent[:DEEPEST])
            if self.mark:
                margin = margin[:len(margin) - len(self.mark)] + self.mark
                self.mark = ""
            self.line.append(margin)
            self.line_has_text = False

    def _flush(self) -> None:
        if self.line:
            self.lines.append("".join(self.line).rstrip(" "))
        self.line, self.space, self.line_has_text = [], False, False

    def new_line(self) -> None:
        """A line break in the text."""
        if self.gap:
            self._begin()
        if not self.line:
            self.lines.append("")
        self._flush()

    def block(self, gap: int) -> None:
        if self.line or self.lines:
            self.gap = max(self.gap, gap)
        self.space = False

    def whole(self) -> list[str]:
        self._flush()
        first = next((k for k, line in enumerate(self.lines) if line.strip()), len(self.lines))
        last = next((k for k in range(len(self.lines), 0, -1) if self.lines[k - 1].strip()), first)
        return self.lines[first:last]


def _broken(lines: list[str]) -> list[str]:
    """Lines broken at spaces where they are longer than ``WIDEST``."""
    out = []
    for line in lines:
        if len(line) <= WIDEST:
            out.append(line)
            continue
        held, size = [], 0
        for word in line.split(" "):
            if held and size + len(word) > WIDEST:
                out.append(" ".join(held))
                held, size = [], 0
            held.append(word)
            size += len(word) + 1
        out.append(" ".join(held))
    return out


class _Table:
    """Cells being laid out: of each row the first column and the lines of every cell."""

    def __init__(self):
        self.rows: list[list[tuple[int, list[str]]]] = []
        self.next = 0  # column of the next cell
        self.under: set[int] = set()  # columns of this row that a cell from above takes
        self.hanging: dict[int, int] = {}  # for how many further rows columns are taken

    def begin_row(self) -> None:
        self.rows.append([])
        self.next, self.under = 0, set(self.hanging)
        self.hanging = {column: left - 1 for column, left in self.hanging.items() if left > 1}

    def place(self, lines: list[str], across: int, down: int) -> None:
        while self.next in self.under:
            self.next += 1
        self.rows[-1].append((self.next, lines))
        if down > 1:
            for column in range(self.next, self.next + across):
                self.hanging[column] = max(down - 1, self.hanging.get(column, 0))
        self.next += across

    def lines(self) -> list[str]:
        rows = [r for r in self.rows if any(cell for _, cell in r)]
        rows = [[(c, _broken(cell) if k + 1 < len(r) else cell) for k, (c, cell) in enumerate(r)] for r in rows]
        width: dict[int, int] = {}
        for row in rows:
            for column, cell in row:
                width[column] = max([width.get(column, 0), *(min(WIDEST, len(line)) for line in cell)])
        begin, at = {}, 0
        for column in sorted(width):
            begin[column] = at
            at += width[column] + 2
        out = []
        for row in rows:
            for k in range(max(len(cell) for _, cell in row)):
                line = ""
                for column, cell in row:
                    if k < len(cell) and cell[k]:
                        line = (line + "  " if len(line) + 2 > begin[column] and line else line.ljust(begin[column])) + cell[k]
                out.append(line.rstrip(" "))
        return out


def _visibility(node: Node, shown: bool) -> tuple[bool, bool]:
    """Whether the element takes part in layout at all, and whether its own text is shown."""
    attrs = node.attrs
    if node.tag in HIDDEN or node.foreign and node.tag in UNDRAWN[node.foreign]:
        return False, False
    if node.foreign in ("svg", "text") and attrs:
        if attrs.get("display", "").strip() == "none":
            return False, False
        if attrs.get("visibility", "").strip() in ("hidden", "collapse", "visible"):
            shown = attrs["visibility"].strip() == "visible"
    if attrs:
        if "hidden" in attrs and attrs["hidden"].lower() != "until-found":
            return False, False
        if node.tag == "dialog" and "open" not in attrs:
            return False, False
        if style := attrs.get("style"):
            if _HIDE.search(style):
                return False, False
            if found := _VISIBILITY.findall(style):
                return True, found[-1].lower() == "visible"
    elif node.tag == "dialog":
        return False, False
    return True, shown


def render(html: str | None) -> str:
    """The visible text of a page."""
    if not html:
        return ""
    outs, tables, numbers = [_Lines()], [], []
    # What is still to do, last first: a node or string with its setting, or a function.
    todo: list = [(child, True, False) for child in reversed(parse(html).children)]
    while todo:
        task = todo.pop()
        if callable(task):
            task()
            continue
        item, shown, keep = task
        out = outs[-1]
        if isinstance(item, str):
            if shown:
                out.add(item, keep)
            continue
        tag = item.tag
        if item.foreign:
            there, shown = _visibility(item, shown)
            if there:
                children, apart = item.children, True
                if item.foreign == "svg" and tag != "foreignobject":  # outside of text elements nothing is drawn as text
                    children, apart = [c for c in children if isinstance(c, Node)], False
                elif item.foreign == "text":
                    apart = tag == "text" or not item.attrs.keys().isdisjoint(("x", "y", "dx", "dy"))
                elif item.foreign == "math" and tag not in TOKENS:
                    apart = tag == "math"
                if apart:
                    out.add(" ", False)
                    todo.append(lambda out=out: out.add(" ", False))
                todo.extend((child, shown, keep) for child in reversed(children))
            continue
        there, shown = _visibility(item, shown)
        if not there:
            continue
        if tag == "br":
            out.new_line()
            continue
        if tag == "wbr" or tag in VOID and tag not in ("hr", "input"):
            continue
        if tag == "input":
            if shown and item.attrs.get("type", "").lower() in ("submit", "button", "reset") and item.attrs.get("value"):
                out.add(f" {item.attrs['value']} ", False)
            continue
        keep = keep or tag in ("pre", "textarea", "listing", "xmp", "plaintext")
        children = item.children
        if tag == "details" and "open" not in item.attrs:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
        if tag in CELLS and tables and tables[-1] and tables[-1].rows:
            outs.append(_Lines())

            def cell(across=_number(item.attrs.get("colspan", ""), 1), down=_number(item.attrs.get("rowspan", ""), 1)):
                down = 65534 if down == 0 else down  # to the end of the table
                tables[-1].place(outs.pop().whole(), min(max(across, 1), 1000), min(max(down, 1), 65534))

            todo.append(cell)
        elif tag == "table" and len(tables) >= DEEPEST:
            out.block(2)
            tables.append(None)

            def deep_table(out=out):
                tables.pop()
                out.block(2)

            todo.append(deep_table)
        elif tag == "table":
            out.block(2)
            tables.append(_Table())
            outs.append(_Lines())  # what stands in a table outside its cells goes before it

            def table():
                outside = outs.pop().whole()
                outs[-1].block(2)
                for line in outside + tables.pop().lines():
                    outs[-1].block(1)
                    outs[-1].add(line, True)
                outs[-1].block(2)

            todo.append(table)
        elif tag == "tr" and tables and tables[-1]:
            tables[-1].begin_row()
        elif tag in LISTS:
            nested = bool(numbers)
            out.block(1 if nested else 2)
            numbers.append(_number(item.attrs.get("start", ""), 1) if tag == "ol" else None)

            def end_list(out=out, nested=nested):
                numbers.pop()
                out.block(1 if nested else 2)

            todo.append(end_list)
        elif tag == "li":
            out.block(1)
            number = numbers[-1] if numbers else None
            mark = "- " if number is None else f"{number}. "
            if number is not None:
                numbers[-1] = number + 1
            out.indent.append(" " * len(mark))
            out.mark = mark

            def end_item(out=out):
                out.indent.pop()
                out.mark = ""
                out.block(1)

            todo.append(end_item)
        elif tag in ("dd", "blockquote"):
            gap = 2 if tag == "blockquote" else 1
            out.block(gap)
            out.indent.append("  ")

            def end_indent(out=out, gap=gap):
                out.indent.pop()
                out.block(gap)

            todo.append(end_indent)
        elif tag in BLOCKS:
            gap = 2 if tag in SPACED else 1
            out.block(gap)
            todo.append(lambda out=out, gap=gap: out.block(gap))
        elif tag in ("td", "th"):
            out.add(" ", False)
        if tag == "q":
            out.add('"', False)
            todo.append(lambda out=out: out.add('"', False))
        todo.extend((child, shown, keep) for child in reversed(children))
    return "\n".join(outs[0].whole()).replace("\xa0", " ")


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the visible text of each page more."""
    ship(pages.sparkSession)

    @F.pandas_udf("string")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([render(page) if isinstance(page, str) else "" for page in batch], dtype=object)

    return pages.withColumn(text, of(F.col(html).cast("string")))
