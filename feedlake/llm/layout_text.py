"""Layout-aware text of web pages: a tree builder with implied tags, visibility rules, and a renderer that keeps blocks, lists and
aligned table cells.

Tree. A linear scan cuts tags, comments and text. Void elements do not nest; a start tag closes what it implies closed (p before
a block, li before li, cells and rows before the next, and so on, never beyond the nearest list or table); an end tag closes up to its match, or is
dropped when there is none. Unclosed elements close at the end. In a tag, a quote opens a value only right after "=" (and white space);
elsewhere it is a character like others. HTML elements inside svg or math close these, as in browsers.

Visible: everything but script, style, head, template and other elements without text of their own, elements with `hidden` or aria-hidden="true",
display:none or content-visibility:hidden, and hidden inputs; under visibility:hidden only what is visibility:visible again, the rest keeping
its place (breaks, numbers, cells). Of a style the last declaration of a property counts, important ones first. Of svg, what text and foreignObject hold, one line each; of math, all but annotations and phantoms.

Rendering. White space collapses outside pre. Blocks start a line; paragraphs, headings, lists, tables and quotes are set off by
one empty line. List items carry "- " or their number (by start, reversed and value), indented by depth. Table cells stand in columns by colspan and rowspan, a cell's
lines below each other, padded to the width of the columns before. A row of one cell, and the cells of a layout table one after the
other, are written as blocks, with their lists and empty lines. A layout table is one with prose side by side (a cell of several lines, one over
PROSE characters), or one that padding would make more than MOST_PADDED times as long as its text: long lines beside many short rows.
"""

from __future__ import annotations

import re
from html import unescape
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql.types import StringType, StructField

from feedlake.llm.rows import map_texts

PROSE = 80
MOST_PADDED = 20

#: Element classes of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("script style head title template noscript iframe object canvas audio video datalist noembed noframes".split())
#: Inside svg and math: elements that are not drawn, those that hold HTML again, and the start tags that end svg and math.
UNDRAWN = frozenset("desc defs metadata symbol clippath mask marker pattern annotation annotation-xml mphantom".split())
HOLDS_HTML = frozenset("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
SVG_TEXT = frozenset(["text", "foreignobject"])
BREAKS_OUT = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre ruby s small span"
    " strong strike sub sup table tt u ul var".split()
)
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6"
    " header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table ul".split()
)
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul".split())
CLOSES_P = BLOCK - {"html", "body", "option", "optgroup", "legend", "summary"}
LISTS = frozenset(["ul", "ol", "menu", "dir"])
CELLS = frozenset(["td", "th"])
ROWGROUPS = frozenset(["thead", "tbody", "tfoot"])
#: A start tag closes open elements of these names, up to the nearest boundary.
IMPLIED = {
    "li": ({"li"}, LISTS),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": (CELLS, {"tr", "table"}),
    "th": (CELLS, {"tr", "table"}),
    "tr": ({"tr"}, {"table"}),
    **{g: (ROWGROUPS | {"caption", "colgroup", "tr"}, {"table"}) for g in ROWGROUPS},
}

_name = re.compile(r"[A-Za-z][^\s/>]*").match
_between = re.compile(r"[ \t\n\f\r/]*").match
_attribute = re.compile(r"[^ \t\n\f\r/>][^ \t\n\f\r/>=]*").match
_equals = re.compile(r"[ \t\n\f\r]*=[ \t\n\f\r]*").match
_unquoted = re.compile(r"[^ \t\n\f\r>]*").match
_whole = re.compile(r"[ \t\n\f\r]*\+?([0-9]+)").match
_integer = re.compile(r"[ \t\n\f\r]*([+-]?[0-9]{1,9})").match
_comment_end = re.compile(r"--!?>").search
# of a style: a declaration up to the next semicolon outside comments, quotes and parentheses
_declarations = re.compile(r"""(?:/\*.*?(?:\*/|\Z)|"(?:[^"\\]|\\.)*(?:"|\Z)|'(?:[^'\\]|\\.)*(?:'|\Z)|\([^)]*(?:\)|\Z)|[^;])+""", re.S).findall
_comments = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_spaces = re.compile(r"[ \t\n\f\r]+")


class Element:
    __slots__ = ("name", "children", "seen", "drawn", "start", "step", "foreign", "over")

    def __init__(self, name: str, seen: bool = True, foreign: bool = False, drawn: bool = True):
        self.name, self.seen, self.foreign, self.drawn, self.children = name, seen, foreign, drawn, []
        self.start, self.step = None, 1  # a list's first number or an item's own, if given
        self.over = (1, 1)  # columns and rows of a cell; 0 rows: all that follow in its row group


def tag_rest(html: str, at: int) -> tuple[int, dict[str, str]]:
    """(place of the > that ends the tag, or the text's length, attributes) from behind the tag's name; of equal names the first counts."""
    out: dict[str, str] = {}
    n = len(html)
    while True:
        at = _between(html, at).end()
        if at >= n or html[at] == ">":
            return at, out
        m = _attribute(html, at)
        at, value = m.end(), ""
        e = _equals(html, at)
        if e:
            at = e.end()
            quote = html[at : at + 1]
            if quote in ('"', "'"):
                end = html.find(quote, at + 1)
                if end < 0:
                    return n, out
                value, at = html[at + 1 : end], end + 1
            else:
                v = _unquoted(html, at)
                value, at = v[0], v.end()
        out.setdefault(m[0].lower(), value)


def style_of(text: str) -> dict[str, str]:
    """Properties of a style attribute, lower-cased: the last declaration of each counts, important ones before others."""
    out: dict[str, str] = {}
    important = set()
    for d in _declarations(text):
        name, colon, value = _comments.sub(" ", d).partition(":")
        name, (value, mark, rank) = name.strip().lower(), value.lower().rpartition("!") if "!" in value else (value.lower(), "", "")
        if mark and rank.strip() != "important":
            continue  # no declaration
        if not colon or (name in important and not mark):
            continue
        if mark:
            important.add(name)
        out[name] = value.strip()
    return out


def element(name: str, a: dict[str, str], inside: bool = False, drawn: bool = True) -> Element:
    """`inside`: svg or math holds it, with no HTML between. `drawn`: the visibility that it inherits."""
    foreign = name in ("svg", "math") or (inside and name not in HOLDS_HTML)
    seen = name not in UNSEEN and not (inside and name in UNDRAWN)
    if not a:
        return Element(name, seen, foreign, drawn)
    seen = seen and "hidden" not in a and a.get("aria-hidden", "").lower() != "true"
    seen = seen and not (name == "input" and a.get("type", "").lower() == "hidden")
    style = {k: a[k].strip().lower() for k in ("display", "visibility") if foreign and k in a}
    if "style" in a:
        style.update(style_of(a["style"]))
    seen = seen and style.get("display") != "none" and style.get("content-visibility") != "hidden"
    drawn = {"hidden": False, "collapse": False, "visible": True, "initial": True}.get(style.get("visibility", ""), drawn)
    e = Element(name, seen, foreign, drawn)
    given = _integer(a.get("start" if name == "ol" else "value", "")) if name in ("ol", "li") else None
    if given:
        e.start = int(given[1])
    if name == "ol" and "reversed" in a:
        e.step = -1
    if name in CELLS:
        e.over = (min(_count(a.get("colspan", "")) or 1, 1000), min(_count(a.get("rowspan", "1"), 1), 65534))
    return e


def _count(text: str, other: int = 0) -> int:
    m = _whole(text)
    return int(m[1][:9]) if m else other


def parse(html: str) -> Element:
    """The tree. Each character is looked at a bounded number of times; text in an unclosed tag is dropped, as browsers do."""
    root = Element("#root")
    stack, at, n = [root], 0, len(html)
    low = None
    while at < n:
        cut = html.find("<", at)
        if cut < 0:
            cut = n
        if cut > at and stack[-1].drawn:
            stack[-1].children.append(unescape(html[at:cut]))
        if cut == n:
            break
        nxt = html[cut + 1 : cut + 2]
        if html.startswith("<!--", cut):
            # <!--> and <!---> are whole comments
            end = _comment_end(html, cut + 2) if html.startswith((">", "->"), cut + 4) else _comment_end(html, cut + 4)
            at = end.end() if end else n
            continue
        if nxt in ("!", "?"):
            end = html.find(">", cut)
            at = n if end < 0 else end + 1
            continue
        closing = nxt == "/"
        m = _name(html, cut + 1 + closing)
        if not m:  # a lone <
            if stack[-1].drawn:
                stack[-1].children.append("<")
            at = cut + 1
            continue
        end, given = tag_rest(html, m.end())
        if end >= n:
            break
        name, at = m[0].lower(), end + 1
        if closing:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == name:
                    del stack[k:]
                    break
                if stack[k].name == "table" or (stack[k].name in CELLS and name not in ("table", "tr", *ROWGROUPS)):
                    break  # an end tag does not reach out of a table or cell
            continue
        if stack[-1].foreign and (name in BREAKS_OUT or (name == "font" and not given.keys().isdisjoint(("color", "face", "size")))):
            while stack[-1].foreign:
                stack.pop()
        names, stop = IMPLIED.get(name, (frozenset(), frozenset()))
        if names:
            close = None
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name in names:
                    close = k
                elif stack[k].name in stop or stack[k].name == "table":
                    break
            if close:
                del stack[close:]
        if name in CLOSES_P:
            for k in range(len(stack) - 1, 0, -1):
                if stack[k].name == "p":
                    del stack[k:]
                    break
                if stack[k].name in BLOCK or stack[k].name in CELLS or stack[k].name == "foreignobject":
                    break
        inside = stack[-1].foreign
        e = element(name, given, inside, stack[-1].drawn)
        stack[-1].children.append(e)
        if name in RAW and not inside:
            if low is None:
                low = html.lower() if len(html.lower()) == n else re.sub("[A-Z]", lambda c: c[0].lower(), html)
            end = low.find(f"</{name}", at)
            end = n if end < 0 else end
            if e.drawn:
                e.children.append(html[at:end] if name not in ("textarea", "title") else unescape(html[at:end]))
            at = end
            stack.append(e)
        elif name not in VOID and not html.endswith("/", cut, at - 1):
            stack.append(e)
    return root


class Page:
    """Lines in the making."""

    def __init__(self):
        self.lines: list[str] = []
        self.now: list[str] = []
        self.blank = False  # an empty line is due before the next text
        self.space = False  # a space is due before the next word
        self.indent: list[str] = []
        self.mark = ""  # of the list item, before its first text

    def end_line(self) -> None:
        if self.now:
            self.lines.append("".join(self.now).rstrip())
            self.now = []
        self.space = False

    def gap(self) -> None:
        self.end_line()
        self.blank = bool(self.lines)

    def put(self, text: str) -> None:
        if not self.now:
            if self.blank:
                self.lines.append("")
                self.blank = False
            self.now.append("".join(self.indent) + self.mark)
            if self.mark:
                self.indent[-1] = " " * len(self.mark)
                self.mark = ""
        self.now.append(text)

    def text(self, text: str) -> None:
        flat = _spaces.sub(" ", text).replace("\xa0", " ")
        body = flat.strip(" ")
        if not body:
            self.space = self.space or bool(flat and self.now)
            return
        if self.now and (self.space or flat[0] == " "):
            self.now.append(" ")
        self.put(body)
        self.space = flat[-1] == " "

    def pre(self, text: str) -> None:
        for k, line in enumerate(text.split("\n")):
            if k:
                if not self.now:
                    self.put("")
                self.end_line()
            if line:
                self.put(line)


def _rows(table: Element) -> list[tuple[int, list[Element]]]:
    """(row group, cells) of every row; what is no cell is a row of its own."""
    rows, todo, groups = [], [(e, 0) for e in reversed(table.children)], 0
    while todo:
        e, group = todo.pop()
        if isinstance(e, str):
            if e.strip():
                rows.append((group, [_wrap(e)]))
        elif not e.seen:
            continue
        elif e.name in ROWGROUPS:
            groups += 1
            todo += [(c, groups) for c in reversed(e.children)]
        elif e.name == "tr":
            rows.append((group, [c if isinstance(c, Element) else _wrap(c) for c in e.children if isinstance(c, Element) and c.seen or isinstance(c, str) and c.strip()]))
        else:
            rows.append((group, [e]))
    return rows


def _wrap(text: str) -> Element:
    e = Element("#cell")
    e.children.append(text)
    return e


def render(root: Element) -> str:
    """Visible text. Cells render into pages of their own; an explicit stack, so depth is no limit."""
    out = Page()
    # entries: (what, value, page, state); a table waits on the stack until its cells are done
    todo: list[tuple] = [("in", root, out, ("", 0))]
    while todo:
        what, e, page, state = todo.pop()
        if what == "text":
            if state[0] == "svg":  # not drawn outside text elements
                continue
            (page.pre if state[0] == "pre" else page.text)(e)
        elif what == "call":
            e(page)
        elif what == "table":
            _write_table(e, page)
        else:
            if not e.seen:
                continue
            name, after = e.name, []
            if name == "br":
                if not page.now and page.lines:
                    page.blank = True
                page.end_line()
                continue
            if name == "table":
                page.gap()
                cells = [(g, [(Page(), c) for c in r]) for g, r in _rows(e)]
                todo += [("call", Page.gap, page, state), ("table", [(g, [(p, *c.over) for p, c in r]) for g, r in cells], page, state)]
                for _, r in reversed(cells):
                    for p, c in reversed(r):
                        todo.append(("inside", c, p, ("", 0)) if c.name in CELLS or c.name in ("#cell", "caption") else ("in", c, p, ("", 0)))
                continue
            if what == "in" and (name in BLOCK or name == "hr"):
                edge = Page.gap if name in SPACED and not (name in LISTS and state[1]) else Page.end_line
                edge(page)
                after.append(edge)
            if name == "svg":
                state = ("svg", state[1])
            elif state[0] == "svg" and name in SVG_TEXT:
                state = ("", state[1])
                Page.end_line(page)
                after.append(Page.end_line)
            elif name == "mtr":
                Page.end_line(page)
                after.append(Page.end_line)
            elif name == "mtd":
                page.space = bool(page.now)
            elif name in LISTS:
                state = (state[0], state[1] + 1)
            elif name in ("pre", "textarea", "xmp"):
                state = ("pre", state[1])
            elif name == "blockquote" or name == "dd":
                page.indent.append("  ")
                after.append(lambda p: p.indent.pop())
            todo += [("call", f, page, state) for f in after]
            number, steps = e.start, []
            if number is None:
                number = 1 if e.step == 1 else sum(not isinstance(c, str) and c.name == "li" and c.seen for c in e.children)
            for c in e.children:
                if isinstance(c, str):
                    steps.append(("text", c, page, state))
                elif name in LISTS and c.name == "li" and c.seen:
                    number = c.start if c.start is not None else number
                    mark = "" if not c.drawn else f"{number}. " if name == "ol" else "- "
                    number += e.step
                    steps += [("call", _item(mark), page, state), ("in", c, page, state), ("call", _item_end, page, state)]
                else:
                    steps.append(("in", c, page, state))
            todo += reversed(steps)
    out.end_line()
    return "\n".join(out.lines)


def _item(mark: str):
    def begin(page: Page) -> None:
        page.end_line()
        if page.mark:  # the item around this one has no text yet: its mark gets a line of its own
            page.put("")
            page.end_line()
        page.mark = mark
        page.indent.append("")

    return begin


def _item_end(page: Page) -> None:
    page.end_line()
    page.mark = ""
    page.indent.pop()


class Cell(NamedTuple):
    lines: list[str]
    first: int  # column
    end: int


def _grid(rows: list[tuple[int, list[tuple[Page, int, int]]]]) -> list[list[Cell]]:
    """The cells of each row at their columns, past those that cells of rows above reach down into."""
    out, reach, last = [], [], 0  # reach: (first column, end, row it ends before), by column, neighbours that end alike as one
    for i, (group, r) in enumerate(rows):
        reach = reach if group == last else []
        last, column, k, cells, new = group, 0, 0, [], []
        for page, columns, down in r:
            while k < len(reach) and reach[k][0] <= column:
                column = max(column, reach[k][1])
                k += 1
            page.end_line()
            cells.append(Cell(page.lines, column, column + columns))
            if down != 1:
                new.append((column, column + columns, min(i + (down or len(rows)), len(rows))))
            column += columns
        out.append(cells)
        reach, held = [], sorted([x for x in reach if x[2] > i + 1] + new) if reach or new else []
        for a, b, n in held:
            if reach and reach[-1][1:] == (a, n):
                reach[-1] = (reach[-1][0], b, n)
            else:
                reach.append((a, b, n))
    return out


def _offsets(grid: list[list[Cell]]) -> dict[int, int]:
    """Where each column begins: two spaces behind the longest line of all cells that end before it."""
    at, place = {}, 0
    cells = sorted((c for r in grid if len(r) > 1 for c in r), key=lambda c: c.end)
    k = 0
    for column in sorted({c.first for r in grid for c in r}):
        while k < len(cells) and cells[k].end <= column:
            place = max(place, at[cells[k].first] + max(map(len, cells[k].lines), default=0) + 2)
            k += 1
        at[column] = place
    return at


def _write_blocks(lines: list[str], page: Page) -> None:
    for line in lines:
        if line:
            page.put(line)
            page.end_line()
        else:
            page.gap()


def _write_table(rows: list[tuple[int, list[tuple[Page, int, int]]]], page: Page) -> None:
    grid = _grid(rows)
    at = _offsets(grid)
    wide = [[c for c in r if c.lines] for r in grid if len(r) > 1]
    prose = any(len(c.lines) > 1 and max(map(len, c.lines)) > PROSE for r in wide if len(r) > 1 for c in r)
    padded = sum(at[r[-1].first] * len(r[-1].lines) for r in wide if r)
    if prose or padded > MOST_PADDED * sum(len(line) - line.count(" ") + 2 for r in wide for c in r for line in c.lines):
        for cells in grid:
            for c in cells:
                page.end_line()
                if len(c.lines) > 1:
                    page.gap()
                _write_blocks(c.lines, page)
                if len(c.lines) > 1:
                    page.gap()
        return
    for cells in grid:
        if len(cells) == 1 and not at[cells[0].first]:
            _write_blocks(cells[0].lines, page)
            continue
        for k in range(max((len(c.lines) for c in cells), default=0)):
            line = ""
            for c in cells:
                if k < len(c.lines) and c.lines[k]:
                    line = line.ljust(at[c.first]) + c.lines[k]
            if line:
                page.put(line)
                page.end_line()


def page_text(html: str | None) -> str | None:
    return None if html is None else render(parse(html))


def extract_text(pages: DataFrame, keep=("page_id",), html: str = "html", into: str = "text") -> DataFrame:
    """`keep` columns and the visible text of every page row.

    Null stays null; an empty page, or one without visible text, gives an empty text. Repeated rows give equal texts, extra
    columns are not read, an empty table gives no rows. No shuffle.
    """
    return map_texts(pages, list(keep), html, lambda: lambda rows: ([page_text(x) for x in rows],), [StructField(into, StringType())])
