"""Visible text of HTML pages, laid out as a reader would see it.

A small tree builder (implied end tags, implied table rows, raw-text elements)
and a walk over the tree that knows what is visible and how it is spaced:
blocks on lines of their own, blank lines around paragraphs and headings, list
markers with indents, and table cells padded to columns.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from palimpsest.llm.common import slices

# Fixed values of the HTML standard: element classes and implied ends.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style noembed noframes xmp iframe".split())
RCDATA = {"textarea", "title"}
HEAD = set("title meta link style script base noscript template".split())
UNSEEN = set(
    "script style noscript template head title meta link base datalist iframe noembed noframes "
    "object embed audio video canvas area param source track rp".split())
FOREIGN = {"svg", "math"}
FOREIGN_UNSEEN = set(
    "annotation annotation-xml desc defs symbol clippath mask pattern marker metadata mphantom".split())
# Elements in which svg and math hold HTML again, and HTML elements that end svg and math elsewhere.
INTEGRATION = set("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
BREAKOUT = set(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing "
    "menu meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
APART = {"text", "mtd", "mtr", "math"}  # set off by blanks
VALUELESS = set("hidden password checkbox radio file color range image".split())  # types of input
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu "
    "nav ol option p pre search section summary table ul caption tr thead tbody tfoot".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 blockquote pre ul ol dl menu table figure hr fieldset".split())
CLOSES_P = (BLOCK | {"table"}) - set("body html li dd dt tr thead tbody tfoot caption option legend summary".split())
# start tag -> (elements that it ends, elements it does not look beyond)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "caption"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()), "caption": ({"caption"}, {"table"}),
} | {t: ({"tr", "caption", "thead", "tbody", "tfoot"}, {"table"}) for t in ("thead", "tbody", "tfoot")}
WALLS = {"td", "th", "table", "caption", "button", "object", "template"}

# Quotes delimit a value only directly after '=' and blanks; elsewhere they are ordinary characters.
WS = r" \t\n\f\r"
NAME = rf"[^{WS}/>][^{WS}/>=]*+"
VALUE = rf"\"[^\"]*\"|'[^']*'|[^{WS}\"'>][^{WS}>]*+|(?=>)"
ATTRIBUTES = rf"(?:[{WS}/]++|{NAME}(?:[{WS}]*+=[{WS}]*+(?:{VALUE})|(?![{WS}]*+=)))*+"
TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^{WS}/>]*+)({ATTRIBUTES})>"
    r"|</?[a-zA-Z][^>]*\Z|[^<]+|<", re.S)
ATTRIBUTE = re.compile(
    rf"({NAME})(?:[{WS}]*=[{WS}]*(?:\"([^\"]*)\"|'([^']*)'|([^{WS}\"'>][^{WS}>]*)|))?")
HIDING = re.compile(r"display\s*:\s*none", re.I)
VISIBILITY = re.compile(r"visibility\s*:\s*(hidden|collapse|visible|initial)", re.I)
BLANK = re.compile(r"[ \t\n\f\r]+")
WRAP, LONGEST_WORD = 60, 1000  # cells: lines are broken at blanks, longer words anywhere
# Fixed values of the HTML standard.
MOST_COLUMNS, MOST_ROWS = 1000, 65534
CELLS = ("td", "th", "table")
PAST_CELLS = {"tr", "tbody", "thead", "tfoot", "table", "body", "html"}  # end tags that close cells


class Node:
    __slots__ = ("tag", "attrs", "kids", "visible", "drawing")

    def __init__(self, tag: str, attrs: str = ""):
        self.tag, self.attrs, self.kids = tag, attrs, []
        self.visible, self.drawing = True, ""

    def attributes(self) -> dict[str, str]:
        return {n.lower(): unescape(a or b or c or "") for n, a, b, c in ATTRIBUTE.findall(self.attrs)}


def in_value(attrs: str) -> bool:
    """Whether the last character belongs to an attribute, and not to the end of the tag."""
    return any(m.end() == len(attrs) for m in ATTRIBUTE.finditer(attrs))


def build_tree(html: str) -> Node:
    root = Node("#root")
    stack, within = [root], defaultdict(list)  # places in the stack of the open elements, by tag

    def pop_to(at: int) -> None:
        for node in stack[at:]:
            within[node.tag].pop()
        del stack[at:]

    def last(tags) -> int:
        return max((within[t][-1] for t in tags if within[t]), default=0)

    def end_implied(names: set[str], scope: set[str]) -> None:
        """End the outermost of ``names`` inside the innermost of ``scope``, and all in it."""
        open_ = [within[n] for n in names if within[n]]
        if open_:
            wall = last(scope)
            inside = [places[i] for places in open_ if (i := bisect_right(places, wall)) < len(places)]
            if inside:
                pop_to(min(inside))

    def foreign() -> bool:
        return any(within[t] for t in FOREIGN) and not any(within[t] for t in INTEGRATION)

    def start(tag: str, attrs: str) -> None:
        outside = foreign()
        if outside and tag in BREAKOUT:
            pop_to(next(at for at, node in enumerate(stack) if node.tag in FOREIGN))
            outside = False
        if tag in CLOSES_P and within["p"]:
            end_implied({"p"}, WALLS)
        if tag in IMPLIED:
            end_implied(*IMPLIED[tag])
            if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
                start("tr", "")
        elif within["head"] and tag not in HEAD and tag != "head" and stack[-1].tag == "head":
            pop_to(len(stack) - 1)
        node = Node(tag, attrs)
        stack[-1].kids.append(node)
        if tag not in VOID and not (
                (outside or tag in FOREIGN) and attrs.endswith("/") and not in_value(attrs)):
            within[tag].append(len(stack))
            stack.append(node)

    def end(tag: str) -> None:
        if not within[tag]:
            if tag == "p":  # an end tag alone makes an empty paragraph
                start("p", "")
                pop_to(len(stack) - 1)
            return
        if tag in PAST_CELLS or within[tag][-1] >= last(CELLS):
            pop_to(within[tag][-1])

    at = 0
    while at < len(html):
        m = TOKEN.match(html, at)
        at, tag = m.end(), m[2]
        if tag is None:
            text = m[0]
            if text[0] != "<" or len(text) == 1:
                if stack[-1].tag == "head" and text.strip():
                    pop_to(len(stack) - 1)
                stack[-1].kids.append(unescape(text) if "&" in text else text)
            continue
        tag = tag.lower()
        if m[1]:
            end(tag)
            continue
        start(tag, m[3])
        if (tag in RAW or tag in RCDATA) and stack[-1].tag == tag:
            close = re.compile(rf"</{tag}(?=[{WS}/>])", re.I).search(html, at)
            upto = close.start() if close else len(html)
            body = html[at:upto]
            if body:
                stack[-1].kids.append(unescape(body) if tag in RCDATA else body)
            at = TOKEN.match(html, upto).end() if close else len(html)
            pop_to(len(stack) - 1)
    return root


def inherit(node: Node, parent: Node | None) -> None:
    """What a node takes from its parent: visibility, and where it is in a drawing."""
    if parent is not None:
        node.visible, node.drawing = parent.visible, parent.drawing
    if node.tag in FOREIGN:
        node.drawing = node.tag
    elif node.drawing == "svg" and node.tag == "text":
        node.drawing = "label"
    elif node.drawing and node.tag == "foreignobject":
        node.drawing = ""
    if "visibility" in node.attrs.lower():
        attrs = node.attributes()
        said = VISIBILITY.findall(attrs.get("style", "")) or (
            [attrs["visibility"].strip()] if node.drawing and "visibility" in attrs else [])
        if said:
            node.visible = said[-1].lower() not in ("hidden", "collapse")


def is_seen(node: Node, parent: Node | None) -> bool:
    """Whether a node and all in it may be displayed; visibility comes on top."""
    if node.tag in UNSEEN or (node.drawing and node.tag in FOREIGN_UNSEEN):
        return False
    if node.drawing and node.attributes().get("display", "").strip().lower() == "none":
        return False
    if node.attrs.strip():
        low = node.attrs.lower()
        if "hidden" in low or "style" in low:
            attrs = node.attributes()
            if "hidden" in attrs or HIDING.search(attrs.get("style", "")):
                return False
        if node.tag == "input" and node.attributes().get("type", "").lower() == "hidden":
            return False
    if node.tag == "dialog" and "open" not in node.attributes():
        return False
    if parent is not None and parent.tag == "details" and node.tag != "summary":
        return "open" in parent.attributes()
    return True


class Flow:
    """Text as it runs: blanks collapse, breaks merge, lines get the current indent."""

    def __init__(self):
        self.parts, self.gap, self.space, self.indent, self.marker = [], 0, False, "", ""
        self.wide = WRAP  # of the widest table inside

    def lead(self) -> None:
        if self.gap and self.parts:
            self.parts.append("\n" * self.gap)
        if self.gap or not self.parts:
            first = self.indent[:max(len(self.indent) - len(self.marker), 0)] + self.marker
            self.parts.append(first if self.marker else self.indent)
            self.marker = ""
        elif self.space:
            self.parts.append(" ")
        self.gap, self.space = 0, False

    def text(self, value: str) -> None:
        body = BLANK.sub(" ", value)
        if body == " " or not body:
            self.space |= bool(body)
            return
        self.space |= body[0] == " "
        self.lead()
        self.parts.append(body.strip(" "))
        self.space = body[-1] == " "

    def kept(self, value: str) -> None:
        """Preformatted lines."""
        for i, line in enumerate(value.replace("\r\n", "\n").split("\n")):
            if i:
                self.gap += 1
                self.space = False
            if line:
                self.lead()
                self.parts.append(line)

    def lines(self, n: int) -> None:
        self.gap, self.space = max(self.gap, n), False

    def result(self) -> str:
        return "".join(self.parts)


@dataclass
class Cell:
    text: str
    across: int = 1
    down: int = 1  # 0: to the end of the table
    wide: int = WRAP

    @classmethod
    def of(cls, node: Node, flow: Flow) -> Cell:
        attrs = node.attributes()

        def span(name: str, least: int, most: int) -> int:
            said = attrs.get(name, "").strip()
            return min(max(int(said[:9]), least), most) if said.isascii() and said.isdecimal() else 1

        return cls(flow.result(), span("colspan", 1, MOST_COLUMNS), span("rowspan", 0, MOST_ROWS), flow.wide)

    def lines(self) -> list[str]:
        """The text's lines, broken where they are wider than a column or a table inside."""
        out = []
        for line in self.text.split("\n"):
            while len(line) > self.wide:
                cut = line.rfind(" ", 1, self.wide + 1)
                if cut < 0 or not line[:cut].strip():  # a long word stands alone, up to a limit
                    indent = len(line) - len(line.lstrip(" "))
                    cut = line.find(" ", max(indent, 1))
                    cut = min(cut if cut > 0 else len(line), max(LONGEST_WORD, self.wide))
                if cut >= len(line):
                    break
                out.append(line[:cut].rstrip())
                line = line[cut:].lstrip(" ")
            out.append(line)
        return out


def table_text(rows: list[list[Cell]]) -> str:
    """The table with aligned columns.

    Cells take the places of a grid as browsers give them: the next one that no cell from an
    earlier row reaches. A column is a place where some cell begins; it is as wide as its
    widest line, and a cell over several columns widens the last of them if it must.
    """
    placed, taken = [], {}
    for y, row in enumerate(rows):
        x, line = 0, []
        for cell in row:
            while taken.get(x, 0) > y:
                x += 1
            line.append((x, cell))
            if cell.down != 1:
                taken.update(dict.fromkeys(range(x, x + cell.across), y + (cell.down or len(rows))))
            x += cell.across
        placed.append(line)
    starts = sorted({x for line in placed for x, _ in line})
    if len(starts) < 2:
        return "\n".join(cell.text for line in placed for _, cell in line if cell.text)
    grid = [[(bisect_left(starts, x), bisect_left(starts, x + cell.across), cell.lines()) for x, cell in line]
            for line in placed]
    wide = [0] * len(starts)
    for first, upto, lines in sorted((c for line in grid for c in line), key=lambda c: c[1] - c[0]):
        have = sum(wide[first:upto]) + 3 * (upto - first - 1)
        wide[upto - 1] += max(max(map(len, lines)) - have, 0)
    out = []
    for line in grid:
        if not any(any(lines) for _, _, lines in line):
            continue
        for k in range(max(len(lines) for _, _, lines in line)):
            parts, at, shown = [], 0, 0
            for first, upto, lines in line:
                parts += [" " * w for w in wide[at:first]]
                at, text = upto, lines[k] if k < len(lines) else ""
                parts.append(text.ljust(sum(wide[first:upto]) + 3 * (upto - first - 1)))
                if text or not k:
                    shown = len(parts)
            out.append(" | ".join(parts[:shown]).rstrip())
    return "\n".join(out)


def render(html: str | None) -> str:
    """The visible text of a page; a null or empty page gives an empty text."""
    if not html:
        return ""
    flow, kept, lists, tables = Flow(), 0, [], []
    todo: list[tuple] = [("in", build_tree(html), None)]
    while todo:
        step, node, parent = todo.pop()
        if step == "out":
            leave = node.tag
            if node.drawing and leave in APART:
                flow.space = True
            if leave in BLOCK:
                flow.lines(2 if leave in SPACED and not lists else 1)
            if leave == "pre":
                kept -= 1
            elif leave in ("ul", "ol", "menu"):
                flow.indent = lists.pop()[0]
                flow.lines(1 if lists else 2)
            elif leave == "li":
                flow.marker = ""
                flow.indent = parent
            elif leave in ("td", "th") and tables:
                tables[-1][1][-1].append(Cell.of(node, flow))
                flow, lists, kept = tables[-1][2].pop()
            elif leave == "table":
                _, rows, _ = tables.pop()
                shape = table_text(rows)
                if shape:
                    flow.lines(2)
                    flow.kept(shape)
                    flow.wide = max(flow.wide, *map(len, shape.split("\n")))
                flow.lines(2)
            continue
        if isinstance(node, str):
            if parent is not None and (not parent.visible or parent.drawing == "svg"):
                continue
            if parent is not None and parent.tag == "details" and "open" not in parent.attributes():
                continue
            if parent is not None and parent.tag in ("table", "tr", "thead", "tbody", "tfoot") and not node.strip():
                continue
            flow.kept(node) if kept else flow.text(node)
            continue
        tag = node.tag
        inherit(node, parent)
        if not is_seen(node, parent):
            continue
        if node.drawing and (tag in APART or parent.tag == "mfrac"):
            flow.space = True
        if tag == "br":
            flow.gap, flow.space = flow.gap + 1 if flow.parts else 0, False
            continue
        if tag == "img" or tag == "input":
            attrs = node.attributes()
            kind = "image" if tag == "img" else attrs.get("type", "text").strip().lower()
            shown = attrs.get("alt" if kind == "image" else "value")
            if shown and node.visible and (kind == "image" or kind not in VALUELESS):
                flow.text(shown)
            continue
        if tag in BLOCK:
            flow.lines(2 if tag in SPACED and not lists else 1)
        back = parent
        if tag == "pre":
            kept += 1
        elif tag in ("ul", "ol", "menu"):
            begin = node.attributes().get("start", "1") if tag == "ol" else "1"
            lists.append([flow.indent, tag, int(begin) if begin.isdecimal() else 1])
        elif tag == "li":
            back, kind = flow.indent, lists[-1] if lists else ["", "ul", 1]
            mark = (f"{kind[2]}. " if kind[1] == "ol" else "- ") if node.visible else ""
            kind[2] += 1
            flow.marker, flow.indent = mark, flow.indent + " " * len(mark)
        elif tag == "table":
            tables.append((tag, [], []))
        elif tag == "tr" and tables:
            tables[-1][1].append([])
        elif tag in ("td", "th"):
            if tables:
                if not tables[-1][1]:
                    tables[-1][1].append([])
                tables[-1][2].append((flow, lists, kept))
                flow, lists, kept = Flow(), [], 0
        todo.append(("out", node, back))
        todo.extend(("in", kid, node) for kid in reversed(node.kids))
    return flow.result().strip("\n")


OUT = "text string, n_lines long, n_words long"


def extract_text(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every row of ``pages`` with the page's visible ``text``, its lines and words.

    Visibility is inherited and may be turned on again, display: none is final.
    Formulas in MathML run as text without their annotations; of svg the text
    elements are shown, not its titles, descriptions and definitions. Inputs show
    their values, except passwords, files, colours, ranges and boxes.
    The html column is replaced; other columns pass through, and columns named
    ``text``, ``n_lines`` or ``n_words`` are replaced. A null or empty page
    gives an empty text of 0 lines. Broken markup never fails: what no rule
    closes ends with the page. An empty table gives no rows.

    Cells of a table stand in aligned columns, whatever they hold: lines of more than 60
    characters are broken at blanks, and words of more than 1,000 anywhere. A cell over several
    rows leaves its columns empty in the later ones.
    """
    names = {"text", "n_lines", "n_words", html.lower()}
    kept = [c for c in pages.columns if c.lower() not in names]
    given = pages.select(*kept, html)
    types = dict(pages.dtypes)
    schema = "".join(f"`{c}` {types[c]}, " for c in kept) + OUT

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, html):
            texts = [render(h) for h in piece.column(html).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [piece.column(c) for c in kept] + [
                    pa.array(texts, pa.string()),
                    pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64()),
                    pa.array([len(t.split()) for t in texts], pa.int64())],
                names=[*kept, "text", "n_lines", "n_words"])

    return given.mapInArrow(run, schema)
