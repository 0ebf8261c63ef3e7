"""Text of web pages as a browser would lay it out.

A forgiving tree builder (implied start and end tags, void and raw-text elements, stray end
tags) makes a tree; invisible elements are left out; the rest is rendered top to bottom: runs of
white space collapse, blocks start new lines with blank lines where browsers put margins,
lists get indented markers, ``pre`` keeps its lines, and table cells are aligned in columns of at most ``WIDEST`` characters.
Text is never dropped as boilerplate: everything visible is emitted.

Invisible are head, script, style, template, noscript and media fallbacks; definitions and metadata in svg and
math (their other text is shown); elements that ``display:none`` or ``visibility:hidden`` hides, in their style or in a
simple rule (tag, .class or #id) of the page's style sheets, where the declaration counts that wins by importance,
selector and order; elements with the ``hidden`` attribute that no display overrides; hidden inputs; closed
details but for their summary. Rules count as on a screen ``SCREEN`` pixels wide: those in blocks for print, other
widths, or conditions that are not known hide nothing.

Defined results: null, empty and invisible pages give ''. Markup of any depth is handled without
recursion; a page without tags is one paragraph. Repeated rows are rendered each.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from candlewick.llm.common import mapped, table

# Element kinds of HTML.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
_RAW = set("script style textarea title xmp iframe noembed noframes".split())
_INVISIBLE = set(
    "head title script style template noscript iframe noembed noframes object audio video canvas datalist".split()
)
# Not shown inside svg and math, whose text stands apart; elements that hold HTML again.
_FOREIGN = {"svg", "math"}
_UNSHOWN = set("defs desc metadata symbol clippath mask pattern marker filter annotation annotation-xml".split())
_HTML_AGAIN = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
_MARGIN = set("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure fieldset hr menu".split())
_BLOCK = _MARGIN | set(
    "html body div section article aside header footer nav main address form li dt dd tr thead tbody tfoot caption "
    "figcaption details summary legend center dir hgroup search option optgroup select".split()
)
_CLOSES_P = _BLOCK - set("html body tr thead tbody tfoot caption option optgroup select".split())
_ROW_GROUPS = {"thead", "tbody", "tfoot"}
# Start tag -> open elements it ends, and the elements that shield them.
_ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table"}),
    "th": ({"td", "th"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "caption"} | _ROW_GROUPS, {"table"}),
    "tbody": ({"td", "th", "tr", "caption"} | _ROW_GROUPS, {"table"}),
    "tfoot": ({"td", "th", "tr", "caption"} | _ROW_GROUPS, {"table"}),
    "body": ({"head"}, set()),
}
_IN_HEAD = set("head title meta link base style script noscript template".split())

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>")
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_SELF_CLOSED = re.compile(r"(?:^|[\s\"'])/$")
_DECLARED = re.compile(r"\s*(display|visibility)\s*:\s*([\w-]+)\s*(!\s*important)?\s*", re.I)
_COMMENT = re.compile(r"/\*.*?(?:\*/|$)", re.S)
_CSS = re.compile(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^'\\]|\\.)*'|[{};]", re.S)
_SIMPLE = re.compile(r"[.#]?[\w-]+")
_WIDTH = re.compile(r"\(\s*(min|max)-width\s*:\s*(\d+(?:\.\d+)?|\.\d+)(px|r?em)\s*\)")
SCREEN = 1280
#: Longer lines of a cell stand as they are and do not widen the column for the other rows.
WIDEST = 120
_SPACE = re.compile(r"[ \t\n\r\f]+")


@dataclass
class Node:
    tag: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    foreign: bool = False  # inside svg or math


class _Stack(list[Node]):
    """The open elements, with the places of each tag among them; place 0 is the root's."""

    def __init__(self, root: Node):
        super().__init__([root])
        self.places: dict[str, list[int]] = {}

    def append(self, node: Node) -> None:
        self.places.setdefault(node.tag, []).append(len(self))
        super().append(node)

    def pop(self) -> Node:
        node = super().pop()
        self.places[node.tag].pop()
        return node

    def cut(self, at: int) -> None:
        while len(self) > at:
            self.pop()

    def last(self, tags: set[str]) -> int:
        """Place of the innermost open element of ``tags``, 0 if there is none."""
        return max((self.places[t][-1] for t in tags if self.places.get(t)), default=0)


def parse(html: str) -> Node:
    """The tree of a page."""
    root = Node("#root")
    stack, at, size = _Stack(root), 0, len(html)
    lowered: str | None = None

    def text(piece: str) -> None:
        if piece:
            stack[-1].children.append(unescape(piece) if "&" in piece else piece)

    while at < size:
        begin = html.find("<", at)
        if begin < 0:
            text(html[at:])
            break
        if html.startswith("<!--", begin):
            text(html[at:begin])
            end = html.find("-->", begin + 4)
            at = size if end < 0 else end + 3
            continue
        if html.startswith(("<!", "<?"), begin):
            text(html[at:begin])
            end = html.find(">", begin)
            at = size if end < 0 else end + 1
            continue
        found = _TAG.match(html, begin)
        if found is None:  # a lone < is text; a tag cut off at the page's end is not
            text(html[at : begin + 1] if not re.match(r"</?[a-zA-Z]", html[begin : begin + 3]) else html[at:begin])
            at = begin + 1 if not re.match(r"</?[a-zA-Z]", html[begin : begin + 3]) else _after_broken(html, begin)
            continue
        text(html[at:begin])
        at = found.end()
        tag = found[2].lower()
        if found[1]:
            _close(stack, tag)
            continue
        node = Node(tag, _attributes(found[3]) if found[3].strip(" /\t\n") else {})
        _open(stack, node)
        if node.foreign and _SELF_CLOSED.search(found[3]):
            stack.pop()
        elif tag in _RAW:
            lowered = lowered or html.lower()
            end = lowered.find(f"</{tag}", at) if len(lowered) == size else html.find(f"</{tag}", at)
            end = size if end < 0 else end
            node.children.append(html[at:end])
            stack.pop()
            close = html.find(">", end)
            at = size if close < 0 else close + 1
        elif tag in _VOID:
            stack.pop()
    return root


def _after_broken(html: str, begin: int) -> int:
    end = html.find(">", begin)
    return len(html) if end < 0 else end + 1


def _attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(text):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


def _open(stack: _Stack, node: Node) -> None:
    tag = node.tag
    if tag not in _IN_HEAD and len(stack) > 1 and stack[-1].tag == "head":
        stack.pop()  # the body begins without its tag
    if tag in _CLOSES_P:
        _end(stack, {"p"}, {"table", "td", "th", "caption", "button", "object"})
    if tag in _ENDS:
        ends, shields = _ENDS[tag]
        _end(stack, ends, shields)
    if tag in ("td", "th") and stack[-1].tag in _ROW_GROUPS | {"table"}:
        row = Node("tr")
        stack[-1].children.append(row)
        stack.append(row)
    node.foreign = tag in _FOREIGN or (stack[-1].foreign and stack[-1].tag not in _HTML_AGAIN)
    stack[-1].children.append(node)
    stack.append(node)


def _end(stack: _Stack, ends: set[str], shields: set[str]) -> None:
    """Close the outermost open element of ``ends`` that no shield stands before."""
    shield = stack.last(shields)
    open_ = [places[bisect_right(places, shield)] for tag in ends if (places := stack.places.get(tag)) and places[-1] > shield]
    if open_:
        stack.cut(min(open_))


def _close(stack: _Stack, tag: str) -> None:
    if tag == "br":
        stack[-1].children.append(Node("br"))
        return
    shields = {"td", "th", "table"} if tag not in _ROW_GROUPS | {"table", "tr", "td", "th", "body", "html"} else {"table"}
    at = stack.last({tag})
    if at and at >= stack.last(shields) and tag not in ("body", "html"):  # what follows these still belongs to the page
        stack.cut(at)


class _Flow:
    """Lines being laid out: collapses white space and block margins."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.parts: list[str] = []
        self.gap = 0
        self.marker = ""
        self.indent: list[str] = []
        self.space = True  # nothing or white space stands before

    def text(self, piece: str) -> None:
        piece = _SPACE.sub(" ", piece)
        if self.space:
            piece = piece.lstrip(" ")
        if piece:
            self.parts.append(piece)
            self.space = piece.endswith(" ")

    def line(self, always: bool = False) -> None:
        """End the current line; an empty one counts only if asked for."""
        content = "".join(self.parts).rstrip(" ")
        if content or (always and (self.lines or self.parts)) or self.marker.strip():
            if self.gap and self.lines:
                self.lines += [""] * self.gap
            self.gap = 0
            margin = "".join(self.indent)
            if self.marker:  # stands in the innermost indentation
                margin = margin[: len(margin) - len(self.marker)] + self.marker
            self.lines.append((margin + content).rstrip())
            self.marker = ""
        self.parts, self.space = [], True

    def block(self, margin: int = 0) -> None:
        if self.parts:
            self.line()
        self.gap = max(self.gap, margin)

    def preformatted(self, piece: str) -> None:
        first, *rest = piece.split("\n")
        self.parts.append(first)
        for one in rest:
            content = "".join(self.parts).rstrip()
            self.lines += [""] * (self.gap if self.lines else 0)
            self.gap = 0
            self.lines.append("".join(self.indent) + content if content else "")
            self.parts = [one]
        self.space = False

    def result(self) -> list[str]:
        self.block()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


@dataclass
class _Grid:
    """Rows of a table; a cell is (first column, lines)."""

    rows: list[list[tuple[int, list[str]]]] = field(default_factory=list)
    taken: dict[int, int] = field(default_factory=dict)  # column -> rows that a cell above still covers

    def start_row(self) -> None:
        self.rows.append([])
        self.free = {c for c, n in self.taken.items() if n > 0}
        self.taken = {c: n - 1 for c, n in self.taken.items() if n > 1}
        self.column = 0

    def add(self, lines: list[str], across: int, down: int) -> None:
        while self.column in self.free:
            self.column += 1
        self.rows[-1].append((self.column, lines))
        for c in range(self.column, self.column + across):
            if down > 1:
                self.taken[c] = down - 1
        self.column += across

    def lines(self) -> list[str]:
        widths: dict[int, int] = {}
        for row in self.rows:
            for column, cell in row:
                widths[column] = max(widths.get(column, 0), *(min(len(line), WIDEST) for line in cell), 0)
        columns = sorted(widths)
        out = []
        for row in self.rows:
            cells = dict(row)
            for n in range(max((len(c) for c in cells.values()), default=0)):
                pieces = [(cells.get(c, [])[n : n + 1] or [""])[0].ljust(widths[c]) for c in columns if widths[c]]
                out.append("  ".join(pieces).rstrip())
        return out


def _number(value: str | None, most: int) -> int:
    return max(1, min(int(value), most)) if value and value.strip().isdecimal() else 1


def _on_screen(query: str) -> bool:
    """Whether a list of media queries holds on the screen; a condition that is not known does not."""
    for one in query.lower().split(","):
        words = one.split()
        negated = words[:1] == ["not"]
        holds = True
        for part in re.split(r"\band\b", " ".join(words[1:] if words[:1] in (["not"], ["only"]) else words)):
            part = part.strip()
            if width := _WIDTH.fullmatch(part):
                limit = float(width[2]) * (1 if width[3] == "px" else 16)
                holds &= SCREEN >= limit if width[1] == "min" else SCREEN <= limit
            elif part not in ("", "all", "screen"):
                if not re.fullmatch(r"[a-z]+", part):
                    negated = holds = False
                    break
                holds = False
        if holds != negated:
            return True
    return False


def _applies(prelude: str) -> bool:
    """Whether the rules in an at-block count."""
    name, _, condition = prelude.partition(" ") if " " in prelude else prelude.partition("(")
    if name.lower().startswith("@media"):
        return _on_screen(prelude[len("@media") :])
    return name.lower() == "@layer" or (name.lower() == "@supports" and not condition.strip().lower().startswith("not"))


# For display and visibility: (important, weight of the selector, order, whether it hides).
_Declarations = dict[str, tuple[bool, int, int, bool]]


def _declare(found: _Declarations, text: str, weight: int, order: int) -> None:
    """Note a declaration that outweighs the one found before."""
    if one := _DECLARED.fullmatch(text):
        value = one[2].lower()
        new = (one[3] is not None, weight, order, value == "none" if one[1].lower() == "display" else value in ("hidden", "collapse"))
        found[one[1].lower()] = max(found.get(one[1].lower(), new), new)


def _rules(root: Node) -> dict[str, _Declarations]:
    """What the page's style sheets declare for simple selectors."""
    rules: dict[str, _Declarations] = {}
    waiting, sheets = [root], []
    while waiting:
        node = waiting.pop()
        if node.tag == "style" and _on_screen(node.attributes.get("media", "")):
            sheets.append("".join(c for c in node.children if isinstance(c, str)))
        if node.tag not in ("noscript", "template"):
            waiting += [c for c in reversed(node.children) if isinstance(c, Node)]
    order = 0
    for sheet in sheets:
        sheet = _COMMENT.sub(" ", sheet).replace("<!--", " ").replace("-->", " ")
        blocks: list[tuple[bool, list[str]]] = [(True, [])]  # whether it counts, and its simple selectors
        at = 0
        for mark in [*_CSS.finditer(sheet), None]:
            if mark and mark[0] not in ("{", "}", ";"):
                continue
            text = sheet[at : mark.start() if mark else len(sheet)].strip()
            at = mark.end() if mark else len(sheet)
            counts, selectors = blocks[-1]
            if mark and mark[0] == "{":
                if text.startswith("@"):
                    blocks.append((counts and _applies(text), selectors))
                else:  # a rule within a rule is no simple one
                    simple = [] if selectors else [s for s in map(str.strip, text.split(",")) if _SIMPLE.fullmatch(s)]
                    blocks.append((counts and (len(simple) > 0), simple))
                continue
            if counts:
                for selector in selectors:
                    order += 1
                    name = selector if selector[0] in ".#" else selector.lower()
                    _declare(rules.setdefault(name, {}), text, {"#": 3, ".": 2}.get(selector[0], 1), order)
            if mark and mark[0] == "}" and len(blocks) > 1:
                blocks.pop()
    return {s: d for s, d in rules.items() if d}


def _invisible(node: Node, rules: dict[str, _Declarations]) -> bool:
    if node.tag in _INVISIBLE or (node.foreign and node.tag in _UNSHOWN):
        return True
    a = node.attributes
    if node.tag == "input" and a.get("type", "").lower() == "hidden":
        return True
    found: _Declarations = {}
    if "hidden" in a or (node.tag == "dialog" and "open" not in a):
        found["display"] = (False, 0, 0, True)
    if rules:
        names = [node.tag, f"#{a['id']}"] if "id" in a else [node.tag]
        for name in [*names, *(f".{c}" for c in a.get("class", "").split())]:
            for what, declared in rules.get(name, {}).items():
                found[what] = max(found.get(what, declared), declared)
    if "style" in a:
        for n, text in enumerate(_COMMENT.sub(" ", a["style"]).split(";")):
            _declare(found, text, 4, n)
    return any(hides for _, _, _, hides in found.values())


def render(html: str | None) -> str:
    """The visible text of a page."""
    if not html:
        return ""
    root = parse(html)
    rules = _rules(root)
    flows, grids, lists = [_Flow()], [], []
    pre = 0
    # Each entry is a node to enter, a node to leave (marked), or a text.
    waiting: list[tuple[Node | str, bool]] = [(root, False)]
    while waiting:
        node, leaving = waiting.pop()
        flow = flows[-1]
        if isinstance(node, str):
            (flow.preformatted if pre else flow.text)(node)
            continue
        tag = node.tag
        if leaving:
            if tag in ("td", "th") and grids:
                flows.pop()
                grids[-1].add(flow.result(), _number(node.attributes.get("colspan"), 1000), _number(node.attributes.get("rowspan"), 65534))
            elif tag == "table":
                lines = grids.pop().lines()
                flow.block()
                for one in lines:
                    flow.parts = [one]
                    flow.line(always=True)
                flow.block(1)
            else:
                pre -= tag == "pre"
                if tag in ("ul", "ol", "menu"):
                    lists.pop()
                if tag == "li" or tag in ("blockquote", "dd"):
                    flow.block()
                    flow.line()  # an item without text still shows its marker
                    flow.indent.pop()
                if node.foreign and tag == "text":
                    flow.block()
                if tag in _BLOCK:
                    flow.block((tag in _MARGIN) and not (tag in ("ul", "ol", "menu") and lists))
            continue
        if _invisible(node, rules):
            continue
        if tag == "br":
            flow.line(always=True)
            continue
        if tag == "hr":
            flow.block(1)
            continue
        if tag == "img" and node.attributes.get("alt"):
            flow.text(node.attributes["alt"])
            continue
        if tag == "input":
            flow.text(node.attributes.get("value", ""))
            continue
        if tag == "table":
            flow.block(1)
            grids.append(_Grid())
        elif tag == "tr" and grids:
            grids[-1].start_row()
        elif tag in ("td", "th") and grids:
            if not grids[-1].rows:
                grids[-1].start_row()
            flows.append(_Flow())
        elif tag in _BLOCK:
            flow.block((tag in _MARGIN) and not (tag in ("ul", "ol", "menu") and lists))
            if tag in ("ul", "ol", "menu"):
                start = node.attributes.get("start", "")
                lists.append(int(start) if tag == "ol" and re.fullmatch(r"-?\d{1,9}", start) else (1 if tag == "ol" else None))
            elif tag == "li":
                number = lists[-1] if lists else None
                marker = "- " if number is None else f"{number}. "
                if number is not None:
                    lists[-1] = number + 1
                if flow.marker.strip():
                    flow.line()
                flow.marker = marker
                flow.indent.append(" " * len(marker))
            elif tag in ("blockquote", "dd"):
                flow.indent.append("  ")
            pre += tag == "pre"
        elif node.foreign and tag == "text":
            flow.block()
        children = node.children
        if tag == "pre" and children and isinstance(children[0], str):  # a line end right after the tag is not shown
            children = [children[0].removeprefix("\r").removeprefix("\n"), *children[1:]]
        if tag == "details" and "open" not in node.attributes:
            children = [c for c in children if isinstance(c, Node) and c.tag == "summary"]
        waiting.append((node, True))
        waiting += [(c, False) for c in reversed(children)]
    return "\n".join(flows[0].result())


def extracted(pages: DataFrame) -> DataFrame:
    """(page_id, text) for each row of ``pages`` (page_id, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([render(h) for h in batch["html"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["page_id"], texts], ["page_id", "text"])

    return mapped(pages.select(F.col("page_id").cast("long"), "html"), run, "page_id long, text string")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4: the visible text of every page."""
    return extracted(table(spark, sf_dir, "pages")).select(
        "page_id", "text", F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256")
    )
