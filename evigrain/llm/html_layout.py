"""HTML extraction: a tree builder with implied tags, visibility rules, and a layout of all visible text.

* The tokenizer takes any text: comments, declarations, tags with quoted or bare attributes, character
  references, and raw-text elements, whose content is not markup. A stray `<` is text.
* The tree builder closes elements that others imply to end (p before blocks; li, dt, dd, option, rows and cells before
  their like), ignores end tags without a start, and closes what a parent's end leaves open.
* Hidden are: head and what only belongs there, scripts, styles, templates, fallbacks of embedded media, what svg and math
  hold but do not draw (descriptions, definitions, annotations), elements with the
  hidden attribute, inputs, closed dialogs, and inline styles of display:none or visibility:hidden|collapse
  (visibility:visible shows again inside).
* The layout collapses blanks, gives blocks lines of their own and paragraphs, headings, lists and tables a blank line
  around, marks list items with bullets or numbers and indents nested ones, keeps preformatted text,
  and aligns table cells in columns, spans included; a column pads to WIDEST characters at most, longer cells run over it whole.

Nulls and edges: null html gives null text; empty html, or html without visible text, gives ''. Elements nest to any
depth; only the blanks that indent lists and quotes end at DEEPEST. Rows are independent: repeated pages, null ids and ties
need no rule; other columns are ignored.
"""

from __future__ import annotations

import html as _html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from . import base

DEEPEST, WIDEST, GAP = 240, 60, "  "
# fixed values of the HTML standard: element names by their role
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes".split())
RAW_WITH_REFERENCES = frozenset("textarea title".split())
HIDDEN = frozenset("head title script style template noscript iframe noembed noframes object audio video canvas datalist base link meta param source track area map input".split())
FOREIGN = frozenset(["svg", "math"])
UNDRAWN = frozenset("desc metadata defs symbol annotation annotation-xml".split())
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li listing main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul xmp".split())
SPACED = frozenset("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr listing menu ol p pre table ul xmp dir".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr listing main menu nav ol p pre search section summary table ul xmp li dd dt".split())
#: Start tag -> (elements that it ends, elements at which looking for them stops).
_SCOPE = frozenset("table td th caption html body button".split())
ENDS = {
    "li": (frozenset(["li"]), frozenset("ul ol menu dir".split()) | _SCOPE),
    "dt": (frozenset(["dt", "dd"]), frozenset(["dl"]) | _SCOPE),
    "dd": (frozenset(["dt", "dd"]), frozenset(["dl"]) | _SCOPE),
    "option": (frozenset(["option"]), frozenset(["select", "datalist"])),
    "optgroup": (frozenset(["option", "optgroup"]), frozenset(["select"])),
    "tr": (frozenset(["tr", "td", "th", "caption"]), frozenset(["table"])),
    "td": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
    "th": (frozenset(["td", "th", "caption"]), frozenset(["table", "tr"])),
    "tbody": (frozenset("tr td th thead tbody tfoot caption".split()), frozenset(["table"])),
    "thead": (frozenset("tr td th thead tbody tfoot caption".split()), frozenset(["table"])),
    "tfoot": (frozenset("tr td th thead tbody tfoot caption".split()), frozenset(["table"])),
    "caption": (frozenset("tr td th thead tbody tfoot caption".split()), frozenset(["table"])),
    "body": (frozenset(["head"]), frozenset(["html"])),
}
HEAD_ONLY = frozenset("title meta link base style script template noscript".split())
_MARKUP = re.compile(r"<!--(?:>|->)|<!--.*?(?:--!?>|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>\x00]*)((?:[^>\"'=]|=\s*(?:\"[^\"]*(?:\"|\Z)|'[^']*(?:'|\Z)|[^\s>\"']?)|[\"'])*)(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>", re.S)
_ATTRIBUTE = re.compile(r"([^\s/=\"'>][^\s/=>]*)(?:\s*=\s*(?:\"([^\"]*)\"?|'([^']*)'?|([^\s>]+)))?", re.S)
_BLANK = re.compile(r"[ \t\n\r\f]+")


class Node:
    __slots__ = ("tag", "attrs", "inside")

    def __init__(self, tag: str, attrs: dict | None = None):
        self.tag, self.attrs, self.inside = tag, attrs or {}, []


def build(source: str) -> Node:
    """The tree of a page. Text is str, elements are Node."""
    root = Node("html")
    stack = [root]
    opened = Counter(["html"])
    at = 0

    def push(node: Node) -> None:
        stack.append(node)
        opened[node.tag] += 1

    def cut(i: int) -> None:
        opened.subtract(n.tag for n in stack[i:])
        del stack[i:]

    def text(s: str) -> None:
        if s:
            if stack[-1].tag == "head" and s.strip():
                cut(-1)
            stack[-1].inside.append(s)

    def close(names: frozenset, stop: frozenset) -> None:
        if not any(opened[n] for n in names):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in names:
                cut(i)
            elif stack[i].tag in stop:
                return

    for m in _MARKUP.finditer(source):
        if m.start() < at:
            continue
        text(_html.unescape(source[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            if tag in ("p", "br") and not opened[tag]:
                stack[-1].inside.append(Node(tag))  # the standard makes an empty element of these stray ends
                continue
            for i in range(len(stack) - 1, 0, -1) if opened[tag] else ():
                if stack[i].tag == tag:
                    cut(i)
                    break
                if stack[i].tag in ("td", "th", "caption") and tag not in ("table", "tr", "tbody", "thead", "tfoot", "td", "th", "caption", "body", "html"):
                    break
            continue
        if tag in ("html",) or tag == "body" and opened["body"]:
            continue
        if stack[-1].tag == "head" and tag not in HEAD_ONLY:
            cut(-1)
        if tag in CLOSES_P:
            close(frozenset(["p"]), _SCOPE | {"li"} if tag != "li" else _SCOPE)
        if tag in ENDS:
            close(*ENDS[tag])
        attrs = {}
        for a in _ATTRIBUTE.finditer(m[3]):
            attrs.setdefault(a[1].lower(), _html.unescape(next((v for v in a.groups()[1:] if v is not None), "")))
        node = Node(tag, attrs)
        stack[-1].inside.append(node)
        if tag in VOID or m[3].endswith("/") and (tag in FOREIGN or any(opened[n] for n in FOREIGN)):
            continue
        if tag in RAW or tag in RAW_WITH_REFERENCES:
            end = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(source, at)
            raw = source[at : end.start() if end else len(source)]
            node.inside.append(_html.unescape(raw) if tag in RAW_WITH_REFERENCES else raw)
            at = end.end() if end else len(source)
            continue
        push(node)
    text(_html.unescape(source[at:]))
    return root


def style_of(node: Node) -> dict[str, str]:
    out = {}
    for part in node.attrs.get("style", "").lower().split(";"):
        name, _, value = part.partition(":")
        out[name.strip()] = value.replace("!important", "").strip()
    return out


class Layout:
    """Lines of text as blocks and inline runs come."""

    def __init__(self):
        self.lines: list[str] = []
        self.run: list[str] = []
        self.gap = False
        self.indent = ""
        self.marker = ""
        self.kept = False

    def inline(self, s: str) -> None:
        s = _BLANK.sub(" ", s)
        if s[:1] == " " and (not self.run or self.run[-1][-1:] == " "):
            s = s[1:]
        if s:
            self.run.append(s)

    def end_line(self, keep: bool = False) -> None:
        line = "".join(self.run)
        line = line.rstrip() if keep or self.kept else line.strip(" ")
        self.run, self.kept = [], False
        if line or keep:
            self.put(line)

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        head = self.marker or self.indent
        self.marker = ""
        self.lines.append((head + line).rstrip())

    def block(self, spaced: bool) -> None:
        self.end_line()
        self.gap |= spaced

    def text(self) -> str:
        self.end_line()
        lines = self.lines
        while lines and not lines[-1]:
            lines.pop()
        while lines and not lines[0]:
            lines.pop(0)
        return "\n".join(lines)


def lay(node: Node, out: Layout) -> None:
    """Lay out a tree of any depth: each step of _lay or table yields the steps inside it, which are run first."""
    steps = [_lay(node, out)]
    while steps:
        inner = next(steps[-1], None)
        if inner is None:
            steps.pop()
        else:
            steps.append(inner)


def _lay(node: Node, out: Layout, shown: bool = True, pre: bool = False, depth: int = 0, foreign: bool = False) -> Iterator:
    tag = node.tag
    if foreign and tag in UNDRAWN:
        return
    foreign |= tag in FOREIGN
    style = style_of(node) if "style" in node.attrs else {}
    if tag in HIDDEN or "hidden" in node.attrs or style.get("display") == "none" or (tag == "dialog" and "open" not in node.attrs):
        return
    if style.get("visibility") in ("hidden", "collapse"):
        shown = False
    elif style.get("visibility") == "visible":
        shown = True
    if tag == "br":
        if shown:
            out.end_line(keep=not out.run and bool(out.lines) and not out.gap)
        return
    if tag == "img":
        if shown and node.attrs.get("alt"):
            out.inline(node.attrs["alt"])
        return
    is_block = tag in BLOCKS or style.get("display") in ("block", "flex", "grid", "list-item", "table")
    is_block = is_block and style.get("display") not in ("inline", "inline-block", "inline-flex")
    spaced = is_block and tag in SPACED and not (tag in ("ul", "ol", "menu", "dir") and depth)
    if is_block:
        out.block(spaced)
    if tag == "table":
        yield from table(node, out, shown, depth)
        out.block(True)
        return
    if tag == "hr":
        out.gap = True
        return
    white = style.get("white-space", "")
    pre = tag in ("pre", "listing", "xmp", "textarea") or white in ("pre", "pre-wrap", "break-spaces") or (pre and white != "normal")
    indent, marker = out.indent, out.marker
    number = _number(node.attrs.get("start"), 1) if tag == "ol" else None
    if tag in ("blockquote", "dd"):
        out.indent, out.marker = (indent + "  ")[:DEEPEST], ""
    for k, x in enumerate(node.inside):
        if isinstance(x, str):
            if not shown:
                continue
            if pre:
                _keep(x[1:] if k == 0 and tag in ("pre", "listing", "textarea") and x[:1] == "\n" else x, out)
            else:
                out.inline(x)
        elif x.tag == "li":
            if "hidden" in x.attrs or style_of(x).get("display") == "none":
                continue
            out.block(False)
            if number is not None:
                number = _number(x.attrs.get("value"), number)
            bullet = f"{number}. " if number is not None else "- "
            inner = out.indent
            out.marker, out.indent = inner + bullet, (inner + " " * len(bullet))[:DEEPEST]
            before = len(out.lines)
            yield _lay(x, out, shown, pre, depth + 1)
            out.end_line()
            if len(out.lines) == before:
                out.marker = ""
            out.indent = inner
            number = None if number is None else number + 1
        else:
            yield _lay(x, out, shown, pre, depth + (tag in ("ul", "ol", "menu", "dir")), foreign)
    if is_block:
        out.block(spaced)
    out.indent = indent
    if tag in ("blockquote", "dd") and marker and not out.marker:
        out.marker = ""


def _number(text: str | None, other: int) -> int:
    return int(text) if text and re.fullmatch(r"\s*-?\d{1,9}\s*", text) else other


def _keep(s: str, out: Layout) -> None:
    parts = s.replace("\r\n", "\n").split("\n")
    for i, p in enumerate(parts):
        if i:
            out.end_line(keep=True)
        if p:
            out.run.append(p)
            out.kept = True


def _rows(node: Node):
    for x in node.inside:
        if isinstance(x, Node):
            style = style_of(x) if "style" in x.attrs else {}
            if "hidden" in x.attrs or style.get("display") == "none":
                continue
            if x.tag == "tr":
                yield x
            elif x.tag in ("thead", "tbody", "tfoot"):
                yield from _rows(x)
            elif x.tag not in ("caption", "colgroup", "col") and x.tag not in HIDDEN:
                yield x
        elif x.strip():
            yield x


def table(node: Node, out: Layout, shown: bool, depth: int) -> Iterator:
    for x in node.inside:
        if isinstance(x, Node) and x.tag == "caption":
            yield _lay(x, out, shown, False, depth)
    grid, held, loose, spanning = [], {}, [], set()
    for row in _rows(node):
        if isinstance(row, str) or row.tag != "tr":  # text or elements that stand between rows come before the table
            loose.append(row)
            continue
        visible = shown and style_of(row).get("visibility") not in ("hidden", "collapse")
        cells: dict[int, list[str]] = {}
        col = 0
        parts = [c for c in row.inside if isinstance(c, Node) or c.strip()]
        for c in parts:
            while held.get(col, 0) > 0:
                col += 1
            inner = Layout()
            if isinstance(c, str):
                if visible:
                    inner.inline(c)
            else:
                yield _lay(c, inner, visible, False, 0)
                if c.tag in ("td", "th") and ("hidden" in c.attrs or style_of(c).get("display") == "none"):
                    continue
            cells[col] = inner.text().split("\n")
            wide, tall = (min(1000, max(1, _number(c.attrs.get(a), 1))) if isinstance(c, Node) else 1 for a in ("colspan", "rowspan"))
            if wide > 1:
                spanning.add((len(grid), col))
            for k in range(col, col + wide):
                held[k] = tall
            col += wide
        grid.append(cells)
        held = {k: n - 1 for k, n in held.items() if n > 1}
    for x in loose:
        if isinstance(x, str):
            if shown:
                out.inline(x)
        else:
            yield _lay(x, out, shown, False, depth)
    out.end_line()
    width: dict[int, int] = {}
    for r, cells in enumerate(grid):
        for k, lines in cells.items():
            width[k] = max(width.get(k, 0), 0, *(len(x) for x in lines if len(x) <= WIDEST and (r, k) not in spanning), 0)
    cols = sorted(k for k in width if width[k] or any(any(c.get(k, [])) for c in grid))
    for cells in grid:
        for i in range(max((len(v) for v in cells.values()), default=0)):
            line = GAP.join((cells[k][i] if k in cells and i < len(cells[k]) else "").ljust(width[k]) for k in cols).rstrip()
            if line:
                out.put(line)


def render(source: str | None) -> str | None:
    """All visible text of a page, laid out."""
    if source is None:
        return None
    out = Layout()
    lay(build(source), out)
    return out.text()


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, text, n_chars) of every row of pages (page_id, html)."""
    base.tune(pages.sparkSession)
    pages = base.pick(pages, ["page_id", "html"])

    def measure(html: pa.Array) -> list[pa.Array]:
        texts = [render(h) for h in html.to_pylist()]
        return [pa.array(texts, pa.string()), pa.array([None if t is None else len(t) for t in texts], pa.int64())]

    return base.beside(pages, ["html"], measure, "text string, n_chars long").select("page_id", "text", "n_chars")
