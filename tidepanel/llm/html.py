"""Layout-aware rendering of HTML: a tree builder with implied tags, visibility rules, and text laid out in lines.

The builder closes elements whose end tags may be left out (paragraphs, list items, table parts, options) and ignores
stray end tags. Hidden are: head, script, style, template, noscript, frames' fallback, definitions and descriptions of drawings, comments, elements
with the attribute hidden or display:none in their style or by rules of the page's own style sheets (selectors of tag, class and id), hidden inputs, closed dialogs, and all of a closed details element but its
summary; also what has visibility:hidden, but for elements within it that are visible again. All other text is emitted, with that of
formulas and drawings and what stands in for objects, sound and pictures. Blocks begin new lines, spaced
blocks have a blank line around them, list items get a marker and an indent, pre keeps its lines, and the cells of a
table's rows stand in columns of equal width, with rows and columns spanned; text of a table outside of its cells comes before them.

The bounds of a layout are parameters (Layout) and lose no text: elements nested deeper than depth are siblings, tables deeper
than nested are laid out as blocks, cells wider than padded (if set) are not padded, a table whose alignment would take more than blanks characters is
not aligned, and spans beyond span count as that many columns.

Defined results: null and empty pages give an empty text; a page without tags is its own text with white space
collapsed; very long pages are read whole; repeated rows get equal texts; an empty table gives no rows; other columns, whatever their
names, are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import leanly, slices


@dataclass(frozen=True)
class Layout:
    depth: int = 500
    padded: int | None = None
    nested: int = 150
    blanks: int = 1 << 24
    span: int = 1000


_TAG = re.compile(
    r"<!--(?:-?>|.*?(?:--!?>|\Z))|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*)>|<[!?/][^>]*>", re.S
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*(?:=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_NONE, _VISIBILITY = re.compile(r"display\s*:\s*none", re.I), re.compile(r"visibility\s*:\s*(hidden|collapse|visible)", re.I)
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript template".split())
HIDDEN = set("head script style title template noscript iframe noembed noframes datalist rp defs desc metadata annotation annotation-xml".split())
SPACED = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure article section fieldset hr menu".split())
BLOCK = SPACED | set("html body div address aside header footer main nav li dt dd tr caption form details summary figcaption legend option center td th thead tbody tfoot dialog text".split())
#: An element that begins closes the open ones named first, if they stand above the ones named second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "table"}),
    "dt": ({"dt", "dd"}, {"dl", "table"}),
    "dd": ({"dt", "dd"}, {"dl", "table"}),
    "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "thead": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "caption"}, {"table"}),
}
CLOSES_P = BLOCK - {"text", "td", "th", "tr", "caption", "thead", "tbody", "tfoot", "option", "legend", "html", "body"}
IN_HEAD = set("base link meta title style script template noscript".split())


class Node:
    __slots__ = ("tag", "attributes", "children", "hidden", "seen")

    def __init__(self, tag: str, attributes: str = "") -> None:
        self.tag, self.attributes, self.children = tag, attributes, []
        self.hidden, self.seen = tag in HIDDEN, None  # seen: None as around it
        own = attributes.lower() if attributes else ""
        if "hidden" in own or "display" in own or "visibility" in own:
            style = self.get("style") or ""
            self.hidden |= self.get("hidden") is not None or bool(_NONE.search(style)) or tag == "input" and self.get("type") == "hidden"
            if found := _VISIBILITY.findall(style):
                self.seen = found[-1].lower() == "visible"
        if tag == "dialog":
            self.hidden |= self.get("open") is None

    def get(self, name: str, exact: bool = False) -> str | None:
        for key, value in _ATTRIBUTE.findall(self.attributes):
            if key.lower() == name:
                return value.strip("\"'") if exact else value.strip("\"'").lower()
        return None


class _Builder:
    def __init__(self, depth: int) -> None:
        self.root, self.depth = Node("html"), depth
        self.stack, self.open = [self.root], {"html": 1}

    def _pop(self) -> None:
        self.open[self.stack.pop().tag] -= 1

    def _close(self, tags: set[str], within: set[str]) -> None:
        """Close the nearest open element with one of the tags, and all in it, unless one of within comes first."""
        if any(self.open.get(t) for t in tags):
            for at in range(len(self.stack) - 1, 0, -1):
                if self.stack[at].tag in tags:
                    while len(self.stack) > at:
                        self._pop()
                    return
                if self.stack[at].tag in within:
                    return

    def begin(self, tag: str, attributes: str) -> None:
        if self.open.get("head") and tag not in IN_HEAD and tag != "head":
            self._close({"head"}, set())
        if tag in ("html", "body"):
            own = Node(tag, attributes)
            self.root.hidden |= own.hidden
            self.root.seen = self.root.seen if own.seen is None else own.seen
            return
        if tag in CLOSES_P:
            self._close({"p"}, {"table", "td", "th", "caption", "button"})
        if tag in IMPLIED:
            tags, within = IMPLIED[tag]
            for _ in range(3 if tag in ("tr", "thead", "tbody", "tfoot") else 1):
                self._close(tags if tag not in ("thead", "tbody", "tfoot") else tags | {"tr", "td", "th"}, within)
        node = Node(tag, attributes)
        self.stack[-1].children.append(node)
        if tag not in VOID and len(self.stack) < self.depth:
            self.stack.append(node)
            self.open[tag] = self.open.get(tag, 0) + 1
        elif tag in BLOCK:
            self.stack[-1].children.append(" ")  # its text, which follows as a sibling, stays apart

    def end(self, tag: str) -> None:
        if tag not in ("html", "body"):
            self._close({tag}, set() if tag == "table" else {"table"} if tag in ("tr", "tbody", "thead", "tfoot", "td", "th", "caption") else {"td", "th", "table"})

    def text(self, text: str) -> None:
        if text:
            if self.open.get("head") and not text.isspace():
                self._close({"head"}, set())
            self.stack[-1].children.append(unescape(text) if "&" in text else text)


def parsed(page: str, depth: int = Layout.depth) -> Node:
    own, at, last, sheets = _Builder(depth), 0, page.rfind(">"), []
    while at <= last and (m := _TAG.search(page, at)):
        own.text(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        if m[1] or m[4]:
            own.end(tag)
            continue
        attributes = m[3] if m[2] else m[6]
        own.begin(tag, attributes)
        if tag in RAW and not attributes.endswith("/"):
            close = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)", re.I).search(page, at)
            stop = close.start() if close else len(page)
            if tag == "style":
                sheets.append(page[at:stop])
            if tag in ("textarea", "xmp"):
                own.stack[-1].children.append(unescape(page[at:stop]) if tag == "textarea" else page[at:stop])
            at = stop
            if not close:
                break
    own.text(page[at:])
    if any("display" in s.lower() or "visibility" in s.lower() for s in sheets):
        _style(own.root, _rules("\n".join(sheets)))
    return own.root


_COMMENT, _RULE = re.compile(r"/\*.*?(?:\*/|\Z)|<!--|-->", re.S), re.compile(r"([^{}]*)\{([^{}]*)\}")
_SHOWN, _SEEN = re.compile(r"(?:^|;)\s*display\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I), re.compile(r"(?:^|;)\s*visibility\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SELECTOR = re.compile(r"(?:([a-zA-Z][\w-]*)|\*)?((?:[.#][\w-]+)*)")


def _flat(sheet: str) -> str:
    """The rules outside of at-rules, and those within @media blocks that name screen or all media and no condition."""
    out, at = [], 0
    sheet = _COMMENT.sub(" ", sheet)
    while (k := sheet.find("@", at)) >= 0:
        out.append(sheet[at:k])
        stop = next((i for i in range(k, len(sheet)) if sheet[i] in "{;"), len(sheet))
        if stop == len(sheet) or sheet[stop] == ";":
            at = stop + 1
            continue
        level, end = 1, stop + 1
        for m in re.compile(r"[{}]").finditer(sheet, stop + 1):
            level += 1 if m[0] == "{" else -1
            end = m.end()
            if not level:
                break
        else:
            end = len(sheet)
        if re.fullmatch(r"@media\s+(screen|all)\s*", sheet[k:stop], re.I):
            out.append(_flat(sheet[stop + 1 : end - 1]))
        at = end
    return "".join([*out, sheet[at:]])


def _rules(sheet: str) -> dict[str, list[tuple]]:
    """Rules about display and visibility whose selector is of tag, classes and id, by the rarest of these: (order, tag, names, display, visibility)."""
    found: dict[str, list[tuple]] = {}
    for n, (selectors, body) in enumerate(_RULE.findall(_flat(sheet))):
        shown, seen = ([(v.lower(), bool(i)) for v, i in p.findall(body)] for p in (_SHOWN, _SEEN))
        if not shown and not seen:
            continue
        for selector in selectors.split(","):
            m = _SELECTOR.fullmatch(selector.strip())
            if m and selector.strip():
                names = re.findall(r"[.#][\w-]+", m[2])
                weight = (sum(x[0] == "#" for x in names), sum(x[0] == "." for x in names), bool(m[1]), n)
                key = max(names, key=lambda x: (x[0] == "#", x)) if names else (m[1] or "*").lower()
                best = [max(own, key=lambda x: x[1]) if own and not own[-1][1] else own[-1] if own else None for own in (shown, seen)]
                found.setdefault(key, []).append((weight, (m[1] or "").lower(), frozenset(names), *best))
    return found


def _style(root: Node, rules: dict[str, list[tuple]]) -> None:
    """Set what the page's own rules hide or show; the heavier selector wins, then the later one; a style attribute beats both unless they are important."""
    todo = [root]
    while todo:
        node = todo.pop()
        todo.extend(c for c in node.children if isinstance(c, Node))
        names: set[str] = set()
        if node.attributes:
            names = {"." + x for x in (node.get("class", True) or "").split()} | ({"#" + i} if (i := node.get("id", True)) else set())
        hits = [r for key in ("*", node.tag, *names) for r in rules.get(key, ()) if (not r[1] or r[1] == node.tag) and r[2] <= names]
        if not hits or node.tag in HIDDEN:
            continue
        style = node.get("style") or "" if node.attributes else ""
        for at, inline in ((3, _SHOWN), (4, _SEEN)):
            own = [(r[at][1], 0, r[0], r[at][0]) for r in hits if r[at]] + [(bool(i), 1, (0, 0, False, 0), v.lower()) for v, i in inline.findall(style)]
            if own:
                value = max(own, key=lambda x: x[:3])[3]
                if at == 3:
                    node.hidden = value == "none"
                elif value in ("hidden", "collapse", "visible"):
                    node.seen = value == "visible"


class _Lines:
    """Lines of one flow of text: the page, or a cell."""

    def __init__(self) -> None:
        self.lines, self.parts, self.gap, self.indent, self.marker = [], [], False, [], ""

    def flush(self) -> None:
        text = " ".join("".join(self.parts).split(" ")).strip(" ")
        self.parts = []
        if text:
            self.put(re.sub(" {2,}", " ", text))

    def put(self, line: str) -> None:
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        before = "".join(self.indent)
        if self.marker:
            before, self.marker = before[: -len(self.marker)] + self.marker, ""
        self.lines.append((before + line).rstrip())


def _number(value: str | None, most: int, least: int = 1) -> int:
    return max(least, min(most, int(value))) if value and value.isascii() and value.isdigit() and len(value) < 10 else least


def rendered(root: Node, layout: Layout = Layout(), level: int = 0, seen: bool = True) -> list[str]:
    out, pre = _Lines(), 0
    stack: list[tuple] = [(root, 0, seen)]
    lists: list[list] = []
    while stack:
        node, state, seen = stack.pop()
        if isinstance(node, str):
            if not seen:
                continue
            if pre:
                head, *rest = node.split("\n")
                out.parts.append(head)
                for line in rest:
                    out.put("".join(out.parts))
                    out.parts = [line]
            else:
                out.parts.append(re.sub(r"[ \t\n\r\f]+", " ", node))
            continue
        tag = node.tag
        if state == 0:
            if node.hidden:
                continue
            seen = seen if node.seen is None else node.seen
            if tag == "br":
                if any(p.strip() for p in out.parts):
                    out.flush()
                elif out.lines:
                    out.gap = True
                continue
            if tag in BLOCK:
                out.flush()
                out.gap |= tag in SPACED and not (lists and tag in ("ul", "ol", "menu"))
            if tag == "hr":
                if seen:
                    out.put("-" * 8)
                out.gap = True
                continue
            if tag == "table" and level < layout.nested:
                for line in _table(node, layout, level, seen):
                    out.put(line)
                out.gap = True
                continue
            if tag in ("ul", "ol", "menu"):
                lists.append([tag, _number(node.get("start"), 10**9, 1) - 1] if tag == "ol" else [tag, 0])
            elif tag == "li":
                own = lists[-1] if lists else ["ul", 0]
                own[1] += 1
                out.marker = f"{own[1]}. " if own[0] == "ol" else "- "
                out.indent.append(" " * len(out.marker))
            elif tag in ("dd", "blockquote"):
                out.indent.append("  ")
            elif tag in ("td", "th"):
                out.parts.append(" ")
            pre += tag in ("pre", "textarea", "xmp")
            stack.append((node, 1, seen))
            children = node.children
            if tag == "details" and node.get("open") is None:
                children = [c for c in children if isinstance(c, Node) and c.tag == "summary"][:1]
            stack.extend((c, 0, seen) for c in reversed(children))
            continue
        if tag in ("pre", "textarea", "xmp"):
            pre -= 1
            if (last := "".join(out.parts)).strip():
                out.put(last)
            out.parts = []
        if tag in BLOCK:
            out.flush()
            out.gap |= tag in SPACED and not (len(lists) > 1 and tag in ("ul", "ol", "menu"))
        if tag in ("ul", "ol", "menu"):
            lists.pop()
        elif tag == "li":
            out.indent.pop()
            out.marker = ""
        elif tag in ("dd", "blockquote"):
            out.indent.pop()
    out.flush()
    return out.lines


def _table(table: Node, layout: Layout, level: int, seen: bool) -> list[str]:
    """Caption lines, then the rows: cells in columns of equal width, two spaces apart; loose text keeps its place before."""
    loose, rows, todo = Node("div"), [], [(table, seen)]
    while todo:
        node, shown = todo.pop()
        for c in node.children:
            if isinstance(c, str):
                loose.children.append(c)
                continue
            if c.hidden:
                continue
            own = shown if c.seen is None else c.seen
            if c.tag in ("thead", "tbody", "tfoot"):
                todo.insert(0, (c, own))
            elif c.tag == "tr" or c.tag in ("td", "th") and node.tag != "tr":
                rows.append((c, own))
            else:
                loose.children.append(c)
    grid, taken = [], {}
    for r, (row, shown) in enumerate(rows):
        cells, col = {}, 0
        for c in row.children if row.tag == "tr" else [row]:
            if isinstance(c, str) or c.tag not in ("td", "th"):
                loose.children.append(c)
                continue
            while taken.get(col, 0) > r:
                col += 1
            wide = _number(c.get("colspan"), layout.span)
            if not c.hidden:
                cells[col] = (wide, rendered(_flow(c), layout, level + 1, shown if c.seen is None else c.seen))
            if (tall := _number(c.get("rowspan"), 10_000)) > 1:
                taken.update((x, r + tall) for x in range(col, col + wide))
            col += wide
        grid.append(cells)
    widths: dict[int, int] = {}
    for cells in grid:
        for col, (wide, lines) in cells.items():
            if wide == 1:
                own = max(map(len, lines), default=0)
                widths[col] = max(widths.get(col, 0), own if layout.padded is None else min(layout.padded, own))
    if sum(widths.values()) * len(grid) > layout.blanks:  # alignment would take more room than that
        widths = dict.fromkeys(widths, 0)
    out = rendered(loose, layout, level + 1, seen)
    for cells in grid:
        for k in range(max((len(lines) for _, lines in cells.values()), default=0)):
            line, end = "", 0
            for col in sorted(cells):
                line += " " * max(0, sum(widths.get(x, 0) + 2 for x in range(end, col))) if col > end else ""
                wide, lines = cells[col]
                room = sum(widths.get(x, 0) for x in range(col, col + wide)) + 2 * (wide - 1)
                line += (lines[k] if k < len(lines) else "").ljust(room) + "  "
                end = col + wide
            out.append(line.rstrip())
    return out


def _flow(cell: Node) -> Node:
    own = Node("div")
    own.children = cell.children
    return own


def text_of(page: str | None, layout: Layout = Layout()) -> str:
    return "\n".join(rendered(parsed(page, layout.depth), layout)) if page else ""


def extracted(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", layout: Layout = Layout()) -> DataFrame:
    """id_col, text and n_lines of each page."""

    def run(batches):
        for batch in slices(batches):
            texts = [text_of(p, layout) for p in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], names=["id", "text", "n_lines"])

    kind = pages.schema[id_col].dataType.simpleString()
    own = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    return own.mapInArrow(leanly(run), f"id {kind}, text string, n_lines long").withColumnRenamed("id", id_col)
