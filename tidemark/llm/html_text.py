"""HTML to text by layout: a tree builder with implied tags, visibility rules, and a renderer.

The tree builder closes what HTML lets authors leave open (paragraphs, list items, table parts, options),
opens what they may leave out (table rows), ends a head at the first tag or text that may not stand there,
ignores end tags without a start, and never lets an end tag
inside a table cell close what lies outside it. Below ``MAX_DEPTH`` nested elements, further ones become
children of the element at that depth, as in browsers.

What is not shown gives no text: head, scripts, styles, templates, comments, what ``noscript`` and other elements of
``UNSEEN`` hold, elements with ``hidden`` (unless a style displays them) or whose style says ``display:none``, and
text whose ``visibility``, its own or the nearest given above it, is ``hidden`` or ``collapse``. Styles are those of the
element and of the page's own ``<style>`` blocks: rules whose selector is an element's name, classes and id, or
parts of these, by importance, specificity and order. Blocks for media other than a screen, linked style sheets and
other selectors (with descendants, attributes, states) are not applied. Details are shown whether open or not. All other text is: navigation and footers too, the
values of buttons and text inputs, formulas, and the text elements of drawings, each on a line of its own
(not their definitions, descriptions and annotations).

Blocks stand on lines of their own, those with a margin with an empty line around them. List items get
"- " or their number and a hanging indent; white space runs to one space but in ``pre``; a table has one
line per row (more where cells have several), its columns padded to the widest cell, spanning cells
included.

Defined results: a NULL page is NULL, an empty one or one without visible text is empty. Markup that is
none (a lone "<") is text. Repeated rows and rows with a NULL id are rendered like any other. Other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
import unicodedata
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from tidemark.llm.common import map_rows, picked

MAX_DEPTH = 200
MAX_SPAN = 1000
GUTTER = "  "

# Element names of HTML by their part in parsing and layout.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = set(
    "head script style template title noscript iframe noembed noframes datalist canvas audio video object "
    "area base link meta param source track col colgroup".split()
)
MARGIN = set("p h1 h2 h3 h4 h5 h6 ul ol dl table pre blockquote figure hr fieldset form".split())
BLOCK = MARGIN | set(
    "address article aside body center dd details dialog dir div dt figcaption footer header hgroup html "
    "legend li main menu nav optgroup option section summary tbody td tfoot th thead tr caption search".split()
)
CLOSES_P = BLOCK - set("body html option optgroup td th tr tbody thead tfoot caption legend".split())
# a start tag closes the nearest of these, unless one of those stands between
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th"}, {"table", "tr"}),
    "th": ({"td", "th"}, {"table", "tr"}),
    "tr": ({"tr"}, {"table"}),
    "tbody": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "caption", "colgroup"}, {"table"}),
}
SCOPE = {"table", "td", "th", "caption"}
TABLE_PARTS = {"table", "tr", "tbody", "thead", "tfoot"}
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
IN_HEAD = set("base basefont bgsound link meta title noframes noscript script style template".split())
# within drawings and formulas: what is not shown, what holds HTML, and tags that end them
FOREIGN = {"svg", "math"}
FOREIGN_UNSEEN = {
    "svg": set("defs desc metadata symbol clippath mask pattern marker".split()),
    "math": {"annotation", "annotation-xml"},
}
HTML_INSIDE = set("foreignobject desc title annotation-xml mi mo mn ms mtext".split())
ENDS_FOREIGN = BLOCK & set(
    "blockquote body center dd dir div dl dt h1 h2 h3 h4 h5 h6 hr li menu ol p pre table ul".split()
) | set("b big br code em embed i img nobr s small span strike strong sub sup tt u var".split())
# inputs that show their value
SHOWN_INPUTS = set("submit button reset text search email url tel number".split())
DRAWN = "\x00drawn"

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z>][^>]*(?:>|\Z)|</>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attributes>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][^\s/>]*)(?P<attributes2>[^>]*)>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?")
_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_RULE = re.compile(r"([^{}]*)\{((?:[^{}]|\{[^{}]*\})*)\}?")
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+)*)")
_SHOWN_MEDIA = re.compile(r"@media\s+(?:only\s+)?(?:all|screen)\b(?!.*\bnot\b)", re.I | re.S)
_SPACE = re.compile(r"[ \t\n\r\f\x00]+")
# inside the renderer: a forced line break and a space that stays
BREAK, FIXED = "\x01", "\x02"


@dataclass
class Node:
    name: str
    attributes: dict[str, str] = field(default_factory=dict)
    children: list[Node | str] = field(default_factory=list)
    # set by the page's styles: not displayed, and whether its own text is seen
    gone: bool = False
    unseen: bool = False


def attributes_of(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, value in _ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), html.unescape(value.strip("\"'")))
    return found


class Builder:
    def __init__(self):
        self.root = Node("html")
        self.stack = [self.root]

    def text(self, text: str) -> None:
        if self.stack[-1].name == "head" and text.strip(" \t\n\r\f"):
            self.stack.pop()
        # drawings show the text of text elements only
        if text and self.stack[-1].name != "svg" and not (self.stack[-1].name == "g" and self.foreign()):
            self.stack[-1].children.append(text)

    def foreign(self) -> str | None:
        """svg or math, if the next element belongs to one."""
        for node in reversed(self.stack):
            if node.name in FOREIGN:
                return node.name
            if node.name in HTML_INSIDE:
                return None
        return None

    def begun(self) -> bool:
        """Whether anything but space has come."""
        return any(not isinstance(c, str) or c.strip() for c in self.root.children)

    def close(self, names: set[str], stops: set[str]) -> None:
        """Close the nearest open element of ``names``, unless one of ``stops`` stands between."""
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i].name in names:
                del self.stack[i:]
                return
            if self.stack[i].name in stops:
                return

    def start(self, name: str, attributes: dict[str, str]) -> Node:
        if self.stack[-1].name == "head" and name not in IN_HEAD:
            self.stack.pop()
        if foreign := self.foreign():
            if name not in ENDS_FOREIGN:
                return self.start_foreign(name, attributes, foreign)
            self.close({foreign}, set())
        if name in CLOSES_P:
            self.close({"p"}, SCOPE | {"button", "object"})
        if name in CLOSES:
            names, stops = CLOSES[name]
            self.close(names, stops)
        if name in TABLE_PARTS - {"table"}:
            self.close({"td", "th"}, {"table"})
            self.close({"tr"}, {"table"})
        if name in HEADINGS and self.stack[-1].name in HEADINGS:
            self.stack.pop()
        if name in ("td", "th") and self.stack[-1].name in ("table", "tbody", "thead", "tfoot"):
            self.start("tr", {})
        node = Node(name, attributes)
        self.stack[-1].children.append(node)
        if name not in VOID and len(self.stack) < MAX_DEPTH:
            self.stack.append(node)
        return node

    def start_foreign(self, name: str, attributes: dict[str, str], foreign: str) -> Node:
        if name in FOREIGN_UNSEEN[foreign]:
            attributes = {**attributes, "hidden": ""}
        if name == "text" and foreign == "svg":
            attributes = {**attributes, DRAWN: ""}
        node = Node(name, attributes)
        self.stack[-1].children.append(node)
        if len(self.stack) < MAX_DEPTH:
            self.stack.append(node)
        return node

    def end(self, name: str) -> None:
        if name in ("html", "body") and self.stack[-1].name == "head":
            self.stack.pop()
        if name == "br":
            self.start("br", {})
        elif name not in ("html", "body") and name not in VOID:
            stops = {"table"} if name in TABLE_PARTS else SCOPE
            self.close({name}, stops - {name})


def parse(source: str) -> Node:
    builder = Builder()
    at = 0
    while found := _TAG.search(source, at):
        builder.text(html.unescape(source[at : found.start()]))
        at = found.end()
        name = found["name"] or found["name2"]
        if found["cdata"] is not None:
            builder.text(found["cdata"])
        if not name:
            continue
        name = name.lower()
        if found["end"] or found["end2"]:
            builder.end(name)
            continue
        if name in ("html", "body") or name == "head" and builder.begun():
            if name == "body" and builder.stack[-1].name == "head":
                builder.stack.pop()
            continue
        inside = found["attributes"] or found["attributes2"] or ""
        attributes = attributes_of(inside)
        if inside.endswith("/") and (name in FOREIGN or builder.foreign() and name not in ENDS_FOREIGN):
            node = builder.start(name, attributes)
            if builder.stack[-1] is node:
                builder.stack.pop()
        elif name in RAW:
            node = builder.start(name, attributes)
            if builder.stack[-1] is node:
                builder.stack.pop()
            closing = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*>|\Z", re.I).search(source, at)
            inside = source[at : closing.start()]
            node.children.append(html.unescape(inside) if name in ("textarea", "title") else inside)
            at = closing.end()
        else:
            builder.start(name, attributes)
    builder.text(html.unescape(source[at:]))
    return builder.root


# What styles say about being seen: {property: (value, important)}.
Declared = dict[str, tuple[str, bool]]


def declarations(source: str) -> Declared:
    """The declarations of ``display`` and ``visibility``; of several the last important one, else the last."""
    found: Declared = {}
    for part in _COMMENT.sub(" ", source).split(";"):
        name, colon, value = part.partition(":")
        name = name.strip().lower()
        if not colon or name not in ("display", "visibility"):
            continue
        value, _, mark = value.lower().partition("!")
        important = mark.strip() == "important"
        if name not in found or important or not found[name][1]:
            found[name] = value.strip(), important
    return found


@dataclass
class Rule:
    """A rule of a style block that says something about being seen."""

    name: str | None
    classes: set[str]
    ids: set[str]
    declared: Declared
    order: int

    def matches(self, node: Node) -> bool:
        if self.name and self.name != node.name:
            return False
        if self.ids and self.ids != {node.attributes.get("id")}:
            return False
        return self.classes <= set(node.attributes.get("class", "").split())

    def weight(self) -> tuple[int, int, int, int]:
        return len(self.ids), len(self.classes), int(bool(self.name)), self.order


def rules_of(sheet: str, order: int = 0) -> list[Rule]:
    found: list[Rule] = []
    # a statement such as @import has no block and ends at its semicolon
    sheet = re.sub(r"@(?:import|charset|namespace)[^;{}]*;", " ", _COMMENT.sub(" ", sheet), flags=re.I)
    for selectors, body in _RULE.findall(sheet.replace("<!--", " ").replace("-->", " ")):
        if selectors.strip().startswith("@"):
            if _SHOWN_MEDIA.match(selectors.strip()):
                found += rules_of(body, order + len(found))
            continue
        declared = declarations(body) if "{" not in body else {}
        for selector in selectors.split(",") if declared else []:
            parts = _COMPOUND.fullmatch(selector.strip())
            if not parts or not selector.strip():
                continue
            marks = re.findall(r"([.#])([\w-]+)", parts[2])
            name = None if parts[1] in (None, "*") else parts[1].lower()
            classes = {n for kind, n in marks if kind == "."}
            ids = {n for kind, n in marks if kind == "#"}
            found.append(Rule(name, classes, ids, declared, order + len(found)))
    return found


def sheets_of(root: Node) -> list[str]:
    """The style blocks of a page, in order."""
    found, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        if node.name == "style":
            if _SHOWN_MEDIA.match(f"@media {node.attributes.get('media') or 'all'}"):
                found.append("".join(c for c in node.children if isinstance(c, str)))
        waiting += [c for c in reversed(node.children) if isinstance(c, Node)]
    return found


def apply_styles(root: Node) -> Node:
    """Tell every element whether it is displayed and whether its own text is seen."""
    rules: list[Rule] = []
    for sheet in sheets_of(root):
        rules += rules_of(sheet, len(rules))
    waiting = [(root, False)]
    while waiting:
        node, unseen = waiting.pop()
        said: dict[str, tuple[tuple, str]] = {}
        own = declarations(node.attributes["style"]) if "style" in node.attributes else {}
        fitting = [(rule.declared, (0, *rule.weight())) for rule in rules if rule.matches(node)]
        for declared, weight in [*fitting, (own, (1,))]:
            for name, (value, important) in declared.items():
                if name not in said or (important, *weight) > said[name][0]:
                    said[name] = (important, *weight), value
        display = said["display"][1] if "display" in said else None
        node.gone = display == "none" or display is None and "hidden" in node.attributes
        seen = said["visibility"][1] if "visibility" in said else "inherit"
        if seen in ("hidden", "collapse"):
            unseen = True
        elif seen in ("visible", "initial"):
            unseen = False
        node.unseen = unseen
        waiting += [(c, unseen) for c in node.children if isinstance(c, Node)]
    _drop_unseen(root)
    return root


def _drop_unseen(root: Node) -> None:
    """An element without any seen text or element in it takes no room."""
    order, waiting = [], [root]
    while waiting:
        node = waiting.pop()
        order.append(node)
        waiting += [c for c in node.children if isinstance(c, Node)]
    for node in reversed(order):
        if node.unseen and all(isinstance(c, str) or c.gone for c in node.children):
            node.gone = True


def visible(node: Node) -> bool:
    if node.name in UNSEEN or node.gone:
        return False
    return node.name != "input" or node.attributes.get("type", "text").lower() in SHOWN_INPUTS


def width(text: str) -> int:
    """Columns of a terminal: wide characters take two, combining ones none."""
    if text.isascii():
        return len(text)
    return sum(
        0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text
    )


class Page:
    """Lines so far, and the inline text of the line to come."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.gap = False

    def text(self, text: str, keep: bool) -> None:
        text = text.replace(BREAK, "").replace(FIXED, "").replace("\xa0", FIXED)
        if keep:
            text = text.replace("\r\n", "\n").replace("\t", FIXED * 4).replace(" ", FIXED).replace("\n", BREAK)
        self.inline.append(text)

    def flush(self) -> None:
        """End the line; a last forced break adds none."""
        if not self.inline:
            return
        parts = _SPACE.sub(" ", "".join(self.inline)).split(BREAK)
        self.inline = []
        if not parts[-1].strip(" "):
            parts.pop()
        self.put([p.strip(" ").replace(FIXED, " ") for p in parts])

    def put(self, lines: list[str]) -> None:
        if not any(line.strip() for line in lines):
            return
        if self.gap and self.lines:
            self.lines.append("")
        self.gap = False
        self.lines += [line.rstrip() for line in lines]

    def block(self, margin: bool) -> None:
        self.flush()
        self.gap = self.gap or margin


def number(value: str | None, default: int) -> int:
    found = re.match(r"\s*([+-]?\d{1,9})", value or "")
    return int(found[1]) if found else default


def indented(lines: list[str], first: str) -> list[str]:
    rest = " " * width(first)
    return [(first if i == 0 else rest if line else "") + line for i, line in enumerate(lines)]


def render(node: Node, page: Page, keep: bool = False, inside_list: bool = False) -> None:
    for child in node.children:
        if isinstance(child, str):
            if not node.unseen:
                page.text(child, keep)
            continue
        name = child.name
        if not visible(child):
            continue
        if name == "br":
            page.inline.append(BREAK)
        elif name == "input":
            page.text(child.attributes.get("value", ""), keep)
        elif name == "table":
            page.block(True)
            page.put(table(child))
            page.block(True)
        elif name in ("ul", "ol", "menu", "dir"):
            page.block(not inside_list)
            page.put(listing(child))
            page.block(not inside_list)
        elif name in ("blockquote", "dd"):
            page.block(name in MARGIN)
            page.put(indented(lines_of(child), "  "))
            page.block(name in MARGIN)
        elif name in BLOCK or DRAWN in child.attributes:
            page.block(name in MARGIN)
            render(child, page, keep or name == "pre", inside_list)
            page.block(name in MARGIN)
        else:
            if name in ("td", "th"):
                page.block(False)
            render(child, page, keep or name == "textarea", inside_list)


def lines_of(node: Node, inside_list: bool = False) -> list[str]:
    page = Page()
    render(node, page, node.name == "pre", inside_list)
    page.flush()
    return page.lines


def listing(node: Node) -> list[str]:
    out: list[str] = []
    count = number(node.attributes.get("start"), 1)
    loose = Node(node.name, unseen=node.unseen)
    for child in [*node.children, None]:
        if isinstance(child, Node) and child.name == "li" or child is None:
            out += lines_of(loose, True)
            loose = Node(node.name, unseen=node.unseen)
            if child is None:
                break
            count = number(child.attributes.get("value"), count)
            if visible(child):
                mark = f"{count}. " if node.name == "ol" else "- "
                out += indented(lines_of(child, True) or [""], mark)
                count += 1
        else:
            loose.children.append(child)
    return out


def rows_of(node: Node) -> list[Node]:
    """The rows of a table: head, bodies, foot."""
    parts: dict[str, list[Node]] = {"thead": [], "tbody": [], "tfoot": []}
    for child in node.children:
        if isinstance(child, Node) and visible(child):
            if child.name == "tr":
                parts["tbody"].append(child)
            elif child.name in parts:
                parts[child.name] += [
                    r for r in child.children if isinstance(r, Node) and r.name == "tr" and visible(r)
                ]
    return parts["thead"] + parts["tbody"] + parts["tfoot"]


def misplaced(node: Node) -> list[Node | str]:
    """What stands in a table, its sections or rows, but in no cell; as in browsers it goes before the table."""
    sections = {"thead", "tbody", "tfoot"}
    inside = {"table": sections | {"tr"}, "tr": {"td", "th"}} | dict.fromkeys(sections, {"tr"})
    out: list[Node | str] = []
    for child in node.children:
        if isinstance(child, Node) and child.name in inside[node.name]:
            if child.name in inside and visible(child):
                out += misplaced(child)
        else:
            out.append(child)
    return out


def table(node: Node) -> list[str]:
    """Caption and stray text first, then the rows."""
    out = lines_of(Node("div", {}, misplaced(node), unseen=node.unseen))
    grid: list[list[tuple[int, int, list[str]]]] = []
    taken: dict[int, int] = {}  # column -> rows still under a cell from above
    for row in rows_of(node):
        cells, column, started = [], 0, {}
        for cell in row.children:
            if not isinstance(cell, Node) or cell.name not in ("td", "th"):
                continue
            while taken.get(column, 0) > 0:
                column += 1
            span = min(MAX_SPAN, max(1, number(cell.attributes.get("colspan"), 1)))
            down = min(MAX_SPAN, max(1, number(cell.attributes.get("rowspan"), 1)))
            shown = visible(cell)
            cells.append((column, span, lines_of(cell) if shown else []))
            for c in range(column, column + span):
                started[c] = down - 1
            column += span
        taken = {c: n - 1 for c, n in taken.items() if n > 1}
        taken.update({c: n for c, n in started.items() if n > 0})
        grid.append(cells)
    widths: dict[int, int] = {}
    for want_single in (True, False):
        for cells in grid:
            for column, span, lines in cells:
                if (span == 1) != want_single:
                    continue
                need = max(map(width, lines), default=0)
                have = sum(widths.get(c, 0) for c in range(column, column + span)) + len(GUTTER) * (span - 1)
                if need > have:
                    last = column + span - 1
                    widths[last] = widths.get(last, 0) + need - have
    edges, at = {}, 0
    columns = max((c + s for cells in grid for c, s, _ in cells), default=0)
    for c in range(columns):
        edges[c] = at
        at += widths.get(c, 0) + (len(GUTTER) if widths.get(c, 0) else 0)
    for cells in grid:
        for i in range(max((len(lines) for _, _, lines in cells), default=0)):
            line, size = "", 0
            for column, _, lines in cells:
                if i < len(lines) and lines[i]:
                    line += " " * (edges[column] - size) + lines[i]
                    size = edges[column] + width(lines[i])
            out.append(line.rstrip())
    return out


def extract(source: str | None) -> str | None:
    """Visible text of a page."""
    if source is None:
        return None
    return "\n".join(lines_of(apply_styles(parse(source))))


def extract_text(df: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, text) of every row."""
    return map_rows(
        picked(df, page_id=page_id, html=html), lambda: lambda value: (extract(value),), "text string", ("page_id",)
    )
