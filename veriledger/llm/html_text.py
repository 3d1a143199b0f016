"""Visible text of web pages, laid out: blocks on lines of their own, lists with their marks, table cells in
aligned columns.

A page is cut into tags and text, built into a tree with the tags that HTML leaves out (paragraphs, list
items, table parts, head and body end where the next element ends them), and rendered. What a browser does not
show is left out: head, scripts, styles, templates, hidden elements, closed details and dialogs, and what inline
styles or the page's own style rules hide. Rules cascade as in a browser: by importance, specificity and order;
selectors of tags, classes, ids, attributes, descendants and children count, others hide and show nothing. Of the
blocks that begin with @, those count that a screen of VIEWPORT pixels surely reads.

Each page is worked on alone, whole, in time proportional to its length but for cells that span and for style rules, each
of which is held against every kind of element that it may be for. Null is a page
without text; broken markup never fails. Elements nested deeper than DEEPEST are laid out as if they were not
nested further.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veriledger.llm.frames import extended

DEEPEST = 200

# The groups of elements that HTML names.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style xmp iframe noembed noframes noscript textarea title plaintext".split())
UNSEEN = set("head script style template noscript title iframe noembed noframes datalist audio video canvas "
             "object embed map area param source track meta link base col colgroup rp".split())
IN_HEAD = set("base basefont bgsound link meta noframes noscript script style template title".split())
BLOCKS = set("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption "
             "figure footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol "
             "optgroup p pre search section summary table ul xmp".split())
SPACED = set("blockquote dl fieldset figure h1 h2 h3 h4 h5 h6 hr menu ol p pre table ul xmp".split())
ENDS_P = set("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
             "form h1 h2 h3 h4 h5 h6 header hgroup hr li dd dt main menu nav ol p pre search section summary table "
             "ul xmp".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
LISTS = set("ul ol menu dir".split())
SECTIONS = set("thead tbody tfoot".split())
TABLE_PARTS = set("caption col colgroup thead tbody tfoot tr td th".split())
BARRIERS = set("applet caption html table td th marquee object template button".split())
SPECIAL = BLOCKS | TABLE_PARTS | BARRIERS

_TAG = re.compile(r"<(?:!--(?P<comment>.*?)(?:--!?>|\Z)|(?P<other>[!?][^>]*>?)|/(?P<end>[a-zA-Z][^\s/>]*)[^>]*>?"
                  r"|(?P<start>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[\s/]++|[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+(?:\"|\Z)"
                  r"|'[^']*+(?:'|\Z)|[^\s>\"'][^\s>]*+)?+)?+)*+)>?)", re.S)
_ATTRIBUTE = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>\"'][^\s>]*+))?+)?+")
_SPACE = re.compile(r"[ \t\n\f\r]+")
_CSS = re.compile(r"\"(?:\\.|[^\"\\\n])*+\"?|'(?:\\.|[^'\\\n])*+'?|[{};]", re.S)
_COMPOUND = re.compile(r"(\*|[a-zA-Z][\w-]*)?((?:[.#][\w-]+|\[\s*[\w-]+\s*(?:=\s*(?:\"[^\"]*\"|'[^']*'|[\w-]+)\s*)?\])*)")
_PART = re.compile(r"([.#])([\w-]+)|\[\s*([\w-]+)\s*(=)?\s*[\"']?(.*?)[\"']?\s*\]")
_SET = re.compile(r"^\s*(display|visibility)\s*:\s*([a-z][a-z -]*?)\s*(!\s*important)?\s*$", re.I)
_WIDTH = re.compile(r"\(\s*(min|max)-width\s*:\s*([\d.]+)\s*(px|em|rem)\s*\)")

#: Pixels of the screen that a page's style rules are read for.
VIEWPORT = 1280


SEEN = {"visible", "hidden", "collapse"}

#: A rule: its selector as compounds from the outermost on, each with whether it must be the next one's parent, its
#: place among the rules, and what it declares.
Rule = tuple[list, int, dict]


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class Tree:
    """The tree of a page, with implied tags."""

    def __init__(self, page: str):
        self.root = Node("html", {})
        self.outer = Node("html", {})  # what the html tag itself says; the root has the body's attributes
        self.open = [self.root]
        self.rules: list[Rule] = []
        self._build(page.replace("\r\n", "\n").replace("\0", ""))

    def _build(self, page: str) -> None:
        at = 0
        while at < len(page):
            mark = page.find("<", at)
            if mark < 0:
                self._text(html.unescape(page[at:]))
                return
            if mark > at:
                self._text(html.unescape(page[at:mark]))
            m = _TAG.match(page, mark)
            if not m:
                self._text("<")
                at = mark + 1
                continue
            at = m.end()
            if m["start"]:
                at = self._start(m["start"].lower(), m["attrs"], page, at)
            elif m["end"]:
                self._end(m["end"].lower())

    def _text(self, text: str) -> None:
        top = self.open[-1]
        if text.strip(" \t\n\f\r"):
            if top.tag == "head":
                self._pop_to("head")
                top = self.open[-1]
            if top.tag in SECTIONS or top.tag in ("table", "tr"):
                self._foster(text)
                return
        elif top.tag in SECTIONS or top.tag in ("table", "tr", "head", "colgroup"):
            return
        top.children.append(text)

    def _foster(self, child) -> None:
        """What a table may not hold goes before it."""
        at = max(i for i, n in enumerate(self.open) if n.tag == "table")
        above = self.open[at - 1].children
        above.insert(next((i for i in range(len(above) - 1, -1, -1) if above[i] is self.open[at]), len(above)), child)

    def _in_scope(self, tags, barriers=BARRIERS) -> bool:
        for node in reversed(self.open):
            if node.tag in tags:
                return True
            if node.tag in barriers:
                return False
        return False

    def _pop_to(self, *tags: str) -> None:
        while len(self.open) > 1:
            if self.open.pop().tag in tags:
                return

    def _pop_until(self, tags) -> None:
        """Leaves the innermost element of the tags open."""
        while len(self.open) > 1 and self.open[-1].tag not in tags:
            self.open.pop()

    def _start(self, tag: str, attrs: str, page: str, at: int) -> int:
        own = {}
        for m in _ATTRIBUTE.finditer(attrs):
            own.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
        if tag in ("html", "body"):
            if tag == "html":
                self.outer.attrs.update((k, v) for k, v in own.items() if k not in self.outer.attrs)
            else:
                if self.open[-1].tag == "head":
                    self.open.pop()
                self.root.attrs.update((k, v) for k, v in own.items() if k not in self.root.attrs)
            return at
        if self.open[-1].tag == "head" and tag not in IN_HEAD:
            self.open.pop()
        if tag in TABLE_PARTS and not any(n.tag == "table" for n in self.open):
            return at
        self._imply(tag)
        node = Node(tag, own)
        top = self.open[-1]
        if (top.tag in SECTIONS or top.tag in ("table", "tr")) and tag not in TABLE_PARTS \
                and tag not in ("script", "style", "template"):
            self._foster(node)
        else:
            top.children.append(node)
        if tag in RAW:
            return self._raw(node, page, at)
        if tag not in VOID and not (attrs.endswith("/") and tag in ("svg", "path")):
            if len(self.open) <= DEEPEST:
                self.open.append(node)
        return at

    def _raw(self, node: Node, page: str, at: int) -> int:
        """An element whose content is no markup, up to its end tag."""
        end = None if node.tag == "plaintext" else re.compile(rf"</{node.tag}(?=[\s/>]|\Z)[^>]*>?", re.I).search(page, at)
        text = page[at:end.start() if end else len(page)]
        if node.tag == "style":
            self._style(text)
        else:
            node.children.append(html.unescape(text) if node.tag in ("textarea", "title") else text)
        return end.end() if end else len(page)

    def _style(self, text: str) -> None:
        """Reads rules; a block that the text does not end is ended by it."""
        text = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", " ", text, flags=re.S)
        blocks, at = [(True, None, [])], 0  # whether it counts, the selectors of a rule, its declarations
        for m in _CSS.finditer(text + "}" * text.count("{")):
            if m[0][0] not in "{};":
                continue
            part, at = text[at:m.start()], m.end()
            counts, selectors, declared = blocks[-1]
            if m[0] == "{":
                counts = counts and selectors is None  # what is nested in a rule is relative to it
                at_rule = part.lstrip().startswith("@")
                blocks.append((counts and (not at_rule or _read(part)), None if at_rule else part, []))
                continue
            declared.append(part)
            if m[0] == "}" and len(blocks) > 1:
                blocks.pop()
                if counts and selectors is not None and (own := _declared(declared)):
                    for selector in selectors.split(","):
                        if chain := _chain(selector.strip()):
                            self.rules.append((chain, len(self.rules), own))

    def _imply(self, tag: str) -> None:
        """Ends the elements that a start tag ends, and starts those it needs."""
        if tag in ENDS_P and self._in_scope({"p"}):
            self._pop_to("p")
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag == "li" and self._in_scope({"li"}, BARRIERS | LISTS):
            self._pop_to("li")
        elif tag in ("dd", "dt") and self._in_scope({"dd", "dt"}, BARRIERS | {"dl"}):
            self._pop_to("dd", "dt")
        elif tag in ("option", "optgroup") and self.open[-1].tag == "option":
            self.open.pop()
            if tag == "optgroup" and self.open[-1].tag == "optgroup":
                self.open.pop()
        elif tag == "optgroup" and self.open[-1].tag == "optgroup":
            self.open.pop()
        elif tag in ("rt", "rp") and self.open[-1].tag in ("rt", "rp"):
            self.open.pop()
        elif tag == "button" and self._in_scope({"button"}, BARRIERS - {"button"}):
            self._pop_to("button")
        elif tag in TABLE_PARTS:
            if tag in ("td", "th"):
                self._pop_until({"tr", *SECTIONS, "table"})
                if self.open[-1].tag in ("table", *SECTIONS):
                    self._start("tr", "", "", 0)
            elif tag == "tr":
                self._pop_until({*SECTIONS, "table"})
            else:
                self._pop_until({"table"})

    def _end(self, tag: str) -> None:
        if tag == "br":
            self.open[-1].children.append(Node("br", {}))
        elif tag == "p" and not self._in_scope({"p"}):
            self._imply("p")
            self.open[-1].children.append(Node("p", {}))
        elif tag in ("html", "body") or tag in VOID:
            return
        elif tag in HEADINGS:
            if self._in_scope(HEADINGS):
                self._pop_to(*HEADINGS)
        elif tag == "table" or tag in TABLE_PARTS:
            if self._in_scope({tag}, {"table"} - {tag}):
                self._pop_to(tag)
        elif tag == "li":
            if self._in_scope({"li"}, BARRIERS | LISTS):
                self._pop_to("li")
        elif tag in SPECIAL or tag == "p":
            if self._in_scope({tag}, BARRIERS - {tag}):
                self._pop_to(tag)
        else:
            for node in reversed(self.open[1:]):
                if node.tag == tag:
                    self._pop_to(tag)
                    return
                if node.tag in SPECIAL:
                    return


def width(text: str) -> int:
    """Columns that a line takes: two for wide characters, none for marks that combine."""
    if text.isascii():
        return len(text)
    return sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Lines under way: inline text is gathered until a block ends the line."""

    def __init__(self):
        self.done: list[str] = []
        self.line: list[str] = []
        self.gap = False  # white space that waits for more text
        self.blank = False  # a blank line that waits for more lines

    def text(self, text: str) -> None:
        for i, part in enumerate(_SPACE.split(text)):
            if i:
                self.gap = bool(self.line)
            if part:
                if self.gap:
                    self.line.append(" ")
                self.gap = False
                self.line.append(part)

    def kept(self, text: str) -> None:
        """Text whose white space is kept."""
        first, *more = text.split("\n")
        self.line.append(first)
        for line in more:
            self.end(True)
            self.line.append(line)

    def end(self, always: bool = False) -> None:
        if self.line or always:
            self.add(["".join(self.line)])
        self.line, self.gap = [], False

    def add(self, lines: list[str]) -> None:
        if lines:
            if self.blank and self.done:
                self.done.append("")
            self.blank = False
            self.done += lines

    def block(self, lines: list[str], spaced: bool) -> None:
        self.end()
        if spaced:
            self.blank = bool(self.done)
        self.add(lines)
        if spaced:
            self.blank = bool(self.done)


def _declared(parts: list[str]) -> dict[str, tuple[bool, str]]:
    """`display` and `visibility` of declarations, each with whether it is important."""
    found = {}
    for part in parts:
        if m := _SET.match(part):
            name, important = m[1].lower(), bool(m[3])
            if important or not found.get(name, (False,))[0]:
                found[name] = important, m[2].lower()
    return found


def _read(prelude: str) -> bool:
    """Whether a screen surely reads the block of an @-rule."""
    name, _, rest = re.sub(r"\s+", " ", prelude.strip().lower().replace("(", " (", 1)).partition(" ")
    if name == "@media":
        return any(_matches(q.strip()) for q in rest.split(","))
    return name == "@layer" or name == "@supports" and "not" not in rest


def _matches(query: str) -> bool:
    if query in ("", "not print", "not speech"):
        return True
    for part in re.split(r"\s+and\s+", query):
        if m := _WIDTH.fullmatch(part):
            pixels = float("0" + m[2].rstrip(".")) * (1 if m[3] == "px" else 16) if m[2].count(".") < 2 else -1
            if pixels < 0 or (pixels > VIEWPORT if m[1] == "min" else pixels < VIEWPORT):
                return False
        elif part not in ("all", "screen", "only screen", "only all"):
            return False
    return True


def _chain(selector: str) -> list | None:
    """A selector's compounds (tag, classes, ids, attributes, whether the next is its child); none if it has others."""
    chain = []
    parts = re.findall(r"\[[^\]]*\]|[>+~]|\s+|[^\s>+~\[]+", re.sub(r"\s*([>+~])\s*", r"\1", selector))
    compounds, child = [""], [False]
    for part in parts:
        if part in ("+", "~"):
            return None
        if part == ">" or part.isspace():
            child[-1] = part == ">"
            compounds.append("")
            child.append(False)
        else:
            compounds[-1] += part
    for text, parent in zip(compounds, child):
        m = _COMPOUND.fullmatch(text)
        if not m or not text:
            return None
        own = _PART.findall(m[2])
        chain.append(((m[1] or "*").lower(), frozenset(v for k, v, *_ in own if k == "."),
                      frozenset(v for k, v, *_ in own if k == "#"),
                      frozenset((a.lower(), v if e else None) for k, _, a, e, v in own if not k), parent))
    return chain


def _fits(compound: tuple, tag: str, attrs: dict[str, str]) -> bool:
    of, classes, ids, others, _ = compound
    return (of in ("*", tag) and (not classes or classes <= set(attrs.get("class", "").split()))
            and (not ids or ids == {attrs.get("id", "")})
            and all(a in attrs and (v is None or attrs[a] == v) for a, v in others))


def _applies(chain: list, node: Node, above: tuple | None) -> bool:
    """Whether a selector is one of an element, given what holds it as (tag, attributes, what holds that)."""
    if not _fits(chain[-1], node.tag, node.attrs):
        return False
    if len(chain) == 1:
        return True
    holding = []
    while above:
        holding.append(above[:2])
        above = above[2]
    ever, last = [False] * len(chain), [False] * len(chain)  # compounds up to one end in any holder, in the last
    for tag, attrs in reversed(holding):
        last = [(i == 0 or (last if chain[i - 1][4] else ever)[i - 1]) and _fits(c, tag, attrs)
                for i, c in enumerate(chain[:-1])]
        ever = [a or b for a, b in zip(ever, last)]
    return (last if chain[-2][4] else ever)[len(chain) - 2]


def weighed(rules: list[Rule]) -> dict[str, tuple]:
    """What some rules set `display` and `visibility` to, with the weight of the rule that does."""
    best = {}
    for chain, nth, declared in rules:
        weight = (False, sum(len(c[2]) for c in chain), sum(len(c[1]) + len(c[3]) for c in chain),
                  sum(c[0] != "*" for c in chain), nth)
        for name, (important, value) in declared.items():
            best[name] = max(best.get(name, ((False,), "")), ((important, *weight), value))
    return best


def cascaded(best: dict[str, tuple], node: Node) -> dict[str, str]:
    """What is set once an element's own style is weighed too."""
    if style := node.attrs.get("style"):
        best = dict(best)
        for name, (important, value) in _declared(style.split(";")).items():
            best[name] = max(best.get(name, ((False,), "")), ((important, True), value))
    return {name: value for name, (_, value) in best.items()}


def styles(tree: Tree) -> dict[int, dict[str, str]]:
    """Of each element, by its identity, what is set; none without rules.

    Elements that look alike to the rules, in their tags and in the classes, ids and attributes that rules name, and
    whose holders do, are styled alike, so rules are held against them once.
    """
    if not tree.rules:
        return {}
    by = {}  # rules by an id, class or tag of what they are for
    for rule in tree.rules:
        tag, classes, ids, _, _ = rule[0][-1]
        by.setdefault(("#", min(ids)) if ids else (".", min(classes)) if classes else ("", tag), []).append(rule)
    compounds = [c for rule in tree.rules for c in rule[0]]
    named_classes, named_ids = ({n for c in compounds for n in c[i]} for i in (1, 2))
    named = sorted({a for c in compounds for a, _ in c[3]})
    # The root stands for the body, which the html element holds.
    alike, found, open_ = {}, {}, [(tree.root, ("html", tree.root.attrs, None), None)]
    while open_:
        node, above, held = open_.pop()
        a = node.attrs
        look = Node("body", a) if node is tree.root else node
        classes = a.get("class", "").split()
        looks = (look.tag, frozenset(named_classes.intersection(classes)), a.get("id") if a.get("id") in named_ids else None,
                 tuple((n, a[n]) for n in named if n in a), held)
        if looks not in alike:
            keys = [("", "*"), ("", look.tag), ("#", a.get("id")), *((".", c) for c in set(classes))]
            rules = [r for k in keys for r in by.get(k, ()) if _applies(r[0], look, above)]
            alike[looks] = len(alike), weighed(rules)
        number, best = alike[looks]
        found[id(node)] = cascaded(best, node)
        own = (look.tag, a, above)
        open_ += [(c, own, number) for c in node.children if isinstance(c, Node)]
    return found


class Renderer:
    def __init__(self, tree: Tree):
        self.styles = styles(tree)
        hidden = self._hidden(tree.root) or self._hidden(tree.outer)
        self.lines = [] if hidden else self._block(tree.root, True, False)

    def _hidden(self, node: Node) -> bool:
        """Whether an element and all it holds is not shown."""
        a = node.attrs
        if node.tag in UNSEEN or node.tag == "input" and a.get("type", "").lower() == "hidden":
            return True
        if display := self._style(node).get("display"):
            return display == "none"
        return "hidden" in a or node.tag == "dialog" and "open" not in a

    def _seen(self, node: Node, seen: bool) -> bool:
        visibility = self._style(node).get("visibility", "inherit")
        return visibility not in ("hidden", "collapse") if visibility in SEEN else seen

    def _style(self, node: Node) -> dict[str, str]:
        found = self.styles.get(id(node))
        return cascaded({}, node) if found is None else found

    def _block(self, node: Node, seen: bool, kept: bool) -> list[str]:
        lines = Lines()
        self._flow(node, lines, self._seen(node, seen), kept)
        lines.end()
        return lines.done

    def _children(self, node: Node) -> list:
        if node.tag == "details" and "open" not in node.attrs:
            first = next((c for c in node.children if isinstance(c, Node) and c.tag == "summary"), None)
            return [first] if first else []
        if node.tag == "select":
            options = [o for c in node.children if isinstance(c, Node)
                       for o in ([c] if c.tag == "option" else c.children) if isinstance(o, Node)]
            chosen = [o for o in options if "selected" in o.attrs] or options[:1]
            return chosen if "multiple" not in node.attrs else options
        return node.children

    def _flow(self, node: Node, lines: Lines, seen: bool, kept: bool) -> None:
        for child in self._children(node):
            if isinstance(child, str):
                if seen:
                    lines.kept(child) if kept else lines.text(child)
                continue
            if self._hidden(child):
                continue
            own = self._seen(child, seen)
            tag = child.tag
            if tag == "br":
                if own:
                    lines.end(True)
            elif tag in LISTS:
                lines.block(self._list(child, own, kept), node.tag != "li")
            elif tag == "table":
                lines.block(self._table(child, own), True)
            elif tag in ("dd", "blockquote"):
                lines.block([f"  {x}" if x else x for x in self._block(child, seen, kept)], tag == "blockquote")
            elif tag in ("pre", "xmp"):
                inner = self._block(child, seen, True)
                lines.block(inner[1:] if inner and not inner[0] else inner, True)
            elif tag == "hr":
                lines.block(["---"] if own else [], True)
            elif tag in BLOCKS:
                lines.block(self._block(child, seen, kept), tag in SPACED)
            elif tag == "textarea":
                lines.block(self._block(child, seen, True), False)
            elif tag == "img":
                if own and child.attrs.get("alt"):
                    lines.text(child.attrs["alt"])
            elif tag == "input":
                if own and child.attrs.get("type", "").lower() in ("submit", "reset", "button"):
                    lines.text(child.attrs.get("value", ""))
            else:
                self._flow(child, lines, own, kept)

    def _list(self, node: Node, seen: bool, kept: bool) -> list[str]:
        lines = Lines()
        number = _number(node.attrs.get("start"), 1)
        step = -1 if "reversed" in node.attrs else 1
        if step < 0 and "start" not in node.attrs:
            number = sum(isinstance(c, Node) and c.tag == "li" for c in node.children)
        loose = Node("li", {})
        for child in node.children:
            if not (isinstance(child, Node) and (child.tag == "li" or self._hidden(child))):
                loose.children = [child]
                lines.block([f"  {x}" for x in self._block(loose, seen, kept)], False)
                continue
            if child.tag != "li" or self._hidden(child):
                continue
            number = _number(child.attrs.get("value"), number)
            mark = f"{number}. " if node.tag == "ol" else "- "
            number += step
            inner = self._block(child, seen, kept)
            if inner:
                lines.block([(mark if i == 0 else " " * len(mark)) + x if x or i == 0 else x
                             for i, x in enumerate(inner)], False)
        lines.end()
        return lines.done

    def _rows(self, node: Node) -> tuple[list[Node], list[Node]]:
        """Captions and rows: heads first, feet last."""
        captions, heads, bodies, feet = [], [], [], []
        for child in node.children:
            if not isinstance(child, Node) or self._hidden(child):
                continue
            if child.tag == "caption":
                captions.append(child)
            elif child.tag == "tr":
                bodies.append(child)
            elif child.tag in SECTIONS:
                into = {"thead": heads, "tfoot": feet}.get(child.tag, bodies)
                into += [r for r in child.children if isinstance(r, Node) and r.tag == "tr" and not self._hidden(r)]
        return captions, heads + bodies + feet

    def _table(self, node: Node, seen: bool) -> list[str]:
        captions, rows = self._rows(node)
        lines = [x for c in captions for x in self._block(c, seen, False)]
        grid: list[dict[int, tuple[list[str], int]]] = []
        taken: dict[int, int] = {}  # column to rows that a cell above still covers
        for row in rows:
            cells, column = {}, 0
            own = self._seen(row, seen)
            covered, taken = taken, {c: n - 1 for c, n in taken.items() if n > 1}
            for cell in row.children:
                if not isinstance(cell, Node) or cell.tag not in ("td", "th") or self._hidden(cell):
                    continue
                while column in covered:
                    column += 1
                span = min(max(_number(cell.attrs.get("colspan"), 1), 1), 1000)
                down = min(max(_number(cell.attrs.get("rowspan"), 1), 1), len(rows))
                cells[column] = (self._block(cell, own, False), span)
                if down > 1:
                    taken.update((c, down - 1) for c in range(column, column + span))
                column += span
            grid.append(cells)
        widths: dict[int, int] = {}
        for cells in grid:
            for column, (text, span) in cells.items():
                if span == 1:
                    widths[column] = max(widths.get(column, 0), max(map(width, text), default=0))
        columns = sorted({c for cells in grid for c in cells})
        for cells in grid:  # a cell that spans widens its last column
            for column, (text, span) in cells.items():
                if span > 1:
                    inner = [c for c in columns if column <= c < column + span]
                    missing = max(map(width, text), default=0) - sum(widths.get(c, 0) for c in inner) - 2 * (len(inner) - 1)
                    if missing > 0:
                        widths[inner[-1]] = widths.get(inner[-1], 0) + missing
        shown = [c for c in columns if widths.get(c)]
        for cells in grid:
            for i in range(max((len(text) for text, _ in cells.values()), default=0)):
                line, at, pad = [], 0, 0
                for column in shown:
                    text = cells[column][0] if column in cells else []
                    part = text[i] if i < len(text) else ""
                    if part:
                        line.append(" " * (at - pad) + part)
                        pad = at + width(part)
                    at += widths[column] + 2
                lines.append("".join(line))
        return lines


def _number(text: str | None, default: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(m[1]) if m else default


def rendered(page: str | None) -> str:
    """The visible text of a page; blank lines part spaced blocks, none lead or trail."""
    lines = [x.replace("\xa0", " ").rstrip() for x in Renderer(Tree(page or "")).lines]
    out: list[str] = []
    for line in lines:
        if line or (out and out[-1]):
            out.append(line)
    while out and not out[-1]:
        out.pop()
    return "\n".join(out)


def texts(df: DataFrame, column: str = "html", keep=None) -> DataFrame:
    """The rows with `text`, the visible text of a page; null pages have the empty text, every row is kept,
    and a column of that name gives way."""
    def work(pages: pa.Array) -> dict:
        return {"text": pa.array([rendered(p) for p in pages.to_pylist()], pa.string())}

    return extended(df, column, [T.StructField("text", T.StringType())], work, keep)


def pages(df: DataFrame) -> DataFrame:
    """Per page its id, address and visible text."""
    return texts(df, keep=["page_id", "url"])
