"""Elements of one HTML page, for use inside tasks."""

from __future__ import annotations

import re
from html.parser import HTMLParser
from itertools import accumulate
from typing import NamedTuple

# Fixed values.
VOID_TAGS = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
HIDDEN_TAGS = frozenset("script style template".split())
PARAGRAPH_ENDERS = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr "
    "li main nav ol p pre section table ul".split()
)
LIST_TAGS = frozenset("ol ul menu".split())
CONTEXT_TAGS = frozenset("article section main".split())
CONTEXT_CLASSES = frozenset("content main article".split())
TEXT_NODES = "#text"
# Selector syntax.
NAME = re.compile(r"[\w-]+")
ATTRIBUTE = re.compile(
    r"""\[\s*([\w:-]+)\s*(?:([~|^$*]?=)\s*("[^"]*"|'[^']*'|[^\s"'\]]+)\s*([iI])?\s*)?\]"""
)
COMBINATOR = re.compile(r"\s*([>+~])\s*|(\s+)")
NTH = re.compile(r"(?:([+-]?\d*)n\s*(?:([+-])\s*(\d+))?|([+-]?\d+))$")
PLAIN_PSEUDOS = {
    "first-child": ("nth-child", (0, 1)),
    "last-child": ("nth-last-child", (0, 1)),
    "first-of-type": ("nth-of-type", (0, 1)),
    "last-of-type": ("nth-last-of-type", (0, 1)),
    "only-child": ("only-child", None),
    "only-of-type": ("only-of-type", None),
    "empty": ("empty", None),
    "root": ("root", None),
}
NTH_PSEUDOS = ("nth-child", "nth-last-child", "nth-of-type", "nth-last-of-type")
LIST_PSEUDOS = ("not", "is", "where")


class Element(NamedTuple):
    selector: str
    pos: int
    tag: str
    href: str | None
    text: str
    context: str | None
    parent_length: int


class Compound(NamedTuple):
    """One step of a selector: what an element must have, and how it stands to the step before."""

    tag: str | None
    classes: frozenset
    ids: frozenset
    attributes: tuple
    pseudos: tuple
    link: str


def parse_selector(selector: str) -> list[list[Compound]]:
    """The alternatives of a selector, each as its steps.

    Tags, classes, ids, attributes with all operators, ``:nth-child`` and its
    relatives, ``:empty``, ``:root``, ``:not`` and ``:is``; blanks, ``>``, ``+``
    and ``~`` between steps; commas between alternatives.  Anything else raises
    ``ValueError``, so that no selector silently finds nothing.
    """
    found, at = _parse_list(selector, 0, "")
    if at != len(selector):
        raise _unsupported(selector)
    return found


def _unsupported(selector: str) -> ValueError:
    return ValueError(f"unsupported selector: {selector!r}")


def _parse_list(text: str, at: int, end: str) -> tuple[list[list[Compound]], int]:
    """Alternatives up to ``end`` (a closing bracket, or the end of the text)."""
    found = []
    while True:
        steps, link = [], ""
        while at < len(text) and text[at].isspace():
            at += 1
        while True:
            step, at = _parse_compound(text, at, link)
            steps.append(step)
            gap = COMBINATOR.match(text, at)
            after = gap.end() if gap else at
            if after == len(text) or text[after] in ",)":
                if gap and gap[1]:
                    raise _unsupported(text)
                at = after
                break
            if not gap:
                raise _unsupported(text)
            link, at = gap[1] or " ", after
        found.append(steps)
        if at < len(text) and text[at] == ",":
            at += 1
            continue
        if text[at : at + 1] != end:
            raise _unsupported(text)
        return found, at


def _parse_compound(text: str, at: int, link: str) -> tuple[Compound, int]:
    start, tag = at, None
    classes, ids, attributes, pseudos = set(), set(), [], []
    if text[at : at + 1] == "*":
        at += 1
    elif at < len(text) and text[at].isalpha():
        hit = NAME.match(text, at)
        tag, at = hit[0].lower(), hit.end()
    while at < len(text) and text[at] in ".#[:":
        if text[at] == "[":
            hit = ATTRIBUTE.match(text, at)
            if not hit:
                raise _unsupported(text)
            name, operator, value, fold = hit.groups()
            value = value[1:-1] if value and value[0] in "\"'" else value
            attributes.append((name.lower(), operator, value, bool(fold)))
            at = hit.end()
            continue
        kind, hit = text[at], NAME.match(text, at + 1)
        if not hit:
            raise _unsupported(text)
        at = hit.end()
        if kind != ":":
            (classes if kind == "." else ids).add(hit[0])
            continue
        name = hit[0].lower()
        if text[at : at + 1] != "(":
            if name not in PLAIN_PSEUDOS:
                raise _unsupported(text)
            pseudos.append(PLAIN_PSEUDOS[name])
        elif name in NTH_PSEUDOS:
            close = text.find(")", at)
            pseudos.append((name, _parse_nth(text[at + 1 : max(close, at)], text)))
            at = close + 1
        elif name in LIST_PSEUDOS:
            inner, at = _parse_list(text, at + 1, ")")
            pseudos.append((name, inner))
            at += 1
        else:
            raise _unsupported(text)
    if at == start:
        raise _unsupported(text)
    return Compound(tag, frozenset(classes), frozenset(ids), tuple(attributes), tuple(pseudos), link), at


def _parse_nth(argument: str, text: str) -> tuple[int, int]:
    """(step, offset) of ``an+b``."""
    argument = argument.strip().lower()
    if argument in ("odd", "even"):
        return 2, int(argument == "odd")
    hit = NTH.match(argument)
    if not hit:
        raise _unsupported(text)
    step, sign, offset, number = hit.groups()
    if number is not None:
        return 0, int(number)
    return int(step + "1" if step in ("", "+", "-") else step), int((sign or "") + (offset or "0"))


def _nth_fits(number: int, nth: tuple[int, int]) -> bool:
    step, offset = nth
    return number == offset if step == 0 else (number - offset) % step == 0 and (number - offset) // step >= 0


def _attribute_fits(node, name, operator, value, fold) -> bool:
    if name not in node.attributes:
        return False
    if operator is None:
        return True
    own = node.attributes[name] or ""
    if fold:
        own, value = own.lower(), value.lower()
    if operator == "=":
        return own == value
    if operator == "|=":
        return own == value or own.startswith(value + "-")
    if operator == "~=":
        return value in own.split()
    return bool(value) and {"^=": own.startswith, "$=": own.endswith, "*=": own.__contains__}[operator](value)


def _pseudo_fits(node, name, argument) -> bool:
    if name == "not":
        return not any(_selected(node, steps) for steps in argument)
    if name in LIST_PSEUDOS:
        return any(_selected(node, steps) for steps in argument)
    if name == "empty":
        return not node.children and node.start == node.end
    if name == "root":
        return node.parent is None
    if name == "only-child":
        return len(node.siblings) == 1
    if name == "only-of-type":
        return sum(s.tag == node.tag for s in node.siblings) == 1
    before = node.siblings[: node.index] if "last" not in name else node.siblings[node.index + 1 :]
    number = 1 + (sum(s.tag == node.tag for s in before) if name.endswith("type") else len(before))
    return _nth_fits(number, argument)


def _fits(node, step):
    return (
        (step.tag is None or node.tag == step.tag)
        and step.classes <= node.classes
        and (not step.ids or step.ids == {node.attributes.get("id")})
        and all(_attribute_fits(node, *a) for a in step.attributes)
        and all(_pseudo_fits(node, *p) for p in step.pseudos)
    )


def _selected(node, steps):
    """Whether the node matches the last step, and what stands before or above it the steps before."""
    if not _fits(node, steps[-1]):
        return False
    if len(steps) == 1:
        return True
    link = steps[-1].link
    if link == ">":
        others = (node.parent,)
    elif link == " ":
        others = _ancestors(node)
    else:
        first = 0 if link == "~" else max(0, node.index - 1)
        others = node.siblings[first : node.index]
    return any(a is not None and _selected(a, steps[:-1]) for a in others)


class _Node:
    __slots__ = ("tag", "classes", "attributes", "parent", "start", "end", "children", "siblings", "index")

    def __init__(self, tag, attributes, parent, start, siblings):
        self.tag = tag
        self.classes = frozenset((attributes.get("class") or "").split())
        self.attributes = attributes
        self.parent = parent
        self.start = start
        self.end = None
        self.children = []
        # Elements only; the node itself is the one at its index.
        self.siblings, self.index = siblings, len(siblings)
        siblings.append(self)


class _Tree(HTMLParser):
    """Nodes in document order, each covering a range of stripped text pieces."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.nodes, self.open, self.pieces, self.buffer, self.roots = [], [], [], [], []

    def _flush(self):
        piece = "".join(self.buffer).strip()
        self.buffer.clear()
        if piece and not any(n.tag in HIDDEN_TAGS for n in self.open):
            self.pieces.append(piece)

    def _close_to(self, depth):
        for node in self.open[depth:]:
            node.end = len(self.pieces)
        del self.open[depth:]

    def _close_nearest(self, tag, barrier=frozenset()):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth].tag == tag:
                return self._close_to(depth)
            if self.open[depth].tag in barrier:
                return None
        return None

    def handle_starttag(self, tag, attrs):
        self._flush()
        if tag in PARAGRAPH_ENDERS:
            self._close_nearest("p", frozenset(("table", "td", "th", "button")))
        if tag == "li":
            self._close_nearest("li", LIST_TAGS)
        parent = self.open[-1] if self.open else None
        siblings = parent.children if parent else self.roots
        node = _Node(tag, dict(attrs), parent, len(self.pieces), siblings)
        self.nodes.append(node)
        if tag in VOID_TAGS:
            node.end = node.start
        else:
            self.open.append(node)

    def handle_endtag(self, tag):
        self._flush()
        self._close_nearest(tag)

    def handle_data(self, data):
        self.buffer.append(data)

    def handle_comment(self, data):
        self._flush()

    def finish(self):
        self.close()
        self._flush()
        self._close_to(0)


def page_elements(
    html: str, selectors: list[str], context_below: int | None, with_empty: bool = False, wanted_text=None
) -> list[Element]:
    """Elements with text (``with_empty``: any) that match a selector, and text nodes for ``#text``.

    Only elements whose text passes ``wanted_text`` are built.

    ``context`` is the text of the nearest article, section or main, else of a
    content div, else of the parent: the first that is longer than the element
    and shorter than the bound.
    """
    tree = _Tree()
    tree.feed(html)
    tree.finish()
    sizes = [0, *accumulate(len(p) for p in tree.pieces)]
    wanted = [(s, parse_selector(s)) for s in selectors if s != TEXT_NODES]

    def size(node):
        return sizes[node.end] - sizes[node.start]

    def content(node):
        return "".join(tree.pieces[node.start : node.end])

    def context(node):
        near = lambda test: next((a for a in _ancestors(node) if test(a)), None)
        candidates = (
            near(lambda a: a.tag in CONTEXT_TAGS),
            near(lambda a: a.tag == "div" and a.classes & CONTEXT_CLASSES),
            node.parent,
        )
        for found in candidates:
            fits = found and size(found) > size(node)
            if fits and (context_below is None or size(found) < context_below):
                return content(found)
        return None

    out = []
    for pos, node in enumerate(tree.nodes):
        hits = [s for s, ways in wanted if any(_selected(node, steps) for steps in ways)]
        if hits and (with_empty or size(node)):
            text = content(node)
            if wanted_text is None or wanted_text(text):
                shared = (text, context(node), size(node.parent) if node.parent else 0)
                out += [Element(s, pos, node.tag, node.attributes.get("href"), *shared) for s in hits]
    if TEXT_NODES in selectors:
        out += [
            Element(TEXT_NODES, i, TEXT_NODES, None, piece, None, 0)
            for i, piece in enumerate(tree.pieces)
            if wanted_text is None or wanted_text(piece)
        ]
    # Nodes that point at each other would stay until the collector happens to run.
    for node in tree.nodes:
        node.parent = node.siblings = None
    return out


def _ancestors(node):
    while node.parent is not None:
        node = node.parent
        yield node
