"""A forgiving reader of web pages: one node per element, with the text that lies directly in it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)",
    re.S,
)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
SPACE = re.compile(r"[ \t\n\r\f]+")

# Element names of the language.  Fixed values.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math select option button".split())
#: Elements whose raw text never nests: read up to their own end tag.
OPAQUE = frozenset("script style textarea title".split())
HIDDEN = RAW | frozenset("head meta link base object embed canvas audio video map".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr br img".split()
)
#: A new paragraph or block ends an open paragraph; a new item ends an open one of its kind.
ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr"
    " main menu nav ol p pre section table ul".split()
)
SIBLINGS = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "p": ("p",),
}
BARRIERS = frozenset("ul ol dl table tbody thead tfoot tr".split())


@dataclass
class Node:
    """An element: its words of class, id and role, its place in the tree, and its own text by block order."""

    tag: str
    parent: int
    depth: int
    tokens: tuple[str, ...]
    children: list[int] = field(default_factory=list)


@dataclass
class Page:
    nodes: list[Node]
    #: (node, text) per run of text between block boundaries, in page order; references decoded, space collapsed.
    blocks: list[tuple[int, str]]


def attribute_words(raw: str) -> tuple[str, ...]:
    words = []
    for name, value in ATTRIBUTE.findall(raw):
        name = name.lower()
        if name in ("class", "id", "role", "aria-label", "itemprop"):
            words += re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())
        elif name in ("hidden", "aria-hidden"):
            words.append(name)
    return tuple(words)


def read_page(source: str) -> Page:
    """Elements and text blocks of a page.

    A block is what lies between starts and ends of block elements.  Its text belongs to the innermost
    block element around it; text inside hidden elements is left out.
    """
    nodes, blocks = [Node("#root", -1, 0, ())], []
    stack, hidden, pending = [0], 0, []
    at, end = 0, len(source)

    def holder() -> int:
        return next(n for n in reversed(stack) if nodes[n].tag not in INLINE)

    def flush() -> None:
        if pending:
            text = SPACE.sub(" ", html.unescape("".join(pending))).strip(" ")
            text = " ".join(text.split())
            if text:
                blocks.append((holder(), text))
            pending.clear()

    def close_to(depth: int) -> None:
        nonlocal hidden
        while len(stack) > depth:
            node = nodes[stack[-1]]
            if node.tag not in INLINE:
                flush()
            hidden -= node.tag in HIDDEN
            stack.pop()

    while at < end:
        found = TOKEN.search(source, at)
        if found is None:
            if not hidden:
                pending.append(source[at:])
            break
        if found.start() > at and not hidden:
            pending.append(source[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        if found[1]:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == name:
                    close_to(k)
                    break
                if name in INLINE and nodes[stack[k]].tag not in INLINE:
                    break
            continue
        raw = found[3]
        if name == "br":
            if not hidden:
                pending.append(" ")
            continue
        if name in ENDS_PARAGRAPH:
            for k in range(len(stack) - 1, 0, -1):
                if nodes[stack[k]].tag == "p":
                    close_to(k)
                    break
                if nodes[stack[k]].tag not in INLINE:
                    break
        if name in SIBLINGS and name != "p":
            for k in range(len(stack) - 1, 0, -1):
                tag = nodes[stack[k]].tag
                if tag in SIBLINGS[name]:
                    close_to(k)
                    break
                if tag in BARRIERS:
                    break
        if name not in INLINE:
            flush()
        if name in VOID:
            continue
        if name in OPAQUE:
            close = re.compile(rf"</{name}[\s/>]", re.I).search(source, at)
            at = source.find(">", close.start()) + 1 or end if close else end
            continue
        node = Node(name, stack[-1], len(stack), attribute_words(raw) if raw else ())
        nodes[stack[-1]].children.append(len(nodes))
        stack.append(len(nodes))
        nodes.append(node)
        if raw.rstrip().endswith("/") and name not in INLINE and name in ("svg", "math"):
            close_to(len(stack) - 1)
            continue
        hidden += name in HIDDEN
    close_to(1)
    flush()
    return Page(nodes, blocks)
