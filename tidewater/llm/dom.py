"""Pages as trees of block elements with the texts between them, and what marks parts of them as furniture.

A tree has all of a page's text, furniture too; its texts have flags, which :mod:`tidewater.llm.wrapper` weighs: marked
(by an element, a class, an id or a role), linked (mostly within links) and inner (within an article or main element).
Only what is never shown as text of the page is left out: heads, scripts, styles, option lists and embedded objects.

Elements nested deeper than ``DEPTH`` are children of the one at that depth, so that trees are bounded in depth; their texts
are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from html import unescape

from xxhash import xxh3_64_intdigest

DEPTH = 128
MARKED, LINKED, INNER = 1, 2, 4
FLOW, TITLE = 1, 2
TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>""",
    re.S,
)
ATTRIBUTE = re.compile(r"""(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
TOKENS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
NAMES = re.compile(r"[A-Za-z_-]+")

# HTML elements by kind.
BLOCKS = frozenset("html body article section main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table caption thead tbody tfoot tr td th blockquote pre hr figure figcaption address header footer nav aside form fieldset details summary center".split())
HIDDEN = frozenset("head select option datalist noscript template iframe object svg canvas audio video map".split())
FURNISHING = frozenset("nav footer aside form button dialog menu".split())
RAW = frozenset("script style title textarea xmp".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CONTENT = frozenset("article main".split())
PIECES = HEADINGS | frozenset("# text p ul ol li dl dt dd caption thead tbody tfoot tr td th pre hr figcaption address".split())
#: Words in a class or id, and roles, that mark furniture anywhere.
FURNITURE = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs masthead footer sidebar aside ad ads advert adverts advertisement banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices notification popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended comment comments respond replies disqus pagination pager widget toolbar copyright".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
#: What a start tag closes, up to the elements in the second set.
CLOSES = {"li": (frozenset(["li"]), frozenset(["ul", "ol"])), "dt": (frozenset(["dt", "dd"]), frozenset(["dl"])), "dd": (frozenset(["dt", "dd"]), frozenset(["dl"])), "tr": (frozenset(["tr", "td", "th"]), frozenset(["table"])), "td": (frozenset(["td", "th"]), frozenset(["tr", "table"])), "th": (frozenset(["td", "th"]), frozenset(["tr", "table"]))}


class Node:
    """A block element, or a leaf with a text: ``leaf`` is its number among the page's texts, -1 for elements."""

    __slots__ = ("label", "kids", "leaf")

    def __init__(self, label: str, leaf: int = -1):
        self.label, self.kids, self.leaf = label, [], leaf


class Open:
    """An element that isn't closed yet."""

    __slots__ = ("tag", "node", "depth", "hidden", "marked", "inside", "aside")

    def __init__(self, tag: str, node: Node, depth: int, hidden: bool, marked: bool, inside: bool, aside: bool = False):
        self.tag, self.node, self.depth, self.hidden, self.marked, self.inside = tag, node, depth, hidden, marked, inside
        self.aside = aside  # furniture within a line of text, with a buffer of its own


def furniture(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element's attributes mark it as furniture; ``inside``: of an article or main element.

    Articles carry their site's states in their classes ("comments-open"), so that only whole names mark them.
    """
    for name, value in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), value.strip("\"'")
        if name == "hidden":
            return True
        if name == "aria-hidden":
            if value == "true":
                return True
        elif name == "style":
            if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                return True
        elif name == "role":
            if value.lower() in ROLES:
                return True
        elif tag in CONTENT:
            if not FURNITURE.isdisjoint(value.lower().split()):
                return True
        elif tag not in {"html", "body"}:
            words = {w.lower() for w in TOKENS.findall(value)}
            if words & FURNITURE or not inside and "header" in words:
                return True
    return False


@lru_cache(1 << 14)
def label_of(tag: str, attributes: str) -> str:
    """The element and its classes, without numbers: what has to agree for two nodes to be matched."""
    if not attributes:
        return tag
    names = [n for name, value in ATTRIBUTE.findall(attributes) if name.lower() == "class" for n in NAMES.findall(value)]
    return ".".join([tag, *sorted(set(names))])


class Parser:
    def __init__(self):
        self.root = Node("#")
        self.stack = [Open("#", self.root, 0, False, False, False)]
        self.open: Counter[str] = Counter()
        self.texts: list[str] = []
        self.flags: list[int] = []
        self.buffers: list[list[str]] = [[]]
        self.linked, self.chars = 0, 0
        self.link_at = 0  # how deep the stack is where the open link began; 0: none

    def say(self, part: str) -> None:
        if part and not self.stack[-1].hidden:
            part = unescape(part) if "&" in part else part
            self.buffers[-1].append(part)
            n = len(part) - part.count(" ")
            self.chars += n
            if self.link_at:
                self.linked += n

    def leaf(self, buffer: list[str], top: Open) -> None:
        """A text of the block that ``top`` is in."""
        text = " ".join("".join(buffer).replace("\x00", "\ufffd").split())
        buffer.clear()
        if text:
            top.node.kids.append(Node("text", len(self.texts)))
            self.texts.append(text)
            self.flags.append((MARKED if top.marked else 0) | (LINKED if 2 * self.linked >= self.chars else 0) | (INNER if top.inside else 0))

    def flush(self) -> None:
        if self.buffers[-1]:
            self.leaf(self.buffers[-1], self.stack[-1])
        self.linked = self.chars = 0

    def pop(self) -> None:
        top = self.stack[-1]
        if top.tag in BLOCKS:
            self.flush()
        elif top.aside:
            kept = self.linked, self.chars
            self.leaf(self.buffers.pop(), top)
            self.linked, self.chars = kept
        self.stack.pop()
        self.open[top.tag] -= 1
        if len(self.stack) < self.link_at:
            self.link_at = 0

    def upto(self, tag: str) -> None:
        """Closes the innermost ``tag`` and all that is open in it."""
        while True:
            last = self.stack[-1].tag == tag
            self.pop()
            if last:
                return

    def start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCKS
        if block:
            self.flush()
            if self.stack[-1].tag == "p":
                self.pop()
            elif tag in CLOSES:
                shut, limit = CLOSES[tag]
                for depth in range(len(self.stack) - 1, 0, -1):
                    if self.stack[depth].tag in limit:
                        break
                    if self.stack[depth].tag in shut:
                        while len(self.stack) > depth:
                            self.pop()
                        if tag != "tr":
                            break
        top = self.stack[-1]
        hidden = top.hidden or tag in HIDDEN
        own = tag in FURNISHING or (tag == "header" and not top.inside) or bool(attributes) and furniture(tag, attributes, top.inside)
        # A header inside an article is furniture but for its headings.
        own = own or top.inside and top.tag == "header" and tag not in HEADINGS and tag not in {"div", "header"}
        if not block and not own and hidden == top.hidden or attributes.endswith("/") and not block:
            if tag == "a":
                self.link_at = len(self.stack)
            return
        aside = not block and own and not hidden and not top.marked
        if not block:
            self.say(" ")
        if aside:
            self.buffers.append([])
        node, depth = top.node, top.depth
        if block and depth < DEPTH:
            node, depth = Node(label_of(tag, attributes)), depth + 1
            if not hidden:
                top.node.kids.append(node)
        marked = top.marked or own
        self.stack.append(Open(tag, node, depth, hidden, marked, top.inside or tag in CONTENT and not marked, aside))
        self.open[tag] += 1

    def read(self, html: str) -> None:
        at = 0
        while True:
            m = TAG.search(html, at)
            if m is None:
                self.say(html[at:])
                break
            if m.start() > at:
                self.say(html[at : m.start()])
            at = m.end()
            tag = m[2] or m[5]
            if tag is None:
                continue
            tag, closing, attributes = tag.lower(), m[1] or m[4], m[3] or m[6] or ""
            if closing:
                if tag == "a":
                    self.link_at = 0
                if self.open[tag]:
                    self.upto(tag)
                elif tag == "br":
                    self.say(" ")
            elif tag in RAW:
                if tag in {"textarea", "xmp"}:
                    self.say(" ")
                end = re.compile(rf"</{tag}\s*>?", re.I).search(html, at)
                at = end.end() if end else len(html)
            elif tag == "hr":
                self.flush()
            elif tag in VOID:
                self.say(" ")
            else:
                self.start(tag, attributes)
        while len(self.stack) > 1:
            self.pop()
        self.flush()


def parse(html: str) -> tuple[Node, list[str], list[int]]:
    """The tree of a page's blocks, their texts in page order and the flags of each.

    Character references are decoded, white space is one space.
    """
    p = Parser()
    p.read(html)
    return p.root, p.texts, p.flags


@lru_cache(1 << 14)
def label_hash(label: str) -> int:
    """The label's hash; its last bits say whether the element is a piece of running text, and the main heading."""
    tag = label.partition(".")[0]
    return xxh3_64_intdigest(label.encode("utf-8", "surrogatepass")) >> 4 << 2 | (FLOW if tag in PIECES else 0) | (TITLE if tag == "h1" else 0)


def text_hash(text: str) -> int:
    """Never 0, which stands for a text that varies."""
    return (xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 2) | 1
