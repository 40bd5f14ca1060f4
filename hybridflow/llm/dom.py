"""A forgiving HTML tree of the nodes that carry text, and numbers that describe each node."""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_right

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img br".split()
)
#: Inside these nothing is a tag: they end at the closing tag of their own name. Their content is left out.
RAW = ("script", "style", "iframe", "textarea", "title")
RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*>?", re.I) for name in RAW}
#: Without that closing tag the rest of the page is code, as in browsers; of the others only the tag is left out.
CODE = frozenset(("script", "style"))
FOREIGN = frozenset(
    (
        "math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover "
        "mmultiscripts mprescripts mtable mtr mtd mlabeledtr maction semantics annotation annotation-xml "
        "svg g path circle ellipse rect line polyline polygon text tspan textpath defs use symbol desc marker mask pattern filter stop image "
        "lineargradient radialgradient clippath foreignobject"
    ).split()
)
#: Belong to the text around them, so that a formula stays in its paragraph.
EMBEDDED = FOREIGN | frozenset("object noscript canvas template select option optgroup".split())
APART = frozenset("option optgroup annotation text".split())
#: What the opening of a block closes if it is still open.
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "thead": ("tr", "td", "th"), "tbody": ("thead", "tr", "td", "th"), "tfoot": ("tbody", "tr", "td", "th"),
}
SCOPE = frozenset("html body table ul ol dl div section article main aside nav header footer form td th blockquote".split())

# Tokens of class, id and role that tell what a block is.
FOR = "article content main post entry body text story prose blog news page"
GROUPS = {
    "menu": "nav menu breadcrumb breadcrumbs pagination pager toolbar toc tags navigation",
    "edge": "sidebar aside footer header foot head widget copyright legal disclaimer related recommended masthead contentinfo complementary",
    "ad": "ad ads advert advertisement sponsor sponsored banner promo",
    "notice": "cookie consent notice alert popup modal gdpr dialog",
    "talk": "comment comments reply replies discussion respond disqus",
    "form": "form search login signup subscribe newsletter share social",
    "for": FOR,
}
TOKEN_GROUP = {t: g for g, ts in GROUPS.items() for t in ts.split()}
GROUP_NAMES = tuple(GROUPS)
TAG_GROUPS = {
    "nav": "menu", "header": "edge", "footer": "edge", "aside": "edge", "form": "form", "button": "form", "fieldset": "form", "select": "form",
    "dialog": "notice", "article": "for", "main": "for",
}
TAGS = ("p", "div", "section", "li", "ul", "ol", "td", "h1", "h2", "h3", "blockquote", "pre", "article", "main", "nav", "header", "footer", "aside", "form", "figcaption", "dd", "body", "figure")

OPENING = re.compile(r"<(?:!--|[!?]|(/?)([A-Za-z][^\s/>]*))")
DECLARATION = re.compile(r"<[!?]")
SPECIAL = re.compile("[>\"']")
ATTRIBUTE = re.compile(r"(class|id|role|data-truth|aria-label|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none|aria-hidden\s*=\s*[\"']?true", re.I)
WORDS_IN = re.compile(r"[A-Za-z]+")


class Node:
    """An element that may carry text of its own; inline elements belong to the node around them."""

    __slots__ = ("tag", "parent", "depth", "groups", "above", "truth", "hidden", "children", "chars", "words", "links", "stops", "tags", "order", "index", "block")

    def __init__(self, tag: str, parent: Node | None, attributes: str, order: int, block: bool = True):
        self.tag, self.parent, self.order, self.block = tag, parent, order, block
        self.depth = parent.depth + 1 if parent else 0
        self.groups, self.truth = set(), False
        self.hidden = tag == "template" or bool(attributes) and HIDDEN.search(attributes) is not None
        if attributes:
            for m in ATTRIBUTE.finditer(attributes):
                if m[1].lower() == "data-truth":
                    self.truth = True
                else:
                    for t in WORDS_IN.findall(re.sub(r"([a-z])([A-Z])", r"\1 \2", m[2] or m[3] or m[4] or "")):
                        if (g := TOKEN_GROUP.get(t.lower())) is not None:
                            self.groups.add(g)
        if tag in TAG_GROUPS:
            self.groups.add(TAG_GROUPS[tag])
        self.above = parent.groups | parent.above if parent else set()
        self.children: list[Node] = []
        self.index = len(parent.children) if parent else 0
        if parent:
            parent.children.append(self)
        # Own text first; sums over the subtree once the page has been read.
        self.chars = self.words = self.links = self.stops = self.tags = 0


class _Ends:
    """Where tags end: at the first ``>`` outside quotes, or at the first one if quotes are left open.

    What a quote leads to is kept by its place, so every place is looked at a bounded number of times.
    """

    def __init__(self, page: str):
        self.page = page
        self.ends: dict[int, int] = {}

    def after(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose attributes begin at ``at``; there is a ``>`` after it."""
        first = self.page.find(">", at)
        double, single = self.page.count('"', at, first), self.page.count("'", at, first)
        if not (double or single) or not (double and single) and (double + single) % 2 == 0:
            return first
        end = self._outside_quotes(at)
        return first if end < 0 else end

    def _outside_quotes(self, at: int) -> int:
        page, passed, end = self.page, [], -1
        while (m := SPECIAL.search(page, at)) is not None:
            if m[0] == ">":
                end = m.start()
                break
            if m.start() in self.ends:
                end = self.ends[m.start()]
                break
            passed.append(m.start())
            at = page.find(m[0], m.end()) + 1
            if not at:
                break
        self.ends.update(dict.fromkeys(passed, end))
        return end


class _Open:
    """The elements that are open, innermost last, and where those of a name and the scopes stand among them."""

    def __init__(self, root: Node):
        self.stack: list[tuple[str, Node]] = [("html", root)]
        self.named: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.blocks: list[int] = []

    def push(self, tag: str, node: Node) -> None:
        at = len(self.stack)
        self.stack.append((tag, node))
        self.named.setdefault(tag, []).append(at)
        if tag in SCOPE:
            self.scopes.append(at)
            if tag not in ("td", "th"):
                self.blocks.append(at)

    def close(self, at: int) -> None:
        """Close the element at a place of the stack and all inside it."""
        while len(self.stack) > at:
            tag, _ = self.stack.pop()
            here = len(self.stack)
            self.named[tag].pop()
            for places in (self.scopes, self.blocks):
                if places and places[-1] == here:
                    places.pop()

    def innermost(self, tag: str) -> int:
        """Place of the innermost element of a name, 0 if there is none."""
        places = self.named.get(tag)
        return places[-1] if places else 0

    def outermost_in_block(self, tags: tuple[str, ...]) -> int:
        """Place of the outermost element of these names inside the innermost block, 0 if there is none."""
        block = self.blocks[-1] if self.blocks else 0
        found = 0
        for tag in tags:
            places = self.named.get(tag, [])
            k = bisect_right(places, block)
            if k < len(places) and (not found or places[k] < found):
                found = places[k]
        return found


def parse(page: str) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes in page order, and the texts in page order: (node that it belongs to, text).

    A text of -1 as node parts blocks. Contents of RAW elements are left out. The time grows with the
    page, whatever stands in it: tags without an end, any depth, closing tags without an opening one.
    """
    root = Node("html", None, "", 0)
    nodes, pieces, opened = [root], [], _Open(root)
    stack = opened.stack
    at, link = 0, 0
    endless: set[str] = set()

    def text(value: str) -> None:
        if not value:
            return
        if "&" in value:
            value = entities.unescape(value)
        node = stack[-1][1]
        pieces.append((node.order, value))
        n = len(value) - value.count(" ")
        if n and not value.isspace():
            node.chars += len(value.strip())
            node.words += value.count(" ") + 1
            node.stops += value.count(". ") + value.count(",") + value.count("? ") + value.count("! ") + value.rstrip().endswith((".", "!", "?"))
            if link:
                node.links += len(value.strip())

    ends, last, look = _Ends(page), page.rfind(">"), 0
    while (start := page.find("<", look)) >= 0:
        if start > last:  # no tag ends any more; a comment or declaration takes the rest
            m = DECLARATION.search(page, start)
            if m is not None:
                text(page[at : m.start()])
                at = len(page)
            break
        m = OPENING.match(page, start)
        if m is None:
            look = start + 1
            continue
        if start > at:
            text(page[at:start])
        if m[2] is None:
            mark = "-->" if m[0] == "<!--" else ">"
            end = page.find(mark, m.end())
            look = at = len(page) if end < 0 else end + len(mark)
            continue
        tag, shut = m[2].lower(), m[1] == "/"
        close = ends.after(m.end())
        attributes, at = page[m.end() : close], close + 1
        if tag in RAW_END:
            stack[-1][1].tags += 1
            if not shut and not attributes.endswith("/") and tag not in endless:
                raw = RAW_END[tag].search(page, at)
                if raw is None:
                    endless.add(tag)
                if raw is not None or tag in CODE:
                    at = raw.end() if raw else len(page)
        else:
            link = _tag(tag, shut, attributes, opened, nodes, pieces, link)
        look = at
    if at < len(page):
        text(page[at:])
    return nodes, pieces


def _tag(tag: str, shut: bool, attributes: str, opened: _Open, nodes: list[Node], pieces: list, link: int) -> int:
    """What a tag does to the open elements; gives whether what follows is in a link."""
    stack = opened.stack
    stack[-1][1].tags += 1
    if tag == "br" or tag == "hr":
        pieces.append((stack[-1][1].order, " "))
        return link
    if tag == "head":
        return link
    if tag == "a":
        link = 0 if shut else 1
    if tag in VOID:
        return link
    inline = tag in INLINE or tag in EMBEDDED
    if not inline:
        pieces.append((-1, " "))
    elif tag in APART:
        pieces.append((stack[-1][1].order, " "))
    if shut:
        k = opened.innermost(tag)
        # A closing tag reaches out of a scope only if it is a scope itself, or inline.
        if k and (inline or tag in SCOPE or not opened.scopes or opened.scopes[-1] <= k):
            opened.close(k)
        return link
    if inline:
        if tag in FOREIGN and attributes.endswith("/"):
            return link
        if tag in ("select", "template") or attributes and ("class" in attributes or "id" in attributes or "hidden" in attributes):
            node = Node(tag, stack[-1][1], attributes, len(nodes), block=False)
            if node.hidden or node.groups - {"for"}:
                nodes.append(node)
                opened.push(tag, node)
            else:
                node.parent.children.pop()
        return link
    if any(n == "p" for n, _ in stack[-4:]):
        k = opened.innermost("p")
        if k and (not opened.scopes or opened.scopes[-1] < k):
            opened.close(k)
    if tag in CLOSES and (k := opened.outermost_in_block(CLOSES[tag])):
        opened.close(k)
    if tag in ("html", "body") and (opened.innermost(tag) or tag == "html" and len(stack) == 1):
        return link
    if attributes.endswith("/") and tag not in SCOPE and tag != "p":
        return link
    node = Node(tag, stack[-1][1], attributes, len(nodes))
    nodes.append(node)
    opened.push(tag, node)
    return link


FEATURES = (
    ["depth", "own", "own_words", "own_link", "own_stops", "sub", "sub_words", "sub_link", "sub_stops", "density", "blocks", "share", "place", "index", "siblings", "alike", "near_sub", "near_link", "up_link", "up_stops", "up_sub", "hidden", "block"]
    + [f"tag_{t}" for t in TAGS]
    + [f"has_{g}" for g in GROUP_NAMES]
    + [f"in_{g}" for g in GROUP_NAMES]
)


def describe(nodes: list[Node]) -> list[list[float]]:
    """A row of FEATURES per node."""
    n = len(nodes)
    if not n:
        return []
    own = [(x.chars, x.words, x.links, x.stops) for x in nodes]
    blocks = [1] * n
    truth = [x.truth for x in nodes]
    before, total = [0] * n, 0
    for i, x in enumerate(nodes):
        before[i] = total
        total += own[i][0]
    for i in range(n - 1, 0, -1):
        x, up = nodes[i], nodes[i].parent
        up.chars += x.chars
        up.words += x.words
        up.links += x.links
        up.stops += x.stops
        up.tags += x.tags
        blocks[up.order] += blocks[i]
        truth[up.order] = truth[up.order] or truth[i]
        up.truth = truth[up.order]
    log = _log
    out = []
    for i, x in enumerate(nodes):
        up = x.parent or x
        kin = up.children if x.parent else [x]
        k = min(x.index, len(kin) - 1)
        near = [kin[j] for j in (k - 1, k + 1) if 0 <= j < len(kin)]
        chars, word, links, stops = own[i]
        row = [
            x.depth, log(chars), log(word), links / (chars + 1), 10 * stops / (word + 5), log(x.chars), log(x.words), x.links / (x.chars + 1),
            10 * x.stops / (x.words + 5), log(x.chars / (x.tags + 1)), log(blocks[i]), x.chars / (total + 1), before[i] / (total + 1), min(x.index, 20),
            min(len(kin), 40), min(sum(y.tag == x.tag for y in kin[max(0, k - 10) : k + 11]), 20),
            log(sum(y.chars for y in near)), sum(y.links for y in near) / (1 + sum(y.chars for y in near)),
            up.links / (up.chars + 1), 10 * up.stops / (up.words + 5), log(up.chars), float(x.hidden), float(x.block),
        ]
        row += [float(x.tag == t) for t in TAGS]
        row += [float(g in x.groups) for g in GROUP_NAMES]
        row += [float(g in x.above) for g in GROUP_NAMES]
        out.append(row)
    return out


def _log(x: float) -> float:
    return float(x + 1).__pow__(0.25)


def chosen_text(pieces: list[tuple[int, str]], keep: list[bool]) -> str:
    """Texts of kept nodes; white space is one space, blocks are joined by one."""
    return " ".join("".join(t if k < 0 or keep[k] else "" for k, t in pieces).split())
