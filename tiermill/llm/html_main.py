"""Main text of web pages by scoring the element tree.

A page is cut into tags and texts, and a tree is built with the usual implied ends of elements. Elements that never hold
article text (scripts, forms, navigation, ...) and those whose class, id or role names a page part (advert, sidebar,
reader comments, ...) are taken out. Every paragraph gives points to its ancestors, for being one, for its commas
and for its length: all to the parent, half to the grandparent, less further up; a container's points are
discounted by the share of its text that lies in links. The container with most points is kept, with those siblings
that score well enough themselves or are paragraphs of running text.

A NULL or empty page has an empty text. White space inside a block becomes one space, and blocks are joined by one space
in page order. Pages are independent, so repeated rows give repeated results; other columns stay, and a column
named like the result is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tiermill.llm.workers import ship

# Element names of HTML by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript iframe template xmp noembed noframes".split())
DROPPED = RAW | frozenset(
    "head nav footer aside form button select option datalist svg math canvas object applet audio video dialog menu map".split()
)
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5"
    " h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
PARAGRAPHS = frozenset("p pre td th blockquote li dd figcaption".split())
CLOSED_BY_BLOCK = frozenset(["p"])
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "tfoot": ({"tr", "td", "th", "thead", "tbody"}, {"table"}),
    "option": ({"option"}, {"select"}),
}
# Words in class, id and role that name a part outside the article.
PARTS = re.compile(
    r"(?:^|[\s_-])(?:ads?|adv|adverts?|advertisement|advertorial|sponsor(?:ed)?|promo(?:tion)?s?|banners?|cookies?|consent|gdpr|notices?|"
    r"alerts?|popups?|pop-up|modal|overlay|lightbox|newsletter|subscribe|subscription|signup|sign-up|login|register|paywall|share|"
    r"sharing|social|related|recommend(?:ed|ations?)?|recirc|outbrain|taboola|trending|popular|teasers?|sidebars?|side-bar|side|rail|widgets?|"
    r"menus?|nav|navbar|navigation|breadcrumbs?|crumbs|pagination|pager|paging|toolbar|masthead|site-header|page-header|topbar|"
    r"header|footer|foot|bottom-bar|copyright|legal|disclaimer|skip|comments?|comment-list|respond|replies|reply|discussion|disqus|"
    r"feedback|reviews?|guestbook|forms?|search|searchbox|tags?|taglist|complementary|contentinfo|search-form)(?:$|[\s_\d-])",
    re.I,
)
MAIN = re.compile(r"(?:^|[\s_-])(?:article|main|content|entry|post|story|body|text|hentry|blog|articlebody)(?:$|[\s_-])", re.I)

_TOKENS = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*(?:>|$)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?:>|$)|([^<]+|<)",
    re.S,
)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|style|aria-hidden|aria-label)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|$)", re.I) for name in RAW}

LONG_ENOUGH = 25


class Node:
    """An element; ``parts`` are texts and elements in page order."""

    __slots__ = ("name", "label", "parent", "parts", "points", "out", "depth", "in_article", "size", "links")

    def __init__(self, name: str, label: str, parent: Node | None, out: bool):
        self.name, self.label, self.parent, self.out = name, label, parent, out
        self.parts: list[Node | str] = []
        self.points = 0.0
        self.depth = 0 if parent is None else parent.depth + 1
        self.in_article = name == "article" or parent is not None and parent.in_article
        self.size = self.links = 0  # characters below, and those in links


def _label(attributes: str) -> tuple[str, bool]:
    """Class, id and role of an element, and whether it is hidden."""
    words, hidden = [], False
    for name, a, b, c in _ATTRIBUTE.findall(attributes):
        value, name = a or b or c, name.lower()
        if name in ("class", "id", "role"):
            words.append(value)
        elif name == "hidden" and not value or name == "aria-hidden" and value.lower() == "true":
            hidden = True
        elif name == "style" and _HIDDEN.search(value):
            hidden = True
    return " ".join(words), hidden


def _is_out(name: str, label: str, hidden: bool, parent: Node) -> bool:
    if hidden or name in DROPPED:
        return True
    if name == "header":  # of the page; an article's own header holds its title
        return not parent.in_article
    if not label or name in ("html", "body", "article", "main"):
        return name == "article" and bool(re.search(r"comment|reply|teaser|related|promo", label, re.I))
    return bool(PARTS.search(label)) and not (MAIN.search(label) and name in ("div", "section") and not re.search(r"comment|sidebar|related|share|footer|nav|\bad", label, re.I))


def parse(html: str) -> Node:
    """The element tree of a page; wrong nesting is repaired the usual way."""
    root = Node("root", "", None, False)
    here, at, size = root, 0, len(html)
    while at < size:
        match = _TOKENS.match(html, at)
        at = match.end()
        cdata, slash, name, attributes, text = match.groups()
        if text is not None:
            here.parts.append(unescape(text) if "&" in text else text)
            continue
        if cdata is not None:
            here.parts.append(cdata)
            continue
        if name is None:
            continue
        name = name.lower()
        if slash:
            node = here
            while node is not None and node.name != name:
                if node.name in ("table", "td", "th") and name not in BLOCKS:
                    node = None
                    break
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
            elif name == "p":
                here.parts.append(Node("p", "", here, here.out))
            continue
        if name == "br" or name == "wbr":
            here.parts.append(" " if name == "br" else "")
            continue
        if name in BLOCKS:
            node = here
            while node.parent is not None and node.name not in ("td", "th", "div", "article", "section", "body", "main", "table", "button"):
                if node.name in CLOSED_BY_BLOCK:
                    here = node.parent
                    break
                node = node.parent
        if name in CLOSES:
            ends, stops = CLOSES[name]
            node = here
            while node.parent is not None and node.name not in stops:
                if node.name in ends:
                    here = node.parent
                    if name not in ("tr", "tbody", "tfoot"):
                        break
                node = node.parent
        label, hidden = _label(attributes) if attributes else ("", False)
        node = Node(name, label, here, here.out or _is_out(name, label, hidden, here))
        here.parts.append(node)
        if name in RAW:
            end = _RAW_END[name].search(html, at)
            at = size if end is None else html.find(">", end.start()) + 1 or size
        elif name not in VOID and not attributes.endswith("/"):
            here = node
    return root


def _texts(node: Node) -> Iterator[str]:
    """Texts below a node in page order; ``None``-like marks part blocks."""
    stack: list[Node | str] = [node]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            yield part
        elif not part.out:
            if part.name in BLOCKS:
                yield "\0"
                stack.append("\0")
            stack += reversed(part.parts)


def blocks(node: Node) -> list[str]:
    """Texts of the blocks below a node, with single spaces."""
    found, own = [], []
    for text in _texts(node):
        if text == "\0":
            if own:
                found.append(" ".join("".join(own).split()))
                own = []
        else:
            own.append(text)
    found.append(" ".join("".join(own).split()))
    return [text for text in found if text]


def _measure(root: Node) -> None:
    """Count the characters below each element, and those in links, from the leaves up; elements that are out have none."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if not node.out:
            order.append(node)
            stack += [part for part in node.parts if not isinstance(part, str)]
    for node in reversed(order):  # all below a node come before it
        node.size = sum(len("".join(part.split())) if isinstance(part, str) else part.size for part in node.parts)
        node.links = node.size if node.name == "a" else sum(part.links for part in node.parts if not isinstance(part, str))


def _link_share(node: Node) -> float:
    return node.links / node.size if node.size else 0.0


def _own_text(node: Node) -> str:
    """Text of a node outside blocks below it."""
    out, stack = [], list(reversed(node.parts))
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            out.append(part)
        elif not part.out and part.name not in BLOCKS:
            stack += reversed(part.parts)
    return " ".join("".join(out).split())


def _score(root: Node) -> list[Node]:
    """Pass points of paragraphs upwards; the containers that got some."""
    got: dict[int, Node] = {}
    stack = [root]
    while stack:
        node = stack.pop()
        if node.out:
            continue
        stack += [part for part in node.parts if not isinstance(part, str)]
        if node.name not in BLOCKS or node.name in ("html", "body"):
            continue
        text = _own_text(node)
        if not text or node.name not in PARAGRAPHS and len(text) < LONG_ENOUGH:
            continue
        points = (1 + text.count(",") + min(len(text) / 100, 3)) * (1 - _link_share(node))
        parent, share = (node.parent, 1.0) if node.name in PARAGRAPHS else (node, 1.0)
        level = 0
        while parent is not None and level < 5:
            if parent.name in BLOCKS:
                parent.points += points * share
                got[id(parent)] = parent
                level += 1
                share = 1 / (2 if level == 1 else 3 * level)
            parent = parent.parent
    for node in got.values():
        if node.name in ("article", "main") or MAIN.search(node.label):
            node.points += 5
        node.points *= 1 - _link_share(node)
    return list(got.values())


def main_text(html: str | None) -> str:
    """The article of a page as one line of text."""
    if not html:
        return ""
    root = parse(html)
    _measure(root)
    scored = _score(root)
    if not scored:
        tops = [node for node in _named(root, "article") or _named(root, "main") if not node.out] or [root]
        return " ".join(text for node in tops for text in blocks(node))
    best = max(scored, key=lambda node: (node.points, -node.depth))
    node: Node | None = best
    while node is not None:  # parts of an article belong together
        if node.name in ("article", "main"):
            best = node
            break
        node = node.parent
    if best.parent is None or best.name in ("article", "main", "body", "html"):
        kept: list[Node] = [best]
        if best.name == "article":
            kept = [x for x in best.parent.parts if x is best or isinstance(x, Node) and x.name == "article" and _good(x, best)]
    else:
        kept = [x for x in best.parent.parts if isinstance(x, Node) and (x is best or _good(x, best))]
    return " ".join(text for node in kept for text in blocks(node))


def _named(root: Node, name: str) -> list[Node]:
    found, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.name == name:
            found.append(node)
        else:
            stack += [part for part in reversed(node.parts) if not isinstance(part, str)]
    return found


def _good(node: Node, best: Node) -> bool:
    """Whether a sibling of the best container belongs to the article."""
    if node.out or node.name not in BLOCKS:
        return False
    if node.points >= max(10.0, 0.2 * best.points):
        return True
    total, links = node.size, node.links
    if node.name in ("h1", "h2", "h3"):
        return total > 0 and not links
    if node.name in ("p", "blockquote", "pre"):
        return total > 80 and links < 0.25 * total or 0 < total <= 80 and not links and best.parent.name == "article"
    return False


def extract(df: DataFrame, html: str = "html", name: str = "text") -> DataFrame:
    """Add the main text of each page."""
    ship(df.sparkSession)

    @F.arrow_udf("string")
    def extracted(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(page.as_py()) for page in pages], pa.string())

    return df.withColumn(name, extracted(F.col(html)))
