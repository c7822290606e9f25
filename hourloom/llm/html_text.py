"""Main text of web pages by tree scoring.

Each page becomes a small tree (end tags may be missing: a new paragraph or item closes an open one). Elements that never
hold an article (scripts, menus, forms, footers, adverts, comments, told by their tag, role, id or class words) are cut. A
class or id in which a word of two meanings stands beside words of content (`related-work`, `share-price`) cuts an element
only if at least half of its text is links. Every paragraph then passes points for its length and commas to its ancestors, in
full to its parent and half as much at every further step up, so that one pass from the leaves adds up all points; a
container's points are discounted by its link density. The best container leads to the article: all of the outermost article or main element around it or, on pages without one, of the
highest ancestor that is reached while most text of the parent is not in link lists. Next to it those siblings are kept that
score near the best container or are prose by themselves.

Blocks keep page order and are joined by one newline, white space inside a block is one space, character references are
decoded. Null html is empty; a page without text gives the empty text. Whole pages, nothing is capped; the time grows with the
length of the page, however deep or broken it is. A tag that the page's end cuts off is text, as all after it. Each row is
extracted by itself, so repeated rows give equal rows; of containers of equal points the first in page order is the best. Only
page_id, url and html are read, columns beside them have no effect.
"""

from __future__ import annotations

import html
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import extended, slices, values

# HTML's rule for attributes: a quote opens a value only right after `=`; an unquoted value ends at white space or `>`.
_ATTRIBUTE = r"[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:\"[^\"]*+\"|'[^']*+'|(?![\"'])[^\s>]*+))?+"
_TAG = re.compile(rf"<!--.*?(?:-->|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_ATTRIBUTE})*+)>", re.S)
_TAG_START = re.compile(r"<(?:/?[a-zA-Z]|[!?])")
_PAIR = re.compile(r"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|(?![\"'])([^\s>]*+)))?+")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"([a-z])([A-Z])")
# Fixed values of HTML: elements without content, with raw text, and those that are blocks.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style textarea title xmp noscript iframe noframes template".split())
_BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead tr ul caption".split())
_CUT = frozenset("nav footer aside form button select input label menu dialog svg canvas object embed audio video map head fieldset search".split()) | _RAW
_CUT_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login comment comments commentlist disqus respond reply replies share sharing social related recommended recommendations widget toolbar pagination pager skip paywall".split()
)
# Words of two meanings, and words that beside them still name a box of the page, not content.
_TWO_MEANINGS = frozenset("alert banner consent menu notice notices promotion recommended recommendations related replies reply share sharing skip social subscription".split())
_BOX_WORDS = frozenset("area articles bar block bottom box button buttons container content footer global header icon icons inner item items left link links list main media module news outer page panel pages post posts right row section site stories story top wrap wrapper".split())
_CUT_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
_PROSE = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6".split())
_KEEP_OPEN = frozenset("html body table ul ol dl div article section main".split())
_HOLDS_ITEMS = frozenset("html body table ul ol dl select".split())
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in _RAW}


class Node:
    """An element. `paragraph` and `items` are the open paragraph and items that a new block or item closes."""

    __slots__ = ("tag", "parent", "children", "cut", "doubt", "points", "chars", "linked", "commas", "depth", "inside", "paragraph", "items")

    def __init__(self, tag: str, parent: Node | None, attributes: str = ""):
        self.tag, self.parent, self.children = tag, parent, []
        self.points, self.chars, self.linked, self.commas = 0.0, 0, 0, 0
        self.depth = parent.depth + 1 if parent else 0
        self.inside = tag in ("article", "main") or parent is not None and parent.inside
        self.paragraph = self if tag == "p" else None if parent is None or tag in _KEEP_OPEN else parent.paragraph
        self.items = {} if parent is None or tag in _HOLDS_ITEMS else parent.items | {tag: self} if tag in _CLOSES else parent.items
        self.cut, self.doubt = _unwanted(tag, attributes) if attributes.strip("/ ") else (False, False)
        self.cut = self.cut or tag in _CUT or tag == "header" and not self.inside


def _unwanted(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether the attributes cut the element, and whether they do so only if it is mostly links."""
    doubt = False
    if tag in ("html", "body", "article", "main"):
        return False, False
    for m in _PAIR.finditer(attributes):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "hidden" or name == "aria-hidden" and value.strip().lower() == "true" or name == "style" and _NO_DISPLAY.search(value):
            return True, False
        if name == "role" and value.lower().strip() in _CUT_ROLES:
            return True, False
        if name in ("class", "id"):
            for part in value.split():
                words = set(_WORDS.findall(_CAMEL.sub(r"\1 \2", part).lower()))
                found = words & _CUT_WORDS
                if not found:
                    continue
                if found - _TWO_MEANINGS or words <= _CUT_WORDS | _BOX_WORDS:
                    return True, False
                doubt = True
    return False, doubt


def parse(page: str) -> Node:
    root = node = Node("html", None)
    is_open: dict[str, int] = {}
    at = text = 0
    size = len(page)

    def leave(top: Node) -> Node:
        """Closes all open elements up to `top`, which is one of them."""
        x = node
        while True:
            is_open[x.tag] -= 1
            if x is top:
                return x.parent
            x = x.parent

    while (lt := page.find("<", at)) >= 0:
        m = _TAG.match(page, lt)
        if not m:
            if _TAG_START.match(page, lt):
                break  # it never ends
            at = lt + 1
            continue
        if lt > text:
            node.children.append(page[text:lt])
        at = text = m.end()
        name = m[2] and m[2].lower()
        if not name:
            continue
        if m[1]:
            if is_open.get(name):
                up = node
                while up.tag != name:
                    up = up.parent
                node = leave(up)
            continue
        if name in ("html", "body"):
            continue
        if name in _RAW:
            end = _RAW_END[name].search(page, at)
            close = page.find(">", end.end()) if end else -1
            at = text = close + 1 if close >= 0 else size
            continue
        if name in _BLOCK and node.paragraph:  # a block closes an open paragraph, an item an open item
            node = leave(node.paragraph)
        if name in _CLOSES and (items := [node.items[x] for x in _CLOSES[name] if x in node.items]):
            node = leave(min(items, key=lambda x: x.depth))
        child = Node(name, node, m[3])
        node.children.append(child)
        if name not in _VOID and not _self_closed(m[3]):
            node = child
            is_open[name] = is_open.get(name, 0) + 1
    if text < size:
        node.children.append(page[text:])
    return root


def _self_closed(attributes: str) -> bool:
    """Ends in a slash that is no part of an unquoted value."""
    if not attributes.endswith("/"):
        return False
    last = attributes[max(map(attributes.rfind, " \t\r\n\f")) + 1 :]
    return "=" not in last or last[-2:-1] in ("'", '"')


def _measure(root: Node) -> list[Node]:
    """Sets chars, linked and commas of every kept node, cuts those in doubt that are mostly links; kept nodes in page order."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        if node.cut:
            continue
        order.append(node)
        stack += [c for c in reversed(node.children) if type(c) is Node]
    for node in reversed(order):
        for c in node.children:
            if type(c) is str:
                node.chars += len(_SPACE.sub(" ", c).strip())
                node.commas += c.count(",")
        if node.tag == "a":
            node.linked = node.chars
        if node.doubt and 2 * node.linked >= node.chars:
            node.cut = True
        elif node.parent is not None:
            node.parent.chars += node.chars
            node.parent.linked += node.linked
            node.parent.commas += node.commas
    for node in order:
        node.cut = node.cut or node.parent is not None and node.parent.cut
    return [node for node in order if not node.cut]


def _density(node: Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def best_nodes(root: Node) -> list[Node]:
    order = _measure(root)
    for node in reversed(order):  # what came from below passes on by half, a paragraph's own points in full
        if node.parent is None:
            continue
        node.parent.points += node.points / 2
        if node.tag not in _BLOCK or node.tag in ("html", "body", "article", "main", "section"):
            continue
        if node.tag != "p" and any(type(c) is Node and c.tag in _BLOCK for c in node.children) or not node.chars:
            continue
        node.parent.points += (1 + node.commas + min(node.chars / 100, 3)) * (1 - _density(node))
    tops = [n for n in order if n.points]
    if not tops:
        return [root]
    prior = {"article": 1.5, "main": 1.25}
    rated = {id(n): n.points * (1 - _density(n)) * prior.get(n.tag, 1) for n in tops}
    best = max(tops, key=lambda n: rated[id(n)])
    limit, out = max(10.0, 0.2 * rated[id(best)]), []
    top, marked = _whole(best, {n for n, points in rated.items() if points >= limit})
    if top.parent is None:
        return [top]
    for s in top.parent.children:
        if type(s) is not Node or s.cut:
            continue
        own = s.tag in _PROSE and _density(s) < 0.25 and (s.chars > 80 or not marked)
        if s is top or rated.get(id(s), 0) >= limit or own:
            out.append(s)
    return out


def _whole(best: Node, near: set[int]) -> tuple[Node, bool]:
    """The article that the best container is a part of, and whether the page marks it: the outermost article or main
    around it; without one, the highest ancestor on whose way up most text of every parent is not in link lists. Lists and boxes of
    links beside the way are cut, unless they score near the best."""
    marked, node = None, best
    while node is not None:
        if node.tag in ("article", "main"):
            marked = node
        node = node.parent
    if marked is not None:
        return marked, True
    top = best
    while (up := top.parent) is not None:
        beside = [c for c in up.children if type(c) is Node and not c.cut and c is not top]
        links = [c for c in beside if _density(c) >= 0.5]
        if 2 * sum(c.chars for c in links) > up.chars:
            break
        for c in links:
            c.cut = c.tag in _BLOCK and c.tag not in _PROSE and id(c) not in near
        top = up
    return top, False


def blocks(nodes: list[Node]) -> list[str]:
    out, run = [], []

    def end():
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list = [*reversed(nodes)]
    while stack:
        x = stack.pop()
        if x is None:
            end()
        elif type(x) is str:
            run.append(x)
        elif not x.cut:
            if x.tag in _BLOCK:
                end()
                stack.append(None)
            elif x.tag == "br":
                run.append(" ")
            stack += reversed(x.children)
    end()
    return out


def main_text(page: str | None) -> str:
    return "\n".join(blocks(best_nodes(parse(page)))) if page else ""


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row."""

    def run(batches):
        for batch in slices(batches):
            texts = [main_text(x) for x in values(batch, "html")]
            yield extended(batch.select(["page_id", "url"]), {"text": (texts, pa.string()), "n_chars": ([len(t) for t in texts], pa.int64())})

    kinds = dict(pages.dtypes)
    return pages.select("page_id", "url", F.col("html").cast("string").alias("html")).mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars bigint")
