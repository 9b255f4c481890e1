"""Main text of web pages by composite text density.

For every element that is no mere part of a line, the characters per tag below it are
weighed down by the share of characters that are links. The element whose children have
the largest sum of densities is the main part; the lowest density on its path up to the
body is the threshold under which link lists inside it go, and which blocks beside it and
beside the elements that hold it must reach to belong to it. Elements that are menus,
footers and the like by their tag or role never take part. Those that a page only names
so by a class or id take no part unless they hold the main part or are headings.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmill.llm.tables import pick, text_of
from creditmill.llm.words import texts_of

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr br img".split()
)
# Start tags that end an open element of the second set, up to the nearest of the third.
CLOSES_P = frozenset(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header "
    "hgroup hr main menu nav ol p pre section table ul".split()
)
PARTS = frozenset("table td th nav aside section article main header footer form dialog button select template object svg".split())
ENDS = {
    "li": (frozenset({"li"}), frozenset({"ul", "ol", "menu"}) | PARTS),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"}) | PARTS),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"}) | PARTS),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select"})),
}
# All that a head holds; anything else ends it.
HEAD = frozenset("html head base link meta title style script noscript template".split())
# Boilerplate by element, by role, and by a whole class or id.
DROPPED = frozenset(
    "head title script style noscript template nav menu footer aside form button select textarea input iframe object "
    "embed svg canvas audio video dialog".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense banner breadcrumb breadcrumbs comment comments "
    "cookie cookies consent disqus footer gdpr header masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promotion related respond share sharing sidebar signup social sponsor sponsored subscribe "
    "toolbar widget widgets".split()
)
PIECES = re.compile(r"[\s_-]+")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6 header hgroup".split())
ARTICLES = frozenset({"article", "main"})
MAIN = frozenset({"html", "body"}) | ARTICLES


class Node:
    """An element with what it holds, and counts over all that is below it. A dropped one
    and what is below it are in no element's parts, but end like others."""

    __slots__ = ("tag", "parent", "dropped", "named", "hinted", "parts", "chars", "tags", "link_chars", "link_tags", "density", "total")

    def __init__(self, tag: str, parent: Node | None, dropped: bool = False):
        self.tag, self.parent, self.dropped, self.parts = tag, parent, dropped, []
        self.named = self.hinted = False  # boilerplate by its name, or by a part of its name
        self.chars = self.tags = self.link_chars = self.link_tags = 0
        self.density = self.total = 0.0


class Tree(HTMLParser):
    """The elements of a page, without the boilerplate ones."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.node = Node("html", None)
        self.order: list[Node] = [self.root]

    def parse_html_declaration(self, i: int) -> int:
        """`<![` that opens no marked section the parser knows is read as browsers read it:
        a bogus comment up to the next `>`, and not an error that would end the task."""
        if self.rawdata.startswith("<![", i):
            try:
                return self.parse_marked_section(i)
            except AssertionError:
                end = self.rawdata.find(">", i + 3)
                return -1 if end < 0 else end + 1
        return super().parse_html_declaration(i)

    def boilerplate(self, tag: str, attributes: list) -> bool:
        if tag in DROPPED or tag == "header" and not self.inside("article"):
            return True
        if tag in MAIN:
            return False
        for name, value in attributes:
            if name == "role" and value and value.lower() in ROLES or name == "hidden":
                return True
        return False

    def name(self, node: Node, attributes: list) -> None:
        """Marks what the class and id of a node say; headings are named after their text."""
        if node.tag in HEADINGS:
            return
        for name, value in attributes:
            if name in ("class", "id") and value:
                value = value.lower()
                node.named |= not NAMES.isdisjoint(value.split() if name == "class" else [value.strip()])
                node.hinted |= name == "class" and not NAMES.isdisjoint(PIECES.split(value))

    def inside(self, tag: str) -> bool:
        node = self.node
        while node is not None and node.tag != tag:
            node = node.parent
        return node is not None

    def end_until(self, ends: frozenset, stops: frozenset) -> None:
        node = found = self.node
        found = None
        while node.parent is not None and node.tag not in stops:
            if node.tag in ends:
                found = node
            node = node.parent
        if found is not None:
            self.node = found.parent

    def handle_starttag(self, tag: str, attributes: list) -> None:
        if tag == "body" or self.node.tag == "head" and tag not in HEAD:
            self.end_until(frozenset({"head"}), frozenset({"body"}))
        if tag in CLOSES_P:
            self.end_until(frozenset({"p"}), frozenset({"button", "td", "th", "table"}))
        elif tag in ENDS:
            self.end_until(*ENDS[tag])
        if tag in ("html", "body") and self.inside("body"):
            return
        node = Node(tag, self.node, self.node.dropped or self.boilerplate(tag, attributes))
        if not node.dropped:
            self.name(node, attributes)
            self.node.parts.append(node)
            self.order.append(node)
        if tag not in VOID:
            self.node = node

    def handle_endtag(self, tag: str) -> None:
        node = self.node
        while node is not None and node.tag != tag:
            if node.dropped and tag in INLINE and node.tag not in INLINE:
                return  # the end of a part of a line ends no block
            node = node.parent
        if node is not None and node.parent is not None:
            self.node = node.parent

    def handle_data(self, text: str) -> None:
        if self.node.tag == "head" and text.strip():
            self.node = self.node.parent
        if not self.node.dropped:
            self.node.parts.append(text)


def density(node: Node, share: float) -> float:
    """Of an element, on a page with this share of link characters."""
    if not node.chars:
        return 0.0
    plain = max(1, node.chars - node.link_chars)
    base = math.log(node.chars / plain * node.link_chars + share * node.chars + math.e)
    ratio = node.chars / max(1, node.link_chars) * max(1, node.tags) / max(1, node.link_tags)
    return node.chars / max(1, node.tags) * max(0.0, math.log(max(ratio, 1e-9), max(base, 1.0001)))


def measure(tree: Tree) -> Node:
    """Counts and densities of all elements; returns the body."""
    for node in reversed(tree.order):  # children stand behind their parents
        link = node.tag == "a"
        node.chars = node.tags = node.link_chars = node.link_tags = 0
        node.density = node.total = 0.0
        for part in node.parts:
            if isinstance(part, str):
                node.chars += len(part.strip())
            else:
                node.chars += part.chars
                node.tags += part.tags + 1
                node.link_chars += part.link_chars
                node.link_tags += part.link_tags + (part.tag == "a")
        if link:
            node.link_chars = node.chars
    body = next((n for n in tree.order if n.tag == "body"), tree.root)
    share = body.link_chars / body.chars if body.chars else 0.0
    for node in tree.order:
        node.density = density(node, share)
    for node in tree.order:
        node.total = sum([p.density for p in node.parts if not isinstance(p, str) and p.tag not in INLINE])
    return body


def main_part(tree: Tree, body: Node) -> tuple[Node, float]:
    """The main element, and the lowest density on its path up to the body.

    From the element with the largest sum, the path up is followed as long as the density
    stays above half of that element's, which takes in headings beside it. An article
    element that holds half of the characters, or lies on that path, is the main element.
    """
    best = body
    for node in tree.order:
        if node.total > best.total and node.tag not in INLINE:
            best = node
    threshold, node = best.density, best
    while node is not None:
        threshold = min(threshold, node.density)
        node = None if node is body else node.parent
    node, least = best, best.density / 2
    while node is not body and node is not None:
        if node.tag in ARTICLES:
            return node, threshold
        node = node.parent
    inside = [n for n in tree.order if n.tag in ARTICLES and 2 * n.chars >= best.chars > 0]
    if inside:
        return inside[0], threshold
    while best is not body and best.parent not in (None, body) and best.parent.density >= least:
        best = best.parent
    return best, threshold


def line_of(parent: Node, parts: list, share: float) -> Node:
    """Text and parts of a line that stand together, as an element."""
    line = Node("div", parent)
    line.parts = parts
    for part in parts:
        if isinstance(part, str):
            line.chars += len(part.strip())
        else:
            line.chars += part.chars
            line.tags += part.tags + 1
            line.link_chars += part.link_chars
            line.link_tags += part.link_tags + (part.tag == "a")
    line.density = density(line, share)
    return line


def main_parts(best: Node, body: Node, threshold: float) -> list[Node]:
    """The main element and, unless it is an article, the blocks beside it and beside what
    holds it whose density reaches the threshold, if links are not most of them, in page
    order. Where a part of its class speaks against a block, its sum must also be a quarter
    of the main element's. The headings before a block that stays, stay."""
    found = [best]
    share = body.link_chars / body.chars if body.chars else 0.0
    node = best
    while node is not body and node.parent is not None and best.tag not in ARTICLES:
        beside: list[Node] = []
        run: list = []
        for part in [*node.parent.parts, None]:
            if part is not None and (isinstance(part, str) or part.tag in INLINE and part is not node):
                run.append(part)
                continue
            if run:
                beside.append(line_of(node.parent, run, share))
                run = []
            if part is not None:
                beside.append(part)
        kept: list[Node] = []
        behind = False  # the block behind stays
        for part in reversed(beside):
            if part is node:
                kept += reversed(found)
                behind = True
            elif part.chars:
                heading = part.tag in HEADINGS and behind
                behind = part.link_chars <= 0.6 * part.chars and (heading or part.density >= threshold)
                behind &= not part.hinted or 4 * part.total >= best.total
                if behind:
                    kept.append(part)
        found, node = kept[::-1], node.parent
    return found


def without_named(tree: Tree, body: Node) -> Node:
    """Takes out the named elements that hold neither an article nor, on a page without one
    of a tenth of its text, the main part; returns the body, measured anew."""
    if not any(n.named and n.tag not in MAIN for n in tree.order):
        return body
    articles = [n for n in tree.order if n.tag in ARTICLES and not n.named]
    holders = {id(body)}
    best = main_part(tree, body)[0]
    for node in articles if any(10 * n.chars >= best.chars for n in articles) else [*articles, best]:
        while node is not None and id(node) not in holders:
            holders.add(id(node))
            node = node.parent
    gone = set()
    for node in tree.order:
        if id(node.parent) in gone or node.named and node.tag not in MAIN and id(node) not in holders:
            gone.add(id(node))
    tree.order = [n for n in tree.order if id(n) not in gone]
    for node in tree.order:
        node.parts = [p for p in node.parts if id(p) not in gone]
    return measure(tree)


def main_text(html: str) -> str:
    """Blocks of the main part, one per line."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    body = without_named(tree, measure(tree))
    best, threshold = main_part(tree, body)
    lines: list[str] = []
    line: list[str] = []

    def end_line() -> None:
        text = " ".join("".join(line).split())
        if text:
            lines.append(text)
        line.clear()

    parts = main_parts(best, body, threshold)
    outer = {id(p) for p in parts}
    stack: list = [x for p in reversed(parts) for x in (None, p)]
    while stack:
        part = stack.pop()
        if isinstance(part, str):
            line.append(part)
        elif part is None:
            end_line()
        elif part.tag == "br":
            line.append(" ")
        elif part.tag in INLINE:
            stack.extend(reversed(part.parts))
        else:
            end_line()
            links = id(part) not in outer and part.link_tags > (not part.hinted) and part.link_chars > 0.6 * part.chars
            if not (links and part.density < threshold):
                stack.append(None)
                stack.extend(reversed(part.parts))
    end_line()
    return "\n".join(lines)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row of `pages`.

    A null or empty page, or one without main text, has an empty text. White space inside
    a block is one space, blocks are joined by one line feed in page order. Pages are read
    one by one: repeated rows stay, an empty table gives an empty result, other columns
    are ignored. No shuffle; memory is bound by one page.
    """
    rows = pick(pages, "page_id", "url", "html").select("page_id", "url", text_of("html").alias("html"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                piece = pa.table(batch.slice(at, 256))
                yield pa.RecordBatch.from_pydict({
                    "page_id": texts_of(piece, "page_id"), "url": texts_of(piece, "url"),
                    "text": pa.array([main_text(h) for h in texts_of(piece, "html").to_pylist()], pa.string()),
                })

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    found = rows.mapInArrow(extract, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")
    return found.select("page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"))
