"""Main text of web pages by composite text density.

A page becomes a tree of elements.  Elements that are never part of an article (menus, site
headers, footers, sidebars, notices, adverts, forms, scripts, styles, reader comments) go first, told by tag, role
or the words of their class and id.  For every node that is left the density is its characters per tag, raised
where few of them are link text:

    density = C / T * log(C / LC * T / LT) / log(log(C / (C - LC) * LC + LCb / Cb * C + e))

(C characters, T tags, LC and LT those inside links, LCb and Cb those of the body; a zero below a line
counts as one).  The sum of the densities of a node's children, and of its own text, marks the node that holds the article:
the one with the greatest sum.  The least density on the way from it to the body is the threshold: other nodes that
reach it are parts of the text too, each at its own greatest sum.  Where a page has ``article`` or ``main`` elements, only
what they hold competes, and the winner's whole element is taken.

Pages are independent: tasks read them in Arrow batches, there is no shuffle, and memory is a batch and the
tree of one page.  Nothing recurses, so deep trees are safe.

Defined cases: null or empty html gives the empty text; repeated rows each give a row; an empty table gives an
empty result; columns named in ``keep`` pass through, others are not read, and the names of the result win over equal
names in ``keep``; markup that never ends is text up to the end of the page.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from weftline.session import ship

# Fixed values of HTML: elements without an end tag, elements whose content is no markup, elements that start a new
# line, and those whose start ends an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
ENDS_P = BLOCK - frozenset("body caption html legend optgroup option tbody td tfoot th thead tr".split())
# An element that a later one of the same kind ends, and the elements that this does not reach across.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"}), "a": ({"a"}, {"table"})}

# What is never part of an article.
DROP_TAGS = frozenset(
    "nav aside footer form button select input label fieldset menu dialog script style noscript template iframe object embed svg "
    "canvas map audio video head title textarea noembed noframes datalist".split())
DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar toolbar".split())
DROP_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense sponsor sponsored sponsor promo promotion banner nav navbar navigation "
    "menu menubar breadcrumb breadcrumbs pagination pager sidebar aside widget widgets footer masthead topbar toolbar cookie cookies "
    "consent gdpr notice notices disclaimer popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "comment comments disqus reply replies respond related recommended recommendations teaser form search skip".split())
HOLDERS = ("article", "main")

_TOKEN = re.compile(
    r"<!--(?:.*?--!?>|-?>|.*\Z)|<[!?][^>]*+>?|<(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)>", re.S)
_NAMED = re.compile(r"([^\s=\"'/>]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))|([^\s=\"'/>]+)", re.S)
_WORDS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")


@dataclass(slots=True, eq=False)
class Node:
    """An element: its children and texts in page order, and the counts of its subtree."""

    tag: str
    parent: "Node | None"
    drop: bool = False
    items: list = field(default_factory=list)
    chars: int = 0
    tags: int = 0
    link_chars: int = 0
    link_tags: int = 0
    density: float = 0.0
    total: float = 0.0


def _attributes(raw: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for name, double, single, bare, alone in _NAMED.findall(raw):
        found.setdefault((name or alone).lower(), entities.unescape(double or single or bare))
    return found


def _never_text(tag: str, raw: str) -> bool:
    """Whether the element is a part of the page that is no article."""
    if tag in DROP_TAGS:
        return True
    if tag in ("html", "body", *HOLDERS) and "comment" not in raw.lower():
        return False
    if not raw or raw.isspace():
        return False
    named = _attributes(raw)
    if "hidden" in named or named.get("aria-hidden", "").lower() == "true" or named.get("role", "").lower() in DROP_ROLES:
        return True
    if "display:none" in named.get("style", "").replace(" ", "").lower():
        return True
    words = {w.lower() for w in _WORDS.findall(f"{named.get('class', '')} {named.get('id', '')}")}
    return tag not in ("html", "body") and not words.isdisjoint(DROP_WORDS)


def parse(page: str) -> Node:
    """The tree of a page.  End tags that are missing are put where the next element or the parent's end asks for them."""
    root = Node("#page", None)
    node, at = root, 0
    open_count: dict[str, int] = {}

    def up_to(stop: Node) -> None:
        nonlocal node
        while node is not stop:
            open_count[node.tag] -= 1
            node = node.parent

    def close(kinds: set[str], fence: set[str] | frozenset[str]) -> None:
        """End the nearest open element of these kinds, unless a fence lies between."""
        if not any(open_count.get(k) for k in kinds):
            return
        found = node
        while found.tag not in kinds:
            if found.tag in fence or found.parent is None:
                return
            found = found.parent
        up_to(found.parent)

    while True:
        token = _TOKEN.search(page, at)
        if token is None:
            break
        if token.start() > at:
            node.items.append(page[at:token.start()])
        at = token.end()
        if token[2] is None:
            continue
        tag, raw = token[2].lower(), token[3]
        if token[1]:
            if tag != "br":
                # The end of an inline element does not reach across blocks.
                close({tag}, {"table", "article", "body"} if tag == "p" else set() if tag in BLOCK else BLOCK)
            continue
        if tag in ENDS_P and open_count.get("p"):
            close({"p"}, {"table", "button"})
        if tag in SIBLINGS:
            kinds, fence = SIBLINGS[tag]
            # A row also ends the cell that is open in the row before it.
            for kind in sorted(kinds, reverse=True) if tag == "tr" else [None]:
                close({kind} if kind else kinds, fence)
        child = Node(tag, node, _never_text(tag, raw))
        node.items.append(child)
        if tag in VOID or raw.endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*+>", re.I).search(page, at)
            at = end.end() if end else len(page)
            continue
        node = child
        open_count[tag] = open_count.get(tag, 0) + 1
    if at < len(page):
        node.items.append(page[at:])
    return root


def _cut_marked(root: Node) -> None:
    """Take marked elements out, except those that hold an article, a main part or the page's first heading of first rank.

    A header goes as well, unless it is the head of an article.
    """
    order = _nodes(root)
    title = next((n for n in order if n.tag == "h1" and not n.drop), None)
    holds: set[int] = set()
    for node in reversed(order):
        if node.parent is not None and (id(node) in holds or node is title or node.tag in HOLDERS and not node.drop):
            holds.add(id(node.parent))
    in_article: set[int] = set()
    for node in order:
        if node.tag == "article" or id(node.parent) in in_article:
            in_article.add(id(node))
        elif node.tag == "header":
            node.drop = True
    for node in order:
        node.items = [i for i in node.items if not (isinstance(i, Node) and i.drop and (
            i.tag in DROP_TAGS or i.tag == "header" or id(i) not in holds))]


def _nodes(root: Node) -> list[Node]:
    """The elements below and including root, in page order."""
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [i for i in reversed(node.items) if isinstance(i, Node)]
    return out


def _size(text: str) -> int:
    return len("".join(entities.unescape(text).split()))


def weigh(root: Node) -> list[Node]:
    """Fill in counts, densities and sums of all elements; returns them in page order."""
    order = _nodes(root)
    inside = {id(root): False}
    own: dict[int, int] = {}
    for node in order:
        linked = inside[id(node)] or node.tag == "a"
        for item in node.items:
            if isinstance(item, Node):
                inside[id(item)] = linked
            else:
                size = _size(item)
                own[id(node)] = own.get(id(node), 0) + size
                if linked:
                    node.link_chars += size
        node.chars = own.get(id(node), 0)
    for node in reversed(order):
        for item in node.items:
            if isinstance(item, Node):
                node.chars += item.chars
                node.link_chars += item.link_chars
                node.tags += item.tags + 1
                node.link_tags += item.link_tags + (item.tag == "a")
    share = root.link_chars / max(1, root.chars)
    for node in order:
        node.density = density(node.chars, node.tags, node.link_chars, node.link_tags, share)
    for node in order:
        node.total = sum(i.density for i in node.items if isinstance(i, Node)) + own.get(id(node), 0)
    return order


def density(chars: int, tags: int, link_chars: int, link_tags: int, share: float) -> float:
    """Composite text density; ``share`` is the part of the body's characters inside links.

    Without links on the page the base of the logarithm would be one: the density is then the plain one.
    """
    if not chars:
        return 0.0
    plain = chars / max(1, tags)
    base = math.log(chars / max(1, chars - link_chars) * link_chars + share * chars + math.e)
    if base <= 1.0:
        return plain
    return plain * math.log(chars / max(1, link_chars) * max(1, tags) / max(1, link_tags)) / math.log(base)


def chosen(root: Node) -> list[Node]:
    """The elements that hold the main text, in page order, none inside another."""
    order = weigh(root)
    holder: dict[int, Node | None] = {}
    for node in order:
        holder[id(node)] = node if node.tag in HOLDERS else holder.get(id(node.parent))
    held = [n for n in order if holder[id(n)] is not None]
    if any(n.chars for n in held):
        best = holder[id(max(held, key=lambda n: n.total))]
        return [best]
    best = max(order, key=lambda n: n.total)
    least, above = best.density, best
    while above.parent is not None and above.tag != "body":
        above = above.parent
        least = min(least, above.density)
    # Lists of the greatest sum inside every element that reaches the threshold, from the top down.
    tops, size = {}, {}
    for node in reversed(order):
        top, number = node, 1
        for item in node.items:
            if isinstance(item, Node):
                number += size[id(item)]
                if tops[id(item)].total > top.total:
                    top = tops[id(item)]
        tops[id(node)], size[id(node)] = top, number
    marked: set[int] = set()
    stack = [above]
    while stack:
        node = stack.pop()
        if node.density >= least and node.chars:
            marked.add(id(tops[id(node)]))
            stack += [i for i in node.items if isinstance(i, Node)]
    out, skip = [], 0
    for i, node in enumerate(order):
        if i >= skip and id(node) in marked:
            out.append(node)
            skip = i + size[id(node)]
    return out


def lines(nodes: list[Node]) -> list[str]:
    """The blocks of the elements' text: references decoded, white space turned into single blanks."""
    out: list[str] = []
    block: list[str] = []

    def end() -> None:
        text = " ".join(entities.unescape("".join(block)).split())
        block.clear()
        if text:
            out.append(text)
    for top in nodes:
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
            elif isinstance(item, str):
                block.append(item)
            elif item.tag == "br":
                block.append(" ")
            elif item.tag in BLOCK or item is top:
                end()
                stack.append(None)
                stack += reversed(item.items)
            else:
                stack += reversed(item.items)
    return out


def main_text(page: str | None) -> str:
    """The main text of one page, a line per block."""
    if not page:
        return ""
    root = parse(page)
    _cut_marked(root)
    return "\n".join(lines(chosen(root)))


def extract(pages: DataFrame, html: str = "html", out: str = "text", keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """Columns ``keep``, the main text and ``n_chars``, its number of code points."""
    ship(pages.sparkSession)
    keep = [c for c in keep if c not in (out, "n_chars")]
    taken = pages.select(*keep, F.col(html).alias("_html"))
    schema = StructType([*taken.select(*keep).schema.fields]).add(out, "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(keep))] + [pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                schema.names)
    return taken.mapInArrow(run, schema)
