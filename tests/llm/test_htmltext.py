import html
import math
import random
import re

import pytest

from weftline.llm import htmltext as H
from weftline.llm.queries import QUERIES

DATA = "/root/testdata/sf0.001"

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>if (a<b) "</p>"</script></head><body class="has-sidebar">
<header><h2>Site</h2></header><nav><a href=x>Menu</a></nav><div id=cookie-notice>We use cookies.</div><div class="ad">Buy</div>
<div class="sidebar"><p>Side text that is rather long and has no links at all, so its density is high.</p></div>
%s<form><p>Write <input name=q> here</p></form><div class="comments"><article class="comment"><p>I say no.</p></article></div>
<footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("body, want", [
    ("<article><header><h1>Head  &amp; line</h1></header><p>One\n two&nbsp;three.<p><b>Four<br>five</p><!-- no <p> --></article>",
     "Head & line\nOne two three.\nFour five"),
    ("<main><h1>T</h1><ul><li>a<li>b <i>c</i></ul><table><tr><td>x<td>y<tr><td>z</table>tail</main>", "T\na\nb c\nx\ny\nz\ntail"),
    ("<article><p>a &lt;b&gt; &#233; &eacute; &am 1 < 2 &amp;lt;</p><aside>no</aside><div class=share>no</div></article>",
     "a <b> é é &am 1 < 2 &lt;"),
    ("<article><p>one</b> two</i></p></div><p title='a > b'>three</p><img src=x alt=no><p hidden>no</p></article>", "one two\nthree"),
    ("<article><p>cut off <a href='x", "cut off <a href='x"),
    ("<div class='content with-menu'><h1>Titles</h1><p>This is the text of the page, in a part without a name.</p>"
     "<p>It has <a href=y>one link</a> and more words than the rest.</p></div>",
     "Titles\nThis is the text of the page, in a part without a name.\nIt has one link and more words than the rest."),
])
def test_page_parts(body, want):
    got = H.main_text(PAGE % body)
    assert got == want or "cut off" in body and got.startswith("cut off")


def test_text_around_links_beats_link_lists():
    links = "<div>" + "".join(f"<p><a href={i}>a linked headline number {i} of the day</a></p>" for i in range(30)) + "</div>"
    text = "<div>" + "<p>A sentence of plain words that goes on for a while, as articles do.</p>" * 4 + "</div>"
    got = H.main_text(f"<html><body><div>{links}</div><div>{text}</div></body></html>")
    assert "headline" not in got and got.count("A sentence") == 4


def drawn(rng, depth=0):
    """A tree as (tag, items) without implied ends."""
    items = []
    for _ in range(rng.randint(1, 4)):
        if depth < 5 and rng.random() < 0.6:
            items.append(drawn(rng, depth + 1))
        else:
            items.append(" ".join(["word"] * rng.choice([0, 1, 3, 20])))
    return rng.choice(["div", "div", "section", "span", "a" if depth > 2 else "div"]), items


def clean(t):
    """Without empty texts and second ones in a row, which a page cannot hold."""
    out = []
    for i in t[1]:
        if isinstance(i, tuple):
            out.append(clean(i))
        elif i and (not out or isinstance(out[-1], tuple)):
            out.append(i)
    return t[0], out


def plain_choice(tree):
    """The elements chosen, by the definitions, with plain recursion over (tag, items)."""
    def chars(t, linked=False, only=False):
        linked = linked or t[0] == "a"
        return sum(chars(i, linked, only) if isinstance(i, tuple) else (len(i.replace(" ", "")) if linked or not only else 0) for i in t[1])

    def tags(t, kind=None):
        return sum(tags(i, kind) + (kind is None or i[0] == kind) for i in t[1] if isinstance(i, tuple))
    body_chars, body_links = chars(tree), chars(tree, only=True)

    def density(t, linked):
        c, lc, n, ln = chars(t), chars(t, linked, True), tags(t), tags(t, "a")
        if c == 0:
            return 0.0
        base = math.log(c / max(1, c - lc) * lc + body_links / max(1, body_chars) * c + math.e)
        if base <= 1.0:
            return c / max(1, n)
        return c / max(1, n) * math.log(c / max(1, lc) * max(1, n) / max(1, ln)) / math.log(base)

    def total(t, linked):
        linked = linked or t[0] == "a"
        return sum(density(i, linked) if isinstance(i, tuple) else len(i.replace(" ", "")) for i in t[1])

    def walk(t, path, linked):
        yield t, path, linked
        for k, i in enumerate(t[1]):
            if isinstance(i, tuple):
                yield from walk(i, (*path, k), linked or t[0] == "a")
    nodes = [(t, path, density(t, linked), total(t, linked)) for t, path, linked in walk(tree, (), False)]
    by_path = {path: d for _, path, d, _ in nodes}
    best = max(nodes, key=lambda n: n[3])[1]
    least = min(by_path[best[:i]] for i in range(len(best) + 1))
    marked = set()

    def mark(path):
        t, d = next((n[0], n[2]) for n in nodes if n[1] == path)
        if d >= least and chars(t):
            below = [n for n in nodes if n[1][:len(path)] == path]
            marked.add(max(below, key=lambda n: n[3])[1])
            for k, i in enumerate(t[1]):
                if isinstance(i, tuple):
                    mark((*path, k))
    mark(())
    return sorted(p for p in marked if not any(p[:i] in marked for i in range(len(p))))


def nested_links(t, linked=False):
    return linked and t[0] == "a" or any(nested_links(i, linked or t[0] == "a") for i in t[1] if isinstance(i, tuple))


def test_choice_equals_definition():
    rng = random.Random(8)

    def write(t):
        return f"<{t[0]}>" + "".join(write(i) if isinstance(i, tuple) else i for i in t[1]) + f"</{t[0]}>"

    def path_of(node, root):
        path = []
        while node is not root:
            path.append(node.parent.items.index(node))
            node = node.parent
        return tuple(reversed(path))
    done = 0
    for _ in range(400):
        items = drawn(rng)[1]
        tree = clean(("body", items))
        if nested_links(tree):
            continue
        root = H.parse(write(tree)).items[0]
        root.parent = None
        H._cut_marked(root)
        assert sorted(path_of(n, root) for n in H.chosen(root)) == plain_choice(tree)
        done += 1
    assert done > 200


def test_deep_and_long_pages():
    assert H.main_text("<div>" * 20000 + "in" + "</div>" * 20000) == "in"
    assert H.main_text("<article>" + "<p>x</p>" * 50000 + "</article>").count("x") == 50000
    assert H.main_text("<" * 50000).startswith("<") and H.main_text("<a b='" * 3000) != "no"


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (1, "u", "", "x"), (None, None, "plain & text", "x"), (2, "u", "<article>a</article>", "x"),
            (2, "u", "<article>a</article>", "x"), (3, "u", "<nav>only</nav>", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or 0), r.text, r.n_chars) for r in H.extract(pages).collect())
    assert got == [(0, "plain & text", 12), (1, "", 0), (1, "", 0), (2, "a", 1), (2, "a", 1), (3, "", 0)]
    assert H.extract(pages, keep=["page_id", "text", "html"]).columns == ["page_id", "html", "text", "n_chars"]
    assert H.extract(pages.limit(0)).count() == 0


def test_query_equals_article_blocks(spark):
    found = {r.page_id: r for r in QUERIES["op11_html_text"](spark, DATA).collect()}
    pages = spark.read.parquet(f"{DATA}/pages.parquet").collect()
    assert len(found) == len(pages)
    for page in pages:
        body = re.search(r"<article>(.*)</article>", page.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<br>", " ", b).replace("<b>", "").replace("</b>", "")).split())
                  for b in re.split(r"</?(?:p|h1)>", body)]
        text = "\n".join(b for b in blocks if b)
        assert found[page.page_id].text == text and found[page.page_id].n_chars == len(text) and found[page.page_id].url == page.url
