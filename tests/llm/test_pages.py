"""Main text of pages: the reader, the style tree against a recursive one, templates, awkward input."""

import html as H
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_data import rows_of

from docflow.llm import dom, styletree

WORDS = "river stone light paper glass tree north field engine quiet harbor signal copper lantern meadow orbit".split()


def text_of(html):
    return dom.Page(html).main_text()


@pytest.mark.parametrize(
    "html,text",
    [
        ("", ""),
        ("just text &amp; more", "just text & more"),
        ("<p>a\n b&nbsp;c<br>d <b>e</b>f<p>g", "a b c d ef\n\ng"),
        ("<html><head><title>t</title><p>late head", "late head"),
        ("<body><nav>m</nav><article><header><h1>T</h1></header><p>x<form>f<input></form><p>y</article><p>outside</body>", "T\n\nx\n\ny"),
        ("<main>a<article>b</article>c</main>", "b"),
        ("<div class='page-header'>h</div><div id=content>c<div class=relatedPosts>r</div></div><div>z</div>", "c"),
        ("<article>a <span class='ad-slot'>buy</span> b<section id=comments><article>c1</article></section></article>", "a b"),
        ("<article><ul><li>1<li>2</ul><table><tr><td>3<td>4<tr><td>5</table></article>", "1\n\n2\n\n3\n\n4\n\n5"),
        ("<article>a<script>var x='</p><p>';</script>b<style>p{}</style><!-- c --><noscript>n</noscript></article>", "ab"),
        ("<article>a<button>x<div>y</div></article>z", "a"),
        ("<article>1 < 2 &copy; &#x41; &bogus; <unknown>u</unknown></article>", "1 < 2 © A &bogus; u"),
        ("<div role=navigation>n</div><p>t<footer>f", "t"),
        ("</p></div><div>a</span></p>b</div>", "a\n\nb"),
        ("<div class='content has-sidebar'><p>t</p><div class='sidebar'>s</div></div>", "t"),
        ("<form id=aspnetForm><div class='menu-open'><main><p>t</p><form>f</form></main><p>x</p></div></form>", "t"),
        ("<div id=sidebar-left-layout><nav>n</nav><article>a</article></div><section class=comments><article>c</article></section>", "a"),
        ("<form><p>f</p></form><p>t</p><div class='cookieNotice'><p>c</p></div>", "t"),
    ],
)
def test_main_text_of_single_pages(html, text):
    assert text_of(html) == text


def test_very_deep_and_very_long_pages():
    deep = "<div>" * 30_000 + "core" + "</div>" * 30_000
    assert text_of(deep) == "core"
    long = "<article>" + "".join(f"<p>{w} {i}" for i, w in enumerate(WORDS * 5_000)) + "</article>"
    assert text_of(long).count("\n\n") == len(WORDS) * 5_000 - 1


# ---------------------------------------------------------------- the tree, by recursion


def brute_low(pages, threshold, min_pages):
    """``{node}`` by a recursive composite importance over explicit trees of one host."""
    distinct = [dom.Page(h) for h in sorted(set(pages))]
    site = styletree._site("h")
    in_pages, styles, texts, above, root = Counter(), defaultdict(Counter), defaultdict(Counter), defaultdict(set), None
    size = {}
    for p in distinct:
        _, nodes, shown, of_text = p.keys(site)
        root = nodes[0][0]
        for n in {n for n, _, _ in nodes}:
            in_pages[n] += 1
        for n, s, _ in nodes:
            above[s].add(n)
        for s, n, k in set(shown):
            styles[n][s] += 1
            size[s] = k
        for n, t in {(n, t) for n, (_, t) in zip(of_text, p.blocks, strict=True)}:
            texts[n][t] += 1
    low = set()

    def visit(n):
        """Importance of ``n`` and the most of any element at or below it."""
        m = in_pages[n]
        if n in texts:
            return (1 - sum(math.log(c, m) for c in texts[n].values()) / len(texts[n])) if m > 1 else 1.0, 0.0
        total = sum(styles[n].values())
        spread = -sum(c / total * math.log(c / total, m) for c in styles[n].values()) if m > 1 else 1.0
        children, most = 0.0, 0.0
        for s, c in styles[n].items():
            below = [visit(x) for x in above[s]]
            children += c / total * sum(i for i, _ in below) / max(1, size[s])
            most = max([most, *(b for _, b in below)])
        rest = 0.9 ** len(styles[n])
        importance = (1 - rest) * min(1.0, spread) + rest * children
        most = max(most, importance)
        if most < threshold and m >= min_pages:
            low.add(n)
        return importance, most

    visit(root)
    return low


def site(n, rng, article=False, notice="qx1"):
    """Pages of one template whose class names tell nothing."""
    out = []
    for i in range(n):
        words = [" ".join(rng.choice(WORDS) for _ in range(rng.randint(5, 12))) + f" {i}" for _ in range(rng.randint(1, 5))]
        body = "".join(f"<p>{w}</p>" for w in words)
        inner = f"<h2>{words[0]}!</h2>{body}<div class={notice}><p>Read our terms</p></div>"
        kept = "\n\n".join([f"{words[0]}!", *words])
        main = f"<article>{inner}</article>" if article else f"<div class=zz>{inner}</div>"
        out.append((f"<body><div class=k9><ul><li>Home<li>About us</ul></div>{main}<div class=w3>Made by nobody</div>", kept))
    return out


def test_low_branches_equal_the_recursion(spark):
    rng = random.Random(6)
    pages = [h for h, _ in site(25, rng)] + ["<p>odd one</p>", "", "plain"] + ["<div class=k9><p>a<div class=w3>x</div></div>"] * 4
    pages += ["<div class=k9>" + "<ul><li>Home</ul>" * (i % 3) + "</div>" for i in range(9)]
    df = spark.createDataFrame([("h", h) for h in pages + pages[:10]], "host string, html string").repartition(4)
    for threshold in (0.1, 0.25, 0.6):
        got = {r["node"] % (1 << 64) for r in styletree.low_branches(df, threshold, 5).collect()}
        assert got == brute_low(pages, threshold, 5)
        assert got


@pytest.mark.parametrize("max_broadcast", [100_000, 0])
def test_repeated_branches_go_whatever_their_names(spark, max_broadcast):
    rng = random.Random(9)
    plain, named = site(30, rng), site(30, rng, article=True)
    rows = [(i, f"http://user@A.example:80/p{i}", h) for i, (h, _) in enumerate(plain)]
    rows += [(100 + i, f"https://b.example/{i}?x#y", h) for i, (h, _) in enumerate(named)]
    rows += [(200 + i, "https://b.example/copy", named[0][0]) for i in range(40)]  # copies of one page change nothing
    got = styletree.extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string"), max_broadcast=max_broadcast)
    found = {r["page_id"]: r["text"] for r in got.collect()}
    assert found == {i: t for i, (_, t) in enumerate(plain)} | {100 + i: t for i, (_, t) in enumerate(named)} | {200 + i: named[0][1] for i in range(40)}


def test_an_article_on_every_page_stays(spark):
    same = "<nav>{}</nav><article><h1>One title</h1><p>The same article</p></article><footer>f</footer>"
    rows = [(i, "http://c.example/", same.format(i)) for i in range(30)]
    bare = [(50 + i, "http://d.example/", f"<div>The same text</div><!-- {i} -->") for i in range(30)]
    got = styletree.extract_main_text(spark.createDataFrame(rows + bare, "page_id long, url string, html string"))
    assert {r["text"] for r in got.where("page_id < 50").collect()} == {"One title\n\nThe same article"}
    assert {r["text"] for r in got.where("page_id >= 50").collect()} == {"The same text"}  # never a page's whole text


def test_awkward_rows(spark):
    rows = [
        (1, "http://e.example/", None, "k", 1), (2, None, "<p>a", None, 2), (None, "not a url", "<article>b", "k", 3), (4, "http://e.example/", "", "k", None),
        (4, "http://e.example/", "<br><hr><p></p>", "k", 5), (5, "http://e.example/", "<p>a &#128512; b", "x", 6), (5, "http://e.example/", "<p>a &#128512; b", "x", 6),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string, `row` int")
    got = styletree.extract_main_text(df)
    assert got.columns == ["page_id", "url", "html", "row", "text", "n_chars"]
    assert rows_of(got, "row", "text", "n_chars") == sorted(
        [(1, "", 0), (2, "a", 1), (3, "b", 1), (5, "", 0), (6, "a 😀 b", 5), (6, "a 😀 b", 5), (None, "", 0)], key=lambda r: tuple((v is None, v) for v in r)
    )
    empty = styletree.extract_main_text(df.where("page_id > 100"))
    assert empty.count() == 0 and empty.dtypes == got.dtypes


def test_query_equals_the_articles_of_the_tables_pages(spark):
    from docflow.llm.queries import op12_html_extraction

    sf = "/root/testdata/sf0.01"
    found = {r["page_id"]: (r["text"], r["n_chars"]) for r in op12_html_extraction(spark, sf).collect()}
    pages = spark.read.parquet(f"{sf}/pages.parquet").collect()
    assert len(found) == len(pages)
    for p in pages:
        article = re.search(r"<article>(.*?)</article>", p["html"], re.S).group(1)
        blocks = [" ".join(H.unescape(re.sub(r"<[^>]+>", " ", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        text = "\n\n".join(b for b in blocks if b)
        assert found[p["page_id"]] == (text, len(text))
