"""Main text of pages, and the cut behind it."""

import itertools
import random
import time

from tallyworks.llm import html_cut

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="page">
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu one</a><li><a href="/b">Menu two</a></ul></nav>
<div class="cookie-notice"><p>We use cookies on this site, as every site does.</p></div><!-- ad --><div class="ad">Buy now!</div>
<article><header class="article-header"><h1>Title &amp; more</h1></header><p><b>First&nbsp;para<br>of   text.<p>Second &lt;para&gt; with a <a href=x>link</a>.</p>
<aside>Aside</aside><ul><li>item one</li><li>item two</li></ul><form><label>Name</label><input name=a></form><table><tr><td>a<td>b</table><p>Last.</p>
<section id="comments"><article class="comment"><p>A reader says that this is a fine text, really.</p></article></section></article>
<div class="sidebar"><p>Related stories, and a long text that could be content by its length alone.</p></div><footer><p>&copy; all</p></footer>"""


def test_article_without_the_rest():
    assert html_cut.main_text(PAGE) == "\n".join(["Title & more", "First para of text.", "Second <para> with a link.", "item one", "item two", "a", "b", "Last."])


def test_page_without_an_article_element():
    page = (
        "<body><ul class=menu><li><a href=x>Home</a><li><a href=y>News</a></ul><div id=content><h2>Head</h2>"
        "<p>A plain text of a page that is long enough to be taken for its content.</p><p>Short.</p></div><div class=footer>c 2020</div>"
    )
    assert html_cut.main_text(page) == "Head\nA plain text of a page that is long enough to be taken for its content.\nShort."


def test_wrappers_with_layout_classes_keep_the_article():
    text = "<h2>Head</h2><p>A plain text of a page that is long enough to be taken for its content.</p><p>It has a second paragraph, too.</p>"
    want = "Head\nA plain text of a page that is long enough to be taken for its content.\nIt has a second paragraph, too."
    rest = "<div class=sidebar><p>Related stories, and a long text.</p></div><section id=comments><article><p>A reader says this.</p></article></section>"
    for open_, close in (
        ('<main class="content has-sidebar">', "</main>"), ('<div id="page" class="has-sidebar"><main>', "</main></div>"), ('<article class="post no-comments">', "</article>"),
        ('<div id="page" class="has-sidebar"><article>', "</article></div>"), ('<div class="search form"><main>', "</main></div>"), ('<main class="sidebar">', "</main>"),
        ('<div class="more"><article>', "</article></div>"), ('<div class="content sidebar-right"><article>', "</article></div>"),
    ):
        assert html_cut.main_text(f"<body><nav>Menu</nav>{open_}{text}{close}</body>") == want, open_
        if "more" not in open_:
            assert html_cut.main_text(f"<body><nav>Menu</nav>{open_}{text}{close}{rest}</body>") == want, open_
    assert html_cut.main_text(f'<div id="page" class="has-sidebar">{text}{rest[:62]}</div>') == want
    # a part inside the wrapper stays what it says
    assert html_cut.main_text(f'<div class="has-sidebar"><main>{text}<div class="share">Share this text with all.</div></main></div>') == want


def test_odd_markup():
    assert html_cut.main_text("") == ""
    assert html_cut.main_text("<p") == html_cut.main_text("<!-- open <p>x") == html_cut.main_text("<script>x") == ""
    assert html_cut.main_text("<article><p title='a>b'>one<p>two</div></span>three") == "one\ntwo\nthree"
    assert html_cut.main_text("<article><p>1 < 2 and 3 > 2.</p></article>") == "1 < 2 and 3 > 2."
    long = "<article>" + "<p>word</p>" * 5000
    assert html_cut.main_text(long).count("\n") == 4999


def test_unclosed_quotes_and_raw_text():
    assert html_cut.main_text("<article><p>one<a 'x>y' <b 'u>v' two") == "oney' v' two"
    assert html_cut.main_text("<article><script>if (a < b) { '</p>' }</script><p>one<style>p > a</style><p>two<!-- <p>no --><p>three") == "one\ntwo\nthree"
    assert html_cut.main_text("<article><p>one <3 two<!-- open <p>x") == "one <3 two"


def test_long_odd_pages_take_no_square_of_time():
    start = time.perf_counter()
    deep = "<div class='share box'>some words here" * 10_000
    assert html_cut.main_text(deep) == "" and html_cut.main_text("<main>" + "<div>word" * 10_000).count("word") == 10_000
    assert html_cut.main_text("<article>" + "<div>" * 5000 + "</span></b>x</p>" * 20_000 + "</article>").count("x") == 20_000
    for odd in ("<a href='", "<a 'x>y' ", "<!", "<b", "</", "<p \"", "<script>", "<![CDATA["):
        html_cut.main_text("<article><p>text</p>" + odd * 30_000)
    assert time.perf_counter() - start < 20


def test_cut_is_minimal():
    chance = random.Random(2)
    for _ in range(200):
        n = chance.randint(1, 7)
        gain = [chance.uniform(-2, 2) for _ in range(n)]
        ties = {(a, b): chance.uniform(0, 2) for a in range(n) for b in range(a + 1, n) if chance.random() < 0.5}
        cost = lambda keep: sum(abs(g) for g, k in zip(gain, keep, strict=True) if (g > 0) != k) + sum(w for (a, b), w in ties.items() if keep[a] != keep[b])
        best = min(map(cost, itertools.product([False, True], repeat=n)))
        assert abs(cost(html_cut.minimum_cut(gain, ties)) - best) < 1e-6


def test_rows(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y")], "page_id long, url string, html string, text string")
    rows = html_cut.extract(pages).collect()
    assert sorted((r.page_id or 0, r.url or "", r.n_chars) for r in rows) == [(0, "", 0), (1, "u", rows[0].n_chars), (1, "u", rows[0].n_chars), (2, "v", 0)]
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_cut.extract(pages.where("false")).count() == 0
