"""Main-text extraction on hand-made pages and on the test table."""

import html
import re
import time

import duckdb

from fleetzone.llm import html_main as H

SF = "/root/testdata/sf0.001"


def test_article_without_furniture():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><a href=x>menu</a></nav><div class="ad">buy, buy, buy, buy</div>
    <div id=cookie-notice>We use cookies, many, many.</div><aside>side, side, side</aside>
    <article><header><h1>A &amp; B</h1></header><p><b>First,&nbsp;text   of
    it.<br>Next<p>Second &lt;x&gt; &eacute;&#233;&copy no end<ul><li>one<li>two</ul>
    <form><input name=q><button>Go</button></form><blockquote>Quote, said.</blockquote>
    <table><tr><td>c1<td>c2</table><!-- gone --><p>Last</p></article>
    <section id="comments"><p>Great, great, great, great, great article, thanks!</p></section>
    <footer>&copy; site</footer></body></html>"""
    assert H.extract(page) == "\n".join([
        "A & B", "First, text of it. Next", "Second <x> éé© no end", "one", "two", "Quote, said.", "c1", "c2", "Last"])


def test_scored_container_without_article():
    page = """<body><div class=menu><a href=1>Home, sweet, home</a></div><div id=wrap><h2>Title</h2>
    <div class=part><p>Short one, yes.</p></div><div class=part><p>A longer paragraph, with commas, and words, to win.</p></div>
    </div><div class="sidebar"><p>Other, other, other, other, other, other, other</p></div></body>"""
    assert H.extract(page) == "Title\nShort one, yes.\nA longer paragraph, with commas, and words, to win."


def test_layout_classes_and_named_furniture():
    page = """<body><div id=page class="layout sidebar-right"><div class="page-header">Site name</div>
    <article><div class="article-body"><p>Kept, text.</p></div><div class="post-comments"><div class="comment-body">no, no</div>
    </div><div class="no-sidebar"><p>Kept too.</p></div><p class="cookie-notice">no</p></article>
    <div class="sidebar-content"><p>side, side, side, side, side, side, side, side</p></div></div></body>"""
    assert H.extract(page) == "Kept, text.\nKept too."


def test_link_density_discounts():
    page = """<body><div><p><a href=1>link, link, link, link, link, link, link, link, link</a></p></div>
    <div><p>The real text, here.</p><p>And more of it.</p></div></body>"""
    assert H.extract(page) == "The real text, here.\nAnd more of it."


def test_edge_cases():
    assert H.extract(None) == "" and H.extract("") == "" and H.extract("<html></html>") == ""
    assert H.extract("just text &amp; more") == "just text & more"
    assert H.extract("<body>a < b <p>c") in ("a < b\nc", "c")
    assert H.extract("<article><p>" + "word, " * 50000 + "</p></article>") == ("word, " * 50000).strip()
    assert H.extract("<article>" + "<div>" * 3000 + "deep" + "</div>" * 3000 + "</article>") == "deep"
    assert H.extract("<p>unclosed <script>x < y") == "unclosed"
    assert H.extract("<article><p>a</p><div class=comment-list><p>no, no, no</p></div><p>b</p></article>") == "a\nb"


def test_every_test_page_gives_its_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in H.main_text(pages).collect()}
    rows = duckdb.connect().execute(f"select page_id, url, html from '{SF}/pages.parquet'").fetchall()
    assert len(got) == len(rows)
    for i, url, page in rows:
        body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", "\n"))
        want = "\n".join(t for t in (" ".join(html.unescape(x).split()) for x in parts) if t)
        assert got[i] == (url, want, len(want))


def test_nulls_extra_columns_and_empty_table(spark):
    df = spark.createDataFrame([(1, None, None, "x"), (None, "u", "<p>a, b</p>", "y"), (1, None, None, "x")],
                               "page_id long, url string, html string, text string")
    got = sorted(((r.page_id or -1), r.url, r.text, r.n_chars) for r in H.main_text(df).collect())
    assert got == [(-1, "u", "a, b", 4), (1, None, "", 0), (1, None, "", 0)]
    assert H.main_text(df.limit(0)).collect() == []


BODY = "<p>" + "The article has a sentence, and another one follows here. " * 5 + "</p>"


def test_no_text_is_lost():
    """Stray signs, pages wrapped in a form, names judged by one word, unclosed frames."""
    assert H.extract("<p>When a<b it's small, fine.</p><p>Middle</p><p>That's the end") == "When a\nMiddle\nThat's the end"
    want = H.extract(f"<body>{BODY * 3}</body>")
    assert len(want) > 800
    for page in (f"<body><form id=f><div>{BODY * 3}</div><input></form></body>",
                 f"<body><section class='share-price'>{BODY * 3}</section><div class='footer-links'><p>Less</p></div></body>",
                 f"<body><div class='legal-analysis'>{BODY * 3}</div></body>",
                 f"<body><iframe src=x><div>{BODY * 3}</div></body>", f"<body><svg><div>{BODY * 3}</div></body>",
                 f"<body><div title='a > b, c' data-x=\"1>2\">{BODY * 3}</div></body>"):
        assert H.extract(page) == want, page[:60]


def test_furniture_goes():
    """Small forms, shared links and reader comments, however long these are."""
    comments = "<section class=discussion>" + "<p>Reader remark, with many words, and more of them than the article.</p>" * 40 + "</section>"
    for extra in ("<form class=x><p>Your name, please.</p></form>", "<div class='share-bar'><p>Tell it, share it.</p></div>",
                  comments, comments.replace("discussion", "comments"), comments.replace("discussion", "reader-replies")):
        assert H.extract(f"<body><div>{BODY * 3}</div>{extra}</body>") == H.extract(f"<body><div>{BODY * 3}</div></body>")
    inside = H.extract(f"<body><article>{BODY}<section class=discussion><p>Results, discussed.</p></section></article></body>")
    assert inside.endswith("Results, discussed.")


def test_hostile_pages_take_linear_time():
    """100,000 nested, unclosed, stray or half quoted tags."""
    n = 100_000
    pages = ["<div>" * n + "text, here", "<span class=a>" * n + "x", "<a b='c>t" * n, "<a b=\"c>t" * (n + 1), "<div>a, b" * n,
             "<li><ul>" + "<div>" * (n // 2) + "<li></li>" * (n // 2), "<b><div>" + "<span>" * (n // 2) + "</b>" * (n // 2),
             "<span>" * (n // 2) + "<hr>" * (n // 2), "<div class=nav-x>" * (n // 2) + "<h1>a</h1>" * (n // 2), "<iframe>" * n,
             "<!--" * n, "<!-- a -->b" * n, "<" * n, "<blockquote>a, b c" * n, "<!x" * n, "<a " + "=" * n, "<body>" * n]
    for page in pages:
        began = time.process_time()
        H.extract(page)
        assert time.process_time() - began < 8, page[:20]         # the squares took minutes
