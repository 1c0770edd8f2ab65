"""Main text of pages: made pages with known articles, and the test table."""

import re
from html import unescape

from tally.llm import queries
from tally.llm.html_consensus import extract_main_text, parse_page

SF = "/root/testdata/sf0.01"
PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><article>no</article>";</script></head><body class="x1">
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="cookie-notice">We use cookies, lots and lots of them, every single day.</div>
<div id="page-{n}"><div class="post-{n}"><h1>Title &amp; {n}</h1><p>First para<b>graph</b> of <i>text</i>,<br>with&nbsp;a break.<p>Second
 one{more}.<div class="share">Share this</div><section class="comments"><p>A reader says a good deal here, at length.</p></section></div>
<aside><p>Related things that you could also read if you wanted to.</p></aside></div><form><input><p>Sign up</p></form>
<footer><p>&copy; nobody, all the rights in the world reserved</p></footer></body></html>"""


def test_made_pages(spark):
    rows = [(n, f"https://H.example/{n}", PAGE.format(n=n, more=" and more" * n)) for n in range(4)]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(4):
        assert got[n] == f"Title & {n} First paragraph of text, with a break. Second one{' and more' * n}."


def test_the_host_decides(spark):
    """A page whose notice is longer than its article is read by the path of its host's other pages."""
    page = "<body><div class=art><p>{}</p></div><div class=extra><p>{}</p></div></body>"
    rows = [(n, "http://a.b/x", page.format("long article text " * 9, "short")) for n in range(5)]
    rows += [(9, "http://a.b/y", page.format("brief", "very long extra thing " * 30)), (10, None, page.format("brief", "longer than brief"))]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[9] == "brief" and got[10] == "longer than brief"


def test_broken_pages():
    for html, text in [("", ""), ("plain", "plain"), ("<p>a<p>b", "a b"), ("<p>a &am", "a &am"), ("a <b>b</b>c", "a bc"), ("<body><p>x", "x"),
                       ("<div><p>x</div></div></p>y", "x y"), ("a<!-- b", "a"), ("a<script>b", "a"), ("<p>a</p><foo bar='", "a"),
                       ("<article><p>one</p><p class='ad'>two<p>three</article>", "one three"), ("a < b > c", "a < b > c")]:
        page = parse_page(html)
        assert page.text(None) == text, html


def test_classes_of_ordinary_pages():
    """A class that names a state or a builder's part isn't boilerplate; a page is never emptied by classes."""
    text = "<p>The text of the page.</p>"
    for html in [f'<body class="no-sidebar">{text}', f'<body class="has-sidebar">{text}', f'<body class="modal-open">{text}', f'<body id="search">{text}',
                 f'<article class="post comments-open">{text}</article>', f'<main class="search hidden x">{text}</main>',
                 f'<div class="elementor-widget-text-editor">{text}</div>', f'<div class="page has-sidebar">{text}</div>',
                 f'<body><div class="modal-open">{text}</div>', f'<body><div id="menu" class="x hidden">{text}</div>']:
        assert parse_page(html).text(None) == "The text of the page.", html
    for html in [f'<div class="{c}"><p>Not this.</p></div>{text}' for c in ("sidebar", "cookie-notice", "ad_top", "x comments", "x hidden y")]:
        assert parse_page(html).text(None) == "The text of the page.", html
    assert parse_page("<nav>Home</nav><div hidden>no</div>").text(None) == ""


def test_whole_articles(spark):
    """Headline, lead and differently classed parts of an article belong to it; what a main element holds beside a small part doesn't."""
    long, more = "long text of the article " * 20, "more of the article " * 10
    parts = f"<div class=a><p>{long}</p></div><div class=b><p>{more}</p></div>"
    want = {0: f"Head {long}", 1: f"{long} {more}", 2: f"Head Lead {long} {more}", 3: f"{long} {more} {long}", 4: f"Head {long}", 5: "one two"}
    pages = {0: f"<article><h1>Head</h1><div class=entry><p>{long}</p></div></article><div>Other</div>", 1: f"<article>{parts}</article><div>Other</div>",
             2: f"<main><h1>Head</h1><p>Lead</p><article>{parts}</article></main><div>Other</div>",
             3: f"<main>{parts}<div class=c><p>{long}</p></div></main><div>Other</div>",
             4: f"<div role=article><h1>Head</h1><div class=entry><p>{long}</p></div></div><div>Other</div>",
             5: f"<main><article>one</article><article>two</article><div class=x>{'<a>linked</a> <br>' * 30}</div></main>"}
    rows = [(n, f"http://{n}.example/", html) for n, html in pages.items()]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in pages:
        assert got[n] == " ".join(want[n].split()), n


def test_within_an_article():
    """Its header with the headline stays, and what a class merely names; what it marks as boilerplate goes; teasers don't win."""
    text = "the text of the article " * 4
    for html, want in [
            (f"<header>Site</header><article><header><h1>Title</h1></header><p>{text}</p></article>", f"Title {text}"),
            (f'<article><div class="header-image"><p>caption</p></div><p>{text}</p></article>', f"caption {text}"),
            (f'<article><div class="social-policy"><p>On policy.</p></div><p>{text}</p></article>', f"On policy. {text}"),
            (f'<article><p>{text}</p><div class="share-buttons">Share</div><div class="related-posts">More</div><div class="comments">He says</div></article>', text),
            (f'<article><p>{text}</p></article><article class="related"><p>{text * 3}</p></article>', text),
            (f'<main><header><h1>Title</h1></header><div class="ad">Buy</div><p>{text}</p></main>', f"Title {text}"),
            (f'<article class="post hidden"><p>{text}</p></article>', text)]:
        assert parse_page(f"<body>{html}</body>").text(None) == " ".join(want.split()), html


def test_deep_nesting_stays_small():
    """50,000 containers in each other, with paths kept by parent, and stray end tags: no square of time or memory."""
    import time
    import tracemalloc

    html = "".join(f'<div class="row-{i % 7}">' for i in range(50_000)) + "<p>deep text</p>" + "</section>" * 50_000
    tracemalloc.start()
    began = time.time()
    page = parse_page(html)
    votes = page.votes()
    assert page.text(next(iter(votes))) == "deep text" and all(len(p) < 1000 for p in votes)
    assert tracemalloc.get_traced_memory()[1] < 200 << 20 and time.time() - began < 60
    tracemalloc.stop()


def test_paths_of_one_vote_tie_by_name(spark):
    rows = [(1, "http://t/1", "<body><div class=a><p>first</p></div></body>"), (2, "http://t/2", "<body><div class=b><p>other</p></div></body>"),
            (3, "http://t/3", "<body><div class=a><p>aaaaa</p></div><div class=b><p>bbbbb</p></div></body>")]
    got = {r["page_id"]: r["text"] for r in extract_main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {1: "first", 2: "other", 3: "bbbbb"}


def test_empty_container_at_the_winning_path():
    assert parse_page("<body><article></article><div><p>text</p></div>").text("body>article") == "text"


def test_edges(spark):
    schema = "page_id long, url string, html string, host string, path string, text string"
    long_page = "<article>" + "<p>some words here</p>" * 20_000 + "</article>"
    rows = [(1, None, None, "h", "p", "t"), (2, "", "", None, None, None), (None, "http://x/", "<p>a</p>", "", "", ""),
            (4, "http://x/", long_page, "", "", ""), (4, "http://x/", long_page, "", "", "")]
    got = [(r["page_id"], len(r["text"]), r["host"]) for r in extract_main_text(spark.createDataFrame(rows, schema)).collect()]
    assert sorted(got, key=repr) == sorted([(1, 0, "h"), (2, 0, None), (None, 1, ""), (4, 320_000 - 1 - 20_000 + 20_000, ""), (4, 319_999, "")], key=repr)
    assert extract_main_text(spark.createDataFrame([], schema)).count() == 0


def test_table(spark):
    html = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op6_consensus_html(spark, SF).collect():
        article = re.search(r"<article>(.*?)</article>", html[r["page_id"]], re.S)[1]
        article = re.sub(r"</?(b|i|a|em)>", "", re.sub(r"</?(p|h1|br)>", " ", article))
        want = " ".join(unescape(article).split())
        assert r["text"] == want and r["n_chars"] == len(want)
