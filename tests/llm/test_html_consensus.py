import pytest
from pyspark.sql import functions as F

from lexitally.llm.html_consensus import extract, host
from lexitally.llm.html_pages import main_text, votes

LONG = "This is a sentence of the article, with some words in it, and it goes on. " * 3


def site(i, body, url="https://www.news.example/{}/story.html"):
    page = f"""<!DOCTYPE html><html><head><title>t{i}</title><style>p {{}}</style></head><body class="page p{i}">
    <header class="site-header"><a href="/">Home</a> Site name</header><nav><ul><li><a href="/a">Section</a></li></ul></nav>
    <div class="cookie-notice">We use cookies, as everybody does, and you have to agree to it all here.</div>
    {body}
    <aside class="sidebar">Most read, most shared, and other things that are not in the article at all.</aside>
    <section id="comments"><h3>Comments</h3><p>{LONG} Says a reader, {LONG} and another {LONG}</p></section>
    <footer>&copy; All rights, as ever, are reserved by somebody who is not the author.</footer><script>var a = "<p>no</p>";</script></body></html>"""
    return i, url.format(i), page


def article(i):
    return f"""<div id="c{i}" class="content post-{i}"><h1>Title {i}</h1><p>{LONG}</p><div class="ad-slot">Buy this, now, it is very good for you and all.</div>
    <p>Caf&eacute; &amp;\n <b>bold</b>ly<br>new&nbsp;line<form><input value="x">Subscribe, please, to our letter here.</form><ul><li>One<li>Two</ul></div>"""


def test_article_without_the_rest(spark):
    pages = spark.createDataFrame([site(i, article(i)) for i in range(6)], "page_id long, url string, html string")
    for r in extract(pages).collect():
        body = " ".join(LONG.split())
        assert r.text == f"Title {r.page_id} {body} Café & boldly new line One Two"


def test_consensus_beats_a_page_that_misleads(spark):
    """One page's own best container is a long box; the host's path finds its short article."""
    box = f'<div class="box"><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div>'
    short = '<div class="content post-9"><h1>Short</h1><p>Brief news.</p></div>'
    rows = [site(i, article(i)) for i in range(5)] + [site(9, box + short)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in extract(pages).collect()}[9] == "Short Brief news."
    alone = spark.createDataFrame([(9, None, rows[-1][2])], "page_id long, url string, html string")
    assert extract(alone).first().text.startswith("This is a sentence")


@pytest.mark.parametrize("source", [
    "", " ", "<", "<>", "plain text", "<p", "<p class='", "<!--", "<script>", "</p></div>", "<div><p>a<div>b</p>c", "<b><i>x</b>y</i>", "a &lt;b&gt; &#x41; &bogus; &",
    "<div>" * 3000 + "deep" + "</div>" * 10, "<p><b>" * 2000 + "open", "<a href=\"x>y</a>", "<table><tr><td>a<td>b<tr><td>c</table>",
])
def test_broken_pages_do_not_crash(source):
    votes(source)
    assert isinstance(main_text(source, "html>body>article"), str)


def test_some_results():
    assert main_text("a &lt;b&gt; &#x41; &bogus; &", None) == "a <b> A &bogus; &"
    assert main_text("<table><tr><td>a<td>b<tr><td>c</table>", None) == "a b c"
    assert main_text("<p>in<b>li</b>ne<p>next", None) == "inline next"
    assert main_text("<script>if (a < b) {}</script>text<style>x</style>", None) == "text"


def test_odd_rows(spark):
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "<p>x"), (None, "https://h.example/", None), (3, "not a url", "<p>x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit(1) for c in ("host", "path", "text", "_host")})
    found = sorted((r.page_id is None, r.page_id, r.text) for r in extract(pages).collect())
    assert found == [(False, 1, ""), (False, 2, ""), (False, 3, "x"), (False, 3, "x"), (True, None, "")]
    assert extract(pages.limit(0)).count() == 0
    hosts = spark.createDataFrame([("HTTPS://User@Www.A.example:80/x",), ("//b.example?q",), ("mailto:x",)], "u string").select(host(F.col("u"))).collect()
    assert [r[0] for r in hosts] == ["www.a.example", "b.example", None]


def test_deep_containers_have_paths_of_their_own():
    source = "<div>" * 70 + f"<p>Not the article: {LONG}</p>" + "<div>" * 5 + f"<p>{LONG}</p><p>{LONG}</p><p>{LONG}</p>" + "</div>" * 75
    path = votes(source)[0][0]
    assert main_text(source, path) == " ".join((LONG * 3).split())
    assert len({p for p, _ in votes(source)}) == len(votes(source))
    assert votes(source.replace("<div>", '<div class="a">', 1))[0][0] != path


def test_all_containers_vote(spark):
    """The article is the fourth container of every page, and the only one that the pages share."""
    names = "abcdefgh"
    rows = []
    for i in range(8):
        boxes = "".join(f'<div class="wrap-{names[i]}{b}"><div class="box-{names[i]}{b}">' + f"<p>{LONG}</p>" * 3 + "</div></div>" for b in "xyz")
        rows.append((i, f"https://h.example/{i}", f'<html><body>{boxes}<div class="outer"><div class="content"><p>{LONG}</p><p>Article {i}</p></div></div></body></html>'))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    for r in extract(pages).collect():
        assert r.text == " ".join(LONG.split()) + f" Article {r.page_id}"
