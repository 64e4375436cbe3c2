"""Main text of pages with known articles."""

import html
import re

import numpy as np
import pytest

from stayline.llm import html_text, queries
from stayline.llm.html_text import main_text

LONG = "This paragraph has quite a few words of plain prose, as the body of an article has. " * 3
OTHER = "A second one goes on about the same matter at some length and without any link. " * 3
L, O = LONG.strip(), OTHER.strip()


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p>';</script></head><body>{body}</body></html>"


MENU = "<ul class='main-menu'>" + "".join(f"<li><a href='/{i}'>item {i}</a></li>" for i in range(8)) + "</ul>"
CASES = {
    "article": (f"<nav>{MENU}</nav><article><h1>Head</h1><p>{L}</p><p>Ok.</p><p>{O}</p></article><footer>f</footer>", ["Head", L, "Ok.", O]),
    "unclosed": (f"<article><h1>Head</h1><p><b>{L}<br><p>{O}<p><b>Short.", ["Head", L, O, "Short."]),
    "div soup": (f"<div id=top>{MENU}</div><div class=content><h2>Head</h2><p>{L}</p><p>Yes.</p><p>{O}</p></div><div class=sidebar><p>{L}</p></div>", ["Head", L, "Yes.", O]),
    "body only": (f"<p><a href=a>home</a> <a href=b>news</a></p><h1>Head</h1><p>{L}</p><p>No.</p><p>{O}</p><p><a href=c>x</a></p>", ["Head", L, "No.", O]),
    "comments": (f"<main><h1>Head</h1><p>{L}</p><div id=comments><p>{O}</p></div><p>{O}</p></main>", ["Head", L, O]),
    "inner header": (f"<header><p>{O}</p></header><article><header><h1>Head</h1></header><p>{L}</p></article>", ["Head", L]),
    "inline": (f"<article><p>a<b>b</b> c<br>d &amp; &eacute;&nbsp;&#x41;</p><p>{L}</p></article>", ["ab c d & é A", L]),
    "ads": (f"<article><p>{L}</p><div class='ad-box'>Buy {O}</div><aside>{O}</aside><form><p>{O}</p></form><span class=ad>x</span><p>{O}</p></article>", [L, O]),
    "cookie": (f"<div class='cookieBanner'><p>{O}</p></div><section><h1>Head</h1><p>{L}</p><p>{L}</p></section>", ["Head", L, L]),
    "hidden": (f"<article><p>{L}</p><p style='display: none'>{O}</p><p hidden>{O}</p><p>End.</p></article>", [L, "End."]),
    "list": (f"<article><p>{L}</p><ul><li>one</li><li>two</li></ul><table><tr><td>a</td><td>b</td></tr></table></article>", [L, "one", "two", "a b"]),
}


WRAPS = ["content with-sidebar", "no-sidebar", "has-comments", "page withoutSidebar", "widget", "alert", "social", "search-page", "form"]
ASIDE = f"<div class='sidebar'><p>{O}</p></div><div class='ad'>Buy {O}</div>"
CASES |= {f"wrap {w}": (f"<div class='{w}'><h1>Head</h1><p>{L}</p><p>{L}</p><p>{L}</p></div><div class='comments'><p>{O}</p></div>", ["Head", L, L, L]) for w in WRAPS}
CASES |= {f"hold {w}": (f"<div class='{w}'>{ASIDE}<article><h1>Head</h1><p>{L}</p></article></div>", ["Head", L]) for w in WRAPS}
CASES |= {
    "nested wraps": (f"<div class=widget><div id=social><main><p>{L}</p><div class=share>{O}</div><p>Ok.</p></main></div></div>", [L, "Ok."]),
    "negated": (f"<div class=text><p>{L}</p><div class='no-sidebar has-comments'><p>{O}</p></div><p>{L}</p></div>", [L, O, L]),
    "comment articles": (f"<main><article><p>{L}</p></article><div class=comments><article><p>{O}</p></article><article><p>{O}</p></article></div></main>", [L]),
    "long ad": (f"<div class=ad><p>{O}</p><p>{O}</p></div><article><p>Short.</p></article>", ["Short."]),
    "inner wrap": (f"<main><div class=widget><p>{L}</p><p>{O}</p></div><p>End.</p></main>", [L, O, "End."]),
    "both": (f"<div class='no-sidebar sidebar'><p>{O}</p></div><div class=text><p>{L}</p><p>{L}</p></div>", [L, L]),
}


@pytest.mark.parametrize("name", CASES)
def test_known_pages(name):
    body, blocks = CASES[name]
    assert main_text(page(body)).split("\n\n") == blocks


def test_awkward_pages():
    for text in (None, "", "   ", "<html></html>", "<script>x</script>", "<nav>menu</nav>", "<!-- c -->", "<p"):
        assert main_text(text) in ("", "<p")
    assert main_text("plain words only") == "plain words only"
    assert main_text("<article>" + "<div>" * 3000 + "deep" + "</div>" * 10) == "deep"
    many = "".join(f"<p>{L} {i}</p>" for i in range(3000))
    assert main_text(f"<article>{many}</article>").count("\n\n") == 2999


def test_smoothing_and_threshold():
    flat = html_text.smoothed(np.ones(7), 1.0)
    assert np.allclose(flat, 1)
    x = np.array([0.0, 0, 10, 0, 0])
    w = np.exp(-0.5 * np.arange(-3, 4) ** 2.0)
    want = [sum(w[3 + j - i] * x[j] for j in range(5) if abs(j - i) <= 3) / sum(w[3 + j - i] for j in range(5) if abs(j - i) <= 3) for i in range(5)]
    assert np.allclose(html_text.smoothed(x, 1.0), want)
    assert 2 < html_text.threshold(np.array([1.0, 2, 9, 10])) < 9
    assert html_text.threshold(np.array([4.0, 4])) == 4


def test_frame(spark):
    df = spark.createDataFrame([(1, "<p>x</p>", "t"), (2, None, None), (1, "<p>x</p>", "t")], "page_id int, html string, text string")
    out = html_text.extracted(df, "html")
    assert sorted(tuple(r) for r in out.select("page_id", "text").collect()) == [(1, "x"), (1, "x"), (2, "")]
    assert html_text.extracted(df.filter("1 = 0"), "html").count() == 0


def test_query(spark, folder):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    rows = queries.queries()["op4_text_ratio"](spark, folder).collect()
    assert len(rows) == len(pages)
    for r in rows:
        body = re.search("<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        body = re.sub("<[^>]*>", "", re.sub("<br>", " ", re.sub("</?h1>|</?p>", "\x00", body)))
        blocks = [" ".join(html.unescape(b).split()) for b in body.split("\x00")]
        assert r["text"] == "\n\n".join(b for b in blocks if b)
        assert r["n_chars"] == len(r["text"])


LONG = "A long paragraph of running text with many words, and hardly any tags around them at all. " * 3


def blocks(html):
    return html_text.main_text(html).split("\n\n")


def test_short_lists_and_last_paragraphs_without_an_article():
    long = LONG.strip()
    menu = "<div class=menu><a href=x>Home</a> <a href=y>About</a></div>"
    page = f"{menu}<div class=content><p>{LONG}</p><ul><li>One</li><li>Two</li></ul><p>{LONG}</p></div><footer>c</footer>"
    assert blocks(page) == [long, "One", "Two", long]
    assert blocks(f"<p>{LONG}<p>{LONG}<script>var x</script><p>end") == [long, long, "end"]


def test_lists_of_links_in_an_article():
    related = "<ul><li><a href=1>Another story</a></li><li><a href=2>One more</a></li></ul>"
    page = f"<article><h1>Head</h1><p>{LONG}</p><p>Short.</p>{related}<ul><li>Item</li><li>see <a href=3>it</a> there</li></ul><p>{LONG}</p></article>"
    assert blocks(page) == ["Head", LONG.strip(), "Short.", "Item", "see it there", LONG.strip()]


def test_several_articles():
    pages = "".join(f"<article><h2>Part {i}</h2><p>{LONG}</p></article>" for i in range(3))
    got = blocks(f"<nav><a href=x>x</a></nav><main>{pages}</main>")
    assert got == [b for i in range(3) for b in (f"Part {i}", LONG.strip())]


def test_broken_and_deep_pages_take_linear_time():
    import time

    for page in ("<div>" * 16000 + "</p>" * 16000, "<div><span>" * 8000 + "</section>" * 8000,
                 "".join(f"<div>a few words {i}" for i in range(8000))):
        start = time.time()
        html_text.main_text(page)
        assert time.time() - start < 3
