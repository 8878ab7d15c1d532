"""Main texts of pages: the given pages against their article element, hand-made layouts, broken mark-up and odd rows."""

import html
import math
import re

import pytest

from rostrum.llm import main_text
from rostrum.llm.main_text import Page

P = ["The first paragraph of the article is long enough to say something about its subject, with a <a href='/x'>link</a> in it.",
     "A second one follows &amp; goes on for a while: quite a few words more, so that its density is that of running text.",
     "Short one.", "The last paragraph closes the article with a sentence of ordinary length, and then some more words."]
PLAIN = " ".join(html.unescape(re.sub("<[^>]*>", "", p)) for p in P)
MENU = "<ul>" + "".join(f"<li><a href='/{i}'>Menu entry {i}</a></li>" for i in range(8)) + "</ul>"
LEGAL = "We use cookies to give you the best experience, and our partners do so too. By going on you agree to all of this without a limit. " * 3


def body(inner, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>Title</title><style>p{{}}</style><script>var a='<p>no</p>';</script></head><body>{before}{inner}{after}</body></html>"


ARTICLE = "<h1>The headline</h1>" + "".join(f"<p>{p}</p>" for p in P)
WANT = "The headline " + PLAIN


@pytest.mark.parametrize("source", [
    body(f"<article>{ARTICLE}</article>", f"<nav>{MENU}</nav><!-- <p>no</p> -->", "<footer>&copy; someone</footer>"),
    body(f"<main><article>{ARTICLE}</article><aside><p>{LEGAL}</p></aside></main>", f"<header><h1>The site</h1>{MENU}</header>", f"<footer><p>{LEGAL}</p></footer>"),
    body(f"<div id='content'>{ARTICLE}</div>", f"<div class='top-menu'>{MENU}</div><div class='cookie-notice'><p>{LEGAL}</p></div>", f"<div id=siteFooter>{LEGAL}</div>"),
    body(f"<div><div>{ARTICLE}</div></div>", f"<div>{MENU}</div>", f"<div>{MENU}</div><div>Imprint</div>"),
    body(f"<form id='aspnetForm' class='page'><div class='main-content with-sidebar'>{ARTICLE}</div><div class='sidebar'><p>{LEGAL}</p></div></form>"),
    body(f"<article>{ARTICLE}<div class='ad'>{LEGAL}</div></article>", "", "<section id='comments'><article class='comment'><p>" + "I agree. " * 200 + "</p></article></section>"),
    body(f"<article><form><p>{LEGAL}</p><input></form>{ARTICLE}<p hidden>{LEGAL}</p><p style='display: none'>{LEGAL}</p></article>"),
    body(f"<table><tr><td>{MENU}<td>{ARTICLE}<td class=advert>{LEGAL}</table>"),
    body("<article>" + ARTICLE.replace("</p>", "").replace("<p>", "<P CLASS=x title='a hidden > b'>") + "</article>").replace("</body></html>", ""),
    body("<article><section>" + ARTICLE.replace("<p>Short", "</section><section><p>Short") + "</section></article>", f"<nav>{MENU}</nav>"),
    body(f"<noscript>{LEGAL}</noscript><textarea>{LEGAL}</textarea><select><option>{LEGAL}</select><article>{ARTICLE}"),
])
def test_layouts(source):
    assert main_text.main_text(source) == WANT


def test_broken_markup():
    text = main_text.main_text
    assert text("<p>a<![bogus foo]]>b</p>") == "ab" and text("<![ [") == "" and text("plain &lt;b&gt; text\n  1 < 2") == "plain <b> text 1 < 2"
    assert text("<p>a<br>b<b>c</b>d<wbr>e</p><p>f") == "a bcde f" and text("x&#0;&#xD800;&bogus;&ampy") == "x��&bogus;&y"
    assert text('<p title="never closed>one</p><p>two</p><!-- no --><p>three') == "one two three"
    assert text("<p>one<script>never closed <p>two") == "one" and text("<p>one<!-- never closed <p>two") == "one" and text("</p></div><p>x</i>y") == "xy"
    assert text(None) == text("") == text(" \n ") == text("<nav>only</nav>") == text("<a") == ""
    deep = "<div>" * 50_000 + "deep" + "<b>" * 50_000
    assert text(deep) == "deep" and text("<p>" + "word " * 300_000) == " ".join(["word"] * 300_000)
    assert text("<p>" + "<a '" * 20_000) == "" and text("<" * 50_000 + "1").endswith("<1")


def test_densities_by_the_definition():
    """The formula on a small tree, written out."""
    c, lc, t, lt, share = 120, 20, 4, 1, 0.25
    want = c / t * math.log(c / lc * t / lt) / math.log(math.log(c / (c - lc) * lc + share * c + math.e))
    assert main_text._density(c, lc, t, lt, share) == want and main_text._density(c, 0, t, 0, 0.0) == 30 and main_text._density(0, 0, 0, 0, 0.5) == 0
    page = Page("<div><p>a<p>b<ul><li>c<li>d</ul></div>e")
    assert page.tag == ["body", "div", "p", "p", "ul", "li", "li"] and page.parent == [-1, 0, 1, 1, 1, 4, 4] and page.last == [6, 6, 2, 3, 6, 5, 6]
    assert [x for x in page.texts if x[1]] == [(2, "a"), (3, "b"), (5, "c"), (6, "d"), (0, "e")]


def test_given_pages(spark):
    """All given pages hold one article element; a plain reading of it is the expected text."""
    def plain(source):
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", source, re.S)[1]
        return " ".join(html.unescape(re.sub("<[^>]*>", "", re.sub(r"</?(?:p|h1|br|div|li|ul)\b[^>]*>", " ", inner))).split())
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {r.page_id: plain(r.html) for r in pages.collect()}
    got = main_text.extract(pages).collect()
    assert {r.page_id: r.text for r in got} == want and len(got) == pages.count() and all(r.n_chars == len(r.text) for r in got)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "<p>a \U0001F600", "y"), (2, "u", "", None), (2, "u", "<p>b", None), (2, "u", "<p>b", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = main_text.extract(df)
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(
        [(1, "u", "", 0), (None, None, "a \U0001F600", 3), (2, "u", "", 0), (2, "u", "b", 1), (2, "u", "b", 1)], key=repr)
    assert main_text.extract(df.limit(0)).count() == 0
