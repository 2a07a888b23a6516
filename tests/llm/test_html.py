"""Main-text extraction."""

import html as stdlib
import re

import duckdb

from tabulon.llm import html
from tabulon.llm.html import main_text

PAGE = """<!doctype html><html><head><title>no</title><style>p{}</style></head><body>
<header><h1>Site</h1><nav><a href=/>home</a></nav></header><div class="cookie-banner">We use cookies</div>
<article><h1>Head&amp;line</h1><p>First <b>par</b>a&nbsp;graph<br>line
 two.<p>Second.<ul><li>one<li>two</ul><div class="ad">Buy!</div><form><label>mail</label></form><script>var t="</p>";</script>
<aside>related</aside><p>Caf&eacute; &#x1F389; last</p></article>
<section id="comments"><article><p>I am a long reader comment that goes on and on and on and on and on and on and on.</p></article></section>
<div class="sidebar">side</div><footer>&copy; foot</footer>"""


def test_page():
    assert main_text(PAGE) == "Head&line First para graph line two. Second. one two Café \U0001f389 last"


def test_no_article():
    page = ("<html><body><div id=top-menu>a b c</div><div id=content><h2>T</h2><p>" + "words and more words " * 20 + "</p><p>end.</p></div>"
            "<div class='site-footer'>x</div></body></html>")
    assert main_text(page) == ("T " + "words and more words " * 20).strip() + " end."


def test_edges():
    assert main_text(None) == main_text("") == main_text("<p></p>") == main_text("<nav>x</nav>") == ""
    assert main_text("plain &lt;text&gt;  here") == "plain <text> here"
    assert main_text("<p>a<p>b") == "a b"
    assert main_text("<div><p>x</div></p></span>y") == "x y"
    assert main_text("<article><p>un<i>closed <b>tags") == "unclosed tags"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    assert main_text(deep) == "deep"
    assert len(main_text("<article><p>" + "word " * 200_000 + "</article>")) == 999_999


def test_given_pages():
    for (page,) in duckdb.sql("SELECT html FROM '/root/testdata/sf0.001/pages.parquet'").fetchall():
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        text = re.sub(r"<[a-zA-Z/!][^>]*>", "", re.sub(r"</?(p|br|h1)[^>]*>", " ", inner))
        assert main_text(page) == " ".join(stdlib.unescape(text).split())


def test_dataframe(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "old"), (2, None, None, "old"), (2, None, None, "old"), (3, "v", "", None)], "page_id int, url string, html string, text string")
    out = html.extract_text(df)
    assert out.columns == ["page_id", "url", "text"]
    assert sorted((r["page_id"], r["text"]) for r in out.collect()) == [(1, main_text(PAGE)), (2, ""), (2, ""), (3, "")]
    assert html.extract_text(df.limit(0)).count() == 0
