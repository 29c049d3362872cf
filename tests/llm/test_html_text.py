"""Main text of web pages: the given template against a regular expression, and pages of other shapes."""

import html
import re

import pytest
from pyspark.sql import functions as F

from demandlake.llm.html_text import extracted, main_text

SF = "/root/testdata/sf0.01"


def by_template(page: str) -> str:
    """The given pages hold one article of headings and paragraphs, some of them not closed."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<b>", "").replace("</b>", "").replace("<br>", " "))
    return "\n".join(t for t in (" ".join(html.unescape(b).split()) for b in blocks) if t)


def test_given_pages_match_their_template(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    want = {r.page_id: by_template(r.html) for r in pages.collect()}
    got = extracted(pages).collect()
    assert len(got) == len(want)
    for r in got:
        assert r.text == want[r.page_id] and r.n_chars == len(r.text)


LONG = "One sentence, with commas, that is long enough to look like an article. " * 5
AROUND = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="top-menu"><ul><li><a href=x>Home</a></ul></div>
<div class="cookie-notice"><p>We use cookies, and more, and more, and more.</p></div>%s
<div id="comments"><div class="comment"><p>""" + "A comment, longer than the article, really, " * 90 + """</p></div></div>
<form><p>Name, mail, and the rest.</p></form><footer>Imprint, contact</footer><script>if (a < b) x = "<p>no</p>";</script></body>"""


@pytest.mark.parametrize("article, text", [
    ("<div class=text><h2>Head &amp; line</h2><p>%s<p>Short<br>line&nbsp;end.<ul><li>one<li>two</ul></div>" % LONG,
     "Head & line\n%s\nShort line end.\none\ntwo" % LONG.strip()),
    ("<article><header><h1>T</h1></header><section><p>%s</p></section><section><p>x</p></section><aside>y</aside></article>" % LONG,
     "T\n%s\nx" % LONG.strip()),
    ("<article><p>a</p><pre>b\n  c</pre><table><tr><td>d<td>e<tr><td>f</table></article>", "a\nb c\nd e\nf"),
    ("<div class=post><div class=c><p>%s</p></div><div class=c><p>x</p></div><div><a href=y>All %s</a></div></div>" % (LONG, LONG),
     "%s\nx" % LONG.strip()),
    ("<main>%s<br><br>x &lt; y &#8364; &notin; &am</main>" % LONG, LONG.strip() + " x < y € ∉ &am"),
])
def test_article_without_its_surroundings(article, text):
    assert main_text(AROUND % article) == text


def test_reader_comments_marked_as_articles_go():
    page = "<article class=story><p>%s</p><article class='comment reply'><p>%s</p></article></article>" % (LONG, "no, " * 500)
    assert main_text(page) == LONG.strip()


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), (" \n", ""), ("just <b>te</b>xt", "just text"), ("<p>a</p", "a"), ("a <3 b < c", "a <3 b < c"), ("<!-- x", ""),
    ("<p>a</p>b</p>c", "a\nb\nc"), ("<script>x", ""), ("<nav>only a menu</nav>", ""), ("<div class=ad>all there is</div>", "all there is"),
    ("<p title='a>b'>t</p>", "t"), ("<P>one<P>two", "one\ntwo"),
])
def test_small_pages(page, text):
    assert main_text(page) == text


def test_long_pages_take_linear_time():
    for page in ("<div>" * 50_000 + "x", "<p>" * 50_000 + "x", "<b><p>" * 30_000 + "x", "<li>" * 50_000 + "x", "x, " * 300_000):
        assert main_text(page).endswith("x" if page.endswith("x") else "x,")


def test_nulls_repeats_empty_table_and_other_columns(spark):
    rows = [(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>"), (None, None, None), (2, None, "<p>" + "é " * 600_000 + "</p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash")).withColumn("n_chars", F.lit(7))
    got = sorted(((r.page_id or 0, r.url, r.text[:3], r.n_chars) for r in extracted(pages).collect()), key=str)
    assert got == [(0, None, "", 0), (1, "u", "a", 1), (1, "u", "a", 1), (2, None, "é é", 1_199_999)]
    assert extracted(pages.limit(0)).count() == 0
