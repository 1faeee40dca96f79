from __future__ import annotations

import html as entities
import re

import pytest

from plugtide.llm import html, queries
from tests.llm.helpers import SF

TREE = html.trained_tree()
P = "<p>" + "a plain sentence of the article with words " * 4 + "</p>"
KEPT = " ".join(("a plain sentence of the article with words " * 4).split())


def test_tree_knows_its_table():
    assert all(html.decide(TREE, row[:-1]) == row[-1] for row in html.LABELLED)


@pytest.mark.parametrize(
    "page, text",
    [
        (None, ""),
        ("", ""),
        ("   ", ""),
        ("<article><h1>T &amp; &#x41;&lt;b&gt;</h1><p>one<br>two <b>th</b>ree</p></article>", "T & A<b> one two three"),
        (f"<nav><a href=/>Home</a></nav><article>{P}</article><footer>&copy; all of it</footer>", KEPT),
        (f"<article>{P}<section class='comments'>{P}</section><form>{P}</form>", KEPT),
        (f"<header>{P}</header><main>{P}</main><aside>{P}</aside><div id=cookie-notice>{P}</div>", KEPT),
        (f"<div class=\"ad\">{P}</div><div class='post-content'>{P}</div><div role=complementary>{P}</div>", KEPT),
        (f"<article>{P}<script>if (a<b) x('</article>{P}')</script><style>p{{}}</style></article>", KEPT),
        (f"<!-- <article> {P} --><article>{P}<!-- {P}", KEPT),
        ("<article><p>un<i>closed<p>next</article></div></p></b>", "unclosed next"),
        ("<article><p title='a>b'>x</p><p>y<", "x y<"),
        ("<article><p>5 < 6 and 7 > 3</p><p>a \n b</p></article>", "5 < 6 and 7 > 3 a b"),
        ("<ARTICLE><P>Upper</P></ARTICLE><NAV>x</NAV>", "Upper"),
        (f"<div><h2>A heading of the page</h2>{P}<p>Short one.</p>{P}</div>", f"A heading of the page {KEPT} Short one. {KEPT}"),
        (f"<div id='content'><h1>Title</h1>{P}<p>End.</p></div><div class='ad-box'>{P}</div>", f"Title {KEPT} End."),
        (f"<div style='display:none'>{P}</div><article>{P}</article>", KEPT),
        # Names that tell an article's subject, or what else a page has.
        (f"<article class='post category-legal'>{P}</article>", KEPT),
        (f"<main><article class='tag-social'>{P}</article></main>", KEPT),
        (f"<main><article class='post legal comments-open'>{P}</article></main>", KEPT),
        (f"<div id='content' class='with-sidebar'><article>{P}</article></div>", KEPT),
        (f"<div class='has-ads'><div class='entry'>{P}</div><div class='ads'>{P}</div></div>", KEPT),
        (f"<main>{P}<div class='related-work'><h2>Related work</h2>{P}</div></main>", f"{KEPT} Related work {KEPT}"),
        (f"<main>{P}<div class='related-posts'><h2>More</h2>{P}</div></main>", KEPT),
        (f"<main>{P}<div class='related-links'><a href=/>One more page of these</a></div></main>", KEPT),
        (f"<article>{P}<article class='comment-body'>{P}</article><ul class=replies><li>{P}</ul></article>", KEPT),
        # Elements without text of the page, closed and not.
        (f"<article>{P}<button>Go<p>{P}</article><footer>{P}</footer>", f"{KEPT} {KEPT}"),
        (f"<article>{P}<button>Go <b>on</b><div>{P}</div></button><select><option>x<option>y</select>{P}</article>", f"{KEPT} {KEPT}"),
        (f"<article><svg><title>t</title><svg></svg>{P}</svg>{P}<object><br>{P}</article>", f"{KEPT} {KEPT}"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page, TREE) == text


def test_given_pages(spark):
    """The given pages mark their article."""
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in queries.op2_html_extraction(spark, SF).collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", pages[r.page_id], re.S)[1]
        plain = re.sub(r"<[^>]*(>|\Z)", " ", re.sub(r"</?b>", "", inner))
        assert r.text == " ".join(entities.unescape(plain).split()) and r.n_chars == len(r.text)


def test_odd_rows(spark):
    rows = [(1, "u", None, "x"), (None, None, "", "x"), (2, "u", f"<article>{P * 3000}", "x"), (2, "u", "<article>q", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.url or "", r.n_chars) for r in html.extract(pages).collect())
    assert got == [("1", "u", 0), ("2", "u", 1), ("2", "u", 3000 * (len(KEPT) + 1) - 1), ("None", "", 0)]
    assert html.extract(pages.filter("false")).collect() == []
