import html
import random
import re
import time

import pytest

from vaultfeed.llm import density, queries

P1 = "The first paragraph has a good many words, so that it is dense, as the paragraphs of an article usually are."
P2 = "The second one follows it with some more words, a <a href='/x'>link</a> and a <b>bold</b> word &amp; an entity."
P3 = "Short end."
TEXT = [P1, "The second one follows it with some more words, a link and a bold word & an entity.", P3]
NAV = "<nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>"
FOOT = "<footer>&copy; 2024 Somebody, all rights reserved. <a href=/i>Imprint</a></footer>"
PARAGRAPHS = f"<p>{P1}</p><p>{P2}</p>\n<p>{P3}</p>"


def blocks(page):
    return density.extract(page).split("\n\n")


@pytest.mark.parametrize(
    "body",
    [
        f"{NAV}<article>{PARAGRAPHS}</article>{FOOT}",
        f"{NAV}<main><div>{PARAGRAPHS}</div></main>{FOOT}",
        f"{NAV}<div id=wrap><div class=content>{PARAGRAPHS}</div><div class='sidebar left'><p>{P1}</p></div></div>{FOOT}",
        f"<div class=header><a href=/>Site</a></div><div>{PARAGRAPHS}</div><div class=footer><p>{P1}</p></div>",
        f"<div role=navigation>{P1}</div>{PARAGRAPHS}<div id='cookie-notice'><p>We use cookies. {P1}</p><button>OK</button></div>",
        f"<article>{PARAGRAPHS}<section id=comments><h3>Comments</h3><article>{P1}</article><article class=comment>{P1}</article></section></article>",
        f"<article><script>var x = '</p><p>no';</script>{PARAGRAPHS}<form><label>Mail</label><input value=x><textarea>{P1}</textarea></form></article>",
        f"<article><style>p{{}}</style><!-- <p>{P1}</p> -->{PARAGRAPHS}<div class='ad-slot'>{P1}</div><aside>{P1}</aside></article>",
        f"<div><table><tr><td><a href=/1>One</a><td><a href=/2>Two</a></table></div><div><div>{PARAGRAPHS}</div><div><a href=/3>More</a> <a href=/4>Next</a></div></div>",
        f"<form id=aspnet><main>{PARAGRAPHS}</main></form>",
        f"<div class='page has-sidebar'>{PARAGRAPHS}</div><div class=related><article>{P1}</article></div>",
        f"<p>{P1}<p>{P2}<p>{P3}",
        f"<article class='post share-count'><h1></h1>{PARAGRAPHS}<div class=share><a href=/f>Share</a></div></article>",
    ],
)
def test_article_without_what_stands_around_it(body):
    for page in (f"<!doctype html><html><head><title>{P1}</title></head><body>{body}</body></html>", body):
        assert blocks(page) == TEXT


def test_split_articles_and_headings():
    two = f"{NAV}<div><h2>Head</h2><div class=s1>{PARAGRAPHS}</div><h2>Next</h2><div class=s2>{PARAGRAPHS}</div></div>{FOOT}"
    assert blocks(two) == ["Head", *TEXT, "Next", *TEXT]


def test_blocks_and_white_space():
    page = "<article>loose <i>te</i>xt\n\n here<p>a<br>b&nbsp; c</p><ul><li>one<li>two</ul><table><tr><td>x<td>y<tr><th>z</table><pre>k\n  l</pre>5 < 6 &lt;b&gt; &#x41;&eacute;</article>"
    assert blocks(page) == ["loose text here", "a b c", "one", "two", "x y", "z", "k l", "5 < 6 <b> Aé"]


@pytest.mark.parametrize("page", ["", " ", "<", "<p", "<!--", "<script>x", "<a title='", "</", "<html></html>", "<nav>a</nav>", "<p>\x00</p >", "&", "<body><body>"])
def test_odd_pages(page):
    assert isinstance(density.extract(page), str)


def test_head_without_end():
    assert blocks(f"<head><meta charset=utf-8><title>T</title><body>{PARAGRAPHS}") == TEXT
    assert blocks(f"<head><title>T</title>{PARAGRAPHS}") == TEXT
    assert blocks("just text without markup") == ["just text without markup"]


def test_long_and_deep_pages_take_linear_time():
    start = time.perf_counter()
    for unit in ("<div>x", "<p><b>x", "<li>x", "<a <b ", "<!-- ", '<p a="', "</x>", "<table><tr><td>x", "&amp;", "<p><table><div>", "< "):
        density.extract(unit * 20_000)
    assert time.perf_counter() - start < 30
    deep = "<div>" * 2000 + P1 + "</div>" * 2000
    assert blocks(deep) == [P1]


def test_nothing_of_an_article_is_lost(seed=7):
    """Against a plain reading of generated articles: every paragraph of any length and link share, in order."""
    dice = random.Random(seed)
    for _ in range(200):
        paragraphs = []
        for _ in range(dice.randint(1, 12)):
            words = [dice.choice(["alpha", "b", "<i>c</i>", "<a href='#'>link word</a>", "&amp;&lt;", "é", "many\nlines"]) for _ in range(dice.choice((1, 3, 30, 200)))]
            paragraphs.append(" ".join(words))
        inner = "".join(dice.choice(("<p>{}</p>", "<p>{}", "<div>{}</div>", "<li>{}</li>", "<h2>{}</h2>", "<blockquote><p>{}</p></blockquote>")).format(p) for p in paragraphs)
        want = [" ".join(html.unescape(re.sub("<[^>]*>", "", p)).split()) for p in paragraphs]
        assert blocks(f"<body>{NAV}<div class=ad>{P1}</div><article>{inner}</article>{FOOT}") == want


def test_query_equals_plain_reading(spark, sf, con):
    """The given pages by cutting out their article element."""
    want = {}
    for page_id, url, page in con.sql("select page_id, url, html from pages").fetchall():
        inner = re.search("<article>(.*?)</article>", page, re.S)[1]
        cut = [" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", inner)]
        text = "\n\n".join(filter(None, cut))
        want[page_id] = (url, text, len(text))
    got = {r.page_id: (r.url, r.text, r.n_chars) for r in queries.op13_main_text(spark, sf).collect()}
    assert got == want
    assert {r[0]: tuple(r[1:]) for r in con.sql(density.SQL).fetchall()} == want


def test_awkward_rows(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (4, "u", "<p>" + "long " * 100_000), (5, "u", "<p>x"), (5, "u", "<p>x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted(((r.page_id, r.url, r.text[:5], r.n_chars) for r in density.main_text(df).collect()), key=str)
    assert got == sorted([(1, "u", "", 0), (2, None, "", 0), (None, "u", "x", 1), (4, "u", "long ", 499_999), (5, "u", "x", 1), (5, "u", "x", 1)], key=str)
    assert density.main_text(df.limit(0)).count() == 0
