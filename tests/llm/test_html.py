from __future__ import annotations

import html as entities
import re

import pytest

from gradeframe.llm import html, queries

SF = "/root/testdata/sf0.001"

PARAGRAPHS = [f"Paragraph {i} says a good deal about harbours, tides & the trade of salt." for i in range(6)]
BODY = "".join(f"<p>{entities.escape(p)}" for p in PARAGRAPHS)
NOISE = (
    '<nav><ul><li><a href="/">Home</a><li><a href="/a">Shipping news of the week</a></ul></nav>'
    '<div class="ad">Buy now, only today, at a price that is hard to believe.</div>'
)
TAIL = (
    '<section id="comments"><p>What a lovely text, I have read it twice already.</p></section>'
    '<aside>More about us and about everybody else who works here.</aside>'
    '<form>Your name <input name="n"> and your address</form><footer>&copy; us, all rights reserved</footer>'
)


@pytest.mark.parametrize(
    "page",
    [
        f"<html><body>{NOISE}<article>{BODY}</article>{TAIL}</body></html>",
        f"<body>{NOISE}<div><div>{BODY}</div></div>{TAIL}",
        f"<body>{NOISE}<main><section>{BODY[: BODY.index('<p>Paragraph 3')]}</section><section>{BODY[BODY.index('<p>Paragraph 3'):]}</section></main>{TAIL}",
        f"<body>{NOISE}<div><div>{BODY[: BODY.index('<p>Paragraph 3')]}</div><div>{BODY[BODY.index('<p>Paragraph 3'):]}</div></div>{TAIL}",
        f"<BODY>{NOISE}<ARTICLE>{BODY}<script>if (a</p>) {{}}</script><!-- <p>x --></ARTICLE>{TAIL}",
    ],
)
def test_the_article_and_nothing_else(page):
    assert html.main_text(page) == "\n".join(PARAGRAPHS)


@pytest.mark.parametrize(
    "page",
    [
        f"<html><head><title>t</title><meta charset=x><body>{NOISE}<article>{BODY}</article>{TAIL}",
        f"<head><link rel=x><div><div>{BODY}</div></div>{TAIL}",
        *[f"<body>{NOISE}<div class='{c}'><div>{BODY}</div></div>{TAIL}" for c in ("content no-sidebar", "post has-banner", "elementor-widget elementor-widget-text", "sidebar-wrapper")],
        f"<body><form id=aspnetForm>{NOISE}<div><div>{BODY}</div></div>{TAIL.replace('form', 'div class=respond')}</form>",
        f"<body><form><div class=social><a href=x>Share</a></div><div class=menu>{NOISE}</div><div>{BODY}</div></form>",
    ],
)
def test_wrappers_and_open_heads_keep_the_article(page):
    assert html.main_text(page) == "\n".join(PARAGRAPHS)


def test_long_comments_are_no_article():
    remarks = "<article>" + "<p>I have read this and have something long to say about it.</p>" * 40 + "</article>"
    page = f"<body><article>{BODY}</article><section id=comments>{remarks}</section>"
    assert html.main_text(page) == "\n".join(PARAGRAPHS)


def test_heading_and_lead_beside_the_body_stay():
    page = f"<body>{NOISE}<div><h1>The title</h1><p>A short lead.</p><div class=body>{BODY}</div></div>{TAIL}"
    assert html.main_text(page) == "\n".join(["The title", "A short lead.", *PARAGRAPHS])


LEFT = "\n".join(PARAGRAPHS)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<main><header><h1>Headline</h1></header>{BODY}</main>", f"Headline\n{LEFT}"),
        (f"<div><h1>T</h1><div class=body>{BODY}</div><h2>End</h2><p>A last word.</p></div>", f"T\n{LEFT}\nEnd\nA last word."),
        (f"<div><div class=body>{BODY}</div><p>A last word.</p><p>&copy; 2020 us</p><h2>More</h2><ul><li><a href=x>y</a></ul></div>", f"{LEFT}\nA last word."),
        (f"<body><div><div>{BODY}</div></div><p>A last word.</p><p>See <a href=x>us</a> here.</p>", f"{LEFT}\nA last word."),
        (f"<main><article>{BODY}</article><p>x</p><article>{BODY}</article></main>", f"{LEFT}\n{LEFT}"),
        (f"<div><article><a href=x>Teaser</a></article><article>{BODY}</article><article><p>Short one.</p></article></div>", LEFT),
        *[
            (f"<article>{BODY}<section {name}><h2>Part</h2><p>Its share rose to a third.</p></section></article>", f"{LEFT}\nPart\nIts share rose to a third.")
            for name in ("id=related-work", "class='market-share'", "class='x legal-notice-history'")
        ],
        (f"<div><div>{BODY}<h2 id=share-prices>Prices</h2><p class=market-share>It fell.</p></div></div>", f"{LEFT}\nPrices\nIt fell."),
        *[
            (f"<article>{BODY}<div class={name}>{inside}</div></article>", LEFT)
            for name, inside in (
                ("share-buttons", "<a href=x>Share it</a> <a href=y>Post it</a>"),
                ("share-this", "Share this article"),
                ("related-posts", "<h3>Read on</h3><ul><li><a href=x>Another text.</a></ul>"),
                ("legal-notice", "All of this is under the law of the land."),
                ("cookie-notice", "We use cookies, as everybody does."),
                ("comment-list", "What a lovely text this is."),
            )
        ],
    ],
)
def test_all_of_the_article_and_no_furniture(page, text):
    page = page if page.startswith("<body>") else f"<body>{NOISE}{page}{TAIL}"
    assert html.main_text(page) == text


def test_blocks_and_white_space():
    page = "<article><h1> A \n title</h1><p>one<b>two</b>\tthree<br>four<ul><li>x<li>y &lt;z&gt;</ul>tail<p></p></article>"
    assert html.main_text(page) == "A title\nonetwo three four\nx\ny <z>\ntail"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("", ""),
        ("no markup at all", "no markup at all"),
        ("a < b and c", "a < b and c"),
        ("<p>open", "open"),
        ("</p></div>x", "x"),
        ("<!-- never closed <p>x", ""),
        ("<script>never closed", ""),
        ('<p class="a>b">q</p>', "q"),
        ("<div class=menu>only a menu</div>", ""),
        ("&amp;amp; &#x41;&#66;&nbsp;C", "&amp; AB C"),
    ],
)
def test_odd_pages(page, text):
    assert html.main_text(page) == text


def test_long_pages_are_read_whole():
    page = "<article>" + "".join(f"<p>number {i}</p>" for i in range(30_000)) + "</article>"
    assert html.main_text(page).split("\n") == [f"number {i}" for i in range(30_000)]
    deep = "<div>" * 5000 + "deep text" + "</div>" * 5000
    assert html.main_text(deep) == "deep text"


def test_rows_stay_rows(spark):
    rows = [(None, "u", None, "t", 1), (1, None, "", "t", 1), (1, "v", f"<article>{BODY}</article>", "t", 1)] * 2
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string, main int")
    got = html.extract(df)
    assert got.columns == ["page_id", "url", "main", "text"]
    expected = [(None, "u", 1, ""), (1, None, 1, ""), (1, "v", 1, "\n".join(PARAGRAPHS))] * 2
    assert sorted(map(str, (tuple(r) for r in got.collect()))) == sorted(map(str, expected))
    assert html.extract(df.filter("false")).count() == 0


def test_registered_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.op3_html(spark, SF).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search("<article>(.*?)</article>", pages[r.page_id].html, re.S)[1]
        pieces = re.sub("<(?:h1|/h1|p|/p)>", "\0", article).replace("<b>", "").replace("<br>", " ").split("\0")
        blocks = [" ".join(entities.unescape(p).split()) for p in pieces]
        assert r.text == "\n".join(b for b in blocks if b)
        assert (r.url, r.n_chars) == (pages[r.page_id].url, len(r.text))
