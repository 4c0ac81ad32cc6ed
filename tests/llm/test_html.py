"""Extraction on layouts that mislead, and its cost on hostile pages."""

import time

import pytest

from lectern.llm import html

ARTICLE = "".join(f"<p>Sentence {i} of the article, with some length to it, and then a little more of that.</p>" for i in range(3))
NAMED = ['class="content has-sidebar"', 'class="col side-by-side"', 'class="post comments-open"', 'class="entry no-footer"', 'id="page-with-nav"', 'class="post-header-article"']


def text(page):
    p = html.Page(page)
    return p.text(p.best())


@pytest.mark.parametrize("name", NAMED)
def test_names_that_mention_a_part(name):
    page = f'<body><nav><a href=x>Home</a></nav><div {name}>{ARTICLE}</div><div class="sidebar"><p>In the margin.</p></div><div class="site-footer"><p>Imprint and so on.</p></div></body>'
    got = text(page)
    assert got.count("Sentence") == 3 and "margin" not in got and "Imprint" not in got


@pytest.mark.parametrize("name", NAMED)
def test_such_a_part_within_the_article(name):
    page = f'<body><div class="post"><p>The lead of it all, a sentence of its own that says a thing or two.</p><div {name}>{ARTICLE}</div><div class="comment-list"><p>First!</p></div></div></body>'
    got = text(page)
    assert got.count("Sentence") == 3 and "First!" not in got


def test_parts_by_name():
    for name in ("sidebar", "ad", "comments", "cookie-notice", "nav-menu", "related-posts-list", "article-comments", "social-links"):
        got = text(f'<body><div class="story">{ARTICLE}<div class="{name}"><p>This is something else, it is.</p></div></div></body>')
        assert got.count("Sentence") == 3 and "something else" not in got, name
    # nothing but such a part: its text is the page's
    assert text(f'<body><div class="sidebar">{ARTICLE}</div></body>').count("Sentence") == 3


@pytest.mark.parametrize("page", ['<a href="' * 40_000, '<a href="' * 40_001 + ">", "<a \"'" * 40_000 + ">x", "<div>" * 20_000 + "x", "<b>" * 20_000 + "<p>x" * 2_000, "</i>" * 30_000 + "<i>" * 30_000, '<x "' + "<y '>" * 50_000])
def test_hostile_pages_cost_linear_time(page):
    began = time.perf_counter()
    text(page)
    assert time.perf_counter() - began < 3


def test_deep_and_long_pages_are_whole():
    deep = "<div>" * 3_000 + "<p>" + "Deep text, all of it. " * 10 + "</p>" + "</div>" * 3_000
    assert text(deep).startswith("Deep text") and len(html.Page(deep).path[-1]) <= 1100
    long = "<article>" + "".join(f"<p>Paragraph {i} of many, whole.</p>" for i in range(20_000)) + "</article>"
    assert text(long).count("\n\n") == 19_999


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "http://h/", f"<article>{ARTICLE}</article>", "x", "y", 3)], "page_id long, url string, html string, host string, path string, n int")
    got = html.extract(df).collect()[0]
    assert got["text"].count("Sentence") == 3 and list(got.asDict()) == ["page_id", "url", "text", "n_chars"]
