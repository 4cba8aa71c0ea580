"""Main text of real and made pages."""

from __future__ import annotations

import html
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyroom.llm.html_text import extracted, main_text

PROSE = "A long first paragraph of the story goes here with some more text in it."


def test_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    rows = {r.page_id: r for r in extracted(pages).collect()}
    for page in pages.collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.DOTALL)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        expected = "\n".join(b for b in blocks if b)
        got = rows[page.page_id]
        assert (got.url, got.text, got.n_chars) == (page.url, expected, len(expected))


def test_edges(spark):
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>x"), (3, "v", "<p>a</p>" * 20000), (3, "v", "<p>a</p>" * 20000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'x' as text", "1 as n_chars", "2 as _text"
    )
    got = sorted(map(tuple, extracted(pages).collect()), key=str)
    long = "\n".join(["a"] * 20000)
    assert got == sorted(
        [(1, "u", "", 0), (2, None, "", 0), (None, "u", "x", 1), (3, "v", long, 39999), (3, "v", long, 39999)], key=str
    )
    assert extracted(pages.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f'<div><a href="x">Home</a> <a>About</a></div><p>{PROSE}</p><p>End.</p><div class="side-bar sidebar">Buy</div>',
         f"{PROSE}\nEnd."),
        (f"<header><h1>Site</h1></header><article><header><h1>Title</h1></header><p>{PROSE}</p>"
         f"<section id=comments><p>First!</p></section></article><aside>More</aside>", f"Title\n{PROSE}"),
        (f"<article><p>{PROSE}<script>if (a < b) document.write('<p>no</p>')</script> Tail.</p></article>",
         f"{PROSE} Tail."),
        (f"<main><p>{PROSE}</p><form><label>Mail</label><input name=a></form><div class='cookie-notice'>OK?</div></main>",
         PROSE),
        (f"<nav><ul><li>left open<article><p>{PROSE}</p></article>", PROSE),
        ("<article><p>a &lt;b&gt; &amp; &eacute;&nbsp;&#x4e2d;\n\t c</p></article>", "a <b> & é 中 c"),
        ("<article><p>one <b>bold</b><i>er</i> word<br>next<hr/>last</article>", "one bolder word\nnext\nlast"),
        ("<article><p>x<!-- <p>hidden</p> -->y</p><p>   </p></article>", "xy"),
        ("", ""), ("<div class=ad>Buy now</div>", ""), ("plain text", "plain text"), ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<article><ul><li><a>linked item</a></li></ul></article>", "linked item"),
    ],
)
def test_made_pages(page, text):
    assert main_text(page) == text


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<nav>", "</nav>", "<a", "'", '"', ">", "<!--", "-->", "<script>",
                                 "</script>", "x y", "&lt;", "<article>", "</article>", "</", "<br/>", "<div class='ad'>",
                                 "</div>"]), max_size=40).map("".join))
def test_any_markup_gives_clean_lines(page):
    text = main_text(page)
    assert all(line and line == " ".join(line.split()) for line in text.split("\n")) or text == ""


def test_time_follows_length():
    for piece in ("<a '", "<!-", "<p", "</nav", "<script>", "&", "<div class=\"ad\">"):
        main_text(piece * 20000)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        # The post is no article, its comments are.
        (f"<div><h1>Title</h1><p>{PROSE}</p><p>{PROSE}</p></div><ol class=comments><li><article class=comment><p>First!</p>"
         f"</article><li><article><p>{PROSE}</p></article></ol>", f"Title\n{PROSE}\n{PROSE}"),
        (f"<article class=comment><p>First!</p></article><p>{PROSE}</p>", PROSE),
        # Text outside a named article counts for less, but a long one is there.
        (f"<p>Hello.</p><article><p>{PROSE}</p></article><p>Bye.</p>", PROSE),
        (f"<div><p>{PROSE * 9}</p></div><article><p>Teaser {PROSE}</p></article>", f"{PROSE * 9}\nTeaser {PROSE}"),
        (f"<aside><article>Other</article></aside><article><p>Lead.</p><p>{PROSE * 9}</p></article>",
         f"Lead.\n{PROSE * 9}"),
    ],
)
def test_line_blocks_decide_on_pages_with_articles(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p class=notice>Moved<p>First<p>Second</article>", "First\nSecond"),
        ("<article><p class=notice>Moved<h2>Head</h2>First</article>", "Head\nFirst"),
        ("<article><ul><li class=ad>Buy<ul><li>x</ul>y<li>one<li>two</ul><p>End</article>", "one\ntwo\nEnd"),
        ("<article><dl><dt>a<dd class=ad>Buy<dt>b<dd>c</dl></article>", "a\nb\nc"),
        ("<article><table><tr><td class=ad>Buy<td>one<tr class=ad><td>no<tr><td>two</table></article>", "one\ntwo"),
        ("<article><div><p class=ad>Buy</div><p>one</article>", "one"),
        (f"<html><head><title>T</title><meta name=a><body><p>{PROSE}", PROSE),
        (f"<head><noscript><p>no</p></noscript><link rel=a><p>{PROSE}", PROSE),
    ],
)
def test_end_tags_may_be_left_out(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<div class='content has-sidebar'><p>{PROSE}</p></div>", PROSE),
        (f"<div id=main class=no-comments><p>{PROSE}</p></div>", PROSE),
        (f"<div class='sidebar-layout'><p>{PROSE}</p><p>{PROSE}</p></div>", f"{PROSE}\n{PROSE}"),
        (f"<article class='hentry category-social tag-search'><p>{PROSE}</p></article>", PROSE),
        (f"<article><h2 id='related-work'>Related</h2><h2 id='search-algorithms'>Search</h2><p id='notice-3'>{PROSE}</p>"
         "</article>", f"Related\nSearch\n{PROSE}"),
        (f"<article><p>{PROSE}</p><section id='related-work'><p>{PROSE * 9}</p></section></article>",
         f"{PROSE}\n{PROSE * 9}"),
        (f"<article><p>{PROSE}</p><div class=related>{PROSE}</div><p class=notice>Moved</p></article>", PROSE),
    ],
)
def test_labels_are_a_weight(page, text):
    assert main_text(page) == text


LEAD, LONG = "A lead of some length. " * 9, "A very long paragraph. " * 220
NAV = "<ul><li><a href=x>Home page</a><li><a href=y>All other pages</a></ul>"


@pytest.mark.parametrize(
    ("page", "lines"),
    [
        (f"<h1>Title</h1><p>{LEAD}</p><div class=ad>Buy</div><p>{LONG}</p>", ["Title", LEAD, LONG]),
        (f"<div><p>{LONG}</p><aside>x</aside><p>Short.</p><div class=ad>Buy</div><p>End.</p></div>{NAV}<div>Imprint</div>",
         [LONG, "Short.", "End."]),
        (f"{NAV}<div><div><p>Lead.</p></div><div class=ad>Buy</div><p>More.</p><aside>x</aside><p>One.</p><p>Two.</p>"
         f"<p>{LONG}</p></div>{NAV}<div>Imprint</div>", ["Lead.", "More.", "One.", "Two.", LONG]),
        (f"<p>{LONG}</p><div class=ad>Buy</div><div>All rights reserved</div>", [LONG]),
    ],
)
def test_a_long_paragraph_hides_no_others(page, lines):
    assert main_text(page).split("\n") == [" ".join(line.split()) for line in lines]
