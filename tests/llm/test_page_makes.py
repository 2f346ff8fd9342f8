"""Pages inside one form, names that are no frames inside an article, and markup that is never closed."""

from __future__ import annotations

import time

import pytest

from ledgermatch.llm import html_extract

LONG = "The council met on Tuesday evening and talked for two hours about the new bridge over the river, which many people in the town have asked for."
MORE = "Several members said that the cost had risen since the spring, and that a second offer should be asked for before anything is signed."
MENU = "<ul><li><a href='/'>Home</a></li><li><a href='/n'>News</a></li><li><a href='/c'>Contact us</a></li></ul>"
ARTICLE = f"<article><h1>New bridge</h1><p>{LONG}</p><p>{MORE}</p></article>"
TEXT = f"New bridge\n{LONG}\n{MORE}"

PAGES = {
    "form around the page": (f"<form method=post><div class='menu'>{MENU}</div>{ARTICLE}<footer>Imprint</footer></form>", TEXT),
    "form around a main part": (f"<form id='aspnetForm'><nav>{MENU}</nav><main><h1>New bridge</h1><p>{LONG}</p><p>{MORE}</p></main></form>", TEXT),
    "search form beside an article": (f"<form><input name=q><label>Search the site</label></form>{ARTICLE}", TEXT),
    "code named menu": (f"<article><h1>New bridge</h1><p>{LONG} Use <code class='menu'>File</code> now.</p></article>", f"New bridge\n{LONG} Use File now."),
    "span named search": (f"<article><p>{LONG} The <span class='search'>query</span> ran.</p></article>", f"{LONG} The query ran."),
    "legal part of an article": (f"<article><h1>New bridge</h1><p>{LONG}</p><div class='legal'><p>{MORE}</p></div></article>", TEXT),
    "share button": (f"<article><p>{LONG}<span class='share'>Tweet</span></p></article>", LONG),
}


@pytest.fixture(scope="module")
def tree(spark):
    return html_extract.train_tree(spark)


@pytest.mark.parametrize("name", PAGES)
def test_pages(tree, name):
    page, text = PAGES[name]
    assert html_extract.main_text(page, tree) == text


def test_unmatched_tags_take_linear_time(tree):
    page = "<div>" * 60_000 + "<p>word" + "</x>" * 100_000 + "</section>" * 50_000
    began = time.time()
    html_extract.main_text(page, tree)
    assert len(page) > 1_000_000 and time.time() - began < 2
