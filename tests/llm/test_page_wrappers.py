"""Pages whose wrappers carry class names that hold a frame's name."""

from __future__ import annotations

import pytest

from ledgermatch.llm import html_extract

ARTICLE = "<article><h1>A title</h1><p>The first words of the text stand here.</p></article>"
TEXT = "A title\nThe first words of the text stand here."
WRAPPED = [
    *(f"<html><body class='{c}'><nav><ul><li><a href='/'>Home</a></li></ul></nav>{ARTICLE}<footer>Imprint</footer></body></html>"
      for c in ("no-sidebar", "single no-sidebar", "has-sidebar", "single-post comments-open", "sidebar", "menu-open", "sidebar-left")),
    *(f"<body><div id='page' class='{c}'><div class='sidebar'><p>Other things to read.</p></div>{ARTICLE}<aside><p>Aside of it.</p></aside></div></body>"
      for c in ("content-with-sidebar", "sidebar-left", "social", "site-header", "widget-page")),
    f"<div class='sidebar-right'>{ARTICLE}<div class='comments'><article><p>A comment that someone wrote about it.</p></article></div></div>",
    f"<div class='has-sidebar'>{ARTICLE}<div class='related'><article><p>Another text that one may read.</p></article></div></div>",
    "<div class='social'><main class='form'><h1>A title</h1><p>The first words of the text stand here.</p></main></div>",
    "<div class='sidebar'><article><p>A teaser in the side column of it.</p></article></div>" + ARTICLE,
]


@pytest.fixture(scope="module")
def tree(spark):
    return html_extract.train_tree(spark)


@pytest.mark.parametrize("page", WRAPPED)
def test_wrapped_articles(tree, page):
    assert html_extract.main_text(page, tree) == TEXT


def test_real_frames_stay(tree):
    for tag in ("nav", "aside", "footer", "dialog"):
        assert html_extract.main_text(f"<{tag}>{ARTICLE}</{tag}>", tree) == ""
    assert not any(b[3] for b in html_extract.flatten(f"<div class='comments'>{ARTICLE}</div>"))


def test_content_beside_a_frame_name():
    (block,) = html_extract.flatten("<div class='post-content social'><p>The first words.</p></div>")
    assert block[4] is False and block[5] is True
