"""Page skeletons with labelled blocks: what is the article's, and what isn't; and marks that name one thing and mean another."""

import time

import pytest

from docloom.llm.html_text import main_text

A, B = "The first part of the text, with commas, tells at some length what happened, and to whom.", "The second part, a little shorter, says why it did, and what came of it, in the end."
NO = "This isn't the article, it is something else, of some length, with commas, on the page."


def p(*texts):
    return "".join(f"<p>{t}</p>" for t in texts)


#: Around the labelled blocks: {0} the article's, {1} what isn't its.
SKELETONS = {
    "article": "<body><header>{1}</header><nav>{1}</nav><article>{0}</article><aside>{1}</aside><footer>{1}</footer></body>",
    "main": "<body><div id='top-bar'>{1}</div><main>{0}</main><div class='site-footer'>{1}</div></body>",
    "divs": "<body><div class='wrapper'><div class='left-sidebar'>{1}</div><div class='column'>{0}</div></div><div class='footer-links'>{1}</div></body>",
    "comments": "<body><article>{0}</article><div class='comments-content'>{1}</div><article class='comment'>{1}</article><div id='reader-comments'>{1}</div></body>",
    "comments inside": "<article>{0}<div class='comment text'>{1}</div><section class='post-comments'>{1}</section></article>",
    "comments on": "<body class='comments-open'><article class='post comments-enabled'>{0}</article><ol class='commentlist'><li>{1}</li></ol></body>",
    "adverts": "<article>{0}<div class='ad-slot'>{1}</div><div class='ads'>{1}</div><div class='sponsored-content-unit-2'></div></article><div class='promo-box'>{1}</div>",
    "notices": "<div class='cookie-notice'>{1}</div><div class='gdpr'>{1}</div><article><div class='notice'>{1}</div>{0}</article>",
    "hidden": "<article>{0}<div style='color:red; display : none'>{1}</div><div hidden>{1}</div><div aria-hidden='true'>{1}</div></article>",
    "forms": "<article>{0}<form>{1}</form><div class='newsletter-signup'>{1}</div><script>{1}</script><style>{1}</style></article>",
    "layout": "<body><div class='layout-sidebar-right'><div>{0}</div><div class='sidebar'>{1}</div></div></body>",
    "all named": "<body><div class='sidebar'>{0}</div></body>",
}


@pytest.mark.parametrize("name", sorted(SKELETONS))
def test_skeletons_give_the_article_and_nothing_else(name):
    page = SKELETONS[name].format(p(A, B), p(NO))
    assert main_text(page) == f"{A}\n\n{B}"


def test_names_that_only_look_like_other_things():
    inside = "<p class='share-price'>One.</p><div class='social-history'>Two.</div><p class='header'>Three.</p><div class='search-history'><p>Four.</p></div><p class='alert-level'>Five.</p>"
    assert main_text(f"<article>{p(A)}{inside}</article>") == "\n\n".join([A, "One.", "Two.", "Three.", "Four.", "Five."])


def test_pages_of_open_heads_are_read_in_linear_time():
    began = time.time()
    main_text("<head>" * 20_000)
    one = time.time() - began
    began = time.time()
    assert main_text("<head>" * 80_000 + p(A)) == A
    assert time.time() - began < 12 * one + 2
