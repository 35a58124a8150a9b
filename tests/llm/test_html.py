"""Pages with nested, unmarked and misleading elements, and pages that are deep or never closed."""

from __future__ import annotations

import random
import time

import pytest

from tidewire.llm import html

NESTED = """<html><body><nav><a href=/>Home</a></nav><main><article class="post"><div class="content"><h1>Title of it</h1>
<nav><a href=/>Home</a> <a href=/a>About us</a></nav><p>The first paragraph of the text, which is long enough.</p>
<div class="social-history"><p>A social history of the town, with many words in it.</p></div>
<aside><p>See also the other article of ours, it is good.</p></aside><form><p>Your mail please, to get our letter.</p></form>
<section class="comments"><h2>Comments</h2><p>I liked this article a lot, thank you for writing it.</p></section></div></article>
<form><p>Give us your address, please.</p></form></main></body></html>"""
UNMARKED = "<body><div><p>First long paragraph of text, with words and an end.</p>{}<p>Second long paragraph of text, with more words and an end.</p>{}</div></body>"


def test_nearest_mark_decides():
    assert html.main_text(NESTED).split("\n\n") == [
        "Title of it", "The first paragraph of the text, which is long enough.", "A social history of the town, with many words in it.",
    ]


@pytest.mark.parametrize("between,after", [("", "<p>Leave a comment</p>"), ("<p>Leave a comment</p>", ""), ("<div class=share-links>Tell all</div>", "<ul><li><a href=/>Next</a></ul>")])
def test_unmarked_paragraphs(between, after):
    found = html.main_text(UNMARKED.format(between, after)).split("\n\n")
    assert found == ["First long paragraph of text, with words and an end.", "Second long paragraph of text, with more words and an end."]


def test_names_of_boilerplate():
    bad = ["footer", "site-footer", "share-buttons", "comment-list", "cookie_notice", "notice-box", "ads", "nav-menu", "post-comments", "widgets"]
    fine = ["social-history", "has-sidebar", "overflow-hidden", "adspace9x", "header-less", "text", "shared", "formation", "tagsoup"]
    assert [n for n in bad if not html.marks_boilerplate(n)] == [] and [n for n in fine if html.marks_boilerplate(n)] == []


def generated(draw):
    """A page and its text: wrappers of any depth and name, boilerplate of all kinds between the paragraphs."""
    def sentence(n):
        return " ".join(draw.choice(["river", "stone", "walks", "under", "light", "seven", "small", "old"]) for _ in range(n)).capitalize() + "."

    def boiler():
        return draw.choice([
            "<nav><ul><li><a href=/>Home</a><li><a href=/x>{}</a></ul></nav>", "<aside><p>{}</p></aside>", "<div class='share-links'><span>{}</span></div>",
            "<section class=comments><h3>Comments</h3><p>{}</p></section>", "<form action=/><p>{}</p><input></form>", "<div id=cookie-banner><p>{}</p></div>",
            "<div class='ad'>{}</div>", "<script>var x = '<p>{}</p>';</script>", "<p hidden>{}</p>", "<div class='related-posts'><article><h2>{}</h2></article></div>",
        ]).format(sentence(draw.randint(3, 12)))

    wrappers = ["<div>{}</div>", "<div class=social-history>{}</div>", "<section class='form-of-art'>{}</section>", "<div class='layout has-sidebar'>{}</div>", "<div class=content>{}</div>"]
    texts, parts = [], []
    for _ in range(draw.randint(2, 7)):
        text = sentence(draw.randint(4, 30))
        texts.append(text)
        part = f"<p>{text}</p>"
        for _ in range(draw.randint(0, 4)):
            part = draw.choice(wrappers).format(part)
        parts.append(part)
        if draw.random() < 0.5:
            parts.append(boiler())
    body = "".join(parts)
    article = f"<article class=post><header><h1>Head line</h1></header>{body}</article>"
    for _ in range(draw.randint(0, 3)):
        article = draw.choice(wrappers).format(article)
    return f"<html><head><title>x</title></head><body>{boiler()}{article}{boiler()}<footer>&copy; us</footer></body></html>", ["Head line", *texts]


def test_generated_pages():
    draw = random.Random(11)
    for _ in range(300):
        page, want = generated(draw)
        assert html.main_text(page).split("\n\n") == want, page


def test_model_trained_on_marked_pages_reads_unmarked_ones(rows):
    draw = random.Random(5)
    model = html.train(rows([(i, generated(draw)[0]) for i in range(150)], "page_id bigint, html string"))
    page = "<body><ul><li><a href=/>Home</a></li><li><a href=/b>Stone</a></li></ul><div><p>{0}</p><p>{0}</p></div><p><a href=/>All news</a></p></body>"
    text = "The river walks under a small old stone, and seven lights walk with it."
    assert html.main_text(page.format(text), model).split("\n\n") == [text, text]


@pytest.mark.parametrize("page", [
    "<div>a" * 100_000, "<p>w <b>x" * 100_000, "<div>" * 100_000 + "x" + "</div>" * 100_000, "<b x" * 100_000 + '"', "<" * 200_000,
    "<div>" * 50_000 + "</span>" * 50_000, "<ul><li>a" * 50_000, "<a b='c>" * 50_000, "<!--" * 50_000, "<script>" * 50_000, "</" * 100_000,
])
def test_odd_pages_take_time_in_proportion(page):
    start = time.perf_counter()
    html.main_text(page)
    assert time.perf_counter() - start < 15


def test_unfinished_markup():
    assert html.main_text("<p>One <b>two</b></p><p x='1") == html.main_text("<p>One <b>two</b></p>")
    assert [b.text for b in html.blocks("a < b and <3 </> c<!-- x --> d <![CDATA[x]]> e")] == ["a < b and <3 c d e"]
    assert [b.text for b in html.blocks('<p title="a>b">One</p><p title="a>Two</p>')] == ["One", "Two"]
