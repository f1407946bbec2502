import html
import random
import re

import numpy as np
import pytest
from conftest import TESTDATA
from corpora import prepared  # noqa: F401

from accrual.llm.main_text import (
    Page, decode, extract_main_text, features, main_texts, odds_of, relayout, take_apart, train_trees,
)


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(str(TESTDATA / "sf0.01" / "pages.parquet"))


@pytest.fixture(scope="module")
def trees(spark, pages):
    from accrual.llm.common import ready

    ready(spark)
    return train_trees(pages, most=60, rounds=12)


def test_given_pages(pages, trees):
    """The article element's blocks, found without being told where it is."""
    got = {r["page_id"]: r for r in extract_main_text(pages, trees).collect()}
    for r in pages.collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = re.split(r"</?p>|</?h1>", article.replace("<br>", " "))
        clean = [" ".join(html.unescape(re.sub(r"</?b>", "", b)).split()) for b in blocks]
        assert got[r["page_id"]]["text"] == "\n".join(b for b in clean if b)
        assert got[r["page_id"]]["n_chars"] == len(got[r["page_id"]]["text"])


def test_unseen_layouts(pages, trees):
    right = 0
    for number, r in enumerate(pages.limit(80).collect()):
        made = relayout(*take_apart(Page(r["html"])), random.Random(10_000 + number))
        page = Page(made)
        right += main_texts([made], trees) == ["\n".join(t for i, t in page.blocks if page.nodes[i].mark)]
    assert right >= 72


def test_hand_made_page(trees):
    story = [f"Sentence number {i}, which tells a part of the story. And then it goes on." for i in range(5)]
    paragraphs = "".join(f"<p>{s}</p>" for s in story)
    page = (
        "<html><head><title>T</title></head><body><div id='header'><ul class='menu'><li><a href='/'>Home</a></li>"
        "<li><a href='/a'>About</a></li></ul></div><div class='cookie-notice'><p>We use cookies, as all do.</p></div>"
        f"<main><h1>The  story &amp;\n more</h1>{paragraphs}</main><aside class='sidebar'><h3>Related</h3><ul>"
        "<li><a href='/b'>Other</a></li></ul></aside><section id='comments'><div class='comment'><p>I like this story, "
        "a lot. It is good.</p></div></section><form><input><button>Send</button></form><footer>&copy; Us</footer>"
        "<script>var x = '<p>no</p>';</script></body></html>"
    )
    assert main_texts([page], trees) == ["\n".join(["The story & more", *story])]


def test_defined_results(spark, trees):
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", "<<>&lt;", "x"), (4, "u", "<p>" * 3000, "x"), (4, "u", "\x00</p><!-- ", "x")]
    given = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = extract_main_text(given, trees)
    assert out.columns == ["page_id", "url", "html", "text", "n_chars"] and out.count() == 5
    assert {r["text"] for r in out.where("page_id in (1, 2)").collect()} == {""}
    assert extract_main_text(given.limit(0), trees).count() == 0
    assert train_trees(given.where("page_id < 3")) == []
    assert {r["n_chars"] for r in extract_main_text(given, []).collect()} == {0}


def test_no_choice_contradicts_another():
    page = Page("<div><p>a</p><div><p>b</p><p>c</p></div></div><div><p>d</p></div>")
    dice = np.random.default_rng(0)
    for _ in range(200):
        odds = dice.uniform(size=len(page.nodes))
        stays = decode(page, odds)
        assert all(stays[n.parent] for i, n in enumerate(page.nodes) if i and stays[i])


def test_tree_building():
    page = Page("<p>a<p>b &amp; c<ul><li>d<li>e</ul>f<br>g<a href=x>h</a><table><tr><td>i<td>j</table>&am")
    assert [t for _, t in page.blocks] == ["a", "b & c", "d", "e", "f gh", "i", "j", "&am"]
    assert features(page).shape[0] == len(page.nodes)
    assert odds_of(np.zeros((2, 3)), [(1.0, np.array([[0, 0.5, 1, 2, 0], [-1, 0, 0, 0, 2.0], [-1, 0, 0, 0, -2.0]]))])[0] > 0.9


@pytest.mark.parametrize("page, blocks", [
    ("<p>some text <ins>added</ins> and more</p>", [("p", "some text added and more")]),
    ("<p>a <label>b <button>c</button></label> d</p>", [("p", "a b c d")]),
    ("<h2>a <noscript>b</noscript> c</h2><p>d</p>", [("h2", "a b c"), ("p", "d")]),
    ("<p>a <object>b</object> <canvas>c</canvas> d <iframe>e</iframe></p>", [("p", "a b c d e")]),
    ("<p>a <button>b<p>c</p>", [("p", "a b"), ("p", "c")]),
    ("<div><button>a</button><p>b</p></div>", [("button", "a"), ("p", "b")]),
    ("<ins>a <p>b <ins>c</ins> d</p></ins>", [("ins", "a"), ("p", "b c d")]),
    ("<p>a <ins class='adsbygoogle'>buy</ins> b</p>", [("p", "a"), ("ins", "buy"), ("p", "b")]),
    ("<p>a <ins/> b</p>", [("p", "a b")]),
])
def test_phrasing_stays_in_its_block(page, blocks):
    found = Page(page)
    assert [(found.nodes[i].tag, text) for i, text in found.blocks] == blocks
