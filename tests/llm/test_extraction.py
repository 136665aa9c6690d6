import itertools
import math
import random
import time

import pytest
from labelled_pages import HELD_OUT

from omnibus.llm import extraction, page_makes
from omnibus.llm.common import table
from omnibus.llm.dom import Page
from omnibus.llm.html_examples import PAGES

PAGE = "page_id bigint, url string, html string, text string, n_chars string"


@pytest.fixture(scope="module")
def model():
    return extraction.learn(extraction.labelled())


def misread(model, html):
    """(text, label, chance) of the runs that get the wrong state."""
    page = Page(html)
    labels, chance = extraction.hand_labels(page), extraction.Tree(page).marginals(model)[0]
    return [(text, labels[n], chance[n]) for n, text in page.runs if (chance[n] > 0.5) != labels[n]]


def test_marginals_equal_sums_over_all_states():
    rng = random.Random(1)
    for n in (1, 2, 5, 9):
        parents = [-1] + [rng.randrange(i) for i in range(1, n)]
        kinds = [rng.randrange(extraction.KINDS) for _ in range(n)]
        unary = [rng.uniform(-3, 3) for _ in range(n)]
        pair = [[rng.uniform(-2, 2) for _ in range(4)] for _ in range(extraction.KINDS)]
        weight = {}
        for states in itertools.product((0, 1), repeat=n):
            total = sum(u * s for u, s in zip(unary, states))
            total += sum(pair[kinds[i]][2 * states[parents[i]] + states[i]] for i in range(1, n))
            weight[states] = math.exp(total)
        z = sum(weight.values())
        chance, both = extraction.marginals(parents, kinds, unary, pair)
        for i in range(n):
            assert chance[i] == pytest.approx(sum(w for s, w in weight.items() if s[i]) / z)
            if i:
                for k in range(4):
                    expected = sum(w for s, w in weight.items() if 2 * s[parents[i]] + s[i] == k) / z
                    assert both[i][k] == pytest.approx(expected)


def test_labelled_pages_are_learned(model):
    assert [misread(model, html) for html in PAGES] == [[]] * len(PAGES)


def test_pages_never_seen(spark):
    # Learned as the query learns, from the labelled pages and the table's own.
    fitted = extraction.fit(table(spark, "/root/testdata/sf0.01", "pages"))
    wrong = {name: found for name, html in HELD_OUT.items() if (found := misread(fitted, html))}
    runs = sum(len(Page(html).runs) for html in HELD_OUT.values())
    assert runs > 100 and sum(map(len, wrong.values())) <= 0.02 * runs and len(wrong) <= 1, wrong
    # The pages the verdict of an earlier version found empty are among the right ones.
    assert not set(list(HELD_OUT)[:6]) & set(wrong)
    made = [misread(fitted, html) for html in page_makes.pages(200, seed=99)]
    assert sum(not found for found in made) >= 0.8 * len(made)


def test_articles_of_the_table_are_whole(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    got = {r.page_id: r.text for r in extraction.extract(pages, extraction.fit(pages)).collect()}
    for row in pages.collect():
        page = Page(row.html)
        inside = [False] * len(page.tags)
        for n in range(1, len(inside)):
            inside[n] = inside[page.parents[n]] or page.tags[n] == "article"
        assert got[row.page_id] == "\n".join(text for n, text in page.runs if inside[n])


@pytest.mark.parametrize(
    "html",
    [
        "<span>x" * 40_000 + "</i>" * 40_000 + "<p>end</p>", "<x>" * 40_000 + "<p>x" * 40_000, "<ul>" + "<x>" * 40_000 + "<li>x</li>" * 40_000,
        "<!--" * 400_000, "<a " * 400_000, "</" * 400_000, "<a b='" * 200_000, "<script>" + "</" * 400_000, "&" * 1_000_000, "<" * 400_000,
        "<i>" * 200_000 + "</b>" * 200_000, "<ul><li>" * 40_000,
    ],
)
def test_odd_pages_take_linear_time(html):
    start = time.perf_counter()
    Page(html)
    assert time.perf_counter() - start < 20


def test_reading():
    read = lambda html: [t for _, t in Page(html).runs]
    assert read("<p>a<!-- x -->b<!---->c<!-->d<!--->e<!-- a -- b --!>f<!-- no end") == ["abcdef"]
    assert read("a<script>if (a<b) '</p>'</script>b<STYLE>x</style >c<textarea><p>x&amp;</textarea>d") == ["abc", "<p>x&", "d"]
    assert read("1 < 2 <p title='a>b' class=\"x\">&lt;&#65;&#x42;&nosuch;&copy</p></>x</ y>z<?php a ?>w<!x>v") == ["1 < 2", "<AB&nosuch;©", "xzwv"]
    assert read("&#" + "9" * 6000 + ";&#" + "0" * 6000 + "65;") == ["\ufffdA"]
    assert read("<p>one<p>two<li>three<div>four</p>five</div><p>six <svg><path/></svg> seven") == ["one", "two", "three", "four", "five", "six seven"]
    links = Page("<a name=x>no link <a href=1>link</a> no <a href=2>link <a href=3>link</a> no")
    assert links.link_chars[0] == len("linklink link")


def test_page_of_another_make(model):
    html = (
        "<html><head><title>x</title><script>if (a < b) { t = '</p>' }</script><style>p{}</style></head><body><nav><a href=1>A</a>"
        "<a href=2>B</a></nav><div class='ad'>Cheap flights, every day.</div><article><h1>Caf&eacute; &amp; bar</h1><p>One  line\n of"
        " <b>bold</b> text, &lt;here&gt; it is.<br>And more of it, for a while.<p>No end tag<p><p>Last &#8212; line of the text.</article>"
        "<section class='comments'><p>First comment by a reader, who liked it.</p></section><footer>&copy; us</footer></body>"
    )
    assert extraction.main_text(html, model) == (
        "Café & bar\nOne line of bold text, <here> it is. And more of it, for a while.\nNo end tag\nLast — line of the text."
    )


def test_edge_rows(spark, model):
    deep = "<div>" * 3000 + "<article><p>Deep down, there is a text of some words.</p></article>"
    rows = [(1, None, None), (2, "u", ""), (None, None, "<nav><a href=x>only a menu</a></nav>"), (4, "u", deep), (4, "u", deep),
            (5, "u", "<p><<p>&&amp;</ <!-- x --><!DOCTYPE"), (6, "u", "<article><p>" + "word " * 200_000 + "</article>")]
    df = spark.createDataFrame([(*r, None, None) for r in rows], PAGE)
    got = extraction.extract(df, model).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"page_id", "url", "text", "n_chars"}
    assert all(r.n_chars == len(r.text) for r in got)
    by_id = {r.page_id: r.text for r in got}
    assert by_id[1] == by_id[2] == by_id[None] == "" and by_id[4] == "Deep down, there is a text of some words."
    assert len(by_id[6]) == 999_999


def test_learns_from_pages_that_mark_their_text(spark):
    html = "<body><nav>{0}</nav><article><h1>{0}</h1><p>Text number {0}, and a bit more.</p></article><footer>f {0}</footer></body>"
    df = spark.createDataFrame([(i, "u", html.format(i), None, None) for i in range(30)] + [(99, "u", None, None, None)], PAGE)
    fitted = extraction.fit(df)
    assert {r.text for r in extraction.extract(df.where("page_id < 30"), fitted).collect()} == {
        f"{i}\nText number {i}, and a bit more." for i in range(30)
    }
    assert extraction.extract(df.limit(0), extraction.fit(df.limit(0))).count() == 0


@pytest.mark.parametrize(
    "start",
    ["<html><head><title>T</title><article>", "<head><meta charset=utf-8><style>p{}</style><script>x()</script><link rel=a><article>",
     "<html><head><title>T</title></head><article>", "<head><noscript><img src=a></noscript><title>T</title>\n<body><article>",
     "<html><head><title>T</title><article>", "<title>T</title><article>"],
)
def test_implied_ends_of_head(model, start):
    html = start + "<h1>Heading here</h1><p>A paragraph of the page, long enough to be its text.<p>And one more of them.</article>"
    expected = "Heading here\nA paragraph of the page, long enough to be its text.\nAnd one more of them."
    assert extraction.main_text(html, model) == expected


def test_text_inline_and_void_tags_end_a_head():
    for body in ("Text of the page.", "<b>Text</b> of the page.", "<img src=a>Text of the page.", "<br>Text of the page."):
        page = Page("<html><head><title>T</title>\n" + body)
        assert [t for _, t in page.runs] == ["Text of the page."]


def test_formulas_are_text():
    page = Page(
        "<article><p>We know that <math><semantics><mrow><mi>E</mi><mo>=</mo><mi>m</mi><msup><mi>c</mi><mn>2</mn></msup></mrow>"
        "<annotation encoding=tex>E = mc^2</annotation></semantics></math> holds.</p></article>"
    )
    assert [t for _, t in page.runs] == ["We know that E=mc2 holds."]
