"""Main text extraction on planted pages."""

import itertools
import time

import numpy as np
import pytest

from distaff.llm import html_extract as h

SCHEMA = "page_id bigint, html string, row string, text int"
WORDS = "lorem ipsum dolor sit amet consetetur sadipscing elitr sed diam nonumy eirmod tempor invidunt ut labore et dolore magna".split()


def sentence(rng, n):
    return " ".join(rng.choice(WORDS, n)).capitalize() + "."


def given(rng, i):
    paragraphs = [sentence(rng, rng.integers(2, 120)) for _ in range(rng.integers(1, 9))]
    nav = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in rng.choice(WORDS, 6))
    page = (
        f"<!DOCTYPE html><html><head><title>T {i}</title><style>p{{margin:0}}</style><script>var t=\"</p>\";</script></head><body>"
        f"<nav><ul>{nav}</ul></nav><!-- ad --><div class=\"ad\">{sentence(rng, 6)}</div><article><h1>Head {i}</h1>"
        + "".join(f"<p>{p.replace('sit', 'si&#116;')}</p>" if k % 2 else f"<p><b>{p}<br>" for k, p in enumerate(paragraphs))
        + f"</article><footer>&copy; {sentence(rng, 5)}</footer></body></html>"
    )
    return page, "\n\n".join([f"Head {i}", *paragraphs])


def test_given_layout_is_read_exactly(spark):
    rng = np.random.default_rng(0)
    made = [given(rng, i) for i in range(80)]
    odd = [(100, None), (101, ""), (102, "just words"), (103, "<" * 500), (104, "<p>" * 3000 + "x"), (3, made[3][0])]
    pages = spark.createDataFrame([(i, p, "clash", 1) for i, (p, _) in enumerate(made)] + [(i, p, None, None) for i, p in odd], SCHEMA)
    got = h.extract(pages, h.fit_extractor(pages)).collect()
    assert len(got) == 86
    texts = {r.row.page_id: r.text for r in got}
    assert [texts[i] for i in range(80)] == [t for _, t in made]
    assert texts[100] == texts[101] == ""


@pytest.fixture(scope="module")
def trees():
    rng = np.random.default_rng(1)
    contents = [h.article_of(given(rng, i)[0]) for i in range(120)]
    made = [h.rearranged(c, [sentence(rng, 40) for _ in range(30)], rng) for c in contents for _ in range(3)]
    batch = h.measure([h.read_page(p, h.MARK) for p in made])
    known = ~np.isnan(batch.share)
    return h.boosted_trees.fit(batch.features[known], batch.share[known], rounds=40, leaves=12, rate=0.25)


def decoded(page, trees):
    parsed = h.read_page(page)
    batch = h.measure([parsed])
    return h.decode(parsed, trees.probabilities(batch.features), batch.chars)


def test_other_layouts(trees):
    rng = np.random.default_rng(5)
    text = [sentence(rng, 60) for _ in range(5)]
    body = "".join(f"<p>{t}</p>" for t in text)
    page = (
        '<body><div class="site-header"><a href=/>Site</a></div><div id="menu"><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div>'
        f'<div class="content">{body}<div class="advert">Buy lorem now</div></div>'
        f'<div id="comments"><h3>Comments</h3><p>{sentence(rng, 20)}</p><p>{sentence(rng, 12)}</p></div>'
        '<div class="sidebar"><ul><li><a href=c>Related one</a></li></ul></div><form><label>Mail</label><input></form>'
        '<div class="cookie-notice">We use cookies lorem ipsum dolor.</div><div class="footer">Imprint</div></body>'
    )
    assert decoded(page, trees) == text


def test_decoding_never_contradicts(trees):
    page = h.read_page("<div>one two<div>three four<p>five six</p></div><p>seven</p></div>")
    chars = h.measure([page]).chars
    for seed in range(30):
        p = np.random.default_rng(seed).random(len(page.nodes))
        kept = h.decode(page, p, chars)
        assert kept == [t for t, *_ in page.blocks if t in kept]


def labelings(page, p, chars, node):
    """(value, kept nodes) of every way to decide a node and what is below it."""
    take, drop = chars[node] * np.log(p[node]), chars[node] * np.log(1 - p[node])
    yield take, {node: True}
    yield drop, {node: False}
    children = [i for i, x in enumerate(page.nodes) if x[0] == node]
    if children:
        own = max(0.0, chars[node] - sum(chars[c] for c in children))
        outside = own * max(take, drop) / chars[node] if chars[node] else 0.0
        for parts in itertools.product(*[list(labelings(page, p, chars, c)) for c in children]):
            kept = {k: v for _, x in parts for k, v in x.items()}
            yield sum(v for v, _ in parts) + outside - h.DESCENT, kept | {node: bool(take >= drop)}


def test_decoding_finds_the_best_of_all_choices():
    page = h.read_page("<div>one two<div>three four<p>five six</p>x</div><p>seven</p><ul><li>eight nine ten</ul></div><p>eleven</p>")
    chars = h.measure([page]).chars
    rng = np.random.default_rng(2)
    for sharpness in (1, 4):
        for _ in range(40):
            p = 1 / (1 + np.exp(-sharpness * rng.normal(size=len(page.nodes))))
            _, kept = max(labelings(page, p, chars, 0), key=lambda x: x[0])

            def decided(node, kept=kept):
                return kept[node] if node in kept else decided(page.nodes[node][0])

            assert h.decode(page, p, chars) == [t for t, _, node in page.blocks if decided(node)]


def test_any_attributes_and_the_mark_of_training(spark, trees):
    page, text = given(np.random.default_rng(9), 1)
    for value in ("yes", "1", "0", "", "\u0661", "9" * 5000):
        assert decoded(page.replace("<article>", f'<article data-truth="{value}" class="{value}">'), trees) == text.split("\n\n")
    pages = spark.createDataFrame([(1, page.replace("<p>", '<p data-truth="yes">'), "x", 1)] * 3, SCHEMA)
    assert {r.text for r in h.extract(pages, h.fit_extractor(pages)).collect()} == {text}
    empty = pages.limit(0)
    assert h.extract(empty, h.fit_extractor(empty)).count() == 0


def test_time_follows_the_length_of_a_page():
    n = 50_000
    for page in (
        "<div>" * 3000 + "</section>" * 2 * n + "x",
        "<blockquote>" * 3000 + "<li>a" * n,
        "<blockquote>" * 3000 + "<p>a<i>" * n,
        "<object>" * 3000 + "<p>a" * n + "</object>" * 3000,
        "<div><p>" * n + "</div>" * n,
    ):
        start = time.process_time()
        h.read_page(page)
        assert time.process_time() - start < 2.5


def test_reading_is_tolerant():
    blocks = lambda t: [b[0] for b in h.read_page(t).blocks]
    assert blocks("<p>a<p>b<div>c</p>d</div>e<br>f &amp; g&nbsp;h<!-- x --><i>i</i>j") == ["a", "b", "c", "d", "e f & g hij"]
    assert blocks("<ul><li>a<ul><li>b</ul><li>c</ul><table><tr><td>d<td>e<tr><td>f</table>") == list("abcdef")
    assert blocks('<a title="x > y">l</a> <script>"<p>no</p>"</script>m<textarea>n</textarea><STYLE>o</style') == ["l m"]
    assert blocks("<!-- never closed <p>x") == [] and blocks("a < b <3") == ["a < b <3"]


def test_hidden_elements_without_end_tags(trees):
    blocks = lambda t: [b[0] for b in h.read_page(t).blocks]
    head = "<html><head><title>t</title><style>p{}</style><meta name=a><link rel=b>"
    for start in ("<body>", "<div>", "<img>", "", "</head>", "<noscript><link rel=c><body>", "</head><head>"):
        assert blocks(f"{head}{start}words<p>more") == ["words", "more"]
    assert blocks(f"{head}<noscript><p>x</p></noscript><template><p>x<template></template><p>y</template><body>z") == ["z"]
    for tag in ("button", "select", "noscript", "svg", "svg/", "object", "video"):
        assert blocks(f"<div>a<{tag}>x<p>b<div>c</div></div>d") == ["a", "b", "c", "d"]
        assert blocks(f"<div>a<{tag}>x<p>b</p>c<{tag}>y</{tag.strip('/')}></div>d") == ["a", "b", "c", "d"]
    for tag in ("button", "noscript", "svg", "template", "object"):
        assert blocks(f"<div>a<{tag}>x<p>y<div>z</div></{tag}></div>d") == ["a", "d"]
    assert blocks("<object><object></object><p>x</p></object><p>b") == ["b"]
    page, text = given(np.random.default_rng(9), 1)
    assert decoded(page.replace("</head>", ""), trees) == decoded(page, trees) == text.split("\n\n")
