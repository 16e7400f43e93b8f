import html
import re

import numpy as np
import pytest

from prefspark.llm import html_extract as H
from prefspark.llm.labelled_pages import labelled_pages


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(spark)


def test_query_returns_the_articles(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    for r in H.query(spark, "/root/testdata/sf0.01").collect():
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", article.replace("<br>", " ")))
        want = "\n\n".join(x for x in (" ".join(html.unescape(p).split()) for p in parts) if x)
        assert r["text"] == want and r["n_chars"] == len(want)


def test_labelled_pages_are_learned(spark, model):
    right = total = 0
    for r in labelled_pages(spark).collect():
        nodes, _ = H.parse(r["html"])
        for n, p in zip(nodes, H.marginals(nodes, model)):
            if n.chars:
                total += 1
                right += (p >= 0.5) == bool(n.label)
    assert right / total > 0.99


def test_marginals_equal_enumeration(model):
    page = "<body><div class='x'><nav><a href=1>a b</a></nav><article><p>Some text.</p><p class='ad'>Buy.</p></article></div><footer>c</footer></body>"
    nodes, _ = H.parse(page)
    n = len(nodes)
    score = np.zeros((n, 2))
    for state in range(1 << n):
        y = [state >> i & 1 for i in range(n)]
        if not y[0]:
            continue
        w = 1.0
        for i in range(1, n):
            up = nodes[nodes[i].parent]
            w *= model["pairs"].get(H.cell(H.edge(up, nodes[i])), model["every"])[y[nodes[i].parent]][y[i]]
            r = sum(model["ratio"].get(H.cell(f), 0.0) for _, f in H.features(nodes[i]))
            p = 1 / (1 + np.exp(-r))
            w *= p if y[i] else 1 - p
        for i in range(n):
            score[i, y[i]] += w
    want = score[:, 1] / score.sum(axis=1)
    assert np.allclose(H.marginals(nodes, model), want)


CASES = [
    ("<body><div id='article'><h1>A title</h1><p>One &amp; two&nbsp;three<br>four.<p>Five <i>six</i></div><div class='comments-area'><p>I agree.</p></div></body>", "A title\n\nOne & two three four.\n\nFive six"),
    ("<main><h1>T</h1><p>Eins.</p><aside>note</aside><p>Zwei.</p></main><footer>f</footer>", "T\n\nEins.\n\nZwei."),
    ("<article><p>a</p><script>if (a < b) { '<p>no</p>' }</script><style>p{}</style><p>b</p><!-- <p>c</p> --></article>", "a\n\nb"),
    ("<article><div>head<p>para</p>tail</div></article>", "head\n\npara\n\ntail"),
    ("", ""), ("<article><p>open", "open"), ("<article></p></div><p>x</p>", "x"), ("< 3 <b", ""),
]


@pytest.mark.parametrize("page, want", CASES)
def test_pages(model, page, want):
    assert H.main_text(page, model) == want


def test_depth_and_length(model):
    deep = "<div>" * 5000 + "x" + "</div>" * 5000
    assert H.main_text(deep, model) in ("", "x")
    assert H.main_text("<article>" + "<p>word</p>" * 20000 + "</article>", model).count("word") == 20000


SENTENCES = "The council met in the spring, and after long talks the members agreed on a plan. Nobody had expected that, but it was done."


def _unseen_layout(k):
    """A page whose content stands in elements of names that no labelled page has, and its blocks."""
    name = f"{'bcdfg'[k % 5]}lor{'aeiou'[k // 5 % 5]}x"
    blocks = [f"Heading number {k}", f"First part {k}. {SENTENCES}", f"Second part {k}. {SENTENCES}", SENTENCES]
    inner = f"<h{1 + k % 3}>{blocks[0]}</h{1 + k % 3}>" + "".join(f"<p>{b}</p>" if k % 2 else f"<div>{b}</div>" for b in blocks[1:])
    frames = [f"<div class='{name}'>{inner}</div>", f"<div id='{name}'><div class='{name}-in'>{inner}</div></div>", f"<section class='{name} wide'>{inner}</section>", inner, f"<div>{inner}</div>"]
    around = ["<nav><a href='/'>home</a></nav>", "<div class='menu'><a href='/'>home</a> <a href='/n'>news</a></div>", "<header><p>the daily</p></header>", "<div class='cookie-banner'>We use cookies. All of them.</div>"]
    after = ["<footer>all rights reserved</footer>", "<div id='disqus_thread'><p>A reader writes. I agree.</p></div>", "<aside class='sidebar'><p>Something else. Read it.</p></aside>"]
    return f"<html><body>{around[k % 4]}{frames[k % len(frames)]}{after[k % 3]}</body></html>", blocks


def test_content_in_names_never_seen(model):
    right = extra = total = 0
    for k in range(75):
        page, blocks = _unseen_layout(k)
        got = H.main_text(page, model).split("\n\n")
        right += sum(b in got for b in blocks)
        extra += sum(g not in blocks for g in got if g)
        total += len(blocks)
    assert right / total > 0.95 and extra / total < 0.02


def test_text_without_elements_and_kept_elements(model):
    assert H.main_text(f"{SENTENCES}\n\n{SENTENCES}", model) == f"{SENTENCES} {SENTENCES}"
    assert H.main_text(f"<body><h1>A title</h1><p>{SENTENCES}</p></body>", model) == f"A title\n\n{SENTENCES}"
    page = f"<article><p>{SENTENCES} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p><object><p>What stands for the object, in words.</p></object><noscript>Without scripts.</noscript><button>Buy</button></article>"
    assert H.main_text(page, model) == f"{SENTENCES} x=2 holds.\n\nWhat stands for the object, in words.\n\nWithout scripts."


def test_stray_end_tags_take_linear_time():
    import time

    began = time.time()
    H.parse("<div>" * 3000 + "</b></i></p></span>" * 30_000)
    assert time.time() - began < 5
