import json
import re
import time
import tracemalloc
from random import Random

import numpy as np
import pytest

from eventlake.llm import extraction
from eventlake.llm.blocks import blocks_of, packed, unpacked
from eventlake.llm.extraction import ExtractionConfig
from eventlake.llm.labeller import INPUT, Labeller, LabellerConfig, excerpt, inputs, made_page, padded, sigmoid, teacher, train

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return [r.html for r in spark.read.parquet(f"{SMALL}/pages.parquet").orderBy("page_id").select("html").collect()]


@pytest.fixture(scope="module")
def model(pages):
    return train(pages[:120])


def test_blocks():
    page = """<body><nav class="top-menu"><ul><li><a href=x>Home</a><li>About</ul></nav><!-- <p>no</p> --><p>One &amp; <b>two</b><br>three
      &nbsp; four<p>Five<script>var x = "<p>";</script><div id='c1 Comments'>Six<textarea><p>x</textarea></div>tail"""
    blocks = blocks_of(page)
    assert [b.text for b in blocks] == ["Home", "About", "One & two three four", "Five", "Six", "tail"]
    assert blocks[0].path == ("body", "nav top menu", "ul", "li") and blocks[0].linked == 1 and blocks[1].linked == 0
    assert blocks[4].path == ("body", "div c comments") and blocks[5].path == ("body",)


@pytest.mark.parametrize("page", [None, "", "<", "<p", "a < b & c", "</div></p>", "<!--", "<script>", "<p>x</p></p></p>", "&#xZZ; &#99999999;"])
def test_broken_pages(page):
    for block in blocks_of(page):
        assert block.text


def test_gradients_are_right():
    rng = np.random.default_rng(0)
    model = Labeller.fresh(LabellerConfig(hidden=3))
    model.weights = {n: w.astype(np.float64) for n, w in model.weights.items()}
    x, mask = padded([rng.normal(size=(n, INPUT)).astype(np.float32) for n in (4, 2)])
    y = np.array([[1, 0, 1, 1], [0, 1, 0, 0]], np.float32)

    def loss():
        p = sigmoid(model.scores(x, mask))
        return -((y * np.log(p) + (1 - y) * np.log(1 - p)) * mask).sum() / mask.sum()

    gradients = model.gradients(x, mask, y)
    for name, w in model.weights.items():
        for _ in range(3):
            at = tuple(rng.integers(0, s) for s in w.shape)
            keep = w[at]
            w[at] = keep + 1e-3
            high = loss()
            w[at] = keep - 1e-3
            slope = (high - loss()) / 2e-3
            w[at] = keep
            assert abs(slope - gradients[name][at]) < 2e-3 * max(1, abs(slope)), name


def test_marked_pages(model, pages):
    for page in pages[120:200]:
        blocks = blocks_of(page)
        assert model.label([blocks])[0].tolist() == [bool(teacher(b)) for b in blocks]


def test_pages_without_marks(model, pages):
    rng, wrong, total = Random(77), 0, 0
    rest = [b.text for p in pages[120:] for b in blocks_of(p)]
    for page in pages[120:]:
        main = [b.text for b in blocks_of(page) if teacher(b)]
        if main:
            blocks, labels = made_page(rng, main[:20], rest)
            wrong += int((model.label([blocks])[0] != np.array(labels)).sum())
            total += len(labels)
    assert wrong < 0.02 * total


def test_the_whole_document_decides_together(model):
    """Padding and the company of other pages change nothing."""
    texts = [[("<p>" + "word " * n + "</p>") for n in range(1, k)] for k in (2, 9, 30)]
    rows = [blocks_of(f"<body><article>{''.join(t)}</article><footer>x</footer></body>") for t in texts]
    together = model.label(rows)
    assert [a.tolist() for a in together] == [model.label([r])[0].tolist() for r in rows]


def test_extract(spark, pages):
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(pages[:60])] + [(100, None, None), (101, "u", ""), (101, "u", ""), (None, "u", pages[0]), (102, "u", pages[1] + "<p>" + "long " * 50_000)]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'mine' AS text", "'mine' AS page")
    out = extraction.extract(frame, ["page_id", "url", "text"], ExtractionConfig(sample_pages=40)).collect()
    assert len(out) == len(rows) and all(r.page.text == "mine" for r in out)
    by_id = {r.page.page_id: r.text for r in out}
    assert by_id[100] == "" and by_id[101] == "" and by_id[None] == by_id[0]
    assert by_id[0] == "\n".join(b.text for b in blocks_of(pages[0]) if teacher(b))


def test_empty_table(spark):
    assert extraction.extract(spark.createDataFrame([], "page_id bigint, url string, html string"), ["page_id"]).count() == 0


def test_formulas_and_fallback_texts_are_kept():
    page = """<body><article><p>Energy <math><mi>E</mi><mo>=</mo><mi>m</mi></math> is <svg><text>drawn</text></svg> here
      <canvas>now</canvas><p>Before<object data=x><p>Text instead of the object</p></object><p>After <video>no film</video><math>x"""
    blocks = blocks_of(page)
    assert [b.text for b in blocks] == ["Energy E=m is drawn here now", "Before", "Text instead of the object", "After no filmx"]
    assert blocks[2].path == ("body", "article", "object", "p")
    assert [b.text for b in blocks_of("<p>a <svg>b<p>the rest of the page")] == ["a b", "the rest of the page"]


def test_long_pages_are_learned_from(spark, pages):
    """All pages are longer than what is learned from one."""
    rows = [(i, f"http://h/{i}", p) for i, p in enumerate(pages) if len(p) > 1_500][:150]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    out = extraction.extract(frame, ["page_id"], ExtractionConfig(sample_bytes=1_000)).collect()
    wanted = {i: "\n".join(b.text for b in blocks_of(p) if teacher(b)) for i, _, p in rows}
    wrong = sum(r.text != wanted[r.page.page_id] for r in out)
    assert len(out) == len(rows) and wrong <= 0.1 * len(rows)


def test_excerpt_of_a_long_page():
    page = "<nav>" + "<li>beside</li>" * 500 + "</nav><article>" + "<p>main text of the page</p>" * 500 + "</article>"
    blocks = blocks_of(page)
    some = excerpt(blocks, 2_000, 3)
    assert 0 < sum(len(b.text) for b in some) <= 2_000 and {bool(teacher(b)) for b in some} == {True, False}
    assert excerpt(blocks, 100_000, 3) == blocks
    assert len(excerpt(blocks_of("<p>" + "long " * 9_000), 100, 3)) == 1


def test_the_teacher_knows_headings_and_articles():
    page = """<title>t</title><article class="post has-comments"><h1 class="entry-title">one</h1><h2 class="section-title meta">two</h2><p>three</p>
      <div class="meta">by</div><button>go</button><div class="comments"><article class="comment"><p>me too</p></article></div>
      <article class="comment"><p>and me</p></article></article><div>x</div><div class="related">y</div>"""
    assert [teacher(b) for b in blocks_of(page)] == [False, True, True, True, False, False, False, False, None, False]


def test_real_pages_without_their_marks(model, pages):
    """Names gone, `article` and `main` turned into plain elements; the labels come from the marked originals."""
    wrong = total = 0
    for page in pages[120:]:
        marked = blocks_of(page)
        plain = re.sub(r"\s(?:class|id|role)\s*=\s*(?:\"[^\"]*\"|'[^']*'|[^\s>]+)", "", page)
        plain = re.sub(r"<(/?)(?:article|main)\b", r"<\1div", plain)
        blocks = blocks_of(plain)
        assert [b.text for b in blocks] == [b.text for b in marked] and not any(" " in step for b in blocks for step in b.path)
        labels = [teacher(b) for b in marked]
        if None not in labels:
            wrong += int((model.label([blocks])[0] != np.array(labels)).sum())
            total += len(labels)
    assert total > 500 and wrong <= 0.05 * total


@pytest.mark.parametrize("page", [
    "<a " * 350_000, '<a "' * 250_000, "<a '\">" * 200_000, "<div>" * 200_000 + "</section>" * 100_000, "<!-" * 300_000, "<!" * 400_000,
    "<a " * 250_000 + '">"', "<script>" * 100_000, "<a '\"'" * 200_000 + ">",
])
def test_broken_pages_take_linear_time(page):
    started = time.process_time()
    blocks_of(page)
    assert time.process_time() - started < 8


def test_deep_pages(model):
    """Blocks at 10,000 levels share their paths."""
    blocks = blocks_of("<div class=c>x" * 10_000)
    assert len(blocks) == 10_000 and len(blocks[-1].path) == 10_000
    tracemalloc.start()
    started = time.process_time()
    model.label([blocks])
    assert time.process_time() - started < 30 and tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
    copies = unpacked(*json.loads(json.dumps(packed(blocks[:50]))))
    assert [(b.text, b.path, b.linked) for b in copies] == [(b.text, b.path, b.linked) for b in blocks[:50]]


def test_long_pages_are_read_in_slices(model, pages):
    blocks = [b for p in pages[:40] for b in blocks_of(p)]
    whole, sliced = model.label([blocks], slice_=len(blocks))[0], model.label([blocks], slice_=37)[0]
    assert (whole == sliced).all()


def test_long_pages_take_bounded_memory(model):
    blocks = blocks_of("<article>" + "<p>one two" * 20_000 + "</article>")
    tracemalloc.start()
    assert len(model.label([blocks])[0]) == 20_000
    assert tracemalloc.get_traced_memory()[1] < 100 << 20
    tracemalloc.stop()
