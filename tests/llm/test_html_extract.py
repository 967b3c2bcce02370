"""Block labeller: gradients, held-out accuracy, markup and edge cases."""

from __future__ import annotations

import random

import numpy as np

from formflow.llm import html_extract as he


def test_gradients_are_those_of_finite_differences():
    rng = np.random.default_rng(3)
    model = he.Labeller(seed=3)
    model.weights = {k: v.astype(np.float64) for k, v in model.weights.items()}
    pages = [rng.normal(size=(n, he.FEATURES)) for n in (4, 2)]
    x, there = he.stacked(pages)
    x, wanted = x.astype(np.float64), rng.integers(0, 2, there.shape).astype(float)

    def loss():
        s = model.scores(x, there)
        return float(np.where(there, np.logaddexp(0, s) - wanted * s, 0).sum() / there.sum())

    grads = model.gradients(x, there, wanted)
    for name, w in model.weights.items():
        at = np.unravel_index(np.argmax(np.abs(grads[name])), w.shape)
        old = w[at]
        w[at] = old + 1e-3
        up = loss()
        w[at] = old - 1e-3
        down = loss()
        w[at] = old
        assert abs((up - down) / 2e-3 - grads[name][at]) < 2e-3, name


def test_held_out_pages():
    model, rng = he.trained(), random.Random(12345)
    wrong = total = 0
    for _ in range(150):
        page, marks = he.example(rng)
        found = he.leaves(page)
        assert len(found) == len(marks)
        x, there = he.stacked([he.features(found)])
        wrong += int(((model.scores(x, there)[:, 0] > 0) != np.array(marks)).sum())
        total += len(marks)
    assert wrong / total < 0.02


def test_a_page_alone_and_among_others_is_labelled_alike():
    rng = random.Random(5)
    pages = [he.example(rng)[0] for _ in range(20)]
    together = he.main_text(pages, he.trained())
    assert together == [he.main_text([p], he.trained())[0] for p in pages]


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var a="<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav><!-- <p>gone</p> -->
<div class="cookie-notice"><p>We use cookies on this site.</p></div>
<article><h1>Tea &amp; r&eacute;sum&#233;</h1><p>First   line<br>goes\n on <i>and</i> on&nbsp;here.<p>Short.</p>
<p>A longer paragraph with several words that says something about tea and how it is made.</p></article>
<section class="comments"><p>Great post, thanks!</p></section>
<form><label>Mail</label><button>Send</button></form><footer>&copy; 2020 somebody</footer></body></html>"""


def test_text_of_a_page(spark):
    rows = [(1, "u", PAGE, "mine"), (1, "u", PAGE, "mine"), (2, None, None, ""), (3, "v", "", None), (4, "w", "<p", None), (None, "x", "<nav>a</nav>", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    out = he.extract(pages).collect()
    assert sorted((r["__row"].page_id or 0) for r in out) == [0, 1, 1, 2, 3, 4]
    want = "Tea & résumé\nFirst line goes on and on here.\nShort.\nA longer paragraph with several words that says something about tea and how it is made."
    for r in out:
        assert r.text == (want if r["__row"].page_id == 1 else r.text)
        assert r["__row"].page_id in (1, 4) or r.text == ""
        assert r["__row"].text in ("mine", "", None)
    assert he.extract(pages.limit(0)).collect() == []


def test_broken_and_long_markup_ends():
    for page in ("<" * 5000, "<p>" * 3000 + "x", "<div class='a", "<!-- open", "<script>never", "&#xFFFFFFF; &bogus; <p>ok", "<a" + " b=\"'" * 2000):
        he.leaves(page)
    long = "<article>" + "".join(f"<p>Paragraph number {i} says a few words.</p>" for i in range(5000)) + "</article>"
    assert he.main_text([long], he.trained())[0].count("\n") > 4900
