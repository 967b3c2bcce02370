"""Language-model scores against exact counts, and on input that comes from a shuffle."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from formflow.llm import log_bloom


def tokens_of(text):
    return [x for x in re.split(r"[\x20\x09-\x0D]+", text or "") if x] + ["\0"]


def quantised(count):
    return float(log_bloom.expected(log_bloom.levels(np.array([count])))[0]) if count else 0.0


def model_of(texts):
    words, pairs, contexts = Counter(), Counter(), Counter()
    for text in texts:
        found = tokens_of(text)
        words.update(found)
        pairs.update(zip(["\1", *found], found, strict=False))
        contexts["\1"] += 1
    total, distinct = sum(words.values()), len(words)

    def score(text):
        found, out = tokens_of(text), 0.0
        for v, w in zip(["\1", *found], found, strict=False):
            c_v, c_w = quantised((words | contexts)[v]), quantised(words[w])
            c_pair = min(quantised(pairs[v, w]), c_v, c_w)
            back = log_bloom.BACK if c_v else 0.0
            out += math.log10(back * (c_pair / c_v if c_v else 0) + (1 - back) * (c_w + 1) / (total + distinct + 1))
        return out

    return score


@pytest.mark.parametrize("segment_bytes", [1 << 27, 400])
def test_scores_are_those_of_exact_counts(spark, segment_bytes):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{min(rng.randrange(200), rng.randrange(200))}" for _ in range(rng.randint(0, 60)))
    training, other = [text() for _ in range(150)], [text() + " unseen words here w1" for _ in range(60)] + ["", None, "never at all"]
    rows = [(i, t) for i, t in enumerate(training + other)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = log_bloom.score(docs, docs.where("doc_id < 150"), keep=["doc_id"], segment_bytes=segment_bytes).collect()
    assert len(out) == len(rows)
    score = model_of(training)
    off = [abs(r.score - score(rows[r["__row"].doc_id][1])) / abs(r.score) for r in out]
    # a probe of the filter is wrong once in a hundred, and never makes a count too low
    assert sorted(off)[len(off) // 2] < 1e-6 and max(off) < 0.05
    known = tokens_of("never at all")
    assert all(math.isfinite(r.score) for r in out) and len(known) == 4


def test_probabilities_after_an_unseen_word_have_the_whole_weight(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "new a")], "doc_id long, text string")
    out = {r["__row"].doc_id: r.score for r in log_bloom.score(docs, docs.where("doc_id = 1")).collect()}
    n, v = 4, 4  # a, b, c and the end
    back = log_bloom.BACK
    want = math.log10((1 - back) * 1 / (n + v + 1))  # "new" after the begin mark
    want += math.log10(2 / (n + v + 1))  # "a" after a word that never occurs
    want += math.log10((1 - back) * 2 / (n + v + 1))  # the end after "a"
    assert abs(out[2] - want) < 1e-9


@pytest.mark.parametrize("segment_bytes", [1 << 27, 20_000])
def test_input_from_a_shuffle_keeps_every_row(spark, segment_bytes):
    """Reading fewer columns must not number the rows of an adaptive shuffle in another way."""
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.adaptive.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "20k")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        rng = random.Random(9)
        rows = [(i, " ".join(f"w{rng.randrange(300)}" for _ in range(1 + i % 50))) for i in range(3000)]
        docs = spark.createDataFrame(rows + rows[:500], "doc_id long, text string").dropDuplicates()
        out = log_bloom.score(docs, docs, keep=["doc_id"], segment_bytes=segment_bytes).collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert {r["__row"].doc_id: r.n_tokens for r in out} == {i: 2 + i % 50 for i, _ in rows} and len(out) == 3000


def test_texts_go_to_python_in_small_batches(spark, monkeypatch):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before, seen, staged = spark.conf.get(key), {}, log_bloom.staged
    monkeypatch.setattr(log_bloom, "staged", lambda df, name: (seen.setdefault(name, int(spark.conf.get(key))), staged(df, name))[1])
    docs = spark.range(1500).selectExpr("id as doc_id", "concat('a b ', id) as text")
    out = log_bloom.score(docs, docs, keep=["doc_id"]).collect()
    assert len(out) == 1500 and {r.n_tokens for r in out} == {4}
    assert seen == {"grams": log_bloom.TEXTS, "scores": log_bloom.TEXTS} and spark.conf.get(key) == before
