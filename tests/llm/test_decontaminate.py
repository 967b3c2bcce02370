"""Decontamination: runs of every length, single hits, longest matches, shards and blocks against brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest

from formflow.llm import decontaminate


def brute_longest(words, item):
    """The longest common run that holds a window: words, place in the text, place in the item."""
    best = None
    size = min(13, len(item))
    for s in range(len(words)):
        for a in range(len(item)):
            n = 0
            while s + n < len(words) and a + n < len(item) and words[s + n] == item[a + n]:
                n += 1
            if n >= size and size and (best is None or (-n, s, a) < (-best[0], *best[1:])):
                best = (n, s, a)
    return best


@pytest.mark.parametrize("item_words", [13, 14, 40, 70, 200, 600])
def test_a_run_of_every_length_is_found(item_words):
    """A single text that holds the item's first n words and nothing else: the shard has one short run."""
    item = [f"t{i}" for i in range(item_words)]
    block = decontaminate.Block([("i", " ".join(item).encode())])
    for n in range(13, item_words + 1):
        found = decontaminate.search(block, [b"other words", " ".join(item[:n]).encode()])
        assert sorted(found["start"].tolist()) == list(range(2, 2 + n - 12)), n
        assert decontaminate.longest_in(found) == {(1, 0): (n, 0, 0)}
        assert found["best"][0] == n and found["where"][0] == 2


def test_one_hit_in_a_clean_corpus(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randrange(5000)}"
    item = [word() for _ in range(90)]
    texts = [" ".join(word() for _ in range(rng.randint(0, 200))) for _ in range(400)]
    texts[123] += " " + " ".join(item[40:57]) + " end"
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(1, " ".join(item)), (2, "short lonely item of eight words of which none")], "item_id long, text string")
    hit = decontaminate.matches(docs, bench).where("n_hit > 0").collect()
    assert [(r["__row"].doc_id, r.n_hit, list(r["items"])) for r in hit] == [(123, 17, ["1"])]
    assert [tuple(m) for m in hit[0].longest] == [("1", 17, len(texts[123].split()) - 18, 40)]


@pytest.mark.parametrize(("block_bytes", "shard_bytes"), [(8 << 20, 4 << 20), (200, 4 << 20), (8 << 20, 300), (90, 100)])
def test_longest_matches_are_those_of_brute_force(spark, monkeypatch, block_bytes, shard_bytes):
    rng = random.Random(7)
    monkeypatch.setattr(decontaminate, "SHARD_BYTES", shard_bytes)
    items = [[f"w{rng.randrange(4)}" for _ in range(n)] for n in (5, 12, 13, 14, 20, 60, 300)] + [["lone", "words"]]
    texts = []
    for _ in range(40):
        words = []
        for _ in range(rng.randint(0, 4)):
            item = rng.choice(items)
            a = rng.randrange(len(item))
            words += item[a : a + rng.randint(1, 40)] + [f"w{rng.randrange(4)}" for _ in range(rng.randint(0, 6))]
        texts.append(words)
    texts += [texts[3], texts[3], []]
    # repeated rows, an item twice, items of one id, a column named like one of the operator's
    docs = spark.createDataFrame([(i, " ".join(w), "mine") for i, w in enumerate(texts)], "doc_id long, text string, longest string")
    bench = [(k, " ".join(w)) for k, w in enumerate(items)] + [(2, " ".join(items[2])), (0, "another text of the first id")]
    found = decontaminate.matches(docs, spark.createDataFrame(bench, "item_id long, text string"), block_bytes)
    best = {}
    for r in found.collect():
        assert r["__row"].longest == "mine"
        i = r["__row"].doc_id
        want = {str(k): m for k, w in enumerate(items) if (m := brute_longest(texts[i], w))}
        assert {m["item"]: (m.words, m.doc_word, m.item_word) for m in r.longest} == want, texts[i]
        assert list(r["items"]) == sorted(want)
        for k, (n, s, a) in want.items():
            best[k] = min(best.get(k, (0,)), (-n, i, s, a))
    got = decontaminate.longest_matches(found).collect()
    assert {r["item"]: (-r.words, r.doc_id, r.doc_word, r.item_word) for r in got} == best
    assert decontaminate.longest_matches(found.limit(0)).collect() == []


def test_suffix_array_is_sorted():
    rng = np.random.default_rng(3)
    for n in range(1, 60):
        ids = np.append(rng.integers(0, 3, n), -1)
        starts = np.flatnonzero(ids >= 0)
        order = decontaminate.suffix_array(ids, starts, 100)
        text = ids.tolist()
        assert order.tolist() == sorted(starts.tolist(), key=lambda i: text[i:])
