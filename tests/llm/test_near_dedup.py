"""Near duplicates against brute force, and ProbMinHash against the exact similarity."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest

from formflow.llm import near_dedup as nd

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def shingle_set(text):
    words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_classes(rows):
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(text or "", []).append(doc_id)
    keys, sets = list(texts), [shingle_set(t) for t in texts]
    parent = list(range(len(keys)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and both / len(sets[i] | sets[j]) >= 0.8:
                parent[root(i)] = root(j)
    groups = {}
    for i, k in enumerate(keys):
        groups.setdefault(root(i), set()).update(texts[k])
    return {frozenset(g) for g in groups.values()}


def words_of(rng, n):
    return ["".join(rng.choices("abcdefghij", k=rng.randint(2, 5))) for _ in range(n)]


def corpus(rng):
    rows, n = [], 0
    shared = words_of(rng, 60)
    for _ in range(12):
        base = words_of(rng, rng.choice([3, 30, 120]))
        for copy in range(rng.choice([1, 2, 8])):
            text = list(base)
            if copy and len(text) > 100 and rng.random() < 0.8:
                text[rng.randrange(len(text))] = "edited" + str(copy)
            rows.append((n, " ".join(text)))
            n += 1
    for _ in range(8):
        rows.append((n, " ".join(words_of(rng, 40) + shared + words_of(rng, 40))))
        n += 1
    return [*rows, (n, None), (n + 1, ""), (n + 2, "One"), (n + 3, "one!"), (n + 4, "one")]


@pytest.mark.parametrize(("block", "block_bytes"), [(512, 4 << 20), (3, 4 << 20), (512, 700)])
def test_classes_are_those_of_brute_force(spark, block, block_bytes, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", block)
    monkeypatch.setattr(nd, "BLOCK_BYTES", block_bytes)
    rows = corpus(random.Random(32))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in nd.near_duplicates(docs).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes(rows)
    assert all(k == min(v) for k, v in got.items())


def test_single_links_between_components_of_large_buckets(spark, monkeypatch):
    monkeypatch.setattr(nd, "BLOCK", 40)
    rng = random.Random(5)
    # ten slots of two passages: texts that differ in one slot are linked, in two they are not
    slots = [[words_of(rng, 40) for _ in range(2)] for _ in range(10)]
    text = lambda n: " ".join(w for k in range(10) for w in slots[k][n >> k & 1])
    # each of the last ones is linked to one of the first 512 and to nothing else
    lone = []
    for n in range(512, 1024):
        if all((n ^ x).bit_count() > 2 for x in lone):
            lone.append(n)
    rows = [(n, text(n)) for n in [*range(512), *lone]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in nd.near_duplicates(docs).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes(rows)


def test_copies_that_repeat_a_passage_more_often_are_linked(spark):
    rng, rows = random.Random(8), []
    for _ in range(12):
        body, line = words_of(rng, 200), words_of(rng, 20)
        rows += [(len(rows), " ".join(body + line * 2)), (len(rows) + 1, " ".join(body + line * 20))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {}
    for r in nd.near_duplicates(docs).collect():
        got.setdefault(r.class_id, set()).add(r.doc_id)
    assert {frozenset(g) for g in got.values()} == brute_classes(rows) == {frozenset((k, k + 1)) for k in range(0, 24, 2)}


def test_a_large_group_of_texts_that_are_alike_but_not_linked(spark, monkeypatch):
    """2,000 texts at about 0.7 of each other, two of them at more: one link, and no more rows than members."""
    monkeypatch.setattr(nd, "BLOCK", 200)
    rng = random.Random(6)
    base = words_of(rng, 300)
    rows = []
    for n in range(2000):
        text = list(base)
        for k in range(5):
            text[(n * 7 + k * 60 + rng.randrange(50)) % 300] = f"own{n}x{k}"
        rows.append((n, " ".join(text)))
    twin = rows[700][1].split()
    twin[150] = "twin"
    rows.append((5000, " ".join(twin)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    sets = {n: frozenset(shingle_set(t)) for n, t in rows}
    found = {r.doc_id: r.class_id for r in nd.near_duplicates(docs).collect()}
    texts = nd.distinct_texts(docs)
    met = nd._buckets(texts).count()
    assert met <= 2001 * nd.BANDS
    order = sorted(sets)
    index = {s: i for i, s in enumerate({s for v in sets.values() for s in v})}
    member = np.zeros((len(order), len(index)), np.float32)
    for k, n in enumerate(order):
        member[k, [index[s] for s in sets[n]]] = 1
    both = member @ member.T
    size = member.sum(1)
    near = both >= 0.8 * (size[:, None] + size[None] - both) - 1e-4
    label = np.arange(len(order))
    while True:  # least label among neighbours
        new = np.where(near, label[None], len(order)).min(1)
        if (new == label).all():
            break
        label = new
    assert found == {n: order[label[k]] for k, n in enumerate(order)}
    assert found[5000] == found[700] and len(set(found.values())) > 1000


def test_a_very_long_text_and_clashing_columns(spark):
    long = " ".join(f"w{i % 4999}" for i in range(60_000))
    rows = [(1, long, "x"), (2, long + " end", "y"), (2, long + " end", "y"), (3, "short text of six words here", None), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id string")
    out = sorted((r.doc_id or 0, r.class_id or 0, r.class_rows, r.stays) for r in nd.near_duplicates(docs).collect())
    assert out == [(0, 0, 1, True), (1, 1, 3, True), (2, 1, 3, False), (2, 1, 3, False), (3, 3, 1, True)]
    assert nd.keep_one(docs).columns == docs.columns


def test_one_row_of_a_class_stays_with_all_columns(spark):
    rows = [(1, "x", "a b c d e f"), (1, "x", "a b c d e f"), (2, "y", "a b c d e f"), (3, "z", None), (4, "z", ""), (None, "n", "solo words here")]
    docs = spark.createDataFrame(rows, "doc_id long, copy_key string, text string")
    kept = nd.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.copy_key) for r in kept.collect()) == [(0, "n"), (1, "x"), (3, "z")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nd.near_duplicates(docs).collect() == [] and nd.keep_one(docs).collect() == []


def test_registers_agree_with_probability_jaccard():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 2**63, 300, dtype=np.uint64)
    ids.sort()
    x, y = rng.integers(1, 9, 200).astype(float), rng.integers(1, 9, 200).astype(float)
    a, b = (ids[:200], x), (ids[100:], y)
    m = 20000
    found = nd.signatures(np.concatenate([a[0], b[0]]), np.concatenate([x, y]), np.array([0, 200, 400]), m)
    weight = {}
    for part, (keys, w) in enumerate((a, b)):
        for k, v in zip(keys.tolist(), w / w.sum(), strict=True):
            weight.setdefault(k, [0, 0])[part] = v
    want = sum(
        1 / sum(max(p[0] / v[0], p[1] / v[1]) for p in weight.values()) for v in weight.values() if v[0] and v[1]
    )
    assert abs((found[0] == found[1]).mean() - want) < 0.02
    assert abs(nd.similarity(a, b) - max(want, 100 / 300)) < 1e-9


@pytest.mark.parametrize("hot", [1000, 3])
def test_components_of_stars_chains_and_repeated_links(spark, hot, monkeypatch):
    from formflow.llm import components as cc

    monkeypatch.setattr(cc, "HOT", hot)
    rng = random.Random(3)
    links = [(500, k) for k in range(300)] + [(k + 1000, k + 1001) for k in range(40)] + [(2000, 2000), (7, 7)] + [(3001, 3000), (3000, 3001)] * 3
    links += [(rng.randrange(5000, 5100), rng.randrange(5000, 5100)) for _ in range(70)]
    rng.shuffle(links)
    want = {x: x for p in links for x in p if p[0] != p[1]}
    for _ in range(60):
        for a, b in links:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    got = cc.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.id: r.root for r in got} == want and len(got) == len(want)
    assert cc.components(spark.createDataFrame([], "a long, b long")).collect() == []
