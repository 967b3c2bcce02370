"""Centroid clustering, periodic runs and SimHash against brute force, and their edge cases."""

from __future__ import annotations

import hashlib
import math
import random
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash

from formflow.llm import orchard, periodic_runs, queries, simhash

LONG = " ".join(f"word{i % 977}" for i in range(30_000))


def documents(spark, more=()):
    rows = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", "c"), (4, LONG, None), (5, "x y z", "d"), (5, "x y z", "d"), (None, "X y z", None), *more]
    return spark.createDataFrame(rows, "doc_id long, text string, n_words string")


def stored(rows, tmp_path, name):
    rows.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


# --- centroid clustering -----------------------------------------------------------------


def brute_clusters(vectors, k=16, rounds=3, dims=64, scale=64):
    kept = [(i, [math.floor(Fraction(x) * scale) for x in v]) for i, v in vectors if v and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in kept)[:k]
    centroids = [v for _, v in first]
    nearest = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(groups[j]) for x in zip(*groups[j], strict=True)] if groups[j] else c for j, c in enumerate(centroids)]
    return [(i, j, d) for i, v in kept for d, j in [nearest(v)]], centroids


@pytest.mark.parametrize("kind", ["spread", "ties", "few", "huge"])
def test_clusters_are_those_of_brute_force(spark, tmp_path, kind):
    rng = random.Random(kind)
    point = {
        "spread": lambda: [float(np.float32(rng.gauss(0, 0.3))) for _ in range(64)],
        "ties": lambda: [rng.choice([0.0, 0.015625]) if i < 4 else -0.5 for i in range(64)],
        "few": lambda: [rng.random() for _ in range(64)],
        "huge": lambda: [rng.choice([1.0, -2.0**70, 2.0**100, 3.0**40]) for _ in range(64)],
    }[kind]
    rows = [(i, point()) for i in range({"spread": 200, "ties": 150, "few": 9, "huge": 40}[kind])]
    rows += [rows[3], (None, point()), (900, None), (901, []), (902, [0.1] * 63), (903, [0.1] * 65), (904, [None] + [0.1] * 63)]
    rows += [(905, [math.nan] + [0.1] * 63), (906, [math.inf] * 64)]
    df = spark.createDataFrame([(i, v, "mine") for i, v in rows], "vec_id long, embedding array<double>, cluster string")
    assigned, centroids = orchard.clusters(df.repartition(3))
    want, final = brute_clusters(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    largest = 2**63 - 1
    got = sorted(((r["__row"].vec_id, r.cluster, r.distance) for r in assigned.collect()), key=key)
    assert got == sorted(((i, j, min(d, largest)) for i, j, d in want), key=key)
    assert centroids == final and {r["__row"].cluster for r in assigned.collect()} == {"mine"}
    out = queries.op11_centroid_clustering(spark, stored(df.drop("cluster"), tmp_path, "embeddings")).collect()
    total, own = sum(min(d, largest) for *_, d in want), defaultdict(int)
    for _, j, d in want:
        own[j] += min(d, largest)
    for r in out:
        assert r.inertia == min(total, largest) and r.cluster_inertia == min(own[r.cluster], largest)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, final[r.cluster])).encode()).hexdigest()


def test_clusters_of_nothing(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, [1.0])], "vec_id long, embedding array<float>")
    assert orchard.clusters(df)[0].collect() == []
    out = queries.op11_centroid_clustering(spark, stored(df.limit(0), tmp_path, "embeddings"))
    assert out.collect() == [] and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]


def test_the_lists_spare_distances():
    rng = np.random.default_rng(5)
    centroids = rng.integers(-1000, 1000, (40, 8))
    x = (centroids[rng.integers(0, 40, 500)] + rng.integers(-30, 30, (500, 8))).astype(np.int64)
    cluster, distance, made = orchard.Orchard(centroids.tolist()).nearest(x)
    every = ((x[:, None] - centroids[None]) ** 2).sum(-1)
    assert (cluster == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert made < 500 * 40 / 2


# --- periodic runs -----------------------------------------------------------------------


def brute_runs(words, least):
    out, n = set(), len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(least, 2 * q) and not any(
                all(words[i + k] == words[i + k + d] for k in range(length - d)) for d in range(1, q)
            ):
                out.add((i, length, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_are_those_of_brute_force(least):
    rng = random.Random(least)
    texts = []
    for _ in range(700):
        words = [f"w{rng.randint(1, rng.choice([1, 2, 3, 30]))}" for _ in range(rng.randint(0, 60))]
        if words and rng.random() < 0.6:
            a = rng.randrange(len(words))
            p = 1 + (len(words) - a) // rng.randint(2, 6)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)] + words[: rng.randint(0, 9)]
        texts.append(words)
    for at in range(0, 700, 7):  # several in a batch: nothing crosses from one text into the next
        some = texts[at : at + 7]
        words, runs = periodic_runs.find_runs([" \n".join(w).encode() for w in some], least)
        for w, got, r in zip(some, words, runs, strict=True):
            want = brute_runs(w, least)
            assert [x.decode() for x in got] == w and [(s, n, q) for s, q, n in r.tolist()] == want, w
            assert periodic_runs.collapsed(got, r).decode() == brute_collapsed(w, want)


def test_extensions_and_suffix_order():
    rng = random.Random(8)
    text = [rng.randint(1, 3) for _ in range(200)]
    tree = periodic_runs.SuffixTree(text)
    assert sorted(range(201), key=lambda i: text[i:]) == np.argsort(tree.rank_up).tolist()
    assert sorted(range(201), key=lambda i: [-x for x in text[i:]]) == np.argsort(tree.rank_down).tolist()
    pairs = [(a, b) for a in range(0, 201, 3) for b in range(201) if a != b]
    common = lambda a, b: next((k for k in range(201) if max(a, b) + k >= 200 or text[a + k] != text[b + k]), 0)
    a, b = np.array(pairs).T
    assert tree.extension(a, b).tolist() == [common(*p) for p in pairs]


def planted_words(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def test_runs_query(spark, tmp_path):
    rng = random.Random(4)
    more = [(100 + i, " ".join(rng.choice(["ab", "cd", "É", "\x0b\x1c"]) for _ in range(rng.randint(0, 150))), "x") for i in range(120)]
    more += [(300, "\x85 a b c " * 12, ""), (301, "a " * 13, "")]
    docs = documents(spark, more)
    out = queries.op12_periodic_runs(spark, stored(docs, tmp_path, "documents")).collect()
    by_id = defaultdict(list)
    for r in out:
        by_id[r.doc_id].append(r)
    rows = docs.collect()
    assert len(out) == len(rows) and any(zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows)
    for row in rows:
        words = [w.decode() for w in planted_words(row.doc_id, row.text)]
        r = by_id[row.doc_id].pop()
        want = brute_runs(words, 12) if len(words) < 1000 else [(0, 30_000, 977)]
        assert r.n_runs == len(want), row
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert (r.start, r.length, r.period) == (best or (None,) * 3)
        assert r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in want).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(brute_collapsed(words, want).encode()).hexdigest()


def test_runs_leave_other_columns_alone(spark):
    out = periodic_runs.periodic_runs(documents(spark)).collect()
    assert {(r["__row"].doc_id, r["__row"].n_words) for r in out} >= {(1, "a"), (4, None), (None, None)}
    assert periodic_runs.periodic_runs(documents(spark).limit(0)).collect() == []


# --- SimHash -----------------------------------------------------------------------------


def brute_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    shingles = [words[i : i + 3] for i in range(len(words) - 2)] if len(words) > 2 else [words] if words else []
    hashes = [xxhash.xxh64_intdigest(b" ".join(s), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(prints):
    """The smallest member of each fingerprint's class."""
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    distinct = sorted(root)
    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {p: find(p) for p in root}


def test_fingerprints_are_those_of_brute_force():
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["Ab", "cÉ", "x", "Ω1"]) for _ in range(rng.randint(0, 40))) for _ in range(200)] + ["", " \x0b ", "One", "a\x1cb"]
    assert simhash.fingerprint_of([t.encode() for t in texts]).tolist() == [brute_fingerprint(t) for t in texts]


@pytest.mark.parametrize("few", [256, 2])
def test_links_join_what_is_close(spark, few):
    """Random ones, close pairs over all bits, a chain, and a family that shares most bits; also with longer keys for nearly all."""
    rng = random.Random(few)
    base = [rng.getrandbits(64) for _ in range(12)]
    prints = {0, 1, 3, 2**63, 2**64 - 1}
    for p in base:
        prints |= {p ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64) for _ in range(4)} | {p}
    chain = rng.getrandbits(64)
    for k in range(0, 40, 2):
        chain ^= 3 << k
        prints.add(chain)
    prints |= {base[0] ^ rng.getrandbits(6) << 20 ^ rng.getrandbits(5) << 40 for _ in range(150)}
    entries = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fingerprint long")
    found = [(r.a % 2**64, r.b % 2**64) for r in simhash.links(entries, few).collect()]
    assert all((a ^ b).bit_count() <= 2 and a != b for a, b in found)
    want, got = brute_classes(prints), {p: p for p in prints}
    for _ in range(len(prints)):
        changed = False
        for a, b in found:
            low = min(got[a], got[b])
            changed |= got[a] != low or got[b] != low
            got[a] = got[b] = low
        if not changed:
            break
    assert got == want


def test_simhash_query(spark, tmp_path):
    rng = random.Random(2)
    more, base = [], [[f"w{rng.randrange(60)}" for _ in range(120)] for _ in range(6)]
    for i in range(90):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "new"
        more.append((500 - i, " ".join(words), "x"))
    docs = documents(spark, more)
    rows = docs.collect()
    out = queries.op13_simhash_near_dedup(spark, stored(docs, tmp_path, "documents")).collect()
    prints = [brute_fingerprint(r.text) for r in rows]
    root, least = brute_classes(set(prints)), {}
    for r, p in zip(rows, prints, strict=True):
        if r.doc_id is not None:
            least[root[p]] = min(r.doc_id, least.get(root[p], r.doc_id))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, out), key=key) == sorted(((r.doc_id, f"{p:016x}", least.get(root[p])) for r, p in zip(rows, prints, strict=True)), key=key)
    assert len({r.component_id for r in out}) < len(set(prints))
    whole = simhash.near_duplicates(docs)
    assert whole.where("__row.n_words = 'd'").count() == 2 and simhash.near_duplicates(docs.limit(0)).collect() == []
