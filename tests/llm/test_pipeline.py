"""The pipeline against brute force over a small table, and what deleting the folder leaves."""

from __future__ import annotations

import hashlib
import random
import re
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
import public_tokenizers
import tiktoken

import corpus_pipeline
from formflow.llm import byte_bpe
from tests.llm.test_near_dedup import shingle_set

ROOT = Path(__file__).resolve().parents[2]
SPACE = re.compile(r"[\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(rng, n):
    return ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 7))) for _ in range(n)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(11)
    items = [" ".join(words_of(rng, n)) for n in (20, 30, 8)]
    rows = []
    for k in range(14):
        rows.append(" ".join(words_of(rng, 150)))
        if k % 3 == 0:  # a near copy and an exact one
            words = rows[-1].split()
            words[70] = "changed"
            rows += [" ".join(words), rows[-1]]
    rows.append(" ".join(words_of(rng, 60)) + "\n" + items[0] + " " + " ".join(words_of(rng, 60)))
    rows.append(" ".join(words_of(rng, 900)) + " " + items[1].upper())  # hit, but less than a twentieth
    rows += ["too short", "", None, " ".join(["spam ham eggs and more"] * 40), " ".join(w + "###" for w in words_of(rng, 90))]
    at = tmp_path_factory.mktemp("pipe")
    docs = [(i, t, "en", "src", len(t or "")) for i, t in enumerate(rows)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{at}/benchmark.parquet")
    return str(at), dict(enumerate(rows)), items


def brute(rows, items):
    def good(t):
        w = [x for x in SPACE.split(t or "") if x]
        grams = list(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
        return len(w) >= 50 and 100 * len(covered) <= 40 * len(w) and 10 * len(re.findall(r"[#*$%&|<>]", t)) <= len(w)

    left = {k: t for k, t in rows.items() if good(t)}
    kept = {}
    for k in sorted(left):
        s = shingle_set(left[k])
        if not any(len(s & o) >= 0.8 * len(s | o) for o in map(shingle_set, kept.values())):
            kept[k] = left[k]
    windows = set()
    for t in items:
        w = ALNUM.findall(t.lower())
        size = min(13, len(w))
        windows |= {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}
    out = {}
    for k, t in kept.items():
        w, hit = ALNUM.findall(t.lower()), set()
        for size in {len(x) for x in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) in windows:
                    hit |= set(range(i, i + size))
        if not (hit and 20 * len(hit) >= len(w)):
            out[k] = t
    return out


def test_pipeline_is_brute_force(spark, folder):
    at, rows, items = folder
    want = brute(rows, items)
    assert 10 < len(want) < 20
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, at).collect()}
    assert set(got) == set(want)
    for k, t in want.items():
        ids = library.encode_ordinary(t)
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()


def test_stages_keep_the_columns_of_documents(spark, folder):
    docs = spark.read.parquet(f"{folder[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, folder[0]).collect() == []


def test_nulls_repeats_ties_and_clashing_columns(spark, folder, tmp_path):
    """Rows alike, rows without id or text, a long text, and columns named as the stages name theirs."""
    rng = random.Random(12)
    good = [" ".join(words_of(rng, 120)) for _ in range(6)]
    long = " ".join(words_of(rng, 20_000))
    near = good[3].rsplit(" ", 1)[0] + " other"
    rows = [(1, good[0]), (1, good[0]), (2, good[0]), (None, good[1]), (None, good[1]), (3, None), (4, ""), (5, " \n "), (6, good[3]), (7, near), (None, near)]
    rows += [(8, long), (9, good[4]), (9, good[4] + " x"), (9, good[5])]
    names = ["doc_id", "text", "__row", "copy_key", "row_no", "spans", "kept", "id", "class_id"]
    full = [(*r, f"a{i}", "b", "c", "d", "e", "f", "g") for i, r in enumerate(rows)]
    docs = spark.createDataFrame(full, "doc_id long, text string, " + ", ".join(f"{n} string" for n in names[2:])).repartition(3)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder[0])
        assert docs.columns == names
    left = sorted((r.doc_id or 0, r.text) for r in docs.collect())
    # of the two rows with doc_id 9 that are near each other one stays: the one of the least text key or the other
    assert [x for x in left if x[0] != 9] == [(0, good[1]), (1, good[0]), (6, good[3]), (8, long)]
    assert (9, good[5]) in left and len([x for x in left if x[0] == 9]) == 2
    out = corpus_pipeline.STAGES[-1][1](spark, docs, folder[0]).collect()
    assert sorted(r.doc_id or 0 for r in out) == [0, 1, 6, 8, 9, 9] and all(r.n_tokens > 0 for r in out)


def test_the_rest_imports_without_this_folder(tmp_path):
    for name in ("formflow", "__spark_entry__.py"):
        source = ROOT / name
        copy = shutil.copytree if source.is_dir() else shutil.copy
        copy(source, tmp_path / name, **({"ignore": shutil.ignore_patterns("llm", "__pycache__")} if source.is_dir() else {}))
    code = "import __spark_entry__ as e; assert len(e.queries()) > 100 and not any(q.startswith('op') for q in e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin", "PYTHONPATH": str(tmp_path)})
