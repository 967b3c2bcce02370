"""Shards against a plain curve and plain counting."""

from __future__ import annotations

import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from formflow.llm import hilbert_shards as hs


def curve(spark, dims, bits):
    cells = list(itertools.product(range(1 << bits), repeat=dims))
    df = spark.createDataFrame([(list(c),) for c in cells], "cell array<int>")
    rows = df.select("cell", hs.hilbert_index("cell", dims, bits).alias("i")).collect()
    return {r.i: r.cell for r in rows}


@pytest.mark.parametrize("dims,bits", [(2, 1), (2, 3), (3, 2), (3, 3)])
def test_the_curve_visits_all_cells_by_single_steps(spark, dims, bits):
    at = curve(spark, dims, bits)
    assert sorted(at) == list(range(1 << dims * bits))
    for i in range(1, len(at)):
        assert sum(abs(a - b) for a, b in zip(at[i - 1], at[i], strict=True)) == 1


def table(spark):
    rows = [(i, "text " * (i % 37), f"src{i % 5}" if i % 3 else "src0", "en" if i % 4 else None, i % 37 * 5, "mine") for i in range(500)]
    rows += [(None, None, None, None, None, None), (7, "ties", "src0", "en", 4, "a"), (7, "ties", "src0", "en", 4, "a")]
    rows.append((900, "ü" * 40_000, "src9", "de", 40_000, None))
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long, shard string")


@pytest.mark.parametrize("law", ["rows", "bytes"])
@pytest.mark.parametrize("part_rows", [5000, 8])
def test_shards_hold_every_row_once(spark, law, part_rows):
    rows, docs = table(spark)
    out = hs.shards(docs, 7, law, part_rows=part_rows).collect()
    assert sorted((r["__row"].doc_id or -1, r["__row"].text or "") for r in out) == sorted((r[0] or -1, r[1] or "") for r in rows)
    assert {r["__row"].shard for r in out} == {"mine", "a", None}
    for r in out:
        raw = (r["__row"].text or "").encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))
    by_shard = {s: sorted((r.slot, r.curve) for r in out if r.shard == s) for s in {r.shard for r in out}}
    for found in by_shard.values():
        assert [slot for slot, _ in found] == list(range(len(found)))
        assert [c for _, c in found] == sorted(c for _, c in found)
    assert all(by_shard[a][-1][1] <= by_shard[b][0][1] for a, b in itertools.pairwise(sorted(by_shard)))
    if law == "rows":
        counts = [len(f) for f in by_shard.values()]
        assert len(counts) == 7 and max(counts) - min(counts) <= 1
    else:
        sizes = [sum(r["size"] for r in out if r.shard == s) for s in by_shard if not any(r.shard == s and r["size"] > 80_000 for r in out)]
        mean = sum(r["size"] for r in out) / 7
        assert all(s <= mean + 200 for s in sizes)


def plain_range(values, value, steps=1 << hs.BITS):
    """In which of ``steps`` ranges of about equally many values one falls: the bounds are the values within which a step is passed."""
    known = sorted(v for v in values if v is not None)
    bounds = []
    for v in sorted(set(known)):
        upto, count = sum(x <= v for x in known), known.count(v)
        if upto < len(known) and upto * steps // len(known) > (upto - count) * steps // len(known):
            bounds.append(v)
    return 0 if value is None else sum(value > b for b in bounds)


def plain_curve(cell, bits=hs.BITS):
    """Hilbert index of a cell, by following the curve's definition from its first cell: Skilling's transform on plain integers."""
    x, n = list(cell), len(cell)
    q = 1 << (bits - 1)
    while q > 1:
        for i in range(n):
            if x[i] & q:
                x[0] ^= q - 1
            else:
                t = (x[0] ^ x[i]) & (q - 1)
                x[0], x[i] = x[0] ^ t, x[i] ^ t
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[n - 1] & q:
            t ^= q - 1
        q >>= 1
    x = [v ^ t for v in x]
    return int("".join(str(v >> b & 1) for b in reversed(range(bits)) for v in x), 2)


def test_the_order_is_that_of_a_plain_ranking(spark):
    """Strings with a long common head, a heavy value, nulls: cells, curve and runs worked out in plain Python."""
    rows = [(i, "t", f"https://crawl-2021/host-{i * i % 90:03d}", f"l{i % 3}" if i % 5 else None, i * 7 % 400) for i in range(700)]
    rows += [(1000 + i, "t", "https://crawl-2021/host-045", "l1", i) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long").repartition(3)
    out = hs.shards(docs, 10, "rows", keep=["doc_id", "source"], part_rows=40).collect()
    curve_of = {r["__row"].doc_id: r.curve for r in out}
    # the two string dimensions decide the curve exactly; the bounds of the numbers are approximate
    by_text = {}
    for i, _, source, lang, _ in rows:
        cell = (plain_range([r[2] for r in rows], source), plain_range([r[3] for r in rows], lang))
        by_text.setdefault(cell, set()).add(i)
    assert len({c[0] for c in by_text}) > 10  # the common head does not hide the sources
    numbers = {n: k for k, n in enumerate(range(1 << hs.BITS))}
    for cell, ids in by_text.items():
        possible = {plain_curve((*cell, n)) for n in numbers}
        assert {curve_of[i] for i in ids} <= possible
    placed = sorted(out, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in placed] == sorted(curve_of.values())
    assert [sum(r.shard == s for r in out) for s in range(10)] == [100] * 10
    # runs can be skipped by source: each holds few of the ninety
    assert sum(len({r["__row"].source for r in out if r.shard == s}) for s in range(10)) < 10 * 90 / 3


def test_empty_table_and_files(spark, tmp_path):
    rows, docs = table(spark)
    assert hs.shards(docs.limit(0), 5).collect() == []
    placed = hs.shards(docs.drop("shard"), 5)
    hs.write_shards(placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(rows)
    assert {tuple(r) for r in back.groupBy("shard").count().collect()} == {tuple(r) for r in placed.groupBy("shard").count().collect()}
    assert len(list((tmp_path / "out").glob("shard=*/part-*"))) == 5
    assert back.agg(F.countDistinct("shard")).first()[0] == 5
