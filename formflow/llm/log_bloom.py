"""Language-model scoring from a log-frequency Bloom filter.

Training: every task turns its documents into 64-bit hashes of words and of word pairs
and counts them in batches; equal hashes meet in buckets of the hash range, so a word
or pair of any frequency is one number per batch by then. Counts are quantised to
q = 1 + floor(log(c) / log(BASE)), and the filter holds (gram, 1) ... (gram, q). A
lookup probes level after level until one is missing; the last one found gives the
count, too high with a small probability and never too low.

Scoring: a token w after v has probability

    BACK * (c(v, w) / c(v)) + (1 - BACK) * (c(w) + 1) / (N + V + 1)

with counts from the filter, c(v, w) bounded by the other two; the word term alone, with its
whole weight, where v does not occur. v is the word before or the begin mark; w a word or the end mark. Every word and every pair of the training texts
enters, also those that occur once.

The filter is cut by the hash of v into segments of at most SEGMENT_BYTES. One segment
at a time is sent to the workers; each gives every text the sum over the tokens whose v
belongs to it, and the sums are added, so a filter of any size works and no worker
holds more than one.

The base score needs exact counts. The HEAD most frequent words, a fixed number, are
sent to the workers; the other words of each text are joined to their counts.

Defined results: null counts as empty text, which is one end token; a null doc_id is
never held out; repeated rows are trained on and scored one by one; an empty table
gives an empty result; other columns are left alone. A-Z are lower-cased.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, batch_rows, packed, slices, staged, text_of
from formflow.llm.words import SOLID, in_batches, mix, split_words

BASE = 1.6
BACK = 0.25
HEAD = 300_000
SEGMENT_BYTES = 128 << 20
#: Filter bits for each entry, and probes for each: 1 % of the probes of absent entries hit.
BITS, PROBES = 10, 7
#: Texts sent to Python at once.
TEXTS = 512
#: Distinct grams in one bucket of the count, about.
BUCKET = 500_000

END = np.uint64(0x5EED0E4D)
BEGIN = np.uint64(0x5EED0BE6)
_PAIR = np.uint64(0xD6E8FEB86659FD93)
_LEVEL = np.uint64(0xA0761D6478BD642F)


_CLASS = np.uint64(0xFFFF)


def pair_hash(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The upper 48 bits stand for the pair, the lower 16 for the class of v, which tells the segment."""
    return (mix(v * _PAIR + w) & ~_CLASS) | (mix(v) & _CLASS)


def spread(grams: np.ndarray, parts: int) -> np.ndarray:
    """Which of ``parts`` equal ranges of hashes each gram is in."""
    return ((grams >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)


def segment_of(v: np.ndarray, segments: int) -> np.ndarray:
    return ((mix(v) & _CLASS) * np.uint64(segments) >> np.uint64(16)).astype(np.int64)


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts: each token, the one before it, and how many tokens each text has (its words and one end)."""
    words = split_words(texts, SOLID)
    counts = words.counts() + 1
    bounds = np.concatenate([[0], np.cumsum(counts)])
    token = np.full(bounds[-1], END, np.uint64)
    token[np.arange(len(words.hashes)) + words.owners()] = words.hashes
    before = np.empty_like(token)
    before[1:] = token[:-1]
    before[bounds[:-1]] = BEGIN
    return token, before, counts


def levels(counts: np.ndarray) -> np.ndarray:
    """Quantised counts: 1 for 1, then one more for each factor BASE."""
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def expected(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that have this level; 0 for level 0."""
    low = np.ceil(BASE ** np.maximum(level - 1, 0) - 1e-9)
    high = np.maximum(low, np.ceil(BASE ** np.maximum(level, 0) - 1e-9) - 1)
    return np.where(level > 0, (low + high) / 2, 0.0)


def _probes(grams: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = mix(grams + level.astype(np.uint64) * _LEVEL)
    return h, mix(h) | np.uint64(1)


def part_of_filter(grams: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    """A Bloom filter over (gram, 1) ... (gram, level of its count): number of bits, and the bits."""
    top = levels(counts)
    bits = 64 + BITS * int(top.sum())
    held = np.zeros(bits, bool)
    for level in range(1, int(top.max(initial=0)) + 1):
        some = grams[top >= level]
        h, step = _probes(some, np.full(len(some), level))
        for _ in range(PROBES):
            held[(h % np.uint64(bits)).astype(np.int64)] = True
            h = h + step
    return bits, np.packbits(held, bitorder="little").tobytes()


class Filter:
    """Parts of a filter side by side: part i is for the grams of the i-th range of hashes."""

    def __init__(self, parts: dict[int, tuple[int, bytes]], count: int):
        empty = (64, bytes(8))
        held = [parts.get(i, empty) for i in range(count)]
        self.bits = np.array([b for b, _ in held], np.uint64)
        sizes = [len(d) for _, d in held]
        self.first = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        self.data = np.frombuffer(b"".join(d for _, d in held), np.uint8)

    def level(self, grams: np.ndarray) -> np.ndarray:
        """Levels of ``grams``: probed upwards until one is missing."""
        part = spread(grams, len(self.bits))
        bits, first = self.bits[part], self.first[part]
        out, open_, level = np.zeros(len(grams), np.int64), np.arange(len(grams)), 1
        while len(open_):
            h, step = _probes(grams[open_], np.full(len(open_), level))
            for _ in range(PROBES):
                at = h % bits[open_]
                byte = self.data[first[open_] + (at >> np.uint64(3)).astype(np.int64)]
                hit = (byte >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0
                open_, h, step = open_[hit], h[hit] + step[hit], step[hit]
            out[open_] = level
            level += 1
        return out


def _texts(batches: Iterator[pa.RecordBatch], *others: str) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(*(batch.column(c).to_pylist() for c in ("text", *others)), strict=True)


def _folded(ascending: np.ndarray) -> bytes:
    """Differences, byte by byte of all: the upper bytes are mostly 0 and compress."""
    steps = np.diff(ascending, prepend=np.uint64(0)).astype("<u8")
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unfolded(raw: bytes) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64)


def _packed_counts(grams: np.ndarray, counts: np.ndarray, buckets: int, kind: int) -> Iterator[pa.RecordBatch]:
    """Sorted distinct grams cut by bucket (the top of the hash range), as one row each."""
    cut = np.searchsorted(spread(grams, buckets), np.arange(buckets + 1))
    some = np.flatnonzero(np.diff(cut))
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(len(some), kind), pa.int32()),
            pa.array(some, pa.int64()),
            pa.array([_folded(grams[cut[i] : cut[i + 1]]) for i in some], pa.binary()),
            pa.array([counts[cut[i] : cut[i + 1]].astype("<u4").tobytes() for i in some], pa.binary()),
        ],
        names=["kind", "bucket", "grams", "counts"],
    )


WORD, PAIR = 0, 1
#: Texts are counted together up to so many bytes, so that equal grams of a task meet before they are sent.
COUNT_BYTES = 8 << 20


def _counter(word_buckets: int, pair_buckets: int):
    def run(batches):
        for rows in in_batches(_texts(batches), 0, COUNT_BYTES):
            token, before = [], []
            for part in in_batches(rows, 0):
                t, b, _ = tokens([r[0] for r in part])
                token.append(t)
                before.append(b)
            t, b = np.concatenate(token), np.concatenate(before)
            # the begin mark is a context of each text: counted as a gram, not as a token
            yield from _packed_counts(*np.unique(np.append(t, b[b == BEGIN]), return_counts=True), word_buckets, WORD)
            yield from _packed_counts(*np.unique(pair_hash(b, t), return_counts=True), pair_buckets, PAIR)

    return run


def _summed(key, part):
    """One bucket: its grams with their counts over all batches."""
    grams = np.concatenate([_unfolded(b) for b in part.column("grams").to_pylist()])
    counts = np.concatenate([np.frombuffer(b, "<u4") for b in part.column("counts").to_pylist()]).astype(np.int64)
    order = np.argsort(grams, kind="stable")
    grams, counts = grams[order], counts[order]
    at = np.flatnonzero(np.append(True, grams[1:] != grams[:-1]))
    grams, counts = grams[at], np.add.reduceat(counts, at)
    return pa.table({"kind": pa.array(np.full(len(grams), key[0].as_py()), pa.int32()), "gram": grams.view(np.int64), "n": counts})


def count_grams(docs: DataFrame) -> DataFrame:
    """Counts of words (with the marks) and of word pairs over all ``docs``: kind, gram, n; staged."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pair_buckets = max(8, math.ceil(size / 6 / BUCKET))
    word_buckets = max(4, pair_buckets // 8)
    packs = docs.select(text_of("text").cast("binary").alias("text")).mapInArrow(
        _counter(word_buckets, pair_buckets), "kind int, bucket long, grams binary, counts binary"
    )
    with batch_rows(docs.sparkSession, TEXTS):
        return staged(packs.groupBy("kind", "bucket").applyInArrow(_summed, "kind int, gram long, n long"), "grams")


def _in_filter(grams: DataFrame, parts: int) -> Filter:
    """The filter over ``grams(gram, n)``, each part built by one task."""
    # the range of a gram's hash, as spread() has it, on the signed value
    high = F.shiftrightunsigned("gram", 32)
    keyed = grams.select(F.shiftright(high * parts, 32).alias("part"), "gram", "n")

    def build(key, rows):
        held = rows.column("gram").to_numpy().view(np.uint64)
        bits, data = part_of_filter(held, rows.column("n").to_numpy())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([bits], pa.int64()), "data": pa.array([data], pa.binary())})

    built = keyed.groupBy("part").applyInArrow(build, "part long, bits long, data binary").toLocalIterator(prefetchPartitions=True)
    return Filter({r.part: (r.bits, bytes(r.data)) for r in built}, parts)


def _pieces(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[tuple[list[bytes], list[pa.Array]]]:
    """Texts in lists of a bounded size, with the columns ``key`` of their rows."""
    for batch in slices(batches, TEXTS):
        at = 0
        for some in in_batches(((t,) for t in batch.column("text").to_pylist()), 0):
            yield [t for (t,) in some], [batch.column(c).slice(at, len(some)) for c in key]
            at += len(some)


def _scorer(model, key: list[str], first: bool):
    """Sums over the tokens whose context is in the model's segment; the first one also does the base score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        total, distinct = m["tokens"], m["words"]
        for rows, kept in _pieces(batches, key):
            token, before, counts = tokens(rows)
            owner = np.repeat(np.arange(len(rows)), counts)
            mine = segment_of(before, m["segments"]) == m["segment"]
            words, at = np.unique(np.concatenate([token[mine], before[mine]]), return_inverse=True)
            c_word = expected(m["word_filter"].level(words))
            c_w, c_v = c_word[at[: mine.sum()]], c_word[at[mine.sum() :]]
            pairs, at = np.unique(pair_hash(before[mine], token[mine]), return_inverse=True)
            c_pair = np.minimum(expected(m["pair_filter"].level(pairs))[at], np.minimum(c_v, c_w))
            follows = np.divide(c_pair, c_v, out=np.zeros(len(c_v)), where=c_v > 0)
            p = BACK * follows + np.where(c_v > 0, 1 - BACK, 1.0) * (c_w + 1) / (total + distinct + 1)
            columns = [*kept, pa.array(np.bincount(owner[mine], np.log10(p), len(rows)).astype(np.float64))]
            if first:
                heads, n = m["head"]
                at = np.minimum(np.searchsorted(heads, token), len(heads) - 1) if len(heads) else np.zeros(len(token), np.int64)
                known = heads[at] == token if len(heads) else np.zeros(len(token), bool)
                part = np.where(known, np.log10(n[at] + 1.0) if len(heads) else 0.0, 0.0)
                order = np.lexsort((token[~known], owner[~known]))
                t, o = token[~known][order], owner[~known][order]
                new = np.flatnonzero(np.append(len(t) > 0, (t[1:] != t[:-1]) | (o[1:] != o[:-1]))[: len(t)])
                times, cut = np.diff(np.append(new, len(t))), np.searchsorted(o[new], np.arange(len(rows) + 1))
                t = t[new].view(np.int64)
                columns += [
                    pa.array(counts, pa.int64()),
                    pa.array(np.bincount(owner, known, len(rows)).astype(np.int64)),
                    pa.array(np.bincount(owner, part, len(rows)).astype(np.float64)),
                    pa.array([t[a:b] for a, b in zip(cut, cut[1:], strict=False)], pa.list_(pa.int64())),
                    pa.array([times[a:b] for a, b in zip(cut, cut[1:], strict=False)], pa.list_(pa.int64())),
                ]
            yield pa.RecordBatch.from_arrays(columns, names=[*key, "score", *_FIRST][: len(columns)])

    return run


_FIRST = ("n_tokens", "n_known", "base", "rare", "times")
_FIRST_TYPES = "n_tokens long, n_known long, base double, rare array<long>, times array<long>"


def score(docs: DataFrame, training: DataFrame, keep: list[str] | None = None, head: int = HEAD, segment_bytes: int = SEGMENT_BYTES) -> DataFrame:
    """Rows of ``docs`` packed, with n_tokens, n_known, train_tokens, base_score and score, by a model of ``training``."""
    spark = docs.sparkSession
    grams = count_grams(training)
    words = grams.where(F.col("kind") == WORD).select("gram", "n")
    begin = int(np.array([BEGIN]).view(np.int64)[0])
    real = words.where(F.col("gram") != begin)
    level = 1 + F.floor(F.log("n") / math.log(BASE) + 1e-9)
    total, distinct = (int(x or 0) for x in real.agg(F.sum("n"), F.count("*")).first())
    sizes = {r["kind"]: int(r["entries"]) for r in grams.groupBy("kind").agg(F.sum(level).alias("entries")).collect()}
    segments = max(1, math.ceil(sizes.get(PAIR, 0) * BITS / 8 / segment_bytes))
    top = real.orderBy(F.col("n").desc(), "gram").limit(head).toArrow()
    order = np.argsort(top.column("gram").to_numpy().view(np.uint64))
    model = {
        "tokens": total,
        "words": distinct,
        "segments": segments,
        "head": (top.column("gram").to_numpy().view(np.uint64)[order], top.column("n").to_numpy()[order]),
        "word_filter": _in_filter(words, max(1, math.ceil(sizes.get(WORD, 0) / BUCKET))),
    }
    rows = packed(docs, keep, text=text_of("text").cast("binary"), row_no=F.monotonically_increasing_id())
    if segments > 1:  # the passes must agree on the numbers; a single one writes them with its result
        rows = staged(rows, "texts")
    passes = []
    for k in range(segments):
        pairs = grams.where(F.col("kind") == PAIR).where(F.floor(F.col("gram").bitwiseAND(0xFFFF) * segments / 65536) == k)
        held = model | {"segment": k, "pair_filter": _in_filter(pairs.select("gram", "n"), max(1, math.ceil(sizes.get(PAIR, 0) / segments / BUCKET)))}
        key = ["row_no"] if k else [ROW, "row_no"]
        types = "row_no long, score double" if k else f"{ROW} {rows.schema[ROW].dataType.simpleString()}, row_no long, score double, {_FIRST_TYPES}"
        sent = spark.sparkContext.broadcast(held)
        with batch_rows(spark, TEXTS):
            passes.append(staged(rows.select("text", *key).mapInArrow(_scorer(sent, key, not k), types), "scores"))
        sent.unpersist()
    first = passes[0]
    rare = first.select("row_no", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row_no", F.col("x.rare").alias("gram"), F.col("x.times").alias("k"))
    tail = rare.join(real, "gram").groupBy("row_no").agg(
        F.sum("k").alias("tail_known"), F.sum(F.col("k") * F.log10(F.col("n") + 1.0)).alias("tail_base")
    )
    whole = first.drop("rare", "times")
    for k, more in enumerate(passes[1:]):
        whole = whole.join(more.withColumnRenamed("score", f"score_{k}"), "row_no").withColumn("score", F.col("score") + F.col(f"score_{k}")).drop(f"score_{k}")
    whole = whole.join(tail, "row_no", "left")
    n_tokens = F.col("n_tokens")
    return whole.select(
        ROW,
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("tail_base", F.lit(0.0)) - n_tokens * math.log10(total + distinct + 1)).alias("base_score"),
        "score",
    )
