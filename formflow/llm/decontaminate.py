"""Benchmark decontamination by suffix arrays over the training text.

Each task cuts its documents into shards of a bounded number of words and builds a
suffix array over each. Every suffix of every benchmark item is looked up by binary
search: its neighbours in the array give its longest verbatim match and where that
is, and the range of suffixes that start with its window gives all places of the
window. A document word inside such a place is hit; a document of which a twentieth
or more is hit is contaminated.

The array leaves out suffixes that cannot start a window: words that occur in no item
cut the text into runs, and a run shorter than the shortest window has none. Matches
shorter than that are not reported; nothing else is left out.

The benchmark travels to the workers in blocks of at most ``BLOCK_BYTES``. One block is
one pass without a shuffle. Several are one pass each over the same stored rows, with one
block in a worker at a time; what they find is gathered by row.

Defined results: a null text has no words; an item without words has no window; a null
item_id is found but not listed; repeated items count once; repeated rows are judged
one by one; an empty table or benchmark gives no hits; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, slices, staged, text_of
from formflow.llm.words import ALNUM, in_batches, split_words

WINDOW = 13
#: A document is contaminated from one hit word in so many.
SHARE = 20
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 4 << 20


def suffix_array(ids: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """``starts`` in the order of the suffixes of ``ids`` that begin there, compared by
    ``depth`` words at least (prefix doubling; a word below 0 ends the suffix)."""
    n = len(ids)
    rank = np.where(ids < 0, 0, ids + 1).astype(np.int64)
    width = 1
    while width < depth:
        after = np.zeros(n, np.int64)
        if width < n:
            after[: n - width] = rank[width:]
        after[rank == 0] = 0
        pair = rank * (rank.max(initial=0) + 1) + after
        values, rank = np.unique(pair, return_inverse=True)
        rank = rank + (len(values) > 0 and values[0] != 0)
        width *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


class Block:
    """Windows and suffixes of some benchmark items, ready to be looked up."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        words = split_words([t for _, t in items], ALNUM)
        self.vocabulary, ids = np.unique(words.hashes, return_inverse=True)
        self.text = np.append(ids, -1)  # the words of all items, one after the other
        bounds = words.bounds
        self.words = [words.word(i) for i in range(len(ids))]
        first, last = np.repeat(bounds[:-1], np.diff(bounds)), np.repeat(bounds[1:], np.diff(bounds))
        self.suffix = np.arange(len(ids))
        self.left = last - self.suffix  # words from here to the item's end
        size = np.minimum(last - first, WINDOW)
        begins = self.left >= size
        self.window, self.size = self.suffix[begins], size[begins]
        self.begin = (self.suffix - first)[begins]
        self.item = np.repeat(np.arange(len(items)), np.diff(bounds))[begins]
        self.names = [name for name, _ in items]
        self.shortest = int(self.size.min()) if len(self.size) else 0
        self.longest = int(self.left.max()) if len(self.left) else 0

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """Ids of document words in the block's vocabulary, else -1."""
        at = np.minimum(np.searchsorted(self.vocabulary, hashes), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == hashes, at, -1)


def _compare(text, places, item_text, suffix, limit):
    """Words in which ``text`` from each place agrees with the item from each suffix, ``limit`` at most, and
    whether the text is less there."""
    agree = np.zeros(len(places), np.int64)
    less = np.zeros(len(places), bool)
    open_ = np.arange(len(places))
    while len(open_):
        done = agree[open_] >= limit[open_]
        open_ = open_[~done]
        at = agree[open_]
        a = text[np.minimum(places[open_] + at, len(text) - 1)]
        b = item_text[suffix[open_] + at]
        less[open_] = a < b
        same = a == b
        open_ = open_[same]
        agree[open_] += 1
    return agree, less


def _bound(text, array, block, suffix, limit, upper):
    """For each item suffix the number of array entries below it (or, ``upper``, not above it) by ``limit`` words."""
    lo, hi = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(array))
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        agree, less = _compare(text, array[mid], block.text, suffix[open_], limit[open_])
        below = (agree < limit[open_]) & less
        if upper:
            below |= agree >= limit[open_]
        lo[open_[below]] = mid[below] + 1
        hi[open_[~below]] = mid[~below]


def search(block: Block, texts: list[bytes]) -> dict:
    """All window places of ``block`` in a shard of texts, and each item suffix's longest match.

    ``start``, ``size``: word ranges hit (positions in the shard), ``item``: whose window, ``from``: where in the item;
    ``best``, ``where``: per item suffix its longest match of a window's length or more, and a place of it.
    """
    words = split_words(texts, ALNUM)
    none = np.zeros(0, np.int64)
    out = {"words": words, "start": none, "size": none, "item": none, "from": none, "best": np.zeros(len(block.suffix), np.int64), "where": np.full(len(block.suffix), -1)}
    if not len(block.size) or not len(words.hashes):
        return out
    ids = block.known(words.hashes)
    # a -1 after each text, so that no match crosses into the next one
    n, count = len(ids), words.counts()
    at = np.arange(n) + words.owners()
    text = np.full(n + len(texts) + 1, -1, np.int64)
    text[at] = ids
    ends = np.flatnonzero(text < 0)
    run = ends[np.searchsorted(ends, np.arange(len(text)))] - np.arange(len(text))  # known words from here on
    inside = np.flatnonzero(run > 0)
    begin = np.zeros(len(text), np.int64)
    begin[1:] = np.where(text[:-1] < 0, np.arange(1, len(text)), 0)
    begin = np.maximum.accumulate(begin)
    long = inside[(run + np.arange(len(text)) - begin)[inside] >= block.shortest]
    starts = long[run[long] >= block.shortest]
    if not len(starts):
        return out
    kept = np.full(len(text), False)
    kept[long] = True
    pick = np.flatnonzero(kept | (text < 0) & np.append(False, kept[:-1]))
    small = text[pick]  # runs that can hold a window, with their ends
    back = np.full(len(text), -1)
    back[pick] = np.arange(len(pick))
    array = suffix_array(small, back[starts], max(block.longest, WINDOW))
    small = np.append(small, -1)
    word_of = np.full(len(text), -1)
    word_of[at] = np.arange(n)
    # longest matches: the neighbours of the place where the suffix would stand
    spot = _bound(small, array, block, block.suffix, block.left, upper=False)
    for near in (spot - 1, spot):
        there = (near >= 0) & (near < len(array))
        place = array[np.clip(near, 0, len(array) - 1)]
        agree, _ = _compare(small, place, block.text, block.suffix, np.where(there, block.left, 0))
        better = agree > out["best"]
        out["best"][better] = agree[better]
        out["where"][better] = word_of[pick[place[better]]]
    short = out["best"] < block.shortest
    out["best"][short], out["where"][short] = 0, -1
    # windows: every suffix of the text that begins with it
    possible = np.flatnonzero(out["best"][block.window] >= block.size)
    low = _bound(small, array, block, block.window[possible], block.size[possible], upper=False)
    high = _bound(small, array, block, block.window[possible], block.size[possible], upper=True)
    times = high - low
    index = np.repeat(low - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(times) else none
    start = word_of[pick[array[index]]]
    which = np.repeat(possible, times)
    # equal hashes are taken for equal words above; here the words themselves are compared
    true = np.array(
        [
            all(words.word(s + k) == block.words[w + k] for k in range(z))
            for s, w, z in zip(start.tolist(), block.window[which].tolist(), block.size[which].tolist(), strict=True)
        ],
        bool,
    )
    out["start"], out["size"], out["item"] = start[true], block.size[which][true], block.item[which][true]
    out["from"] = block.begin[which][true]
    return out


def longest_in(found: dict) -> dict[tuple[int, int], tuple[int, int, int]]:
    """For each text (by number) and item of a ``search`` its longest verbatim match: words, first word in the text and
    in the item (ties: smallest places). Windows that follow each other in both are one match."""
    bounds = found["words"].bounds
    owner = np.searchsorted(bounds, found["start"], side="right") - 1
    place, of, at = found["start"], found["item"], found["from"]
    order = np.lexsort((place, place - at, of, owner))
    owner, place, of, at, size = owner[order], place[order], of[order], at[order], found["size"][order]
    follows = (owner[1:] == owner[:-1]) & (of[1:] == of[:-1]) & (place[1:] == place[:-1] + 1) & (at[1:] == at[:-1] + 1)
    first = np.flatnonzero(np.append(True, ~follows)[: len(order)])
    words = np.diff(np.append(first, len(order))) - 1 + size[first]
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    for o, i, n, s, a in zip(*(x.tolist() for x in (owner[first], of[first], words, (place - bounds[owner])[first], at[first])), strict=True):
        if (o, i) not in best or (-n, s, a) < (-best[o, i][0], *best[o, i][1:]):
            best[o, i] = (n, s, a)
    return best


_MATCH = "array<struct<item:string,words:int,doc_word:int,item_word:int>>"
_FOUND = f"n_words long, spans array<int>, items array<string>, longest {_MATCH}"
_MATCH_ARROW = pa.list_(pa.struct([("item", pa.string()), ("words", pa.int32()), ("doc_word", pa.int32()), ("item_word", pa.int32())]))


def _best_of(matches: list[tuple[str, int, int, int]]) -> list[dict]:
    """Of (item, words, doc_word, item_word) the longest of each item, by item."""
    best: dict[str, tuple] = {}
    for item, n, s, a in matches:
        best[item] = min(best.get(item, (0, 0, 0)), (-n, s, a))
    return [{"item": k, "words": -n, "doc_word": s, "item_word": a} for k, (n, s, a) in sorted(best.items())]


def _searcher(block, key: str, all_rows: bool):
    """A pass over rows (key, text): what a block's windows hit in each. Rows without hits are left out, unless ``all_rows``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found_in = block.value
        for batch in slices(batches, 1024):
            texts = batch.column("text").to_pylist()
            counts: list[int] = []
            spans, items, longest = [[] for _ in texts], [[] for _ in texts], [[] for _ in texts]
            at = 0
            for rows in in_batches(((t,) for t in texts), 0, SHARD_BYTES):
                found = search(found_in, [r[0] for r in rows])
                counts.extend(found["words"].counts().tolist())
                bounds = found["words"].bounds
                owner = np.searchsorted(bounds, found["start"], side="right") - 1
                for i in np.unique(owner):
                    start = found["start"][owner == i] - bounds[i]
                    spans[at + i] = merged(list(zip(start.tolist(), (start + found["size"][owner == i]).tolist(), strict=True)))
                named: dict[int, list] = {}
                for (i, item), match in longest_in(found).items():
                    if found_in.names[item] is not None:
                        named.setdefault(i, []).append((found_in.names[item], *match))
                for i, some in named.items():
                    longest[at + i] = _best_of(some)
                    items[at + i] = [m["item"] for m in longest[at + i]]
                at += len(rows)
            out = pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, pa.list_(pa.int32())),
                    pa.array(items, pa.list_(pa.string())),
                    pa.array(longest, _MATCH_ARROW),
                ],
                names=[key, "n_words", "spans", "items", "longest"],
            )
            yield out if all_rows else out.filter(pa.array([bool(x) for x in spans], pa.bool_()))

    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (row_no, n_words, spans, items, longest) of several blocks, gathered by row, as if of one block."""
    for batch in slices(batches, 1024):
        spans = [merged([*zip(*[iter(x)] * 2, strict=True)]) for x in batch.column("spans").to_pylist()]
        longest = [_best_of([tuple(m.values()) for m in x]) for x in batch.column("longest").to_pylist()]
        columns = [
            batch.column("row_no"),
            batch.column("n_words"),
            pa.array(spans, pa.list_(pa.int32())),
            pa.array([[m["item"] for m in x] for x in longest], pa.list_(pa.string())),
            pa.array(longest, _MATCH_ARROW),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["row_no", "n_words", "spans", "items", "longest"])


def merged(spans: list[tuple[int, int]]) -> list[int]:
    """Disjoint ranges, flat: start, end, start, end ..."""
    out: list[int] = []
    for start, end in sorted(spans):
        if out and start <= out[-1]:
            out[-1] = max(out[-1], end)
        else:
            out += [start, end]
    return out


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple[str | None, bytes]]]:
    """The distinct items in blocks of at most ``block_bytes`` (a longer item is alone); the driver holds one at a time."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), text_of("text").alias("text")).distinct()
    held, size, some = [], 0, False
    for row in items.orderBy("item_id", "text").toLocalIterator():
        text = row.text.encode()
        if held and size + len(text) > block_bytes:
            yield held
            held, size, some = [], 0, True
        held.append((row.item_id, text))
        size += len(text)
    if held or not some:  # an empty benchmark is one empty block: words are counted
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with n_words, the word ranges hit (``spans``, flat), the
    ``items`` found, and of each its ``longest`` verbatim match: words, and where it begins in the document and in the item."""
    spark = docs.sparkSession
    rows = packed(docs, keep, text=text_of("text").cast("binary"))
    row = rows.schema[ROW].dataType.simpleString()
    held = blocks(benchmark, block_bytes)
    first, second = next(held), next(held, None)
    if second is None:
        out = rows.mapInArrow(_searcher(spark.sparkContext.broadcast(Block(first)), ROW, True), f"{ROW} {row}, {_FOUND}")
    else:
        rows = staged(rows.withColumn("row_no", F.monotonically_increasing_id()), "texts")
        found = None
        for items in chain([first, second], held):
            sent = spark.sparkContext.broadcast(Block(items))
            run = _searcher(sent, "row_no", found is None)  # the first pass counts the words of all rows
            part = staged(rows.select("row_no", "text").mapInArrow(run, f"row_no long, {_FOUND}"), "matches")
            sent.unpersist()
            found = part if found is None else found.union(part)
        lists = [F.flatten(F.collect_list(c)).alias(c) for c in ("spans", "items", "longest")]  # one entry for each block at most
        whole = found.groupBy("row_no").agg(F.max("n_words").alias("n_words"), *lists).mapInArrow(_united, f"row_no long, {_FOUND}")
        out = rows.select(ROW, "row_no").join(whole, "row_no").drop("row_no")
    n_hit = F.expr(
        "aggregate(spans, named_struct('n', 0L, 'sign', -1L), (s, x) -> named_struct('n', s.n + s.sign * x, 'sign', -s.sign), s -> s.n)"
    )
    out = out.select(ROW, "n_words", n_hit.alias("n_hit"), "spans", "items", "longest")
    return out.withColumn("contaminated", F.expr(f"n_hit > 0 and {SHARE} * n_hit >= n_words"))


def longest_matches(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Of each item found by ``matches`` its longest verbatim match over all documents: item, words, the document
    and where the match begins in both (ties: the least document, then the least places)."""
    each = found.select(F.col(f"{ROW}.`{id_column}`").alias("doc"), F.explode("longest").alias("m"))
    order = F.struct((-F.col("m.words")).alias("less"), "doc", "m.doc_word", "m.item_word")
    best = each.groupBy("m.item").agg(F.min(order).alias("b"))
    return best.select("item", (-F.col("b.less")).alias("words"), F.col("b.doc").alias(id_column), "b.doc_word", "b.item_word")


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns."""
    return matches(docs, benchmark).where("not contaminated").select(f"{ROW}.*")
