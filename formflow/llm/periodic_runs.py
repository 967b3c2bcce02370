"""Detection of periodic runs of words by longest common extensions from suffix trees.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical), of at least two periods, that no neighbouring word extends.

1. Two suffix trees are built online (Ukkonen), of the word sequence and of its reversal.
   Their leaves in depth-first order and the depths at which the Euler tour turns between
   two consecutive leaves give the length of the longest common extension of any two
   places, to the right and to the left, as a range minimum: constant time each.
2. The order of the leaves ranks the suffixes, once with the words in ascending and once
   in descending order (the end comes first in both). The next smaller suffix after each
   place ends the longest Lyndon word that starts there.
3. Every run has such a word as its root in one of the two orders, as long as its period.
   Each candidate is extended from its two ends in both directions by one lookup each;
   those that reach two periods in all are runs.

Trees are built only over the parts of a text in which a run of the wanted length can
lie: a run of twelve words or more contains no ``GRAM`` consecutive windows of ``GRAM``
words that occur nowhere else in it. Parts are cut until no cut is left, so a text
without repetition needs no tree, and no run is lost or changed (see ``parts``).

Words are compared as themselves (each gets a number in its batch); a batch of texts is
handled at a time, a long text alone.

Defined results: null counts as empty text, which has no words and no runs; texts of any
length are handled whole; repeated rows one by one; of equally long runs the longest is
the one that starts first, then that of the smallest period; an empty table gives an
empty result; other columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, slices, text_of
from formflow.llm.words import in_batches

#: Shortest run.
LEAST = 12
#: Words of the windows by which parts without runs are left out; 2 * GRAM - 2 < LEAST.
GRAM = 6


class SuffixTree:
    """Of a sequence of numbers from 1 on; 0 is the end mark.

    ``rank_up`` and ``rank_down``: each suffix's place among all, words ascending or
    descending. ``extension``: length of the longest common prefix of pairs of suffixes.
    """

    def __init__(self, text: list[int]):
        self.n = len(text)
        text = [*text, 0]
        kinds = max(text) + 1
        child, begin, end = self._built(text, kinds)
        # children of each node, ascending by their first word
        keys = np.sort(np.fromiter(child, np.int64, len(child)))
        parents = keys // kinds
        heads = np.searchsorted(parents, np.arange(len(begin) + 1)).tolist()
        children = [child[k] for k in keys.tolist()]
        ends_here = (keys % kinds == 0).tolist()
        self.leaves, turns = self._toured(children, heads, begin, end, ends_here, descending=False)
        down, _ = self._toured(children, heads, begin, end, ends_here, descending=True)
        self.rank_up = np.empty(self.n + 1, np.int64)
        self.rank_up[self.leaves] = np.arange(self.n + 1)
        self.rank_down = np.empty(self.n + 1, np.int64)
        self.rank_down[down] = np.arange(self.n + 1)
        # minima over ranges of 2 ** k turns
        self.minima = [turns]
        while 2 << len(self.minima) - 1 <= len(turns):
            last, half = self.minima[-1], 1 << len(self.minima) - 1
            self.minima.append(np.minimum(last[:-half], last[half:]))

    @staticmethod
    def _built(text: list[int], kinds: int) -> tuple[dict[int, int], list[int], list[int]]:
        """Edges by node * kinds + first word, and where each node's incoming edge begins and ends (exclusive)."""
        size = len(text)
        begin, end, link = [0], [0], [0]
        child: dict[int, int] = {}
        node, edge, length, waiting = 0, 0, 0, 0
        for i, word in enumerate(text):
            waiting += 1
            linked = 0  # the inner node that still lacks its suffix link
            while waiting:
                if not length:
                    edge = i
                at = node * kinds + text[edge]
                below = child.get(at)
                if below is None:
                    child[at] = len(begin)
                    begin.append(i)
                    end.append(size)
                    link.append(0)
                    if linked:
                        link[linked] = node
                    linked = 0
                else:
                    long = min(end[below], i + 1) - begin[below]
                    if length >= long:
                        edge += long
                        length -= long
                        node = below
                        continue
                    if text[begin[below] + length] == word:
                        length += 1
                        if linked:
                            link[linked] = node
                        break
                    split = len(begin)
                    child[at] = split
                    begin.append(begin[below])
                    end.append(begin[below] + length)
                    link.append(0)
                    begin[below] += length
                    child[split * kinds + text[begin[below]]] = below
                    child[split * kinds + word] = split + 1
                    begin.append(i)
                    end.append(size)
                    link.append(0)
                    if linked:
                        link[linked] = split
                    linked = split
                waiting -= 1
                if not node:
                    if length:
                        length -= 1
                        edge = i - waiting + 1
                else:
                    node = link[node]
        return child, begin, end

    @staticmethod
    def _toured(children, heads, begin, end, ends_here, descending) -> tuple[np.ndarray, np.ndarray]:
        """Leaves (as suffixes) in the order of an Euler tour, and the least depth between each two of them."""
        size = end[1]  # node 1 is the first leaf
        leaves, turns = [], []
        lowest = 0
        stack = [(0, 0)]
        while stack:
            node, depth = stack.pop()
            if node < 0:  # the tour is back at an inner node
                lowest = min(lowest, depth)
                continue
            first, last = heads[node], heads[node + 1]
            if first == last:
                leaves.append(size - depth)
                turns.append(lowest)
                lowest = depth
                continue
            order = range(first, last)
            if descending:  # the end mark still comes first
                order = [first, *range(last - 1, first, -1)] if ends_here[first] else range(last - 1, first - 1, -1)
            back = (-1, depth)
            for k in reversed(order):
                below = children[k]
                stack.append(back)
                stack.append((below, depth + end[below] - begin[below]))
        return np.array(leaves), np.array(turns[1:], np.int64)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Of each pair of different suffixes, how many words they have in common from their start."""
        x, y = self.rank_up[a], self.rank_up[b]
        low, high = np.minimum(x, y), np.maximum(x, y)
        power = np.frexp(high - low)[1] - 1
        out = np.zeros(len(low), np.int64)
        for k in np.unique(power):
            some = power == k
            row = self.minima[k]
            out[some] = np.minimum(row[low[some]], row[high[some] - (1 << k)])
        return out


def _lyndon_ends(rank: list[int], n: int) -> np.ndarray:
    """Where the longest Lyndon word from each place ends (exclusive): the next smaller suffix."""
    after = [n] * n
    for i in range(n - 2, -1, -1):
        j, mine = i + 1, rank[i]
        while j < n and rank[j] > mine:
            j = after[j]
        after[i] = j
    return np.array(after, np.int64)


def runs_of(text: list[int], least: int = LEAST) -> np.ndarray:
    """All runs of a sequence of numbers from 1 on, of ``least`` words or more: rows of start, length, period."""
    n = len(text)
    if n < max(2, least):
        return np.zeros((0, 3), np.int64)
    forward, backward = SuffixTree(text), SuffixTree(text[::-1])
    found = []
    for rank in (forward.rank_up, forward.rank_down):
        start = np.arange(n)
        end = _lyndon_ends(rank.tolist(), n)
        period = end - start
        right = forward.extension(start, end)
        # words before start and before end, as suffixes of the reversal; before the first word there is none
        left = backward.extension(n - start, n - end)
        run = np.stack([start - left, left + period + right, period], axis=1)
        found.append(run[(left + right >= period) & (run[:, 1] >= least)])
    return np.unique(np.concatenate(found), axis=0)


def parts(ids: np.ndarray, owner: np.ndarray, gram: int = GRAM) -> list[tuple[int, int]]:
    """Ranges of ``ids`` that hold all runs of 2 * gram words or more, each within one owner.

    In a run every window of ``gram`` words has a copy one period on or back, but for gram - 1
    consecutive windows at most (those in the middle of a run of just two periods). So ``gram``
    consecutive windows without a copy in their range are in no run together, and a run lies in the
    words of the windows before the last of them or after the first. Ranges are cut so until
    nothing changes. Two ranges share 2 * gram - 3 words at most, less than a run: what is a run
    inside a range is one of the whole text.
    """
    edges = np.flatnonzero(np.append(True, owner[1:] != owner[:-1])) if len(owner) else np.zeros(0, np.int64)
    start, end = edges, np.append(edges[1:], len(owner))
    done: list[tuple[int, int]] = []
    code = np.zeros(max(0, len(ids) - gram + 1), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(gram):
            code = code * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(code)].astype(np.uint64)
            code ^= code >> np.uint64(29)
    while True:
        keep = end - start >= 2 * gram
        start, end = start[keep], end[keep]
        if not len(start):
            return done
        count = end - start - gram + 1
        first = np.cumsum(count) - count
        part = np.repeat(np.arange(len(start)), count)
        place = np.arange(count.sum()) - np.repeat(first, count) + np.repeat(start, count)
        order = np.lexsort((code[place], part))
        same = (part[order[1:]] == part[order[:-1]]) & (code[place[order[1:]]] == code[place[order[:-1]]])
        copied = np.zeros(len(place), bool)
        copied[order[1:][same]] = True
        copied[order[:-1][same]] = True
        # stretches of windows that have copies, or lack them, within one range
        turn = np.flatnonzero(np.append(True, (copied[1:] != copied[:-1]) | (part[1:] != part[:-1])))
        long = np.diff(np.append(turn, len(place)))
        cut = ~copied[turn] & (long >= gram)
        whole = np.bincount(part[turn[cut]], minlength=len(start)) == 0
        done += zip(start[whole].tolist(), end[whole].tolist(), strict=True)
        # between two cuts: the windows of a piece, and gram - 1 more of each cut beside it
        piece_start, piece_end = [], []
        at, size, of = turn[cut], long[cut], part[turn[cut]]
        for p in np.flatnonzero(~whole).tolist():
            mine = slice(*np.searchsorted(of, [p, p + 1]))
            low = start[p]
            for a, z in zip((place[at[mine]]).tolist(), size[mine].tolist(), strict=True):
                piece_start.append(low)
                piece_end.append(min(a + 2 * gram - 2, end[p]))
                low = max(start[p], a + z - gram + 1)
            piece_start.append(low)
            piece_end.append(end[p])
        start, end = np.array(piece_start, np.int64), np.array(piece_end, np.int64)


def find_runs(texts: list[bytes], least: int = LEAST) -> tuple[list[list[bytes]], list[np.ndarray]]:
    """The words of each text, and its runs sorted by start, then period."""
    words = [t.split() for t in texts]
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers) + 1) for text in words for w in text), np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    first = np.cumsum(sizes) - sizes
    found: list[list[np.ndarray]] = [[] for _ in words]
    for start, end in parts(ids, owner, min(GRAM, least // 2)):
        _, small = np.unique(ids[start:end], return_inverse=True)
        runs = runs_of((small + 1).tolist(), least)
        if len(runs):
            of = int(owner[start])
            found[of].append(runs + [start - int(first[of]), 0, 0])
    none = np.zeros((0, 3), np.int64)
    return words, [np.unique(np.concatenate(f), axis=0)[:, [0, 2, 1]] if f else none for f in found]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words that no run (start, period, length) contains after its first period, joined by one space."""
    if not len(runs):
        return b" ".join(words)
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 1], 1)
    np.add.at(change, runs[:, 0] + runs[:, 2], -1)
    kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
    return b" ".join([words[i] for i in kept.tolist()])


_FOUND = "n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame, least: int = LEAST, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with n_words, the ``runs`` of at least ``least``
    words in order of start and period, and the text ``collapsed``: of each run only its first period is left."""
    if least < 2:
        raise ValueError("a run has two words at least")
    rows = packed(docs, keep, text=text_of("text").cast("binary"))
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            at = 0
            for some in in_batches(((t,) for t in batch.column("text").to_pylist()), 0):
                words, runs = find_runs([t for (t,) in some], least)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(ROW).slice(at, len(some)),
                        pa.array([len(w) for w in words], pa.int64()),
                        pa.array([[{"start": s, "length": n, "period": p} for s, p, n in r.tolist()] for r in runs], kind),
                        pa.array([collapsed(w, r).decode() for w, r in zip(words, runs, strict=True)], pa.string()),
                    ],
                    names=[ROW, "n_words", "runs", "collapsed"],
                )
                at += len(some)

    return rows.mapInArrow(run, f"{ROW} {rows.schema[ROW].dataType.simpleString()}, {_FOUND}")


def longest(runs: str = "runs") -> F.Column:
    """Of an array of runs the longest; ties: the smallest start, then period; null if there is none."""
    best = f"array_max(transform({runs}, r -> struct(r.length as length, -r.start as back, -r.period as less)))"
    return F.expr(f"transform(array({best}), b -> if(b is null, null, named_struct('start', -b.back, 'length', b.length, 'period', -b.less)))[0]")
