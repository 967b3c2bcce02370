"""SimHash near duplicates: fingerprints that differ in two bits or fewer are linked.

1. A text's fingerprint has 64 bits, each the majority among the hashes of its three-word
   shingles. Texts with one fingerprint are one entry from then on.
2. Pigeonhole blocks: the bits are cut into ``BLOCKS`` blocks. Two differences touch at
   most two of them, so a close pair shares two whole blocks at least; every entry is dealt
   under each choice of two blocks and their bits, and close pairs meet under one of these keys.
3. Under a key with few entries every two are compared and the Hamming distance decides. Under
   a key with more than ``FEW`` (families of near copies) the bits outside its blocks are cut
   into blocks in turn, with the same argument, so the key becomes longer. After three cuts
   eight bits are left free and a key cannot have more than 256 entries. So nothing is
   capped, and work grows with the entries: 6, 36 or 216 rows each, for large families only.
4. Under each key a spanning forest of its links goes on, not every pair. A class is a
   component of the links.

Defined results: null counts as empty text; a text of one or two words has one shingle of
all its words; a text without words has fingerprint zero, which is linked like any other;
a null doc_id is in its class but does not name it (a class of null ids only has a null
name); repeated rows share their fingerprint; an empty table gives an empty result; other
columns are left alone. A-Z are lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, slices, staged, text_of
from formflow.llm.components import components
from formflow.llm.words import in_batches

SHINGLE = 3
SEED = 42
DISTANCE = 2
BLOCKS = 4
#: Entries of a key of which every two are compared.
FEW = 256
#: Fingerprints with more than one in so many of all rows (so at most as many) are joined by broadcast.
HOT = 1000
#: Hashes whose bits are counted at once.
CHUNK = 1 << 16


def shingle_hashes(text: bytes, size: int = SHINGLE) -> list[int]:
    """XXH64 of each run of ``size`` words, joined by one space; of all words if there are fewer."""
    words = text.lower().split()
    if not words:
        return []
    joined = b" ".join(words)
    if len(words) <= size:
        return [xxhash.xxh64_intdigest(joined, SEED)]
    ends = list(accumulate(map(len, words), lambda end, n: end + 1 + n))
    starts = [0, *(e + 1 for e in ends)]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :], strict=False)]


def fingerprint_of(texts: list[bytes]) -> np.ndarray:
    """Fingerprints of texts, as unsigned integers: a bit is 1 if it is in more than half of the hashes."""
    hashes = [shingle_hashes(t) for t in texts]
    sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
    owner = np.repeat(np.arange(len(texts)), sizes)
    flat = np.fromiter((h for some in hashes for h in some), np.uint64, len(owner))
    ones = np.zeros((len(texts), 64), np.int64)
    for at in range(0, len(flat), CHUNK):
        of = owner[at : at + CHUNK]
        bits = np.unpackbits(flat[at : at + CHUNK].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
        ones[of[first]] += np.add.reduceat(bits, first, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > sizes[:, None], axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with ``fingerprint`` (a long, its bits) and ``doc_key`` (doc_id)."""
    rows = packed(docs, keep, doc_key=F.col("doc_id").cast("long"), text=text_of("text").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):
            at = 0
            for some in in_batches(((t,) for t in batch.column("text").to_pylist()), 0):
                made = fingerprint_of([t for (t,) in some]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(at, len(some)) for c in (ROW, "doc_key")), pa.array(made)], names=[ROW, "doc_key", "fingerprint"]
                )
                at += len(some)

    return rows.mapInArrow(run, f"{ROW} {rows.schema[ROW].dataType.simpleString()}, doc_key long, fingerprint long")


def _masks(levels: int) -> list[list[int]]:
    """For each level the masks of the bits that a key holds; those that come from mask i are 6 * i ... 6 * i + 5."""
    out = [[0]]
    for _ in range(levels):
        made = []
        for mask in out[-1]:
            free = [b for b in range(64) if not mask >> b & 1]
            size = len(free) // BLOCKS
            blocks = [sum(1 << b for b in free[k * size : (k + 1) * size]) for k in range(BLOCKS)]
            made += [mask | sum(some) for some in combinations(blocks, BLOCKS - DISTANCE)]
        out.append(made)
    return out


CHOICES = len(list(combinations(range(BLOCKS), BLOCKS - DISTANCE)))
LEVELS = 3
MASKS = _masks(LEVELS)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links of a spanning forest among different fingerprints, where those at ``DISTANCE`` or less are linked."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= DISTANCE
    left = np.ones(len(prints), bool)
    a, b = [], []
    for root in range(len(prints)):
        if not left[root]:
            continue
        left[root] = False
        reached = [root]
        while reached:
            at = reached.pop()
            new = np.flatnonzero(near[at] & left)
            left[new] = False
            a += [at] * len(new)
            b += new.tolist()
            reached += new.tolist()
    return prints[a], prints[b]


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, 512):
        a, b = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for row in batch.column("prints"):
            x, y = _forest(row.values.to_numpy().view(np.uint64))
            a.append(x)
            b.append(y)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).view(np.int64)) for c in (a, b)], names=["a", "b"])


def links(entries: DataFrame, few: int = FEW) -> DataFrame:
    """Links ``(a, b)`` that join all fingerprints at distance two or less of ``entries(fingerprint)`` (different ones); staged."""
    rows = entries.select("fingerprint", F.lit(0).alias("mask"))
    found = None
    for level in range(1, LEVELS + 1):
        masks = F.array(*(F.lit(_signed(m)) for m in MASKS[level]))
        rows = rows.select("fingerprint", F.explode(F.expr(f"transform(sequence(0, {CHOICES - 1}), c -> {CHOICES} * mask + c)")).alias("mask"))
        rows = rows.withColumn("key", F.col("fingerprint").bitwiseAND(F.get(masks, F.col("mask"))))
        shared = rows.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
        rows = staged(rows.join(shared, ["mask", "key"]), "blocks")
        small = rows if level == LEVELS else rows.where(F.col("n") <= few)
        # a list has ``few`` entries at most, or as many as the bits left free allow
        lists = small.groupBy("mask", "key").agg(F.collect_list("fingerprint").alias("prints")).select("prints")
        made = staged(lists.mapInArrow(_linked, "a long, b long"), "links")
        found = made if found is None else found.union(made)
        rows = rows.where(F.col("n") > few)
        if level == LEVELS or rows.isEmpty():
            return found
    return found


def near_duplicates(docs: DataFrame, keep: list[str] | None = None, few: int = FEW) -> DataFrame:
    """Rows of ``docs`` packed (all columns, or those of ``keep``), with ``fingerprint`` (16 hex digits), ``component_id``
    (least doc_id of the class), ``class_rows`` and ``class_prints`` (rows and different fingerprints of the class)."""
    rows = staged(fingerprints(docs, keep), "fingerprints")
    entries = rows.groupBy("fingerprint").agg(F.min("doc_key").alias("least"), F.count("*").alias("n"))
    entries = staged(entries, "entries")
    roots = staged(components(links(entries, few)), "roots")
    named = entries.join(roots.withColumnRenamed("id", "fingerprint"), "fingerprint", "left")
    named = named.withColumn("root", F.coalesce("root", "fingerprint"))
    classes = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("class_rows"), F.count("*").alias("class_prints"))
    named = staged(named.select("fingerprint", "n", "root").join(classes, "root").drop("root"), "named")
    total = named.agg(F.sum("n")).first()[0] or 0
    # a fingerprint with a large share of all rows is joined where its rows are; there are at most HOT of these
    hot = F.col("n") > total / HOT
    often = F.broadcast(named.where(hot).drop("n").withColumn("often", F.lit(True)))
    first = rows.join(often, "fingerprint", "left")
    rest = first.where("often is null").select(ROW, "fingerprint").join(named.where(~hot).drop("n"), "fingerprint")
    columns = [ROW, "fingerprint", "component_id", "class_rows", "class_prints"]
    out = first.where("often").select(columns).unionByName(rest.select(columns))
    return out.withColumn("fingerprint", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")))
