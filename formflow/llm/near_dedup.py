"""Near-duplicate classes by probability MinHash.

1. Exact copies are one text. Each text's five-word shingles, weighted by how often
   they occur, get a ProbMinHash signature: every shingle is a Poisson process whose
   rate is its weight, each arrival picks a register, and a register keeps the shingle
   that arrives first. A shingle whose next arrival is later than the latest register
   is done. Two registers agree with the probability Jaccard similarity of the texts.
   A text that repeats a shingle has a second signature with all weights 1, whose
   registers agree with the Jaccard similarity of the sets; for others it is the same.
2. Bands of registers, of both signatures alike, give buckets; buckets with the same members
   count once. The members of a bucket are dealt into blocks of bounded size, with their
   whole texts. In a block every two members that are not of one component yet are
   compared exactly: probability Jaccard or Jaccard of the shingle sets of 0.8 or more is
   a link, and only links that join two components go on.
3. A bucket of one block is done, and so is one whose members are one component by now. In
   the others every two blocks meet in the same way; a component that fills blocks of its
   own does not meet itself.
4. A class is a component of the verified links.

So every two texts that share a bucket and are not of one component anyway are compared,
on their whole texts. Pairs are never rows: a block gives fewer links than it has members.
A bucket's rows are repeated once for each block that they meet, and the comparisons in
tasks grow with the square of its members outside one component.

Defined results: null counts as empty text; a text of one to four words has one shingle
of all its words; texts without words are only linked to exact copies; repeated rows
are copies; an empty table gives an empty result; ``keep_one`` keeps all columns,
``near_duplicates`` reads doc_id and text only. Words
are runs of ASCII letters, digits and non-ASCII characters, A-Z lower-cased.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from formflow.llm.common import packed, slices, staged, text_of, unpacked
from formflow.llm.components import components, joined
from formflow.llm.words import ALNUM, BATCH_BYTES, in_batches, mix, split_words, windows

SHINGLE = 5
SIMILARITY = 0.8
BANDS, ROWS = 32, 5  # a pair at 0.8 shares no band once in 300,000
REGISTERS = BANDS * ROWS
BLOCK = 512  # members of a bucket that are compared with each other in one task, about
BLOCK_BYTES = 4 << 20  # and their texts


def weighted_shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text in ascending order, how often each occurs, and bounds per text."""
    hashes, bounds = windows(split_words(texts, ALNUM), SHINGLE)
    owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
    order = np.lexsort((hashes, owner))
    hashes, owner = hashes[order], owner[order]
    first = np.ones(len(hashes), bool)
    first[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(first)
    weights = np.diff(np.append(at, len(hashes)))
    return hashes[at], weights.astype(np.float64), np.searchsorted(owner[at], np.arange(len(texts) + 1))


def signatures(elements: np.ndarray, weights: np.ndarray, bounds: np.ndarray, registers: int = REGISTERS) -> np.ndarray:
    """ProbMinHash signatures, one row of ``registers`` element ids per set.

    Every pass takes the next arrival of all elements that are still in time.
    Sets without elements keep zeros.
    """
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    earliest = np.full(n * registers, np.inf)
    winner = np.zeros(n * registers, np.uint64)
    latest = np.full(n, np.inf)
    active, clock, turn = np.arange(len(elements)), np.zeros(len(elements)), 0
    while len(active):
        turn += 1
        draw = mix(elements[active] + mix(np.array([turn], np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        clock = clock - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weights[active]
        due = clock < latest[owner[active]]
        active, clock, draw = active[due], clock[due], draw[due]
        cell = owner[active] * registers + (mix(draw + np.uint64(1)) % np.uint64(registers)).astype(np.int64)
        sooner = np.flatnonzero(clock < earliest[cell])
        sooner = sooner[np.argsort(-clock[sooner], kind="stable")]  # of several, the earliest is written last
        earliest[cell[sooner]] = clock[sooner]
        winner[cell[sooner]] = elements[active[sooner]]
        touched = np.unique(owner[active[sooner]])
        latest[touched] = earliest.reshape(n, registers)[touched].max(axis=1)
    return winner.reshape(n, registers)


def _band_keys(signature: np.ndarray) -> np.ndarray:
    parts = signature.reshape(len(signature), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(ROWS):
        key = mix(key * np.uint64(3) + parts[:, :, k])
    return key.view(np.int64) if key.flags.c_contiguous else np.ascontiguousarray(key).view(np.int64)


def _text_rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple]:
    for batch in slices(batches):
        yield from zip(*(batch.column(n).to_pylist() for n in names), strict=True)


_SIGNED = pa.schema([("copy_key", pa.binary()), ("doc_key", pa.int64()), ("size", pa.int64()), ("bands", pa.list_(pa.int64()))])


def _signed(batches):
    for rows in in_batches(_text_rows(batches, ("text", "copy_key", "doc_key")), 0, 2 * BATCH_BYTES):
        texts = [r[0] for r in rows]
        elements, weights, bounds = weighted_shingles(texts)
        found = signatures(elements, weights, bounds)
        sizes = np.diff(bounds)
        repeats = np.bincount(np.repeat(np.arange(len(rows)), sizes), weights > 1, len(rows)) > 0
        ones = np.repeat(repeats, sizes)
        plain = signatures(elements[ones], np.ones(ones.sum()), np.append(0, np.cumsum(sizes[repeats])))
        keys = list(_band_keys(found))
        for i, k in zip(np.flatnonzero(repeats), _band_keys(plain), strict=True):
            keys[i] = np.union1d(keys[i], k)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[1] for r in rows], pa.binary()),
                pa.array([r[2] for r in rows], pa.int64()),
                pa.array([len(t) for t in texts], pa.int64()),
                pa.array([keys[i] if sizes[i] else [] for i in range(len(rows))], pa.list_(pa.int64())),
            ],
            schema=_SIGNED,
        )


#: Stands for a null doc_id in keys.
NO_ID = 2**63 - 1


def _keys() -> list[Column]:
    doc_id = F.col("doc_id").cast("long")
    return [F.unhex(F.md5(text_of("text"))).alias("copy_key"), F.coalesce(doc_id, F.lit(NO_ID)).alias("doc_key")]


def _copies(docs: DataFrame) -> DataFrame:
    return docs.select(*_keys(), text_of("text").cast("binary").alias("text"))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """One row per text: id, copy_key, its least doc_id as doc_key, number of rows, size in bytes, band keys."""
    signed = _copies(docs).mapInArrow(_signed, "copy_key binary, doc_key long, size long, bands array<long>")
    one = signed.groupBy("copy_key").agg(
        F.min("doc_key").alias("doc_key"), F.count("*").alias("n_rows"), F.first("size").alias("size"), F.first("bands").alias("bands")
    )
    return staged(one.withColumn("id", F.monotonically_increasing_id()), "texts")


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of Jaccard similarity and probability Jaccard similarity of two weighted sets (ids ascending)."""
    both, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    plain = len(both) / (len(a[0]) + len(b[0]) - len(both))
    if plain >= SIMILARITY:
        return plain
    # sum over shared i of 1 / sum over all j of max(x_j / x_i, y_j / y_i), by the order of x / y
    x, y = a[1] / a[1].sum(), b[1] / b[1].sum()
    xs, ys = x[i], y[j]
    order = np.argsort(xs / ys)
    xs, ys = xs[order], ys[order]
    above = xs.sum() - np.cumsum(xs)  # shared ones with a larger ratio weigh by x, the rest by y
    below = np.cumsum(ys)
    only_x, only_y = 1 - xs.sum(), 1 - ys.sum()
    return max(plain, float((1 / ((above + only_x) / xs + (below + only_y) / ys)).sum()))


def _forest(sets: list[tuple[np.ndarray, np.ndarray]], roots: np.ndarray, side: np.ndarray) -> list[tuple[int, int]]:
    """Links (by place) that join all of the weighted sets whose roots differ and that are near duplicates. With two sides
    only sets of different sides are compared."""
    roots = np.unique(roots, return_inverse=True)[1]
    sizes = np.array([len(x) for x, _ in sets])
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    _, flat = np.unique(np.concatenate([x for x, _ in sets]), return_inverse=True)
    weights = np.concatenate([w / w.sum() for _, w in sets])
    repeats = np.array([w.max() > 1 for _, w in sets])
    mark, other = np.zeros(flat.max() + 1, bool), np.zeros(flat.max() + 1)
    links = []
    first = int(np.searchsorted(side, 1)) if side[-1] else 0  # sides are sorted
    for i in range(first or len(sets) - 1):
        at = max(first, i + 1)
        if (roots[at:] == roots[i]).all():
            continue
        mine = flat[bounds[i] : bounds[i + 1]]
        mark[mine] = True
        cut = bounds[at:-1] - bounds[at]
        rest = flat[bounds[at] :]
        shared = np.add.reduceat(mark[rest], cut, dtype=np.int64)
        mark[mine] = False
        near = shared >= (SIMILARITY - 1e-9) * (sizes[i] + sizes[at:] - shared)
        # without repeats both measures are equal; with them the shared weight is a bound of the other one
        if repeats[i] or (repeats[at:] & ~near & (shared > 0)).any():
            other[mine] = weights[bounds[i] : bounds[i + 1]]
            common = np.add.reduceat(np.minimum(other[rest], weights[bounds[at] :]), cut)
            other[mine] = 0
            for j in np.flatnonzero(~near & (repeats[at:] | repeats[i]) & (common >= SIMILARITY - 1e-9) & (roots[at:] != roots[i])):
                near[j] = similarity(sets[i], sets[at + j]) >= SIMILARITY - 1e-9
        for j in np.flatnonzero(near).tolist():
            if roots[at + j] != roots[i]:
                links.append((i, at + j))
                roots[roots == roots[at + j]] = roots[i]
    return links


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows (meeting, side, id, root, text), sorted by meeting, as one list for each meeting."""
    held: list[tuple] = []
    for row in _text_rows(batches, ("meeting", "side", "id", "root", "text")):
        if held and row[0] != held[0][0]:
            yield held
            held = []
        held.append(row)
    if held:
        yield held


def _met(batches):
    meetings = ((b"".join(r[4] for r in rows), rows) for rows in _meetings(batches))
    for some in in_batches(meetings, 0):
        elements, weights, bounds = weighted_shingles([r[4] for _, rows in some for r in rows])
        sets = [(elements[s:e], weights[s:e]) for s, e in zip(bounds, bounds[1:], strict=False)]
        a, b, at = [], [], 0
        for _, rows in some:
            side, ids, roots = (np.array([r[k] for r in rows]) for k in (1, 2, 3))
            for i, j in _forest(sets[at : at + len(rows)], roots, side):
                a.append(ids[i])
                b.append(ids[j])
            at += len(rows)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (a, b)], names=["a", "b"])


def _links(rows: DataFrame, whole: DataFrame) -> DataFrame:
    """The verified links ``(a, b)`` of ``rows(meeting, side, id, root)`` that join components; staged."""
    dealt = rows.join(whole, "id").select("meeting", "side", "id", "root", "text")
    dealt = dealt.repartition("meeting").sortWithinPartitions("meeting", "side", "id")
    return staged(dealt.mapInArrow(_met, "a long, b long"), "links")


def _whole_texts(docs: DataFrame, texts: DataFrame, ids: DataFrame) -> DataFrame:
    """``(id, text)`` of some distinct texts, each read from the one row that stands for its copies; staged."""
    wanted = texts.join(ids, "id", "left_semi").select("id", "copy_key", "doc_key")
    found = _copies(docs).join(wanted, ["copy_key", "doc_key"]).select("id", "text")
    return staged(found.dropDuplicates(["id"]), "wanted")


def _mixed(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Of ``members(key, id, ...)`` those in buckets of more than one component, with their root."""
    labelled = members.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))
    keys = labelled.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    return staged(labelled.join(keys.select("key"), "key", "left_semi"), "mixed")


def _blocks(count: Column, size: Column) -> Column:
    """In how many blocks so many members with so many bytes are dealt."""
    return F.greatest(F.lit(1), F.ceil(count / BLOCK), F.ceil(size / BLOCK_BYTES))


def _buckets(texts: DataFrame) -> DataFrame:
    """``(key, id, size, blocks)`` of the texts that share a band, each set of members once; staged."""
    bands = texts.select("id", "size", F.explode("bands").alias("key"))
    members = [F.bit_xor(F.xxhash64("id", F.lit(k))).alias(f"members_{k}") for k in (0, 1)]
    keys = bands.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("bytes"), *members).where("n > 1")
    keys = keys.groupBy("n", "bytes", "members_0", "members_1").agg(F.min("key").alias("key"))
    return staged(bands.join(keys.select("key", _blocks(F.col("n"), F.col("bytes")).alias("blocks")), "key"), "buckets")


def _first_meetings(buckets: DataFrame) -> DataFrame:
    """Each block of each bucket by itself; nothing is linked yet."""
    part = F.pmod(F.xxhash64("id", "key"), F.col("blocks"))
    meeting = F.when(F.col("blocks") > 1, F.xxhash64("key", part)).otherwise(F.col("key"))
    return buckets.select(meeting.alias("meeting"), F.lit(0).alias("side"), "id", F.col("id").alias("root"))


def _later_meetings(members: DataFrame) -> DataFrame:
    """Of ``members(key, id, size, root)`` every two blocks of one bucket.

    A component that fills a block or more has blocks of its own, which do not meet each other; the smaller
    ones share blocks."""
    sizes = members.groupBy("key", "root").agg(_blocks(F.count("*"), F.sum("size")).alias("blocks"), F.count("*").alias("c"), F.sum("size").alias("bytes"))
    own = (F.col("c") >= BLOCK) | (F.col("bytes") >= BLOCK_BYTES)
    shared = sizes.where(~own).groupBy("key").agg(_blocks(F.sum("c"), F.sum("bytes")).alias("shared_blocks"))
    sizes = sizes.join(shared, "key", "left").select(
        "key", "root", F.when(own, F.col("root")).otherwise(-1).alias("own"), F.when(own, F.col("blocks")).otherwise(F.col("shared_blocks")).alias("blocks")
    )
    mine = F.when(F.col("own") == -1, F.xxhash64("root", "key")).otherwise(F.xxhash64("id", "key"))
    placed = members.join(sizes, ["key", "root"]).select("key", "id", "root", "own", F.pmod(mine, F.col("blocks")).alias("part"))
    placed = staged(placed, "placed")
    at = placed.select("key", "own", "part").distinct()
    both = at.toDF("key", "own_a", "part_a").join(at.toDF("key", "own_b", "part_b"), "key")
    both = both.where("struct(own_a, part_a) <= struct(own_b, part_b) and (own_a = -1 or own_a <> own_b)")
    both = staged(both.withColumn("meeting", F.monotonically_increasing_id()), "meetings")
    at = ["key", "own", "part"]
    first = placed.join(both.selectExpr("key", "own_a as own", "part_a as part", "meeting", "0 as side"), at)
    second = both.where("own_a <> own_b or part_a <> part_b")
    second = placed.join(second.selectExpr("key", "own_b as own", "part_b as part", "meeting", "1 as side"), at)
    columns = ["meeting", "side", "id", "root"]
    return first.select(columns).union(second.select(columns))


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct texts and ``(id, root)`` of those that are linked to another."""
    texts = distinct_texts(docs)
    buckets = _buckets(texts)
    whole = _whole_texts(docs, texts, buckets.select("id").distinct())
    found = _links(_first_meetings(buckets), whole)
    roots = staged(components(found), "roots")
    large = buckets.where("blocks > 1")
    if not large.isEmpty():
        further = _links(_later_meetings(_mixed(large.select("key", "id", "size"), roots)), whole)
        if not further.isEmpty():
            roots = joined(roots, further)
    return texts, roots


def memberships(docs: DataFrame) -> DataFrame:
    """Per distinct text: copy_key, least doc_key, class_id, rows and texts of its class, and
    whether it is the text that stays (that of the least doc_id; a null id comes last)."""
    texts, roots = classes(docs)
    named = texts.select("id", "copy_key", "doc_key", "n_rows").join(roots, "id", "left")
    named = staged(named.withColumn("root", F.coalesce("root", "id")), "named")
    groups = named.groupBy("root").agg(
        F.min(F.struct("doc_key", "id")).alias("first"), F.sum("n_rows").alias("class_rows"), F.count("*").alias("class_texts")
    )
    return named.join(groups, "root").select(
        "copy_key",
        "doc_key",
        F.when(F.col("first.doc_key") != NO_ID, F.col("first.doc_key")).alias("class_id"),
        "class_rows",
        "class_texts",
        (F.col("first.id") == F.col("id")).alias("first_text"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, class_id (least doc_id of the class), class_rows, class_texts
    and ``stays`` (this row, or one of several equal to it, is the one of its class that stays)."""
    member = memberships(docs).withColumnRenamed("doc_key", "first_key")
    rows = docs.select("doc_id", *_keys())
    return rows.join(member, "copy_key").select(
        "doc_id", "class_id", "class_rows", "class_texts", (F.col("first_text") & (F.col("doc_key") == F.col("first_key"))).alias("stays")
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each class, with the columns of ``docs``."""
    keys = ["copy_key", "doc_key"]
    stay = memberships(docs).where("first_text").select(*keys)
    repeated = docs.select(*_keys()).groupBy(*keys).count().where("count > 1").select(*keys, F.lit(True).alias("repeated"))
    stay = staged(stay.join(repeated, keys, "left"), "stay")
    rows = packed(docs, **dict(zip(keys, _keys(), strict=True)))
    once = rows.join(stay.where("repeated is null").select(*keys), keys, "left_semi")
    more = rows.join(stay.where("repeated").select(*keys), keys, "left_semi").dropDuplicates(keys)
    return unpacked(once.unionByName(more))
