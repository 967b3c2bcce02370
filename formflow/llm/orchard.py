"""Clustering of vectors around centroids by Orchard's search.

Components become integers floor(scale * x), so that every sum and distance is exact.
The first centroids are the vectors whose ids have the smallest hashes. In each round
every vector goes to its nearest centroid and every centroid that has vectors becomes
the floor of their mean.

The nearest centroid is searched for along lists: each centroid has the others in order of
their distance from it. A vector starts at centroid 0 and walks its list. A centroid that
is closer (or as close, with a smaller number) becomes the current one, whose list is
walked from its start; centroids once visited are marked and skipped. The walk stops where
the list's distance is strictly beyond twice the distance to the current centroid: by the
triangle inequality nothing behind it is as close. Ties are not lost, since only what is
strictly farther is cut off. The vectors of a batch walk side by side.

The centroids and their lists are sent to the workers: k * (dims + k) numbers. A task sums
its vectors for each centroid and sends one row for each component, so a centroid with a
third of all vectors is a few rows a task. The input is read once for the seeds, once a
round and once at the end; nothing of it is shuffled.

Defined results: a vector that is null, of another length, or has a null or non-finite
component is left out; a null id is hashed as empty text; repeated rows are vectors of
their own; rows with equal hash are ordered by their components; with fewer vectors than
centroids each starts a centroid; an empty table gives an empty result; other columns
are left alone. Components of any size are summed and compared exactly; a distance or
inertia beyond a long is given as the largest long.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import ROW, packed, slices, staged

SCALE = 64
LARGEST = 2**63 - 1
BATCH_ROWS = 2048


def quantised(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of rows of doubles: 64-bit integers if squared distances fit, else Python integers."""
    fits = math.sqrt(2.0**61 / max(1, values.shape[1])) / scale
    if not values.size or np.abs(values).max() < fits:
        return np.floor(values * scale).astype(np.int64)
    out = np.empty(values.shape, object)
    out.flat = [math.floor(Fraction(x) * scale) for x in values.ravel().tolist()]
    return out


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of the rows of two arrays, exact."""
    gap = a - b
    return (gap * gap).sum(axis=-1)


class Orchard:
    """Centroids, each with the others in order of distance (ties: by number)."""

    def __init__(self, centroids: list[list[int]]):
        k, dims = len(centroids), len(centroids[0])
        self.centroids = np.empty((k, dims), object)
        self.centroids[:] = centroids
        if np.abs(self.centroids).max(initial=0) < math.sqrt(2.0**61 / dims):
            self.centroids = self.centroids.astype(np.int64)
        gaps = [squared(self.centroids[[i]], self.centroids).tolist() for i in range(k)]
        self.order = np.array([sorted((j for j in range(k) if j != i), key=lambda j: (gaps[i][j], j)) for i in range(k)], np.int64).reshape(k, k - 1)
        # gap > 4 * d (all squared: beyond twice the distance) is d <= (gap - 1) // 4
        quarters = [[(gaps[i][j] - 1) // 4 for j in self.order[i]] for i in range(k)]
        self.quarter = np.array(quarters, self.centroids.dtype).reshape(k, k - 1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Of each row the nearest centroid and its squared distance; and how many distances were computed."""
        k = len(self.centroids)
        now = np.zeros(len(x), np.int64)
        best = squared(x, self.centroids[0])
        seen = np.zeros((len(x), k), bool)
        seen[:, 0] = True
        place = np.zeros(len(x), np.int64)
        walking, made = np.arange(len(x)), len(x)
        while True:
            walking = walking[place[walking] < k - 1]
            beyond = (best[walking] <= self.quarter[now[walking], place[walking]]).astype(bool)
            walking = walking[~beyond]
            if not len(walking):
                return now, best, made
            other = self.order[now[walking], place[walking]]
            place[walking] += 1
            fresh = ~seen[walking, other]
            i, j = walking[fresh], other[fresh]
            seen[i, j] = True
            distance = squared(x[i], self.centroids[j])
            made += len(i)
            closer = (distance < best[i]).astype(bool) | (distance == best[i]).astype(bool) & (j < now[i])
            i, j = i[closer], j[closer]
            now[i], best[i], place[i] = j, distance[closer], 0


def _vectors(batches: Iterator[pa.RecordBatch], dims: int, scale: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in slices(batches, BATCH_ROWS):
        if batch.num_rows:
            values = batch.column("vector").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            yield batch, quantised(values.reshape(-1, dims), scale)


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """An integer as digits of 32 bits, the last one signed."""
    place = 0
    while not -(1 << 31) <= value < 1 << 31:
        yield place, value & 0xFFFFFFFF
        place, value = place + 1, value >> 32
    yield place, value


COUNT = -1  # the component under which a cluster's vectors are counted
_SUMS = "cluster int, component int, limb int, value long"


def _summer(sent, dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orchard = sent.value
        k = len(orchard.centroids)
        sums, counts = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for _, x in _vectors(batches, dims, scale):
            cluster, _, _ = orchard.nearest(x)
            part = np.zeros((k, dims), x.dtype)
            np.add.at(part, cluster, x)
            sums = sums + part.astype(object)
            counts += np.bincount(cluster, minlength=k)
        rows = [(c, COUNT, limb, v) for c in range(k) if counts[c] for limb, v in _limbs(int(counts[c]))]
        rows += [(c, d, limb, v) for c in range(k) if counts[c] for d in range(dims) for limb, v in _limbs(int(sums[c, d]))]
        columns = zip(*rows, strict=True) if rows else [()] * 4
        types = [pa.int32()] * 3 + [pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["cluster", "component", "limb", "value"])

    return run


def _assigner(sent, dims: int, scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, x in _vectors(batches, dims, scale):
            cluster, distance, _ = sent.value.nearest(x)
            distance = [min(d, LARGEST) for d in distance.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(ROW), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=[ROW, "cluster", "distance"])

    return run


def usable(column: str, dims: int):
    """Whether a vector has ``dims`` components, none null or non-finite."""
    return F.expr(f"coalesce(size(`{column}`) = {dims} and forall(`{column}`, x -> x is not null and abs(x) < double('infinity')), false)")


def clusters(
    vectors: DataFrame,
    k: int = 16,
    rounds: int = 3,
    dims: int = 64,
    scale: int = SCALE,
    seed: int = 1,
    id_column: str = "vec_id",
    column: str = "embedding",
    keep: list[str] | None = None,
) -> tuple[DataFrame, list[list[int]]]:
    """Rows of ``vectors`` packed (all columns, or those of ``keep``) with ``cluster`` and squared ``distance``; staged.
    And the centroids at the end."""
    spark = vectors.sparkSession
    kept = vectors.where(usable(column, dims))
    mark = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{id_column}`").cast("string"), F.lit(""))), 256)
    first = kept.select(mark.alias("mark"), F.col(f"`{column}`").alias("vector")).orderBy("mark", "vector").limit(k).collect()
    rows = packed(kept, keep, vector=F.col(f"`{column}`"))
    schema = f"{ROW} {rows.schema[ROW].dataType.simpleString()}, cluster int, distance long"
    if not first:
        return spark.createDataFrame([], schema), []
    centroids = quantised(np.array([r.vector for r in first], np.float64), scale).tolist()
    narrow = rows.select("vector")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(Orchard(centroids))
        sums = narrow.mapInArrow(_summer(sent, dims, scale), _SUMS).groupBy("cluster", "component", "limb").agg(F.sum("value").alias("value"))
        total: dict[tuple[int, int], int] = {}
        for r in sums.collect():  # k * (dims + 1) numbers
            total[r.cluster, r.component] = total.get((r.cluster, r.component), 0) + (r.value << 32 * r.limb)
        centroids = [
            [total[c, d] // total[c, COUNT] for d in range(dims)] if (c, COUNT) in total else old for c, old in enumerate(centroids)
        ]
        sent.unpersist()
    sent = spark.sparkContext.broadcast(Orchard(centroids))
    return staged(rows.mapInArrow(_assigner(sent, dims, scale), schema), "clusters"), centroids


def with_inertia(assigned: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """The rows of ``clusters`` with cluster_inertia, inertia and the digest of their final centroid."""
    spark = assigned.sparkSession
    largest = F.lit(LARGEST).cast("decimal(38,0)")
    exact = F.sum(F.col("distance").cast("decimal(19,0)")).cast("decimal(38,0)")
    each = assigned.groupBy("cluster").agg(exact.alias("own"))
    total = each.agg(F.sum("own").cast("decimal(38,0)").alias("all"))
    digests = [(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(centroids)]
    named = spark.createDataFrame(digests, "cluster int, centroid_sha256 string")
    # one row for each centroid
    each = each.join(F.broadcast(named), "cluster").withColumn("all", total.scalar()).select(
        "cluster",
        F.least("own", largest).cast("long").alias("cluster_inertia"),
        F.least("all", largest).cast("long").alias("inertia"),
        "centroid_sha256",
    )
    return assigned.join(F.broadcast(each), "cluster")
