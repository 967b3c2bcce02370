"""Connected components of a table of links, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formflow.llm.common import staged


#: Nodes with more than one in so many of all edge ends (so at most as many) are joined by broadcast.
HOT = 1000


def _with_least(rows: DataFrame, key: str, value: str, total: int) -> DataFrame:
    """``rows`` with ``least``, the least ``value`` of their ``key``. A key with a large share of the ``total`` rows is
    joined where its rows are, so that no task gathers them."""
    least = rows.groupBy(key).agg(F.min(value).alias("least"), F.count("*").alias("n"))
    hot = F.broadcast(least.where(F.col("n") > total / HOT).select(key, F.col("least").alias("often")))  # HOT rows at most
    marked = rows.join(hot, key, "left")
    here = marked.where("often is not null").withColumnRenamed("often", "least")
    return here.unionByName(marked.where("often is null").drop("often").join(least.select(key, "least"), key))


def components(links: DataFrame) -> DataFrame:
    """``(id, root)`` for every id in ``links(a, b)``; root is the least id of its component.

    Each round links a node's larger neighbours to its least one, then its smaller
    neighbours too, until every node points at its root. Least neighbours are counted
    with a map-side combine and a node with very many links is joined by broadcast, so it
    is no single task's work. Nothing comes to the driver but a checksum.
    """
    edges = staged(links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")), "links")
    seen = None
    while True:
        mark = tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first())
        if mark == seen:
            return edges.select(F.col("hi").alias("id"), F.col("lo").alias("root")).union(edges.select("lo", "lo").distinct())
        seen = mark
        both = edges.selectExpr("hi as u", "lo as v").union(edges.selectExpr("lo as u", "hi as v"))
        met = _with_least(both, "u", "v", 2 * mark[0])
        large = staged(met.where("v > u").selectExpr("v as hi", "least(least, u) as lo"), "links")
        lows = _with_least(large, "hi", "lo", mark[0])
        small = lows.where("lo <> least").selectExpr("lo as hi", "least as lo")
        edges = staged(small.union(lows.selectExpr("hi", "least as lo")).distinct(), "links")


def joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """``roots(id, root)`` after further links: only the components that these link are worked on."""
    of = roots.withColumnRenamed("root", "r")
    ends = links.join(of.toDF("a", "ra"), "a", "left").join(of.toDF("b", "rb"), "b", "left")
    ends = ends.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b"))
    further = components(ends).toDF("r", "root")
    moved = of.join(further, "r", "left").select("id", F.coalesce("root", "r").alias("root"))
    # ids that had no link before are their own root in ``further``
    new = further.join(of.select(F.col("id").alias("r")), "r", "left_anti").select(F.col("r").alias("id"), "root")
    return staged(moved.union(new), "roots")
