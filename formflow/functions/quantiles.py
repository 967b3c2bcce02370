"""Exact medians of groups of any size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 1_000_000


def grouped_median(df: DataFrame, keys: Sequence[str], value: str, out: str, bucket: int = BUCKET) -> DataFrame:
    """Continuous median of an integer column per group, null if all null.

    Two levels of counting, both with map-side combine: first per bucket of
    ``bucket`` neighbouring values, which tells the bucket of the middle
    ranks, then per value inside those buckets only. No task ever holds a
    group's rows, only counts of its buckets or of one bucket's values.
    """
    present = df.where(F.col(value).isNotNull()).withColumn("_b", F.floor(F.col(value) / F.lit(bucket)))
    buckets = present.groupBy(*keys, "_b").agg(F.count(F.lit(1)).alias("_n"))
    by_bucket = Window.partitionBy(*keys).orderBy("_b")
    whole = Window.partitionBy(*keys)
    marks = (
        buckets.withColumn("_upto", F.sum("_n").over(by_bucket))
        .withColumn("_total", F.sum("_n").over(whole))
        # 0-based ranks of the one or two middle values
        .withColumn("_lo", F.floor((F.col("_total") - 1) / 2))
        .withColumn("_hi", F.floor(F.col("_total") / 2))
        .withColumn("_before", F.col("_upto") - F.col("_n"))
        .where((F.col("_before") <= F.col("_hi")) & (F.col("_upto") > F.col("_lo")))
        .select(*keys, "_b", "_before", "_lo", "_hi")
    )
    values = (
        present.join(marks, [*keys, "_b"])
        .groupBy(*keys, "_b", "_before", "_lo", "_hi", value)
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    by_value = Window.partitionBy(*keys, "_b").orderBy(value)
    ranked = values.withColumn("_end", F.col("_before") + F.sum("_n").over(by_value)).withColumn(
        "_start", F.col("_end") - F.col("_n")
    )

    def at(rank: str):
        inside = (F.col("_start") <= F.col(rank)) & (F.col(rank) < F.col("_end"))
        return F.max(F.when(inside, F.col(value)))

    return ranked.groupBy(*keys).agg(((at("_lo") + at("_hi")) / 2).alias(out))
