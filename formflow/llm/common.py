"""What the operators of this folder share: tables, staged tables, row packing."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.session import shared_dir

ROW = "__row"
#: Staged tables, below the shared folder.
FOLDER = "formflow-llm"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage: what is read later does not depend on the executors that
    made it. The folder belongs to whoever owns ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{FOLDER}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def batch_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Actions inside send Python at most so many rows at once. An executor holds each task's batch several times:
    as vectors, as a stream and in Python."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    spark.conf.set(key, min(rows, before) if before > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def clear_staged(spark: SparkSession, older_than_hours: float) -> int:
    """Delete staged tables that were written so long ago; returns how many. For the owner of the folder,
    between runs: a result that has not been written elsewhere still reads its tables."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{FOLDER}")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    latest = (time.time() - older_than_hours * 3600) * 1000
    old = [s.getPath() for s in fs.listStatus(folder) if s.getModificationTime() <= latest] if fs.exists(folder) else []
    for path in old:
        fs.delete(path, True)
    return len(old)


def packed(df: DataFrame, keep: list[str] | None = None, **columns: Column) -> DataFrame:
    """The row (or its columns in ``keep``) as one struct beside the working columns, so that
    no column of the input can clash with one of the operator's own."""
    row = F.struct(*(F.col(f"`{c}`") for c in keep or df.columns))
    return df.select(row.alias(ROW), *(c.alias(n) for n, c in columns.items()))


def unpacked(df: DataFrame) -> DataFrame:
    return df.select(f"{ROW}.*")


def slices(batches: Iterable, rows: int = 128) -> Iterable:
    """Arrow batches cut into small ones, so that a task holds the Python values of a few rows only."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def text_of(column: str | Column) -> Column:
    """A text column; null counts as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def any_of(conditions: Iterable[Column]) -> Column:
    out = F.lit(False)
    for c in conditions:
        out = out | c
    return out
