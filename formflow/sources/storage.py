"""Media object keys of a tenant."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def list_media_keys(spark: SparkSession, path: str) -> DataFrame:
    """Keys below ``path`` by listing the storage; no file is opened.

    Listing runs in parallel but the file index is held by the driver. For a
    tenant with very many objects use :func:`read_inventory`.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select(F.col("path").alias("object_key"))
    )


def read_inventory(spark: SparkSession, path: str, key_column: str, prefix: str, fmt: str = "parquet") -> DataFrame:
    """Keys below ``prefix`` from the storage provider's inventory dataset."""
    keys = spark.read.format(fmt).load(path).select(F.col(key_column).alias("object_key"))
    return keys.where(F.col("object_key").startswith(prefix))
