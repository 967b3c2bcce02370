"""The training-data pipeline: each stage takes and returns documents.

Every stage's result is written as Parquet below the shared folder and read back as
the next one's input, so a lost executor costs one stage at most. The last stage
returns each document that is left with the digests of its token ids and of the bytes
decoded from them.

Defined results: a null, empty or wordless text fails the quality rules and goes, as in any
row; a text of any length is judged, compared and encoded whole; of repeated rows, of copies
and of a group of near duplicates the one of the least doc_id stays (a null one comes last,
and of rows alike in id and text any one stays); an empty table gives an empty result;
columns besides doc_id and text, whatever their names, go through the stages untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formflow.llm import decontaminate, near_dedup, quality_rules, queries
from formflow.llm.common import staged, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, as digests of the ids and of what they decode to."""
    return queries.encoded_digests(docs)


STAGES = [("quality_rules", quality), ("near_dedup", near_duplicates), ("decontamination", benchmark), ("byte_bpe", tokens)]

#: The token stage is beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
