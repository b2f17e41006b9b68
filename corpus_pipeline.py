"""From documents to tokens of clean, distinct and uncontaminated ones.

Each stage reads what the one before it wrote. Those that filter keep whole rows with the columns of `documents`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cadastra.llm import bpe, decontaminate, queries, simhash_dups
from cadastra.scratch import cleared, delete, new_folder

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator does not reject."""
    return docs.where(queries.toxicity_score(spark, docs, sf_dir) < queries.PREDICTED_FROM)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return docs.where(queries.quality_score(spark, docs, sf_dir) >= queries.PREDICTED_FROM)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return simhash_dups.keep_one(docs, queries.SHINGLE_WORDS, queries.MAX_BITS)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a benchmark item."""
    return decontaminate.remove_copies(docs, queries.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with the digests of ids and of the bytes decoded from them."""
    return queries.tokenized(docs.select("doc_id", "text")).select("doc_id", "token_ids", *bpe.token_digests())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("quality", keep_good),
    ("near_duplicates", drop_near_copies),
    ("decontamination", drop_test_items),
    ("tokens", encode),
]

#: No SQL: the stages fit models, and compress and merge bytes.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table `documents`; the folder of the last one is the caller's to delete."""
    docs, before = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = new_folder(spark, f"stage-{name}")
        with cleared(spark):  # what a stage stored on its way goes when its result is there
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before:
            delete(spark, before)
        before = path
    return docs
