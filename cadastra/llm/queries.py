"""The operators as named queries over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import (
    bpe,
    decontaminate,
    embedding_dups,
    hard_negatives,
    html_extract,
    language_id,
    licenses,
    quality_fm,
    sharding,
    simhash_dups,
    tokenizer_alignment,
    toxicity_zstd,
    warc,
)
from cadastra.llm.labels import held_out
from cadastra.scratch import new_folder

#: A document is predicted to have label 1 from this score on.
PREDICTED_FROM = 0.3
QUALITY_FOLDS, QUALITY_FOLD = 5, 0
TOXIC_FOLDS, TOXIC_FOLD = 4, 2
SHARDS, ROW_OVERHEAD = 24, 8
RANK_FILE = "byte_bpe_multi_50k.tiktoken"
COSINE = 0.93
SHINGLE_WORDS, MAX_BITS = 3, 2
#: Anchors have ids divisible by the first number; labels of ids divisible by the second one go one up, of so many.
ANCHOR_EVERY, RELABEL_EVERY, LABELS = 50, 7, 10
LANGUAGE_FOLDS, LANGUAGE_FOLD = 5, 0
BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _prediction(scored: DataFrame, folds: int, fold: int) -> DataFrame:
    predicted = (F.col("score") >= PREDICTED_FROM).cast("int")
    return scored.select("doc_id", held_out("doc_id", folds, fold).alias("held_out"), "score", predicted.alias("predicted"))


def quality_score(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Column:
    """The quality of each of `docs`, by a machine that is fitted to those of them that have labels."""
    machine = quality_fm.fit(docs, table(spark, sf_dir, "labels"), QUALITY_FOLDS, QUALITY_FOLD, metadata=["n_chars"])
    return quality_fm.score(F.col("text"), machine, [F.col("n_chars")])


def toxicity_score(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Column:
    """The toxicity of each of `docs`, by a model that is fitted to those of them that have labels."""
    model = toxicity_zstd.fit(docs, table(spark, sf_dir, "labels"), TOXIC_FOLDS, TOXIC_FOLD)
    return toxicity_zstd.score(F.col("text"), model)


def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return _prediction(docs.withColumn("score", quality_score(spark, docs, sf_dir)), QUALITY_FOLDS, QUALITY_FOLD)


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_copies(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity_zstd(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _prediction(docs.withColumn("score", toxicity_score(spark, docs, sf_dir)), TOXIC_FOLDS, TOXIC_FOLD)


def op4_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign(table(spark, sf_dir, "documents").select("doc_id", "text"), SHARDS, ROW_OVERHEAD)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.learn_weights(pages)).select("page_id", "url", "text", "n_chars")


def tokenized(docs: DataFrame) -> DataFrame:
    return bpe.tokenize(docs, public_tokenizers.path(RANK_FILE), public_tokenizers.PATTERN)


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return tokenized(docs).select("doc_id", *bpe.token_digests())


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    return warc.read_archives(spark, path).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op8_embedding_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    linked = embedding_dups.near_duplicates(rows, COSINE)
    return linked.select("vec_id", "n_links", "component_id", "kept")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dups.components(table(spark, sf_dir, "documents"), SHINGLE_WORDS, MAX_BITS)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % RELABEL_EVERY == 0, (F.col("label") + 1) % LABELS).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", moved), F.col("vec_id") % ANCHOR_EVERY == 0)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs, LANGUAGE_FOLDS, LANGUAGE_FOLD)
    fold = held_out("doc_id", LANGUAGE_FOLDS, LANGUAGE_FOLD).alias("held_out")
    return language_id.identify(docs.select("doc_id", "text"), model).select("doc_id", fold, "lang_pred", "score")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    paths = public_tokenizers.path(BYTE_FILE), public_tokenizers.PATTERN, public_tokenizers.path(PIECE_FILE)
    return tokenizer_alignment.summarize(docs, *paths)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_fm, op2_decontaminate, op3_toxicity_zstd, op4_shards, op5_html_text,
        op6_bpe, op7_warc, op8_embedding_dups, op9_simhash, op10_licenses,
        op11_hard_negatives, op12_language_id, op13_tokenizer_alignment,
    )
}
