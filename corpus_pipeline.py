"""A pipeline over ``documents`` from five of the training-data operators, one after another.

Each stage works on all that its predecessor kept and, but for the last, returns the columns it was given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from threatsieve.llm import decontamination, pieces, quality, simhash, surrogates


def good_only(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones, does not reject."""
    model = quality.fit_on(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: fingerprints of three-word shingles that differ in at most three bits."""
    return simhash.one_per_group(docs, distance=3, words_per_shingle=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def private_replaced(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data under the session's key."""
    return surrogates.with_surrogates(docs, surrogates.key_of(spark))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document, with what was checked on the way."""
    return pieces.summary(docs, with_ids=True)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_only),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontaminated),
    ("pii_surrogates", private_replaced),
    ("sentencepiece_encoding", encoded),
]
# SQL cannot state the classifier, the fingerprints or the pieces; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``, each on what the one before it kept."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
