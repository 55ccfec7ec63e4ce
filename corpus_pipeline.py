"""Corpus pipeline: each stage works on all that its predecessor kept.

Null, empty and very long texts, ties, repeated rows, empty tables and extra columns have the results that
the stages' operators state; no stage drops a row for any of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexflume.llm import bpe, exact_dedup, minhash, mixing, queries, toxicity
from lexflume.session import hand_small_batches, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of being toxic at any grade is below one half."""
    hand_small_batches(spark)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def without_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.drop_exact_duplicates(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, Jaccard 0.8 or more."""
    return minhash.drop_near_duplicates(docs, width=5, percent=80)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their fitted rates say; the classifier is taught by the labelled table."""
    return mixing.mixed(docs, queries.fitted_domains(spark, sf_dir), queries.DOMAIN_WEIGHTS)


def as_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of every document."""
    hand_small_batches(spark)
    return bpe.round_trip(docs, queries.vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", without_toxic),
    ("exact dedup", without_exact_copies),
    ("near dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", as_tokens),
]

# Trained models and sketches take part in the result, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name.replace(" ", "-"))
    return docs
