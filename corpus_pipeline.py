"""A corpus through five stages: toxicity, exact and near duplicates, mixing, encoding.

Each stage is written to the shared folder and read again, so a lost executor costs a part of
one stage. Every stage works on all that the one before it kept and returns the
columns of documents, the last one also the token ids.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mercatura.llm import bpe, exact_dedup, mixing, near_dedup, toxicity
from mercatura.llm.common import documents
from mercatura.session import staged_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, fitted on the labels, does not reject."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.learn(docs, labels))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: that of the largest doc_id."""
    return exact_dedup.keep_one(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest doc_id, of each group linked by a similarity of 0.8 or
    more between sets of five-word shingles."""
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn to the sources' target weights, repeated by epoch where needed."""
    return mixing.draw(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents and the token ids of their texts."""
    return bpe.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", clean),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("mixing", mixed),
    ("bpe", encoded),
]

# Compression lengths have no SQL form; tests compare every stage with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = staged_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
