"""A training corpus from raw documents, stage by stage.

Each stage reads what the one before it kept, written as Parquet below the
shared folder, and returns the columns of ``documents``; the last returns the
packed sequences."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortlens.llm import decontaminate, exact_dedup, language_id, near_dedup, packing
from cohortlens.llm.common import prepare, read, stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    prepare(spark)
    return language_id.known_languages(docs)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts: the one with the smallest id."""
    prepare(spark)
    return exact_dedup.without_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, 0.8)."""
    prepare(spark)
    return near_dedup.without_near_copies(docs, shingle=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return decontaminate.without_leaks(docs, read(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens."""
    prepare(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("packing", pack),
]

#: A learnt classifier and a tokenizer are beyond SQL; tests/llm checks the
#: pipeline against a version without Spark.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
