"""The corpus pipeline: quality rules, exact and near-duplicate removal, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that its predecessor kept.  All
but the last return the columns of ``documents``, with changed texts in place of the old ones.
The stages handle nulls, empty texts, repeated rows and further columns as their operators say.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from farelens.llm import exact, minhash, packing, quality, substrings
from farelens.session import scratch_path, tune


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Failing lines go, and so do documents that lose too much or fail the base rules."""
    return quality.clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space one stays."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the smallest id stays."""
    return minhash.drop_near_copies(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words go that a window of 13 covers which a smaller id has too."""
    return substrings.remove(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 4096 tokens, one row per piece."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_rules", quality_rules), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup), ("packing", pack),
]

# Packing needs a tokenizer, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each one's rows written and read again."""
    docs = tune(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
