"""Corpus pipeline: documents in a known language, one of each near-duplicate
group, free of benchmark text, mixed to the source weights, and placed in
shards. Every stage is written as Parquet and read again before the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sluice.llm.common import materialize, table
from sluice.llm.decontaminate import clean_documents
from sluice.llm.hilbert import hilbert_shards
from sluice.llm.langid import known_language
from sluice.llm.mixing import mixed_documents
from sluice.llm.simhash import one_of_each


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, or in no learned language, go."""
    return known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SimHash: the document with the smallest id of each component stays."""
    return one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark window go."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are repeated or left out so that sources meet their targets."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document of the mix."""
    return hilbert_shards(docs)


STAGES = [
    ("language ID", language),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixing),
    ("sharding", sharding),
]

# Language identification (and the Hilbert order) have no SQL form; tests/llm
# holds the whole run against a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
