"""The corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept. All
but the last return the columns they got.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textprep.llm import exact_dedup, jaccard_join, mixing, packing, quality_rules
from textprep.llm.columns import table
from textprep.session import stage


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that the quality rules reject."""
    return quality_rules.keep_good(docs)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return exact_dedup.keep_first(docs)


def dissimilar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by five-word shingles at 0.8 or more."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", good_documents),
    ("exact dedup", distinct_documents),
    ("n-gram Jaccard join", dissimilar_documents),
    ("mixing", mixed_documents),
    ("best-fit packing", packed_sequences),
]

# SQL has no tokenizer; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
