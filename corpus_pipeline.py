"""The corpus pipeline: quality rules, near duplicates, decontamination, personal data, packing.

Every stage works on all rows its predecessor kept and is written as Parquet before the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slackline.llm import decontamination, jaccard, packing, pii, quality
from slackline.llm.queries import table, tokenizer
from slackline.session import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that a rule rejects go."""
    return quality.keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every class of near duplicates the row with the smallest id stays."""
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold a benchmark item go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` becomes the new length."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all rows with their places in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer())


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("PII", personal_data),
    ("best-fit packing", packed),
]

# Boosted trees, MinHash and the tokenizer are beyond SQL; tests compare the rows with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
