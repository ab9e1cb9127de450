"""A corpus pipeline of five stages, each an operator over all that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataroll.llm import decontamination, mixing, quality, secret_scan, simhash
from strataroll.llm.common import saved, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def no_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item is found."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def no_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in their texts redacted."""
    return secret_scan.redact_secrets(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes of each document."""
    return mixing.mix_documents(docs)


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", no_near_duplicates),
    ("decontamination", no_benchmark),
    ("secrets", no_secrets),
    ("mix", mixed),
]
#: The stages learn, hash and align: SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
