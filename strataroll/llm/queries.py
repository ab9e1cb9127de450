"""Registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataroll.llm import (
    byte_pairs,
    decontamination,
    divergence,
    hard_negatives,
    mixing,
    personal_data,
    quality,
    secret_scan,
    simhash,
    substring_dedup,
    token_counts,
    top_k,
    warc,
)
from strataroll.llm.common import saved, scratch, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "warc")
    warc.write_captures(table(spark, sf_dir, "pages"), path)
    records = saved(warc.read_records(spark, path, with_payload=False), "warc-records")
    return warc.capture_digests(warc.assemble(records))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), digest=True)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(table(spark, sf_dir, "documents"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op5_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k.top_k(table(spark, sf_dir, "embeddings"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontamination.find_benchmark(docs, benchmark)


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path("piece_bpe_32k.model"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from public_tokenizers import path

    vocabulary = byte_pairs.read_vocabulary(path("byte_bpe_50k.json"))
    encoded = byte_pairs.encode(table(spark, sf_dir, "documents"), vocabulary)
    decoded = byte_pairs.decode(encoded, vocabulary)
    return decoded.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows.withColumn("label", relabelled))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc,
        op2_substring_dedup,
        op3_simhash,
        op4_source_mix,
        op5_top_k,
        op6_secret_scan,
        op7_decontamination,
        op8_personal_data,
        op9_token_counts,
        op10_quality,
        op11_byte_pairs,
        op12_hard_negatives,
        op13_divergence,
    )
}
ORACLES: dict[str, str] = {
    "op5_top_k": top_k.TOP_K_SQL,
    "op12_hard_negatives": hard_negatives.MINE_SQL,
    "op13_divergence": divergence.AUDIT_SQL,
}
