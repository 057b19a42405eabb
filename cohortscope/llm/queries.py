"""Registered queries of the operators: each applies one of them to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortscope.llm import (
    bpe,
    centroids,
    decontamination,
    minhash,
    packing,
    pii,
    quality,
    quotations,
    ranked,
    sharding,
    suffixes,
    toxicity,
    wordpiece,
)

SHARDS = 40


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_quotations(spark: SparkSession, sf: str) -> DataFrame:
    """The chats hold no quotes, so they are first written as mails that quote what they answer."""
    return quotations.conversations(quotations.quoting(_table(spark, sf, "conversations")))


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    return pii.replace(docs.select("doc_id", "text"))


def op3_minhash(spark: SparkSession, sf: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf, "documents"), size=4, percent=80)


def op4_byte_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.digests(_table(spark, sf, "documents"))


def op5_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op6_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return quality.verdicts(_table(spark, sf, "documents"))


def op7_wordpiece_counts(spark: SparkSession, sf: str) -> DataFrame:
    return wordpiece.token_counts(_table(spark, sf, "documents"))


def op8_suffix_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return suffixes.remove_repeats(_table(spark, sf, "documents")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard(_table(spark, sf, "documents"), SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    scores = toxicity.score(docs, toxicity.train(docs, _table(spark, sf, "labels")))
    return scores.select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_packing(spark: SparkSession, sf: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf, "documents"))
    return packing.pack(cut.withColumn("ids_crc32", F.crc32("ids")).drop("ids")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op12_ranked_search(spark: SparkSession, sf: str) -> DataFrame:
    return ranked.search(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op13_centroids(spark: SparkSession, sf: str) -> DataFrame:
    return centroids.cluster(_table(spark, sf, "embeddings")).drop("steps")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quotations": op1_quotations,
    "op2_pii": op2_pii,
    "op3_minhash": op3_minhash,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_decontamination": op5_decontamination,
    "op6_divergence": op6_divergence,
    "op7_wordpiece_counts": op7_wordpiece_counts,
    "op8_suffix_dedup": op8_suffix_dedup,
    "op9_sharding": op9_sharding,
    "op10_toxicity": op10_toxicity,
    "op11_packing": op11_packing,
    "op12_ranked_search": op12_ranked_search,
    "op13_centroids": op13_centroids,
}
