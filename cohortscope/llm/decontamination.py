"""Benchmark decontamination by spaced seeds.

A mask picks some of the tokens in a short window and ignores the others, so two texts that differ in an ignored
token still meet. The picked tokens are hashed at every position of both sides; equal hashes are hits, and each
hit is verified on the tokens around it. All of it is SQL expressions; only hits leave the scan of the documents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortscope.llm.shared import land, let

#: Windows of tokens: 1 is hashed, 0 is ignored.
MASKS = ("1101011", "11100101", "10110011")
SPAN = max(map(len, MASKS))
#: Tokens of an overlap that are compared, or all of a shorter item, and the share of them that must be equal.
OVERLAP = 20
MIN_EQUAL_PERCENT = 80
#: Seeds of the benchmark up to which they are broadcast (16 bytes each); more are joined by a shuffle.
MAX_BROADCAST_SEEDS = 2_000_000


def tokens(text: Column) -> Column:
    """Hashes of the lower-cased runs of letters and digits."""
    runs = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}\\p{N}]+"), "")
    return F.transform(runs, lambda run: F.xxhash64(run))


def _seeds(frame: DataFrame, key: str) -> DataFrame:
    """The key, each position as `at` and, for each mask, the hash of the tokens it picks there as `seed`.

    Rows hold the few tokens of one window only, never the whole text, and are hashed in generated code.
    """
    size = F.size("tokens")
    shifted = [F.slice("tokens", F.lit(k + 1), F.greatest(size - k, F.lit(0))).alias(f"t{k}") for k in range(SPAN)]
    windows = frame.select(key, F.posexplode(F.arrays_zip(*shifted)).alias("at", "window"))
    hashes = [
        F.when(F.col(f"window.t{len(mask) - 1}").isNotNull(), F.xxhash64(
            F.lit(number), *[F.col(f"window.t{k}") for k, bit in enumerate(mask) if bit == "1"]))
        for number, mask in enumerate(MASKS)
    ]
    return windows.select(key, "at", F.explode(F.array(*hashes)).alias("seed")).where("seed IS NOT NULL")


def _equal_tokens() -> Column:
    """The most equal tokens in an aligned window of OVERLAP tokens, or of the whole item if it is shorter."""
    length = F.least(F.size("item_tokens"), F.lit(OVERLAP))
    equal = F.transform("item_tokens", lambda token, x: F.coalesce(
        (F.when(x + F.col("shift") >= 0, F.get("tokens", x + F.col("shift"))) == token).cast("int"), F.lit(0)))

    def sums(own: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(own) - length + 1)
        return F.transform(starts, lambda x: F.aggregate(F.slice(own, x, length), F.lit(0), lambda a, b: a + b))

    return let(equal, lambda own: F.array_max(sums(own)))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document that holds most of a benchmark item or of a long run of one.

    Returns doc_id, n_items (distinct items found), first_item (the smallest of their ids) and equal_percent (of
    the best window). Items of fewer tokens than the shortest mask prove nothing and are skipped, as are null
    texts; rows with the same doc_id are one document. An empty benchmark contaminates nothing.
    """
    items = benchmark.select("item_id", tokens(F.col("text")).alias("tokens"))
    read = docs.select("doc_id", tokens(F.col("text")).alias("tokens"))
    seeds = _seeds(items, "item_id").withColumnRenamed("at", "item_at")
    if seeds.count() <= MAX_BROADCAST_SEEDS:
        seeds = F.broadcast(seeds)
    # Hits of one alignment of a document and an item are one row before they are shuffled.
    hits = land(
        _seeds(read, "doc_id").join(seeds, "seed")
        .select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct(),
        "decontamination_hits",
    )
    found = read.join(hits.select("doc_id").distinct(), "doc_id", "left_semi").join(hits, "doc_id").join(
        items.withColumnRenamed("tokens", "item_tokens"), "item_id")
    length = F.least(F.size("item_tokens"), F.lit(OVERLAP))
    verified = found.select("doc_id", "item_id", F.floor(100 * _equal_tokens() / length).cast("int").alias("percent"))
    by_item = verified.where(F.col("percent") >= MIN_EQUAL_PERCENT).groupBy("doc_id", "item_id").agg(
        F.max("percent").alias("percent"))
    return by_item.groupBy("doc_id").agg(
        F.count("*").alias("n_items"), F.min("item_id").alias("first_item"), F.max("percent").alias("equal_percent"))


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, with all their columns, that hold no benchmark item. A null doc_id is kept."""
    leaks = land(contaminated(docs, benchmark).select("doc_id"), "contaminated")
    return docs.join(leaks, "doc_id", "left_anti")
