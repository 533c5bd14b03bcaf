"""Sharding by proportional stratified interleaving, with DataFrame operations only.

Rows of a source are shuffled by a seeded hash and ranked; all sources are then merged along their
fractional ranks, so every stretch of the merged order holds each source in its global share. Shards
are equal stretches: row counts differ by at most one, and a source's count by at most two from its share.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from stockcast.llm.order import BUCKET_ROWS, bucket_bits, hash_bucket, unit_interval, with_positions
from stockcast.session import write_stage

SEED = 42


def stratum(source: Column) -> list[Column]:
    """A nullable source as two columns that are never null; null is a stratum of its own."""
    return [source.isNull().alias("__none"), F.coalesce(source, F.lit("")).alias("__source")]


def shard_rows(rows: DataFrame, n_shards: int = 8, seed: int = SEED, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Deal narrow rows (doc_id, source and whatever else) to shards; adds ``shard`` and ``slot``.

    Every column takes part in the shuffle hash, so the outcome depends on the rows alone, not on
    their order or partitioning. Rows that agree in every column are interchangeable. Null sources
    form one stratum; null ids are values like any other. An empty table gives an empty result.
    """
    names = rows.columns
    hashed = F.xxhash64(F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("\0none")) for c in names])
    staged = write_stage(rows.select("*", *stratum(F.col("source")), hashed.alias("__hash")), "shard-rows")
    total = staged.count()
    bits = bucket_bits(total, bucket_rows)
    ranked = with_positions(
        staged.withColumn("__bucket", hash_bucket(F.col("__hash"), bits)),
        ["__none", "__source"], "__bucket", ["__hash", *names])
    phase = unit_interval(F.xxhash64(F.lit(seed + 1), "__none", "__source"))
    share = (F.col("position") + phase) / F.col("group_rows")
    stretches = max(1, math.ceil(total / bucket_rows))
    merged = write_stage(
        ranked.withColumn("__share", share).drop("__bucket", "position", "group_rows")
        .withColumn("__stretch", F.floor(F.col("__share") * stretches)), "shard-ranks")
    placed = with_positions(merged, [], "__stretch", ["__share", "__none", "__source", "__hash", *names])
    shard = F.expr(f"(position * {n_shards}) div {max(1, total)}").cast("int")
    start = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("position") - start).select(*names, "shard", "slot")


def shard_documents(docs: DataFrame, n_shards: int = 8, seed: int = SEED) -> DataFrame:
    """doc_id, size (UTF-8 bytes plus one; null text: 1), text_crc32, shard and slot of every document.

    Only numbers are shuffled, never texts. Extra columns of ``docs`` are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    return shard_rows(rows, n_shards, seed)
