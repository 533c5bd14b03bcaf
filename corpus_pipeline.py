"""A training corpus from raw documents: filter, deduplicate, mix and pack, one written stage after another."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.llm import mixing, packing, simhash, suffix_dedup, toxicity
from stockcast.llm.queries import vocabulary
from stockcast.session import recorded_stages, remove_stages, send_texts_in_small_batches, shared_dir
from stockcast.sources.panel import table


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
_left: list[str] = []  # folders of the working tables that the last stage has written


def stage(made: Stage) -> Stage:
    """A stage that first removes the working tables of the stage before it, whose result is written by then.

    From the first stage on, the session sends its rows to Python workers in small batches.
    """
    @wraps(made)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        send_texts_in_small_batches(spark)
        remove_stages(spark, _left)
        _left.clear()
        with recorded_stages() as own:
            try:
                return made(spark, docs, sf_dir)
            finally:
                _left.extend(own)

    return run_stage


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that boosted trees, learned from ``labels``, do not call toxic."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.one_per_group(docs)


@stage
def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that an earlier one has; ``n_chars`` follows the text."""
    cut = suffix_dedup.without_repeats(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    return mixing.mix_documents(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of binary lengths."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("source_mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A learned filter and XXH64 fingerprints have no SQL; tests run brute-force versions of all stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/corpus-{uuid.uuid4().hex}"
    for name, function in STAGES:
        made = function(spark, docs, sf_dir)
        made.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(made.schema).parquet(f"{folder}/{name}")
    return docs
