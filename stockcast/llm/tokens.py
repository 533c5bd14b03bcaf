"""Token counts of a piece model by a two-tier lookup on the map side, without shuffling any pre-token.

A pre-token is a run of spaces with the word behind it, or a line break with the word behind it. The
model merges nothing across such borders, so counts of pre-tokens add up to the count of the text. A
first pass finds the frequent ones: tasks keep bounded summaries (Misra-Gries), which are merged in a
tree. Their lengths form a compact table that is broadcast. A second pass looks every pre-token up,
there or in the worker's own bounded cache, and encodes only what neither holds. The table decides
speed alone; counts are exact whatever it holds.
"""

from __future__ import annotations

import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from stockcast.llm.worker import keep

TABLE_SIZE = 16_384    # pre-tokens in the broadcast table, and in a summary
CACHE_SIZE = 400_000   # pre-tokens a worker adds to it before it starts anew
CACHED_CHARS = 64      # longer pre-tokens are encoded each time
FAN_IN = 16            # summaries merged by one task
SPACE = "▁"
UNITS = re.compile(f"[ {SPACE}]*[^ {SPACE}\n]+|\n[^ {SPACE}\n]*|[ {SPACE}]+")


def keys_of(text: str) -> list[str]:
    """Pre-tokens of a text that is not empty, as lookup keys.

    A key is what the processor must be given: it puts one space in front by itself, so a run of
    spaces loses one. Keys with a line break in front are counted without that space.
    """
    text = " " + text
    if "  " not in text and " \n" not in text and SPACE not in text and text[-1] != " ":
        return text.replace("\n", " \n").split(" ")[1:]
    return [u if u[0] == "\n" else u[1:] for u in UNITS.findall(text)]


class PieceLengths(dict):
    """Token counts by key: a fixed table first, then what this worker has encoded itself."""

    def __init__(self, model_path: str, table: dict[str, int], cache_size: int = CACHE_SIZE):
        super().__init__(table)
        self.table, self.most = table, len(table) + cache_size
        self.processor = sentencepiece.SentencePieceProcessor(model_file=model_path)

    def __missing__(self, key: str) -> int:
        n = len(self.processor.encode(key)) - 1 if key[:1] == "\n" else len(self.processor.encode(key)) if key else 1
        if len(key) <= CACHED_CHARS:
            if len(self) >= self.most:
                self.clear()
                self.update(self.table)
            self[key] = n
        return n

    def count(self, text: str) -> int:
        return sum(map(self.__getitem__, keys_of(text))) if text else 0


def worker_lengths(model_path: str, ticket: str, packed: tuple[bytes, bytes]) -> PieceLengths:
    """This worker's lookup for the broadcast table named ``ticket``."""
    def make() -> PieceLengths:
        words = packed[0].decode().split(" ") if packed[0] else []
        return PieceLengths(model_path, dict(zip(words, np.frombuffer(packed[1], "<u2").tolist())))

    return keep(("pieces", model_path, ticket), make)


def trim(counts: Counter, size: int) -> Counter:
    """At most ``size`` keys, less what the first one left out has (Misra-Gries)."""
    if len(counts) <= size:
        return counts
    top = counts.most_common(size + 1)
    least = top[-1][1]
    return Counter({k: n - least for k, n in top[:-1] if n > least})


def _pack(counts: Counter) -> tuple[bytes, bytes]:
    return " ".join(counts).encode(), np.array(list(counts.values()), dtype="<i8").tobytes()


def _unpack(words: bytes, counts: bytes) -> Counter:
    return Counter(dict(zip(words.decode().split(" "), np.frombuffer(counts, "<i8").tolist()))) if counts else Counter()


def frequent_keys(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """The most frequent short keys of all texts, up to the error of the summaries, most frequent first.

    Only summaries of at most ``size`` keys move: one per task, then one per ``FAN_IN`` of them.
    """
    schema = "place long, words binary, counts binary"

    def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                if value := text.as_py():
                    counts.update(keys_of(value))
                    if len(counts) > 8 * size:
                        counts = trim(counts, size)
        short = Counter({k: n for k, n in counts.items() if len(k) <= CACHED_CHARS and k and " " not in k})
        yield pa.RecordBatch.from_pylist([dict(zip(
            ("place", "words", "counts"), (TaskContext.get().partitionId(), *_pack(trim(short, size)))))],
            pa.schema([("place", pa.int64()), ("words", pa.binary()), ("counts", pa.binary())]))

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        total: Counter = Counter()
        for words, counts in zip(rows["words"], rows["counts"]):
            total.update(_unpack(words, counts))
        return pd.DataFrame([[rows["place"].iloc[0] // FAN_IN, *_pack(trim(total, size))]], columns=["place", "words", "counts"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    level, n = texts.mapInArrow(summaries, schema), texts.rdd.getNumPartitions()
    while n > 1:
        level = level.groupBy(F.floor(F.col("place") / FAN_IN).alias("group")).applyInPandas(merged, schema)
        n = -(-n // FAN_IN)
    return [k for row in level.collect() for k, _ in _unpack(row["words"], row["counts"]).most_common()]


def count_tokens(docs: DataFrame, model_path: str, table_size: int = TABLE_SIZE, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every row.

    Counts are those of the model's own library over whole texts, without begin or end. Null texts
    count as empty ones (0 tokens); repeated rows are counted each; extra columns are ignored.
    """
    spark = docs.sparkSession
    lengths = PieceLengths(model_path, {})
    table = {k: lengths[k] for k in frequent_keys(docs, table_size)}
    packed = " ".join(table).encode(), np.array(list(table.values()), dtype="<u2").tobytes()
    shared = spark.sparkContext.broadcast(packed)
    ticket = uuid.uuid4().hex

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = worker_lengths(model_path, ticket, shared.value)
        for batch in batches:
            counts = pa.array([lookup.count(t.as_py() or "") for t in batch.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), counts], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInArrow(counted, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit)
