"""Removal of lines that an earlier document has, found by two Bloom filters.

The filters have a word of 64 bits for every few lines and are cut into shards by word number. A batch of
documents adds each of its distinct line keys once: a key whose bits the once-seen filter already covers is
added to the twice-seen filter too. Keys that the twice-seen filter covers are suspects; only those leave their
batch as text, one row per batch and key, for the exact count of documents and the choice of the first one. What
is confirmed goes back to the batches that hold it. All other lines never move, and no filter is broadcast.

Documents are written once, where they are read, in batch files in the shared folder.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import xxhash
from pyspark.sql import DataFrame, functions as F

from stockcast.session import note_stage, shared_dir, write_stage

MIN_CHARS = 10            # code points of a key that may repeat
BATCH_BYTES = 16 << 20    # text of a batch file
SHARD_KEYS = 1 << 20      # keys a shard of the filters aims at
BITS_PER_LINE = 16
SPACE = b" \t\n\x0b\x0c\r"  # fixed values
LAST_ID = (1 << 63) - 1   # documents without id count as one, after all others
SEED = 13


def line_keys(text: bytes, min_chars: int = MIN_CHARS) -> list[bytes | None]:
    """The key of every line: ends stripped, A-Z lower-cased; None where it is too short to repeat."""
    return [k if is_long(k, min_chars) else None for k in (line.strip(SPACE).lower() for line in text.split(b"\n"))]


def is_long(key: bytes, min_chars: int) -> bool:
    if len(key) < min_chars or len(key) >= 4 * min_chars or key.isascii():
        return len(key) >= min_chars
    return len(key.decode("utf-8", "replace")) >= min_chars


def filter_words(hashed: np.ndarray, n_blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Word number and bits (up to four) of every hash; ``n_blocks`` is a power of two of at most 2^40."""
    word = np.zeros(len(hashed), np.uint64)
    for shift in (40, 46, 52, 58):
        word |= np.uint64(1) << ((hashed >> np.uint64(shift)) & np.uint64(63))
    return hashed & np.uint64(n_blocks - 1), word


def marks(hashed: np.ndarray, n_blocks: int) -> np.ndarray:
    """One number for word number and bits together; equal pairs have equal marks."""
    block, word = filter_words(hashed, n_blocks)
    return block * np.uint64(0x9E3779B97F4A7C15) ^ word * np.uint64(0xC2B2AE3D27D4EB4F)


def suspected(block: np.ndarray, word: np.ndarray, again: np.ndarray, first_block: int, n_blocks: int, step: int = 1 << 16) -> np.ndarray:
    """Which keys the twice-seen filter covers once all are added; every batch gives a key once.

    ``again`` marks keys that several documents of their batch have.
    """
    once, twice = np.zeros(n_blocks, np.uint64), np.zeros(n_blocks, np.uint64)
    at = (block - np.uint64(first_block)).astype(np.int64)
    for low in range(0, len(at), step):
        a, w = at[low:low + step], word[low:low + step]
        order = np.lexsort((w, a))
        same = (np.diff(a[order]) == 0) & (np.diff(w[order].view(np.int64)) == 0)
        seen = again[low:low + step] | ((once[a] & w) == w)
        seen[order[1:][same]] = True
        np.bitwise_or.at(once, a, w)
        np.bitwise_or.at(twice, a[seen], w[seen])
    return (twice[at] & word) == word


def _write_batches(docs: DataFrame, folder: str, batch_bytes: int) -> DataFrame:
    """Write the rows of ``docs`` to batch files; (batch, n_lines) of each, written as a table."""
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        held, size, lines = [], 0, 0

        def flush() -> pa.RecordBatch:
            number = uuid.uuid4().int >> 65
            whole = pa.Table.from_batches(held)
            with store.open_output_stream(f"{root}/{number}", compression=None) as sink:
                with pa.ipc.new_stream(sink, whole.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_table(whole)
            return pa.RecordBatch.from_pydict({"batch": pa.array([number], pa.int64()), "n_lines": pa.array([lines], pa.int64())})

        for batch in batches:
            text = batch.column("__bytes")
            sizes = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            breaks = pc.fill_null(pc.count_substring(text, "\n"), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[at:]), batch_bytes - size)) + 1
                held.append(batch.slice(at, fits))
                size += int(sizes[at:at + fits].sum())
                lines += int(breaks[at:at + fits].sum()) + len(sizes[at:at + fits])
                at += fits
                if size >= batch_bytes:
                    yield flush()
                    held, size, lines = [], 0, 0
        if held:
            yield flush()

    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    note_stage(folder)
    return write_stage(docs.mapInArrow(write, "batch long, n_lines long"), "line-batches")


def _open(folder: str, number: int) -> pa.Table:
    store, root = pafs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{number}", compression=None) as f:
        return pa.ipc.open_stream(pa.py_buffer(f.read())).read_all()


def _documents(whole: pa.Table) -> Iterator[tuple[int, bytes]]:
    """Id (``LAST_ID`` for none) and text of every row of a batch file."""
    for part in whole.to_batches(max_chunksize=1_000):
        for doc_id, text in zip(part.column("__id").to_pylist(), part.column("__bytes").to_pylist()):
            yield LAST_ID if doc_id is None else doc_id, text or b""


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.Table]]:
    """Rows of one batch number after another, from rows sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        number = batch.column("batch").to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)]
        for low, high in zip(bounds, bounds[1:]):
            part = batch.slice(low, high - low)
            if held and held[0].column("batch")[0] != part.column("batch")[0]:
                yield held[0].column("batch")[0].as_py(), pa.Table.from_batches(held)
                held = []
            if high > low:
                held.append(part)
    if held:
        yield held[0].column("batch")[0].as_py(), pa.Table.from_batches(held)


def repeated_keys(files: DataFrame, folder: str, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS) -> DataFrame:
    """(batch, key, first) for every batch file and key that one of its documents has after document ``first``."""
    n_files, n_lines = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_lines"), F.lit(0))).first()
    tasks, n_shards = max(1, n_files), max(1, 1 << math.ceil(math.log2(max(1, n_lines) / shard_keys)) if n_lines > shard_keys else 1)
    n_blocks = max(n_shards, 1 << math.ceil(math.log2(max(1, n_lines * BITS_PER_LINE // 64))))
    own_blocks = n_blocks // n_shards
    listed = files.select("batch")

    def once_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number in batch.column("batch").to_pylist():
                seen: dict[bytes, int] = {}
                again: set[bytes] = set()
                for doc_id, text in _documents(_open(folder, number)):
                    for key in set(line_keys(text, min_chars)):
                        if key is not None and seen.setdefault(key, doc_id) != doc_id:
                            again.add(key)
                hashed = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in seen), np.uint64, len(seen))
                block, word = filter_words(hashed, n_blocks)
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array(np.full(len(seen), number, np.int64)),
                    "shard": pa.array((block // np.uint64(own_blocks)).astype(np.int32)),
                    "hash": pa.array(hashed.view(np.int64)),
                    "again": pa.array(np.fromiter((k in again for k in seen), bool, len(seen)))})

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [(b.column("batch").to_numpy(), b.column("hash").to_numpy().view(np.uint64), b.column("again").to_numpy(zero_copy_only=False))
                for b in batches if b.num_rows]
        if not held:
            return
        batch, hashed, again = (np.concatenate(c) for c in zip(*held))
        block, word = filter_words(hashed, n_blocks)
        first = int(block[0]) // own_blocks * own_blocks
        hit = suspected(block, word, again, first, own_blocks)
        yield pa.RecordBatch.from_pydict({"batch": pa.array(batch[hit]), "mark": pa.array(marks(hashed[hit], n_blocks).view(np.int64))})

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _grouped(batches):
            wanted = np.unique(rows.column("mark").to_numpy().view(np.uint64))
            first: dict[bytes, int] = {}
            last: dict[bytes, int] = {}
            for doc_id, text in _documents(_open(folder, number)):
                for key in set(line_keys(text, min_chars)):
                    if key is not None:
                        if first.setdefault(key, doc_id) > doc_id:
                            first[key] = doc_id
                        if last.setdefault(key, doc_id) < doc_id:
                            last[key] = doc_id
            hashed = np.fromiter((xxhash.xxh64_intdigest(k, SEED) for k in first), np.uint64, len(first))
            held = [key for key, hit in zip(first, np.isin(marks(hashed, n_blocks), wanted).tolist()) if hit]
            for part in range(0, len(held), 10_000):
                chosen = held[part:part + 10_000]
                yield pa.RecordBatch.from_pydict({
                    "batch": pa.array(np.full(len(chosen), number, np.int64)), "key": pa.array(chosen, pa.binary()),
                    "first": pa.array([first[k] for k in chosen], pa.int64()), "last": pa.array([last[k] for k in chosen], pa.int64())})

    added = listed.repartition(tasks).mapInArrow(once_per_batch, "batch long, shard int, hash long, again boolean")
    covered = added.repartitionById(n_shards, F.col("shard")).mapInArrow(cover, "batch long, mark long")
    seen = write_stage(
        covered.repartition(tasks, "batch").sortWithinPartitions("batch").mapInArrow(suspects, "batch long, key binary, first long, last long"),
        "suspects")
    confirmed = seen.groupBy("key").agg(F.min("first").alias("first"), F.max("last").alias("__last")).where("first < __last")
    return seen.select("batch", "key", "last").join(confirmed, "key").where("last > first").select("batch", "key", "first")


def _cut(docs: DataFrame, finish: Callable[[pa.RecordBatch, list[bytes], list[int], list[int]], pa.RecordBatch], schema: object,
         min_chars: int, shard_keys: int, batch_bytes: int) -> DataFrame:
    """Apply ``finish`` to rows, what is left of their texts, and their numbers of lines and of dropped lines."""
    folder = f"{shared_dir(docs.sparkSession).rstrip('/')}/lines-{uuid.uuid4().hex}"
    files = _write_batches(docs, folder, batch_bytes)
    tasks = max(1, files.count())
    found = repeated_keys(files, folder, min_chars, shard_keys)
    listed = files.select("batch", F.lit(None).cast("binary").alias("key"), F.lit(None).cast("long").alias("first"))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in _grouped(batches):
            first = dict(zip(rows.column("key").to_pylist(), rows.column("first").to_pylist()))
            first.pop(None, None)
            whole = _open(folder, number)
            for part in whole.to_batches(max_chunksize=1_000):
                texts, n_lines, n_dropped = [], [], []
                for doc_id, text in _documents(pa.Table.from_batches([part])):
                    keys = line_keys(text, min_chars)
                    gone = [k is not None and first.get(k, doc_id) < doc_id for k in keys] if first else []
                    dropped = sum(gone)
                    texts.append(b"\n".join(line for line, g in zip(text.split(b"\n"), gone) if not g) if dropped else text)
                    n_lines.append(len(keys))
                    n_dropped.append(dropped)
                yield finish(part, texts, n_lines, n_dropped)

    return found.unionByName(listed).repartition(tasks, "batch").sortWithinPartitions("batch").mapInArrow(apply, schema)


def line_report(docs: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """doc_id, n_lines (before), n_dropped and the text that is left of every row.

    A line goes if its key has ``min_chars`` code points or more and a document with a smaller doc_id holds it;
    the smallest keeps all its lines. Null and empty texts are one empty line, and what is left of a null text is
    empty. Rows with equal ids are one document; rows without id are one document after all others. Only
    ``doc_id`` and ``text`` are read. An empty table gives an empty one.
    """
    def report(part: pa.RecordBatch, texts: list[bytes], n_lines: list[int], n_dropped: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "doc_id": part.column("__id"), "n_lines": pa.array(n_lines, pa.int64()), "n_dropped": pa.array(n_dropped, pa.int64()),
            "text": pa.array(texts, pa.binary()).cast(pa.string())})

    rows = docs.select(F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").cast("binary").alias("__bytes"))
    return _cut(rows, report, "doc_id long, n_lines long, n_dropped long, text string", min_chars, shard_keys, batch_bytes)


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, shard_keys: int = SHARD_KEYS, batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, with repeated lines cut from ``text``; see ``line_report``. Null texts stay null."""
    names = docs.columns
    rows = docs.select(
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != "text"],  # own names, so that none clashes
        F.col("doc_id").cast("long").alias("__id"), F.col("text").cast("string").cast("binary").alias("__bytes"))

    def rewrite(part: pa.RecordBatch, texts: list[bytes], n_lines: list[int], n_dropped: list[int]) -> pa.RecordBatch:
        known = part.column("__bytes").is_valid().to_pylist()
        left = pa.array([t if k else None for t, k in zip(texts, known)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([left if c == "text" else part.column(f"c{i}") for i, c in enumerate(names)], names)

    return _cut(rows, rewrite, docs.schema, min_chars, shard_keys, batch_bytes)
