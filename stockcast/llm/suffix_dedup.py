"""Removal of byte strings that occur in an earlier document, by external suffix sorting in shards.

Every window of 50 bytes is assigned to the least hash of its 16-byte grams, so equal windows share
that value wherever they stand. Neighbouring windows with one value form a segment. A value that
occurs in a single document cannot match across documents; segments of all other values go to the
shard of their value, where an induced sort (``induced_sort``) orders their suffixes with common-prefix
lengths. Suffixes that agree in 50 bytes are one class, and its smallest document keeps the string.

A passage that many documents share has other bytes around it in each of them, so its first and last
values can have as many distinct segments as there are documents. Values with more bytes of distinct
segments than a task should get are split: their windows go by the hash of the whole window instead.
Equal windows still meet, and windows of one document only are dropped like other values.

Documents are written once, where they are read, in batch files in the shared folder. Between the
steps only value lists, bitmaps, distinct segments of a batch and verdicts move; a passage that many
documents share is sent once per batch, and its verdict comes back once per batch. No text is shuffled.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from stockcast.llm.induced_sort import MEMORY, suffixes
from stockcast.llm.worker import let_go
from stockcast.session import note_stage, shared_dir, write_stage

WINDOW = 50
GRAM = 16
BATCH_BYTES = 4 << 20    # text of a batch file
SHARD_BYTES = 4 << 20    # text per shard of values (its repeated segments are a part of that)
HOT_SHARE = 4            # a value with more than a shard's bytes through this, of distinct segments, is split
RUN = 64                 # windows of a segment of a split value (only equal windows in a row share one)
LAST_ID = (1 << 63) - 1  # documents without id come last
BLOCK = 1 << 15          # windows hashed at once, so that their arrays stay in a core's cache
_TABLE = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def gram_blocks(text: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> Iterator[tuple[int, np.ndarray]]:
    """For every start, the least mixed hash of the grams in its window, as 48-bit numbers: (first start, numbers) of each block."""
    for low in range(0, len(text) - window + 1, BLOCK):
        hashed, factor, n = _TABLE[text[low:low + BLOCK + window - 1]], 0x9E3779B97F4A7C15, 1
        while n < gram:
            longer = hashed[:-n] * np.uint64(factor)
            longer += hashed[n:]
            hashed, factor, n = longer, factor * factor % (1 << 64), 2 * n
        hashed ^= hashed >> np.uint64(29)
        hashed *= np.uint64(0xBF58476D1CE4E5B9)
        hashed ^= hashed >> np.uint64(32)
        hashed >>= np.uint64(16)
        width, n, least = window - gram + 1, 1, hashed.view(np.int64)  # 48 bits: the sign does not matter
        while 2 * n <= width:
            least, n = np.minimum(least[:-n], least[n:]), 2 * n
        if n < width:
            least = np.minimum(least[:n - width], least[width - n:])
        yield low, least.view(np.uint64)


def least_grams(text: np.ndarray) -> np.ndarray:
    """The numbers of all blocks."""
    return np.concatenate([np.zeros(0, np.uint64), *[least for _, least in gram_blocks(text)]])


def window_hashes(text: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """48-bit hashes of the windows that start at ``pos``."""
    hashed = np.zeros(len(pos), np.uint64)
    for k in range(WINDOW):
        hashed = hashed * np.uint64(0x9E3779B97F4A7C15) + _TABLE[text[pos + k]]
    hashed ^= hashed >> np.uint64(29)
    hashed *= np.uint64(0xBF58476D1CE4E5B9)
    hashed ^= hashed >> np.uint64(32)
    return hashed >> np.uint64(16)


class Batch:
    """Documents of a batch file: their rows, ids and texts, and the segments of their windows."""

    def __init__(self, rows: pa.Table, text_at: int, id_at: int):
        self.rows = rows
        texts = rows.column(text_at).cast(pa.string()).cast(pa.binary()).fill_null(b"").combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        self.texts = texts.to_pylist()
        ids = rows.column(id_at).cast(pa.int64()).fill_null(LAST_ID)
        self.ids = np.array(ids.to_pylist(), np.int64)
        self.lengths = np.fromiter(map(len, self.texts), np.int64, count=len(self.texts))
        self.starts = np.cumsum(np.append(0, self.lengths))[:-1]
        self.raw = b"".join(self.texts)

    def segments(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(value, document, start in the batch, windows) of every segment."""
        n = max(0, len(self.raw) - WINDOW + 1)
        first, beyond = self.starts, self.starts + np.maximum(self.lengths - WINDOW + 1, 0)
        # a document's first window begins a segment; a place behind its last one ends it and is not one itself
        fresh = np.zeros(n, bool)
        fresh[first[first < n]] = True
        fresh[beyond[beyond < n]] = True
        places, values, last = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], None
        for low, least in gram_blocks(np.frombuffer(self.raw, np.uint8)):
            own = fresh[low:low + len(least)]
            own[0] |= last != least[0]
            own[1:] |= least[1:] != least[:-1]
            at, last = np.flatnonzero(own), least[-1]
            places.append(at + low)
            values.append(least[at])
        at, value = np.concatenate(places), np.concatenate(values)
        windows = np.diff(np.append(at, n))
        doc = np.searchsorted(first, at, "right") - 1
        sound = at < beyond[doc]
        return value[sound], doc[sound].astype(np.int32), at[sound], windows[sound]

    def distinct_bytes(self, value: np.ndarray, start: np.ndarray, windows: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Values whose distinct segments have more than ``least`` bytes, ascending, and these bytes."""
        order = np.argsort(value)
        v = value[order]
        head = np.flatnonzero(np.append(True, v[1:] != v[:-1])) if len(v) else np.zeros(0, np.int64)
        ends = np.append(head[1:], len(v))
        found, sizes = [], []
        for i in np.flatnonzero(np.add.reduceat(windows[order] + WINDOW - 1, head) > least) if len(v) else ():
            own = order[head[i]:ends[i]]
            size = sum(map(len, {self.raw[a:a + w + WINDOW - 1] for a, w in zip(start[own].tolist(), windows[own].tolist())}))
            if size > least:
                found.append(v[head[i]])
                sizes.append(size)
        return np.array(found, np.uint64), np.array(sizes, np.int64)

    def split(self, doc: np.ndarray, start: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Segments cut into runs of equal windows: (window's hash, document, start, windows) of each run."""
        text, parts = np.frombuffer(self.raw, np.uint8), []
        bounds = np.flatnonzero(np.diff(np.cumsum(windows) >> 18, prepend=-1, append=1 << 62))
        for low, high in zip(bounds, bounds[1:]):
            w = windows[low:high]
            owner = np.repeat(np.arange(low, high), w)
            n = np.arange(len(owner))
            pos = n - np.repeat(np.cumsum(w) - w, w) + start[owner]
            hashed = window_hashes(text, pos)
            fresh = np.append(True, (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1]))
            fresh |= (n - np.maximum.accumulate(np.where(fresh, n, 0))) % RUN == 0
            at = np.flatnonzero(fresh)
            parts.append((hashed[at], doc[owner[at]], pos[at], np.diff(np.append(at, len(n)))))
        if not parts:
            return np.zeros(0, np.uint64), doc[:0], start[:0], windows[:0]
        return tuple(np.concatenate(column) for column in zip(*parts))


def shard_values(value: np.ndarray, doc: np.ndarray, n_shards: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(shard, ascending distinct values, whether more than one document of the batch has them)."""
    order = np.argsort(value)  # documents of a value may stand in any order: if there are two, some neighbours differ
    v, d = value[order], doc[order]
    head = np.append(True, v[1:] != v[:-1]) if len(v) else np.zeros(0, bool)
    group = np.cumsum(head) - 1
    many = np.zeros(head.sum(), bool)
    many[group[1:][~head[1:] & (d[1:] != d[:-1])]] = True
    distinct = v[head]
    shard = distinct % np.uint64(n_shards)
    by_shard = np.argsort(shard.astype(np.min_scalar_type(n_shards)), kind="stable")
    bounds = np.searchsorted(shard[by_shard], np.arange(n_shards + 1))
    for s in range(n_shards):
        if bounds[s] < bounds[s + 1]:
            own = by_shard[bounds[s]:bounds[s + 1]]
            yield s, distinct[own], many[own]


def cut_values(values: np.ndarray) -> bytes:
    """48-bit numbers in six bytes each."""
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def read_values(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return wide.view("<u8").ravel()


def covered_elsewhere(segments: list[bytes], owners: np.ndarray, memory: int = MEMORY) -> list[list[tuple[int, int]]]:
    """Per distinct segment, the runs (from, to) of windows that also lie in a segment with a smaller owner.

    Texts are UTF-8, so bytes 0xFE and 0xFF are free for the end and between segments.
    """
    joined = np.frombuffer(b"\xff".join(segments) + b"\xff\xfe", np.uint8) + np.uint8(2)
    lengths = np.fromiter(map(len, segments), np.int64, count=len(segments))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    owner_of = np.repeat(owners, lengths + 1)
    edge = np.zeros(len(joined) + 1, np.int8)
    edge[starts] = 1
    edge[starts + np.maximum(lengths - WINDOW + 1, 0)] -= 1
    whole = np.cumsum(edge[:-1], dtype=np.int8).view(np.bool_)  # where a window starts; only these suffixes are wanted
    flagged = np.zeros(ends[-1] + 1, bool)
    pending: list[tuple[np.ndarray, np.ndarray]] = []

    def close(parts: list[tuple[np.ndarray, np.ndarray]]) -> None:
        pos = np.concatenate([p for p, _ in parts])
        if not len(pos):
            return
        head = np.concatenate([c for _, c in parts]) < WINDOW
        head[0] = True
        group = np.cumsum(head) - 1
        sound = whole[pos]
        pos, group = pos[sound], group[sound]
        if len(pos):
            first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
            least = np.minimum.reduceat(owner_of[pos], first)
            flagged[pos] = np.repeat(least, np.diff(np.append(first, len(pos)))) < owner_of[pos]

    for pos, common in suffixes(joined, 256, WINDOW, memory, whole):
        cut = np.flatnonzero(common < WINDOW)
        if len(cut):  # classes before the last head are complete
            pending.append((pos[:cut[-1]], common[:cut[-1]]))
            close(pending)
            pending = [(pos[cut[-1]:], common[cut[-1]:])]
        else:
            pending.append((pos, common))
    close(pending)
    edge = np.diff(flagged.astype(np.int8), prepend=0, append=0)
    low, high = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    for s, a, b in zip((np.searchsorted(starts, low, "right") - 1).tolist(), low.tolist(), high.tolist()):
        out[s].append((a - int(starts[s]), b - int(starts[s])))
    return out


def _table_bytes(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _bytes_table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(data)).read_all()


def _pack(*parts: bytes) -> bytes:
    """Byte strings as one, compressed."""
    raw = np.array([len(parts), *map(len, parts)], "<i8").tobytes() + b"".join(parts)
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _unpack(data: bytes) -> list[bytes]:
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)
    n = int.from_bytes(raw[:8], "little")
    ends = 8 * (n + 1) + np.cumsum(np.append(0, np.frombuffer(raw, "<i8", n, 8)))
    return [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]


def _owned_texts(data: bytes) -> tuple[np.ndarray, pa.Array]:
    """The owners and the texts that ``_pack`` has joined."""
    raw = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd")
    n = int(np.frombuffer(raw, "<i8", 1)[0])
    ends = 8 * (n + 1) + np.cumsum(np.append(0, np.frombuffer(raw, "<i8", n, 8)))
    owners = np.frombuffer(raw, "<i8", n - 1, ends[0])
    return owners, pa.Array.from_buffers(pa.large_binary(), n - 1, [None, pa.py_buffer(ends[1:].astype("<i8")), raw])


PART = "batch string, kind int, shard int, body binary"
_PART = pa.schema([("batch", pa.string()), ("kind", pa.int32()), ("shard", pa.int32()), ("body", pa.binary())])
PARTS_BYTES = 1 << 20  # bodies that leave a task at once
FILE, BITMAP, PLACES, VERDICT, SEGMENTS, VALUES, HEAT, HOT = range(8)


def _parts(made: Callable[[Iterator[pa.RecordBatch]], Iterator[tuple]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Let (batch, kind, shard, body) tuples leave in record batches of about ``PARTS_BYTES``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for part in made(batches):
            held.append(part)
            size += len(part[3])
            if size >= PARTS_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PART)], schema=_PART)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), _PART)], schema=_PART)

    return run


def _grouped(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[object, list[dict]]]:
    """Rows of sorted batches, group by group."""
    here, rows = None, []
    for batch in batches:
        for row in batch.to_pylist():
            if row[key] != here and rows:
                yield here, rows
                rows = []
            here = row[key]
            rows.append(row)
    if rows:
        yield here, rows


def _write_batches(docs: DataFrame, folder: str) -> DataFrame:
    """Write the rows of ``docs`` to batch files where they are read; (batch, docs, bytes) of each, written as a table."""
    text_at = docs.columns.index("text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = pafs.FileSystem.from_uri(folder)
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            name = f"batch-{uuid.uuid4().hex}"
            with store.open_output_stream(f"{root}/{name}", compression=None) as out:
                out.write(_table_bytes(pa.Table.from_batches(held)))
            return pa.RecordBatch.from_pylist([dict(batch=name, bytes=size)], pa.schema([("batch", pa.string()), ("bytes", pa.int64())]))

        for batch in batches:
            sizes = np.array([0 if t is None else t for t in pc.binary_length(batch.column(text_at)).to_pylist()], np.int64)
            at = 0
            while at < batch.num_rows:
                fits = int(np.searchsorted(np.cumsum(sizes[at:]), BATCH_BYTES - size)) + 1
                held.append(batch.slice(at, fits))
                size += int(sizes[at:at + fits].sum())
                at += fits
                if size >= BATCH_BYTES:
                    yield flush()
                    held, size = [], 0
        if held:
            yield flush()

    store, root = pafs.FileSystem.from_uri(folder)
    store.create_dir(root, recursive=True)
    note_stage(folder)
    return write_stage(docs.mapInArrow(write, "batch string, bytes long"), "batches")


def _open(folder: str, name: str, text_at: int, id_at: int) -> Batch:
    let_go()  # a batch takes many times its bytes: what other operators or tasks left behind goes first
    store, root = pafs.FileSystem.from_uri(folder)
    with store.open_input_stream(f"{root}/{name}", compression=None) as f:
        return Batch(_bytes_table(f.read()), text_at, id_at)


def among(value: np.ndarray, some: np.ndarray) -> np.ndarray:
    """Which of ``value`` are in ``some`` (ascending)."""
    if not len(some):
        return np.zeros(len(value), bool)
    return some[np.minimum(np.searchsorted(some, value), len(some) - 1)] == value


def shared_segments(docs: DataFrame, folder: str) -> tuple[DataFrame, DataFrame, int, int]:
    """Write the batch files and, per batch and shard, the segments of values that several documents have.

    Returns the batch files and the segments, both as parts, and the numbers of tasks and of shards. Shards
    from the number of shards on are those of split values.
    """
    text_at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")
    files = _write_batches(docs, folder)
    n_files, total = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).first()
    n_shards = max(1, math.ceil(total / SHARD_BYTES))
    tasks = max(1, n_files)
    most = max(1, SHARD_BYTES // HOT_SHARE)
    least, unseen = most >> 11, most >> 16  # a batch reports more than ``least`` bytes of a value; less counts as ``unseen``
    listed = files.select("batch", F.lit(FILE).alias("kind"), F.lit(-1).alias("shard"), F.lit(None).cast("binary").alias("body"))

    @_parts
    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for name, _ in _grouped(batches, "batch"):
            batch = _open(folder, name, text_at, id_at)
            value, doc, start, windows = batch.segments()
            for shard, own, many in shard_values(value, doc, n_shards):
                yield name, VALUES, shard, np.packbits(many).tobytes() + cut_values(own)
            heavy, size = batch.distinct_bytes(value, start, windows, least)
            shard = (heavy % np.uint64(n_shards)).astype(np.int64)
            for s in np.unique(shard).tolist():
                yield name, HEAT, s, np.stack([heavy[shard == s].astype("<i8"), size[shard == s]]).tobytes()

    @_parts
    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, parts in _grouped(batches, "shard"):
            rows = [row for row in parts if row["kind"] == VALUES]
            counts, lists, flags = [], [], []
            for row in rows:
                n = (8 * len(row["body"])) // 49 - 1  # n values take 6 n bytes and their flags n / 8
                while 6 * n + -(-n // 8) < len(row["body"]):
                    n += 1
                flags.append(np.unpackbits(np.frombuffer(row["body"][:-6 * n], np.uint8), count=n))
                lists.append(read_values(row["body"][-6 * n:]))
                counts.append(n)
            every, many = np.concatenate(lists), np.concatenate(flags)
            order = np.argsort(every)
            v = every[order]
            same = v[1:] == v[:-1]
            hit = many[order].astype(bool)
            hit[1:] |= same
            hit[:-1] |= same
            mark = np.empty(len(v), bool)
            mark[order] = hit
            at = 0
            for row, n in zip(rows, counts):
                if mark[at:at + n].any():
                    yield row["batch"], BITMAP, shard, np.packbits(mark[at:at + n]).tobytes()
                at += n
            if shard >= n_shards:
                continue
            head = np.flatnonzero(np.append(True, ~same))
            distinct, size = v[head], unseen * np.diff(np.append(head, len(v)))
            for row in parts:
                if row["kind"] == HEAT:
                    heavy, known = np.frombuffer(row["body"], "<i8").reshape(2, -1)
                    size[np.searchsorted(distinct, heavy.astype(np.uint64))] += known - unseen
            if (size > most).any():
                yield "", HOT, shard, cut_values(distinct[size > most])

    @_parts
    def split_values(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for name, _ in _grouped(batches, "batch"):
            batch = _open(folder, name, text_at, id_at)
            value, doc, start, windows = batch.segments()
            at = among(value, hot)
            value, doc, _, _ = batch.split(doc[at], start[at], windows[at])
            for shard, own, many in shard_values(value, doc, n_shards):
                yield name, VALUES, n_shards + shard, np.packbits(many).tobytes() + cut_values(own)

    def kept_values(value: np.ndarray, doc: np.ndarray, marks: dict[int, bytes], first: int) -> np.ndarray:
        kept = [own[np.unpackbits(np.frombuffer(marks[first + shard], np.uint8), count=len(own)).astype(bool)]
                for shard, own, _ in shard_values(value, doc, n_shards) if first + shard in marks]
        return np.sort(np.concatenate(kept)) if kept else np.zeros(0, np.uint64)

    @_parts
    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for name, rows in _grouped(batches, "batch"):
            marks = {r["shard"]: r["body"] for r in rows if r["kind"] == BITMAP}
            if not marks:
                continue
            batch = _open(folder, name, text_at, id_at)
            value, doc, start, windows = batch.segments()
            at = among(value, kept_values(value, doc, marks, 0))
            own_shard = (value % np.uint64(n_shards)).astype(np.int64)
            if len(hot):
                parted = among(value, hot)
                at &= ~parted
                finer = batch.split(doc[parted], start[parted], windows[parted])
                taken = among(finer[0], kept_values(finer[0], finer[1], marks, n_shards))
                own_shard = np.append(own_shard[at], (finer[0][taken] % np.uint64(n_shards)).astype(np.int64) + n_shards)
                doc, start, windows = (np.append(a[at], b[taken]) for a, b in zip((doc, start, windows), finer[1:]))
                at = np.arange(len(doc))
            else:
                at = np.flatnonzero(at)
                own_shard = own_shard[at]
            by_own = np.argsort(own_shard.astype(np.min_scalar_type(2 * n_shards)), kind="stable")
            every, own_shard = at[by_own], own_shard[by_own]
            bounds = np.flatnonzero(np.diff(own_shard, prepend=-1, append=2 * n_shards))
            for low, high in zip(bounds, bounds[1:]):
                shard, at = int(own_shard[low]), every[low:high]
                index: dict[bytes, int] = {}
                place = [index.setdefault(batch.raw[a:a + w + WINDOW - 1], len(index)) for a, w in zip(start[at].tolist(), windows[at].tolist())]
                owner = np.full(len(index), LAST_ID, np.int64)
                np.minimum.at(owner, place, batch.ids[doc[at]])
                yield name, SEGMENTS, shard, _pack(owner.tobytes(), *index)
                yield name, PLACES, shard, _pack(*(np.asarray(c, "<i4").tobytes() for c in (doc[at], start[at], windows[at], place)))

    lists = by_batch(listed, tasks).mapInArrow(values, PART)
    bitmaps = write_stage(by_shard(lists, n_shards).mapInArrow(shared, PART), "bitmaps")
    split = [read_values(row["body"]) for row in bitmaps.where(F.col("kind") == HOT).select("body").collect()]
    hot = np.sort(np.concatenate(split)) if split else np.zeros(0, np.uint64)
    bitmaps = bitmaps.where(F.col("kind") == BITMAP)
    if len(hot):
        finer = by_batch(listed, tasks).mapInArrow(split_values, PART)
        bitmaps = bitmaps.unionByName(by_shard(finer, n_shards).mapInArrow(shared, PART))
    return listed, write_stage(by_batch(bitmaps.unionByName(listed), tasks).mapInArrow(segments, PART), "segments"), tasks, n_shards


def covered_in_shard(segments: list[bytes], owners: np.ndarray, by_value: bool, memory: int) -> list[list[tuple[int, int]]]:
    """``covered_elsewhere`` over the segments of a shard. A value with one distinct segment needs no sort: its windows are
    nowhere else, so the smallest owner alone decides. The same holds for a window's hash in the shards of split values."""
    if not segments:
        return []
    heads = np.frombuffer(b"".join(t[:WINDOW] for t in segments), np.uint8)
    value = least_grams(heads)[::WINDOW] if by_value else window_hashes(heads, np.arange(0, len(heads), WINDOW))
    _, back, count = np.unique(value, return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[back] > 1).tolist()
    out: list[list[tuple[int, int]]] = [[] for _ in segments]
    if not several:
        return out
    for i, runs in zip(several, covered_elsewhere([segments[i] for i in several], owners[several], memory)):
        out[i] = runs
    return out


def by_batch(df: DataFrame, tasks: int) -> DataFrame:
    return df.repartition(tasks, "batch").sortWithinPartitions("batch", "kind", "shard")


def by_shard(df: DataFrame, n_shards: int) -> DataFrame:
    return df.repartition(n_shards, "shard").sortWithinPartitions("shard", "batch")


def verdicts(docs: DataFrame, folder: str, memory: int = MEMORY) -> tuple[DataFrame, int]:
    """Parts (batch, kind, shard, body) of what each batch file needs to be cut, and the number of batch files."""
    listed, made, tasks, n_shards = shared_segments(docs, folder)

    @_parts
    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for shard, rows in _grouped(batches, "shard"):
            owned = [_owned_texts(row["body"]) for row in rows]
            coded = pa.chunked_array([texts for _, texts in owned]).dictionary_encode()  # all chunks have one dictionary
            places = [chunk.indices.to_numpy() for chunk in coded.chunks]
            segments = coded.chunk(0).dictionary.to_pylist()
            least = np.full(len(segments), LAST_ID, np.int64)
            np.minimum.at(least, np.concatenate(places), np.concatenate([own for own, _ in owned]))
            runs = covered_in_shard(segments, least, shard < n_shards, memory)
            found = np.fromiter(map(bool, runs), np.bool_, len(runs))
            for row, mine, (own, _) in zip(rows, places, owned):
                keeper = least[mine]
                first = np.flatnonzero(found[mine] & (own == keeper)).tolist()
                cut = [(i, a, b) for i in first for a, b in runs[mine[i]]]
                yield row["batch"], VERDICT, shard, _pack(keeper.astype("<i8").tobytes(), np.array(cut, "<i4").tobytes())

    ruled = by_shard(made.where(F.col("kind") == SEGMENTS), n_shards).mapInArrow(judged, PART)
    return listed.unionByName(made.where(F.col("kind") == PLACES)).unionByName(ruled), tasks


def removed_bytes(batch: Batch, parts: list[dict]) -> np.ndarray:
    """Which bytes of a batch's joined text go, from its places and verdicts."""
    begins, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    places = {p["shard"]: _unpack(p["body"]) for p in parts if p["kind"] == PLACES}
    for part in parts:
        if part["kind"] != VERDICT:
            continue
        keeper, cut = _unpack(part["body"])
        keeper, cut = np.frombuffer(keeper, "<i8"), np.frombuffer(cut, "<i4").reshape(-1, 3)
        doc, start, windows, segment = (np.frombuffer(c, "<i4") for c in places[part["shard"]])
        own = batch.ids[doc]
        late = own > keeper[segment]
        begins.append(start[late])
        ends.append(start[late] + windows[late] + WINDOW - 1)
        if len(cut):
            first = np.flatnonzero(~late)
            first = first[np.argsort(segment[first], kind="stable")]
            low, high = (np.searchsorted(segment[first], cut[:, 0], side) for side in ("left", "right"))
            run = np.repeat(np.arange(len(cut)), high - low)  # once for each place of its segment
            at = np.arange(len(run)) - np.repeat(np.cumsum(high - low) - high, high - low)
            begins.append(start[first[at]] + cut[run, 1])
            ends.append(start[first[at]] + cut[run, 2] + WINDOW - 1)
    depth = np.zeros(len(batch.raw) + 1, np.int32)
    np.add.at(depth, np.concatenate(begins), np.int32(1))
    np.add.at(depth, np.concatenate(ends), np.int32(-1))
    return np.cumsum(depth[:-1], dtype=np.int32) > 0


def cut_documents(
    docs: DataFrame, finish: Callable[[Batch, np.ndarray], pa.RecordBatch], schema: object, memory: int = MEMORY
) -> DataFrame:
    """Apply ``finish`` to every batch of documents and the mask of its removed bytes.

    A byte goes if it lies in a string of ``WINDOW`` bytes that also starts in a document with a smaller
    doc_id. Strings are judged on the input; documents with equal ids keep each other's; documents
    without id count as the last. Null texts are empty, and texts shorter than the window stay whole.
    """
    folder = f"{shared_dir(docs.sparkSession).rstrip('/')}/dedup-{uuid.uuid4().hex}"
    text_at, id_at = docs.columns.index("text"), docs.columns.index("doc_id")
    parts, tasks = verdicts(docs, folder, memory)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, rows in _grouped(batches, "batch"):
            batch = _open(folder, name, text_at, id_at)
            yield finish(batch, removed_bytes(batch, rows))

    return by_batch(parts, tasks).mapInArrow(apply, schema)


def _kept(batch: Batch, gone: np.ndarray) -> Iterator[tuple[bytes, np.ndarray]]:
    """What is left of each text, and its part of the mask."""
    for text, at, n in zip(batch.texts, batch.starts.tolist(), batch.lengths.tolist()):
        mask = gone[at:at + n]
        yield (np.frombuffer(text, np.uint8)[~mask].tobytes() if mask.any() else text), mask


def removal_report(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    def report(batch: Batch, gone: np.ndarray) -> pa.RecordBatch:
        rows = [(len(mask), int(np.count_nonzero(mask)), int(mask[:1].sum() + np.count_nonzero(mask[1:] > mask[:-1])),
                 hashlib.sha256(kept).hexdigest()) for kept, mask in _kept(batch, gone)]
        columns = list(zip(*rows))
        arrays = [batch.rows.column(0).combine_chunks().cast(pa.int64()), *[pa.array(c, pa.int64()) for c in columns[:3]], pa.array(columns[3])]
        arrays = [a.combine_chunks() if isinstance(a, pa.ChunkedArray) else a for a in arrays]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return cut_documents(rows, report, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string", memory)


def without_repeats(docs: DataFrame, memory: int = MEMORY) -> DataFrame:
    """The rows of ``docs`` with repeated strings cut out of their texts.

    A cut may go through a character; what is left of it is dropped. Null texts stay null.
    """
    text_at = docs.columns.index("text")

    def rewrite(batch: Batch, gone: np.ndarray) -> pa.RecordBatch:
        texts = [kept.decode("utf-8", "ignore") for kept, _ in _kept(batch, gone)]
        known = batch.rows.column(text_at).is_valid().to_pylist()
        new = pa.array([t if k else None for t, k in zip(texts, known)], pa.string())
        whole = batch.rows.set_column(text_at, batch.rows.schema.field(text_at).with_type(pa.string()), new)
        return whole.combine_chunks().to_batches()[0]

    return cut_documents(docs, rewrite, docs.schema, memory)
