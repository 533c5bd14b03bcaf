"""Near-duplicate groups by 64-bit SimHash and tiled exact comparison of all fingerprints.

Documents with one fingerprint are one class. Distinct fingerprints are dealt into tiles of one bit
count each; two tiles meet only if their bit counts differ by at most the radius, since every
differing bit changes the count by at most one. A pair of tiles is compared in numpy blocks by
exclusive-or and bit counts, and passes on a spanning forest of its links, never all pairs. Tile
pairs are separate rows spread over tasks, so the quadratic part scales with the machines.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from stockcast.llm.components import roots
from stockcast.operators.hot_groups import row_hash
from stockcast.session import write_stage

WIDTH = 3         # words in a shingle
SEED = 42
RADIUS = 2        # most differing bits of a link
TILE = 16_384     # fingerprints a tile aims at
BLOCK = (64, 4_096)
SHINGLES_AT_ONCE = 65_536


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """SimHash of the word shingles, repeats included; null and texts without words give 0.

    Only A-Z are lower-cased and only ASCII white space separates words, which is what ``bytes`` does.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < width:
        shingles: Iterable[bytes] = [b" ".join(words)]
        count = 1
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
        count = len(words) - width + 1
    ones, digest, left = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest, iter(shingles)
    for start in range(0, count, SHINGLES_AT_ONCE):
        size = min(SHINGLES_AT_ONCE, count - start)
        hashes = np.fromiter((digest(s, SEED) for _, s in zip(range(size), left)), dtype="<u8", count=size)
        ones += np.unpackbits(hashes.view(np.uint8).reshape(size, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > count, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, text_hash and fingerprint (signed long) of every row; texts stay where they are read."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text")
            values = np.fromiter((fingerprint(t.as_py(), width) for t in texts), dtype=np.uint64, count=len(texts))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(values.view(np.int64))],
                ["doc_id", "text_hash", "fp"])

    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"),
        F.col("text").cast("string").alias("text"))
    return plain.mapInArrow(rows, "doc_id long, text_hash long, fp long")


def tile_links(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles of fingerprints (uint64), as (node, root) arrays."""
    both = np.concatenate([a, b])
    root = np.arange(len(both), dtype=np.int32)
    for i in range(0, len(a), BLOCK[0]):
        rows = a[i:i + BLOCK[0], None]
        for j in range(0, len(b), BLOCK[1]):
            near = np.bitwise_count(rows ^ b[None, j:j + BLOCK[1]]) <= radius
            for r in np.flatnonzero(near.any(axis=1)):
                met = np.unique(root[np.append(np.flatnonzero(near[r]) + len(a) + j, i + r)])
                if len(met) > 1:
                    root[np.isin(root, met)] = met[0]
    moved = np.flatnonzero(root != np.arange(len(both)))
    return both[moved], both[root[moved]]


def links(classes: DataFrame, radius: int = RADIUS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all distinct fingerprints ``fp`` within ``radius`` bits, directly or through others."""
    spark = classes.sparkSession
    counted = classes.withColumn("ones", F.bit_count("fp"))
    tiles_of = {r["ones"]: -(-r["n"] // tile) for r in counted.groupBy("ones").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_tiles = F.element_at(F.array(*[F.lit(tiles_of.get(k, 0)) for k in range(65 + radius)]), F.col("ones") + 1)
    tiles = write_stage(
        counted.withColumn("chunk", F.pmod(F.xxhash64("fp"), n_tiles).cast("int"))
        .groupBy("ones", "chunk").agg(F.collect_list("fp").alias("fps")), "tiles")

    pairs = [
        (low, high, sum(range(1, n + 1)) if low == high else n * tiles_of[high])
        for low, n in tiles_of.items() for high in range(low, low + radius + 1) if tiles_of.get(high)]
    n_pairs = sum(n for *_, n in pairs)
    tasks = max(1, min(n_pairs, 4 * spark.sparkContext.defaultParallelism + n_pairs // 64))
    members = None
    for distance in range(radius + 1):
        other = lambda shift: F.element_at(
            F.array(*[F.lit(tiles_of.get(k + shift, 0)) for k in range(65)]), F.col("ones") + 1)
        partners = F.sequence(F.lit(0), other(distance) - 1)
        if distance == 0:
            partners = F.sequence("chunk", other(0) - 1)
        low = tiles.where(other(distance) > 0).select(
            F.col("ones").alias("low"), F.lit(distance).alias("distance"), F.col("chunk").alias("i"),
            F.explode(partners).alias("j"), F.lit(0).alias("side"), "fps")
        back = F.sequence(F.lit(0), other(-distance) - 1) if distance else F.sequence(F.lit(0), F.col("chunk"))
        high = tiles.where(other(-distance) > 0).select(
            (F.col("ones") - distance).alias("low"), F.lit(distance).alias("distance"), F.explode(back).alias("i"),
            F.col("chunk").alias("j"), F.lit(1).alias("side"), "fps")
        members = low.unionByName(high) if members is None else members.unionByName(low).unionByName(high)
    dealt = members.repartition(tasks, "low", "distance", "i", "j").sortWithinPartitions("low", "distance", "i", "j", "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: np.ndarray | None = None
        for batch in batches:
            for side, fps in zip(batch.column("side").to_pylist(), batch.column("fps")):
                values = fps.values.to_numpy(zero_copy_only=False).view(np.uint64)
                if side == 0:
                    first = values.copy()
                    continue
                a, b = tile_links(first, values, radius)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

    return dealt.select("side", "fps").mapInArrow(compare, "a long, b long")


def near_duplicates(docs: DataFrame, radius: int = RADIUS, width: int = WIDTH, tile: int = TILE) -> DataFrame:
    """Every row's fingerprint and group: doc_id, text_hash, fp, root, component_id.

    ``root`` names the group by its smallest fingerprint; ``component_id`` is the smallest doc_id that
    links of at most ``radius`` bits reach (null only if all ids of the group are null). Null and empty
    texts have fingerprint 0 and link like any other. Repeated rows are one class. An empty table gives
    an empty result. Extra columns are ignored.
    """
    rows = write_stage(fingerprints(docs, width), "fingerprints")
    classes = write_stage(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "classes")
    found = roots(links(classes, radius, tile))
    rooted = classes.join(found, classes["fp"] == found["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    least = write_stage(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "components")
    named = write_stage(rooted.join(least, "root").select("fp", "root", "component_id"), "class-components")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def one_per_group(docs: DataFrame, **options: int) -> DataFrame:
    """The rows of ``docs`` that stay: of each near-duplicate group the one with the smallest doc_id.

    Rows with a null id stay only where a group has no other; of rows that agree in id and text one stays.
    """
    groups = near_duplicates(docs, **options)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    best = groups.groupBy("root").agg(F.min(rank).alias("k")).select(
        F.col("k.doc_id").alias("__best_id"), F.col("k.text_hash").alias("__best_hash"))
    best = write_stage(best, "group-heads")
    names = [f"__d{i}" for i in range(len(docs.columns))]
    doc, text = (names[docs.columns.index(c)] for c in ("doc_id", "text"))
    keyed = docs.toDF(*names).withColumns({"__id": F.col(doc).cast("long"), "__hash": F.xxhash64(text)})
    kept = keyed.join(best, F.col("__id").eqNullSafe(F.col("__best_id")) & (F.col("__hash") == F.col("__best_hash")), "left_semi")
    first = Window.partitionBy("__id", "__hash").orderBy(row_hash(kept))
    return kept.withColumn("__n", F.row_number().over(first)).where("__n = 1").select(
        *[F.col(n).alias(c) for n, c in zip(names, docs.columns)])
