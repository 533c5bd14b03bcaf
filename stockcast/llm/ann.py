"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing and exact reranking.

Vectors are dealt into bands of norms within a factor of two. Each band is scaled into the unit ball by its
own largest norm and lifted onto the sphere, where the largest inner product is the smallest distance;
so a few long vectors do not push all others to the pole. Each table hashes them by random projections
cut into cells. A query visits its own bucket and then perturbed ones of every band, in the order of their
estimated success; the candidates of all tables and bands are merged and ranked by their exact inner
product. Queries that found too few probe on, and in the end meet all vectors. Equal vectors are one class: it is hashed
once and stands for its members, of which only the smallest ids can rank. Large buckets are cut into
chunks, so each pair of query and bucket is compared in blocks of bounded size and nothing is left out.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from stockcast.operators.hot_groups import pinned
from stockcast.session import write_stage

TABLES, HASHES, CELL, PROBES = 5, 6, 2.0, 90
SEED = 42
CHUNK = 4_096  # vectors of a bucket, or queries at it, that are compared at once


def _projection(table: int, dim: int, hashes: int, cell: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng([seed, table, dim])
    return rng.standard_normal((dim + 1, hashes)), rng.random(hashes) * cell


def perturbations(hashes: int, count: int) -> list[tuple[int, ...]]:
    """The likeliest sets of steps to neighbouring cells, as ranks among a query's 2 x ``hashes`` border distances.

    Expected squared distances of the ranked borders decide; a set never steps both ways along one
    hash. The first set is empty: the query's own bucket.
    """
    m = hashes
    expected = [j * (j + 1) / (4 * (m + 1) * (m + 2)) for j in range(1, m + 1)]
    expected += [1 - (2 * m + 1 - j) / (m + 1) + (2 * m + 1 - j) * (2 * m + 2 - j) / (4 * (m + 1) * (m + 2)) for j in range(m + 1, 2 * m + 1)]
    found: list[tuple[int, ...]] = [()]
    heap = [(expected[0], (0,))]
    while heap and len(found) < count:
        cost, chosen = heapq.heappop(heap)
        last = chosen[-1]
        if last + 1 < 2 * m:
            heapq.heappush(heap, (cost - expected[last] + expected[last + 1], (*chosen[:-1], last + 1)))
            heapq.heappush(heap, (cost + expected[last + 1], (*chosen, last + 1)))
        if len({min(j, 2 * m - 1 - j) for j in chosen}) == len(chosen):
            found.append(chosen)
    return found


def _bucket_keys(cells: np.ndarray) -> np.ndarray:
    """One number per row of cell numbers (last axis); equal keys of different cells only add candidates."""
    key = np.zeros(cells.shape[:-1], dtype=np.uint64)
    for k in range(cells.shape[-1]):
        key = (key ^ cells[..., k].astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def probe_buckets(queries: np.ndarray, a: np.ndarray, b: np.ndarray, cell: float, probes: int) -> np.ndarray:
    """Bucket keys that each query visits, likeliest first: its own, then perturbed ones."""
    hashes = len(b)
    position = (queries @ a + b) / cell
    base = np.floor(position)
    inside = position - base
    border = np.concatenate([inside, 1 - inside], axis=1) ** 2  # down, then up
    order = np.argsort(border, axis=1, kind="stable")
    ranked = np.take_along_axis(border, order, axis=1)
    sets = perturbations(hashes, 4 * probes)
    member = np.zeros((2 * hashes, len(sets)))
    for s, chosen in enumerate(sets):
        member[list(chosen), s] = 1
    best = np.argsort(ranked @ member, axis=1, kind="stable")[:, :probes]
    cells = np.repeat(base[:, None, :], best.shape[1], axis=1)
    for rank in range(2 * hashes):
        used = member[rank][best]
        which, up = order[:, rank] % hashes, np.where(order[:, rank] < hashes, -1.0, 1.0)
        np.add.at(cells, (np.arange(len(cells))[:, None], np.arange(best.shape[1])[None, :], which[:, None]), used * up[:, None])
    return _bucket_keys(cells)


def _matrix(raw: list[bytes], code: str) -> np.ndarray:
    """Packed vectors of one length as a matrix in double precision."""
    return np.frombuffer(b"".join(raw), code).reshape(len(raw), -1).astype(np.float64) if raw else np.zeros((0, 0))


def _in_bands(classes: DataFrame) -> DataFrame:
    """Adds ``band``, from the longest vectors of a dimension down, and ``scale``, the binary logarithm of the band's largest norm."""
    longest = pinned(classes.groupBy("dim").agg(F.max("size").alias("longest")), "ann-longest")[0]
    banded = classes.join(longest, "dim").withColumn("band", F.floor(F.col("longest") - F.col("size")).cast("int")).drop("longest")
    scales = pinned(banded.groupBy("dim", "band").agg(F.max("size").alias("scale")), "ann-bands")[0]
    return banded.join(scales, ["dim", "band"])


def _hashed(rows: DataFrame, code: str, probes: int, tables: int, hashes: int, cell: float, seed: int) -> DataFrame:
    """Rows (cls, dim, vec) as (dim, tab, bucket, cls, vec), one per table and probe; without probes rows (cls, dim,
    vec, band, scale) as (dim, band, tab, bucket, cls, vec), one per table."""
    kept = ["dim"] if probes else ["dim", "band"]

    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at_once = max(1, (1 << 20) // max(1, probes))
        for batch in batches:
            yield from (batch.slice(low, at_once) for low in range(0, batch.num_rows, at_once))

    def hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                x = _matrix(part.column("vec").to_pylist(), code)
                if probes:
                    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of very long or short vectors do not fit a double
                    norm = np.sqrt((x * x).sum(axis=1))
                    lifted = np.concatenate([x / norm[:, None], np.zeros((len(x), 1))], axis=1)
                else:
                    scale = part.column("scale").to_numpy()[:, None]
                    x = np.ldexp(x, -np.floor(scale).astype(np.int64)) * 2.0 ** (np.floor(scale) - scale)
                    lifted = np.concatenate([x, np.sqrt(np.maximum(0, 1 - (x * x).sum(axis=1)))[:, None]], axis=1)
                for tab in range(tables):
                    a, b = _projection(tab, int(dim), hashes, cell, seed)
                    keys = probe_buckets(lifted, a, b, cell, probes) if probes else _bucket_keys(np.floor((lifted @ a + b) / cell))[:, None]
                    which = np.repeat(np.arange(len(x)), keys.shape[1])
                    taken = part.take(pa.array(which))
                    yield pa.RecordBatch.from_arrays(
                        [*[taken.column(c) for c in kept], pa.array(np.full(len(which), tab, np.int32)), pa.array(keys.ravel()),
                         taken.column("cls"), taken.column("vec")], [*kept, "tab", "bucket", "cls", "vec"])

    rows = rows.select("cls", "vec", *kept, *([] if probes else ["scale"]))
    return rows.mapInArrow(hash_rows, f"{', '.join(f'{c} int' for c in kept)}, tab int, bucket long, cls long, vec binary")


def _block_best(q: np.ndarray, q_cls: np.ndarray, x: np.ndarray, x_cls: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, candidate, score) of the ``k`` best candidates of each query; scores are summed row by row."""
    own, other = q / np.abs(q).max(axis=1, keepdims=True), x / np.abs(x).max()
    product = own @ other.T  # in the order of the scores, of any size
    if len(x) > k:
        near = np.argpartition(-product, k - 1, axis=1)[:, :k]
        least = np.take_along_axis(product, near, axis=1).min(axis=1)
        margin = 1e-12 * np.sqrt((own * own).sum(axis=1)) * np.sqrt((other * other).sum(axis=1).max())
        i, j = np.nonzero(product >= (least - margin)[:, None])  # ties at the end stay in
    else:
        i, j = np.nonzero(np.ones_like(product, dtype=bool))
    with np.errstate(over="ignore", invalid="ignore"):
        score = np.sum(q[i] * x[j], axis=1)
        odd = np.flatnonzero(~np.isfinite(score))
        if len(odd):  # infinities of both signs in one sum: add up scaled terms
            a, b = q[i[odd]], x[j[odd]]
            top_a, top_b = np.abs(a).max(axis=1), np.abs(b).max(axis=1)
            score[odd] = np.sum(a / top_a[:, None] * (b / top_b[:, None]), axis=1) * top_a * top_b
    return q_cls[i], x_cls[j], score


def _candidates(index: DataFrame, probes: DataFrame, code: str, k: int) -> DataFrame:
    """Best candidates (query, cls, score) of every visit of a query to a chunk of a bucket, in every band that has it."""
    asked_at = ["dim", "tab", "bucket"]
    keys = ["band", *asked_at]

    def ways(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
        large = rows.groupBy(*keys).agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias(name)).where(F.col(name) > 1)
        return pinned(large, f"ann-{name}")[0]

    split, asked = ways(index, keys, "x_ways"), ways(probes, asked_at, "q_ways")

    def dealt(rows: DataFrame, side: int, own: str, other: str) -> DataFrame:
        rows = rows.join(split, keys, "left").join(asked, asked_at, "left").na.fill(1, ["x_ways", "q_ways"])
        mine = F.pmod(F.xxhash64("cls"), F.col(own)).cast("int")
        return rows.select(*keys, mine.alias(own), F.explode(F.sequence(F.lit(0), F.col(other) - 1)).alias(other),
                           F.lit(side).alias("side"), "cls", "vec")

    parts = [*keys, "x_ways", "q_ways"]
    visits = probes.join(index.select(*keys).distinct(), asked_at)
    met = dealt(index, 0, "x_ways", "q_ways").unionByName(dealt(visits, 1, "q_ways", "x_ways"))
    met = met.repartition(*parts).sortWithinPartitions(*parts, "side")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held = None, ([], [], [], [])

        def result() -> Iterator[pa.RecordBatch]:
            if held[0] and held[2]:
                x, q = _matrix(held[0], code), _matrix(held[2], code)
                found = _block_best(q, np.array(held[3], np.int64), x, np.array(held[1], np.int64), k)
                yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], ["query", "cls", "score"])

        for batch in batches:
            at = list(zip(*(batch.column(c).to_pylist() for c in parts)))
            for here, side, cls, vec in zip(at, *(batch.column(c).to_pylist() for c in ("side", "cls", "vec"))):
                if here != place:
                    yield from result()
                    place, held = here, ([], [], [], [])
                held[2 * side].append(vec)
                held[2 * side + 1].append(cls)
        yield from result()

    return met.mapInArrow(compare, "query long, cls long, score double")


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, tables: int = TABLES, hashes: int = HASHES, cell: float = CELL,
    probes: int = PROBES, seed: int = SEED,
) -> DataFrame:
    """The ``k`` nearest found of every query: query_id, rank (from 1), vec_id, score (inner product).

    ``vectors`` and ``queries`` have vec_id and embedding; a query is no candidate of its own. Null ids,
    and vectors that are null, empty, zero or hold a null or non-finite component, take no part; vectors
    of different lengths never meet. Components may be of any finite size; products beyond doubles are infinite. Rows that repeat an id and its vector count once. Ties go to the
    smaller vec_id. A query gets ``k`` if there are as many.
    """
    value = F.col("embedding").cast("array<double>")
    sound = F.forall(value, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))

    def usable(df: DataFrame) -> DataFrame:
        plain = df.where(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & sound & F.exists(value, lambda v: v != 0))
        # adding 0.0 turns -0.0 into 0.0, so equal vectors have equal bytes
        return plain.select(F.col("vec_id").cast("long").alias("id"), F.transform(value, lambda v: v + 0.0).alias("v")).distinct()

    first_ids = Window.partitionBy("v").orderBy("id")
    ranked = usable(vectors).withColumn("r", F.row_number().over(first_ids)).where(F.col("r") <= k + 1)
    classes = ranked.groupBy("v").agg(F.min("id").alias("cls"), F.sort_array(F.collect_list("id")).alias("members"))
    code = _code(vectors, queries)
    packed = _packed(classes.select("cls", F.size("v").alias("dim"), "v", "members"), code)
    classes = write_stage(packed, "ann-classes")
    asked = write_stage(_packed(usable(queries).select(F.col("id").alias("cls"), F.size("v").alias("dim"), "v"), code), "ann-queries")
    # queries with one vector ask once, under the smallest of their ids
    askers = asked.groupBy("vec").agg(F.min("cls").alias("cls"), F.first("dim").alias("dim"))
    askers = write_stage(askers, "ann-askers")
    index = write_stage(_hashed(_in_bands(classes), code, 0, tables, hashes, cell, seed), "ann-index")

    def found(index: DataFrame, visits: DataFrame) -> DataFrame:
        pairs = _candidates(index, visits, code, k + 1).groupBy("query", "cls").agg(F.max("score").alias("score"))
        best = Window.partitionBy("query").orderBy(F.desc("score"), "cls")
        top = pairs.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
        rows = top.join(classes.select("cls", "members"), "cls").select("query", "score", F.explode("members").alias("vec_id"))
        best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
        rows = rows.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1)
        lists = rows.groupBy("query").agg(F.sort_array(F.collect_list(F.struct("r", "vec_id", "score"))).alias("found"))
        return write_stage(lists, "ann-lists")

    def visits(rows: DataFrame, probes: int) -> DataFrame:
        return write_stage(_hashed(rows, code, probes, tables, hashes, cell, seed), "ann-probes")

    lists = found(index, visits(askers, probes))
    there = classes.groupBy("dim").agg(F.sum(F.size("members")).alias("n"))
    there = pinned(there.select("dim", F.least("n", F.lit(k + 1)).alias("n")), "ann-dims")[0]
    while True:
        counted = lists.select(F.col("query").alias("cls"), F.size("found").alias("n_found"))
        short = askers.join(there, "dim").join(counted, "cls", "left").where(F.coalesce("n_found", F.lit(0)) < F.col("n"))
        short = write_stage(short.select("cls", "dim", "vec"), "ann-short")
        if short.isEmpty():
            break
        probes *= 4
        if probes < 4 * 3 ** hashes:  # there are 3 ** hashes buckets at most to probe
            more = found(index, visits(short, probes))
        else:
            one = {"tab": F.lit(0), "bucket": F.lit(0).cast("long")}
            more = found(classes.select("dim", F.lit(0).alias("band"), "cls", "vec").withColumns(one), short.withColumns(one))
        lists = lists.join(short.select(F.col("cls").alias("query")), "query", "left_anti").unionByName(more)
    named = asked.select(F.col("cls").alias("query_id"), "vec").join(
        askers.select("vec", F.col("cls").alias("query")), "vec").join(lists, "query")
    own = F.filter("found", lambda x: x["vec_id"] != F.col("query_id"))
    return named.select("query_id", F.posexplode(F.slice(own, 1, k)).alias("at", "x")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "x.vec_id", "x.score")


def _code(*frames: DataFrame) -> str:
    """Components travel in single precision if that is how they are given, else in double."""
    single = all(isinstance(df.schema["embedding"].dataType.elementType, T.FloatType) for df in frames)
    return "<f4" if single else "<f8"


def _packed(rows: DataFrame, code: str) -> DataFrame:
    """Column v (array of doubles, not all zero) as ``vec`` (little-endian bytes) with ``size``, the binary logarithm of its norm."""
    @F.arrow_udf("binary")
    def pack(v: pa.Array) -> pa.Array:
        return pa.array([np.asarray(x, code).tobytes() for x in v.to_pylist()], pa.binary())

    top = F.array_max(F.transform("v", F.abs))
    rest = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.col("__top")) * (x / F.col("__top")))
    sized = rows.withColumn("__top", top).withColumn("size", F.log2("__top") + F.log2(rest) / 2)
    return sized.withColumn("vec", pack(F.col("v"))).drop("v", "__top")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours (query_id, vec_id) that were found."""
    hit = exact.join(found, ["query_id", "vec_id"], "left_semi").count()
    return hit / max(1, exact.count())
