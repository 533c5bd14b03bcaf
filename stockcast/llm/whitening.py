"""Whitening of vectors by an exact integer covariance, counted in bit slices.

Every entry c becomes the integer x = floor(1024 c) + 100000. Less the smallest of its dimension, x is a small number that is
not negative; bit b of it over 64 rows is one machine word. The sum of x_i x_j over rows is then the sum of
2^(a+b) popcount(plane_ia AND plane_jb) over all pairs of bits: counts only, so exact at any size. Sums
of all tasks are added as decimals per pair of dimensions, centred as integers (n C - S S^T), and only the finished
matrix, which grows with the dimensions alone, becomes floating point for its eigenvectors.

Rows with an entry too far from the others for bit planes are rare by nature, but may be any share of a table: their
products are added as integers of any length, in limbs, beside the planes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from stockcast.session import write_stage

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
ROWS_AT_ONCE = 8_192     # rows whose planes are counted together
PLANE_LIMIT = 1 << 31    # entries of larger size are left to the integers of any length
LIMB = 10 ** 18
LONG_MAX = (1 << 63) - 1


def to_integers(vectors: np.ndarray) -> np.ndarray | None:
    """x of a matrix of doubles as 64-bit integers; None if an entry does not fit bit planes."""
    if vectors.size and not (np.abs(vectors) < PLANE_LIMIT / SCALE / 2).all():
        return None
    return np.floor(SCALE * vectors).astype(np.int64) + OFFSET


def exact_integers(vector: list[float]) -> list[int]:
    """x of one vector, of any length: a double is a fraction with a power of two below."""
    out = []
    for c in vector:
        top, bottom = float(c).as_integer_ratio()
        out.append(SCALE * top // bottom + OFFSET)
    return out


def bit_planes(x: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Planes (bit and dimension, words) of a matrix that is not negative, and each dimension's number of bits."""
    words = -(-len(x) // 64)
    padded = np.zeros((64 * words, x.shape[1]), np.int64)
    padded[:len(x)] = x
    bits = [int(m).bit_length() for m in x.max(axis=0, initial=0)]
    planes = [
        np.packbits((padded[:, i] >> b & 1).astype(np.uint8)).view(np.uint64) for i, n in enumerate(bits) for b in range(n)]
    return np.array(planes, np.uint64).reshape(-1, words), bits


def cross_products(x: np.ndarray) -> list[list[int]]:
    """Exact sums of x_i x_j over the rows, as Python integers, from AND-popcounts of the planes."""
    d = x.shape[1]
    total = np.zeros((d, d), object)
    planes, bits = bit_planes(x)
    if not len(planes):
        return total.tolist()
    counts = np.zeros((len(planes), len(planes)), np.int64)
    for p in range(len(planes)):
        counts[p, p:] = np.bitwise_count(planes[p:] & planes[p]).sum(axis=1, dtype=np.int64)
    counts += np.triu(counts, 1).T
    # weighted sums per pair of dimensions; beyond 63 bits with integers of any length
    fits = 2 * max(bits) + len(x).bit_length() < 63
    weights = np.array([1 << b for n in bits for b in range(n)], np.int64 if fits else object)
    weighted = counts * weights[:, None] * weights
    used = [i for i, n in enumerate(bits) if n]
    first = np.cumsum([0, *(bits[i] for i in used)])[:-1]
    total[np.ix_(used, used)] = np.add.reduceat(np.add.reduceat(weighted, first, axis=0), first, axis=1)
    return total.tolist()


@dataclass(frozen=True)
class Fitted:
    """n, exact sums S of x, exact n C - S S^T, and the first components by falling eigenvalue of V."""

    n: int
    sums: list[int]
    scatter: list[list[int]]
    components: np.ndarray        # rows are unit eigenvectors
    roots: list[float | None]     # of the eigenvalues; None without spread
    shares: list[float | None]    # eigenvalues over the trace; None if that is zero


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, x) of rows that take part: a vector with entries, none of them null or not finite, and of the length most such rows have.

    The most frequent length counts (the longer one if two are as frequent).
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"))
    rows = rows.where("size(x) > 0 AND forall(x, c -> c IS NOT NULL AND NOT isnan(c) AND abs(c) < double('infinity'))")
    lengths = rows.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    most = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return rows.where(F.size("x") == (most["d"] if most else 0))


def _matrix(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _chunks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        yield part, _matrix(part, dims)


def _split_wide(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Integers of the rows that fit bit planes, and the numbers of those that do not."""
    wide = ~(np.abs(vectors) < PLANE_LIMIT / SCALE / 2).all(axis=1)
    return to_integers(vectors[~wide]), np.flatnonzero(wide)


def fit(rows: DataFrame, components: int = COMPONENTS) -> Fitted | None:
    """Fit ``usable`` rows (a written table, read once here); None without rows."""
    head = rows.select(F.size("x")).first()
    if head is None:
        return None
    dims = head[0]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, products = 0, [0] * dims, [[0] * dims for _ in range(dims)]

        def add(sums: list[int], crossed: list[list[int]]) -> None:
            for i in range(dims):
                total[i] += sums[i]
                for j in range(i, dims):
                    products[i][j] += crossed[i][j]

        for batch in batches:
            for _, vectors in _chunks(batch, dims):
                n += len(vectors)
                x, wide = _split_wide(vectors)
                if len(x):
                    low = x.min(axis=0)
                    shifted = x - low
                    least, part = low.tolist(), shifted.sum(axis=0).tolist()
                    crossed, k = cross_products(shifted), len(x)
                    # back from shifted to whole numbers: (y_i + l_i)(y_j + l_j)
                    add([s + k * m for s, m in zip(part, least)], [
                        [crossed[i][j] + least[i] * part[j] + least[j] * part[i] + k * least[i] * least[j] for j in range(dims)]
                        for i in range(dims)])
                for at in wide.tolist():
                    own = exact_integers(vectors[at].tolist())
                    add(own, [[a * b for b in own] for a in own])
        if not n:
            return
        cells = [(-1, -1, n)] + [(i, -1, s) for i, s in enumerate(total)] + [
            (i, j, products[i][j]) for i in range(dims) for j in range(i, dims)]
        out: list[tuple[int, int, int, int]] = []
        for i, j, value in cells:
            sign, value, limb = (-1 if value < 0 else 1), abs(value), 0
            while value or not limb:
                value, rest = divmod(value, LIMB)
                out.append((i, j, limb, sign * rest))
                limb += 1
        columns = list(zip(*out))
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[k], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.int64()))], ["i", "j", "limb", "part"])

    parts = rows.select("x").mapInArrow(sums, "i int, j int, limb int, part long")
    added = parts.groupBy("i", "j", "limb").agg(F.sum(F.col("part").cast("decimal(38,0)")).alias("part")).collect()
    cell: dict[tuple[int, int], int] = {}
    for r in added:
        cell[r["i"], r["j"]] = cell.get((r["i"], r["j"]), 0) + int(r["part"]) * LIMB ** r["limb"]
    n = cell[-1, -1]
    total = [cell[i, -1] for i in range(dims)]
    scatter = [[n * cell[min(i, j), max(i, j)] - total[i] * total[j] for j in range(dims)] for i in range(dims)]
    return Fitted(n, total, scatter, *_eigen(n, scatter, components))


def _eigen(n: int, scatter: list[list[int]], components: int) -> tuple[np.ndarray, list[float | None], list[float | None]]:
    """Unit eigenvectors, roots of the eigenvalues of scatter / n^2, and their shares of the trace.

    Large matrices are divided by a power of four first, whose root is given back to the roots. Of an eigenvector
    and its opposite, the one whose largest entry is positive counts.
    """
    size = max((abs(v) for row in scatter for v in row), default=0)
    half = max(0, size.bit_length() - 500) // 2
    scaled = np.array([[float(v >> 2 * half) for v in row] for row in scatter])
    values, vectors = np.linalg.eigh(scaled)
    order = np.argsort(-values, kind="stable")[:components]
    chosen, values = vectors[:, order].T.copy(), values[order]
    for row in chosen:
        if row[np.argmax(np.abs(row))] < 0:
            row *= -1
    least = 8 * len(scatter) * np.finfo(float).eps * max(0.0, float(values[0]))
    roots = [_ratio(int(np.sqrt(v) * 2.0 ** 52) << half, n << 52) if v > least else None for v in values]
    trace = float(np.trace(scaled))
    return chosen, roots, [float(v) / trace if trace > 0 else None for v in values]


def _ratio(a: int, b: int) -> float:
    """a / b of integers of any length, rounded once; infinite beyond the range of doubles."""
    try:
        return a / b
    except OverflowError:
        return float("inf") if a > 0 else float("-inf")


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, whitened (array), explained (array) and identity_error of every usable row.

    ``whitened[k]`` is x - S/n on component k over the root of its eigenvalue, ``explained[k]`` the eigenvalue's share of the trace,
    ``deviation`` the exact sum of (n x - S)^2 over dimensions, and ``identity_error`` how far the
    covariance of all whitened values is from the identity at most. Vectors that are null, empty, hold nulls or
    non-finite entries, or are not as long as most, take no part. There are as many components as dimensions, if
    fewer. A component without spread (an eigenvalue of zero at double precision, as with equal rows) has NULL
    as whitened value and is left out of ``identity_error``, which is NULL if no component has any; a trace of
    zero makes ``explained`` NULL; a deviation beyond 64 bits is NULL. Repeated rows count each; ids may be null.
    An empty table gives an empty one. Other columns are ignored.
    """
    schema = "vec_id long, n long, deviation long, whitened array<double>, explained array<double>"
    rows = write_stage(usable(vectors, id_col, vector_col), "vectors")
    fitted = fit(rows, components)
    if fitted is None:
        return vectors.sparkSession.createDataFrame([], schema + ", identity_error double")
    n, total, dims, share = fitted.n, fitted.sums, len(fitted.sums), fitted.shares
    roots = np.array([np.nan if r is None else r for r in fitted.roots])

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, values in _chunks(batch, dims):
                deviations: list[int | None] = [None] * len(values)
                centred = np.zeros(values.shape)
                x, wide = _split_wide(values)
                fits = np.setdiff1d(np.arange(len(values)), wide)
                if len(x):
                    bound = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, total))
                    if dims * bound * bound <= LONG_MAX:
                        off = n * x - np.array(total, np.int64)
                        exact = (off * off).sum(axis=1).tolist()
                    else:
                        off = n * x.astype(object) - np.array(total, object)
                        exact = (off * off).sum(axis=1).tolist()
                    centred[fits] = off.astype(float) / n
                    for at, v in zip(fits.tolist(), exact):
                        deviations[at] = v
                for at in wide.tolist():
                    own = [n * a - s for a, s in zip(exact_integers(values[at].tolist()), total)]
                    centred[at] = [_ratio(a, n) for a in own]
                    deviations[at] = sum(a * a for a in own)
                flat = (centred @ fitted.components.T / roots).ravel()
                k = len(roots)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": part.column("vec_id"), "n": pa.array(np.full(len(values), n, np.int64)),
                    "deviation": pa.array([v if v is not None and v <= LONG_MAX else None for v in deviations], pa.int64()),
                    "whitened": pa.ListArray.from_arrays(
                        pa.array(np.arange(len(values) + 1, dtype=np.int32) * k), pa.array(flat, mask=~np.isfinite(flat))),
                    "explained": pa.array([share] * len(values), pa.list_(pa.float64()))})

    out = write_stage(rows.mapInArrow(apply, schema), "whitened")
    known = [i for i, r in enumerate(fitted.roots) if r is not None]
    gaps = [F.abs(F.covar_pop(F.get("whitened", F.lit(i)), F.get("whitened", F.lit(j))) - F.lit(float(i == j)))
            for i in known for j in known if i <= j]
    error = F.array_max(F.array(*gaps)) if gaps else F.lit(None).cast("double")
    return out.withColumn("identity_error", F.lit(out.agg(error.alias("e")).first()["e"]).cast("double"))
