"""Whitening against plain numpy and exact integers."""

import math
import random

import numpy as np
import pytest

from stockcast.llm import queries, whitening

SCHEMA = "vec_id long, embedding array<double>, n long, x string, whitened int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], SCHEMA)


def integers(vector):
    return [1024 * a // b + 100_000 for a, b in (float(c).as_integer_ratio() for c in vector)]


def brute(vectors, components=8):
    x = [integers(v) for v in vectors]
    n, d = len(x), len(x[0])
    s = [sum(r[i] for r in x) for i in range(d)]
    scatter = [[n * sum(r[i] * r[j] for r in x) - s[i] * s[j] for j in range(d)] for i in range(d)]
    e, v = np.linalg.eigh(np.array(scatter, float) / n / n)
    order = np.argsort(-e)[:components]
    deviation = [sum((n * a - t) ** 2 for a, t in zip(r, s)) for r in x]
    white = (np.array(x, float) - np.array(s) / n) @ v[:, order] / np.sqrt(e[order])
    return deviation, white, e[order] / e.sum()


@pytest.mark.parametrize("top", [1, 2, 1_000, 1 << 20, 1 << 31])
def test_cross_products_are_exact(top):
    rng = np.random.default_rng(top)
    x = rng.integers(0, top, (129, 5))
    x[:, 2] = 0
    want = [[sum(int(a) * int(b) for a, b in zip(x[:, i], x[:, j])) for j in range(5)] for i in range(5)]
    assert whitening.cross_products(x) == want
    assert whitening.cross_products(x[:1]) == [[int(a) * int(b) for b in x[0]] for a in x[0]]


def test_against_brute_force(spark):
    rng = np.random.default_rng(3)
    vectors = (rng.normal(size=(500, 12)) * np.linspace(3, 0.1, 12)).tolist()
    rows = [(i, v) for i, v in enumerate(vectors)]
    bad = [(900, None), (901, []), (902, [float("nan")] * 12), (903, [None] * 12), (904, [float("inf")] + [0.0] * 11), (905, [1.0, 2.0])]
    got = {r.vec_id: r for r in whitening.whiten(frame(spark, rows + bad)).collect()}
    deviation, white, shares = brute(vectors)
    assert set(got) == set(range(500))
    for i in range(500):
        assert got[i].n == 500 and got[i].deviation == deviation[i] and got[i].identity_error < 1e-9
        assert np.allclose(got[i].explained, shares, rtol=1e-9)
    found = np.array([got[i].whitened for i in range(500)])
    assert np.allclose(found * np.sign(found[0]) * np.sign(white[0]), white, atol=1e-7)


def test_entries_of_any_size(spark):
    rng = random.Random(2)
    for size in (1e9, 1e200):
        vectors = [[rng.gauss(0, 1) * (size if rng.random() < 0.3 else 1.0) for _ in range(3)] for _ in range(60)]
        got = sorted(whitening.whiten(frame(spark, list(enumerate(vectors)))).collect(), key=lambda r: r.vec_id)
        x = [integers(v) for v in vectors]
        sums = [sum(r[i] for r in x) for i in range(3)]
        for r, own in zip(got, x):
            exact = sum((60 * a - t) ** 2 for a, t in zip(own, sums))
            assert r.deviation == (exact if exact < 1 << 63 else None)
        assert got[0].identity_error < 1e-9 and math.isclose(sum(got[0].explained), 1, rel_tol=1e-9)
        assert all(math.isfinite(v) for r in got for v in r.whitened)


def test_defined_results_of_odd_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None)])).count() == 0
    same = whitening.whiten(frame(spark, [(1, [0.5, 0.25]), (1, [0.5, 0.25]), (None, [0.5, 0.25])])).collect()
    assert len(same) == 3
    assert all(r.deviation == 0 and r.whitened == [None, None] and r.explained == [None, None] and r.identity_error is None for r in same)
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(5)])).collect()
    assert all(r.whitened[0] is not None and r.whitened[1] is None and r.identity_error < 1e-9 for r in line)


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()}
    ids = sorted(vectors)
    got = queries.op11_bit_sliced_whitening(spark, folder).collect()
    assert len(got) == 8 * len(ids) and {r.component for r in got} == set(range(1, 9))
    deviation, white, shares = brute([vectors[i] for i in ids])
    at = {v: i for i, v in enumerate(ids)}
    sign = {r.component: np.sign(r.whitened) * np.sign(white[0][r.component - 1]) for r in got if r.vec_id == ids[0]}
    for r in got:
        assert r.n == len(ids) and r.deviation == deviation[at[r.vec_id]] and r.identity_error < 1e-4
        assert math.isclose(r.explained, shares[r.component - 1], rel_tol=1e-9)
        assert abs(r.whitened * sign[r.component] - white[at[r.vec_id]][r.component - 1]) < 1e-6
