"""Periodic runs against a brute-force search over all starts and periods."""

import collections
import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import docs, empty, odd_rows

from stockcast.llm import periodic_runs, queries


def brute_runs(words, min_words=24, min_repeats=3):
    """Every stretch that keeps a period q and cannot be extended, with q its smallest period."""
    best = {}
    for q in range(1, len(words) // min_repeats + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            length = end - at + q
            if end > at and length >= max(min_words, min_repeats * q):
                best.setdefault((at, length), q)  # the first one found has the smallest period
            at = end + 1
    return sorted((start, length, q) for (start, length), q in best.items())


def brute_row(doc_id, text):
    words = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    top = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *top, None if not runs else 1000 * top[1] // top[2],
            hashlib.sha256("".join(f"{s},{length},{q}\n" for s, length, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in gone)).hexdigest())


def random_words(rng):
    kind = rng.random()
    if kind < 0.3:
        return [rng.randrange(2) for _ in range(rng.randrange(60))]
    out = []
    for _ in range(rng.randrange(1, 5)):
        block = [rng.randrange(rng.choice([1, 2, 3, 9])) for _ in range(rng.randrange(1, 12))]
        whole = block * rng.randrange(1, 7)
        out += whole[:len(whole) - rng.randrange(len(block))]
    return out


@pytest.mark.parametrize("shape", [(24, 3), (4, 2), (7, 3), (11, 2), (2, 2), (30, 5)])
def test_runs_of_many_texts_at_once(shape):
    rng = random.Random(repr(shape))
    texts = [random_words(rng) for _ in range(400)]
    found = periodic_runs.runs_of(np.array([w for t in texts for w in t], np.int64), [len(t) for t in texts], *shape)
    assert found == [sorted(brute_runs(t, *shape), key=lambda r: (r[0], r[2])) for t in texts]
    assert sum(map(len, found)) > 50


def test_long_texts():
    same = np.zeros(50_000, np.int64)
    assert periodic_runs.runs_of(same, [50_000]) == [[(0, 50_000, 1)]]
    period = np.tile(np.arange(700), 100)[:69_999]
    assert periodic_runs.runs_of(period, [69_999]) == [[(0, 69_999, 700)]]
    blocks = np.concatenate([np.tile(np.array([7, 8, 9]), 300), [1], np.tile(np.array([7, 8, 9]), 300), [2], np.arange(3_000)])
    assert periodic_runs.runs_of(blocks, [len(blocks)]) == [[(0, 900, 3), (901, 900, 3)]]


def test_find_runs_on_odd_rows(spark):
    rows = odd_rows() + [(20, "a b c " * 9 + "end", "en", "a", 58), (20, "a b c " * 9 + "end", "en", "a", 58)]
    got = periodic_runs.find_runs(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = collections.defaultdict(set)
    for r in got:
        by_id[r.doc_id].add((r.n_words, tuple(map(tuple, r.runs)), r.collapsed))
    assert by_id[20] == {(28, ((0, 27, 3),), "a b c end")}
    assert by_id[2] == {(0, (), "")} and by_id[3] == {(0, (), "")}
    assert periodic_runs.find_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        periodic_runs.find_runs(docs(spark), min_repeats=1)


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = odd_rows()[:5] + [(i, " ".join(f"w{w}" for w in random_words(rng)), "en", "a", 0) for i in range(100, 400)]
    docs(spark, rows, clashes=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in queries.op12_kruskal_runs(spark, str(tmp_path)).select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256").collect()]
    want = [brute_row(r[0], r[1]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert sum(r[1] for r in want) > 100


def test_query_over_whole_table(spark):
    folder = "/root/testdata/sf0.001"
    texts = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    short = {r.doc_id: brute_row(r.doc_id, r.text) for r in texts if len(r.text or "") < 20_000}
    got = {r.doc_id: r for r in queries.op12_kruskal_runs(spark, folder).collect()}
    assert len(got) == len(texts)
    for doc_id, want in short.items():
        assert tuple(got[doc_id]) == want
