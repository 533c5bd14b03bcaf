import collections
import math

import pytest
from cases import docs, empty, odd_rows

from stockcast.llm import mixing, sharding
from stockcast.llm.order import with_positions


def rows_of(spark, n=600, sources=7):
    return [(i, f"w{i} " * (1 + i * i % 41), "en", f"s{min(i % (2 * sources), sources)}", 0) for i in range(n)]


def test_positions_are_gapless_in_order(spark):
    df = spark.createDataFrame([(i % 3, i // 50, (i * 37) % 300) for i in range(300)], "k int, b long, v int")
    got = with_positions(df.withColumn("b", ((df.v - df.v % 50) / 50).cast("long")), ["k"], "b", ["v"]).collect()
    for k in range(3):
        own = sorted((r.position, r.v) for r in got if r.k == k)
        assert [p for p, _ in own] == list(range(100)) and [v for _, v in own] == sorted(v for _, v in own)
        assert {r.group_rows for r in got if r.k == k} == {100}


def test_shards_match_the_mixture(spark):
    got = sharding.shard_documents(docs(spark, rows_of(spark), clashes=False)).collect()
    counts = collections.Counter(r.shard for r in got)
    assert set(counts.values()) == {75} and len(got) == 600
    source = {r[0]: r[3] for r in rows_of(spark)}
    total = collections.Counter(source.values())
    for shard in range(8):
        own = collections.Counter(source[r.doc_id] for r in got if r.shard == shard)
        assert all(abs(own[s] - total[s] / 8) <= 2 for s in total)
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(75))


def test_shards_do_not_depend_on_partitioning(spark):
    df = docs(spark, rows_of(spark), clashes=False)
    first, second = (sorted(map(tuple, sharding.shard_documents(d).collect())) for d in (df, df.repartition(5)))
    assert first == second


def test_shards_of_odd_and_empty_rows(spark):
    got = sharding.shard_documents(docs(spark)).collect()
    assert len(got) == len(odd_rows())
    assert sorted(r.size for r in got if r.doc_id in (2, 3)) == [1, 1]
    counts = collections.Counter(r.shard for r in got)
    assert max(counts.values()) - min(counts.get(s, 0) for s in range(8)) <= 1
    assert sharding.shard_documents(empty(spark)).count() == 0


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, cap=2.0):
    """Reshare by weight, again and again, what sources at their cap leave."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        rest = budget - sum(cap * sizes[s] for s in full)
        free = sum(weight[s] for s in names if s not in full)
        target = {s: cap * sizes[s] if s in full else rest * weight[s] / free for s in names}
        over = {s for s in names if s not in full and target[s] > cap * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_and_copies(spark):
    rows = [*rows_of(spark), (900, "one two three", "en", None, 0), (901, "", "en", "void", 0)]
    got = mixing.copies_per_document(mixing.sized_rows(docs(spark, rows, clashes=False))).collect()
    sizes = collections.Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(text.split())
    want, taken = brute_targets(sizes), collections.Counter()
    assert len(got) == len(rows)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
        assert 0 <= r.copies <= 2
        rate = want[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert math.floor(rate) <= r.copies <= math.ceil(rate)
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - want[s]) <= 45 for s in sizes if s is not None)


def test_rounding_keeps_expected_copies(spark):
    """Over many seeds every document is taken as often as its source's rate says."""
    rows = [(i, "a b c " * (1 + i % 3), "en", "x" if i % 3 else "y", 0) for i in range(40)]
    sized = mixing.sized_rows(docs(spark, rows, clashes=False))
    sums, runs = collections.Counter(), 25
    for seed in range(runs):
        for r in mixing.copies_per_document(sized, seed=seed).collect():
            sums[r.doc_id] += r.copies
            rate = r.target / r.source_size
    mean = {i: n / runs for i, n in sums.items()}
    assert sum(mean.values()) / 40 == pytest.approx(1.5, abs=0.25)
    assert all(0.2 < m < 2.01 for m in mean.values()), (mean, rate)


def test_mixed_documents(spark):
    df = docs(spark)
    a, b = (sorted(map(str, mixing.mix_documents(d).collect())) for d in (df, df.repartition(3)))
    assert a == b and mixing.mix_documents(df).columns == df.columns
    copies = mixing.copies_per_document(mixing.sized_rows(df)).collect()
    assert len(copies) == len(odd_rows()) and sum(r.copies for r in copies) == len(a)
    assert mixing.mix_documents(empty(spark)).count() == 0
