import random

import numpy as np
import xxhash
from cases import docs, empty, odd_rows

from stockcast.llm import simhash
from stockcast.llm.components import roots


def brute_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def brute_components(ids, fps, radius=2):
    parent = list(range(len(ids)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= radius:
                parent[find(i)] = find(j)
    least = {}
    for i, doc in enumerate(ids):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(ids))]


def near_rows():
    rng = random.Random(5)
    rows = []
    for g in range(12):
        words = [f"v{rng.randrange(400)}" for _ in range(120)]
        for _ in range(6):
            copy = list(words)
            for _ in range(rng.randrange(3)):
                copy[rng.randrange(len(copy))] = "changed"
            rows.append((len(rows), " ".join(copy), "en", "a", 0))
    return rows + [(1000 + i, f"lonely text number {i} about {i * 7}", "en", "b", 0) for i in range(30)]


def check(spark, rows, **options):
    got = simhash.near_duplicates(docs(spark, rows, clashes=False), **options).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = sorted(zip([r[0] or -1 for r in rows], fps, [c if c is not None else -1 for c in brute_components([r[0] for r in rows], fps)]))
    assert sorted((r.doc_id or -1, r.fp % (1 << 64), -1 if r.component_id is None else r.component_id) for r in got) == want


def test_groups_match_brute_force(spark):
    check(spark, near_rows())


def test_small_tiles_change_nothing(spark):
    check(spark, near_rows(), tile=3)


def test_odd_rows(spark):
    check(spark, odd_rows())
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_tile_links_span_all_links():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    a, b = base ^ np.uint64(1), base ^ np.uint64(6)
    nodes, heads = simhash.tile_links(a, b, 3)
    assert len(nodes) == 40 and all(bin(int(x) ^ int(y)).count("1") <= 3 for x, y in zip(nodes, heads))


def test_roots_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (-7, 500)], "a long, b long")
    got = {r.node: r.root for r in roots(links).collect()}
    assert got == {**{i: 0 for i in range(1, 201)}, 500: -7, 501: -7}
    assert roots(links.limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [*near_rows(), *odd_rows(), (0, near_rows()[0][1], "en", "a", 0)]
    df = docs(spark, rows)
    kept = simhash.one_per_group(df)
    assert kept.columns == df.columns
    got = kept.collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    groups = set(brute_components(list(range(len(rows))), fps))
    assert len(got) == len(groups)
    named = {c for c in brute_components([r[0] for r in rows], fps) if c is not None}
    assert {r.doc_id for r in got if r.doc_id is not None} == named
    assert simhash.one_per_group(empty(spark)).count() == 0
