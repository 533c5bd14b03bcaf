import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from cases import PASSAGE, docs, empty, odd_rows

from stockcast.llm import suffix_dedup
from stockcast.llm.induced_sort import BucketQueue, s_types, suffixes


@pytest.mark.parametrize("memory", [3, 7, 1_000])
def test_suffix_array_and_prefix_lengths(memory):
    """Small bounds force spilled queues, files for arrays and recursion."""
    rng = np.random.default_rng(4)
    for trial in range(60):
        text = rng.integers(1, rng.integers(2, 6), rng.integers(1, 70))
        text = np.append(np.tile(text, 3) if trial % 3 == 0 else text, 0).astype(np.uint8)
        raw = text.tobytes()
        whole = np.concatenate([p for p, _ in suffixes(text, 8, 0, memory)])
        assert whole.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        parts = list(suffixes(text, 8, 9, memory))
        order, lcp = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        assert sorted(order) == list(range(len(raw)))
        for i, j, n in zip(order, order[1:], lcp[1:]):
            a, b = raw[i:i + 9], raw[j:j + 9]
            assert a <= b and n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


def test_queue_keeps_order_when_it_spills():
    queue = BucketQueue(4)
    for i in range(20):
        queue.push(i % 2, np.array([i, i + 100]), np.array([1, 2], np.uint8))
    got = np.concatenate([p for p, _ in queue.drain(0)])
    assert got.tolist() == [x for i in range(0, 20, 2) for x in (i, i + 100)]
    assert queue.last(1) == 119
    assert np.concatenate([p for p, _ in queue.drain_back(1)]).tolist() == [x for i in range(19, 0, -2) for x in (i + 100, i)]


def test_types():
    text = np.array([2, 1, 1, 2, 2, 1, 0])
    assert s_types(text, 2).tolist() == s_types(text, 100).tolist() == [False, True, True, False, False, False, True]


def brute(rows, window=50):
    first = {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    key = lambda i: float("inf") if rows[i][0] is None else rows[i][0]
    for i in order:
        raw = (rows[i][1] or "").encode()
        for p in range(len(raw) - window + 1):
            first.setdefault(raw[p:p + window], key(i))
    out = []
    for i, row in enumerate(rows):
        raw = (row[1] or "").encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - window + 1):
            if first[raw[p:p + window]] < key(i):
                gone[p:p + window] = True
        kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((row[0] or -1, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def shared_rows():
    rng = random.Random(8)
    words = [f"{rng.choice('abcdefg')}{rng.choice('aeiou')}{rng.choice('klmnst')}{rng.randrange(30)}" for _ in range(300)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passages = [text(rng.randrange(10, 40)) for _ in range(6)]
    rows = []
    for i in range(90):
        parts = [text(rng.randrange(2, 30)) for _ in range(3)]
        if i % 2:
            parts.insert(1, rng.choice(passages)[rng.randrange(5):])
        rows.append((1000 - 7 * i, " ".join(parts), "en", "a", 0))
    rows += [(5_000 + i, "x" * (45 + 3 * i), "en", "a", 0) for i in range(6)] + [(6_000, rows[3][1], "en", "a", 0), (6_000, rows[3][1], "en", "a", 0)]
    return rows + [(7_000, "é" * 60, "fr", "b", 0), (7_001, "aé" * 60, "fr", "b", 0), (7_002, "ab" * 60, "fr", "b", 0), (7_003, "ab" * 90, "fr", "b", 0)]


@pytest.mark.parametrize("batch, memory", [(1 << 23, 1 << 22), (3_000, 500)])
def test_removal_matches_brute_force(spark, monkeypatch, batch, memory):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", batch)
    rows = [*shared_rows(), *[r for r in odd_rows() if r[0] != 6]]
    got = suffix_dedup.removal_report(docs(spark, rows).repartition(3), memory).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows)


def test_hot_passage_is_split(spark, monkeypatch, tmp_path):
    """The ends of a passage in all documents give one distinct segment each; no shard may get them all."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 20_000)
    monkeypatch.setattr(suffix_dedup, "SHARD_BYTES", 16_384)
    rng = random.Random(5)
    own = lambda n: "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))
    rows = [(i, f"{own(60)}{PASSAGE}{own(60)}", "en", "a", 0) for i in range(400)]
    rows += [(1_000 + i, own(rng.randrange(30)) + "=" * (60 + 5 * i), "en", "a", 0) for i in range(100)]
    df = docs(spark, rows).repartition(3)
    _, made, _, n_shards = suffix_dedup.shared_segments(df, f"file://{tmp_path}/files")
    texts = {}
    for row in made.where(f"kind = {suffix_dedup.SEGMENTS}").collect():
        texts.setdefault(row.shard, set()).update(suffix_dedup._unpack(row.body)[1:])
    assert n_shards > 4 and max(sum(map(len, t)) for t in texts.values()) < 16_384
    got = suffix_dedup.removal_report(df).collect()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == brute(rows)


def test_texts_without_repeats(spark):
    df = docs(spark)
    cut = suffix_dedup.without_repeats(df)
    assert cut.columns == df.columns
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got[9] == f"begin {PASSAGE} end" and got[10] == "another startand end"
    assert got[2] is None and got[3] == "" and cut.count() == df.count()
    assert suffix_dedup.without_repeats(empty(spark)).count() == 0
    assert suffix_dedup.removal_report(empty(spark)).count() == 0


@pytest.mark.parametrize("memory", [5, 1_000])
def test_only_wanted_suffixes_are_induced(memory):
    """Wanted ones come in order, with lengths by the suffix that comes before; other ones are mostly left out."""
    rng = np.random.default_rng(9)
    for _ in range(60):
        pieces = [rng.integers(2, rng.integers(4, 7), rng.integers(9, 40)).astype(np.uint8) for _ in range(rng.integers(1, 6))]
        text = np.concatenate([*[np.append(p, 1) for p in pieces], [0]]).astype(np.uint8)
        wanted = np.concatenate([*[np.arange(len(p) + 1) < len(p) - 8 for p in pieces], [False]])
        raw = text.tobytes()
        parts = list(suffixes(text, 8, 9, memory, wanted))
        order, lcp = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
        assert len(set(order.tolist())) == len(order) and set(np.flatnonzero(wanted)) <= set(order.tolist())
        for i, j, n in zip(order, order[1:], lcp[1:]):
            a, b = raw[i:i + 9], raw[j:j + 9]
            assert a <= b and n == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    text = np.append(np.tile([2, 3], 500), [1, 0]).astype(np.uint8)
    assert sum(len(p) for p, _ in suffixes(text, 8, 9, memory, np.arange(len(text)) < 20)) < 40


def test_single_windows_of_split_values_are_not_sorted(monkeypatch):
    """In a shard of split values a window that one distinct segment has is nowhere else; only others are sorted."""
    sorted_ones = []
    real = suffix_dedup.covered_elsewhere
    monkeypatch.setattr(suffix_dedup, "covered_elsewhere", lambda s, *rest: sorted_ones.extend(s) or real(s, *rest))
    rng = random.Random(3)
    single = [bytes(rng.choices(b"abcdef ", k=50)) for _ in range(40)]
    twice = [b"=" * 53, b"=" * 60]
    runs = suffix_dedup.covered_in_shard([*single, *twice], np.array([*range(5, 45), 9, 4]), False, 1_000)
    assert sorted_ones == twice and runs == [[]] * 40 + [[(0, 4)], []]


@pytest.mark.parametrize("block", [7, 1 << 15])
def test_segments_do_not_depend_on_blocks(monkeypatch, block):
    monkeypatch.setattr(suffix_dedup, "BLOCK", block)
    rng = random.Random(11)
    texts = ["".join(rng.choices("abcd ", k=rng.choice([0, 49, 50, 51, 200]))) for _ in range(30)] + ["z" * 300, "", "é" * 60]
    batch = suffix_dedup.Batch(pa.table({"doc_id": pa.array(range(len(texts))), "text": texts}), 1, 0)
    got = list(zip(*(c.tolist() for c in batch.segments())))
    expected, raws = [], [t.encode() for t in texts]
    for d, (raw, at) in enumerate(zip(raws, np.cumsum([0, *map(len, raws)]).tolist())):
        for p in range(len(raw) - 49):
            value = int(suffix_dedup.least_grams(np.frombuffer(raw[p:p + 50], np.uint8))[0])  # of this window alone
            if p and expected[-1][0] == value:
                expected[-1][3] += 1
            else:
                expected.append([value, d, at + p, 1])
    assert got == [tuple(e) for e in expected]
