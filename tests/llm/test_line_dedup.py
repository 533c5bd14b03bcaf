"""Line deduplication against a brute-force version."""

import hashlib
import random

import numpy as np
from cases import docs, empty, odd_rows

from stockcast.llm import line_dedup, queries

LAST = line_dedup.LAST_ID


def brute(rows, min_chars=10):
    first = {}
    ids = [LAST if r[0] is None else r[0] for r in rows]
    keys = [[line.strip(b" \t\n\x0b\x0c\r").lower() for line in (r[1] or "").encode().split(b"\n")] for r in rows]
    for doc_id, own in zip(ids, keys):
        for k in own:
            first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for r, doc_id, own in zip(rows, ids, keys):
        gone = [len(k.decode()) >= min_chars and first[k] < doc_id for k in own]
        left = b"\n".join(line for line, g in zip((r[1] or "").encode().split(b"\n"), gone) if not g)
        out.append((r[0], len(own), sum(gone), left.decode()))
    return out


def line_rows(seed=4):
    rng = random.Random(seed)
    pool = [f"{'ÄÖÜé'[i % 4] * (i % 5)} Shared line number {i}" if i % 3 else f"short {i}" for i in range(60)]
    pool += ["ääääääääää", "äääääääää", "0123456789", "012345678"]
    rows = []
    for i in range(300):
        lines = []
        for _ in range(rng.randrange(12)):
            line = rng.choice(pool) if rng.random() < 0.5 else f"own line {rng.random()}"
            lines.append(rng.choice(["", " ", "\t", "\x0b"]) + (line.upper() if rng.random() < 0.2 and line.isascii() else line) + rng.choice(["", "\r", "  "]))
        rows.append((rng.choice([i, i, i, 7, None]), "\n".join(lines) if rng.random() < 0.95 else None, "en", "a", 0))
    return rows


def same(got, want):
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))


def test_against_brute_force(spark):
    rows = line_rows() + odd_rows()
    want = brute(rows)
    assert sum(r[2] for r in want) > 300
    frame = docs(spark, rows).repartition(6)
    same(line_dedup.line_report(frame).collect(), want)
    same(line_dedup.line_report(frame, shard_keys=64).collect(), want)  # many shards of the filters
    same(line_dedup.line_report(frame, shard_keys=256, batch_bytes=500).collect(), want)  # and many batches
    same(line_dedup.line_report(frame, min_chars=1).collect(), brute(rows, 1))


def test_all_columns_stay(spark):
    rows = line_rows(9) + odd_rows()
    frame = docs(spark, rows)
    got = line_dedup.drop_repeated_lines(frame)
    assert got.columns == frame.columns
    want = [(r[0], None if r[1] is None else left) for r, (_, _, _, left) in zip(rows, brute(rows))]
    same(got.select("doc_id", "text").collect(), want)
    clash = docs(spark, odd_rows()).withColumnsRenamed({"size": "__id", "shard": "__bytes", "fp": "key"})
    assert line_dedup.drop_repeated_lines(clash).columns == clash.columns
    assert line_dedup.drop_repeated_lines(clash).count() == len(odd_rows())
    assert line_dedup.line_report(empty(spark)).count() == 0 and line_dedup.drop_repeated_lines(empty(spark)).count() == 0


def test_suspects_hold_all_repeats_and_few_others():
    rng = np.random.default_rng(1)
    single, twice = rng.integers(0, 1 << 63, 40_000, dtype=np.uint64), rng.integers(0, 1 << 63, 2_000, dtype=np.uint64)
    hashed = np.concatenate([single, twice, twice])
    rng.shuffle(hashed)
    block, word = line_dedup.filter_words(hashed, 1 << 14)
    hit = line_dedup.suspected(block, word, np.zeros(len(hashed), bool), 0, 1 << 14, step=1_000)
    repeated = np.isin(hashed, twice)
    assert hit[repeated].all() and hit[~repeated].mean() < 0.03


def test_query_digest(spark, tmp_path):
    rows = line_rows(2)
    docs(spark, rows, clashes=False).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_bloom_line_dedup(spark, str(tmp_path)).select("doc_id", "n_lines", "n_dropped", "kept_sha256").collect()
    same(got, [(i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in brute(rows)])
