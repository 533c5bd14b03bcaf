import math
import random
import zlib

import numpy as np
import pytest
from cases import docs, empty, odd_rows
from pyspark.sql import functions as F

from stockcast.llm import ann, quality, toxicity

VECTORS = "vec_id long, embedding array<float>, cls long, norm double"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2.0) for i, v in rows], VECTORS)


def brute_nearest(rows, query_ids, k):
    rows = [(i, np.array(np.array(v, np.float32), np.float64)) for i, v in {(i, tuple(v)) for i, v in rows}]
    out = {}
    for i, v in rows:
        if i in query_ids:
            near = sorted((-float(np.sum(v * w)), j) for j, w in rows if j != i)
            out[i] = [(j, -s) for s, j in near[:k]]
    return out


def test_vectors_of_any_size(spark):
    """Components near the ends of the range of doubles: no overflow in norms, ties by relative size, sums of both infinities."""
    rng = np.random.default_rng(6)
    for size in (1e200, 1e-200, 1e307, 5e-324, 1.0):
        x = rng.integers(-3, 4, (120, 6)) * size
        x[:, 0] = np.where((x == 0).all(axis=1), size, x[:, 0])
        rows = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
        got = ann.nearest(rows, rows.where("vec_id % 20 = 0"), k=119).collect()
        assert len(got) == 6 * 119
        with np.errstate(over="ignore", invalid="ignore"):
            for q in range(0, 120, 20):
                mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
                exact = (x[q] / size * (x / size)).sum(axis=1)
                want = sorted((i for i in range(120) if i != q), key=lambda i: (-round(exact[i]), i))
                if size == 1.0:
                    assert [r.vec_id for r in mine] == want
                assert all(r.score == exact[r.vec_id] * size * size for r in mine if math.isfinite(r.score) and r.score)
                assert all(a.score >= b.score for a, b in zip(mine, mine[1:]))
                assert not any(math.isnan(r.score) for r in mine)


def test_exact_when_every_bucket_is_visited(spark, monkeypatch):
    monkeypatch.setattr(ann, "CHUNK", 7)
    rng = np.random.default_rng(0)
    rows = [(i, (rng.standard_normal(5) * (1 + i % 4)).tolist()) for i in range(200)]
    rows += [(300 + i, [1.0, 1.0, 0.0, 0.0, 0.0]) for i in range(60)] + [(500, rows[3][1]), (500, rows[3][1])]
    df = vectors(spark, rows)
    asked = df.where("vec_id % 20 = 0")
    got = ann.nearest(df, asked, k=6, tables=3, hashes=2, cell=8.0, probes=16).collect()
    want = brute_nearest(rows, {i for i, _ in rows if i % 20 == 0}, 6)
    assert {r.query_id for r in got} == set(want)
    for query, near in want.items():
        own = sorted((r["rank"], r.vec_id, r.score) for r in got if r.query_id == query)
        assert [v for _, v, _ in own] == [j for j, _ in near] and [x for x, _, _ in own] == list(range(1, len(near) + 1))
        assert [s for _, _, s in own] == pytest.approx([s for _, s in near], abs=1e-12)


def test_recall_of_the_defaults(spark):
    rng = np.random.default_rng(1)
    centres = rng.standard_normal((30, 32))
    x = centres[rng.integers(0, 30, 1500)] + 0.6 * rng.standard_normal((1500, 32))
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    df = vectors(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"))
    want = [(q, j) for q, near in brute_nearest(rows, set(range(0, 1500, 20)), 20).items() for j, _ in near]
    assert ann.recall(got, spark.createDataFrame(want, "query_id long, vec_id long")) >= 0.9


@pytest.mark.parametrize("norms", ["one long", "spread"])
def test_recall_with_unequal_norms(spark, norms):
    rng = np.random.default_rng(2)
    x = rng.standard_normal((1_000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    x *= np.exp(rng.standard_normal(1_000))[:, None] if norms == "spread" else np.append(1_000, np.ones(999))[:, None]
    rows = [(i, v.tolist()) for i, v in enumerate(x, 1)]
    df = vectors(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"))
    assert got.groupBy("query_id").count().where("count = 20").count() == 50
    want = [(q, j) for q, near in brute_nearest(rows, set(range(20, 1_001, 20)), 20).items() for j, _ in near]
    share = ann.recall(got, spark.createDataFrame(want, "query_id long, vec_id long"))
    print(f"recall, {norms}: {share:.3f}")
    assert share >= 0.9


def test_queries_with_few_candidates_probe_on(spark):
    """Narrow cells: nearly every vector is alone in its bucket, and one probe finds none of the others."""
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 8)))] + [(100, [1.0, 2.0]), (101, [2.0, 1.0])]
    df = vectors(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0"), k=5, tables=1, hashes=3, cell=0.05, probes=1).collect()
    want = brute_nearest(rows[:60], {0, 20, 40}, 5) | brute_nearest(rows[60:], {100}, 5)
    assert {q: sorted((r["rank"], r.vec_id) for r in got if r.query_id == q) for q in want} == {
        q: [(n, j) for n, (j, _) in enumerate(near, 1)] for q, near in want.items()}


def test_unsound_vectors_take_no_part(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.1]), (2, None), (3, []), (4, [0.0, 0.0]), (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]),
            (7, [None, 1.0]), (None, [1.0, 1.0]), (20, [1.0, 2.0, 3.0])]
    df = vectors(spark, rows)
    got = ann.nearest(df, df.where("vec_id % 20 = 0 or vec_id is null")).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in got] == [(0, 1, 1)]
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


def test_perturbations_are_sound():
    sets = ann.perturbations(4, 200)
    assert sets[0] == () and len(set(sets)) == len(sets)
    assert all(len({min(j, 7 - j) for j in s}) == len(s) for s in sets) and len(sets) == 3 ** 4


def brute_counts(text):
    import re
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i:i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(p for i in at for p in range(i, i + 8))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_base_counts(spark):
    rng = random.Random(3)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randrange(40))) for _ in range(40)]
    texts += ["x y z\n\nx y z\n \nq", "a b c d e f g h " * 5, "# * $\r\v\f|<> é b", "w " * 8, "w " * 9]
    rows = odd_rows() + [(100 + i, t, "en", "a", 0) for i, t in enumerate(texts)]
    got = quality.base_statistics(docs(spark, rows)).collect()
    have = sorted((r.doc_id or -1, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got)
    assert have == sorted((r[0] or -1, *brute_counts(r[1])) for r in rows)


def brute_mcd(z):
    """The same estimate in numpy: two starts, binned concentration steps, reweighting."""
    d, factor = quality.DIM, quality._consistency(quality.HALF)

    def estimate(x, scale):
        cov = (x.T @ x / len(x) - np.outer(x.mean(0), x.mean(0))) * scale * (1 - quality.RIDGE) + quality.RIDGE * np.eye(d)
        return x.mean(0), cov

    def distance(x, mean, cov):
        return np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)

    found = []
    for mean, cov in ((np.zeros(d), np.eye(d)), estimate(np.clip(z, -1.5, 1.5), 1.0)):
        for _ in range(quality.STEPS):
            bins = np.floor(np.log(np.maximum(distance(z, mean, cov), 1e-6)) * quality.BINS_PER_E)
            below = np.array([(bins < b).sum() for b in bins])
            mean, cov = estimate(z[below < len(z) * quality.HALF], factor)
        found.append((np.linalg.det(cov), mean, cov))
    _, mean, cov = min(found, key=lambda f: f[0])
    inside = distance(z, mean, cov) <= quality.chi2_quantile(0.975, d)
    mean, cov = estimate(z[inside], quality._consistency(0.975))
    return distance(z, mean, cov)


def quality_rows():
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows = []
    for i in range(330):
        text = ". ".join(" ".join(word() for _ in range(rng.randrange(4, 14))).capitalize() for _ in range(rng.randrange(4, 30)))
        if i % 11 == 0:
            text = " ".join(w + "###" for w in text.upper().split())
        rows.append((i, text, "en", "a" if i % 3 else "b", 0))
    return rows


def test_outliers_match_numpy(spark):
    rows = quality_rows()
    got = {r.doc_id: r for r in quality.score(docs(spark, rows)).collect()}
    stats = {r["doc_id"]: r for r in quality.base_statistics(docs(spark, rows)).collect()}
    for source in "ab":
        ids = [r[0] for r in rows if r[3] == source and not got[r[0]].base_failed]
        grid = []
        for i in ids:
            s = stats[i]
            n, chars = max(s.n_words, 1), max(s.word_chars, 1)
            values = (np.log(n), np.log(s.word_chars / n), s.n_symbols / chars, s.n_dup_lines / max(s.n_lines, 1),
                      s.n_repeat_words / n, s.n_upper / chars, s.n_marks / chars)
            grid.append([round(v / f * quality.GRID) for v, f in zip(values, quality.STATISTICS.values())])
        grid = np.array(grid)
        low = lambda x: np.sort(x, axis=0)[(len(x) - 1) // 2]
        median = low(grid)
        scale = np.maximum(low(np.abs(grid - median)) * 1.4826, quality.GRID)
        z = np.round(np.clip((grid - median) / scale, -50, 50) * quality.GRID) / quality.GRID
        assert [got[i].d2 for i in ids] == pytest.approx(brute_mcd(z).tolist(), rel=1e-2, abs=1e-2)
    assert not any(got[r[0]].kept for r in rows if r[0] % 11 == 0)
    assert sum(got[r[0]].kept for r in rows if r[0] % 11) >= 295


def test_small_groups_and_odd_rows(spark):
    got = quality.score(docs(spark)).collect()
    assert len(got) == len(odd_rows()) and all(r.d2 is None for r in got)
    assert all(r.kept == (not r.base_failed) for r in got)
    assert quality.score(empty(spark)).count() == 0


def test_chi_square():
    assert quality.chi2_quantile(0.95, 1) == pytest.approx(3.841459, abs=1e-5)
    assert quality.chi2_quantile(0.5, 7) == pytest.approx(6.345811, abs=1e-5)


def toxic_rows(n=1_500):
    rng = random.Random(12)
    plain = [f"{a}{b}" for a in ("ka", "lo", "mi", "ru", "te") for b in ("ban", "dor", "fil", "gos", "hut")]
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(rng.randrange(10, 80))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["snark", "grumble", "y0u", "blatherx", "blathery", "blatherz"])
        rows.append((i, " ".join(words), "en", "a", 0))
        if rng.random() < 0.8:
            labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows()
    frame = spark.createDataFrame([*labels, (None, 1, 1), (5, 1, None), (99_999, 0, 1)], "doc_id long, quality int, toxic int")
    odd = [(10_000 + i, *r[1:]) for i, r in enumerate(odd_rows())]
    got = {r.doc_id: r for r in toxicity.score_documents(docs(spark, rows + odd), frame).collect()}
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    held = [(got[i].predicted, t) for i, _, t in labels if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in got)
    assert sum(p == t for p, t in held) / len(held) > 0.95
    kept = toxicity.keep_clean(docs(spark, rows + odd), frame)
    assert kept.columns == docs(spark, []).columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in got.items() if not r.predicted}


def test_without_labels_scores_are_the_prior(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in toxicity.score_documents(docs(spark), none).collect()} == {0.0}
    assert toxicity.score_documents(empty(spark), none).count() == 0
    one_kind = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {r.predicted for r in toxicity.score_documents(docs(spark), one_kind).collect()} == {0}


def test_words_behind_look_alikes():
    codes = toxicity.WordCodes({"snark": 3.0, "blath*": 2.0})
    assert codes["Snark!"] & 1023 == 300 and codes["blatherings"] & 1023 == 200
    assert codes["sn4rk"] & toxicity.HIDDEN and codes["snaaaark"] & toxicity.HIDDEN and codes["s.n.a.r.k"] & toxicity.OBFUSCATED
    assert codes["You,"] & toxicity.SECOND and codes["LOUD"] & toxicity.SHOUTED and codes["plain"] == 0
