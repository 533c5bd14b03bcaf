"""Robust multivariate outliers among text statistics, with DataFrame operations only.

Per language and source the statistics of its texts get a minimum-covariance-determinant estimate:
the centre and scatter of the half of the rows with the smallest determinant, found by concentration
steps from two deterministic starts and then reweighted. A text whose Mahalanobis distance from its
group is too large is rejected. A concentration step is one aggregation: rows are summed by group,
start and distance bin on the map side, and the bins that make up the half are added up afterwards.
All sums are of whole numbers, so reruns agree bit by bit and no group is gathered anywhere.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockcast.operators.hot_groups import pinned
from stockcast.session import write_stage

WORD_BREAK = r"[\x20\x09-\x0D]+"
#: Statistic: floor of its scale, in its own (transformed) units. A group in which a statistic hardly varies is
#: judged by the floor, else a few unusual lines would be infinitely far away.
STATISTICS = {
    "log_words": 1.0, "log_word_length": 0.06, "symbol_rate": 0.01, "dup_line_rate": 0.12,
    "repeat_rate": 0.15, "upper_rate": 0.03, "mark_rate": 0.03,
}
DIM = len(STATISTICS)
GRID = 1_000          # steps of a scale unit; z-scores and medians are whole numbers of steps
FAR = 50              # z-scores are cut off here for the estimates (not for the verdict's distance in use)
HALF = 0.5            # share of rows that the estimate rests on
RIDGE = 0.25          # share of the identity in every scatter matrix
STEPS = 4             # concentration steps
BINS_PER_E = 10       # bins of the squared distance per factor e
TAIL = 1e-6           # chance that a normal row is rejected
MIN_ROWS = 10 * DIM   # smaller groups are merged


def chi2_cdf(x: float, k: float) -> float:
    """Chi-square distribution function, by the series of the incomplete gamma function."""
    a, half = k / 2, x / 2
    term = total = 1 / a
    n = a
    while term > 1e-17 * total:
        n += 1
        term *= half / n
        total += term
    return min(1.0, total * math.exp(a * math.log(half) - half - math.lgamma(a))) if half > 0 else 0.0


def chi2_quantile(p: float, k: float) -> float:
    low, high = 0.0, 1_000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return high


def _consistency(share: float) -> float:
    """What the scatter of the inner ``share`` of a normal sample must be multiplied by."""
    return share / chi2_cdf(chi2_quantile(share, DIM), DIM + 2)


def _bind(value: str, name: str, body: str) -> str:
    """SQL that evaluates ``value`` once and uses it as ``name`` in ``body``."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def repeat_words_sql(words: str, width: int = 8) -> str:
    """SQL: words covered by windows of ``width`` words that occur twice or more in the array ``words``.

    Windows are compared by 64-bit hashes; only texts with an equal pair are sorted.
    """
    window = ", ".join(f"hs[i + {k}]" for k in range(width))
    twice = ("filter(s, (x, j) -> (j > 0 AND s[greatest(j - 1, 0)].h = x.h) "
             "OR (j < size(s) - 1 AND s[least(j + 1, size(s) - 1)].h = x.h))")
    covered = f"{width}L + aggregate(sequence(1, size(p) - 1), 0L, (a, k) -> a + least({width}, p[k] - p[k - 1]))"
    found = _bind("sort_array(transform(ws, (h, i) -> struct(h, i)))", "s",
                  _bind(f"sort_array(transform({twice}, x -> x.i))", "p", covered))
    search = _bind(f"transform(sequence(0, size(hs) - {width}), i -> xxhash64({window}))", "ws",
                   f"if(size(array_distinct(ws)) = size(ws), 0L, {found})")
    return _bind(f"transform({words}, w -> xxhash64(w))", "hs", f"if(size(hs) <= {width}, 0L, {search})")


def base_statistics(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the counts of every text; null texts have no words."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, WORD_BREAK, -1), lambda w: w != "")
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")))
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"), text.alias("t"), words.alias("w"), lines.alias("l"),
    ).select(
        "doc_id", "lang", "source", F.size("w").cast("long").alias("n_words"),
        F.char_length(F.array_join("w", "")).cast("long").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("l") - F.size(F.array_distinct("l"))).cast("long").alias("n_dup_lines"),
        F.expr(repeat_words_sql("w")).alias("n_repeat_words"),
        F.size("l").cast("long").alias("n_lines"),
        F.regexp_count("t", F.lit(r"\p{Lu}")).cast("long").alias("n_upper"),
        F.regexp_count("t", F.lit(r"\p{P}")).cast("long").alias("n_marks"),
    ).withColumn("base_failed", (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")))


def _statistic(name: str) -> Column:
    ratio = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return {
        "log_words": F.log(F.greatest(F.col("n_words"), F.lit(1))),
        "log_word_length": F.log(F.greatest(ratio("word_chars", "n_words"), F.lit(0.1))),
        "symbol_rate": ratio("n_symbols", "word_chars"), "dup_line_rate": ratio("n_dup_lines", "n_lines"),
        "repeat_rate": ratio("n_repeat_words", "n_words"), "upper_rate": ratio("n_upper", "word_chars"),
        "mark_rate": ratio("n_marks", "word_chars"),
    }[name]


def _grouped(stats: DataFrame) -> DataFrame:
    """Rows with their group ``g``: lang and source, or what small groups are merged into.

    Groups under ``MIN_ROWS`` usable rows are merged by language, and languages still too small with each other.
    """
    keys = {"lang_key": F.coalesce(F.concat(F.lit("="), "lang"), F.lit("none")),
            "source_key": F.coalesce(F.concat(F.lit("="), "source"), F.lit("none"))}
    stats = stats.withColumns(keys)
    counts = stats.groupBy("lang_key", "source_key").agg(F.count_if(~F.col("base_failed")).alias("n"))
    of_lang = Window.partitionBy("lang_key")
    small = F.col("n") < MIN_ROWS
    counts = counts.withColumn("rest", F.sum(F.when(small, F.col("n")).otherwise(0)).over(of_lang))
    name = F.when(~small, F.struct("lang_key", "source_key")).when(
        F.col("rest") >= MIN_ROWS, F.struct("lang_key", F.lit("").alias("source_key"))).otherwise(
        F.struct(F.lit("").alias("lang_key"), F.lit("").alias("source_key")))
    names, _ = pinned(counts.select("lang_key", "source_key", F.to_json(name).alias("g")), "quality-groups")
    return stats.join(names, ["lang_key", "source_key"]).drop("lang_key", "source_key")


def _half(counts: DataFrame, value: str, by: list[str]) -> DataFrame:
    """Weighted lower median of ``value`` per ``by`` from rows (by, value, n)."""
    order = Window.partitionBy(*by).orderBy(value)
    run = counts.withColumn("run", F.sum("n").over(order)).withColumn("all", F.sum("n").over(Window.partitionBy(*by)))
    return run.where(2 * F.col("run") >= F.col("all")).groupBy(*by).agg(F.min(value).alias(value))


def _scales(rows: DataFrame) -> DataFrame:
    """Per group: an array of (median, scale) in grid steps of each statistic's floor; scales are 1 floor at least."""
    steps = F.explode(F.array(*[F.struct(F.lit(i).alias("k"), F.col(f"x{i}").alias("v")) for i in range(DIM)]))
    counts = write_stage(
        rows.select("g", steps.alias("s")).groupBy("g", "s.k", "s.v").agg(F.count(F.lit(1)).alias("n")), "quality-grid")
    median = _half(counts, "v", ["g", "k"]).withColumnRenamed("v", "median")
    spread = counts.join(median, ["g", "k"]).withColumn("gap", F.abs(F.col("v") - F.col("median")))
    spread = spread.groupBy("g", "k", "gap").agg(F.sum("n").alias("n"))
    scale = F.greatest(F.col("gap") * 1.4826, F.lit(float(GRID)))
    return median.join(_half(spread, "gap", ["g", "k"]), ["g", "k"]).groupBy("g").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("k", "median", scale.alias("scale")))),
                    lambda s: F.struct(s["median"].alias("median"), s["scale"].alias("scale"))).alias("scales"))


MEAN = [f"m{i}" for i in range(DIM)]
PRECISION = [f"p{i}_{j}" for i in range(DIM) for j in range(i + 1)]


def _with_distance(rows: DataFrame) -> DataFrame:
    """Adds ``d2``: the squared Mahalanobis distance of z0.. from the mean m0.. under the precision p0_0.."""
    rows = rows.withColumns({f"u{i}": F.col(f"z{i}") / GRID - F.col(f"m{i}") for i in range(DIM)})
    terms = [F.col(f"p{i}_{j}") * F.col(f"u{i}") * F.col(f"u{j}") * (1 if i == j else 2) for i in range(DIM) for j in range(i + 1)]
    return rows.withColumn("d2", sum(terms[1:], terms[0])).drop(*[f"u{i}" for i in range(DIM)])


def _sums(prefix: str = "z") -> list[Column]:
    """Row count and whole-number sums of z and of its products."""
    z = [F.col(f"{prefix}{i}") for i in range(DIM)]
    out = [F.count(F.lit(1)).alias("n"), *[F.sum(z[i]).alias(f"s{i}") for i in range(DIM)]]
    return out + [F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i in range(DIM) for j in range(i + 1)]


def _estimates(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    """Mean, precision and determinant of the scatter from summed rows; the matrix is inverted by sweeping."""
    n = F.col("n").cast("double")
    mean = [F.col(f"s{i}") / n / GRID for i in range(DIM)]
    cells = []
    for i in range(DIM):
        for j in range(DIM):
            product = F.col(f"q{max(i, j)}_{min(i, j)}") / n / GRID / GRID - mean[i] * mean[j]
            cells.append(product * (factor * (1 - RIDGE)) + (RIDGE if i == j else 0.0))
    out = sums.select(*keys, F.array(*mean).alias("mean"), F.array(*cells).alias("a"), F.lit(1.0).alias("det"))
    for k in range(DIM):
        pivot = f"a[{k * DIM + k}]"
        out = out.withColumn("det", F.expr(f"det * {pivot}")).withColumn("a", F.expr(f"""
            transform(a, (x, t) -> CASE
                WHEN t = {k * DIM + k} THEN -1D / {pivot}
                WHEN t div {DIM} = {k} OR t % {DIM} = {k} THEN x / {pivot}
                ELSE x - a[(t div {DIM}) * {DIM} + {k}] * a[{k * DIM} + t % {DIM}] / {pivot} END)"""))
    precision = [(-F.col("a")[i * DIM + j]).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i + 1)]
    return out.select(*keys, *[F.col("mean")[i].alias(m) for i, m in enumerate(MEAN)], *precision, "det")


def _small(df: DataFrame, name: str) -> DataFrame:
    """A table of one row per group, evaluated once: broadcast up to a counted bound, else written."""
    return pinned(df, name)[0]


def _concentrate(rows: DataFrame, params: DataFrame) -> DataFrame:
    """One concentration step: sums of the half of each group that is nearest under ``params``, per start."""
    bin_of = F.floor(F.log(F.greatest(F.col("d2"), F.lit(1e-6))) * BINS_PER_E)
    binned = _with_distance(rows.join(params, "g")).groupBy("g", "start", bin_of.alias("bin")).agg(*_sums())
    order, own = Window.partitionBy("g", "start").orderBy("bin"), Window.partitionBy("g", "start")
    before = F.sum("n").over(order) - F.col("n")
    inner = binned.withColumn("before", before).withColumn("rows", F.sum("n").over(own)).where(
        F.col("before") < F.col("rows") * HALF)
    names = [c for c in binned.columns if c not in ("g", "start", "bin")]
    return inner.groupBy("g", "start").agg(*[F.sum(c).alias(c) for c in names])


def score(docs: DataFrame) -> DataFrame:
    """Base counts, base_failed, the group's squared distance ``d2`` and ``kept`` of every row.

    Rows that fail the base rules take no part in the estimates and are not kept. A group left with
    fewer than ``MIN_ROWS`` rows after all merging judges nobody: d2 is null there and base rules decide.
    Null languages and sources are groups of their own; null texts fail; repeated rows count each.
    """
    stats = write_stage(base_statistics(docs), "quality-base")
    grid = {f"x{i}": F.round(_statistic(s) / floor * GRID).cast("long") for i, (s, floor) in enumerate(STATISTICS.items())}
    rows = write_stage(_grouped(stats).withColumns(grid), "quality-rows")
    scales = _small(_scales(rows.where(~F.col("base_failed"))), "quality-scales")
    z = {f"z{i}": F.round(F.greatest(F.lit(-FAR), F.least(F.lit(FAR), (
        F.col(f"x{i}") - F.col("scales")[i]["median"]) / F.col("scales")[i]["scale"])) * GRID).cast("long") for i in range(DIM)}
    rows = write_stage(rows.join(scales, "g", "left").withColumns(z).drop("scales", *grid), "quality-z")
    used = rows.where(~F.col("base_failed")).select("g", *z)

    # starts: the coordinates' own medians and scales, and the scatter of winsorised coordinates
    near = used.withColumns({c: F.greatest(F.lit(-3 * GRID // 2), F.least(F.lit(3 * GRID // 2), F.col(c))) for c in z})
    second = _estimates(near.groupBy("g").agg(*_sums()), ["g"], 1.0).select("g", F.lit(1).alias("start"), *MEAN, *PRECISION)
    unit = [F.lit(float(i == j)).alias(f"p{i}_{j}") for i in range(DIM) for j in range(i + 1)]
    first = second.select("g", F.lit(0).alias("start"), *[F.lit(0.0).alias(m) for m in MEAN], *unit)
    params = _small(first.unionByName(second), "quality-start")
    for _ in range(STEPS):
        params = _small(_estimates(_concentrate(used, params), ["g", "start"], _consistency(HALF)), "quality-step")
    best = params.groupBy("g").agg(F.min(F.struct("det", "start", *MEAN, *PRECISION)).alias("b")).select(
        "g", *[f"b.{c}" for c in MEAN + PRECISION])
    best = _small(best, "quality-best")
    inside = _with_distance(used.join(best, "g")).where(F.col("d2") <= chi2_quantile(0.975, DIM))
    enough = inside.groupBy("g").agg(*_sums()).where(F.col("n") >= MIN_ROWS * HALF)
    final = _small(_estimates(enough, ["g"], _consistency(0.975)).drop("det"), "quality-final")
    scored = _with_distance(rows.join(final, "g", "left"))
    good = F.coalesce(F.col("d2") <= chi2_quantile(1 - TAIL, DIM), F.lit(True))
    return scored.withColumn("kept", ~F.col("base_failed") & good).select(
        *[c for c in stats.columns if c != "base_failed"], "d2", "base_failed", "kept")
