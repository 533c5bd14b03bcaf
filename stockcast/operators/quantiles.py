"""Exact interpolated quantiles that never bring a group's values into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockcast.functions import sqltext as sql
from stockcast.operators.hot_groups import MAX_GROUP_ROWS, MAX_LISTED, pinned

STEPS = 200            # even quantiles of a sketch inside a bracket
SMALL_GROUP = 100_000  # values that one aggregation buffer may hold


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    group_cols: Sequence[str] = (),
    accuracy: int = 10_000,
    max_rows: int = MAX_GROUP_ROWS,
    median_rule: bool = False,
) -> DataFrame:
    """Linear-interpolation quantiles of each column, per group: (group..., feature, n, quantiles).

    Mergeable sketches, whose guaranteed rank error gives each quantile a bracket of values it must lie in, are taken in one
    narrow scan, run at once. While the brackets of a group may hold more than ``max_rows`` values, a scan takes sketches
    inside them, which narrows each about a hundredfold, whatever the values look like. A last scan counts rows per value
    inside the brackets and per gap between them, on the map side first, and a running count over at most about ``max_rows``
    values finds the order statistics exactly. Groups of at most ``accuracy`` rows use one bracket for
    everything. A value between two others is interpolated from the nearer one; with
    ``median_rule`` a halfway value is their mean. NULLs are left out; a group
    without values has n = 0 and NULL quantiles. NULL keys form a group of their own.
    """
    groups, cols, k = list(group_cols), list(cols), len(probs)
    quoted = [sql.name(g) for g in groups]
    counted = bracket_counts(df, cols, probs, groups, accuracy, max_rows)
    group = ", ".join([*quoted, "__f"])
    ranks = [f"({float(p)!r}D * (n - 1))" for p in probs]
    ranked = counted.selectExpr(
        "*", f"sum(w) OVER (PARTITION BY {group} ORDER BY slot, gap ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto",
        f"sum(w) OVER (PARTITION BY {group}) AS n")

    def at(rank: str) -> str:
        return f"max(IF(upto > {rank} AND upto - w <= {rank} AND NOT gap, slot, NULL))"

    picked = ranked.groupBy(*groups, "__f").agg(F.max("n").alias("n"), *[
        F.expr(at(f"{end}{r}")).alias(f"{end}_{i}") for i, r in enumerate(ranks) for end in ("floor", "ceil")
    ])
    lost = "CAST(raise_error('quantile outside its sketch bracket') AS DOUBLE)"
    results = []
    for i, r in enumerate(ranks):
        a, b, t = f"floor_{i}", f"ceil_{i}", f"({r} - floor{r})"
        value = f"IF({t} < 0.5D, {a} + ({b} - {a}) * {t}, {b} - ({b} - {a}) * (1.0D - {t}))"
        if median_rule:
            value = f"IF({t} = 0.5D, ({a} + {b}) / 2.0D, {value})"
        results.append(f"IF(n > 0 AND ({a} IS NULL OR {b} IS NULL), {lost}, {value})")
    names = sql.array(sql.text(c) for c in cols)
    return picked.selectExpr(*quoted, f"get({names}, __f) AS feature", "n", f"{sql.array(results)} AS quantiles")


def bracket_counts(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], groups: Sequence[str], accuracy: int, max_rows: int
) -> DataFrame:
    """Rows per value inside the brackets of ``probs`` and per gap between them: (group..., __f, slot, gap, w).

    ``__f`` is the column's number. A group and column have at most about ``max_rows`` of these rows.
    """
    groups, cols, probs, k = list(groups), list(cols), list(probs), len(probs)
    quoted, ids = [sql.name(g) for g in groups], range(len(cols))
    narrow = df.selectExpr(*quoted, *[f"{sql.number(df, c)} AS __{i}" for i, c in enumerate(cols)])
    margin, ordered = 3.0 / accuracy, sorted(probs)
    shares = sql.array(
        [f"{max(0.0, p - margin)!r}D" for p in ordered] + [f"{min(1.0, p + margin)!r}D" for p in ordered])
    sketches = narrow.groupBy(*groups).agg(*[
        F.expr(sql.struct(
            __id=str(i), __n=f"count(__{i})", __b=f"percentile_approx(__{i}, {shares}, {accuracy})")).alias(f"__s{i}")
        for i in ids
    ])
    everything = f"concat(array_repeat(double('-infinity'), {k}), array_repeat(double('infinity'), {k}))"
    group_ids = [f"__g{j}" for j in range(len(groups))]
    brackets = sketches.selectExpr(
        *[f"{g} AS {gid}" for g, gid in zip(quoted, group_ids)], f"inline({sql.array(f'__s{i}' for i in ids)})"
    ).selectExpr(
        *group_ids, "__id", "__n", f"IF(__n <= {accuracy}, {everything}, __b) AS __b",
        f"IF(__n <= {accuracy}, 0D, {k} * 8.0D * __n / {accuracy}) AS __inside")
    # one row per group and column: broadcast if few, else a written table joined by shuffle
    brackets, listed = pinned(brackets, "brackets", MAX_LISTED // (2 * k))

    values = narrow.selectExpr(*quoted, f"posexplode({sql.array(f'__{i}' for i in ids)}) AS (__f, v)")
    same = " AND ".join(["__f = __id", *[f"{g} <=> {gid}" for g, gid in zip(quoted, group_ids)]])

    def most(rows: list | None, table: DataFrame) -> float:
        if rows is not None:
            return max((r["__inside"] for r in rows), default=0)
        return table.agg(F.max("__inside")).first()[0] or 0

    while most(listed, brackets) > max_rows:
        brackets, listed = pinned(_narrowed(values.join(brackets, F.expr(same)), ordered, group_ids, accuracy), "brackets", MAX_LISTED // (2 * k))

    # brackets may overlap: a value is inside one if more of them have started than ended
    started = " + ".join(f"IF(v >= get(__b, {i}), 1, 0)" for i in range(k))
    ended = " + ".join(f"IF(v > get(__b, {k + i}), 1, 0)" for i in range(k))
    return (
        values.join(brackets, F.expr(same))
        .selectExpr(*quoted, "__f", "v", "__b", f"{started} AS started", f"{ended} AS ended")
        .selectExpr(
            *quoted, "__f",
            f"IF(started > ended, v, IF(ended = 0, NULL, get(__b, {k - 1} + ended))) AS slot",
            "IF(v IS NULL, NULL, started = ended) AS gap")
        .groupBy(*groups, "__f", "slot", "gap")
        .agg(F.count(F.lit(1)).alias("w"))
        .withColumn("w", F.expr("IF(gap IS NULL, 0, w)"))
    )


def _narrowed(values: DataFrame, probs: Sequence[float], group_ids: Sequence[str], accuracy: int) -> DataFrame:
    """Brackets narrowed by a sketch strictly inside each; the exact rank of its start tells which part holds the quantile.

    ``values`` are joined with their brackets. A value that a great share of rows has becomes an end of its bracket, so what
    is inside shrinks by a constant factor each time. Small groups keep their brackets.
    """
    k, margin = len(probs), 3.0 / accuracy
    even = sql.array(f"{i / STEPS!r}D" for i in range(STEPS + 1))
    parts = []
    for j in range(k):
        inside = f"v > get(__b, {j}) AND v < get(__b, {k + j})"
        parts.append(F.expr(sql.struct(
            upto=f"count_if(v <= get(__b, {j}))", m=f"count_if({inside})",
            s=f"percentile_approx(IF(__inside > 0 AND {inside}, v, NULL), {even}, {accuracy})")).alias(f"__p{j}"))
    found = values.groupBy(*group_ids, "__id").agg(
        F.max("__n").alias("__n"), F.max("__inside").alias("__inside"), F.first("__b").alias("__b"), *parts)
    low, high = [], []
    for j, p in enumerate(probs):
        rank, m, span = f"({float(p)!r}D * (__n - 1))", f"__p{j}.m", f"greatest(__p{j}.m - 1, 1)"
        first, last = f"(floor{rank} - __p{j}.upto)", f"(ceil{rank} - __p{j}.upto)"  # places among the values inside
        from_ = f"get(__p{j}.s, greatest(0, CAST(floor(({first} / {span} - {margin!r}D) * {STEPS}) AS INT)))"
        to = f"get(__p{j}.s, least({STEPS}, CAST(ceil(({last} / {span} + {margin!r}D) * {STEPS}) AS INT)))"
        low.append(f"CASE WHEN {first} < 0 THEN get(__b, {j}) WHEN {first} >= {m} THEN get(__b, {k + j}) ELSE {from_} END")
        high.append(f"CASE WHEN {last} < 0 THEN get(__b, {j}) WHEN {last} >= {m} THEN get(__b, {k + j}) ELSE {to} END")
    # starts and ends in ascending order, as the counting needs them; the union of all brackets stays as it is
    fresh = found.selectExpr(
        *group_ids, "__id", "__n", "__inside", "__b", f"{' + '.join(f'__p{j}.m' for j in range(k))} AS __left",
        f"{sql.array(low)} AS __low", f"{sql.array(high)} AS __high")
    rising = (f"concat(transform(sequence(0, {k - 1}), j -> array_min(slice(__low, j + 1, {k}))), "
              f"transform(sequence(0, {k - 1}), j -> array_max(slice(__high, 1, j + 1))))")
    return fresh.selectExpr(
        *group_ids, "__id", "__n", f"IF(__inside = 0, __b, {rising}) AS __b",
        f"IF(__inside = 0, 0D, __left * {2 * margin + 2.0 / accuracy + 2.0 / STEPS!r}D) AS __inside")


def medians_wide(df: DataFrame, cols: Sequence[str], group_cols: Sequence[str], suffix: str) -> DataFrame:
    """Exact medians as one row per group with a ``<col><suffix>`` column each.

    If no group is larger than ``SMALL_GROUP`` rows, one plain aggregation finds them.
    """
    if group_cols:
        largest = df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0]
        if (largest or 0) <= SMALL_GROUP:
            return df.groupBy(*group_cols).agg(*[F.median(F.expr(sql.number(df, c))).alias(f"{c}{suffix}") for c in cols])
    long = exact_quantiles(df, cols, [0.5], group_cols, median_rule=True)
    return long.groupBy(*group_cols).agg(*[
        F.max(F.when(F.col("feature") == c, F.col("quantiles")[0])).alias(f"{c}{suffix}") for c in cols
    ])
