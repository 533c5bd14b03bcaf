"""Distribution drift over equal-width bins, with per-category share differences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from stockcast.defaults import N_BINS, TOP_K
from stockcast.functions import sqltext as sql
from stockcast.functions.scores import psi_term
from stockcast.operators.distributions import (
    ABSENT, OUTSIDE, FeatureCounts, column_profile, combined_moments, feature_counts, top_of,
)
from stockcast.operators.hot_groups import pinned

MISSING = "__MISSING__"
ZERO_SHARE = 1e-8


def width_edges(profile: DataFrame, n_bins: int = N_BINS) -> DataFrame:
    """Equal bins over [min, max], right-closed, first edge lowered by 0.1% of the range.

    A constant v gets the range v -/+ 0.1% of |v| (-/+ 0.001 for 0), not lowered.
    Columns without values are left out.
    """
    ranged = profile.where("n > 0").selectExpr(
        "*", "CASE WHEN min <> max THEN 0.0D WHEN min = 0 THEN 0.001D ELSE abs(min) * 0.001D END AS pad"
    ).selectExpr("*", "min - pad AS a", "max + pad AS b", f"((max + pad) - (min - pad)) / {float(n_bins)}D AS step")
    inner = sql.array(f"a + {float(i)}D * step" for i in range(1, n_bins))
    return ranged.selectExpr(
        *map(sql.name, profile.columns), f"{inner} AS cuts", "IF(min <> max, a - (b - a) * 0.001D, a) AS lo", "b AS hi")


def _bins(edges: DataFrame, n_bins: int) -> DataFrame:
    """One row per bin with its bounds ``bin_lo`` and ``bin_hi``."""
    each = (f"transform(sequence(0, {n_bins - 1}), i -> named_struct('bin', i, "
            f"'bin_lo', IF(i = 0, lo, get(cuts, i - 1)), 'bin_hi', IF(i = {n_bins - 1}, hi, get(cuts, i))))")
    return edges.selectExpr("*", f"inline({each})")


def _with_features(df: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    """Exactly the features; absent ones are all NULL."""
    def absent(c: str) -> Column:
        return F.lit(None).cast("string" if c in cat_cols else "double").alias(c)

    return df.select(*[F.col(c) if c in df.columns else absent(c) for c in feature_names])


def width_reference(
    df: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str], n_bins: int = N_BINS, top_k: int = TOP_K
) -> DataFrame:
    """Reference table over all features: one row per numeric bin or frequent category.

    Two scans: the profile of the numbers, and bins with categories and row count.
    """
    df = _with_features(df, feature_names, cat_cols)
    nums = [c for c in feature_names if c not in cat_cols]
    cats = [c for c in feature_names if c in cat_cols]
    edges = pinned(width_edges(column_profile(df, nums), n_bins), "width-edges")[0] if nums else None
    counts = feature_counts(df, edges.collect() if nums else [], nums, cats, MISSING, right_closed=True)
    tops = top_of(counts, top_k).join(F.broadcast(counts.missing_rates()), "feature") if cats else None
    return reference_rows_of(feature_names, edges, counts.bins() if nums else None, tops, n_bins)


def reference_rows_of(
    feature_names: Sequence[str], edges: DataFrame | None, bins: DataFrame | None, tops: DataFrame | None, n_bins: int
) -> DataFrame:
    """The reference table from edges with profiles, counts per (feature, bin), and ranked categories with rates."""
    position = f"array_position({sql.array(map(sql.text, feature_names))}, feature) - 1"
    parts = []
    if edges is not None:
        counted = _bins(edges, n_bins).join(bins, ["feature", "bin"], "left")
        cnt = F.coalesce("cnt", F.lit(0))
        parts.append(counted.select(
            "feature", F.lit("numeric").alias("kind"), "bin", F.col("bin_lo").alias("lo"), F.col("bin_hi").alias("hi"),
            F.lit(None).cast("string").alias("key"), cnt.alias("cnt"), (cnt / F.col("n")).alias("share"),
            "missing_rate", "mean", "std", "min", "max", "n_rows"))
    if tops is not None:
        nothing = F.lit(None).cast("double")
        parts.append(tops.select(
            "feature", F.lit("categorical").alias("kind"), F.lit(None).cast("int").alias("bin"),
            nothing.alias("lo"), nothing.alias("hi"), "key", "cnt", "share", "missing_rate",
            nothing.alias("mean"), nothing.alias("std"), nothing.alias("min"), nothing.alias("max"), "n_rows"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.selectExpr(f"CAST({position} AS INT) AS pos", "*")


def _reference_edges(ref: DataFrame) -> DataFrame:
    return ref.groupBy("feature").agg(
        F.min("lo").alias("lo"), F.max("hi").alias("hi"),
        F.array_sort(F.collect_list(F.when(F.col("bin") > 0, F.col("lo")))).alias("cuts"))


def numeric_drift(ref: DataFrame, bins: DataFrame) -> DataFrame:
    """PSI, mean, population std and out-of-range rate of each numeric reference feature, from the batch's bins.

    Batch rows outside the reference's range are in no bin; if all are, PSI is NULL.
    """
    counts = bins.where(F.col("bin") != ABSENT)
    inside = F.when(F.col("bin") != OUTSIDE, F.col("cnt"))
    seen = counts.groupBy("feature").agg(F.sum("cnt").alias("n_all"), F.sum(inside).alias("n_in"))
    cur = counts.where(F.col("bin") != OUTSIDE).select("feature", "bin", F.col("cnt").alias("cur_cnt"))
    total = ref.groupBy("feature").agg(F.sum("cnt").alias("ref_n"))

    def share(cnt: Column, n: Column) -> Column:
        part = cnt / n
        return F.when(part == 0, F.lit(ZERO_SHARE)).otherwise(part)

    psi = (
        ref.join(cur, ["feature", "bin"], "left").join(F.broadcast(total), "feature").join(F.broadcast(seen), "feature")
        .groupBy("feature")
        .agg(F.sum(F.when(F.col("n_in") > 0, psi_term(
                share(F.col("cnt"), F.col("ref_n")),
                share(F.coalesce("cur_cnt", F.lit(0)), F.col("n_in"))))).alias("psi"),
             F.max((F.col("n_all") - F.coalesce("n_in", F.lit(0))) / F.col("n_all")).alias("out_of_range_rate"))
    )
    stats = combined_moments(bins).select("feature", F.col("mean").alias("mean_batch"), "std_batch")
    return ref.select("pos", "feature", "kind").distinct().join(stats, "feature", "left").join(psi, "feature", "left")


def category_drift(ref: DataFrame, counts: FeatureCounts) -> DataFrame:
    """Share in the batch minus share in the reference for every reference category."""
    cur = counts.categories().withColumnRenamed("cnt", "cur_cnt")
    listed = ref.select("feature", "key", F.col("share"), "pos", "kind")
    # only listed keys matter: the small reference filters the counts before they are joined back
    cur = cur.join(F.broadcast(ref.select("feature", "key")), ["feature", "key"], "left_semi")
    n = F.lit(counts.n_rows)
    return listed.join(F.broadcast(cur), ["feature", "key"], "left").join(F.broadcast(counts.missing_rates()), "feature", "left").select(
        "pos", "feature", "kind", F.col("key").alias("value"),
        F.when(n > 0, F.coalesce("cur_cnt", F.lit(0)) / F.nullif(n, F.lit(0)) - F.col("share")).alias("delta"),
        "missing_rate")


def drift_report(
    batch: DataFrame, reference: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str]
) -> DataFrame:
    """Long report over all reference features; columns absent from the batch count as all NULL.

    One scan of the batch. The reference says how many bins a feature has.
    """
    batch = _with_features(batch, feature_names, cat_cols)
    nums = [c for c in feature_names if c not in cat_cols]
    cats = [c for c in feature_names if c in cat_cols]
    ref_nums = reference.where((F.col("kind") == "numeric") & F.col("feature").isin(nums))
    ref_cats = reference.where((F.col("kind") == "categorical") & F.col("feature").isin(cats))
    edges = _reference_edges(ref_nums).collect() if nums else []
    counts = feature_counts(batch, edges, nums, cats, MISSING, right_closed=True, moments=True)
    parts = []
    if nums:
        parts.append(numeric_drift(ref_nums, counts.bins()).select(
            "pos", "feature", "kind", "psi", "mean_batch", "std_batch", "out_of_range_rate",
            F.lit(None).cast("string").alias("value"), F.lit(None).cast("double").alias("delta"),
            F.lit(None).cast("double").alias("missing_rate")))
    if cats:
        nothing = F.lit(None).cast("double")
        parts.append(category_drift(ref_cats, counts).select(
            "pos", "feature", "kind", nothing.alias("psi"), nothing.alias("mean_batch"), nothing.alias("std_batch"),
            nothing.alias("out_of_range_rate"), "value", "delta", "missing_rate"))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.withColumn("n_batch_rows", F.lit(counts.n_rows).cast("bigint"))
