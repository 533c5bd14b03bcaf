"""Distribution drift over quantile bins, with an ``__other__`` bucket for categories."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import N_BINS, PSI_THRESHOLD, TOP_FEATURES, TOP_K
from stockcast.functions.scores import clipped_share, psi_term
from stockcast.operators.distributions import ABSENT, feature_counts, top_of
from stockcast.operators.encode import MISSING
from stockcast.operators.hot_groups import pinned
from stockcast.operators.quantiles import exact_quantiles

OTHER = "__other__"


def quantile_edges(df: DataFrame, cols: Sequence[str], n_bins: int = N_BINS, edge_digits: int | None = None) -> DataFrame:
    """Inner cut points per column: (feature, cuts, lo, hi). The outer bins are open.

    Equal quantiles merge. No value: one bin. One distinct value: cut at that value.
    ``edge_digits`` rounds edges to significant digits first, which removes interpolation noise
    from data with few digits.
    """
    probs = [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]
    edge = "q" if edge_digits is None else f"CAST(format_string('%.{edge_digits - 1}e', q) AS DOUBLE)"
    distinct = f"array_sort(array_distinct(transform(array_compact(quantiles), q -> {edge})))"
    edges = exact_quantiles(df, cols, probs).selectExpr("feature", f"{distinct} AS e").selectExpr(
        "feature", "IF(size(e) <= 1, e, slice(e, 2, size(e) - 2)) AS cuts",
        "CAST(NULL AS DOUBLE) AS lo", "CAST(NULL AS DOUBLE) AS hi")
    return pinned(edges, "edges")[0]


def _shares(counts: DataFrame, prop: str) -> DataFrame:
    """Counts per (feature, bin) as shares of the feature's rows with a value."""
    counts = counts.where(F.col("bin") != ABSENT)
    totals = F.broadcast(counts.groupBy("feature").agg(F.sum("cnt").alias("total")))
    return counts.join(totals, "feature").select("feature", "bin", (F.col("cnt") / F.col("total")).alias(prop))


def _positions(df: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str]) -> DataFrame:
    rows = [(i, c, "categorical" if c in cat_cols else "numeric") for i, c in enumerate(feature_names)]
    return F.broadcast(df.sparkSession.createDataFrame(rows, "pos int, feature string, kind string"))


def quantile_reference(
    df: DataFrame,
    feature_names: Sequence[str],
    cat_cols: Sequence[str],
    n_bins: int = N_BINS,
    top_k: int = TOP_K,
    edge_digits: int | None = None,
) -> DataFrame:
    """Reference table over all features: one row per numeric bin or category key.

    Three scans if no bracket needs narrowing: sketches, values inside brackets, and bins with categories and row count.
    """
    nums = [c for c in feature_names if c not in cat_cols]
    cats = [c for c in feature_names if c in cat_cols]
    positions = _positions(df, feature_names, cat_cols)
    edges = quantile_edges(df, nums, n_bins, edge_digits) if nums else None
    counts = feature_counts(df, edges.collect() if nums else [], nums, cats, MISSING, right_closed=False)
    parts = []
    if nums:
        shares = _shares(counts.bins(), "share")
        bins = edges.select("feature", "cuts", F.explode(F.sequence(F.lit(0), F.size("cuts"))).alias("bin"))
        parts.append(bins.join(shares, ["feature", "bin"], "left").select(
            "feature", "bin",
            F.get("cuts", F.col("bin") - 1).alias("lo"), F.get("cuts", F.col("bin")).alias("hi"),
            F.lit(None).cast("string").alias("key"), F.coalesce("share", F.lit(0.0)).alias("ref_prop")))
    if cats:
        top = top_of(counts, top_k)
        rest = top.groupBy("feature").agg(F.greatest(F.lit(0.0), F.lit(1.0) - F.sum("share")).alias("share"))
        keyed = top.where(F.col("key") != OTHER).select("feature", "key", "share").unionByName(
            rest.select("feature", F.lit(OTHER).alias("key"), "share"))
        parts.append(keyed.select(
            "feature", F.lit(None).cast("int").alias("bin"), F.lit(None).cast("double").alias("lo"),
            F.lit(None).cast("double").alias("hi"), "key", F.col("share").alias("ref_prop")))
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return rows.join(positions, "feature").select(
        "pos", "feature", "kind", "bin", "lo", "hi", "key", "ref_prop", F.lit(counts.n_rows).cast("bigint").alias("n_ref"))


def reference_edges(reference: DataFrame) -> DataFrame:
    """Inner cut points of a quantile reference, one row per numeric feature."""
    nothing = F.lit(None).cast("double")
    cuts = F.array_sort(F.array_compact(F.collect_list("lo")))  # a feature has at most n_bins rows
    return reference.where(F.col("kind") == "numeric").groupBy("feature").agg(cuts.alias("cuts")).select(
        "feature", "cuts", nothing.alias("lo"), nothing.alias("hi"))


def quantile_psi(
    df: DataFrame, reference: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str]
) -> DataFrame:
    """PSI of current rows against a reference: (pos, feature, kind, psi).

    One scan of the current rows. The reference says how many bins a feature has. Numeric features without a reference are left out; categorical ones get 0.
    """
    absent = [c for c in feature_names if c not in df.columns]
    if absent:
        raise KeyError(f"columns missing from the current data: {', '.join(absent)}")
    nums = [c for c in feature_names if c not in cat_cols]
    cats = [c for c in feature_names if c in cat_cols]
    edges = reference_edges(reference).collect() if nums else []
    counts = feature_counts(df, edges, nums, cats, MISSING, right_closed=False)
    terms = []
    if nums:
        shares = _shares(counts.bins(), "cur_prop")
        terms.append(reference.where(F.col("kind") == "numeric").join(shares, ["feature", "bin"], "left")
                     .select("feature", "ref_prop", "cur_prop"))
    if cats:
        ref = reference.where(F.col("kind") == "categorical").select("feature", "key", "ref_prop")
        known = ref.where(F.col("key") != OTHER).select("feature", "key", F.col("key").alias("bucket"))
        # a reference holds at most top_k + 1 keys per feature, so it is the side to broadcast
        current = (
            counts.categories().join(F.broadcast(known), ["feature", "key"], "left")
            .groupBy("feature", F.coalesce("bucket", F.lit(OTHER)).alias("key"))
            .agg((F.sum("cnt") / F.lit(counts.n_rows)).alias("cur_prop"))
        )
        terms.append(ref.join(current, ["feature", "key"], "left").select("feature", "ref_prop", "cur_prop"))
    rows = terms[0] if len(terms) == 1 else terms[0].unionByName(terms[1])
    psi = rows.groupBy("feature").agg(F.sum(psi_term(
        clipped_share(F.col("ref_prop")), clipped_share(F.coalesce("cur_prop", F.lit(0.0))))).alias("psi"))
    return (
        _positions(df, feature_names, cat_cols).join(psi, "feature", "left")
        .select("pos", "feature", "kind",
                F.when(F.col("kind") == "categorical", F.coalesce("psi", F.lit(0.0))).otherwise(F.col("psi")).alias("psi"))
        .where(F.col("psi").isNotNull())
    )


def top_drifting(psi: DataFrame, k: int = TOP_FEATURES) -> DataFrame:
    """The k features with the highest PSI; ties keep feature order."""
    return psi.orderBy(F.desc("psi"), "pos").limit(k)


def drift_summary(psi: DataFrame, threshold: float = PSI_THRESHOLD, k: int = TOP_FEATURES) -> DataFrame:
    """One row: drift_detected, drift_threshold, max_psi, n_features_over_threshold, top_features.

    ``psi`` has one row per feature, so the sorted list is bounded by the number of columns.
    """
    ranked = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("psi")).alias("neg"), "pos", "feature"))), 1, k)
    return psi.agg(
        F.coalesce(F.max("psi") >= threshold, F.lit(False)).alias("drift_detected"),
        F.lit(float(threshold)).alias("drift_threshold"),
        F.coalesce(F.max("psi"), F.lit(0.0)).alias("max_psi"),
        F.count_if(F.col("psi") >= threshold).alias("n_features_over_threshold"),
        F.transform(ranked, lambda r: F.struct(r["feature"].alias("feature"), (-r["neg"]).alias("psi"))).alias("top_features"),
    )
