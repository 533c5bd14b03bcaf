"""Drift references from stored counts per day, so that new rows do not mean another scan of all history.

A day's counts say how often each feature has each value. They are written by months; the counts of any days add up, so a
reference for any cutoff is made from them, and is the one that the rows themselves would give.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockcast.defaults import DATE, MONTH, N_BINS, TOP_K
from stockcast.functions import sqltext as sql
from stockcast.functions.values import FLOATS
from stockcast.operators.drift_width import MISSING, reference_rows_of, width_edges
from stockcast.operators.hot_groups import pinned
from stockcast.operators.temporal import moment, month_number
from stockcast.session import write_stage

DAY = "period_day"


def daily_counts(df: DataFrame, feature_names: Sequence[str], cat_cols: Sequence[str], date_col: str = DATE) -> DataFrame:
    """(feature, value, key, absent, cnt, period_day, date_month) of rows with a date, in one scan, combined on the map side.

    Numbers have ``value`` (NULL where missing), categories ``key``. Absent features are all NULL. Written by ``write_counts``.
    """
    parts = []
    for c in feature_names:
        if c in cat_cols:
            known = c in df.columns
            floating = known and isinstance(df.schema[c].dataType, FLOATS)
            key = f"coalesce(CAST({sql.name(c)} AS STRING), {sql.text(MISSING)})" if known else sql.text(MISSING)
            gone = (f"{sql.name(c)} IS NULL" + f" OR isnan({sql.name(c)})" * floating) if known else "true"
            parts.append(sql.struct(feature=sql.text(c), value="CAST(NULL AS DOUBLE)", key=key, absent=f"({gone})"))
        else:
            value = sql.number(df, c) if c in df.columns else "CAST(NULL AS DOUBLE)"
            parts.append(sql.struct(feature=sql.text(c), value=value, key="CAST(NULL AS STRING)", absent=f"({value} IS NULL)"))
    dated = df.withColumn(DAY, moment(df, date_col).cast("date")).where(F.col(DAY).isNotNull())
    rows = dated.selectExpr(DAY, f"inline({sql.array(parts)})")
    counted = rows.groupBy("feature", "value", "key", "absent", DAY).agg(F.count(F.lit(1)).alias("cnt"))
    return counted.withColumn(MONTH, month_number(F.col(DAY)))


def write_counts(counts: DataFrame, path: str) -> None:
    """Write daily counts by months; the months that ``counts`` has are replaced, others stay."""
    counts.hint("rebalance", F.col(MONTH)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def merged_width_reference(
    counts: DataFrame, cutoff: Column, feature_names: Sequence[str], cat_cols: Sequence[str], n_bins: int = N_BINS, top_k: int = TOP_K
) -> DataFrame:
    """The equal-width reference of all days up to a cutoff, from daily counts (only the months needed are read)."""
    day = cutoff.cast("date")
    upto = counts.where((F.col(MONTH) <= month_number(day)) & (F.col(DAY) <= day))
    merged = write_stage(upto.groupBy("feature", "value", "key", "absent").agg(F.sum("cnt").alias("cnt")), "merged-counts")
    totals = merged.groupBy("feature").agg(F.sum("cnt").alias("n_rows"), F.sum(F.when(F.col("absent"), F.col("cnt")).otherwise(0)).alias("gone"))
    rates = totals.select("feature", "n_rows", (F.col("gone") / F.col("n_rows")).alias("missing_rate"))
    nums = [c for c in feature_names if c not in cat_cols]
    cats = [c for c in feature_names if c in cat_cols]
    bins = tops = edges = None
    if nums:
        known = merged.where(F.col("value").isNotNull())
        means = known.groupBy("feature").agg((F.sum(F.col("value") * F.col("cnt")) / F.sum("cnt")).alias("mean"))
        off = F.col("value") - F.col("mean")
        profile = known.join(F.broadcast(means), "feature").groupBy("feature").agg(
            F.sum("cnt").alias("n"), F.max("mean").alias("mean"),
            F.sqrt(F.sum(off * off * F.col("cnt")) / F.nullif(F.sum("cnt") - 1, F.lit(0))).alias("std"),
            F.min("value").alias("min"), F.max("value").alias("max")).join(F.broadcast(rates), "feature")
        edges = pinned(width_edges(profile, n_bins), "width-edges")[0]
        place = F.size(F.filter("cuts", lambda c: c < F.col("value")))
        bins = known.join(edges.select("feature", "cuts"), "feature").groupBy("feature", place.alias("bin")).agg(F.sum("cnt").alias("cnt"))
    if cats:
        order = Window.partitionBy("feature").orderBy(F.desc("cnt"), "key")
        keyed = merged.where(F.col("key").isNotNull()).groupBy("feature", "key").agg(F.sum("cnt").alias("cnt"))
        tops = keyed.withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= top_k).join(F.broadcast(rates), "feature").select(
            "feature", "key", "cnt", (F.col("cnt") / F.col("n_rows")).alias("share"), "missing_rate", "n_rows")
    return reference_rows_of(feature_names, edges, bins, tops, n_bins)
