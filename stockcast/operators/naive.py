"""Seasonal-naive forecast: last year's value, else the series median, else the overall median."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import DATE, KEYS, SEASON_DAYS, TARGET
from stockcast.operators.hot_groups import pinned
from stockcast.operators.quantiles import exact_quantiles, medians_wide

SEASONAL, MEDIAN = "__seasonal", "__median"


def attach_season(
    train: DataFrame,
    valid: DataFrame,
    keys: Sequence[str] = KEYS,
    date_col: str = DATE,
    target_col: str = TARGET,
    season_days: int = SEASON_DAYS,
) -> DataFrame:
    """LEFT join of each validation row with the training value ``season_days`` earlier.

    Only the training dates the validation range can reach are read.
    """
    reach = valid.agg(
        F.date_sub(F.min(date_col), season_days).alias("first"),
        F.date_sub(F.max(date_col), season_days).alias("last"),
    )
    lookup = train.where(
        (F.col(date_col) >= reach.select("first").scalar()) & (F.col(date_col) <= reach.select("last").scalar())
    ).select(*keys, F.date_add(date_col, season_days).alias(date_col), F.col(target_col).alias(SEASONAL))
    return valid.join(lookup, [*keys, date_col], "left")


def fill_with_medians(
    rows: DataFrame,
    train: DataFrame,
    keys: Sequence[str] = KEYS,
    target_col: str = TARGET,
    out_col: str = "pred",
    seasonal_col: str | None = None,
    overall_from: DataFrame | None = None,
) -> DataFrame:
    """Forecast column from an optional seasonal value, then series median, then overall median.

    Medians are computed only for series that still need one, the overall median only if a
    needed series has no training value. All median values are exact. ``overall_from`` holds all
    training rows where ``train`` is a part of them.
    """
    keys = list(keys)
    open_rows = rows.where(F.col(seasonal_col).isNull()) if seasonal_col else rows
    need, need_rows = pinned(open_rows.select(*keys).distinct(), "open-series")
    value = F.col(seasonal_col).cast("double") if seasonal_col else F.lit(None).cast("double")
    if need_rows == []:
        return rows.withColumn(out_col, value)
    target = train.select(*keys, F.col(target_col).alias(MEDIAN))
    wanted = target.join(need, keys, "left_semi")
    medians, median_rows = pinned(medians_wide(wanted, [MEDIAN], keys, "").where(F.col(MEDIAN).isNotNull()), "series-medians")
    if need_rows is None or median_rows is None:
        covered = need.join(medians, keys, "left_anti").isEmpty()
    else:
        found = {tuple(r[k] for k in keys) for r in median_rows}
        covered = all(tuple(r[k] for k in keys) in found for r in need_rows)
    if overall_from is not None:
        target = overall_from.select(F.col(target_col).alias(MEDIAN))
    overall = None if covered else exact_quantiles(target, [MEDIAN], [0.5], median_rule=True).first()["quantiles"][0]
    return (
        rows.join(medians, keys, "left")
        .withColumn(out_col, F.coalesce(value, F.col(MEDIAN), F.lit(overall).cast("double")))
        .drop(MEDIAN)
    )


def seasonal_naive(
    train: DataFrame,
    valid: DataFrame,
    keys: Sequence[str] = KEYS,
    date_col: str = DATE,
    target_col: str = TARGET,
    out_col: str = "pred",
    season_days: int = SEASON_DAYS,
    overall_from: DataFrame | None = None,
) -> DataFrame:
    """Validation rows with a forecast in ``out_col``. Duplicate lookup rows fan out."""
    joined = attach_season(train, valid, keys, date_col, target_col, season_days)
    return fill_with_medians(joined, train, keys, target_col, out_col, SEASONAL, overall_from).select(*valid.columns, out_col)
