"""Forecast metrics, inventory cost, segment reports and the promotion decision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import COST_OVER, COST_UNDER, DATE, KEYS, PREDICTION, TARGET
from stockcast.functions.scores import cost_from_units, error_aggregates, shortage, surplus


def forecast_metrics(
    df: DataFrame,
    target_col: str = TARGET,
    pred_col: str = PREDICTION,
    by: Sequence[str] = (),
    cost_under: float = COST_UNDER,
    cost_over: float = COST_OVER,
    eps: float = 1e-8,
) -> DataFrame:
    """n, n_null, mae, rmse, mape and cost_total, for all rows or per ``by`` group, in one pass."""
    y, yhat = F.col(target_col), F.col(pred_col)
    aggs = [expr.alias(name) for name, expr in error_aggregates(y, yhat, eps).items()]
    cost = cost_from_units(F.sum(shortage(y, yhat)), F.sum(surplus(y, yhat)), cost_under, cost_over)
    return df.groupBy(*by).agg(*aggs, cost.alias("cost_total"))


def cost_scenarios(
    df: DataFrame,
    scenarios: Sequence[tuple[str, float, float]],
    target_col: str = TARGET,
    pred_col: str = PREDICTION,
    by: Sequence[str] = KEYS,
) -> DataFrame:
    """Cost of every (name, under price, over price) scenario per group.

    Units are summed once per group; the scenarios multiply only the aggregated rows.
    """
    y, yhat = F.col(target_col), F.col(pred_col)
    units = df.groupBy(*by).agg(F.sum(shortage(y, yhat)).alias("short"), F.sum(surplus(y, yhat)).alias("over"))
    options = F.array(*[
        F.struct(F.lit(name).alias("scenario"), F.lit(float(u)).alias("cost_under"), F.lit(float(o)).alias("cost_over"))
        for name, u, o in scenarios
    ])
    return units.select(*by, "short", "over", F.inline(options)).select(
        *by, "scenario", "cost_under", "cost_over",
        cost_from_units(F.col("short"), F.col("over"), F.col("cost_under"), F.col("cost_over")).alias("cost_total"),
    )


def segment_keys(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Distinct segments, for selectors."""
    return df.select(*keys).distinct()


def segment_series(
    df: DataFrame,
    segment: Mapping[str, object] | None = None,
    keys: Sequence[str] = KEYS,
    date_col: str = DATE,
    target_col: str = TARGET,
    pred_col: str = PREDICTION,
    names: tuple[str, str] = ("Real", "Previsto"),
) -> DataFrame:
    """Dates with real and predicted values: of one segment in date order, or of all segments."""
    values = [F.col(date_col), F.col(target_col).alias(names[0]), F.col(pred_col).alias(names[1])]
    if segment is None:
        return df.select(*keys, *values)
    for key, value in segment.items():
        df = df.where(F.col(key) == F.lit(value))
    return df.select(*values).orderBy(date_col)


def promotion(metrics: DataFrame, baseline: str, challenger: str, by: Sequence[str] = ()) -> DataFrame:
    """Promote when the challenger's cost is strictly below the baseline's.

    ``metrics`` has one row per ``candidate`` (and per ``by`` group) with ``cost_total``.
    """
    def cost(name: str):
        return F.max(F.when(F.col("candidate") == name, F.col("cost_total")))

    return metrics.groupBy(*by).agg(
        cost(baseline).alias("baseline_cost"), cost(challenger).alias("model_cost")
    ).withColumn("promote", F.col("model_cost") < F.col("baseline_cost"))
