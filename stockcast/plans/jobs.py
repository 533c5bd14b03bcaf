"""The end-to-end jobs: build the dataset, train and compare, score a batch, report segments.

Each job hands its result on as a parquet table, so a lost executor repeats one stage only and
later steps read pruned columns with pushed date filters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.defaults import (
    COST_OVER, COST_UNDER, DATE, HORIZON_DAYS, KEYS, LAGS, MACRO_COLS, PREDICTION, STORE, TARGET, WINDOWS,
)
from stockcast.operators.boosting import Forecaster, fit_forecaster, score
from stockcast.operators.calendar import add_calendar, date_parts
from stockcast.operators.drift_width import drift_report, width_reference
from stockcast.operators.enrich import enrich_panel
from stockcast.operators.history import add_history, history_names
from stockcast.operators.hot_groups import MAX_GROUP_ROWS
from stockcast.operators.impute import finalize_features
from stockcast.operators.naive import seasonal_naive
from stockcast.operators.scoring import cost_scenarios, forecast_metrics, promotion
from stockcast.operators.temporal import latest_batch, reference_rows, temporal_split
from stockcast.sources.artifacts import load_forecaster, load_reference, save_forecaster, save_reference
from stockcast.session import own_stages, write_stage
from stockcast.sources.files import read_parquet, read_raw, write_by_month, write_parquet


def build_dataset(
    sales: DataFrame,
    features: DataFrame,
    stores: DataFrame,
    keys: Sequence[str] = KEYS,
    target_col: str = TARGET,
    store_col: str = STORE,
    date_col: str = DATE,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    macro_cols: Sequence[str] = MACRO_COLS,
    max_series_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Enrich, calendar, history, impute, keep full history, clip.

    Lags see unclipped targets, and medians all rows, also those without full history.
    """
    # several steps read the joined rows: join once
    enriched = write_stage(enrich_panel(sales, features, stores, store_col, date_col), "enriched")
    # rows without a series key get no history and would be dropped below: leave them out of the shuffle
    keyed = enriched.dropna(subset=list(keys)) if (lags or windows) else enriched
    known = add_history(
        keyed, keys, target_col, date_col, lags, windows, max_series_rows=max_series_rows)
    # calendar columns need no history; added after the series shuffle they do not travel through it
    dated = add_calendar(known, date_col)
    history = history_names(lags, windows)
    dated = dated.select(*[c for c in dated.columns if c not in history], *history)
    # medians need neither calendar nor history, so they are fitted on the joined rows alone
    return finalize_features(dated, store_col, target_col, macro_cols, fit_rows=enriched)


@dataclass(frozen=True)
class TrainingResult:
    forecaster: Forecaster
    predictions: DataFrame
    metrics: DataFrame
    decision: DataFrame
    reference: DataFrame


def evaluate_candidates(
    scored: dict[str, tuple[DataFrame, str]],
    target_col: str = TARGET,
    cost_under: float = COST_UNDER,
    cost_over: float = COST_OVER,
) -> DataFrame:
    """One metrics row per candidate: name -> (frame, prediction column)."""
    rows = [
        forecast_metrics(df, target_col, pred, cost_under=cost_under, cost_over=cost_over)
        .select(F.lit(name).alias("candidate"), "*")
        for name, (df, pred) in scored.items()
    ]
    out = rows[0]
    for more in rows[1:]:
        out = out.unionByName(more)
    return out


def run_training(
    dataset: DataFrame,
    keys: Sequence[str] = KEYS,
    target_col: str = TARGET,
    date_col: str = DATE,
    horizon_days: int = HORIZON_DAYS,
    cost_under: float = COST_UNDER,
    cost_over: float = COST_OVER,
    **fit_options,
) -> TrainingResult:
    """Split, naive baseline, boosted model, metrics of both, promotion decision, drift reference.

    ``dataset`` should be a written table, as it is read several times.
    """
    train, valid, cutoff = temporal_split(dataset, date_col, horizon_days)
    baseline = seasonal_naive(train, valid, keys, date_col, target_col)
    forecaster = fit_forecaster(train, valid, target_col, **fit_options)
    predictions = score(forecaster, valid, target_col)
    metrics = evaluate_candidates(
        {"baseline": (baseline, "pred"), "model": (predictions, PREDICTION)}, target_col, cost_under, cost_over)
    prep = forecaster.preprocess
    watched = reference_rows(dataset, cutoff, date_col)
    reference = width_reference(date_parts(watched.drop(target_col)), prep.feature_names, prep.cat_cols)
    return TrainingResult(forecaster, predictions, metrics, promotion(metrics, "baseline", "model"), reference)


def run_batch(
    dataset: DataFrame,
    forecaster: Forecaster,
    reference: DataFrame | None,
    target_col: str = TARGET,
    date_col: str = DATE,
    horizon_days: int = HORIZON_DAYS,
) -> tuple[DataFrame, DataFrame | None]:
    """Score the latest rows and report their drift; without a reference there is no report."""
    batch = latest_batch(dataset, date_col, horizon_days)
    predictions = score(forecaster, batch, target_col)
    if reference is None:
        return predictions, None
    prep = forecaster.preprocess
    return predictions, drift_report(date_parts(batch.drop(target_col)), reference, prep.feature_names, prep.cat_cols)


def segment_report(
    predictions: DataFrame,
    scenarios: Sequence[tuple[str, float, float]] = (("default", COST_UNDER, COST_OVER),),
    keys: Sequence[str] = KEYS,
    target_col: str = TARGET,
    pred_col: str = PREDICTION,
) -> tuple[DataFrame, DataFrame]:
    """Metrics of all segments in one pass, and their cost under each price scenario."""
    metrics = forecast_metrics(predictions, target_col, pred_col, by=keys)
    return metrics, cost_scenarios(predictions, scenarios, target_col, pred_col, by=keys)


def training_job(spark: SparkSession, raw_dir: str, out_dir: str, **options) -> DataFrame:
    """Raw CSV files to dataset, model, predictions, metrics, drift reference and promotion decision.

    All results are written below ``out_dir``, the dataset by months; returns the written decision. Intermediate tables are
    removed at the end.
    """
    with own_stages(spark):
        raw = read_raw(spark, raw_dir)
        write_by_month(build_dataset(raw["train"], raw["features"], raw["stores"]), f"{out_dir}/dataset")
        result = run_training(read_parquet(spark, f"{out_dir}/dataset"), **options)
        write_parquet(result.predictions, f"{out_dir}/valid_predictions")
        write_parquet(result.metrics, f"{out_dir}/metrics")
        save_reference(result.reference, f"{out_dir}/drift_reference")
        save_forecaster(spark, result.forecaster, f"{out_dir}/model")
        metrics = read_parquet(spark, f"{out_dir}/metrics")
        write_parquet(promotion(metrics, "baseline", "model"), f"{out_dir}/decision")
    return read_parquet(spark, f"{out_dir}/decision")


def batch_job(spark: SparkSession, out_dir: str, horizon_days: int = HORIZON_DAYS) -> DataFrame | None:
    """Score the latest rows of the written dataset and report drift; None without a reference.

    Predictions are written by months: a later run replaces the months it covers. Intermediate tables are removed at the end.
    """
    with own_stages(spark):
        forecaster = load_forecaster(spark, f"{out_dir}/model")
        try:
            reference = load_reference(spark, f"{out_dir}/drift_reference")
        except FileNotFoundError:
            reference = None
        predictions, report = run_batch(read_parquet(spark, f"{out_dir}/dataset"), forecaster, reference, horizon_days=horizon_days)
        write_by_month(predictions, f"{out_dir}/batch_predictions")
        if report is None:
            return None
        save_reference(report, f"{out_dir}/drift_report")
    return load_reference(spark, f"{out_dir}/drift_report")
