"""Saved preprocessing metadata, models and drift references."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.operators.boosting import Forecaster, Preprocess

PREPROCESS_SCHEMA = "model_name string, feature string, pos int, is_cat boolean, value string, code int, input double"


def _read(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        raise FileNotFoundError(f"no saved table at {path}") from exc


def save_preprocess(spark: SparkSession, prep: Preprocess, path: str) -> None:
    """A dictionary table: one row per feature, or per label of a categorical feature."""
    rows = []
    for pos, name in enumerate(prep.feature_names):
        is_cat = name in prep.cat_cols
        labels = [] if name in prep.wide else prep.cat_mapping[name] if is_cat else [None]
        for code, value in enumerate(labels):
            rows.append((prep.model_name, name, pos, is_cat, value, code if is_cat else None, None))
    table = spark.createDataFrame(rows, PREPROCESS_SCHEMA).coalesce(1)
    for name, labels in prep.wide.items():
        table = table.unionByName(labels.select(
            F.lit(prep.model_name).alias("model_name"), F.lit(name).alias("feature"), F.lit(prep.feature_names.index(name)).alias("pos"),
            F.lit(True).alias("is_cat"), "value", F.col("code").cast("int").alias("code"), "input"))
    table.write.mode("overwrite").parquet(path)


def load_preprocess(spark: SparkSession, path: str) -> Preprocess:
    """Read metadata back; an absent path raises FileNotFoundError. Long dictionaries stay tables."""
    table = _read(spark, path)
    listed = table.where(F.col("input").isNull())
    rows = sorted(listed.collect(), key=lambda r: (r["pos"], r["code"] or 0))
    long = {r["pos"]: r["feature"] for r in table.where(F.col("input").isNotNull()).select("pos", "feature").distinct().collect()}
    heads = {r["pos"]: r["feature"] for r in rows} | long
    name = rows[0]["model_name"] if rows else table.select("model_name").first()["model_name"]
    cats = {r["feature"] for r in rows if r["is_cat"]} | set(long.values())
    names = [heads[pos] for pos in sorted(heads)]
    mapping = {c: [r["value"] for r in rows if r["feature"] == c] for c in names if c in cats and c not in long.values()}
    wide = {c: table.where(F.col("feature") == c).select("value", "code", "input") for c in long.values()}
    return Preprocess(name, names, [c for c in names if c in cats], mapping, wide)


def save_forecaster(spark: SparkSession, forecaster: Forecaster, folder: str) -> None:
    save_preprocess(spark, forecaster.preprocess, f"{folder}/preprocess")
    forecaster.pipeline.write().overwrite().save(f"{folder}/pipeline")


def load_forecaster(spark: SparkSession, folder: str) -> Forecaster:
    return Forecaster(load_preprocess(spark, f"{folder}/preprocess"), PipelineModel.load(f"{folder}/pipeline"))


def save_reference(reference: DataFrame, path: str) -> None:
    """Write a drift reference or report; it has a few rows per feature. Open bin ends are NULL."""
    reference.coalesce(1).write.mode("overwrite").parquet(path)


def load_reference(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path)
