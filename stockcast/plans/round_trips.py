"""Registered queries of files, saved artifacts and fallbacks, each over whole test tables, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.defaults import DATE, KEYS, MACRO_COLS, TARGET
from stockcast.functions.values import clip_low
from stockcast.operators import drift_quantile as dq, drift_width as dw, scoring
from stockcast.operators.boosting import fit_preprocess
from stockcast.operators.encode import model_matrix
from stockcast.operators.enrich import enrich_panel
from stockcast.operators.history import history_names
from stockcast.operators.impute import fit_medians
from stockcast.operators.merged_reference import daily_counts, merged_width_reference, write_counts
from stockcast.operators.naive import seasonal_naive
from stockcast.operators.temporal import cutoff_date, latest_batch, month_number, reference_rows, temporal_split
from stockcast.plans import queries as base
from stockcast.session import note_stage, shared_dir, write_stage
from stockcast.sources import artifacts, json_artifacts
from stockcast.sources.files import SCHEMAS, read_csv, write_by_month
from stockcast.sources.panel import panel_tables, sales_panel, store_features, table
from stockcast.sources.series_layout import SeriesLayout, layout_history, layout_naive, layout_report, write_series_layout

LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
FLAG = "l_returnflag"
SPELLINGS = ("NA", "NaN", "null", "#N/A", "n/a")


def _place(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    note_stage(path)
    return path


def q_csv_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Store features as a CSV file with several spellings of a missing value, read back by the declared schema."""
    features = store_features(spark, folder)
    names = [part.split()[0] for part in SCHEMAS["features"].split(", ")]
    spelled = F.element_at(F.array(*map(F.lit, SPELLINGS)), F.col("Store") % len(SPELLINGS) + 1)
    text = [F.coalesce(F.col(c).cast("string") if c in features.columns else F.lit(None), spelled).alias(c) for c in names]
    path = f"{_place(spark, 'csv')}/features.csv"
    features.select(*text).write.option("header", True).csv(path)
    return read_csv(spark, path, SCHEMAS["features"])


def q_preprocess_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Preprocessing metadata of the enriched panel, written and read as a table and as a document."""
    panel = write_stage(enrich_panel(*panel_tables(spark, folder)), "panel")
    train, valid, _ = temporal_split(panel)
    prep = fit_preprocess(train, valid)
    path = _place(spark, "preprocess")
    json_artifacts.write_preprocess(spark, prep, f"{path}/document")
    again = json_artifacts.read_preprocess(spark, f"{path}/document")
    artifacts.save_preprocess(spark, again, f"{path}/table")
    loaded = artifacts.load_preprocess(spark, f"{path}/table")
    rows = [(pos, c, c in loaded.cat_cols, code, value) for pos, c in enumerate(loaded.feature_names)
            for code, value in enumerate(loaded.cat_mapping.get(c, [None]))]
    return spark.createDataFrame(rows, "pos int, feature string, is_cat boolean, code int, value string")


def _line_split(spark: SparkSession, folder: str) -> list[DataFrame]:
    return list(temporal_split(table(spark, folder, "lineitem").select(*LINE_NUMBERS, "l_shipdate", FLAG), "l_shipdate", 365)[:2])


def q_quantile_reference_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """A quantile reference as a document with infinite edges, read back and saved as a table."""
    before, _ = _line_split(spark, folder)
    path = _place(spark, "reference")
    json_artifacts.write_quantile_reference(dq.quantile_reference(before, [*LINE_NUMBERS, FLAG], [FLAG], edge_digits=12), f"{path}/document")
    artifacts.save_reference(json_artifacts.read_quantile_reference(spark, f"{path}/document"), f"{path}/table")
    return artifacts.load_reference(spark, f"{path}/table").select("pos", "feature", "kind", "bin", "lo", "hi", "key", "ref_prop", "n_ref")


def q_width_reference_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """An equal-width reference as a document and as a table; the report by what was read back, as a document too."""
    before, after = _line_split(spark, folder)
    path = _place(spark, "reference")
    json_artifacts.write_width_reference(dw.width_reference(before, [*LINE_NUMBERS, FLAG], [FLAG]), f"{path}/document")
    artifacts.save_reference(json_artifacts.read_width_reference(spark, f"{path}/document"), f"{path}/table")
    report = dw.drift_report(after, artifacts.load_reference(spark, f"{path}/table"), [*LINE_NUMBERS, FLAG], [FLAG])
    json_artifacts.write_drift_report(report, f"{path}/report")
    schema = ("n_batch_rows bigint, features map<string, struct<psi double, mean_batch double, std_batch double, "
              "missing_rate double, top_value_drift map<string, double>>>")
    read = spark.read.schema(schema).json(f"{path}/report").selectExpr("n_batch_rows", "explode(features) AS (feature, f)")
    return read.selectExpr(
        "feature", "n_batch_rows", "round(f.psi, 9) AS psi", "round(f.mean_batch, 6) AS mean_batch", "round(f.std_batch, 6) AS std_batch",
        "f.missing_rate AS missing_rate", "round(f.top_value_drift['N'], 9) AS delta_n")


def q_impute_overall(spark: SparkSession, folder: str) -> DataFrame:
    """Medians where one store lacks a column: its rows take the median of the column as filled by the stores."""
    lacking = enrich_panel(*panel_tables(spark, folder)).withColumn("CPI", F.when(F.col("Store") != 1, F.col("CPI")))
    panel = write_stage(lacking, "panel")
    fill = fit_medians(panel)
    rounded = {c: F.round(c, 3) for c in MACRO_COLS if c in panel.columns}
    return fill.apply(panel).withColumns(rounded).withColumn("overall_used", F.lit("CPI" in fill.overall))


def q_naive_overall(spark: SparkSession, folder: str) -> DataFrame:
    """A forecast for series that training has never seen: the overall median."""
    sales = write_stage(sales_panel(spark, folder).withColumn(TARGET, clip_low(F.col(TARGET), 0)), "sales")
    train, valid, _ = temporal_split(sales)
    renamed = valid.withColumn("Dept", F.when(F.col("Store") == 2, F.concat(F.lit("new "), F.col("Dept"))).otherwise(F.col("Dept")))
    return seasonal_naive(train, renamed).withColumn("pred", F.round("pred", 4))


def _coerced(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines with a number kept as text, every third of them no number, and a ratio that may be infinite."""
    lines = table(spark, folder, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_tax", "l_shipdate", FLAG,
        F.when(F.col("l_orderkey") % 3 == 0, F.lit("bad")).otherwise(F.col("l_quantity").cast("string")).alias("amount"),
        F.when(F.col("l_discount") == 0, F.lit(float("inf"))).otherwise(F.try_divide("l_extendedprice", "l_discount")).alias("ratio"))


def q_matrix_coerced(spark: SparkSession, folder: str) -> DataFrame:
    """Model inputs from text, infinities, an absent column and labels not known: 0 or the missing label."""
    return model_matrix(
        _coerced(spark, folder), ["amount", "ratio", "absent", "l_tax", FLAG], {FLAG: ["A", "missing"]}, keep=["l_orderkey", "l_linenumber"])


def q_drift_coerced(spark: SparkSession, folder: str) -> DataFrame:
    """Drift of a number kept as text and of a column with infinities; what is no number counts as missing."""
    before, after, _ = temporal_split(_coerced(spark, folder), "l_shipdate", 365)
    names = ["amount", "ratio"]
    report = dw.drift_report(after, write_stage(dw.width_reference(before, names, []), "reference"), names, [])
    return report.select("feature", *[F.round(c, 6).alias(c) for c in ("psi", "out_of_range_rate")], "n_batch_rows")


def q_reference_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Orders up to the cutoff where dates are text and some are none: those are in no reference."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", F.lit("unknown")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"))
    return reference_rows(orders, cutoff_date(orders, "day", 28), "day")


def q_segment_one(spark: SparkSession, folder: str) -> DataFrame:
    """The series of one store and its first department, in date order."""
    sales = write_stage(sales_panel(spark, folder).withColumn(TARGET, clip_low(F.col(TARGET), 0)), "sales")
    train, valid, _ = temporal_split(sales)
    forecast = seasonal_naive(train, valid)
    first = forecast.where(F.col("Store") == 1).agg(F.min("Dept")).first()[0]
    return scoring.segment_series(forecast, dict(zip(KEYS, (1, first))), pred_col="pred").withColumn("Previsto", F.round("Previsto", 4))


def q_merged_reference(spark: SparkSession, folder: str) -> DataFrame:
    """A reference of order lines from counts per day: history stored once, the last months added later, then merged up to the cutoff."""
    names = [*LINE_NUMBERS, FLAG]
    lines = table(spark, folder, "lineitem").select(*names, "l_shipdate")
    path = f"{_place(spark, 'daily')}/counts"
    old, new, _ = temporal_split(lines, "l_shipdate", 700)
    write_counts(daily_counts(old, names, [FLAG], "l_shipdate"), path)
    first = month_number(new.agg(F.min("l_shipdate").cast("date").alias("d")).select("d").scalar())
    later = lines.where(month_number(F.col("l_shipdate")) >= first)  # whole months, so the month of the border is written again
    write_counts(daily_counts(later, names, [FLAG], "l_shipdate"), path)
    cutoff = cutoff_date(lines.select(F.col("l_shipdate").cast("date").alias("d")), "d", 365)
    ref = merged_width_reference(spark.read.parquet(path), cutoff, names, [FLAG])
    return ref.withColumns({c: F.round(c, 6) for c in ("mean", "std")}).drop("kind")


def q_gold_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """Weekly sales written by months, the last months written again, and the latest batch read from what it needs."""
    path = f"{_place(spark, 'by-month')}/sales"
    sales = write_stage(sales_panel(spark, folder), "sales")
    write_by_month(sales, path)
    again = latest_batch(sales, horizon_days=70)
    months = again.select(month_number(F.col("Date")).alias("m")).distinct()
    write_by_month(sales.join(F.broadcast(months), month_number(F.col("Date")) == F.col("m"), "left_semi"), path)
    whole = spark.read.parquet(path)
    rows = whole.count()
    return latest_batch(whole).withColumn("n_rows", F.lit(rows))


def _by_series(sales: DataFrame) -> SeriesLayout:
    """Weekly sales by series: those longer than 300 weeks lie beside the buckets."""
    return write_series_layout(write_stage(sales, "sales"), buckets=8, max_series_rows=300)


def _clipped(spark: SparkSession, folder: str) -> DataFrame:
    return sales_panel(spark, folder).withColumn(TARGET, clip_low(F.col(TARGET), 0))


def q_layout_history(spark: SparkSession, folder: str) -> DataFrame:
    """The rolling values of ``rolling_features``, from sales written by series."""
    out = layout_history(_by_series(sales_panel(spark, folder, money=base.EXACT)))
    return base._exact_history(out).select(*KEYS, DATE, TARGET, *history_names((), (4, 8, 12)))


def q_layout_naive(spark: SparkSession, folder: str) -> DataFrame:
    """The forecast of ``seasonal_naive``, from sales written by series."""
    return layout_naive(_by_series(_clipped(spark, folder))).withColumn("pred", F.round("pred", 4))


def q_layout_report(spark: SparkSession, folder: str) -> DataFrame:
    """The report of ``segment_report``, from sales written by series."""
    return base.rounded(layout_report(_by_series(_clipped(spark, folder)), base._exact_pair), "mape")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
