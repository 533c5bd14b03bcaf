"""Registered queries: each runs one or more operators over whole test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stockcast.defaults import DATE, KEYS, PREDICTION, TARGET
from stockcast.functions.dates import parse_date
from stockcast.functions.values import clip_low
from stockcast.operators import drift_quantile as dq, drift_width as dw
from stockcast.operators.boosting import fit_forecaster, fit_preprocess, score, score_by_expression
from stockcast.operators.calendar import add_calendar, date_parts
from stockcast.operators.distributions import column_profile, top_categories
from stockcast.operators.encode import apply_dictionary, category_dictionary, model_matrix
from stockcast.operators.enrich import enrich_panel
from stockcast.operators.history import add_history, history_names
from stockcast.operators.hot_groups import MAX_GROUP_ROWS
from stockcast.operators.impute import fit_medians
from stockcast.operators.naive import fill_with_medians, seasonal_naive
from stockcast.operators.quantiles import exact_quantiles
from stockcast.operators import scoring
from stockcast.operators.temporal import latest_batch, reference_rows, temporal_split
from stockcast.plans import jobs
from stockcast.session import write_stage
from stockcast.sources.panel import panel_tables, sales_panel, store_dimension, store_features, table

EXACT = "decimal(18,2)"
SCENARIOS = (("default", 6.0, 1.5), ("balanced", 1.0, 1.0), ("overstock", 1.5, 6.0))
GOLD_NUMBERS = [
    "Store", "MarkDown1", "MarkDown2", "CPI", "Unemployment", "Size", "IsHoliday", "year", "month", "weekofyear", "dayofweek",
    "is_month_start", "is_month_end", *history_names(),
    *[f"Date_{part}" for part in ("year", "month", "week", "day", "dow", "dayofyear", "ts")]]
GOLD_FEATURES = [*GOLD_NUMBERS, "Type", "Dept"]
GOLD_CATS = ["Type", "Dept"]
LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
#: Few enough rounds for a query, but patience ends the fit, not the bound on rounds.
FIT = dict(num_boost_round=2_000, early_stopping_rounds=4, step_size=0.4, max_depth=4)
EVENT_DAYS = 10
EVENT_PIECE = 5_000  # rows of a piece of an event series in the query that cuts them, at every scale
WEEKLY = None  # no size check: the panel is grouped by series and week, so a series is as long as its weeks


def sig(col: Column, digits: int = 9) -> Column:
    """Round to significant digits, so that sums in another order compare equal."""
    x = col.cast("double")
    e = F.floor(F.log10(F.abs(x)))
    scale = F.pow(F.lit(10.0), F.abs(e))
    small = F.round(x * scale, digits) / scale
    return F.when(x == 0, F.lit(0.0)).when(e < 0, small).otherwise(F.round(x / scale, digits) * scale)


def rounded(df: DataFrame, *cols: str) -> DataFrame:
    return df.withColumns({c: sig(F.col(c)) for c in cols})


def _doubles(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in names})


def _sales(spark: SparkSession, folder: str, money: str = "double") -> DataFrame:
    return sales_panel(spark, folder, money=money)


def _clipped(spark: SparkSession, folder: str) -> DataFrame:
    return write_stage(_sales(spark, folder).withColumn(TARGET, clip_low(F.col(TARGET), 0)), "sales")


def _exact_history(df: DataFrame) -> DataFrame:
    """Exact means and lags as doubles, stds to two decimals."""
    df = _doubles(df, [TARGET, "lag_1", "lag_2", "lag_3", "lag_4"])
    return df.withColumns({c: F.round(c, 2) for c in df.columns if c.startswith("roll_std_")})


def _exact_macro(df: DataFrame) -> DataFrame:
    """Medians of cents have at most three decimals."""
    return df.withColumns({c: F.round(c, 3) for c in ("MarkDown1", "MarkDown2", "CPI", "Unemployment")})


def _dataset(spark: SparkSession, folder: str) -> DataFrame:
    return _exact_macro(_exact_history(jobs.build_dataset(
        sales_panel(spark, folder, money=EXACT), store_features(spark, folder), store_dimension(spark, folder),
        max_series_rows=WEEKLY)))


def _gold(spark: SparkSession, folder: str) -> DataFrame:
    return write_stage(_dataset(spark, folder), "dataset")


# enrichment, calendar, history, imputation

def q_enrich_panel(spark, folder):
    return enrich_panel(*panel_tables(spark, folder))


def q_calendar_features(spark, folder):
    return add_calendar(_sales(spark, folder).select(*KEYS, DATE))


def q_parse_dates(spark, folder):
    text = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, folder, "events").select(
        "event_id",
        parse_date(F.col("ts")).alias("day"),
        parse_date(F.date_format("ts", "yyyy-MM-dd"), strict=True).alias("strict_day"),
        parse_date(text, strict=False).alias("lenient_day"),
    )


def q_model_date_parts(spark, folder):
    orders = table(spark, folder, "orders")
    return date_parts(orders.select("o_orderkey", F.col("o_orderdate").alias("at"), F.col("o_orderdate").cast("date").alias("day")))


def q_lag_features(spark, folder):
    names = ["lag_1", "lag_2", "lag_3", "lag_4"]
    return add_history(_sales(spark, folder), windows=(), max_series_rows=WEEKLY).select(*KEYS, DATE, TARGET, *names)


def q_rolling_features(spark, folder):
    out = add_history(_sales(spark, folder, EXACT), max_series_rows=WEEKLY)
    return _exact_history(out).select(*KEYS, DATE, TARGET, *history_names((), (4, 8, 12)))


def q_rolling_features_split(spark, folder):
    """The same rolling values with every series over 100 rows cut into pieces."""
    out = add_history(write_stage(_sales(spark, folder, EXACT), "sales"), max_series_rows=100)
    return _exact_history(out).select(*KEYS, DATE, TARGET, *history_names((), (4, 8, 12)))


def q_event_history(spark, folder):
    """Lags and means over five series that hold all events."""
    return _event_history(_events(spark, folder, F.col("ts")))


def q_event_history_ties(spark, folder):
    """The same over days: all events of a type and day tie, and are ordered by their ids."""
    return _event_history(_events(spark, folder, F.date_trunc("day", "ts")))


def q_event_history_pieces(spark, folder):
    """The same over days, with ids as text that breaks ties, in pieces of a range exchange."""
    by_day = _events(spark, folder, F.date_trunc("day", "ts")).withColumn("event_id", F.lpad(F.col("event_id").cast("string"), 12, "0"))
    out = _event_history(write_stage(by_day, "events"), EVENT_PIECE)
    return out.withColumn("event_id", F.col("event_id").cast("bigint"))


def _events(spark, folder, at: Column) -> DataFrame:
    return table(spark, folder, "events").select("event_type", at.alias("ts"), "event_id", F.col("value").cast("decimal(18,4)").alias("value"))


def _event_history(events: DataFrame, piece: int = MAX_GROUP_ROWS) -> DataFrame:
    out = add_history(events, ["event_type"], "value", "ts", lags=(1, 2), windows=(4, 8), tie_cols=["event_id"], max_series_rows=piece)
    return _doubles(out, ["value", "lag_1", "lag_2"]).withColumns({c: sig(F.col(c), 6) for c in ("roll_std_4", "roll_std_8")}).select(
        "event_id", "event_type", "value", "lag_1", "lag_2", "roll_mean_4", "roll_mean_8", "roll_std_4", "roll_std_8")


def q_impute_macro(spark, folder):
    panel = write_stage(enrich_panel(*panel_tables(spark, folder)), "panel")
    return _exact_macro(fit_medians(panel).apply(panel))


def q_build_dataset(spark, folder):
    return _dataset(spark, folder)


# split, baseline, scores

def q_split_counts(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderdate")
    train, valid, _ = temporal_split(orders, "o_orderdate", 28)

    def part(name: str, df: DataFrame) -> DataFrame:
        day = F.col("o_orderdate").cast("date")
        return df.agg(F.lit(name).alias("part"), F.count(F.lit(1)).alias("n"), F.min(day).alias("first_day"), F.max(day).alias("last_day"))

    return part("train", train).unionByName(part("valid", valid))


def q_batch_slice(spark, folder):
    return latest_batch(_sales(spark, folder))


def _naive(spark, folder) -> tuple[DataFrame, DataFrame, DataFrame]:
    train, valid, _ = temporal_split(_clipped(spark, folder))
    return train, valid, seasonal_naive(train, valid)


def _exact_pair(df: DataFrame, pred: str = "pred") -> DataFrame:
    """Target and forecast as decimals, so that error sums are exact."""
    return df.withColumns({TARGET: F.col(TARGET).cast("decimal(18,4)"), pred: F.col(pred).cast("decimal(18,4)")})


def q_seasonal_naive(spark, folder):
    return _naive(spark, folder)[2].withColumn("pred", F.round("pred", 4))


def q_eval_baseline(spark, folder):
    return rounded(scoring.forecast_metrics(_exact_pair(_naive(spark, folder)[2]), pred_col="pred"), "mape")


def q_segment_report(spark, folder):
    report = scoring.forecast_metrics(_exact_pair(_naive(spark, folder)[2]), pred_col="pred", by=KEYS)
    return rounded(report, "mape")


def q_segment_series(spark, folder):
    return scoring.segment_series(_naive(spark, folder)[2], pred_col="pred").withColumn("Previsto", F.round("Previsto", 4))


def q_cost_scenarios(spark, folder):
    return scoring.cost_scenarios(_exact_pair(_naive(spark, folder)[2]), SCENARIOS, pred_col="pred")


def q_segment_keys(spark, folder):
    return scoring.segment_keys(_sales(spark, folder)).orderBy(*KEYS)


def q_promotion_decision(spark, folder):
    """Per store: does the plain series median cost less than the seasonal forecast?"""
    train, valid, naive = _naive(spark, folder)
    median = fill_with_medians(valid, train)
    rows = [
        scoring.forecast_metrics(_exact_pair(df), pred_col="pred", by=["Store"]).withColumn("candidate", F.lit(name))
        for name, df in (("seasonal", naive), ("median", median))
    ]
    return scoring.promotion(rows[0].unionByName(rows[1]), "seasonal", "median", by=["Store"])


def q_supplier_brand_costs(spark, folder):
    """Seasonal forecast and its cost per supplier over the finest panel: supplier x brand x week."""
    panel = sales_panel(spark, folder, store="l_suppkey", dept="p_brand")
    panel = write_stage(panel.withColumn(TARGET, clip_low(F.col(TARGET), 0)), "fine-sales")
    train, valid, _ = temporal_split(panel)
    scored = _exact_pair(seasonal_naive(train, valid))
    return rounded(scoring.forecast_metrics(scored, pred_col="pred", by=["Store"]), "mape")


def q_supplier_brand_history(spark, folder):
    """History features summed up per supplier over the finest panel."""
    panel = sales_panel(spark, folder, store="l_suppkey", dept="p_brand", money=EXACT)
    known = add_history(panel, max_series_rows=WEEKLY)
    return known.groupBy("Store").agg(
        F.count("lag_4").alias("n_lag_4"), F.count("roll_mean_12").alias("n_roll_12"),
        F.sum("lag_1").cast("double").alias("sum_lag_1"),
        F.sum(F.col("roll_mean_4").cast("decimal(24,6)")).cast("double").alias("sum_mean_4"),
    )


# model inputs

def _known_labels(spark, folder) -> DataFrame:
    suppliers = table(spark, folder, "supplier").where(F.col("s_acctbal") < 0)
    nations = table(spark, folder, "nation")
    return nations.join(suppliers, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi").select(F.col("n_name").alias("nation"))


def q_category_dictionary(spark, folder):
    panel = write_stage(enrich_panel(*panel_tables(spark, folder)), "panel")
    train, valid, _ = temporal_split(panel)
    return category_dictionary([train, valid], GOLD_CATS)


def q_category_apply(spark, folder):
    """Customers' nations through a dictionary that has seen only some of them."""
    known = write_stage(category_dictionary([_known_labels(spark, folder)], ["nation"]), "labels")
    customers = table(spark, folder, "customer").join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return apply_dictionary(customers.select("c_custkey", F.col("n_name").alias("nation")), "nation", known)


def q_feature_matrix(spark, folder):
    gold = _gold(spark, folder).withColumn("Size", F.col("Size").cast("string"))
    depts = fit_preprocess(gold.select("Dept"), gold.select("Dept")).cat_mapping["Dept"]
    names = ["Size", "MarkDown1", "MarkDown5", "Type", "Dept", "lag_1", "roll_mean_4", "Date_year", "Date_dayofyear", "Date_ts"]
    keep = ["Store", "Date_week"]
    return model_matrix(date_parts(gold.drop(TARGET)), names, {"Type": ["ASIA", "EUROPE", "missing"], "Dept": depts}, keep=keep)


# distributions and drift

def q_column_profile(spark, folder):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]
    return rounded(column_profile(table(spark, folder, "lineitem"), cols), "mean", "std", "std_batch")


def q_exact_quantiles(spark, folder):
    out = exact_quantiles(table(spark, folder, "lineitem"), ["l_extendedprice", "l_quantity"], [i / 10 for i in range(11)], ["l_returnflag"])
    return out.select("l_returnflag", "feature", "n", F.posexplode("quantiles").alias("decile", "q")).withColumn("q", F.round("q", 5))


def _events_split(spark, folder):
    events = table(spark, folder, "events").select("ts", "value", "event_type", F.col("user_id").cast("string").alias("user_id"))
    return temporal_split(events, "ts", EVENT_DAYS)[:2]


def _gold_split(spark, folder):
    train, valid, _ = temporal_split(_gold(spark, folder))
    return [date_parts(df.drop(TARGET)) for df in (train, valid)]


def q_drift_width_reference(spark, folder):
    train, _ = _gold_split(spark, folder)
    ref = dw.width_reference(train, GOLD_NUMBERS, [])
    return rounded(ref.select("pos", "feature", "bin", "lo", "hi", "cnt", "share", "missing_rate", "mean", "std", "min", "max", "n_rows"),
                   "mean", "std")


def q_drift_width_report(spark, folder):
    train, valid = _gold_split(spark, folder)
    ref = write_stage(dw.width_reference(train, GOLD_NUMBERS, []), "reference")
    report = dw.drift_report(valid, ref, GOLD_NUMBERS, [])
    return rounded(report.select("pos", "feature", "psi", "mean_batch", "std_batch", "out_of_range_rate", "n_batch_rows"),
                   "psi", "mean_batch", "std_batch", "out_of_range_rate")


def _mixed_report(spark, folder):
    train, valid = _gold_split(spark, folder)
    ref = write_stage(dw.width_reference(train, GOLD_FEATURES, GOLD_CATS), "reference")
    return dw.drift_report(valid, ref, GOLD_FEATURES, GOLD_CATS)


def q_drift_report_mixed(spark, folder):
    """One report over all features, numbers and categories together."""
    return rounded(_mixed_report(spark, folder), "psi", "mean_batch", "std_batch", "out_of_range_rate").withColumn("delta", F.round("delta", 9))


def _line_split(spark, folder):
    lines = table(spark, folder, "lineitem").select(*LINE_NUMBERS, "l_shipdate", "l_returnflag")
    return temporal_split(lines, "l_shipdate", 365)[:2]


def q_drift_width_bins20(spark, folder):
    """Order lines against a reference of 20 bins, which the report reads from the reference."""
    before, after = _line_split(spark, folder)
    ref = write_stage(dw.width_reference(before, LINE_NUMBERS, [], n_bins=20), "reference")
    report = dw.drift_report(after, ref, LINE_NUMBERS, [])
    return rounded(report.select("feature", "psi", "mean_batch", "std_batch", "out_of_range_rate", "n_batch_rows"),
                   "psi", "mean_batch", "std_batch", "out_of_range_rate")


def q_drift_quantile_bins20(spark, folder):
    before, after = _line_split(spark, folder)
    ref = write_stage(dq.quantile_reference(before, LINE_NUMBERS, [], n_bins=20, edge_digits=12), "reference")
    return rounded(dq.quantile_psi(after, ref, LINE_NUMBERS, []), "psi")


def q_drift_width_events(spark, folder):
    before, after = _events_split(spark, folder)
    ref = write_stage(dw.width_reference(before, ["value"], []), "reference")
    report = dw.drift_report(after, ref, ["value"], [])
    return rounded(report.select("feature", "psi", "mean_batch", "std_batch", "out_of_range_rate", "n_batch_rows"),
                   "psi", "mean_batch", "std_batch", "out_of_range_rate")


def q_drift_category_topk(spark, folder):
    before, _ = _events_split(spark, folder)
    return top_categories(before, ["event_type", "user_id"], dw.MISSING)


def q_drift_category_delta(spark, folder):
    before, after = _events_split(spark, folder)
    ref = write_stage(dw.width_reference(before, ["event_type", "user_id"], ["event_type", "user_id"]), "reference")
    report = dw.drift_report(after, ref, ["event_type", "user_id"], ["event_type", "user_id"])
    return report.select("feature", "value", F.round("delta", 9).alias("delta"), "missing_rate", "n_batch_rows")


def q_drift_quantile_reference(spark, folder):
    train, _ = _gold_split(spark, folder)
    ref = dq.quantile_reference(train, GOLD_NUMBERS, [], edge_digits=12)
    return ref.select("pos", "feature", "bin", "lo", "hi", "ref_prop", "n_ref")


def _quantile_psi(spark, folder):
    train, valid = _gold_split(spark, folder)
    ref = write_stage(dq.quantile_reference(train, GOLD_FEATURES, GOLD_CATS, edge_digits=12), "reference")
    return dq.quantile_psi(valid, ref, GOLD_FEATURES, GOLD_CATS)


def q_drift_quantile_psi(spark, folder):
    return rounded(_quantile_psi(spark, folder), "psi")


def q_drift_top_features(spark, folder):
    return dq.top_drifting(rounded(_quantile_psi(spark, folder), "psi"))


def q_drift_quantile_summary(spark, folder):
    summary = dq.drift_summary(rounded(_quantile_psi(spark, folder), "psi"))
    return summary.withColumn(
        "top_psi", F.array_join(F.transform("top_features", lambda t: F.format_string("%.6f", t["psi"])), ",")
    ).withColumn("top_features", F.array_join(F.transform("top_features", lambda t: t["feature"]), ","))


def q_drift_category_psi(spark, folder):
    before, after = _events_split(spark, folder)
    cols = ["event_type", "user_id"]
    ref = write_stage(dq.quantile_reference(before, cols, cols), "reference")
    return rounded(dq.quantile_psi(after, ref, cols, cols), "psi")


def q_drift_quantile_lineitem(spark, folder):
    """Quantile-bin drift of order lines: the last year of shipping dates against everything before."""
    before, after = _line_split(spark, folder)
    names = [*LINE_NUMBERS, "l_returnflag"]
    ref = write_stage(dq.quantile_reference(before, names, ["l_returnflag"], edge_digits=12), "reference")
    return rounded(dq.quantile_psi(after, ref, names, ["l_returnflag"]), "psi")


# model jobs

def _close(a: Column, b: Column) -> Column:
    return F.abs(a - b) <= F.lit(1e-9) * F.greatest(F.abs(a), F.abs(b), F.lit(1.0))


def _trained(spark, folder, **options):
    train, valid, _ = temporal_split(_gold(spark, folder))
    return train, valid, fit_forecaster(train, valid, **options)


def q_train_score_gbt(spark, folder):
    """Every scored row with its inputs whole, whether its forecast is finite, and whether the model beats the mean on its training rows."""
    train, valid, forecaster = _trained(spark, folder, **FIT)
    mean = train.agg(F.avg(TARGET)).first()[0]
    error = lambda x: F.sum((F.col(TARGET) - x) * (F.col(TARGET) - x))
    better = score(forecaster, train).agg((error(F.col(PREDICTION)) < error(F.lit(mean))).alias("b")).first()["b"]
    finite = F.col(PREDICTION).isNotNull() & (F.abs(PREDICTION) < float("inf"))
    return score(forecaster, valid).withColumn("finite", finite).withColumn("beats_mean", F.lit(better)).drop(PREDICTION)


def q_score_expression(spark, folder):
    """Every row of the dataset scored by the fitted pipeline and by the trees as SQL expressions; inputs whole."""
    gold = _gold(spark, folder)
    train, valid, _ = temporal_split(gold)
    forecaster = fit_forecaster(train, valid, **FIT)
    by_model = score(forecaster, gold)
    both = score_by_expression(forecaster, by_model, out_col="by_expression")
    return both.withColumn("equal", _close(F.col(PREDICTION), F.col("by_expression"))).drop(PREDICTION, "by_expression")


def q_train_reference_settings(spark, folder):
    """Patience 100, rate 0.03 and depth 6: patience ends the fit, no tree beyond it is kept or grown twice."""
    train, valid, forecaster = _trained(spark, folder)
    kept = forecaster.trees.getNumTrees - 1
    once = 100 <= forecaster.rounds - kept < 110
    model = scoring.forecast_metrics(score(forecaster, valid)).first()
    naive = scoring.forecast_metrics(fill_with_medians(valid, train), pred_col="pred").first()
    return valid.groupBy("Store").agg(F.count(F.lit(1)).alias("n_scored")).withColumns({
        "patience_ended": F.lit(forecaster.patience_ended), "grown_once": F.lit(once),
        "beats_median": F.lit(model["rmse"] < naive["rmse"])})


def q_train_compare(spark, folder):
    """Metrics of the seasonal baseline, and the model's held against their formulas over its predictions."""
    result = jobs.run_training(_gold(spark, folder), **FIT)
    exact = ["mae", "rmse", "mape", "cost_total"]
    off = F.col(TARGET) - F.col(PREDICTION)
    again = result.predictions.agg(
        F.avg(F.abs(off)).alias("mae"), F.sqrt(F.avg(off * off)).alias("rmse"),
        F.avg(F.abs(off) / F.greatest(F.abs(TARGET), F.lit(1e-8))).alias("mape"),
        F.sum(F.greatest(off, F.lit(0.0)) * 6.0 + F.greatest(-off, F.lit(0.0)) * 1.5).alias("cost_total")).first()
    model = F.col("candidate") == "model"
    same = F.lit(True)
    for c in exact:
        same = same & F.when(model, _close(F.col(c), F.lit(again[c]))).otherwise(True)
    decision = result.decision.first()
    promoted = decision["promote"] == (decision["model_cost"] < decision["baseline_cost"]) and decision["model_cost"] > 0
    shown = {c: F.when(~model, sig(F.col(c))) for c in exact}
    return result.metrics.withColumn("sound", same).withColumns(shown).select(
        "candidate", "n", "n_null", *exact, "sound").withColumn("decision_sound", F.lit(promoted))


def _batch(spark, folder):
    gold = _gold(spark, folder)
    train, valid, cutoff = temporal_split(gold)
    forecaster = fit_forecaster(train, valid, **FIT)
    prep = forecaster.preprocess
    watched = date_parts(reference_rows(gold, cutoff).drop(TARGET))
    ref = write_stage(dw.width_reference(watched, prep.feature_names, prep.cat_cols), "reference")
    return jobs.run_batch(gold, forecaster, ref)


def q_batch_predictions(spark, folder):
    """The latest rows with all their inputs, scored by the batch job."""
    scored = _batch(spark, folder)[0]
    return scored.withColumn("scored", F.col(PREDICTION).isNotNull()).drop(PREDICTION)


def q_batch_job(spark, folder):
    """The whole drift report of the batch job."""
    report = rounded(_batch(spark, folder)[1], "psi", "mean_batch", "std_batch", "out_of_range_rate")
    return report.withColumn("delta", F.round("delta", 9)).drop("pos")


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name[2:]: fn for name, fn in globals().items() if name.startswith("q_")}
