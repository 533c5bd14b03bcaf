import math
import re
from datetime import date, timedelta

import numpy as np
import pytest

from stockcast.operators.naive import fill_with_medians, seasonal_naive
from stockcast.operators.scoring import cost_scenarios, forecast_metrics, promotion, segment_keys, segment_series
from stockcast.operators.temporal import cutoff_date, latest_batch, reference_rows, temporal_split

D0 = date(2011, 1, 7)
SCHEMA = "Store int, Dept int, Date date, Weekly_Sales double"


def weeks(n):
    return D0 + timedelta(weeks=n)


def test_split_covers_all_dated_rows_once(spark):
    df = spark.createDataFrame([(1, 1, weeks(i), float(i)) for i in range(20)] + [(1, 1, None, 9.0)], SCHEMA)
    train, valid, cutoff = temporal_split(df)
    assert (train.count(), valid.count()) == (16, 4)
    assert df.select(cutoff).first()[0] == weeks(15)
    assert latest_batch(df).count() == 4 and latest_batch(df, horizon_days=7).count() == 1
    assert reference_rows(df, cutoff_date(df)).count() == 16
    assert temporal_split(df.limit(0))[0].count() == 0


def test_cutoff_reaches_the_scan(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    _, valid, _ = temporal_split(orders, "o_orderdate")
    plan = valid.select("o_orderkey")._jdf.queryExecution().toString()
    assert re.search(r"PushedFilters: \[IsNotNull\(o_orderdate\), GreaterThan\(o_orderdate,\d{4}-\d\d-\d\dT", plan)
    assert "subquery" not in plan.lower()


def test_seasonal_value_then_series_median_then_overall_median(spark):
    rows = [(1, 1, weeks(0), 10.0), (1, 1, weeks(1), 20.0), (1, 1, weeks(2), 60.0), (2, 1, weeks(0), 7.0), (1, 1, weeks(52), None)]
    train = spark.createDataFrame(rows, SCHEMA)
    valid = spark.createDataFrame(
        [(1, 1, weeks(53), 0.0), (1, 1, weeks(55), 0.0), (2, 1, weeks(52), 0.0), (3, 3, weeks(52), 0.0), (None, 3, weeks(52), 0.0)], SCHEMA)
    got = {(r["Store"], r["Date"]): r["pred"] for r in seasonal_naive(train, valid).collect()}
    overall = float(np.median([10, 20, 60, 7]))
    assert got == {(1, weeks(53)): 20.0, (1, weeks(55)): 20.0, (2, weeks(52)): 7.0, (3, weeks(52)): overall, (None, weeks(52)): overall}


def test_duplicate_lookup_rows_fan_out_and_long_horizons_use_training_rows_only(spark):
    train = spark.createDataFrame([(1, 1, weeks(0), 1.0), (1, 1, weeks(0), 2.0)], SCHEMA)
    valid = spark.createDataFrame([(1, 1, weeks(52), 5.0), (1, 1, weeks(104), 5.0)], SCHEMA)
    assert sorted((r["Date"], r["pred"]) for r in seasonal_naive(train, valid).collect()) == [
        (weeks(52), 1.0), (weeks(52), 2.0), (weeks(104), 1.5)]


def test_no_median_work_when_every_row_has_a_season(spark):
    train = spark.createDataFrame([(1, 1, weeks(0), 3.0)], SCHEMA)
    valid = spark.createDataFrame([(1, 1, weeks(52), 5.0)], SCHEMA)
    assert seasonal_naive(train, valid).first()["pred"] == 3.0
    assert fill_with_medians(valid, train).first()["pred"] == 3.0


def test_more_series_than_the_list_bound(spark, monkeypatch):
    monkeypatch.setattr("stockcast.operators.naive.pinned",
                        lambda df, name: __import__("stockcast.operators.hot_groups", fromlist=["pinned"]).pinned(df, name, 2))
    train = spark.createDataFrame([(s, 1, weeks(0), float(s)) for s in range(6)], SCHEMA)
    valid = spark.createDataFrame([(s, 1, weeks(60), 0.0) for s in range(8)], SCHEMA)
    got = {r["Store"]: r["pred"] for r in seasonal_naive(train, valid).collect()}
    assert got == {**{s: float(s) for s in range(6)}, 6: 2.5, 7: 2.5}


def test_metrics_against_numpy(spark):
    y, p = [10.0, 0.0, 4.0, 8.0], [7.0, 1.0, 4.0, 10.0]
    df = spark.createDataFrame([(a, b) for a, b in zip(y, p)] + [(None, 1.0)], "Weekly_Sales double, y_pred double")
    r = forecast_metrics(df).first()
    e = np.array(y) - np.array(p)
    assert (r["n"], r["n_null"]) == (4, 1)
    assert math.isclose(r["mae"], np.abs(e).mean()) and math.isclose(r["rmse"], np.sqrt((e ** 2).mean()))
    assert math.isclose(r["mape"], np.mean(np.abs(e) / np.maximum(np.abs(y), 1e-8)))
    assert r["cost_total"] == 3 * 6.0 + (1 + 2) * 1.5
    assert forecast_metrics(df, cost_under=1, cost_over=1).first()["cost_total"] == r["n"] * r["mae"]
    assert forecast_metrics(df.limit(0)).first()["mae"] is None


def test_scenarios_equal_separate_costs(spark):
    rows = [(1, 1, 5.0, 3.0), (1, 1, 2.0, 6.0), (2, 1, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "Store int, Dept int, Weekly_Sales double, y_pred double")
    got = {(r["Store"], r["scenario"]): r["cost_total"] for r in cost_scenarios(df, [("a", 6, 1.5), ("b", 1, 2)]).collect()}
    assert got == {(1, "a"): 18.0, (1, "b"): 10.0, (2, "a"): 0.0, (2, "b"): 0.0}


def test_segments(spark):
    df = spark.createDataFrame([(1, 2, weeks(1), 1.0, 2.0), (1, 2, weeks(0), 3.0, 4.0), (1, 3, weeks(0), 5.0, 6.0)], SCHEMA + ", y_pred double")
    assert segment_keys(df).count() == 2
    one = segment_series(df, {"Store": 1, "Dept": 2})
    assert [tuple(r) for r in one.collect()] == [(weeks(0), 3.0, 4.0), (weeks(1), 1.0, 2.0)]
    assert one.columns == ["Date", "Real", "Previsto"]
    assert segment_series(df).columns == ["Store", "Dept", "Date", "Real", "Previsto"]


@pytest.mark.parametrize("model, wanted", [(9.0, True), (10.0, False), (11.0, False)])
def test_promotion_is_strict(spark, model, wanted):
    metrics = spark.createDataFrame([("baseline", 10.0), ("model", model)], "candidate string, cost_total double")
    assert promotion(metrics, "baseline", "model").first()["promote"] is wanted
