import random
from datetime import date
from statistics import median

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from stockcast.operators.impute import finalize_features, fit_medians, keep_full_history
from stockcast.operators.quantiles import bracket_counts, exact_quantiles


def test_group_median_then_overall_median_of_filled_values(spark):
    rows = [(1, 1.0, None), (1, None, None), (1, 4.0, None), (2, None, None), (2, None, None), (None, None, None), (3, 10.0, None)]
    df = spark.createDataFrame(rows, "Store int, CPI double, MarkDown1 double")
    out = [(r["Store"], r["CPI"], r["MarkDown1"]) for r in fit_medians(df).apply(df).collect()]
    overall = median([1.0, 2.5, 4.0, 10.0])
    assert sorted(out, key=str) == sorted(
        [(1, 1.0, None), (1, 2.5, None), (1, 4.0, None), (2, overall, None), (2, overall, None), (None, overall, None), (3, 10.0, None)], key=str)


def test_nan_counts_as_missing_and_absent_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 3.0), (1, 5.0)], "Store int, CPI double")
    assert sorted(r["CPI"] for r in fit_medians(df).apply(df).collect()) == [3.0, 4.0, 5.0]
    bare = spark.createDataFrame([(1,)], "Store int")
    assert fit_medians(bare).apply(bare).collect() == bare.collect()


def test_finalize_drops_short_history_and_clips_but_keeps_missing_target(spark):
    rows = [(1, -5.0, 1.0, None), (1, -5.0, -7.0, 2.0), (1, None, 1.0, 2.0), (1, 0.0, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "Store int, Weekly_Sales double, lag_1 double, roll_mean_4 double")
    out = finalize_features(df).collect()
    assert sorted([(r["Weekly_Sales"], r["lag_1"]) for r in out], key=str) == [(0.0, -7.0), (0.0, 1.0), (None, 1.0)]
    assert keep_full_history(spark.createDataFrame([(1,)], "a int")).count() == 1


def test_medians_can_be_fitted_on_training_rows_only(spark):
    df = spark.createDataFrame([(1, 1.0, 1.0), (1, None, 1.0), (1, 9.0, 1.0)], "Store int, CPI double, Weekly_Sales double")
    out = finalize_features(df, fit_rows=df.where("CPI < 5"))
    assert sorted(r["CPI"] for r in out.collect()) == [1.0, 1.0, 9.0]


@pytest.mark.parametrize("accuracy, max_rows", [(20, 10**7), (200, 10**7), (10_000, 10**7), (20, 1), (200, 1), (10_000, 1)])
def test_quantiles_are_exact_whatever_the_sketch(spark, accuracy, max_rows):
    rng = random.Random(2)
    rows = [(g, rng.choice([None, rng.gauss(0, 100), float(rng.randint(0, 3))])) for g in (1, 2, None) for _ in range(4000)]
    rows += [(3, 1.0), (4, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(7)
    probs = [i / 10 for i in range(11)] + [0.37, 0.999]
    got = {r["g"]: r for r in exact_quantiles(df, ["v"], probs, ["g"], accuracy, max_rows).collect()}
    for g in (1, 2, 3, None):
        values = [v for k, v in rows if k == g and v is not None]
        assert got[g]["n"] == len(values)
        np.testing.assert_allclose(got[g]["quantiles"], np.quantile(values, probs), rtol=0, atol=0)
    assert got[4]["n"] == 0 and set(got[4]["quantiles"]) == {None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=40))
def test_overall_quantiles_of_any_list(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    kept = [v for v in values if v is not None]
    for max_rows in (10**7, 1):
        row = exact_quantiles(df, ["v"], [0.0, 0.25, 0.5, 1.0], accuracy=10, max_rows=max_rows).first()
        assert row["n"] == len(kept)
        if kept:
            np.testing.assert_allclose(row["quantiles"], np.quantile(kept, [0, 0.25, 0.5, 1]), rtol=1e-9, atol=1e-6)


def test_clusters_and_far_outliers_are_narrowed(spark):
    """Equal-width cells would hold all but a few values; the values that one task sorts stay within the bound."""
    rng = np.random.default_rng(8)
    n, probs, bound = 60_000, [0.0, 0.25, 0.5, 0.9, 1.0], 1_500
    clusters = np.concatenate([
        rng.normal(0, 1e-9, n // 2), 5 + rng.normal(0, 1e-12, n // 4), np.full(n // 8, 7.0), rng.lognormal(0, 90, n // 8)])
    rng.shuffle(clusters)
    values = np.append(clusters, [1e300, -1e300, 1e250])
    df = spark.createDataFrame([(float(v),) for v in values], "v double").repartition(8)
    row = exact_quantiles(df, ["v"], probs, accuracy=500, max_rows=bound).first()
    np.testing.assert_allclose(row["quantiles"], np.quantile(values, probs), rtol=1e-12)
    counted = bracket_counts(df, ["v"], probs, [], 500, bound)
    assert counted.count() <= bound and counted.agg(F.sum("w")).first()[0] == len(values)
    assert bracket_counts(df, ["v"], probs, [], 500, 10**7).count() > bound  # without narrowing


def test_large_bracket_tables_are_joined_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr("stockcast.operators.quantiles.MAX_LISTED", 4)
    df = spark.range(600).select((F.col("id") % 50).alias("g"), F.col("id").cast("double").alias("v"))
    got = {r["g"]: r["quantiles"][0] for r in exact_quantiles(df, ["v"], [0.5], ["g"]).collect()}
    assert got == {g: float(np.median(np.arange(g, 600, 50))) for g in range(50)}


def test_dates_are_refused(spark):
    df = spark.createDataFrame([(date(2020, 1, 1),)], "d date")
    with pytest.raises(TypeError):
        exact_quantiles(df, ["d"], [0.5])
