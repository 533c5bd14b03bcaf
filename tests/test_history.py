import math
import random
from datetime import date, timedelta
from statistics import stdev

import pytest
from pyspark.sql import functions as F

from stockcast.operators.history import add_history, history_names
from stockcast.operators.hot_groups import HALO, PIECE, hot_keys, range_pieces

START = date(2020, 1, 3)


def panel(spark, series):
    rows = [(s, 1, START + timedelta(days=d), y) for s, points in series.items() for d, y in points]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double")


def brute(points, lags, windows):
    ys = [y for _, y in sorted(points)]
    out = []
    for i in range(len(ys)):
        row = {f"lag_{k}": ys[i - k] if i >= k else None for k in lags}
        for k in windows:
            w = ys[i - k:i] if i >= k else [None]
            full = all(v is not None for v in w)
            row[f"roll_mean_{k}"] = sum(w) / k if full else None
            row[f"roll_std_{k}"] = stdev(w) if full and k > 1 else None
        out.append(row)
    return out


def assert_rows(df, series, lags=(1, 2, 3, 4), windows=(4, 8, 12)):
    names = history_names(lags, windows)
    got = {}
    for r in df.orderBy("Store", "Date").collect():
        got.setdefault(r["Store"], []).append(r)
    for s, points in series.items():
        for r, want in zip(got[s], brute(points, lags, windows), strict=True):
            for c in names:
                a, b = r[c], want[c]
                assert (a is None) == (b is None), (s, r["Date"], c, a, b)
                assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)


def test_gaps_nulls_and_neighbouring_series(spark):
    rng = random.Random(3)
    series = {
        1: [(7 * i, rng.uniform(-5, 50)) for i in range(30)],
        2: [(7 * i, None if i == 9 else rng.uniform(0, 9)) for i in range(30)],
        3: [(i * i, float(i)) for i in range(20)],
        4: [(0, 1.0)],
    }
    assert_rows(add_history(panel(spark, series)), series)


@pytest.mark.parametrize("max_rows", [3, 10, 40, 10_000])
def test_cut_series_equal_whole_series(spark, max_rows):
    rng = random.Random(5)
    series = {
        1: [(i, rng.choice([None, rng.uniform(-5, 50)]) if i % 9 == 0 else rng.uniform(0, 9)) for i in range(400)],
        2: [(i * i % 1009 + 2 * i * 1009, float(i)) for i in range(35)],
        3: [(i, 1.0) for i in range(2)],
    }
    assert_rows(add_history(panel(spark, series), max_series_rows=max_rows), series)


def test_ties_on_one_date_are_cut_too(spark):
    df = spark.range(3000).select(
        F.lit(1).alias("Store"), F.lit(1).alias("Dept"),
        F.when(F.col("id") < 2500, F.lit("2020-03-01")).otherwise(
            F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 200).cast("int")).cast("string")).cast("date").alias("Date"),
        (F.hash("id") % 1000).cast("decimal(18,2)").alias("Weekly_Sales"), "id")
    whole = add_history(df, max_series_rows=None).orderBy("id").collect()
    assert add_history(df, max_series_rows=200).orderBy("id").collect() == whole


def test_infinite_values_are_missing_and_single_row_std_is_null(spark):
    series = {1: [(0, 1.0), (1, math.inf), (2, 3.0), (3, 4.0)]}
    rows = add_history(panel(spark, series), lags=(1,), windows=(1, 2)).orderBy("Date").collect()
    assert [r["lag_1"] for r in rows] == [None, 1.0, None, 3.0]
    assert [r["roll_mean_1"] for r in rows] == [None, 1.0, None, 3.0]
    assert all(r["roll_std_1"] is None for r in rows)


def test_no_row_sees_itself_or_the_future(spark):
    series = {1: [(i, float(i)) for i in range(30)]}
    before = add_history(panel(spark, series)).where("Date < '2020-01-20'").orderBy("Date").collect()
    changed = {1: [(i, y if i < 16 else -999.0) for i, y in series[1]]}
    after = add_history(panel(spark, changed)).where("Date < '2020-01-20'").orderBy("Date").collect()
    names = history_names()
    assert [[r[c] for c in names] for r in before] == [[r[c] for c in names] for r in after]


def test_few_hot_keys_are_found_from_separate_sizes(spark):
    series = {1: [(i, 1.0) for i in range(50)], 2: [(i, 1.0) for i in range(5)]}
    df = panel(spark, series)
    assert hot_keys(df, ["Store", "Dept"], 100) is None
    hot, rows = hot_keys(df, ["Store", "Dept"], 20)
    assert [r["Store"] for r in hot.collect()] == [1] and rows == 50


@pytest.mark.parametrize("max_rows", [None, 20])
def test_rows_without_a_key_have_no_history(spark, max_rows):
    series = {1: [(i, float(i)) for i in range(60)]}
    lost = spark.createDataFrame([(None, 1, START, 5.0), (None, 1, START + timedelta(days=1), 6.0), (1, None, START, 7.0)],
                                 "Store int, Dept int, Date date, Weekly_Sales double")
    out = add_history(panel(spark, series).unionByName(lost), max_series_rows=max_rows)
    assert_rows(out.where("Store IS NOT NULL AND Dept IS NOT NULL"), series)
    rest = out.where("Store IS NULL OR Dept IS NULL").collect()
    assert len(rest) == 3 and all(r[c] is None for r in rest for c in history_names())


def test_every_hot_group_is_cut_however_many_there_are(spark):
    df = spark.range(1_100 * 12).select(
        (F.col("id") % 1_100).cast("int").alias("Store"), F.lit(1).alias("Dept"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") / 1_100).cast("int")).alias("Date"), F.lit(1.0).alias("Weekly_Sales"))
    hot, rows = hot_keys(df, ["Store", "Dept"], 5)
    assert hot.count() == 1_100 and rows == df.count()
    whole = add_history(df, max_series_rows=None).orderBy("Store", "Date").collect()
    assert add_history(df, max_series_rows=5).orderBy("Store", "Date").collect() == whole


@pytest.mark.parametrize("tie", ["id", "CAST(id AS STRING)", "concat('same', CAST(id DIV 1000 AS STRING))", "'same'"])
def test_tied_rows_are_cut_along_columns_of_any_type(spark, tie):
    """All rows tie on the date; numbers, text, text that hardly differs, and copies of one row."""
    df = spark.range(4_000).select(
        F.lit(1).alias("Store"), F.lit(1).alias("Dept"), F.lit("2020-03-01").cast("date").alias("Date"), F.expr(tie).alias("nr"),
        F.when(F.expr(tie).cast("string") == "same", 3.0).otherwise((F.col("id") % 17).cast("double")).alias("Weekly_Sales"))
    def rows(got):
        return sorted(map(repr, got.collect()))

    assert rows(add_history(df, tie_cols=["nr"], max_series_rows=100)) == rows(add_history(df, tie_cols=["nr"], max_series_rows=None))
    pieces = range_pieces(df, ["Store", "Dept"], ["Date", "nr"], 12, 40, ["Weekly_Sales"]).groupBy(PIECE).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(HALO).alias("halo")).collect()
    assert len(pieces) > 30 and max(r["n"] - r["halo"] for r in pieces) <= 250
    assert {r["halo"] for r in pieces} <= {0, 12} and sum(r["n"] - r["halo"] for r in pieces) == 4_000


def test_halo_reaches_over_pieces_shorter_than_it(spark):
    series = {1: [(i, float(i * i % 31)) for i in range(90)], 2: [(i, float(i)) for i in range(3)], 3: [(i, float(i % 7)) for i in range(40)]}
    for max_rows in (1, 2, 5):
        assert_rows(add_history(panel(spark, series), max_series_rows=max_rows), series)
