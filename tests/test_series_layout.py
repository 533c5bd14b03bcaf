import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockcast.operators import scoring
from stockcast.operators.history import add_history
from stockcast.operators.naive import seasonal_naive
from stockcast.operators.temporal import temporal_split
from stockcast.sources.series_layout import layout_history, layout_naive, layout_report, write_series_layout

START = date(2020, 1, 3)
SCHEMA = "Store int, Dept string, Date date, Weekly_Sales double"


def weeks(spark, keyless=True):
    """Odd short series, series of 60 to 66 weeks, one of 100, some of only the last weeks, and rows without a key."""
    rows = [(s, f"d{d}", START + timedelta(7 * w), float((s * 31 + d * 17 + w * w) % 97))
            for s in range(5) for d in range(3) for w in range(100 - (60 + s + d), 100)]
    rows += [(9, "long", START + timedelta(7 * w), float(w)) for w in range(100)]
    rows += [(7, "twice", START + timedelta(7 * w), float(v)) for w in (47, 98) for v in (3, 4)]  # a looked-up day with two rows
    rows += [(6, "none", START + timedelta(7 * w), None if w == 47 else 5.0) for w in (46, 47, 99)]
    rows += [(8, "new", START + timedelta(7 * w), float(w)) for w in (98, 99)]
    rows += [(None, "d0", START + timedelta(7 * w), 1.0 + w) for w in range(90, 100)] if keyless else []
    return spark.createDataFrame(rows, SCHEMA).repartition(4)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def rows_of(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def exchanges(df):
    """Hash exchanges in the final plan, as (keys, rows of the plan)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)


@pytest.mark.parametrize("longest", [80, 1000])
def test_same_results_as_over_plain_rows(spark, longest):
    df = weeks(spark)
    layout = write_series_layout(df, buckets=4, max_series_rows=longest)
    in_rest = {tuple(r) for r in layout.rest.select("Store", "Dept").distinct().collect()}
    assert in_rest == ({(None, "d0"), (9, "long")} if longest == 80 else {(None, "d0")})
    assert rows_of(layout.rows) == rows_of(df)
    assert rows_of(layout_history(layout)) == rows_of(add_history(df))
    train, valid, _ = temporal_split(df)
    whole = seasonal_naive(train, valid)
    assert rows_of(layout_naive(layout)) == rows_of(whole)
    report = scoring.forecast_metrics(whole, pred_col="pred", by=["Store", "Dept"])
    sums = {c: F.round(c, 9) for c in ("mae", "rmse", "mape", "cost_total")}  # floating sums depend on the order
    assert rows_of(layout_report(layout).withColumns(sums)) == rows_of(report.withColumns(sums))
    # the overall median of all training rows fills series that only began after the cutoff
    new = layout_naive(layout).where(F.col("Store") == 8)
    assert {r.pred for r in new.collect()} == {seasonal_naive(train, valid).where(F.col("Store") == 8).first().pred}
    layout.forget()


def test_no_exchange_of_rows_by_series(spark, no_broadcast):
    layout = write_series_layout(weeks(spark, keyless=False), buckets=4)
    assert layout.rest is None
    assert exchanges(layout_history(layout)) == []
    assert exchanges(layout.bucketed.groupBy("Store", "Dept").agg(F.sum("Weekly_Sales"))) == []
    plain = weeks(spark, keyless=False)
    assert exchanges(add_history(plain, max_series_rows=None)) != []
    for made in (layout_naive(layout), layout_report(layout)):
        assert exchanges(made) == []
    layout.forget()


def test_empty_table(spark):
    layout = write_series_layout(spark.createDataFrame([], SCHEMA))
    assert layout.rest is None and layout.rows.isEmpty() and layout_history(layout).isEmpty() and layout_naive(layout).isEmpty()
    layout.forget()
