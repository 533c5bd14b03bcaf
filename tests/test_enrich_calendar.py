from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from stockcast.functions.dates import parse_date
from stockcast.operators.calendar import add_calendar, date_parts
from stockcast.operators.enrich import enrich_panel, left_lookup

D1, D2 = date(2010, 2, 5), date(2010, 2, 12)
SALES = "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean"


def stores(spark):
    return spark.createDataFrame([(1, "A", 10)], "Store int, Type string, Size int")


def test_flag_of_features_wins_even_on_a_miss(spark):
    sales = spark.createDataFrame([(1, 1, D1, 5.0, True), (1, 1, D2, 6.0, False), (2, 1, D1, 7.0, True)], SALES)
    features = spark.createDataFrame([(1, D2, 0.5, True)], "Store int, Date date, CPI double, IsHoliday boolean")
    out = enrich_panel(sales, features, stores(spark))
    got = {(r["Store"], r["Date"]): (r["IsHoliday"], r["CPI"], r["Type"]) for r in out.collect()}
    assert got == {(1, D1): (0, None, "A"), (1, D2): (1, 0.5, "A"), (2, D1): (0, None, None)}
    assert out.columns[-1] == "IsHoliday" and "IsHoliday_x" not in out.columns


def test_flag_from_the_only_side_or_zero(spark):
    sales = spark.createDataFrame([(1, 1, D1, 5.0, True), (1, 1, D2, 5.0, None)], SALES)
    plain = spark.createDataFrame([(1, D1, 1.0)], "Store int, Date date, CPI double")
    assert [r["IsHoliday"] for r in enrich_panel(sales, plain, stores(spark)).orderBy("Date").collect()] == [1, 0]
    none = enrich_panel(sales.drop("IsHoliday"), plain, stores(spark))
    assert [r["IsHoliday"] for r in none.collect()] == [0, 0]


def test_duplicate_dimension_rows_fan_out_and_shared_columns_get_suffixes(spark):
    sales = spark.createDataFrame([(1, 1, D1, 5.0, True)], SALES).withColumn("CPI", F.lit(9.0))
    features = spark.createDataFrame([(1, D1, 1.0), (1, D1, 2.0)], "Store int, Date date, CPI double")
    out = enrich_panel(sales, features, stores(spark))
    assert sorted((r["CPI_x"], r["CPI_y"]) for r in out.collect()) == [(9.0, 1.0), (9.0, 2.0)]


def test_null_keys_match_only_when_null_safe(spark):
    left = spark.createDataFrame([(None, 1)], "Store int, a int")
    right = spark.createDataFrame([(None, 2)], "Store int, b int")
    assert left_lookup(left, right, ["Store"]).first()["b"] is None
    assert left_lookup(left, right, ["Store"], null_safe=True).first().asDict() == {"Store": None, "a": 1, "b": 2}


def test_calendar_edges(spark):
    days = [(date(2010, 1, 1),), (date(2011, 12, 31),), (date(2012, 2, 29),), (None,)]
    rows = add_calendar(spark.createDataFrame(days, "Date date")).collect()
    names = ["year", "month", "weekofyear", "dayofweek", "is_month_start", "is_month_end"]
    assert [tuple(r[c] for c in names) for r in rows] == [
        (2010, 1, 53, 4, 1, 0), (2011, 12, 52, 5, 0, 1), (2012, 2, 9, 2, 0, 1), (None,) * 6]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_date_parts_and_epoch_seconds(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.createDataFrame([(date(2012, 9, 28), 1), (date(2010, 4, 30), 2)], "Date date, x int")
        out = date_parts(df)
        assert "Date" not in out.columns and "x" in out.columns
        assert [r["Date_ts"] for r in out.collect()] == [1348790400, 1272585600]
        before_1970 = date_parts(spark.createDataFrame([(datetime(1969, 12, 31, 23, 59, 59, 500000),)], "t timestamp_ntz"))
        assert before_1970.first()["t_ts"] == -1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_date_strict_and_lenient(spark):
    df = spark.createDataFrame([("2012-02-29",), ("nope",)], "s string")
    assert [r[0] for r in df.select(parse_date(F.col("s"), strict=False)).collect()] == [date(2012, 2, 29), None]
    with pytest.raises(Exception):
        df.select(parse_date(F.col("s"))).collect()
