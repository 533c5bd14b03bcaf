import pytest
from pyspark.sql import functions as F

from stockcast.operators.encode import (
    align_pair, align_to, apply_category, apply_dictionary, category_columns, category_dictionary, model_matrix,
)


def test_align(spark):
    a = spark.createDataFrame([(1, 2.0, "x")], "a int, Weekly_Sales double, c string")
    inputs = a.drop("Weekly_Sales")
    b = spark.createDataFrame([(5, 7)], "d int, a int")
    left, right = align_pair(inputs, b)
    assert left.columns == right.columns == ["a", "c", "d"]
    assert left.first().asDict() == {"a": 1, "c": "x", "d": 0} and right.first().asDict() == {"a": 7, "c": 0, "d": 5}
    assert align_to(a, ["z", "a"]).first().asDict() == {"z": 0, "a": 1}


def dictionary(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["feature"], r["code"])):
        out.setdefault(r["feature"], []).append(r["value"])
        assert out[r["feature"]][r["code"]] == r["value"]
    return out


def test_dictionary_is_the_sorted_union_with_missing(spark):
    train = spark.createDataFrame([("B", "u"), ("A", None)], "Type string, t string")
    valid = spark.createDataFrame([("C", "missing"), ("A", "a")], "Type string, t string")
    assert dictionary(category_dictionary([train, valid], ["Type", "t"])) == {
        "Type": ["A", "B", "C", "missing"], "t": ["a", "missing", "u"]}


def test_large_dictionary_numbers_in_pieces(spark):
    df = spark.range(3000).select(F.concat(F.lit("k"), F.col("id")).alias("u"), (F.col("id") % 3).cast("string").alias("v"))
    assert dictionary(category_dictionary([df], ["u", "v"], max_labels=50)) == dictionary(category_dictionary([df], ["u", "v"]))


def test_unseen_and_null_become_missing(spark):
    df = spark.createDataFrame([("A",), ("Q",), (None,)], "Type string")
    assert [r[0] for r in df.select(apply_category(F.col("Type"), ["A", "missing"])).collect()] == ["A", "missing", "missing"]
    table = category_dictionary([df.where("Type = 'A'")], ["Type"])
    got = [(r["Type_label"], r["Type_code"]) for r in apply_dictionary(df, "Type", table).collect()]
    assert sorted(got) == [("A", 0), ("missing", 1), ("missing", 1)]


def test_categorical_columns(spark):
    a = spark.createDataFrame([(1, "x", True)], "a int, c string, b boolean")
    b = spark.createDataFrame([("1", "x", True)], "a string, c string, b boolean")
    assert category_columns(a) == ["c"] and category_columns(a, b) == ["a", "c"]
    with pytest.raises(ValueError, match="date"):
        category_columns(a.withColumn("d", F.current_date()))


def test_matrix_order_fill_and_coercion(spark):
    df = spark.createDataFrame([("7", None, "A", 1.0, True), ("bad", 2.0, "Z", float("nan"), False)], "s string, n double, Type string, m double, b boolean")
    out = model_matrix(df, ["n", "absent", "s", "Type", "m", "b", "gone"], {"Type": ["A", "missing"], "gone": ["missing"]})
    assert out.columns == ["n", "absent", "s", "Type", "m", "b", "gone"]
    assert [tuple(r) for r in out.collect()] == [
        (0.0, 0.0, 7.0, "A", 1.0, 1.0, "missing"), (2.0, 0.0, 0.0, "missing", 0.0, 0.0, "missing")]


def test_text_without_any_number_is_an_error(spark):
    df = spark.createDataFrame([("x",), (None,)], "s string")
    with pytest.raises(ValueError, match="'?s'?"):
        model_matrix(df, ["s"], {})
    nulls = spark.createDataFrame([(None,)], "s string")
    assert model_matrix(nulls, ["s"], {}).first()["s"] == 0.0
