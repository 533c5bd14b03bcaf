import math
import tempfile

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from pyspark.sql import functions as F

from stockcast.operators.distributions import column_profile, feature_counts, top_categories
from stockcast.operators.drift_quantile import drift_summary, quantile_psi, quantile_reference, top_drifting
from stockcast.operators.drift_width import drift_report, width_reference
from stockcast.operators.merged_reference import daily_counts, merged_width_reference, write_counts


def numbers(spark, values, name="x"):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], f"{name} double")


def edges_of(ref):
    rows = ref.orderBy("bin").collect()
    return [rows[0]["lo"], *[r["hi"] for r in rows]], [r["cnt"] for r in rows]


# equal-width bins

def test_width_edges_match_known_values(spark):
    edges, _ = edges_of(width_reference(numbers(spark, range(1, 46)), ["x"], []))
    np.testing.assert_allclose(edges[:4], [0.956, 5.4, 9.8, 14.2])
    edges, counts = edges_of(width_reference(numbers(spark, [4.0] * 7), ["x"], []))
    assert math.isclose(edges[0], 3.996) and math.isclose(edges[-1], 4.004) and counts == [0, 0, 0, 0, 7, 0, 0, 0, 0, 0]
    edges, _ = edges_of(width_reference(numbers(spark, [-4988.94, 693099.36]), ["x"], []))
    np.testing.assert_allclose(edges[:2], [-5687.0283, 64819.89])
    edges, _ = edges_of(width_reference(numbers(spark, [0.0]), ["x"], []))
    np.testing.assert_allclose([edges[0], edges[-1]], [-0.001, 0.001])


def test_width_bins_are_right_closed_and_count_everything(spark):
    _, counts = edges_of(width_reference(numbers(spark, range(11)), ["x"], []))
    assert counts == [2, 1, 1, 1, 1, 1, 1, 1, 1, 1]


def test_width_reference_skips_empty_features_and_keeps_rates(spark):
    df = spark.createDataFrame([(1.0, None, "a"), (3.0, None, None), (None, None, "a"), (5.0, None, "b")], "x double, e double, c string")
    rows = width_reference(df, ["x", "e", "absent", "c"], ["c"]).collect()
    assert {r["feature"] for r in rows} == {"x", "c"}
    x = next(r for r in rows if r["feature"] == "x")
    assert (x["mean"], x["std"], x["min"], x["max"], x["missing_rate"], x["n_rows"]) == (3.0, 2.0, 1.0, 5.0, 0.25, 4)
    assert {(r["key"], r["share"], r["missing_rate"]) for r in rows if r["feature"] == "c"} == {
        ("a", 0.5, 0.25), ("b", 0.25, 0.25), ("__MISSING__", 0.25, 0.25)}


def width_psi(ref, cur, edges):
    r = np.histogram(ref, edges)[0] / len(ref)
    c = np.histogram(cur, edges)[0]
    c = c / c.sum()
    r, c = np.where(r == 0, 1e-8, r), np.where(c == 0, 1e-8, c)
    return float(np.sum((c - r) * np.log(c / r)))


def test_width_report(spark):
    rng = np.random.default_rng(4)
    ref_x, cur_x = rng.normal(size=500), np.append(rng.normal(0.4, size=199), 99.0)
    ref = width_reference(numbers(spark, ref_x), ["x"], [])
    row = drift_report(numbers(spark, cur_x), ref, ["x"], []).first()
    edges, _ = edges_of(ref)
    assert math.isclose(row["psi"], width_psi(ref_x, cur_x, edges), rel_tol=1e-9)
    assert math.isclose(row["mean_batch"], cur_x.mean()) and math.isclose(row["std_batch"], cur_x.std())
    outside = np.sum((cur_x < edges[0]) | (cur_x > edges[-1])) / 200
    assert row["n_batch_rows"] == 200 and math.isclose(row["out_of_range_rate"], outside) and outside > 0
    same = drift_report(numbers(spark, ref_x), ref, ["x"], []).first()
    assert abs(same["psi"]) < 1e-12


@pytest.mark.parametrize("batch, rate", [([100.0, 200.0], 1.0), ([None], None), ([], None)])
def test_width_psi_is_null_without_rows_in_range(spark, batch, rate):
    ref = width_reference(numbers(spark, range(50)), ["x"], [])
    row = drift_report(numbers(spark, batch), ref, ["x"], []).first()
    assert row["psi"] is None and row["out_of_range_rate"] == rate


def test_category_deltas_and_absent_columns(spark):
    ref_df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    ref = width_reference(ref_df, ["c"], ["c"])
    cur = spark.createDataFrame([("a",), ("z",), (None,), (None,)], "c string")
    got = {r["value"]: (r["delta"], r["missing_rate"]) for r in drift_report(cur, ref, ["c"], ["c"]).collect()}
    assert got == {"a": (-0.25, 0.5), "b": (-0.25, 0.5), "__MISSING__": (0.25, 0.5)}
    gone = drift_report(spark.createDataFrame([(1,)], "q int"), ref, ["c"], ["c"]).collect()
    assert {r["value"]: (r["delta"], r["missing_rate"]) for r in gone}["__MISSING__"] == (0.75, 1.0)
    empty = drift_report(cur.limit(0), ref, ["c"], ["c"]).collect()
    assert {(r["delta"], r["missing_rate"], r["n_batch_rows"]) for r in empty} == {(None, None, 0)}


def test_top_k_ties_and_text_coercion(spark):
    df = spark.createDataFrame([(f"v{i:02d}",) for i in range(40)] + [("v39",)], "c string")
    top = top_categories(df, ["c"], "missing").collect()
    assert len(top) == 30 and {r["key"] for r in top} == {"v39", *[f"v{i:02d}" for i in range(29)]}
    text = spark.createDataFrame([("1",), ("x",), ("3",)], "t string")
    row = column_profile(text, ["t"]).first()
    assert (row["n"], row["mean"], row["n_rows"]) == (2, 2.0, 3)
    assert math.isclose(row["missing_rate"], 1 / 3)


# quantile bins

def numpy_quantile_psi(ref, cur):
    edges = sorted(set(np.quantile(ref, np.linspace(0, 1, 11))))
    edges = [-np.inf, edges[0], np.inf] if len(edges) < 2 else [-np.inf, *edges[1:-1], np.inf]
    r, c = np.histogram(ref, edges)[0] / len(ref), np.histogram(cur, edges)[0] / max(len(cur), 1)
    r, c = np.clip(r, 1e-6, 1), np.clip(c, 1e-6, 1)
    return float(np.sum((c - r) * np.log(c / r)))


@pytest.mark.parametrize("ref, cur", [
    (list(range(100)), [x * 0.7 for x in range(100)]),
    ([1, 1, 1, 2, 2, 3, 5, 8, 13, 21, 34], [1, 2, 3, 34, 100]),
    ([5.0] * 9, [4.0, 5.0, 6.0]),
    ([0.0, 1.0] * 30, [0.0, 0.0, 1.0]),
    (list(np.random.default_rng(8).normal(size=101)), list(np.random.default_rng(9).normal(size=60))),
])
def test_quantile_psi_against_numpy(spark, ref, cur):
    table = quantile_reference(numbers(spark, ref), ["x"], [])
    got = quantile_psi(numbers(spark, cur), table, ["x"], []).first()["psi"]
    assert math.isclose(got, numpy_quantile_psi(ref, cur), rel_tol=1e-9, abs_tol=1e-12)
    again = quantile_psi(numbers(spark, ref), table, ["x"], []).first()["psi"]
    assert abs(again) < 1e-12


def test_special_edges(spark):
    def bins(values):
        return [(r["bin"], r["lo"], r["hi"], r["ref_prop"]) for r in quantile_reference(numbers(spark, values), ["x"], []).orderBy("bin").collect()]

    assert bins([None, None]) == [(0, None, None, 0.0)]
    assert bins([7.0, 7.0]) == [(0, None, 7.0, 0.0), (1, 7.0, None, 1.0)]
    both = bins([0.0, 0.0, 0.0, 0.0, 0.0, 1.0, 1.0, 1.0, 1.0, 1.0, 1.0])
    assert both == [(0, None, None, 1.0)]


def test_categories_with_other_bucket(spark):
    values = [f"k{i:02d}" for i in range(35) for _ in range(2)] + [None] * 5 + ["__other__"] * 9
    ref_df = spark.createDataFrame([(v,) for v in values], "c string")
    ref = quantile_reference(ref_df, ["c"], ["c"])
    shares = {r["key"]: r["ref_prop"] for r in ref.collect()}
    n = len(values)
    assert len(shares) == 29 + 1 and math.isclose(shares["missing"], 5 / n)
    assert math.isclose(shares["__other__"], 1 - (9 + 5 + 28 * 2) / n)
    cur = ["k00"] * 4 + ["new", None, "__other__", "k34"]
    current = {"k00": 4 / 8, "missing": 1 / 8, "__other__": 3 / 8}
    want = sum((max(current.get(k, 0), 1e-6) - max(r, 1e-6)) * math.log(max(current.get(k, 0), 1e-6) / max(r, 1e-6)) for k, r in shares.items())
    got = quantile_psi(spark.createDataFrame([(v,) for v in cur], "c string"), ref, ["c"], ["c"]).first()["psi"]
    assert math.isclose(got, want, rel_tol=1e-9)


def test_features_without_reference_and_absent_columns(spark):
    df = spark.createDataFrame([(1.0, "a", 2.0), (2.0, "b", 3.0)], "x double, c string, y double")
    ref = quantile_reference(df, ["x"], [])
    psi = quantile_psi(df, ref, ["x", "y", "c"], ["c"]).orderBy("pos").collect()
    assert [(r["feature"], r["psi"]) for r in psi] == [("x", 0.0), ("c", 0.0)]
    with pytest.raises(KeyError):
        quantile_psi(df, ref, ["x", "absent"], [])


def test_summary_threshold_is_inclusive(spark):
    rows = [(i, f"f{i}", "numeric", p) for i, p in enumerate([0.1, 0.2, 0.5, 0.5] + [0.01] * 9)]
    psi = spark.createDataFrame(rows, "pos int, feature string, kind string, psi double")
    s = drift_summary(psi).first()
    assert (s["drift_detected"], s["drift_threshold"], s["max_psi"], s["n_features_over_threshold"]) == (True, 0.2, 0.5, 3)
    order = ["f2", "f3", "f1", "f0", "f4", "f5", "f6", "f7", "f8", "f9"]
    assert [t["feature"] for t in s["top_features"]] == order == [r["feature"] for r in top_drifting(psi).collect()]
    none = drift_summary(psi.limit(0)).first()
    assert (none["drift_detected"], none["max_psi"], none["n_features_over_threshold"], none["top_features"]) == (False, 0.0, 0, [])


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-100, 100), min_size=1, max_size=30), st.lists(st.floats(-200, 200), max_size=30))
def test_psi_is_never_negative_and_shares_sum_to_one(spark, ref, cur):
    table = quantile_reference(numbers(spark, ref), ["x"], [])
    assert math.isclose(sum(r["ref_prop"] for r in table.collect()), 1.0)
    assert quantile_psi(numbers(spark, cur), table, ["x"], []).first()["psi"] >= 0
    wide = width_reference(numbers(spark, ref), ["x"], [])
    assert sum(r["cnt"] for r in wide.collect()) == len(ref)


def test_bin_closure_is_a_parameter(spark):
    edges = spark.createDataFrame([("x", [1.0, 2.0], None, None)], "feature string, cuts array<double>, lo double, hi double")
    df = numbers(spark, [0.5, 1.0, 1.5, 2.0, 3.0])

    def count(right):
        counted = feature_counts(df, edges.collect(), ["x"], [], "missing", right)
        return {r["bin"]: r["cnt"] for r in counted.bins().collect()}

    assert count(False) == {0: 1, 1: 2, 2: 2} and count(True) == {0: 2, 1: 2, 2: 1}


def scans_of(spark, folder, job):
    """How often a job's queries read a folder, by the final plans of all that it ran."""
    store = spark._jsparkSession.sharedState().statusStore()
    before = store.executionsCount()
    job()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    count = 0
    executions = store.executionsList(int(before), 10_000)
    for i in range(executions.size()):
        nodes = store.planGraph(executions.apply(i).executionId()).allNodes()
        count += sum(1 for j in range(nodes.size()) if "Scan parquet" in nodes.apply(j).name() and folder in nodes.apply(j).desc())
    return count


@pytest.mark.parametrize("build, report, most", [
    (width_reference, lambda df, ref: drift_report(df, ref, ["x", "y", "c"], ["c"]), 2),
    (quantile_reference, lambda df, ref: quantile_psi(df, ref, ["x", "y", "c"], ["c"]), 3)])
def test_scans_of_reference_and_current_side(spark, build, report, most):
    tmp_path = tempfile.mkdtemp(prefix="s-")  # plans show the first hundred characters of a path
    rows = spark.range(50_000).selectExpr(
        "CAST(id % 977 AS DOUBLE) AS x", "CAST(id AS DOUBLE) AS y", "IF(id % 9 = 0, NULL, CAST(id % 40 AS STRING)) AS c")
    for name in ("ref", "cur"):
        rows.write.parquet(f"{tmp_path}/{name}_data")
    before, now = (spark.read.parquet(f"{tmp_path}/{name}_data") for name in ("ref", "cur"))
    build(before, ["x", "y", "c"], ["c"]).write.parquet(f"{tmp_path}/table")  # the same, to have it outside the count
    count = scans_of(spark, "ref_data", lambda: build(before, ["x", "y", "c"], ["c"]).collect())
    assert 1 <= count <= most
    ref = spark.read.parquet(f"{tmp_path}/table")
    assert scans_of(spark, "cur_data", lambda: report(now, ref).collect()) == 1


def test_merged_counts_give_the_reference_of_the_rows(spark, tmp_path):
    """Any cutoff, a month replaced later, missing values, text numbers, an absent and an empty feature."""
    df = spark.range(4_000).selectExpr(
        "date_add(DATE'2020-01-15', CAST(id % 150 AS INT)) AS Date", "IF(id % 11 = 0, NULL, CAST(id % 37 AS DOUBLE) / 4) AS x",
        "IF(id % 5 = 0, 'bad', CAST(id % 8 AS STRING)) AS t", "CAST(NULL AS DOUBLE) AS e", "IF(id % 7 = 0, NULL, CAST(id % 50 AS STRING)) AS c")
    names, path = ["x", "t", "e", "absent", "c"], f"{tmp_path}/counts"

    def rows(ref):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in map(tuple, ref.fillna("-").fillna(-9.0).collect()))

    write_counts(daily_counts(df.where("Date < '2020-04-10'"), names, ["c"]), path)
    april = "Date >= '2020-04-01' AND Date < '2020-05-01'"
    changed = df.withColumn("x", F.when(F.expr(april), F.col("x") + 100).otherwise(F.col("x")))
    write_counts(daily_counts(changed.where("Date >= '2020-04-01'"), names, ["c"]), path)
    counts = spark.read.parquet(path)
    for cutoff in ("2020-02-03", "2020-04-30", "2021-01-01"):
        day = F.lit(cutoff).cast("date")
        want = width_reference(changed.where(F.col("Date") <= day), names, ["c"])
        assert rows(merged_width_reference(counts, day, names, ["c"])) == rows(want)
    plan = counts.where("date_month <= 202002")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_month" in plan
