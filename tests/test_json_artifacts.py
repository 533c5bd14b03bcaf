import json
import math

import pytest
from pyspark.sql import functions as F

from stockcast.operators.boosting import Preprocess
from stockcast.operators.drift_quantile import quantile_psi, quantile_reference
from stockcast.operators.drift_width import drift_report, width_reference
from stockcast.sources import json_artifacts as ja


@pytest.fixture(scope="module")
def df(spark):
    return spark.range(200).select(
        (F.col("id") % 37).cast("double").alias("x"), F.lit(4.0).alias("k"), (F.col("id") % 3).cast("string").alias("c"))


def rows(df):
    return sorted(map(str, df.collect()))


def test_width_document_round_trip(spark, df, tmp_path):
    ref = width_reference(df, ["x", "k", "c"], ["c"])
    ja.write_width_reference(ref, str(tmp_path / "w"))
    assert rows(ja.read_width_reference(spark, str(tmp_path / "w"))) == rows(ref)


def test_quantile_document_round_trip(spark, df, tmp_path):
    ref = quantile_reference(df, ["x", "k", "c"], ["c"])
    ja.write_quantile_reference(ref, str(tmp_path / "q"))
    back = ja.read_quantile_reference(spark, str(tmp_path / "q"))
    assert rows(back) == rows(ref)
    assert all(abs(r["psi"]) < 1e-12 for r in quantile_psi(df, back, ["x", "k", "c"], ["c"]).collect())


def test_bare_infinities_are_read(spark, tmp_path):
    doc = {"feature_names": ["x"], "numeric_edges": {"x": [-math.inf, 1.0, math.inf]}, "numeric_ref_props": {"x": [0.25, 0.75]},
           "cat_ref_props": {}, "n_ref": 4}
    (tmp_path / "r.json").write_text(json.dumps(doc, indent=2))
    got = ja.read_quantile_reference(spark, str(tmp_path / "r.json")).orderBy("bin").collect()
    assert [(r["lo"], r["hi"], r["ref_prop"]) for r in got] == [(None, 1.0, 0.25), (1.0, None, 0.75)]


def test_width_document_from_elsewhere(spark, tmp_path):
    counts = [3, 0, 7, 10]
    document = {
        "created_at_utc": "2026-01-01T00:00:00", "n_rows": 25, "feature_names": ["colour", "depth", "Lost"], "cat_cols": ["colour"],
        "top_k": 5,
        "features": {
            "depth": {
                "type": "numeric", "missing_rate": 0.2, "stats": {"mean": 6.1, "std": 2.2, "min": 0.0, "max": 10.0},
                "hist": {"bins": [-0.01, 2.5, 5.0, 7.5, 10.0], "counts": counts}},
            "colour": {"type": "categorical", "missing_rate": 0.0, "top_values": {"red": 0.64, "green": 0.36}},
        },
    }
    (tmp_path / "r.json").write_text(json.dumps(document, indent=2))
    ref = ja.read_width_reference(spark, str(tmp_path / "r.json"))
    depth = ref.where("feature = 'depth'").orderBy("bin").collect()
    assert [r["cnt"] for r in depth] == counts and {r["pos"] for r in depth} == {1}
    assert (depth[0]["lo"], depth[0]["hi"], depth[3]["hi"]) == (-0.01, 2.5, 10.0) and math.isclose(sum(r["share"] for r in depth), 1.0)
    assert {r["key"]: r["share"] for r in ref.where("feature = 'colour'").collect()} == {"red": 0.64, "green": 0.36}
    batch = spark.createDataFrame([(6.0, "red"), (10.0, "blue"), (11.0, None)], "depth double, colour string")
    report = {(r["feature"], r["value"]): r for r in drift_report(batch, ref, ["depth", "colour"], ["colour"]).collect()}
    assert report["depth", None]["psi"] > 0 and math.isclose(report["depth", None]["out_of_range_rate"], 1 / 3)
    assert math.isclose(report["colour", "green"]["delta"], -0.36)


def test_preprocess_document(spark, tmp_path):
    own = Preprocess("m", ["a", "b"], ["b"], {"b": ["missing", "x"]})
    ja.write_preprocess(spark, own, str(tmp_path / "p"))
    assert ja.read_preprocess(spark, str(tmp_path / "p")) == own


def test_report_document(spark, df, tmp_path):
    ref = width_reference(df, ["x", "c"], ["c"])
    ja.write_drift_report(drift_report(df.limit(50), ref, ["x", "c"], ["c"]), str(tmp_path / "d"))
    doc = json.loads(next((tmp_path / "d").glob("part-*")).read_text())
    assert doc["n_batch_rows"] == 50 and doc["features"]["x"]["psi"] >= 0
    assert set(doc["features"]["c"]["top_value_drift"]) == {"0", "1", "2"}
