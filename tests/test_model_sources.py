import math
import os
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from stockcast.operators import boosting
from stockcast.operators.boosting import Forecaster, Preprocess, fit_forecaster, score, score_by_expression, stop_round
from stockcast.operators.drift_quantile import quantile_reference
from stockcast.operators.drift_width import width_reference
from stockcast import session
from stockcast.operators.temporal import latest_batch, temporal_split
from stockcast.plans.jobs import batch_job, run_batch, run_training, segment_report, training_job
from stockcast.session import own_stages, recorded_stages, remove_stages, shared_dir, write_stage
from stockcast.sources import artifacts
from stockcast.sources.files import SCHEMAS, read_csv, read_parquet, read_raw, write_by_month, write_parquet


@pytest.fixture(scope="module")
def dataset(spark):
    start = date(2019, 1, 4)
    rows = [
        (s, d, start + timedelta(weeks=w), float(50 * s + 10 * d + 20 * math.sin(w / 8) + (w * 7 % 5)), "AB"[s % 2], None if w % 10 == 0 else 1.0 * w)
        for s in range(1, 4) for d in range(1, 4) for w in range(70)
    ]
    df = spark.createDataFrame(rows, "Store int, Dept int, Date date, Weekly_Sales double, Type string, CPI double")
    return write_stage(df, "model-test")


@pytest.fixture(scope="module")
def trained(dataset):
    return run_training(dataset, num_boost_round=12, early_stopping_rounds=4, max_depth=4, min_rows_per_leaf=5, step_size=0.3)


def test_training_result(dataset, trained):
    prep = trained.forecaster.preprocess
    assert prep.cat_mapping == {"Type": ["A", "B", "missing"]} and "Date_ts" in prep.feature_names and "Date" not in prep.feature_names
    assert trained.predictions.columns == [*dataset.columns, "y_pred"]
    values = [r["y_pred"] for r in trained.predictions.collect()]
    assert len(values) == 36 and all(math.isfinite(v) for v in values)
    metrics = {r["candidate"]: r for r in trained.metrics.collect()}
    decision = trained.decision.first()
    assert decision["promote"] == (metrics["model"]["cost_total"] < metrics["baseline"]["cost_total"])
    assert metrics["model"]["mae"] < 40
    kinds = {r["feature"] for r in trained.reference.select("feature").distinct().collect()}
    assert {"Date_ts", "Date_dow", "Type", "CPI"} <= kinds


def test_batch_and_segments(spark, dataset, trained):
    predictions, report = run_batch(dataset, trained.forecaster, trained.reference)
    assert predictions.count() == 36 and report.where("feature = 'CPI'").count() == 1
    assert run_batch(dataset, trained.forecaster, None)[1] is None
    metrics, costs = segment_report(predictions, [("a", 1, 1), ("b", 2, 2)])
    assert metrics.count() == 9 and costs.count() == 18


def test_scoring_survives_other_columns_and_labels(spark, dataset, trained):
    batch = dataset.limit(5).drop("CPI").withColumn("Type", F.lit("never seen")).withColumn("extra", F.lit(1))
    out = score(trained.forecaster, batch)
    assert out.columns == [*batch.columns, "y_pred"] and out.where("y_pred IS NULL").count() == 0


def test_forecaster_round_trip(spark, dataset, trained, tmp_path):
    artifacts.save_forecaster(spark, trained.forecaster, str(tmp_path / "m"))
    loaded = artifacts.load_forecaster(spark, str(tmp_path / "m"))
    assert loaded.preprocess == trained.forecaster.preprocess
    a, b = (sorted(score(f, dataset).select("Store", "Dept", "Date", "y_pred").collect()) for f in (trained.forecaster, loaded))
    assert a == b


def test_preprocess_save_keeps_order_and_absent_path_raises(spark, tmp_path):
    prep = Preprocess("m", ["z", "Type", "a"], ["Type"], {"Type": [f"v{i}" for i in range(12)]})
    artifacts.save_preprocess(spark, prep, str(tmp_path / "p"))
    assert artifacts.load_preprocess(spark, str(tmp_path / "p")) == prep
    with pytest.raises(FileNotFoundError):
        artifacts.load_preprocess(spark, str(tmp_path / "none"))


def test_any_number_of_labels(spark, tmp_path):
    """200,000 labels: a table joined by the model, saved and read as one, and no label in a plan."""
    rows = spark.range(400_000).select(
        F.format_string("c%06d", F.col("id") % 200_000).alias("c"), ((F.col("id") % 200_000) / 1000.0).alias("Weekly_Sales"), F.col("id").alias("i"))
    train, valid = rows.where("i < 300000"), rows.where("i >= 300000").withColumn("c", F.when(F.col("i") % 10 > 0, F.col("c")).otherwise("unseen"))
    forecaster = fit_forecaster(train, valid, num_boost_round=4, early_stopping_rounds=None, max_depth=4, step_size=0.5, min_rows_per_leaf=5)
    assert forecaster.preprocess.cat_mapping == {} and forecaster.preprocess.wide["c"].count() == 200_002
    scored = score(forecaster, valid)
    known = scored.where("c <> 'unseen'")
    assert known.agg(F.corr("Weekly_Sales", "y_pred")).first()[0] > 0.9
    assert scored.where("c = 'unseen'").agg(F.countDistinct("i")).first()[0] == 10_000
    for plan in (scored, score_by_expression(forecaster, valid)):
        text = plan._jdf.queryExecution().toString()
        assert "c000" not in text and "c199" not in text
    artifacts.save_preprocess(spark, forecaster.preprocess, str(tmp_path / "p"))
    loaded = artifacts.load_preprocess(spark, str(tmp_path / "p"))
    assert loaded == forecaster.preprocess and loaded.wide["c"].count() == 200_002
    assert score(Forecaster(loaded, forecaster.pipeline), valid).agg(F.sum("y_pred")).first()[0] == pytest.approx(
        scored.agg(F.sum("y_pred")).first()[0])


def test_trees_as_expressions_agree_with_the_model(spark, dataset, trained):
    odd = dataset.withColumn("Type", F.when(F.col("Dept") == 1, F.lit("never seen")).when(F.col("Dept") == 2, F.col("Type")))
    for df in (dataset, odd, odd.drop("CPI").limit(0)):
        a = {tuple(r)[:3]: r for r in score(trained.forecaster, df).collect()}
        b = {tuple(r)[:3]: r for r in score_by_expression(trained.forecaster, df).collect()}
        assert a.keys() == b.keys()
        for k, r in a.items():
            assert tuple(r)[:-1] == tuple(b[k])[:-1] and b[k]["y_pred"] == pytest.approx(r["y_pred"], rel=1e-12)
    plan = score_by_expression(trained.forecaster, dataset)._jdf.queryExecution().executedPlan().toString()
    assert "UDF" not in plan and "vector" not in plan.lower()


def test_early_stopping_grows_every_tree_once(spark, dataset):
    train, valid, _ = temporal_split(dataset)
    options = dict(max_depth=3, step_size=0.5)
    short = fit_forecaster(train, valid, num_boost_round=64, early_stopping_rounds=2, **options)
    n = short.trees.getNumTrees - 1  # and the mean
    assert short.patience_ended and n + 2 <= short.rounds < n + 2 + 10
    again = fit_forecaster(train, valid, num_boost_round=n, early_stopping_rounds=None, **options)
    assert again.patience_ended is False and again.rounds == n
    a, b = (sorted(r["y_pred"] for r in score(f, valid).collect()) for f in (short, again))
    assert a == pytest.approx(b)


def test_rounds_compile_no_code_of_their_own(spark, dataset, monkeypatch):
    monkeypatch.setattr(boosting, "BLOCK", 2)
    train, valid, _ = temporal_split(dataset)
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    counts = [compiled.getCount()]
    for seed, rounds in enumerate((4, 4, 14)):
        fitted = fit_forecaster(train, valid, num_boost_round=rounds, early_stopping_rounds=rounds, max_depth=2, seed=seed)
        assert fitted.rounds == rounds
        counts.append(compiled.getCount())
    _, once, more = (b - a for a, b in zip(counts, counts[1:]))
    assert more - once < 10, counts


def test_patience_may_not_run_out(spark, dataset):
    train, valid, _ = temporal_split(dataset)
    fitted = fit_forecaster(train, valid, num_boost_round=6, early_stopping_rounds=6, max_depth=2, step_size=0.01)
    assert not fitted.patience_ended and fitted.rounds == 6 and 2 <= fitted.trees.getNumTrees <= 7


def test_reference_round_trip(spark, dataset, tmp_path):
    for i, build in enumerate((width_reference, quantile_reference)):
        ref = build(dataset.select("CPI", "Type"), ["CPI", "Type"], ["Type"])
        artifacts.save_reference(ref, str(tmp_path / f"r{i}"))
        loaded = artifacts.load_reference(spark, str(tmp_path / f"r{i}"))
        assert sorted(map(str, loaded.collect())) == sorted(map(str, ref.collect()))


def test_stop_round():
    falling = {"squared": [5, 4, 3, 2, 1], "absolute": [5, 4, 3, 2, 1]}
    assert stop_round(falling, 2) == (5, False)
    assert stop_round({"squared": [5, 4, 6, 6, 1], "absolute": [5, 4, 3, 2, 1]}, 2) == (2, True)
    assert stop_round({"squared": [5, 4, 3, 2, 1], "absolute": [1, 2, 3, 4, 5]}, 2) == (1, True)
    assert stop_round({"squared": [5, 1, 2], "absolute": [5, 1, 2]}, 2) == (2, False)


def test_jobs_from_raw_files(spark, tmp_path):
    start, raw, out = date(2010, 2, 5), tmp_path / "raw", str(tmp_path / "out")
    raw.mkdir()
    weeks = [(start + timedelta(weeks=w)).isoformat() for w in range(60)]
    (raw / "stores.csv").write_text("Store,Type,Size\n1,A,10\n2,B,20\n")
    header = "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
    (raw / "features.csv").write_text(header + "".join(
        f"{s},{d},{40 + i % 9},2.5,NA,NA,{i},NA,1,{200 + i},7,{'TRUE' if i % 13 == 0 else 'FALSE'}\n" for s in (1, 2) for i, d in enumerate(weeks)))
    (raw / "train.csv").write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n" + "".join(
        f"{s},{k},{d},{100 * s + 10 * k + i % 7 - (500 if i == 30 else 0)},FALSE\n" for s in (1, 2) for k in (1, 2) for i, d in enumerate(weeks)))
    before = list(session._written)
    decision = training_job(spark, str(raw), out, num_boost_round=4, early_stopping_rounds=None, max_depth=3, min_rows_per_leaf=2).first()
    assert decision["promote"] == (decision["model_cost"] < decision["baseline_cost"])
    dataset = read_parquet(spark, f"{out}/dataset")
    assert dataset.count() == 4 * 48 and dataset.agg(F.min("Weekly_Sales")).first()[0] == 0.0
    assert dataset.agg(F.min("lag_1")).first()[0] < 0 and dataset.where("MarkDown1 IS NOT NULL").count() == 0
    assert dataset.columns[:5] == ["Store", "Dept", "Date", "Weekly_Sales", "Temperature"]
    report = batch_job(spark, out)
    assert session._written == before
    assert read_parquet(spark, f"{out}/batch_predictions").count() == 16 and report.where("psi IS NOT NULL").count() > 10


# files

def test_csv_missing_spellings_and_carriage_returns(spark, tmp_path):
    (tmp_path / "stores.csv").write_bytes(b"Store,Type,Size\r1,A,151315\r2,B,202307\r")
    (tmp_path / "features.csv").write_text(
        "Store,Date,Temperature,Fuel_Price,MarkDown1,MarkDown2,MarkDown3,MarkDown4,MarkDown5,CPI,Unemployment,IsHoliday\n"
        "1,2010-02-05,42.31,NA,NaN,,null,#N/A,5.5,211.1,nan,FALSE\n")
    (tmp_path / "train.csv").write_text("Store,Dept,Date,Weekly_Sales,IsHoliday\n1,1,2010-02-05,-24924.5,TRUE\n")
    raw = read_raw(spark, str(tmp_path))
    assert [tuple(r) for r in raw["stores"].collect()] == [(1, "A", 151315), (2, "B", 202307)]
    assert tuple(raw["features"].first()) == (1, date(2010, 2, 5), 42.31, None, None, None, None, None, 5.5, 211.1, None, False)
    assert tuple(raw["train"].first()) == (1, 1, date(2010, 2, 5), -24924.5, True)


def test_bad_csv_value_raises(spark, tmp_path):
    (tmp_path / "s.csv").write_text("Store,Type,Size\nx1,A,5\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "s.csv"), SCHEMAS["stores"]).collect()


def test_parquet_overwrite_and_partitions(spark, tmp_path):
    df = spark.createDataFrame([(2010, 1.0), (2011, 2.0)], "year int, v double")
    path = str(tmp_path / "t")
    write_parquet(df, path)
    write_parquet(df, path, ["year"])
    assert read_parquet(spark, path).count() == 2
    plan = read_parquet(spark, path).where("year = 2010")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(year" in plan


def test_months_are_pruned_and_replaced_one_by_one(spark, tmp_path):
    start, path = date(2010, 1, 4), f"{tmp_path}/m"
    rows = [(s, start + timedelta(weeks=w), float(w)) for s in (1, 2) for w in range(60)] + [(3, None, 9.0)]
    df = spark.createDataFrame(rows, "Store int, Date date, Weekly_Sales double")
    write_by_month(df, path)
    table = read_parquet(spark, path)
    for side in (latest_batch(table), temporal_split(table)[1]):
        assert "date_month" not in side.columns
        assert sorted(map(str, side.collect())) == sorted(map(str, latest_batch(df).collect()))
        plan = side._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [isnotnull(date_month" in plan and "PushedFilters: [IsNotNull(Date), GreaterThan(Date,2011-" in plan
    assert temporal_split(table)[0].count() == temporal_split(df)[0].count()
    files = {f for f in table.inputFiles() if "date_month=201002" not in f}
    write_by_month(df.where("month(Date) = 2 AND year(Date) = 2010").withColumn("Weekly_Sales", F.lit(-1.0)), path)
    again = read_parquet(spark, path)
    assert files <= set(again.inputFiles()) and again.count() == df.count() and again.where("Weekly_Sales = -1").count() == 8


def test_jobs_leave_no_stage(spark, tmp_path, monkeypatch):
    from stockcast import session
    from stockcast.plans import jobs

    monkeypatch.setattr(jobs, "read_raw", lambda spark, folder: 1 / 0)
    before = list(session._written)
    with pytest.raises(ZeroDivisionError):
        training_job(spark, "none", str(tmp_path))
    assert session._written == before


def test_stage_is_written_to_the_shared_folder(spark):
    staged = write_stage(spark.range(3).toDF("id"), "t")
    assert staged.count() == 3
    assert shared_dir(spark).rstrip("/").split(":")[-1] in staged.inputFiles()[0]


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from stockcast import session

    class Context:
        master = "spark://somewhere:7077"

        @staticmethod
        def getCheckpointDir():
            return None

    class Conf:
        @staticmethod
        def get(name, default):
            return default

    class Session:
        sparkContext, conf = Context, Conf

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(Session)
    assert not session.is_local(Session) and session.is_local(spark)


def test_own_stages_are_removed(spark):
    def place(staged):
        return staged.inputFiles()[0].removeprefix("file://").rpartition("/")[0]

    kept = place(write_stage(spark.range(3).toDF("id"), "kept"))
    with own_stages(spark):
        gone = place(write_stage(spark.range(3).toDF("id"), "gone"))
        assert os.path.isdir(gone)
    assert not os.path.exists(gone) and os.path.isdir(kept)


def test_stages_are_removed_by_path_not_by_position(spark):
    """A removal and another query's live stage between two stages of a pipeline."""
    def place(staged):
        return staged.inputFiles()[0].removeprefix("file://").rpartition("/")[0]

    with recorded_stages() as first:
        one = write_stage(spark.range(3).toDF("id"), "one")
    live = write_stage(spark.range(4).toDF("id"), "live")
    with recorded_stages() as outer, pytest.raises(ZeroDivisionError), own_stages(spark):
        failed = place(write_stage(spark.range(5).toDF("id"), "failed"))
        raise ZeroDivisionError
    assert len(outer) == 1 and not os.path.exists(failed)
    place_of_one = place(one)
    remove_stages(spark, first)
    remove_stages(spark, first)  # again: nothing else is touched
    assert not os.path.exists(place_of_one) and live.count() == 4
