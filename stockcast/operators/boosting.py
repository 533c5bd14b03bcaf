"""Gradient-boosted forecaster on Spark MLlib: fit with early stopping, score, keep with its metadata."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from itertools import accumulate

from pyspark import SparkContext
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import PREDICTION, TARGET
from stockcast.operators.calendar import date_parts
from stockcast.operators.encode import MISSING, align_pair, category_columns, category_dictionary, model_inputs
from stockcast.operators.tree_sql import ensemble_sql, tree_sql
from stockcast.session import recorded_stages, remove_stages, shared_dir, write_stage

ROW, RAW, FEATURES = "__row", "__prediction", "__features"
Y, SO_FAR = "__y", "__so_far"
MAX_BINS = 64
BLOCK = 10  # rounds between two writes of the predictions so far


@dataclass(frozen=True)
class Preprocess:
    """What scoring must repeat: feature order, categorical columns and their labels.

    Columns with more labels than a tree can split as sets have a table in ``wide`` instead of a list: (value, code, input), with
    the place in the sorted labels and the number the model sees, the label's mean target.
    """

    model_name: str
    feature_names: list[str]
    cat_cols: list[str]
    cat_mapping: dict[str, list[str]]
    wide: Mapping[str, DataFrame] = field(default_factory=dict, compare=False)


@dataclass(frozen=True)
class Forecaster:
    """Metadata, the fitted pipeline (assembler, trees), the rounds grown and whether patience ended the fit."""

    preprocess: Preprocess
    pipeline: PipelineModel
    rounds: int | None = None
    patience_ended: bool | None = None

    @property
    def trees(self) -> GBTRegressionModel:
        return self.pipeline.stages[-1]


def fit_preprocess(
    train: DataFrame, valid: DataFrame, target_col: str = TARGET, model_name: str = "forecaster", max_labels: int = MAX_BINS
) -> Preprocess:
    """Feature order from the training columns, dictionaries from both sides.

    Labels of columns with at most ``max_labels`` are listed; the others stay in a written table, of any length.
    """
    left, right = align_pair(date_parts(train.drop(target_col)), date_parts(valid.drop(target_col)))
    cats = category_columns(left, right)
    mapping: dict[str, list[str]] = {}
    wide: dict[str, DataFrame] = {}
    if cats:
        dictionary = write_stage(category_dictionary([left, right], cats), "dictionary")
        sizes = {r["feature"]: r["n"] for r in dictionary.groupBy("feature").agg(F.count(F.lit(1)).alias("n")).collect()}
        short = [c for c in cats if sizes[c] <= max_labels]
        mapping = {c: [] for c in short}
        for r in sorted(dictionary.where(F.col("feature").isin(short)).collect(), key=lambda r: (r["feature"], r["code"])):
            mapping[r["feature"]].append(r["value"])
        for c in (c for c in cats if c not in mapping):
            wide[c] = write_stage(_with_mean_target(dictionary.where(F.col("feature") == c), train, c, target_col), "wide-labels")
    return Preprocess(model_name, left.columns, cats, mapping, wide)


def _with_mean_target(labels: DataFrame, train: DataFrame, col: str, target_col: str) -> DataFrame:
    """(value, code, input): the mean target of each label in the training rows, of all rows where it has none."""
    if target_col not in train.columns:
        return labels.select("value", "code", F.col("code").cast("double").alias("input"))
    y = F.col(target_col).cast("double")
    overall = train.agg(F.avg(y)).first()[0] or 0.0
    means = train.groupBy(F.coalesce(F.col(col).cast("string"), F.lit(MISSING)).alias("value")).agg(F.avg(y).alias("mean"))
    return labels.join(means, "value", "left").select("value", "code", F.coalesce("mean", F.lit(overall)).alias("input"))


def stop_round(errors: Mapping[str, Sequence[float]], patience: int) -> tuple[int, bool]:
    """Best number of rounds, and whether patience ran out.

    The first metric without a new minimum for ``patience`` rounds decides; if none runs out,
    the first metric's best round counts.
    """
    length = len(next(iter(errors.values())))
    best = dict.fromkeys(errors, 0)
    for i in range(length):
        for name, series in errors.items():
            if series[i] < series[best[name]]:
                best[name] = i
            elif i - best[name] >= patience:
                return best[name] + 1, True
    return best[next(iter(errors))] + 1, False


def fit_forecaster(
    train: DataFrame,
    valid: DataFrame,
    target_col: str = TARGET,
    model_name: str = "forecaster",
    num_boost_round: int = 2000,
    early_stopping_rounds: int | None = 100,
    seed: int = 42,
    step_size: float = 0.03,
    max_depth: int = 6,
    min_rows_per_leaf: int = 50,
    feature_share: float = 0.9,
    row_share: float = 0.9,
    max_bins: int = MAX_BINS,
) -> Forecaster:
    """Squared-error boosting from the mean target; depth 6 stands for 64 leaves.

    Each round grows one tree on what the ensemble so far leaves over, so every tree is grown once. Early stopping watches
    squared and absolute error on ``valid`` after every round and ends the fit when patience runs out; the model keeps the trees up to
    the best round. Inputs and predictions so far are a written table, renewed every ``BLOCK`` rounds; between, the
    newest trees are applied as a model, so that all rounds run the same generated code and none is compiled for its own trees.
    """
    spark = train.sparkSession
    shared_dir(spark)  # tree fitting checkpoints its row-to-node lineage there
    prep = fit_preprocess(train, valid, target_col, model_name, max_bins)
    names = prep.feature_names
    assembler = VectorAssembler(inputCols=names, outputCol=FEATURES)

    def matrix(df: DataFrame) -> DataFrame:
        own = date_parts(df.withColumn(Y, F.col(target_col).cast("double")).drop(target_col))
        return _inputs(own, prep, [Y]).where(F.col(Y).isNotNull())

    grower = RandomForestRegressor(
        featuresCol=FEATURES, labelCol="__rest", numTrees=1, bootstrap=False, maxDepth=max_depth, minInstancesPerNode=min_rows_per_leaf,
        featureSubsetStrategy=str(float(feature_share)), subsamplingRate=row_share, maxBins=max_bins)
    rows, watched = assembler.transform(matrix(train)).select(FEATURES, Y), None
    with recorded_stages() as old:
        rows = _spread(write_stage(rows, "boosting-rows"))
        base = DecisionTreeRegressor(featuresCol=FEATURES, labelCol=Y, maxDepth=0).fit(rows)
        mean = F.expr(tree_sql(base, names))
        rows = rows.withColumn(SO_FAR, mean)
        if early_stopping_rounds is not None:
            watched = write_stage(assembler.transform(matrix(valid)).select(FEATURES, Y, mean.alias(SO_FAR)), "boosting-watched")
    trees: list[DecisionTreeRegressionModel] = []
    errors: dict[str, list[float]] = {"squared": [], "absolute": []}
    best, stopped = num_boost_round, False
    while len(trees) < num_boost_round and not stopped:
        block: list[DecisionTreeRegressionModel] = []
        ahead = rows
        for _ in range(min(BLOCK, num_boost_round - len(trees))):
            rest = ahead.select(FEATURES, (F.col(Y) - F.col(SO_FAR)).alias("__rest"))
            block.append(grower.setSeed(seed + len(trees) + len(block)).fit(rest).trees[0])
            ahead = _advanced(ahead, block[-1], step_size)
        trees += block
        if watched is not None:
            for name, values in _errors(watched, block, step_size).items():
                errors[name] += values
            best, stopped = stop_round(errors, early_stopping_rounds)
        with recorded_stages() as new:
            if len(trees) < num_boost_round and not stopped:
                rows = write_stage(ahead, "boosting-rows")
                if watched is not None:
                    watched = write_stage(reduce(lambda df, tree: _advanced(df, tree, step_size), block, watched), "boosting-watched")
        remove_stages(spark, old)
        old = new
    model = _ensemble([base, *trees[:best]], [1.0] + [step_size] * min(best, len(trees)), len(names))
    return Forecaster(prep, PipelineModel([assembler, model]), len(trees), stopped)


def _inputs(df: DataFrame, prep: Preprocess, keep: Sequence[str]) -> DataFrame:
    return model_inputs(df, prep.feature_names, prep.cat_mapping, prep.wide, keep)


def _spread(rows: DataFrame) -> DataFrame:
    """A written table with a part for every core at least: each round reads it several times, level by level."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() >= cores:
        return rows
    return write_stage(rows.repartition(cores), "boosting-rows")


def _advanced(rows: DataFrame, tree: DecisionTreeRegressionModel, step_size: float) -> DataFrame:
    """Predictions so far with a tree added."""
    scored = tree.setFeaturesCol(FEATURES).setPredictionCol("__tree").transform(rows)
    return scored.select(FEATURES, Y, (F.col(SO_FAR) + F.lit(step_size) * F.col("__tree")).alias(SO_FAR))


def _errors(watched: DataFrame, block: Sequence[DecisionTreeRegressionModel], step_size: float) -> dict[str, list[float]]:
    """Mean squared and absolute error after each round of a block, in one pass."""
    names = [f"__tree_{i}" for i in range(len(block))]
    for tree, name in zip(block, names):
        watched = tree.setFeaturesCol(FEATURES).setPredictionCol(name).transform(watched)
    at = list(accumulate(names, lambda so_far, name: so_far + F.lit(step_size) * F.col(name), initial=F.col(SO_FAR)))[1:]
    watched = watched.select(*[(F.col(Y) - x).alias(name) for x, name in zip(at, names)])
    off = [F.col(name) for name in names]
    row = watched.agg(*[F.avg(x * x) for x in off], *[F.avg(F.abs(x)) for x in off]).first()
    values = [float("inf") if v is None else v for v in row]
    return {"squared": values[:len(block)], "absolute": values[len(block):]}


def _ensemble(trees: Sequence[DecisionTreeRegressionModel], weights: Sequence[float], n_features: int) -> GBTRegressionModel:
    """Trees and weights as one model that MLlib can save, load and apply."""
    gateway = SparkContext._active_spark_context._gateway
    ml = gateway.jvm.org.apache.spark.ml
    kept = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    shares = gateway.new_array(gateway.jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        kept[i], shares[i] = tree._java_obj, float(weight)
    java = ml.regression.GBTRegressionModel(f"gbt_{trees[0].uid}", kept, shares, n_features)
    return GBTRegressionModel(java).setFeaturesCol(FEATURES).setPredictionCol(RAW)


def _with_row(forecaster: Forecaster, df: DataFrame, target_col: str) -> DataFrame:
    packed = df.withColumn(ROW, F.struct(*[F.col(c) for c in df.columns])).drop(target_col)
    return _inputs(date_parts(packed), forecaster.preprocess, [ROW])


def score(forecaster: Forecaster, df: DataFrame, target_col: str = TARGET, out_col: str = PREDICTION) -> DataFrame:
    """All input columns plus the prediction."""
    scored = forecaster.pipeline.transform(_with_row(forecaster, df, target_col))
    return scored.select(f"{ROW}.*", F.col(RAW).alias(out_col))


def score_by_expression(forecaster: Forecaster, df: DataFrame, target_col: str = TARGET, out_col: str = PREDICTION) -> DataFrame:
    """The same with the trees compiled to SQL text: plain projections over columns, no vectors.

    Predictions agree with ``score`` up to the order of the sum. The trees are a few expressions each, added up behind.
    """
    inputs = _with_row(forecaster, df, target_col)
    parts = ensemble_sql(forecaster.trees, forecaster.preprocess.feature_names)
    sums = inputs.select(ROW, *[F.expr(p).alias(f"__part_{i}") for i, p in enumerate(parts)])
    return sums.select(f"{ROW}.*", F.expr(" + ".join(f"__part_{i}" for i in range(len(parts)))).alias(out_col))
