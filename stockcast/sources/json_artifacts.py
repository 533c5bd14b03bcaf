"""Drift references, drift reports and preprocessing metadata as JSON documents.

Inside the engine these are tables; a document holds a few values per feature and one line.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stockcast.operators.boosting import Preprocess

WIDTH_DOCUMENT = (
    "n_rows bigint, feature_names array<string>, cat_cols array<string>, features map<string, struct<type string, "
    "missing_rate double, stats struct<mean double, std double, min double, max double>, "
    "hist struct<bins array<double>, counts array<bigint>>, top_values map<string, double>>>"
)
QUANTILE_DOCUMENT = (
    "feature_names array<string>, numeric_edges map<string, array<double>>, numeric_ref_props map<string, array<double>>, "
    "cat_ref_props map<string, map<string, double>>, n_ref bigint"
)
PREPROCESS_DOCUMENT = (
    "model_name string, feature_names array<string>, cat_cols array<string>, cat_mapping map<string, array<string>>"
)
POSITION = "CAST(array_position(feature_names, feature) - 1 AS INT) AS pos"


def _document(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def _write(document: DataFrame, path: str) -> None:
    document.select(F.to_json(F.struct("*"))).coalesce(1).write.mode("overwrite").text(path)


def read_width_reference(spark: SparkSession, path: str) -> DataFrame:
    """An equal-width reference document as a reference table."""
    features = _document(spark, path, WIDTH_DOCUMENT).selectExpr("n_rows", "feature_names", "explode(features) AS (feature, f)")
    total = "aggregate(f.hist.counts, 0L, (a, x) -> a + x)"
    stats = ["f.missing_rate", "f.stats.mean", "f.stats.std", "f.stats.min", "f.stats.max", "n_rows"]
    numeric = features.where("f.type = 'numeric'").selectExpr("*", "posexplode(f.hist.counts) AS (bin, cnt)").selectExpr(
        POSITION, "feature", "'numeric' AS kind", "bin", "f.hist.bins[bin] AS lo", "f.hist.bins[bin + 1] AS hi",
        "CAST(NULL AS STRING) AS key", "cnt", f"cnt / nullif({total}, 0) AS share", *stats)
    categorical = features.where("f.type = 'categorical'").selectExpr("*", "explode(f.top_values) AS (key, share)").selectExpr(
        POSITION, "feature", "'categorical' AS kind", "CAST(NULL AS INT) AS bin", "CAST(NULL AS DOUBLE) AS lo",
        "CAST(NULL AS DOUBLE) AS hi", "key", "CAST(round(share * n_rows) AS BIGINT) AS cnt", "share", *stats)
    return numeric.unionByName(categorical)


def write_width_reference(reference: DataFrame, path: str) -> None:
    """A reference table as an equal-width reference document."""
    bins = "array_sort(collect_list(IF(kind = 'numeric', struct(bin, lo, hi, cnt), NULL)))"
    tops = "map_from_entries(collect_list(IF(kind = 'categorical', struct(key, share), NULL)))"
    features = (
        reference.groupBy("pos", "feature", "kind", "missing_rate", "mean", "std", "min", "max", "n_rows")
        .agg(F.expr(bins).alias("bins"), F.expr(tops).alias("tops"))
        .selectExpr(
            "pos", "feature", "kind", "n_rows",
            "struct(kind AS type, missing_rate, "
            "IF(kind = 'numeric', struct(mean, std, min, max), NULL) AS stats, "
            "IF(kind = 'numeric', struct(concat(array(bins[0].lo), transform(bins, b -> b.hi)) AS bins, "
            "transform(bins, b -> b.cnt) AS counts), NULL) AS hist, "
            "IF(kind = 'categorical', tops, NULL) AS top_values) AS f")
    )
    ordered = "array_sort(collect_list(struct(pos, feature, kind)))"  # one entry per feature
    _write(features.groupBy().agg(
        F.expr("date_format(now(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").alias("created_at_utc"),
        F.max("n_rows").alias("n_rows"),
        F.expr(f"transform({ordered}, x -> x.feature)").alias("feature_names"),
        F.expr(f"transform(filter({ordered}, x -> x.kind = 'categorical'), x -> x.feature)").alias("cat_cols"),
        F.expr("map_from_entries(collect_list(struct(feature, f)))").alias("features")), path)


def read_quantile_reference(spark: SparkSession, path: str) -> DataFrame:
    """A quantile reference document as a reference table; infinite edges become NULL."""
    document = _document(spark, path, QUANTILE_DOCUMENT)
    open_end = "abs({x}) = double('infinity')"
    numeric = document.selectExpr("feature_names", "n_ref", "numeric_edges", "explode(numeric_ref_props) AS (feature, props)").selectExpr(
        "*", "posexplode(props) AS (bin, ref_prop)", "numeric_edges[feature] AS e").selectExpr(
        POSITION, "feature", "'numeric' AS kind", "bin", f"IF({open_end.format(x='e[bin]')}, NULL, e[bin]) AS lo",
        f"IF({open_end.format(x='e[bin + 1]')}, NULL, e[bin + 1]) AS hi", "CAST(NULL AS STRING) AS key", "ref_prop", "n_ref")
    categorical = document.selectExpr("feature_names", "n_ref", "explode(cat_ref_props) AS (feature, props)").selectExpr(
        "*", "explode(props) AS (key, ref_prop)").selectExpr(
        POSITION, "feature", "'categorical' AS kind", "CAST(NULL AS INT) AS bin", "CAST(NULL AS DOUBLE) AS lo",
        "CAST(NULL AS DOUBLE) AS hi", "key", "ref_prop", "n_ref")
    return numeric.unionByName(categorical)


def write_quantile_reference(reference: DataFrame, path: str) -> None:
    """A reference table as a quantile reference document; open ends are written as infinities."""
    features = reference.groupBy("pos", "feature", "kind", "n_ref").agg(
        F.expr("array_sort(collect_list(IF(kind = 'numeric', struct(bin, lo, hi, ref_prop), NULL)))").alias("bins"),
        F.expr("map_from_entries(collect_list(IF(kind = 'categorical', struct(key, ref_prop), NULL)))").alias("props"))

    def as_map(kind: str, value: str):
        return F.expr(f"map_from_entries(collect_list(IF(kind = '{kind}', struct(feature, {value}), NULL)))")

    edges = "concat(array(double('-infinity')), transform(bins, b -> coalesce(b.hi, double('infinity'))))"
    _write(features.groupBy().agg(
        F.expr("transform(array_sort(collect_list(struct(pos, feature))), x -> x.feature)").alias("feature_names"),
        as_map("numeric", edges).alias("numeric_edges"),
        as_map("numeric", "transform(bins, b -> b.ref_prop)").alias("numeric_ref_props"),
        as_map("categorical", "props").alias("cat_ref_props"),
        F.max("n_ref").alias("n_ref")), path)


def write_drift_report(report: DataFrame, path: str) -> None:
    """A drift report as one document: per feature its PSI and moments, or its category differences."""
    features = report.groupBy("feature", "kind", "psi", "mean_batch", "std_batch", "missing_rate", "n_batch_rows").agg(
        F.expr("map_from_entries(collect_list(IF(kind = 'categorical', struct(value, delta), NULL)))").alias("drift")
    ).selectExpr(
        "feature", "n_batch_rows",
        "struct(psi, mean_batch, std_batch, missing_rate, IF(kind = 'categorical', drift, NULL) AS top_value_drift) AS f")
    _write(features.groupBy().agg(
        F.expr("date_format(now(), \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")").alias("created_at_utc"),
        F.max("n_batch_rows").alias("n_batch_rows"),
        F.expr("map_from_entries(collect_list(struct(feature, f)))").alias("features")), path)


def read_preprocess(spark: SparkSession, path: str) -> Preprocess:
    """Preprocessing metadata from a document."""
    row = _document(spark, path, PREPROCESS_DOCUMENT).first()
    return Preprocess(row["model_name"], row["feature_names"], row["cat_cols"], dict(row["cat_mapping"]))


def write_preprocess(spark: SparkSession, prep: Preprocess, path: str) -> None:
    _write(spark.createDataFrame(
        [(prep.model_name, prep.feature_names, prep.cat_cols, prep.cat_mapping)], PREPROCESS_DOCUMENT), path)
