"""Model matrix: column alignment, numeric coercion, category dictionaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from stockcast.functions import sqltext as sql
from stockcast.functions.values import DATES, is_numeric, type_of
from stockcast.operators.hot_groups import MAX_GROUP_ROWS, is_small
from stockcast.session import write_stage

MISSING = "missing"


def align_pair(train: DataFrame, valid: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with the union of columns in training order; absent columns are 0."""
    names = train.columns + [c for c in valid.columns if c not in train.columns]
    return align_to(train, names), align_to(valid, names)


def align_to(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Exactly ``names`` in order: absent columns are 0, others are dropped."""
    return df.select(*[F.col(c) if c in df.columns else F.lit(0).alias(c) for c in names])


def category_columns(*frames: DataFrame) -> list[str]:
    """Columns that are categorical on any side: everything neither numeric nor a date."""
    found: dict[str, None] = {}
    for df in frames:
        for f in df.schema.fields:
            if isinstance(f.dataType, DATES):
                raise ValueError(f"column {f.name!r} is still a date; apply date_parts first")
            if not is_numeric(f.dataType):
                found[f.name] = None
    return [c for c in frames[0].columns if c in found]


def _labels(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct (feature, value) pairs; NULL counts as the missing label."""
    pairs = sql.array(
        sql.struct(feature=sql.text(c), value=f"coalesce(CAST({sql.name(c)} AS STRING), '{MISSING}')") for c in cols)
    return df.selectExpr(f"inline({pairs})").distinct()


def category_dictionary(frames: Sequence[DataFrame], cols: Sequence[str], max_labels: int = MAX_GROUP_ROWS) -> DataFrame:
    """Sorted labels of each column over all frames, "missing" included: (feature, value, code).

    Codes are positions in the sorted order. Work is on distinct labels; a column with more than
    ``max_labels`` of them is numbered in ordered pieces instead of one sorted task.
    """
    spark = frames[0].sparkSession
    always = spark.createDataFrame([(c, MISSING) for c in cols], "feature string, value string")
    found = reduce(DataFrame.unionByName, [_labels(df, cols) for df in frames], always).distinct()
    found = write_stage(found, "labels")  # read by the count and the numbering
    order = Window.partitionBy("feature").orderBy("value")
    sizes = found.groupBy("feature").agg(F.count(F.lit(1)).alias("n"))
    most = sizes.agg(F.max("n")).first()[0]
    if most <= max_labels:
        return found.withColumn("code", F.row_number().over(order) - 1)
    # one cut per piece, taken from a sorted sample, which only balances the pieces
    n_pieces = -(-most // max_labels)
    sample = found.sample(min(1.0, 100.0 * n_pieces / most), seed=7).groupBy("feature").agg(
        F.array_sort(F.collect_set("value")).alias("s"))
    cuts = sample.select("feature", F.expr(
        f"array_distinct(transform(sequence(1, {max(1, n_pieces - 1)}), i -> s[CAST(i * size(s) DIV {n_pieces} AS INT)]))").alias("cuts"))
    pieces = found.join(F.broadcast(cuts), "feature", "left").select(
        "feature", "value",
        F.size(F.filter(F.coalesce("cuts", F.array().cast("array<string>")), lambda c: c <= F.col("value"))).alias("piece"),
    )
    starts = pieces.groupBy("feature", "piece").agg(F.count(F.lit(1)).alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("feature").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1))
    ).select("feature", "piece", F.coalesce("before", F.lit(0)).alias("before"))
    within = Window.partitionBy("feature", "piece").orderBy("value")
    return (
        pieces.withColumn("nr", F.row_number().over(within))
        .join(F.broadcast(starts), ["feature", "piece"])
        .select("feature", "value", (F.col("before") + F.col("nr") - 1).cast("int").alias("code"))
    )


def apply_category(col: Column, labels: Sequence[str]) -> Column:
    """Known labels stay; NULL and unseen become "missing"."""
    text = col.cast("string")
    return F.when(text.isin(list(labels)), text).otherwise(F.lit(MISSING))


def apply_dictionary(df: DataFrame, col: str, dictionary: DataFrame) -> DataFrame:
    """Map one column through a dictionary table of any size: label and code columns.

    NULL and unseen values become "missing". A small dictionary is broadcast; a large one is
    joined by shuffle, where Spark splits skewed labels.
    """
    known = dictionary.where(F.col("feature") == col).select(
        F.col("value").alias("__value"), F.col("code").alias("__code"))
    missing_code = known.where(F.col("__value") == MISSING).select("__code").scalar()
    if is_small(known):
        known = F.broadcast(known)
    return df.join(known, F.col(col).cast("string") == F.col("__value"), "left").select(
        *df.columns,
        F.coalesce("__value", F.lit(MISSING)).alias(f"{col}_label"),
        F.coalesce(F.col("__code"), missing_code).alias(f"{col}_code"),
    )


def check_numeric_text(df: DataFrame, cols: Sequence[str]) -> None:
    """Error if a text column that should be numeric holds values but none of them is a number."""
    texts = [c for c in cols if c in df.columns and not is_numeric(type_of(df, c))]
    if not texts:
        return
    counts = df.agg(*[
        F.expr(sql.struct(filled=f"count({sql.name(c)})", numbers=f"count({sql.number(df, c)})")).alias(c) for c in texts]).first()
    bad = [c for c in texts if counts[c]["filled"] > 0 and counts[c]["numbers"] == 0]
    if bad:
        raise ValueError(f"non-numeric values in columns that are not categorical: {', '.join(bad)}")


def model_matrix(
    df: DataFrame, feature_names: Sequence[str], cat_labels: Mapping[str, Sequence[str]], keep: Sequence[str] = ()
) -> DataFrame:
    """The pinned feature columns: categories as known labels, everything else as double, NULL as 0.

    Absent columns are 0 (or "missing"), extra columns are dropped except ``keep``.
    """
    check_numeric_text(df, [c for c in feature_names if c not in cat_labels])
    cols = []
    for c in feature_names:
        if c in cat_labels:
            cols.append(apply_category(F.col(c) if c in df.columns else F.lit(None), cat_labels[c]).alias(c))
        else:
            cols.append(F.expr(_filled(df, c)).alias(c))
    return df.select(*keep, *cols)


def _filled(df: DataFrame, c: str) -> str:
    return f"coalesce({sql.number(df, c)}, 0.0D)" if c in df.columns else "0.0D"


def model_inputs(
    df: DataFrame,
    feature_names: Sequence[str],
    cat_labels: Mapping[str, Sequence[str]],
    wide: Mapping[str, DataFrame],
    keep: Sequence[str] = (),
) -> DataFrame:
    """The pinned feature columns as doubles, NULL as 0: numbers as they are, categories as codes.

    A category with listed labels becomes its place in the list, with the labels as column metadata. One in ``wide`` takes
    ``input`` from its dictionary table (value, input), by a join that Spark plans by size and splits where labels are
    hot, so no label is in the plan. NULL and unseen labels stand for the missing one. Extra columns are dropped except ``keep``.
    """
    check_numeric_text(df, [c for c in feature_names if c not in cat_labels and c not in wide])
    cols = []
    for i, c in enumerate(feature_names):
        label = F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
        if c in wide:
            key, value = f"__label_{i}", f"__input_{i}"
            known = wide[c].select(F.col("value").alias(key), F.col("input").alias(value))
            missing = wide[c].where(F.col("value") == MISSING).select("input").first()["input"]
            df = df.withColumn(f"__own_{i}", F.coalesce(label, F.lit(MISSING)))
            df = df.join(known, F.col(f"__own_{i}") == F.col(key), "left")
            cols.append(F.coalesce(F.col(value), F.lit(missing)).alias(c))
        elif c in cat_labels:
            labels = list(cat_labels[c])
            place = F.array_position(F.array(*[F.lit(x) for x in labels]), F.coalesce(label, F.lit(MISSING)))
            code = F.coalesce(F.nullif(place, F.lit(0)) - 1, F.lit(labels.index(MISSING))).cast("double")
            cols.append(code.alias(c, metadata={"ml_attr": {"type": "nominal", "name": c, "vals": labels}}))
        else:
            cols.append(F.expr(_filled(df, c)).alias(c))
    return df.select(*keep, *cols)
