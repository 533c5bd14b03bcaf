"""Column profiles, binned counts and category shares over many columns at once."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, Window, functions as F

from stockcast.defaults import TOP_K
from stockcast.functions import sqltext as sql
from stockcast.functions.values import FLOATS
from stockcast.session import write_stage


def column_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row per column: n_rows, n, missing_rate, mean, std (sample), std_batch (population), min, max.

    One scan with one wide aggregate; only the single result row is unpivoted.
    """
    numbers = df.selectExpr(*[f"{sql.number(df, c)} AS {sql.name(c)}" for c in cols])
    stats = [
        sql.struct(
            feature=sql.text(c),
            n_rows="count(1)",
            n=f"count({x})",
            missing_rate=f"1.0D - count({x}) / nullif(count(1), 0)",
            mean=f"avg({x})",
            std=f"stddev_samp({x})",
            std_batch=f"stddev_pop({x})",
            min=f"min({x})",
            max=f"max({x})",
        )
        for c, x in ((c, sql.name(c)) for c in cols)
    ]
    wide = numbers.agg(*[F.expr(s).alias(f"__{i}") for i, s in enumerate(stats)])
    return wide.selectExpr(f"inline({sql.array(f'__{i}' for i in range(len(cols)))})")


ABSENT, OUTSIDE = -2, -1  # bins of missing values and of values beyond the bounds


@dataclass(frozen=True)
class FeatureCounts:
    """Counted rows per feature and bin or category, evaluated once and kept as a written table.

    ``table`` has (feature, bin, key, cnt) and, if asked for, mean and var of each group; a number has ``bin`` (from 0, ``OUTSIDE``,
    ``ABSENT``) and no ``key``, a category has a ``key``, and the bin ``ABSENT`` if it is missing.
    """

    table: DataFrame
    n_rows: int

    def bins(self) -> DataFrame:
        """(feature, bin, cnt[, mean, var]) of numbers: as many rows as there are bins, so a broadcast copy."""
        rows = self.table.where(F.col("key").isNull()).drop("key")
        return F.broadcast(self.table.sparkSession.createDataFrame(rows.collect(), rows.schema))

    def categories(self) -> DataFrame:
        """(feature, key, cnt) of categories, of any number."""
        return self.table.where(F.col("key").isNotNull()).groupBy("feature", "key").agg(F.sum("cnt").alias("cnt"))

    def missing_rates(self) -> DataFrame:
        """(feature, missing_rate, n_rows) of categories; NULL without rows."""
        gone = F.sum(F.when(F.col("bin") == ABSENT, F.col("cnt")).otherwise(0))
        known = self.table.where(F.col("key").isNotNull()).groupBy("feature").agg((gone / F.sum("cnt")).alias("missing_rate"))
        return known.withColumn("n_rows", F.lit(self.n_rows).cast("bigint"))


def feature_counts(
    df: DataFrame, edges: Iterable[Row], nums: Sequence[str], cats: Sequence[str], missing: str, right_closed: bool, moments: bool = False
) -> FeatureCounts:
    """Bins of all numbers, keys of all categories, missing values and row count in one scan.

    A value's bin is the number of inner cuts below it (right-closed) or at or below it. ``edges`` has
    one row per column (feature, cuts, lo, hi; NULL bounds are open), each with cuts of its own number; a column without a row has
    one bin. Cuts become literals, so a row turns into small codes only, which are counted on the map side. Totals
    are sums of these counts, so they cost no scan and repeated tasks cannot count twice. ``moments`` adds mean and
    population variance per group, which combine into those of a column.
    """
    known, exprs, codes = {r["feature"]: r for r in edges}, [], []
    passed = ">" if right_closed else ">="
    for i, c in enumerate(nums):
        x = f"x{i}"
        exprs.append(f"{sql.number(df, c)} AS {x}")
        inside = "0"
        if c in known:
            r = known[c]
            inside = " + ".join(f"IF({x} {passed} {sql.double(v)}, 1, 0)" for v in r["cuts"]) or "0"
            outside = [f"{x} < {sql.double(r['lo'])}"] if r["lo"] is not None else []
            outside += [f"{x} > {sql.double(r['hi'])}"] if r["hi"] is not None else []
            inside = f"IF({' OR '.join(outside)}, {OUTSIDE}, {inside})" if outside else inside
        codes.append(sql.struct(
            f=str(i), bin=f"IF({x} IS NULL, {ABSENT}, {inside})", key="CAST(NULL AS STRING)", **({"x": x} if moments else {})))
    for i, c in enumerate(cats, len(nums)):
        floating = isinstance(df.schema[c].dataType, FLOATS)
        exprs.append(f"coalesce(CAST({sql.name(c)} AS STRING), {sql.text(missing)}) AS k{i}")
        exprs.append(f"IF({sql.name(c)} IS NULL{f' OR isnan({sql.name(c)})' * floating}, {ABSENT}, 0) AS a{i}")
        codes.append(sql.struct(f=str(i), bin=f"a{i}", key=f"k{i}", **({"x": "CAST(NULL AS DOUBLE)"} if moments else {})))
    if not codes:
        raise ValueError("no features to count")
    more = [F.avg("x").alias("mean"), F.var_pop("x").alias("var")] if moments else []
    counted = df.selectExpr(*exprs).selectExpr(f"inline({sql.array(codes)})").groupBy("f", "bin", "key").agg(
        F.count(F.lit(1)).alias("cnt"), *more)
    names = sql.array(sql.text(c) for c in (*nums, *cats))
    table = write_stage(counted.selectExpr(
        f"get({names}, f) AS feature", "bin", "key", "cnt", *(["mean", "var"] if moments else [])), "counts")
    first = [*nums, *cats][0]
    return FeatureCounts(table, table.where(F.col("feature") == first).agg(F.sum("cnt")).first()[0] or 0)


def combined_moments(bins: DataFrame) -> DataFrame:
    """(feature, n, mean, std_batch) of numbers from the counts and moments of their bins."""
    known = bins.where(F.col("bin") != ABSENT)
    means = known.groupBy("feature").agg(F.sum("cnt").alias("n"), (F.sum(F.col("cnt") * F.col("mean")) / F.sum("cnt")).alias("__m"))
    off = F.col("mean") - F.col("__m")
    return known.join(means, "feature").groupBy("feature").agg(
        F.max("n").alias("n"), F.max("__m").alias("mean"),
        F.sqrt(F.sum(F.col("cnt") * (F.col("var") + off * off)) / F.sum("cnt")).alias("std_batch"))


def top_of(counts: FeatureCounts, top_k: int = TOP_K) -> DataFrame:
    """The most frequent keys of each category with their share of all rows: (feature, key, cnt, share).

    Ties go to the smaller key. The rank filter is applied per map partition before the shuffle.
    """
    order = Window.partitionBy("feature").orderBy(F.desc("cnt"), "key")
    ranked = counts.categories().withColumn("nr", F.row_number().over(order)).where(F.col("nr") <= top_k)
    return ranked.select("feature", "key", "cnt", (F.col("cnt") / F.lit(counts.n_rows)).alias("share"))


def top_categories(df: DataFrame, cols: Sequence[str], missing: str, top_k: int = TOP_K) -> DataFrame:
    """``top_of`` over the columns of a frame, in one scan."""
    return top_of(feature_counts(df, [], [], cols, missing, right_closed=False), top_k)
