"""A panel written once by series, so that history, seasonal lookup, medians and reports share one shuffle.

Rows are bucketed by the series key: every later window, group or join on it (alone or with more columns)
reads the buckets and exchanges nothing. A bucket is one task's work, so series above a bound, and rows
without a key, are not bucketed; they lie in a plain table beside it and take the operators' own way for hot
series. No series is in both, so results of the two parts add up.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from stockcast.defaults import DATE, HORIZON_DAYS, KEYS, SEASON_DAYS, TARGET
from stockcast.operators.history import add_history
from stockcast.operators.hot_groups import MAX_GROUP_ROWS, hot_keys
from stockcast.operators.naive import SEASONAL, fill_with_medians, seasonal_naive
from stockcast.operators.scoring import forecast_metrics
from stockcast.operators.temporal import cutoff_date
from stockcast.session import note_stage, shared_dir, write_stage

BUCKET_ROWS = 4_000_000  # rows a bucket aims at


@dataclass
class SeriesLayout:
    """The bucketed table of all ordinary series, and a plain table of the rest (None if there is none)."""

    name: str
    keys: list[str]
    bucketed: DataFrame
    rest: DataFrame | None = None
    max_series_rows: int = MAX_GROUP_ROWS

    @property
    def rows(self) -> DataFrame:
        return self.bucketed if self.rest is None else self.bucketed.unionByName(self.rest)

    def apply(self, plain: Callable[[DataFrame], DataFrame], hot: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """``plain`` over the bucketed table and ``hot`` (default: the same) over the rest, together."""
        done = plain(self.bucketed)
        return done if self.rest is None else done.unionByName((hot or plain)(self.rest))

    def forget(self) -> None:
        """Drop the catalog's entry; the files go with the other stages."""
        self.bucketed.sparkSession.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_series_layout(
    df: DataFrame, keys: Sequence[str] = KEYS, date_col: str = DATE, buckets: int | None = None, max_series_rows: int = MAX_GROUP_ROWS
) -> SeriesLayout:
    """Write ``df`` by series: one shuffle, one file per bucket, sorted by series and date.

    ``df`` is read up to four times (sizes, count, both parts), so it should be a written table. An empty table gives one
    empty bucket.
    """
    keys, spark = list(keys), df.sparkSession
    hot = hot_keys(df, keys, max_series_rows)
    keyed = df.dropna(subset=keys)
    short = keyed if hot is None else keyed.join(hot[0], keys, "left_anti")
    if buckets is None:
        buckets = max(1, math.ceil((df.count() - (hot[1] if hot else 0)) / BUCKET_ROWS))
    name, path = f"series_{uuid.uuid4().hex}", f"{shared_dir(spark).rstrip('/')}/series-{uuid.uuid4().hex}"
    note_stage(path)
    dealt = short.select(*df.columns).repartition(buckets, *keys)
    dealt.write.format("parquet").bucketBy(buckets, *keys).sortBy(*keys, date_col).option("path", path).saveAsTable(name)
    keyless = df.where(F.concat(*[F.col(k).cast("string") for k in keys]).isNull())
    rest = keyless if hot is None else keyless.unionByName(keyed.join(hot[0], keys, "left_semi").select(*df.columns))
    rest = write_stage(rest, "series-rest")
    return SeriesLayout(name, keys, spark.table(name), None if rest.isEmpty() else rest, max_series_rows)


def layout_history(layout: SeriesLayout, **options: object) -> DataFrame:
    """``add_history`` over a layout: no exchange for bucketed series, pieces of a range exchange for the others."""
    return layout.apply(
        lambda rows: add_history(rows, layout.keys, max_series_rows=None, **options),
        lambda rows: add_history(rows, layout.keys, max_series_rows=layout.max_series_rows, **options))


def layout_naive(
    layout: SeriesLayout, date_col: str = DATE, target_col: str = TARGET, horizon_days: int = HORIZON_DAYS,
    season_days: int = SEASON_DAYS, then: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Seasonal-naive forecast of the last ``horizon_days`` of the whole panel. The overall median is that of all training rows.

    In buckets the lookup is a range frame of one day within the series instead of a join on key and date, for which Spark
    would exchange both sides; several rows of that day fan out as in the join. ``then`` is applied to the forecast of
    each part, for steps that work within series.
    """
    cutoff = cutoff_date(layout.rows.select(date_col), date_col, horizon_days)
    early, late = F.col(date_col) <= cutoff, F.col(date_col) > cutoff
    everything = layout.rows.where(early)
    then = then or (lambda rows: rows)

    def in_buckets(rows: DataFrame) -> DataFrame:
        series = Window.partitionBy(*layout.keys).orderBy(F.unix_date(date_col))
        before = F.collect_list(F.when(early, F.struct(F.col(target_col).alias("y")))).over(series.rangeBetween(-season_days, -season_days))
        reached = rows.where(F.col(date_col) > F.date_sub(cutoff, season_days)).withColumn(SEASONAL, before).where(late)
        valid = reached.withColumn(SEASONAL, F.explode_outer(SEASONAL)).withColumn(SEASONAL, F.col(SEASONAL)["y"])
        filled = fill_with_medians(valid, rows.where(early), layout.keys, target_col, "pred", SEASONAL, everything)
        return then(filled.select(*rows.columns, "pred"))

    return layout.apply(in_buckets, lambda rows: then(seasonal_naive(
        rows.where(early), rows.where(late), layout.keys, date_col, target_col, season_days=season_days, overall_from=everything)))


def layout_report(layout: SeriesLayout, exact: Callable[[DataFrame], DataFrame] | None = None, **options: object) -> DataFrame:
    """Metrics per series of the seasonal-naive forecast; ``exact`` may change the types of the forecast rows before."""
    return layout_naive(layout, then=lambda rows: forecast_metrics(
        rows if exact is None else exact(rows), pred_col="pred", by=layout.keys), **options)
