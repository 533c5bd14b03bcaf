"""Median imputation, minimum-history filter and target clipping."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import MACRO_COLS, STORE, TARGET
from stockcast.functions.values import clip_low, finite, finite_columns
from stockcast.operators.hot_groups import pinned
from stockcast.operators.quantiles import exact_quantiles, medians_wide

MEDIAN = "__median"


@dataclass
class MedianFill:
    """Fitted medians: a table per group and, where a group has none, one value per column."""

    group_col: str
    cols: list[str]
    by_group: DataFrame | None = None
    overall: dict[str, float | None] = field(default_factory=dict)

    def apply(self, df: DataFrame) -> DataFrame:
        if not self.cols:
            return df
        filled = df.join(self.by_group, self.group_col, "left")
        values = {
            c: F.coalesce(finite(F.col(c).cast("double")), F.col(c + MEDIAN), F.lit(self.overall.get(c)).cast("double"))
            for c in self.cols
        }
        return filled.withColumns(values).select(*df.columns)


def fit_medians(df: DataFrame, cols: Sequence[str] = MACRO_COLS, group_col: str = STORE) -> MedianFill:
    """Median per group over all rows of ``df``, then the median of the columns so filled.

    The second step scans the data only for columns that the first one leaves with NULLs.
    """
    cols = [c for c in cols if c in df.columns]
    if not cols:
        return MedianFill(group_col, [])
    df = finite_columns(df.select(group_col, *cols))
    medians, rows = pinned(medians_wide(df, cols, [group_col], MEDIAN), "medians")
    fill = MedianFill(group_col, cols, medians.where(F.col(group_col).isNotNull()))
    # a column stays open where a whole group lacks it, or where the group itself is NULL
    if rows is None:
        lacking = medians.agg(*[
            F.max(F.col(c + MEDIAN).isNull() | F.col(group_col).isNull()).alias(c) for c in cols]).first()
        open_cols = [c for c in cols if lacking[c]]
    else:
        open_cols = [c for c in cols if any(r[c + MEDIAN] is None or r[group_col] is None for r in rows)]
    if open_cols:
        overall = exact_quantiles(fill.apply(df), open_cols, [0.5], median_rule=True).collect()
        fill.overall = {r["feature"]: r["quantiles"][0] for r in overall}
    return fill


def keep_full_history(df: DataFrame) -> DataFrame:
    """Drop rows that lack any ``lag_*`` or ``roll_*`` value."""
    names = [c for c in df.columns if c.startswith(("lag_", "roll_"))]
    return df.dropna(subset=names) if names else df


def finalize_features(
    df: DataFrame,
    group_col: str = STORE,
    target_col: str = TARGET,
    macro_cols: Sequence[str] = MACRO_COLS,
    fit_rows: DataFrame | None = None,
) -> DataFrame:
    """Fill macro columns, keep rows with full history, clip the target at 0.

    Medians come from all rows of ``df`` before the filter, or from ``fit_rows`` (for example
    training rows only, or the same rows without the history columns).
    """
    fill = fit_medians(df if fit_rows is None else fit_rows, macro_cols, group_col)
    filled = fill.apply(df)
    return keep_full_history(filled).withColumn(target_col, clip_low(F.col(target_col), 0))
