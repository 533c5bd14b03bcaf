"""Row-based lags and rolling statistics per series, without using the current row."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from stockcast.defaults import DATE, KEYS, LAGS, TARGET, WINDOWS
from stockcast.functions.values import finite_columns
from stockcast.operators.hot_groups import COPY, HALO, MAX_GROUP_ROWS, PIECE, hot_keys, range_pieces, row_hash

TIE, SPREAD = "__tie", "__spread"


def history_names(lags: Sequence[int] = LAGS, windows: Sequence[int] = WINDOWS) -> list[str]:
    return [f"lag_{k}" for k in lags] + [f"roll_{s}_{k}" for k in windows for s in ("mean", "std")]


def _history(y: Column, w: WindowSpec, lags: Sequence[int], windows: Sequence[int]) -> dict[str, Column]:
    out = {f"lag_{k}": F.lag(y, k).over(w) for k in lags}
    for k in windows:
        before = w.rowsBetween(-k, -1)
        full = F.count(y).over(before) == k
        out[f"roll_mean_{k}"] = F.when(full, F.sum(y).over(before).cast("double") / k)
        out[f"roll_std_{k}"] = F.when(full, F.stddev_samp(y).over(before))
    return out


def add_history(
    df: DataFrame,
    keys: Sequence[str] = KEYS,
    target_col: str = TARGET,
    date_col: str = DATE,
    lags: Sequence[int] = LAGS,
    windows: Sequence[int] = WINDOWS,
    tie_cols: Sequence[str] = (),
    max_series_rows: int | None = MAX_GROUP_ROWS,
    sizes_from: DataFrame | None = None,
) -> DataFrame:
    """Add ``lag_k``, ``roll_mean_k`` and ``roll_std_k``; rolling values need all k rows before.

    Ordinary series cost one shuffle on ``keys``. Series with more than ``max_series_rows``
    rows go through a range exchange over keys, date, ``tie_cols`` of any type and row hash, in pieces of
    about that many rows, so no task sorts one whole; each piece gets the last rows of the pieces before it.
    Copies that agree in every column may be cut apart too. Sizes are counted
    in ``sizes_from`` (default: the input), which needs ``keys`` only; pass
    ``max_series_rows=None`` when series are known to be short. A decimal target gives exact means.
    """
    keys, names = list(keys), history_names(lags, windows)
    no_series = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    df = finite_columns(df)
    out_cols = [c for c in df.columns if c not in names] + names
    depth = max([*lags, *windows])
    # rows with a NULL key belong to no series: no history, and spread out instead of sorted together
    rows = df.drop(*names).withColumn(TIE, row_hash(df)).withColumn(SPREAD, F.when(no_series, F.col(TIE)))
    order = [date_col, *tie_cols, TIE]
    series = Window.partitionBy(*keys, SPREAD).orderBy(*order)
    exprs = {
        name: F.when(~no_series, expr) for name, expr in _history(F.col(target_col), series, lags, windows).items()
    }

    hot = None if max_series_rows is None else hot_keys(df if sizes_from is None else sizes_from, keys, max_series_rows)
    if hot is None:
        return rows.withColumns(exprs).select(*out_cols)

    hot_series, n_hot = hot
    whole = rows.join(hot_series, keys, "left_anti").withColumns(exprs)
    pieces = range_pieces(
        rows.join(hot_series, keys, "left_semi"), keys, order, depth, math.ceil(n_hot / max_series_rows) + 1, [target_col])
    piece = Window.partitionBy(PIECE, *keys).orderBy(*order, COPY)
    cut = pieces.withColumns(_history(F.col(target_col), piece, lags, windows)).where(~F.col(HALO))
    return whole.select(*out_cols).unionByName(cut.select(*out_cols))
