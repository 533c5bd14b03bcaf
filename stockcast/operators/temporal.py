"""Split of a panel by time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from stockcast.defaults import DATE, HORIZON_DAYS, MONTH
from stockcast.functions.dates import parse_date
from stockcast.functions.values import type_of


def moment(df: DataFrame, date_col: str) -> Column:
    """The date column; text is parsed as a date, what is no date is NULL."""
    return parse_date(F.col(date_col), strict=False) if isinstance(type_of(df, date_col), T.StringType) else F.col(date_col)


def month_number(at: Column) -> Column:
    """Year and month of a date as one number that ascends with it: the partition of a dated table."""
    return (F.year(at) * 100 + F.month(at)).cast("int")


def _cutoff(df: DataFrame, date_col: str, horizon_days: int) -> tuple[str | None, T.DataType]:
    """Last date minus the horizon as text, and its type. A table by months is asked for its last month only."""
    at = moment(df, date_col)
    kind = T.DateType() if isinstance(type_of(df, date_col), T.StringType) else type_of(df, date_col)
    if MONTH in df.columns:
        month = df.agg(F.max(MONTH)).first()[0]
        df = df if month is None else df.where(F.col(MONTH) == month)
    last = F.max(at)
    back = F.date_sub(last, horizon_days) if isinstance(kind, T.DateType) else last - F.make_dt_interval(F.lit(horizon_days))
    return df.agg(back.cast("string").alias("cutoff")).first()["cutoff"], kind


def cutoff_date(df: DataFrame, date_col: str = DATE, horizon_days: int = HORIZON_DAYS) -> Column:
    """Last date minus the horizon, fetched once: a literal, so later scans push it down and prune by it."""
    value, kind = _cutoff(df, date_col, horizon_days)
    return F.lit(value).cast(kind)


def _by_month(df: DataFrame, cutoff: Column, after: bool) -> DataFrame:
    """Leave out whole months of a table by months, whose column then goes; other tables stay as they are."""
    if MONTH not in df.columns:
        return df
    month = month_number(cutoff.cast("date"))
    return df.where(F.col(MONTH) >= month if after else F.col(MONTH) <= month).drop(MONTH)


def temporal_split(
    df: DataFrame, date_col: str = DATE, horizon_days: int = HORIZON_DAYS
) -> tuple[DataFrame, DataFrame, Column]:
    """Training rows up to the cutoff, validation rows after it, and the cutoff; NULL dates in neither.

    Of a table written by months, only the months that a side can lie in are read.
    """
    cutoff = cutoff_date(df, date_col, horizon_days)
    before, after = _by_month(df, cutoff, after=False), _by_month(df, cutoff, after=True)
    return before.where(moment(before, date_col) <= cutoff), after.where(moment(after, date_col) > cutoff), cutoff


def latest_batch(df: DataFrame, date_col: str = DATE, horizon_days: int = HORIZON_DAYS) -> DataFrame:
    """Rows of the last ``horizon_days`` days."""
    cutoff = cutoff_date(df, date_col, horizon_days)
    recent = _by_month(df, cutoff, after=True)
    return recent.where(moment(recent, date_col) > cutoff)


def reference_rows(df: DataFrame, cutoff: Column, date_col: str = DATE) -> DataFrame:
    """Rows up to a cutoff, for a drift reference; what is no date counts for nothing."""
    return _by_month(df, cutoff, after=False).where(F.col(date_col).try_cast("date") <= cutoff)
