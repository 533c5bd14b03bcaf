"""Calendar features and the split of date columns into model inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import DATE
from stockcast.functions.dates import calendar_parts, epoch_seconds
from stockcast.functions.values import DATES


def add_calendar(df: DataFrame, date_col: str = DATE) -> DataFrame:
    """Add year, month, weekofyear, dayofweek, is_month_start, is_month_end; NULL dates give NULLs."""
    return df.withColumns(calendar_parts(F.col(date_col)))


def date_parts(df: DataFrame) -> DataFrame:
    """Replace every date or timestamp column ``c`` by seven numeric columns ``c_*``.

    Used by both fitting and scoring.
    """
    for field in [f for f in df.schema.fields if isinstance(f.dataType, DATES)]:
        c, col = field.name, F.col(field.name)
        parts = calendar_parts(col)
        df = df.withColumns({
            f"{c}_year": parts["year"],
            f"{c}_month": parts["month"],
            f"{c}_week": parts["weekofyear"],
            f"{c}_day": F.dayofmonth(col),
            f"{c}_dow": parts["dayofweek"],
            f"{c}_dayofyear": F.dayofyear(col),
            f"{c}_ts": epoch_seconds(col, field.dataType),
        }).drop(c)
    return df
