"""Pieces of SQL expression text, for wide expressions over many columns."""

from __future__ import annotations

from pyspark.sql import DataFrame

from stockcast.functions.values import DATES, FLOATS, is_numeric, type_of


def name(col: str) -> str:
    return "`" + col.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def number(df: DataFrame, col: str) -> str:
    """A column as double; text that is no number, NaN and infinities are NULL."""
    dtype, c = type_of(df, col), name(col)
    if isinstance(dtype, DATES):
        raise TypeError(f"column {col!r} is a date; split it with date_parts first")
    if is_numeric(dtype) and not isinstance(dtype, FLOATS):
        return f"CAST({c} AS DOUBLE)"
    value = f"CAST({c} AS DOUBLE)" if isinstance(dtype, FLOATS) else f"TRY_CAST({c} AS DOUBLE)"
    return f"IF(isnan({value}) OR abs({value}) = double('infinity'), NULL, {value})"


def double(value: float) -> str:
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def struct(**fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"


def array(items) -> str:
    return f"array({', '.join(items)})"
