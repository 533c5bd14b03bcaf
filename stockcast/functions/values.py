"""Missing values and numeric coercion. NULL is the only missing value after these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

FLOATS = (T.FloatType, T.DoubleType)
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def type_of(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.NumericType, T.BooleanType))


def finite(col: Column) -> Column:
    """NaN and infinities become NULL."""
    return F.when(F.isnan(col) | (F.abs(col) == F.lit(float("inf"))), None).otherwise(col)


def finite_columns(df: DataFrame) -> DataFrame:
    """Apply ``finite`` to every float column."""
    floats = {f.name: finite(F.col(f.name)) for f in df.schema.fields if isinstance(f.dataType, FLOATS)}
    return df.withColumns(floats) if floats else df


def clip_low(col: Column, low: float) -> Column:
    """Lower bound that keeps NULL (``greatest`` would turn NULL into the bound)."""
    return F.when(col < F.lit(low), F.lit(low)).otherwise(col)
