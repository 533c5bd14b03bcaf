"""Join the sales fact with store-week attributes and the store dimension."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from stockcast.defaults import DATE, HOLIDAY, STORE


def left_lookup(left: DataFrame, right: DataFrame, on: Sequence[str], null_safe: bool = False) -> DataFrame:
    """LEFT equi join; other columns both sides have are told apart as ``<c>_x`` and ``<c>_y``.

    Duplicate right keys fan out. There is no broadcast hint: Spark broadcasts the right side
    when its known size allows and splits skewed join partitions otherwise.
    """
    shared = [c for c in right.columns if c in left.columns and c not in on]
    left = left.withColumnsRenamed({c: f"{c}_x" for c in shared})
    right = right.withColumnsRenamed({c: f"{c}_y" for c in shared})
    added = [c for c in right.columns if c not in on]
    if not null_safe:
        return left.join(right, list(on), "left").select(*left.columns, *added)
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    same = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return left.join(right, same, "left").drop(*[f"__r_{c}" for c in on])


def enrich_panel(
    sales: DataFrame,
    features: DataFrame,
    stores: DataFrame,
    store_col: str = STORE,
    date_col: str = DATE,
    flag_col: str = HOLIDAY,
    null_safe: bool = False,
) -> DataFrame:
    """Sales with store-week features and store attributes, and one holiday flag as 0/1.

    If both inputs carry the flag, the features' value decides, even where no features row
    matched (then 0); the sales flag is not a fallback.
    """
    df = left_lookup(sales, features, [store_col, date_col], null_safe)
    df = left_lookup(df, stores, [store_col], null_safe)
    sided = [f"{flag_col}_y", f"{flag_col}_x"]
    source = next((c for c in [*sided, flag_col] if c in df.columns), None)
    flag = F.coalesce(F.col(source).cast("int"), F.lit(0)) if source else F.lit(0)
    return df.withColumn(flag_col, flag).drop(*[c for c in sided if c in df.columns])
