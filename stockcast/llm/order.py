"""Exact positions of rows in a distributed order, with DataFrame operations only.

A window over a whole table or over a hot group would send it to one task. Here the order is cut
into buckets by a monotone bucket number; only bucket sizes are summed up along the order, and rows
are numbered inside their bucket.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKET_ROWS = 4_096  # rows a bucket aims at


def bucket_bits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    """Bits of a uniform hash that cut ``rows`` rows into buckets of about ``bucket_rows``."""
    return max(0, math.ceil(math.log2(max(1, rows) / bucket_rows)))


def hash_bucket(hashed: Column, bits: int) -> Column:
    """The leading ``bits`` of a signed 64-bit hash, as a number that ascends with the hash."""
    return F.shiftright(hashed, 64 - bits) + F.lit(2 ** (bits - 1)) if bits else F.lit(0).cast("long")


def unit_interval(hashed: Column) -> Column:
    """A double in [0, 1) from the upper 53 bits of a 64-bit hash."""
    return F.shiftrightunsigned(hashed, 11).cast("double") * F.lit(2.0**-53)


def with_positions(df: DataFrame, keys: list[str], bucket: str, order: list[str]) -> DataFrame:
    """Add ``position`` (from 0) and ``group_rows`` within the groups of ``keys`` (not null), in the order of
    ``bucket`` and then ``order``.

    ``df`` is read twice, so it should be a written table. Rows that agree in everything may swap.
    """
    own = Window.partitionBy(*keys) if keys else Window.partitionBy()
    sizes = df.groupBy(*keys, bucket).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(own.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *keys, bucket, F.coalesce(before, F.lit(0)).alias("__before"), F.sum("__n").over(own).alias("group_rows"))
    inside = Window.partitionBy(*keys, bucket).orderBy(*order)
    return (
        df.join(offsets, [*keys, bucket])
        .withColumn("position", F.col("__before") + F.row_number().over(inside) - 1)
        .drop("__before")
    )
