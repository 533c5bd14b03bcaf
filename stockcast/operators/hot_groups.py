"""Groups that may hold a large share of all rows: find them and cut them into ordered pieces.

Nothing is sampled away or capped: pieces only say which task handles a row, results are
the same for any pieces.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, Window, functions as F, types as T

from stockcast.session import write_stage

MAX_GROUP_ROWS = 10_000_000  # a sorted group up to this size is one task's work
MAX_LISTED = 100_000         # rows a driver-side list or a broadcast may hold
PIECE, HALO, COPY = "__piece", "__halo", "__copy"


def is_small(df: DataFrame, max_rows: int = MAX_LISTED) -> bool:
    """True when the frame holds at most ``max_rows`` rows (stops counting beyond that)."""
    return df.limit(max_rows + 1).count() <= max_rows


def pinned(df: DataFrame, name: str, max_rows: int = MAX_LISTED) -> tuple[DataFrame, list[Row] | None]:
    """Evaluate a small table once: a broadcast copy and its rows.

    Beyond the bound it is written to the shared folder instead, with no rows and no broadcast.
    """
    rows = df.limit(max_rows + 1).collect()
    if len(rows) <= max_rows:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), rows
    return write_stage(df, name), None


def row_hash(df: DataFrame) -> Column:
    """A repeatable number per row content, used to order rows that tie on everything else."""
    nested = (T.MapType, T.VariantType)
    return F.xxhash64(*[F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, nested)])


def hot_keys(df: DataFrame, keys: Sequence[str], max_rows: int = MAX_GROUP_ROWS) -> tuple[DataFrame, int] | None:
    """Keys of every group with more than ``max_rows`` rows, however many, and their rows altogether; None without any.

    Sizes are combined on the map side. The keys are a broadcast copy, or a written table beyond the list bound.
    """
    sizes = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > max_rows)
    listed, rows = pinned(sizes, "hot-keys")
    total = sum(r["__rows"] for r in rows) if rows is not None else listed.agg(F.sum("__rows")).first()[0]
    return (listed.drop("__rows"), total) if total else None


def range_pieces(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], depth: int, n_pieces: int, carried: Sequence[str] = ()
) -> DataFrame:
    """Rows in pieces of one range exchange over ``keys`` and ``order``, each piece with the rows just before it.

    Adds ``PIECE`` and ``HALO``. Pieces follow each other in the order of keys and ``order`` columns of any type. The rows
    with ``HALO`` are copies of the last ``depth`` rows that a group has in the pieces before; they hold only keys,
    order and ``carried`` columns. So whatever looks ``depth`` rows back within (piece, keys) is exact. Rows that agree in
    all of ``order`` may be cut apart, in any order. The exchange is written once.
    """
    keys, order = list(keys), list(order)
    spread = df.withColumn(COPY, F.monotonically_increasing_id()).repartitionByRange(n_pieces, *keys, *order, COPY)
    staged = write_stage(spread.withColumn(PIECE, F.spark_partition_id()), "pieces")
    kept = [*dict.fromkeys([*keys, *order, *carried, COPY, PIECE])]
    backwards = Window.partitionBy(PIECE, *keys).orderBy(*[F.desc(c) for c in (*order, COPY)])
    tails = staged.select(*kept).withColumn("__back", F.row_number().over(backwards)).where(F.col("__back") <= depth)
    # tails are depth rows per piece and group; a piece's halo are the last depth of them before its own first one
    along = Window.partitionBy(*keys).orderBy(PIECE, F.desc("__back"))
    tails = tails.withColumn("__nr", F.row_number().over(along))
    starts = tails.groupBy(*keys, PIECE).agg((F.min("__nr") - 1).alias("__upto")).where(F.col("__upto") > 0).select(
        *keys, F.col(PIECE).alias("__next"), "__upto", F.floor(F.col("__upto") / depth).alias("__slot"))
    slots = F.array_distinct(F.array(F.floor(F.col("__nr") / depth), F.floor((F.col("__nr") + (depth - 1)) / depth)))
    halo = tails.withColumn("__slot", F.explode(slots)).join(starts, [*keys, "__slot"]).where(
        (F.col("__nr") <= F.col("__upto")) & (F.col("__nr") > F.col("__upto") - depth))
    halo = halo.select(*[c for c in kept if c != PIECE], F.col("__next").alias(PIECE), F.lit(True).alias(HALO))
    return staged.withColumn(HALO, F.lit(False)).unionByName(halo, allowMissingColumns=True)
