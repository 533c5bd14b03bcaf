"""Connected components of a link table, by alternating stars over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from stockcast.session import write_stage


def _star(links: DataFrame, large: bool) -> DataFrame:
    """Connect neighbours to the smallest node around: the larger neighbours, or the smaller ones and the node itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    near = both if large else both.where(F.col("b") < F.col("a"))
    # written, so that both sides of the join are plain exchanges, which Spark splits where a node is hot
    least = write_stage(near.groupBy("a").agg(F.min("b").alias("m")), "least")
    least = least.withColumn("m", F.least("a", "m"))
    joined = near.join(least, "a")
    if large:
        out = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(
            least.select("a", F.col("m").alias("b")))
    return write_stage(out.where(F.col("a") != F.col("b")).distinct(), "star")


def roots(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (long columns a, b) but the roots: the smallest node reachable.

    Nodes without links are their own roots and not listed. Every half round is written to the shared
    folder, so lineage stays short and executors may be lost.
    """
    links = write_stage(links.where(F.col("a") != F.col("b")).select("a", "b").distinct(), "links")
    seen = None
    while True:
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == seen or now[0] == 0:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now
        links = _star(_star(links, large=True), large=False)
