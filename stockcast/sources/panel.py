"""A sales panel built from order tables: weekly sales, store-week features and stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

MONEY = "decimal(12,2)"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def week_of(col: str) -> Column:
    return F.date_trunc("week", F.col(col)).cast("date")


def sales_panel(
    spark: SparkSession, folder: str, store: str = "n_regionkey", dept: str = "p_type", money: str = "double"
) -> DataFrame:
    """Net weekly sales per store and department; returned items count negative."""
    price = F.col("l_extendedprice").cast(MONEY)
    net = F.when(F.col("l_returnflag") == "R", -price).otherwise(price)
    items = (
        table(spark, folder, "lineitem")
        .join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, folder, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    )
    weekly = items.groupBy(
        F.col(store).cast("int").alias("Store"), F.col(dept).alias("Dept"), week_of("l_shipdate").alias("Date")
    ).agg(F.sum(net).cast(money).alias("Weekly_Sales"))
    return weekly.withColumn("IsHoliday", F.month("Date") == 11)


def store_features(spark: SparkSession, folder: str) -> DataFrame:
    """Order totals and account balances per store and week."""
    priority, price, balance = F.col("o_orderpriority"), F.col("o_totalprice").cast(MONEY), F.col("c_acctbal").cast(MONEY)
    orders = (
        table(spark, folder, "orders")
        .join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    weekly = orders.groupBy(F.col("n_regionkey").cast("int").alias("Store"), week_of("o_orderdate").alias("Date")).agg(
        F.sum(F.when(priority.startswith("1-"), price)).cast("double").alias("MarkDown1"),
        F.sum(F.when(priority.startswith("2-"), price)).cast("double").alias("MarkDown2"),
        F.max(balance).cast("double").alias("CPI"),
        F.min(balance).cast("double").alias("Unemployment"),
    )
    return weekly.withColumn("IsHoliday", F.month("Date") == 12)


def store_dimension(spark: SparkSession, folder: str) -> DataFrame:
    """Region name and supplier count per store."""
    return (
        table(spark, folder, "region")
        .join(table(spark, folder, "nation"), F.col("n_regionkey") == F.col("r_regionkey"))
        .join(table(spark, folder, "supplier"), F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .groupBy(F.col("r_regionkey").cast("int").alias("Store"), F.col("r_name").alias("Type"))
        .agg(F.count("s_suppkey").alias("Size"))
    )


def panel_tables(spark: SparkSession, folder: str) -> Sequence[DataFrame]:
    return sales_panel(spark, folder), store_features(spark, folder), store_dimension(spark, folder)
