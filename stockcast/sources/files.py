"""CSV and parquet tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from stockcast.defaults import DATE, MONTH
from stockcast.operators.temporal import moment, month_number

# Spellings of a missing value in the input files.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

SCHEMAS = {
    "train": "Store int, Dept int, Date date, Weekly_Sales double, IsHoliday boolean",
    "features": "Store int, Date date, Temperature double, Fuel_Price double, MarkDown1 double, MarkDown2 double, "
                "MarkDown3 double, MarkDown4 double, MarkDown5 double, CPI double, Unemployment double, IsHoliday boolean",
    "stores": "Store int, Type string, Size int",
}


def read_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Header CSV with a declared schema; every NA spelling is NULL, other bad values raise.

    Columns are matched by name, so their order in the file does not matter.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    raw = spark.read.option("header", True).option("inferSchema", False).option("ignoreLeadingWhiteSpace", True).csv(path)

    def typed(field: T.StructField):
        text = F.col(f"`{field.name}`")
        return F.when(~text.isin(*NA_STRINGS), text).cast(field.dataType).alias(field.name)

    return raw.select(*[typed(f) for f in wanted.fields])


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The three input tables ``train.csv``, ``features.csv`` and ``stores.csv``."""
    return {name: read_csv(spark, f"{folder.rstrip('/')}/{name}.csv", schema) for name, schema in SCHEMAS.items()}


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a parquet table, optionally partitioned (for example by year)."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_by_month(df: DataFrame, path: str, date_col: str = DATE) -> None:
    """Write a dated table in partitions by month; the months that ``df`` has are replaced, others stay.

    Rows without a date have a partition of their own. The time split and the latest batch read only the months they need.
    """
    # rebalanced, so that small months are one file and large ones many
    dated = df.withColumn(MONTH, month_number(moment(df, date_col))).hint("rebalance", F.col(MONTH))
    dated.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)
