"""The fact by month of creation: one folder for each month.

Writing rows of some months replaces the folders of these months and no
other one (dynamic partition overwrite), so a month that is loaded late or
again costs its own rows alone.  Reading some months lists and scans their
folders only.

Rows are range-partitioned by month and row number before they are written: a
month that holds a third of all rows is spread over tasks, and no task writes
a file into every folder.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = "created_month"


def with_month(fact: DataFrame, date_key: str = "created_date_key") -> DataFrame:
    """``created_month`` as an int yyyyMM, from the yyyyMMdd key."""
    return fact.withColumn(MONTH, F.floor(F.col(date_key) / 100).cast("int"))


def write_months(fact: DataFrame, path: str, order: Sequence[str] = ("source_row",)) -> None:
    """Write all rows of the months that ``fact`` holds over what is there of
    these months."""
    rows = with_month(fact).repartitionByRange(MONTH, *order).sortWithinPartitions(MONTH, *order)
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path)


def read_months(spark: SparkSession, path: str, months: Sequence[int] | None = None) -> DataFrame:
    fact = spark.read.parquet(path)
    return fact if months is None else fact.where(F.col(MONTH).isin([int(m) for m in months]))


def monthly_sla(fact: DataFrame) -> DataFrame:
    """Requests, closed ones and those within their target by month."""
    return fact.groupBy(MONTH).agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(F.col("status") == "closed").alias("closed_requests"),
        F.count_if("sla_met").alias("sla_met_requests"),
        F.max("source_row").alias("last_row"),
    )
