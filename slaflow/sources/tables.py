"""Parquet table scans and input gates (required columns, empty input)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy Parquet scan; projections and filters applied later are pushed
    into the scan by Catalyst."""
    return spark.read.parquet(table_path(sf_dir, name))


def require_columns(df: DataFrame, required: Iterable[str], what: str = "Source data") -> None:
    """Fail before any job runs when a required column is absent (no Spark job)."""
    present = set(df.columns)
    missing = [c for c in required if c not in present]
    if missing:
        raise ValueError(f"{what} is missing required columns: {', '.join(missing)}")


def require_rows(df: DataFrame, message: str) -> None:
    """Refuse an empty input; reads at most one row."""
    if df.isEmpty():
        raise ValueError(message)


def table_version(spark: SparkSession, sf_dir: str, names: Iterable[str]) -> str:
    """A fingerprint of the tables' files (names, sizes and times; contents
    aren't read): another one when a table has changed."""
    files = spark.read.format("binaryFile").load([table_path(sf_dir, n) for n in names])
    h = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count("path").alias("n"), F.sum("length").alias("size"), F.sum(h).alias("h")).first()
    return f"{row['n']}-{row['size']}-{row['h']}"


def read_if_present(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
