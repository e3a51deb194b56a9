"""Queries over files: tables are written as text files and read back by the
library's own readers, so every value passes them."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.session import ensure_checkpoint_dir, prepare_session
from slaflow.sources.csv_records import CSV_SINK, CsvRecords, read_records
from slaflow.sources.tables import read_table

#: Small enough that the smallest tables are cut too.  Larger ones are cut into
#: ``SPLITS`` splits of up to ``MAX_SPLIT_BYTES``, so tasks don't get many.
SPLIT_BYTES, MAX_SPLIT_BYTES = 256 << 10, 32 << 20
SPLITS = 256


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/slaflow-{name}-{uuid.uuid4().hex}"


def split_bytes(size: int) -> int:
    """Bytes of a split of files of ``size`` bytes."""
    return min(max(size // SPLITS, SPLIT_BYTES), MAX_SPLIT_BYTES)


def _read_in_splits(spark: SparkSession, folder: str) -> CsvRecords:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    return read_records(spark, folder, split_bytes(size))


def csv_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, written as quoted CSV (line breaks stay inside the
    quotes) and read back in many splits."""
    prepare_session(spark)
    documents = read_table(spark, sf_dir, "documents")
    folder = _folder(spark, "csv")
    documents.select([F.col(c).cast("string") for c in documents.columns]).write.options(**CSV_SINK, quoteAll=True).csv(folder)
    records = _read_in_splits(spark, folder)
    records.refuse_malformed()
    return records.whole().select(records.names)


def csv_malformed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents written as lines without quotes, the way a careless
    export does: each comma of a text makes a field too many.  Every record is
    either whole or named with its reason."""
    prepare_session(spark)
    text = F.translate(F.coalesce("text", F.lit("")), '"\n\r', "'  ")
    lines = read_table(spark, sf_dir, "documents").select(F.concat_ws(",", F.col("doc_id").cast("string"), text).alias("doc_id,text"))
    folder = _folder(spark, "csv")
    lines.write.options(**{**CSV_SINK, "sep": "\x01"}).csv(folder)
    records = _read_in_splits(spark, folder)
    return records.rows.select(
        F.when(F.col("__malformed").isNull(), F.col("doc_id")).otherwise(F.substring_index("__record", ",", 1)).cast("long").alias("doc_id"),
        F.col("__malformed").alias("reason"),
        F.coalesce(F.octet_length("__record"), F.octet_length(F.concat_ws(",", "doc_id", "text"))).cast("long").alias("record_bytes"),
    )
