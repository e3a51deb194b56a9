"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.operators.ordinal import materialize
from slaflow.session import ensure_checkpoint_dir

__all__ = ["documents", "join_weighted", "materialize", "shared_path", "split_batch", "string_buffers", "table", "text_or_empty", "utf8_bytes", "without"]

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: What a Python worker gets at a time; a worker's memory is a small multiple.
BATCH_ROWS, BATCH_BYTES = "2000", str(8 << 20)


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches that go to Python workers by rows and bytes."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder of ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/slaflow-{name}-{uuid.uuid4().hex}"


def text_or_empty(column: str | Column = "text") -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c, F.lit(""))


def utf8_bytes(column: Column) -> Column:
    """UTF-8 length of a text as a long; a null text has none."""
    return F.coalesce(F.octet_length(column), F.lit(0)).cast("long")


def ascii_lower(column: Column) -> Column:
    """A-Z lower-cased, every other code point unchanged.  ``lower`` does
    just that for ASCII texts and is much faster than ``translate``."""
    ascii_only = F.octet_length(column) == F.char_length(column)
    return F.when(ascii_only, F.lower(column)).otherwise(F.translate(column, UPPER, UPPER.lower()))


#: A key with at least this share of all rows is joined by broadcast; there
#: are at most as many such keys.
HEAVY_SHARE = 1000


def join_weighted(rows: DataFrame, table: DataFrame, key: str, weight: str = "n") -> DataFrame:
    """``rows`` (written) joined to a table with one row for each key, whose
    ``weight`` is the number of rows that hold the key.  Heavy keys, at most
    a thousand, are broadcast; in the shuffle of the others none is heavy."""
    total = table.agg(F.coalesce(F.sum(weight), F.lit(0)).alias("n")).first()["n"]
    heavy = F.col(weight) * HEAVY_SHARE >= total
    few = F.broadcast(table.where(heavy).drop(weight))
    rest = rows.join(few.select(key), key, "left_anti").join(table.where(~heavy).drop(weight), key)
    return rows.join(few, key).unionByName(rest)


def without(df: DataFrame, *names: str) -> DataFrame:
    """The frame without the columns of these names, in whatever case."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in gone])


def string_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column (null: empty) and the n + 1 offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64, n + 1, column.offset * 8) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def split_batch(batch: pa.RecordBatch, column: str = "text", limit: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of whole rows with about ``limit`` bytes of text each (one row
    at least), so that array work on a slice needs bounded memory."""
    if not batch.num_rows:
        return
    _, bounds = string_buffers(batch.column(batch.schema.get_field_index(column)))
    i, n = 0, batch.num_rows
    while i < n:
        j = int(np.searchsorted(bounds, bounds[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield batch.slice(i, j - i)
        i = j
