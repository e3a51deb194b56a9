"""Incremental Bronze landing with Structured Streaming.

New CSV drops in a folder are appended to a Bronze Parquet table, one
micro-batch at a time: all values as text, the fixed column subset, the
file name, a content fingerprint of the batch's files and a contiguous
``source_row`` continuing from the rows already landed.  The stream carries
file names; each batch reads its files by their header, so another column
order or extra columns do no harm and missing columns are refused.  Each
epoch writes its own ``batch_epoch=<id>`` folder in overwrite mode, so a
retried epoch (after a lost executor or driver restart) is idempotent, and
the number of its last row, so that later ones needn't scan the table.
Validation stays a batch job over the landed table (the uniqueness rule
needs all rows).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from slaflow.operators.ordinal import scratch
from slaflow.session import prepare_session
from slaflow.sources.bronze import bronze_from_csv
from slaflow.sources.requests import REQUEST_COLUMNS
from slaflow.sources.tables import read_if_present


def _last_rows(table_dir: str) -> str:
    return f"{table_dir.rstrip('/')}/_last_row"  # Spark's readers pass over names with an underscore


def _landed_rows(spark: SparkSession, table_dir: str, before_epoch: int) -> int:
    """Highest ``source_row`` landed by earlier epochs (1 when none), so a
    retried epoch numbers its rows exactly as the first attempt did."""
    landed = read_if_present(spark, _last_rows(table_dir))
    if landed is None:
        return 1
    row = landed.where(F.col("batch_epoch") < before_epoch).agg(F.max("last_row").alias("m")).first()
    return int(row["m"]) if row["m"] is not None else 1


def land_bronze_stream(
    spark: SparkSession,
    source_dir: str,
    table_dir: str,
    checkpoint_location: str,
    columns: Sequence[str] = REQUEST_COLUMNS,
    available_now: bool = True,
    max_files_per_trigger: int = 100,
) -> StreamingQuery:
    """Start the landing stream (``availableNow`` processes what is there and stops)."""
    prepare_session(spark)
    stream = (
        spark.readStream.format("binaryFile")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .schema("path string, modificationTime timestamp, length long, content binary")
        .load(source_dir)
        .select("path")
    )

    def land(batch: DataFrame, epoch_id: int) -> None:
        session = batch.sparkSession
        files = sorted(r["path"] for r in batch.select("path").distinct().collect())  # <= max_files_per_trigger
        if not files:
            return
        start = _landed_rows(session, table_dir, epoch_id) + 1
        folder = f"batch_epoch={epoch_id}"
        with scratch(session):
            # one folder per epoch, overwritten on retry: a re-run batch
            # replaces its own partial output instead of appending duplicates
            out = bronze_from_csv(session, files, columns, start=start)
            out.write.mode("overwrite").parquet(f"{table_dir.rstrip('/')}/{folder}")
            last = session.read.parquet(f"{table_dir.rstrip('/')}/{folder}").agg(
                F.coalesce(F.max("source_row"), F.lit(start - 1)).alias("last_row")
            )
            last.write.mode("overwrite").parquet(f"{_last_rows(table_dir)}/{folder}")

    writer = stream.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
