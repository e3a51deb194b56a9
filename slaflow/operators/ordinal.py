"""Distributed, contiguous ordinals (1..n in a given order) without a
single-partition window.

``row_number().over(Window.orderBy(k))`` moves every row into one task.
Here the rows are range-partitioned on the order columns (balanced by
sampling, so a hot value spreads over several partitions), each row gets
its partition id and position inside the sorted partition, and the
result is materialised so both are frozen.  The per-partition row counts
(one row per partition, so bounded by the partition count) are turned
into offsets and broadcast back.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.session import ensure_checkpoint_dir

_PART = "__part"
_POS = "__pos"
_OFFSET = "__offset"


#: Snapshots written since each of the open ``scratch`` blocks began.
_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Snapshots that are written in the block are deleted at its end; what
    is to outlive it must be written elsewhere in it."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        paths = _SCRATCH.pop()
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        for text in paths:
            path = jvm.org.apache.hadoop.fs.Path(text)
            path.getFileSystem(conf).delete(path, True)


def materialize(df: DataFrame, name: str = "layer") -> DataFrame:
    """Cut lineage: write the frame as Parquet under the session's checkpoint
    directory (the shared folder named by ``spark.checkpoint.dir``) and read
    it back.  Unlike an RDD checkpoint the copy is columnar, so later scans
    prune columns and push filters; a lost executor re-reads the files
    instead of recomputing the lineage."""
    base = ensure_checkpoint_dir(df.sparkSession).rstrip("/")
    path = f"{base}/slaflow-{name}-{uuid.uuid4().hex}"
    for paths in _SCRATCH[-1:]:
        paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_ordinal(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str = "ordinal",
    start: int = 1,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``name`` = start + rank of the row in ``order_by`` (ties broken
    arbitrarily but once: the numbering is materialised)."""
    cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    ranged = ranged.sortWithinPartitions(*cols)
    part = F.spark_partition_id()
    ranged = ranged.withColumn(_PART, part).withColumn(
        _POS, F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)
    )
    frozen = materialize(ranged, f"ordinal-{name}")
    # One row per partition (bounded by the partition count, not the data):
    # counted once, turned into offsets on the driver and broadcast back as a
    # local relation, so later reads of the numbered frame run no extra job.
    sizes = sorted((r[_PART], r["__rows"]) for r in frozen.groupBy(_PART).agg(F.count(F.lit(1)).alias("__rows")).collect())
    running, rows = 0, []
    for part, n in sizes:
        rows.append((part, running))
        running += n
    offsets = df.sparkSession.createDataFrame(rows, f"{_PART} int, {_OFFSET} long")
    return (
        frozen.join(F.broadcast(offsets), _PART)
        .withColumn(name, F.col(_OFFSET) + F.col(_POS) + F.lit(start))
        .drop(_PART, _POS, _OFFSET)
    )
