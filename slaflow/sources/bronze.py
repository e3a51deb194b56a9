"""Bronze: source records as text plus ingestion metadata.

``source_row`` is the record ordinal + 1 (first data record = 2): that of the
distributed ordinal operator for the request source, the place in the files
for CSV.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from slaflow.contract import DEFAULT_INGESTED_AT
from slaflow.operators.ordinal import materialize
from slaflow.sources.csv_records import BROADCAST_SPLITS, CsvRecords, file_name, fixed_splits, read_records
from slaflow.sources.requests import REQUEST_COLUMNS, request_metadata, request_rows
from slaflow.sources.tables import require_columns

BRONZE_METADATA = ["source_file", "ingestion_batch_id", "ingested_at_utc"]

def bronze_columns(columns: Sequence[str] = REQUEST_COLUMNS) -> list[str]:
    return ["source_row", *columns, *BRONZE_METADATA]


def bronze_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze over the request source of ``sf_dir``, written once.  The narrow
    orders are numbered before the join and the text columns are made."""
    meta = request_metadata()
    rows = request_rows(spark, sf_dir, number="source_row")
    return materialize(
        rows.select(
            F.col("source_row").cast("long").alias("source_row"),
            *REQUEST_COLUMNS,
            *[F.lit(meta[c]).alias(c) for c in BRONZE_METADATA],
        ),
        "bronze",
    )


# --------------------------------------------------------------------------- CSV files


#: A binary row holds a file of less than 2 GiB.
MAX_BYTES = (1 << 31) - 1
#: Lines, and then digests, that make one digest of the tree.
FAN = 4096


def file_fingerprint(spark: SparkSession, path: str | list[str], method: str = "auto") -> str:
    """16-hex fingerprint of the input files:

    * ``bytes``: the SHA-256 of the file's bytes, or, of several files, that
      of their digests in order of their names.  Files are hashed whole, in
      the executors, so none may have 2 GiB or more.
    * ``tree``: files are hashed by lines, in splits: the SHA-256 of the
      digests of ``FAN`` lines in a row, then of ``FAN`` such digests, up to
      one for each file, with the file's length; then as above.
    * ``auto``: ``bytes``, or ``tree`` if a file is too large for it.

    Folders don't count, so moved files keep their fingerprint.  One row for
    each file reaches the driver.
    """
    if method not in ("auto", "bytes", "tree"):
        raise ValueError(f"no fingerprint method {method!r}")
    paths = path if isinstance(path, list) else [path]
    files = spark.read.format("binaryFile").load(paths)
    large = files.where(F.col("length") > MAX_BYTES).select("path").first()
    if large and method == "bytes":
        raise ValueError(f"{large['path']} is too large to be hashed whole; use method='tree'")
    name = F.regexp_extract("path", "[^/]*$", 0).alias("name")
    if method == "tree" or large:
        parts = _tree_digests(spark, paths).join(files.select(F.col("path").alias("file"), "length"), "file", "right")
        parts = parts.select(
            F.regexp_extract("file", "[^/]*$", 0).alias("name"),
            F.sha2(F.concat_ws(":", F.coalesce("d", F.lit("")), F.col("length")), 256).alias("d"),
        )
    else:
        parts = files.select(name, F.sha2("content", 256).alias("d"))
    found = sorted((r["name"], r["d"]) for r in parts.collect())
    if len(found) == 1:
        return found[0][1][:16]
    return hashlib.sha256("\n".join(f"{n}:{d}" for n, d in found).encode()).hexdigest()[:16]


def _tree_digests(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, d): the root of the tree of each file that has a line."""
    with fixed_splits(spark):
        lines = spark.read.text(paths, lineSep="\n").select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("id"), F.sha2("value", 256).alias("d"),
        )
        lines = materialize(lines, "line-digests")
    sizes = lines.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("id").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = materialize(sizes.select("file", "block", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset")), "line-offsets")
    n_splits = sizes.count()
    known = lines.join(F.broadcast(sizes) if n_splits <= BROADCAST_SPLITS else sizes, ["file", "block"])
    level = known.select("file", (F.col("offset") + F.col("id") - F.col("first")).alias("k"), "d")
    while True:
        rows = F.sort_array(F.collect_list(F.struct("k", "d")))
        level = level.groupBy("file", F.floor(F.col("k") / FAN).alias("k")).agg(
            F.sha2(F.array_join(F.transform(rows, lambda r: r["d"]), ""), 256).alias("d")
        )
        level = materialize(level, "tree-level")
        if not (level.agg(F.max("k").alias("k")).first()["k"] or 0):
            return level.select("file", "d")


def records_as_bronze(
    records: CsvRecords, batch: str, columns: Sequence[str] = REQUEST_COLUMNS, ingested_at: str = DEFAULT_INGESTED_AT, start: int = 2
) -> DataFrame:
    """Bronze of the whole records: fixed column subset and order, record
    number, file name, content fingerprint, ingestion timestamp."""
    require_columns(records.rows, columns, "Source data")
    return records.whole().select(
        (F.col("__place") + start).alias("source_row"),
        *[F.col(f"`{c}`") for c in columns],
        file_name(F.col("__file")).alias("source_file"),
        F.lit(batch).alias("ingestion_batch_id"),
        F.lit(ingested_at).alias("ingested_at_utc"),
    )


def bronze_from_csv(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = REQUEST_COLUMNS,
    ingested_at: str = DEFAULT_INGESTED_AT,
    fingerprint: str = "auto",
    start: int = 2,
) -> DataFrame:
    """Bronze from CSV text files; a malformed record is refused, naming its
    row."""
    records = read_records(spark, path)
    require_columns(records.rows, columns, "Source data")
    records.refuse_malformed(start)
    return records_as_bronze(records, file_fingerprint(spark, path, fingerprint), columns, ingested_at, start)


def bronze_and_malformed(
    spark: SparkSession,
    path: str | list[str],
    columns: Sequence[str] = REQUEST_COLUMNS,
    ingested_at: str = DEFAULT_INGESTED_AT,
    start: int = 2,
) -> tuple[DataFrame, DataFrame]:
    """Bronze of the whole records, and the malformed ones as
    (source_row, source_file, reason, record).  All rows keep their numbers."""
    records = read_records(spark, path)
    bronze = records_as_bronze(records, file_fingerprint(spark, path), columns, ingested_at, start)
    bad = records.malformed().select((F.col("place") + start).alias("source_row"), "source_file", "reason", "record")
    return bronze, bad
