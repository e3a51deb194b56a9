"""Is a written table in its published order?

A reader that relies on the order of the files (in order of their names) and
of the rows in each file needs every row to be no smaller than the one before
it.  The scan hands a task rows of a file one behind the other, so each is
compared with its predecessor where it is read, on the key columns alone, and
nothing is shuffled.  A task gives one row for each run of consecutive rows of
a file that it has met (of ``block_rows`` rows at most), with its first and
last key; the step from one run to the next is compared in the table of runs.
So a file of any size is spread over tasks.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_ROWS = 100_000

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module


def _after(a: Column, b: Column, descending: bool) -> Column:
    """Does ``a`` sort strictly behind ``b``?  Nulls come first, in descending
    order last, as in Spark."""
    if descending:
        return (a.isNull() & b.isNotNull()) | F.coalesce(a < b, F.lit(False))
    return (a.isNotNull() & b.isNull()) | F.coalesce(a > b, F.lit(False))


def misplaced(before: Column, row: Column, order: Sequence[str]) -> Column:
    """Is a row (a struct ``k0``, ``k1``, ... of its keys) smaller than the one
    before it?  ``order`` names columns, a leading minus for descending."""
    found, equal = F.lit(False), F.lit(True)
    for i, name in enumerate(order):
        a, b = before[f"k{i}"], row[f"k{i}"]
        found |= equal & _after(a, b, name[0] == "-")
        equal &= a.eqNullSafe(b)
    return found


def _tied(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Equal keys, as in Spark: nulls are equal, and so are NaNs."""
    same = pc.equal(a, b).fill_null(False).to_numpy(zero_copy_only=False)
    same |= (pc.is_null(a).to_numpy(zero_copy_only=False)) & pc.is_null(b).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(a.type):
        nan = [pc.is_nan(x).fill_null(False).to_numpy(zero_copy_only=False) for x in (a, b)]
        same |= nan[0] & nan[1]
    return same


def _behind(a: pa.Array, b: pa.Array, descending: bool) -> np.ndarray:
    """``_after`` for arrays: nulls come first (descending: last), NaN is the
    largest number."""
    null = [pc.is_null(x).to_numpy(zero_copy_only=False) for x in (a, b)]
    if descending:
        a, b = b, a
    more = pc.greater(a, b).fill_null(False).to_numpy(zero_copy_only=False)
    if pa.types.is_floating(a.type):
        nan = [pc.is_nan(x).fill_null(False).to_numpy(zero_copy_only=False) for x in (a, b)]
        more = (more & ~nan[1]) | (nan[0] & ~nan[1] & ~(null[0] | null[1]))
    return more | ((null[0] & ~null[1]) if descending else (~null[0] & null[1]))


def _runs(order: Sequence[str], block_rows: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Runs of rows (file, at, k0, k1, ...) that follow one another in a file:
    where each begins, its rows, those of them that are smaller than the one
    before, its first and its last key."""

    def shaped(found: list[tuple[pa.RecordBatch, pa.RecordBatch, int, int]]) -> pa.RecordBatch:
        ends = [pa.Table.from_batches([r[k] for r in found]).combine_chunks() for k in (0, 1)]
        columns = [[t.column(c).combine_chunks() for c in range(t.num_columns)] for t in ends]
        keys = [pa.StructArray.from_arrays(c[2:], names=[f"k{i}" for i in range(len(order))]) for c in columns]
        counts = [pa.array([r[k] for r in found], pa.int64()) for k in (2, 3)]
        return pa.RecordBatch.from_arrays([*columns[0][:2], *counts, *keys], ["file", "at", "n", "bad", "first", "last"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None  # of the run that is still open
        n = bad = 0
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch if last is None else pa.Table.from_batches([last, batch]).combine_chunks().to_batches()[0]
            a, b = rows.slice(0, rows.num_rows - 1), rows.slice(1)
            at = rows.column(1).to_numpy()
            follows = pc.equal(a.column(0), b.column(0)).to_numpy(zero_copy_only=False) & (at[1:] == at[:-1] + 1) & (at[1:] % block_rows != 0)
            smaller, tie = np.zeros(len(at) - 1, bool), np.ones(len(at) - 1, bool)
            for i, name in enumerate(order):
                smaller |= tie & _behind(a.column(i + 2), b.column(i + 2), name[0] == "-")
                tie &= _tied(a.column(i + 2), b.column(i + 2))
            smaller &= follows
            found = []
            begins = np.append(np.flatnonzero(~follows) + 1, len(at)).tolist()
            if last is None:
                first, n, bad = rows.slice(0, 1), 1, 0
            done = 1  # rows, from the first one of ``rows``, that are counted by now
            for begin in begins:
                n, bad = n + begin - done, bad + int(smaller[done - 1 : begin - 1].sum())
                if begin < len(at):
                    found.append((first, rows.slice(begin - 1, 1), n, bad))
                    first, n, bad = rows.slice(begin, 1), 1, 0
                    done = begin + 1
            last = rows.slice(len(at) - 1)
            if found:
                yield shaped(found)
        if last is not None:
            yield shaped([(first, last, n, bad)])

    return run


def audit_order(spark: SparkSession, path: str, order: Sequence[str], block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row (rows, files, misplaced_in_files, misplaced_between_files,
    first_file) for a Parquet table; the last names a file, the first by name,
    in which, or at whose start, a row is out of place."""
    keys = [F.col(f"`{c.lstrip('-')}`").alias(f"k{i}") for i, c in enumerate(order)]
    rows = spark.read.parquet(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"), *keys)
    key = ", ".join(f"k{i}: {t}" for i, (_, t) in enumerate(rows.dtypes[2:]))
    runs = rows.mapInArrow(_runs(order, block_rows), f"file string, at long, n long, bad long, first struct<{key}>, last struct<{key}>")
    by_place = Window.orderBy("file", "at")
    edges = runs.select(
        "*", F.lag("last").over(by_place).alias("before"), F.lag("file").over(by_place).alias("file_before")
    ).withColumn("edge", F.col("file_before").isNotNull() & misplaced(F.col("before"), F.col("first"), order))
    same_file = F.col("file") == F.col("file_before")
    return edges.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.count_distinct("file").alias("files"),
        (F.coalesce(F.sum("bad"), F.lit(0)) + F.count_if(F.col("edge") & same_file)).alias("misplaced_in_files"),
        F.count_if(F.col("edge") & ~same_file).alias("misplaced_between_files"),
        F.regexp_extract(F.min(F.when(F.col("edge") | (F.col("bad") > 0), F.col("file"))), "[^/]*$", 0).alias("first_file"),
    )
