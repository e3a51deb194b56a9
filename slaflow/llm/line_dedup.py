"""Line dedup: hashed lines are range-partitioned and sorted by document and
position; first occurrences are streamed and come back as one compressed
keep bitmap per document, never as text.

Only DataFrame functions are used.

* A line's key is the line without surrounding ASCII white space and with
  A-Z lower-cased.  Keys of at least ``min_chars`` code points that occur in
  at least ``min_docs`` documents are shared; their lines go, except all of
  them in the first document of the order, the one with the largest id.
* Hashes (128 bits) are range-partitioned, so a hash has all its lines in
  one sorted run.  Hashes with more than a thousandth of all lines (at most
  1,000, so they can be broadcast) are aggregated map-side instead; none of
  them meets in one task.
* A bitmap is a list of runs ``(first, length)`` of dropped lines; lines
  outside them are kept.  Documents without a dropped line have no bitmap.

Defined results: a null or empty text has one empty line; rows with a null
id keep all lines and don't count as documents; rows that share an id are
one document, and each keeps its own bitmap (the row's text hash is part of
the key); an empty table gives no rows; other columns aren't read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from slaflow.llm.common import ascii_lower, materialize, text_or_empty, without

#: ASCII white space: 0x20 and 0x09 to 0x0D.
BLANKS = " \t\n\x0b\x0c\r"
MAX_HOT = 1000
_RUNS = "array<struct<first:int,length:int>>"


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def row_key(text: Column) -> Column:
    """Tells rows with the same id but other texts apart."""
    return F.xxhash64(text)


def hashed_lines(docs: DataFrame, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """(hash, doc, row_key, pos) of every line long enough to be shared."""
    text = text_or_empty(text_col)
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc"),
        row_key(text).alias("row_key"),
        F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"),
    )
    stripped = lines.withColumn("line", F.btrim("line", F.lit(BLANKS))).where(F.char_length("line") >= min_chars)
    return stripped.select(F.unhex(F.md5(ascii_lower(F.col("line")))).alias("hash"), "doc", "row_key", "pos")


def keep_bitmaps(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc, row_key, drop_runs) of every document that loses lines."""
    seen = Observation("lines")
    found = hashed_lines(docs, min_chars, id_col, text_col).observe(seen, F.count(F.lit(1)).alias("n"))
    lines = materialize(found, "lines")
    n = seen.get.get("n") or 0
    # At most n / (n / 1000) = 1,000 hashes are that frequent.
    frequent = lines.groupBy("hash").count().where(F.col("count") > F.lit(max(MAX_HOT, n // MAX_HOT)))
    hot = F.broadcast(materialize(frequent.select("hash"), "hot-lines"))

    runs = lines.join(hot, "hash", "left_anti").repartitionByRange("hash")
    order = Window.partitionBy("hash").orderBy(F.col("doc").desc(), "pos")
    whole = Window.partitionBy("hash")
    streamed = (
        runs.withColumn("first", F.first("doc").over(order))
        .withColumn("new", (~F.col("doc").eqNullSafe(F.lag("doc").over(order))).cast("int"))
        .withColumn("n_docs", F.sum("new").over(whole))
        .where((F.col("n_docs") >= min_docs) & (F.col("doc") < F.col("first")))
    )
    hot_lines = lines.join(hot, "hash", "left_semi")
    hot_keys = (
        hot_lines.groupBy("hash", "doc").agg(F.lit(1).alias("one")).groupBy("hash")
        .agg(F.count("one").alias("n_docs"), F.max("doc").alias("first")).where(F.col("n_docs") >= min_docs)
    )
    hot_dropped = lines.join(F.broadcast(hot_keys), "hash").where(F.col("doc") < F.col("first"))
    dropped = streamed.select("doc", "row_key", "pos").unionByName(hot_dropped.select("doc", "row_key", "pos"))

    per_row = Window.partitionBy("doc", "row_key").orderBy("pos")
    return (
        dropped.groupBy("doc", "row_key", "pos").agg(F.lit(1).alias("one"))
        .repartition("doc", "row_key")
        .withColumn("run", F.col("pos") - F.row_number().over(per_row))
        .groupBy("doc", "row_key", "run")
        .agg(F.min("pos").alias("first"), F.count("one").cast("int").alias("length"))
        .groupBy("doc", "row_key")
        .agg(F.array_sort(F.collect_list(F.struct("first", "length"))).cast(_RUNS).alias("drop_runs"))
    )


def kept_lines(lines: Column, drop_runs: Column) -> Column:
    """The lines outside the dropped runs: one slice per gap."""
    n_runs = F.size(drop_runs)

    def gap(i: Column) -> Column:
        before = F.get(drop_runs, i - 1)
        first = F.when(i > 0, before["first"] + before["length"]).otherwise(0)
        end = F.when(i < n_runs, F.get(drop_runs, i)["first"]).otherwise(F.size(lines))
        return F.slice(lines, first + 1, end - first)

    return F.flatten(F.transform(F.sequence(F.lit(0), n_runs), gap))


def dedup_lines(
    docs: DataFrame, min_chars: int = 40, min_docs: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text`` added;
    columns of these names are replaced."""
    docs = without(docs, "n_lines", "n_dropped", "kept_text")
    bitmaps = keep_bitmaps(docs, min_chars, min_docs, id_col, text_col).select(
        F.col("doc").alias("__doc"), F.col("row_key").alias("__row"), F.col("drop_runs").alias("__runs")
    )
    text = text_or_empty(F.col(f"d.{text_col}"))
    joined = docs.alias("d").join(
        bitmaps, (F.col(f"d.{id_col}") == F.col("__doc")) & (row_key(text) == F.col("__row")), "left"
    )
    lines = F.split(text, "\n", -1)
    lost = F.aggregate("__runs", F.lit(0), lambda a, r: a + r["length"])
    return joined.select(
        "d.*",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(lost, F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__runs").isNull(), text)
        .otherwise(F.array_join(kept_lines(lines, F.col("__runs")), "\n"))
        .alias("kept_text"),
    )
