"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch holds every distinct shingle hash below a fixed fraction of the
hash range, so it grows with its text, sketches of parts merge into that of
the whole, and the containment of a short text in a very long one can be
estimated.  A text too short to have ``FLOOR`` such hashes, some 130 words,
holds its ``FLOOR`` smallest instead (all of them if it has no more), so the
shortest are exact.

Two sketches are compared below the smaller of their thresholds: the fixed
one, the largest hash of a filled-up sketch, or none for a complete one.

Defined results: a null text is empty; a text of one to four words has one
shingle; a text without words has the empty sketch, which is like another
empty one (1.0) and unlike any other (0.0).  Sketches depend on the text
alone.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from slaflow.llm.common import split_batch, string_buffers, text_or_empty
from slaflow.llm.words import shingles, words

HASH_BITS = 48
FRACTION = 4
THRESHOLD = (1 << HASH_BITS) // FRACTION
FLOOR = 32
WORDS = 5


def sketches(column: pa.Array) -> list[np.ndarray]:
    """The sorted sketch of each text."""
    h, _, _, bounds = words(*string_buffers(column))
    sh, at = shingles(h, bounds, WORDS)
    sh = sh >> np.uint64(64 - HASH_BITS)
    low = sh < np.uint64(THRESHOLD)
    low_at = np.concatenate([[0], np.cumsum(low)])[at]
    kept = sh[low]
    out = []
    for i in range(len(at) - 1):
        s = np.unique(kept[low_at[i] : low_at[i + 1]])
        if len(s) < FLOOR:
            s = np.unique(sh[at[i] : at[i + 1]])[:FLOOR]
        out.append(s)
    return out


def threshold(sketch: np.ndarray) -> int:
    """Below this, the sketch holds every hash of its text."""
    if len(sketch) < FLOOR:
        return 1 << HASH_BITS
    return max(THRESHOLD, int(sketch[-1]) + 1)


def by_threshold(sketch: np.ndarray) -> bool:
    """Whether the fixed fraction alone has made the sketch."""
    return len(sketch) >= FLOOR and int(sketch[-1]) < THRESHOLD


def _common(a: np.ndarray, b: np.ndarray) -> tuple[int, int, int]:
    t = np.uint64(min(threshold(a), threshold(b)))
    a, b = a[: np.searchsorted(a, t)], b[: np.searchsorted(b, t)]
    return len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated Jaccard similarity of two texts."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both, n, m = _common(a, b)
    return both / (n + m - both) if n + m else 0.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """The estimated share of a's shingles that b has."""
    if not len(a):
        return 1.0
    both, n, _ = _common(a, b)
    return both / n if n else 0.0


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sketch of the union of two sets of shingles."""
    t = np.uint64(min(threshold(a), threshold(b)))
    both = np.union1d(a, b)
    low = both[both < np.uint64(THRESHOLD)]
    if len(low) >= FLOOR:
        return low
    return both[both < t][:FLOOR]


def pack(sketch: np.ndarray) -> str:
    """Eight characters a hash, in ascending order."""
    raw = sketch.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:]
    return base64.b64encode(raw.tobytes()).decode()


def unpack(text: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(text), np.uint8).reshape(-1, 6)
    wide = np.zeros((len(raw), 8), np.uint8)
    wide[:, 2:] = raw
    return wide.view(">u8").reshape(-1).astype(np.uint64)


def fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    picked = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                packed = pa.array([pack(s) for s in sketches(batch.column(1))], pa.string())
                yield pa.RecordBatch.from_arrays([batch.column(0), packed], ["doc_id", "fingerprint"])

    id_type = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"doc_id {id_type}, fingerprint string")


def with_next(
    docs: DataFrame, rows_per_range: int = 2000, max_ranges: int = 20_000, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows in ranges of ascending numeric id (a null one comes first;
    ties in order of a hash of the text), sorted in their partition, with the
    first row of the next range repeated behind each (that of the first range
    behind the last): (range, tail, doc_id, text).  So every row has its
    successor behind it, the tails aside, and no task holds the whole order.
    An id that many rows share, or null, gets several ranges, cut by the hash
    of the text.  The driver gets the cuts, at most ``max_ranges`` ids."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("with_id")).first()
    n_ranges = max(1, min(max_ranges, size["with_id"] // rows_per_range))
    for_null = max(1, min(max_ranges, (size["n"] - size["with_id"]) // rows_per_range))
    shares = [k / n_ranges for k in range(1, n_ranges)] or [0.5]
    # an id that comes out as many cuts holds as many ranges
    cuts, hot = np.unique(rows.agg(F.percentile_approx("doc_id", shares, 100_000)).first()[0] or [0], return_counts=True)
    own = np.where(hot > 1, hot, 0)
    # ranges before each cut: those of null ids, one between two cuts, those of hot ids
    before = for_null + np.arange(1, len(cuts) + 1) + np.cumsum(own) - own

    @F.pandas_udf("int")
    def range_of(ids: pd.Series, ties: pd.Series) -> pd.Series:
        null = ids.isna().to_numpy()
        values = ids.fillna(cuts[0]).to_numpy()
        share = (ties.to_numpy().astype(np.float64) + 2.0**63) / 2.0**64
        within = lambda n: np.minimum((share * n).astype(np.int64), np.maximum(n - 1, 0))
        at = np.searchsorted(cuts, values, side="right") - 1
        cut = np.maximum(at, 0)
        behind = np.where(at < 0, for_null, before[cut] + own[cut])  # a range between two cuts
        on = ~null & (at >= 0) & (cuts[cut] == values) & (own[cut] > 0)
        found = np.where(on, before[cut] + within(own[cut]), behind)
        return pd.Series(np.where(null, within(np.full(len(values), for_null)), found)).astype("int32")

    tie = F.xxhash64("text").alias("tie")
    ranged = rows.withColumn("range", range_of("doc_id", F.xxhash64("text")))
    firsts = (
        ranged.groupBy("range").agg(F.min(F.struct("doc_id", tie)).alias("first")).orderBy("range")
        .select("range", "first.doc_id", "first.tie").collect()
    )
    heads = spark.createDataFrame(
        [(r["doc_id"], r["tie"], firsts[k - 1]["range"]) for k, r in enumerate(firsts)],
        f"head_id {id_type}, head_tie long, before int",
    )
    is_head = F.col("doc_id").eqNullSafe(F.col("head_id")) & (F.xxhash64("text") == F.col("head_tie"))
    tails = rows.join(F.broadcast(heads), is_head).groupBy("before").agg(F.first(F.struct("doc_id", "text")).alias("row"))
    body = ranged.select("range", F.lit(False).alias("tail"), "doc_id", "text")
    both = body.unionByName(
        tails.select(F.col("before").alias("range"), F.lit(True).alias("tail"), "row.doc_id", "row.text")
    )
    return both.repartition("range").sortWithinPartitions("range", "tail", "doc_id", tie)


def edit(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many (or
    all) of the following text."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block: int = 1 << 20) -> DataFrame:
    """Of every row the fingerprints of its text and of the edited text, the
    likeness of its fingerprint to that one and to the next row's, the share
    of its shingles that the edited text contains, and whether its sketch is
    made by the threshold alone."""
    ordered = with_next(docs, id_col=id_col, text_col=text_col)
    id_type = ordered.schema["doc_id"].dataType

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        """Of rows that stand behind each other, all but the last."""
        pairs = [(k, rows[k], rows[k + 1]) for k in range(len(rows) - 1) if not rows[k][0]]
        edited = [edit(a[2], b[2]) for _, a, b in pairs]
        own = sketches(pa.array([r[2] for r in rows], pa.string()))
        changed = sketches(pa.array(edited, pa.string()))
        return pa.RecordBatch.from_arrays(
            [
                pa.array([a[1] for _, a, _ in pairs], to_arrow_type(id_type)),
                pa.array([len(a[2]) for _, a, _ in pairs], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
                pa.array([pack(own[k]) for k, _, _ in pairs], pa.string()),
                pa.array([pack(s) for s in changed], pa.string()),
                pa.array([likeness(own[k], s) for (k, _, _), s in zip(pairs, changed)], pa.float64()),
                pa.array([likeness(own[k], own[k + 1]) for k, _, _ in pairs], pa.float64()),
                pa.array([containment(own[k], s) for (k, _, _), s in zip(pairs, changed)], pa.float64()),
                pa.array([by_threshold(own[k]) for k, _, _ in pairs], pa.bool_()),
            ],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "contained", "by_threshold"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[2])
                if size >= block and len(held) > 1:
                    yield compare(held)
                    held = held[-1:]
                    size = len(held[0][2])
        if held:
            yield compare(held)

    return ordered.select("tail", "doc_id", "text").mapInArrow(
        run,
        f"doc_id {id_type.simpleString()}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double, contained double, by_threshold boolean",
    )
