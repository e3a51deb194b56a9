"""Vector code compression: product codes trained by active-entry Lloyd rounds.

Every component becomes the integer floor(``scale`` x); a vector is cut into
``parts`` equal consecutive parts, and each part position has a codebook that
starts as that part of the first vectors in order of their ids.  A round
assigns each part to the nearest entry of its codebook (squared Euclidean
distance, ties to the lower index) and replaces each entry by the floored
mean of its parts; entries without parts stay.

After the first full scan, a part remembers its entry and the exact distance
to it.  If that entry has not moved in the last round, all other entries that
have not moved either still lose against it, so the part is compared with the
moved entries alone, against the stored distance: a moved entry wins with a
smaller distance, or with an equal one and a lower index.  A part whose entry
has moved scans the whole codebook again.  All distances are integers, so the
codes are those of full scans.

One pass over the rows assigns and writes the state (integers, codes and
distances) under ``spark.checkpoint.dir``; a second one adds up the parts of
each entry, first in every task, then by (part, entry, position).  Codebooks
(entries x dimension integers, whatever the number of rows) are all that
passes through the driver.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped.  The dimension is that of the first row, by id (null
ids last, then by the vector), whose length is a positive multiple of
``parts``.  Rows of another length, or with an integer beyond 2^24 in size,
can't be coded: they come back with null code and error and count nowhere.
With fewer rows than entries, each row is an entry.  Rows that share an id
are coded each by itself.  ``label_error`` is null where no row of the label
is coded or the sum exceeds a long.  An empty table stays empty.  Other
columns are left out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slaflow.llm.common import bound_batches, materialize

#: Integers up to this size keep every sum of squares exact in 64 bits.
LARGEST = 1 << 24
#: A label with at least this share of the rows is joined by broadcast: there
#: are at most as many such labels.
HEAVY_SHARE = 1000

Arrays = tuple[np.ndarray, np.ndarray]


@dataclass
class Codebooks:
    """``entries[part, entry, position]``; ``moved`` marks the entries that
    the last round changed."""

    entries: np.ndarray
    moved: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.reshape(-1).tolist())).encode()).hexdigest()


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to those of ``b``."""
    largest = max(int(np.abs(a).max(initial=0)), int(np.abs(b).max(initial=0)))
    if 4 * largest * largest * max(a.shape[1], 1) < 1 << 53:  # doubles hold all of it exactly
        product = (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    else:
        product = a @ b.T
    return (a * a).sum(1)[:, None] - 2 * product + (b * b).sum(1)[None, :]


def _nearest(a: np.ndarray, b: np.ndarray) -> Arrays:
    """Index of the nearest row of ``b``, the lowest of equals, and its distance."""
    d = _distances(a, b)
    at = d.argmin(1)
    return at, d[np.arange(len(a)), at]


def assign_all(parts: np.ndarray, books: Codebooks) -> Arrays:
    """Codes and distances of all parts (rows x parts x width) by full scans."""
    found = [_nearest(parts[:, p], books.entries[p]) for p in range(parts.shape[1])]
    return np.stack([c for c, _ in found], 1).astype(np.uint8), np.stack([d for _, d in found], 1)


def assign_active(parts: np.ndarray, books: Codebooks, codes: np.ndarray, distances: np.ndarray) -> Arrays:
    """The same from the former codes and distances: parts whose entry stayed
    fixed look at moved entries alone."""
    codes, distances = codes.copy(), distances.copy()
    for p in range(parts.shape[1]):
        moved = np.flatnonzero(books.moved[p])
        if not len(moved):
            continue
        again = books.moved[p][codes[:, p]]
        fixed, rest = np.flatnonzero(~again), np.flatnonzero(again)
        if len(fixed):
            at, d = _nearest(parts[fixed, p], books.entries[p][moved])
            old = distances[fixed, p]
            wins = (d < old) | ((d == old) & (moved[at] < codes[fixed, p]))
            codes[fixed[wins], p] = moved[at[wins]]
            distances[fixed[wins], p] = d[wins]
        if len(rest):
            codes[rest, p], distances[rest, p] = _nearest(parts[rest, p], books.entries[p])
    return codes, distances


def _rows_of(column: pa.Array, width: int, dtype: type) -> np.ndarray:
    """A list column without nulls, all of one length, as an array."""
    return np.asarray(column.flatten(), dtype).reshape(len(column), width)


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(values.reshape(-1), kind))


def _assigner(books: Codebooks, first: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n_parts, _, width = books.entries.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = _rows_of(batch.column(2), n_parts * width, np.int64)
            parts = whole.reshape(-1, n_parts, width)
            if first:
                codes, distances = assign_all(parts, books)
            else:
                raw = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(-1, n_parts)
                codes, distances = assign_active(parts, books, raw, _rows_of(batch.column(4), n_parts, np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), batch.column(2),
                    pa.array([c.tobytes() for c in codes], pa.binary()), _lists(distances, pa.int64()),
                ],
                ["vec_id", "label", "ints", "code", "distances"],
            )

    return run


def _adder(shape: tuple[int, int, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    n_parts, entries, width = shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(shape, np.int64), np.zeros((n_parts, entries), np.int64)
        for batch in batches:
            parts = _rows_of(batch.column(0), n_parts * width, np.int64).reshape(-1, n_parts, width)
            codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, n_parts)
            for p in range(n_parts):
                np.add.at(sums[p], codes[:, p], parts[:, p])
                counts[p] += np.bincount(codes[:, p], minlength=entries)
        p, e = np.nonzero(counts)
        if len(p):
            repeat = lambda x: np.repeat(x, width).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(repeat(p)), pa.array(repeat(e)), pa.array(np.tile(np.arange(width, dtype=np.int32), len(p))),
                    pa.array(np.repeat(counts[p, e], width)), pa.array(sums[p, e].reshape(-1)),
                ],
                ["part", "entry", "position", "n", "total"],
            )

    return run


def _update(state: DataFrame, books: Codebooks) -> Codebooks:
    """Entries replaced by the floored means of their parts."""
    added = state.select("ints", "code").mapInArrow(
        _adder(books.entries.shape), "part int, entry int, position int, n long, total long"
    )
    means = added.groupBy("part", "entry", "position").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect()
    entries = books.entries.copy()
    for r in means:  # at most entries x dimension rows
        entries[r["part"], r["entry"], r["position"]] = r["total"] // r["n"]
    return Codebooks(entries, (entries != books.entries).any(2))


def _kept(vector: Column) -> Column:
    """True for vectors without null and non-finite components (NaN is the
    largest double)."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    return vector.isNotNull() & finite


def with_label_error(coded: DataFrame) -> DataFrame:
    """The rows of a written table with the error summed over their label.
    Labels with a thousandth of the rows or more, of which there are at most
    a thousand, are joined by broadcast, the rest by a shuffle, in which no
    label is heavy."""
    sums = materialize(
        coded.groupBy(F.col("label").alias("of")).agg(
            F.sum(F.col("error").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
        ),
        "label-errors",
    )
    n = sums.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).first()["n"]
    total = F.expr("try_cast(s AS long)").alias("label_error")
    is_heavy = F.col("n") * HEAVY_SHARE >= n
    heavy = F.broadcast(sums.where(is_heavy).select("of", total))
    light = sums.where(~is_heavy).select("of", total)
    same = F.col("label").eqNullSafe(F.col("of"))
    rest = coded.join(heavy.select("of"), same, "left_anti")
    return coded.join(heavy, same).drop("of").unionByName(rest.join(light, same).drop("of"))


def compress(
    vectors: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> tuple[DataFrame, Codebooks | None]:
    """Rows (vec_id, label, code, error) of all vectors that are not dropped,
    as a written table, and the codebooks (None where no vector can be
    coded).  ``code`` holds a byte for each part, ``error`` the sum of the
    final squared distances."""
    if not (0 < entries <= 256 and parts > 0):
        raise ValueError("a code has a byte for each part: 1 to 256 entries")
    bound_batches(vectors.sparkSession)
    kept = vectors.where(_kept(F.col(vector_col))).select(
        F.col(id_col).alias("vec_id"),
        F.col(label_col).alias("label"),
        F.transform(vector_col, lambda x: F.floor(x.cast("double") * scale)).alias("ints"),
    )
    size = F.size("ints")
    in_range = F.forall("ints", lambda x: x.between(-LARGEST, LARGEST)) & (size > 0) & (size % parts == 0)
    order = [F.col("vec_id").asc_nulls_last(), F.col("ints")]
    found = kept.where(in_range).orderBy(*order).select(size.alias("size")).limit(1).collect()
    if not found:
        none = kept.select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return materialize(none, "vector-codes"), None
    codable = in_range & (size == found[0]["size"])
    head = kept.where(codable).orderBy(*order).limit(entries).select("ints").collect()
    width = found[0]["size"] // parts
    start = np.array([r["ints"] for r in head], np.int64).reshape(len(head), parts, width).transpose(1, 0, 2)
    books = Codebooks(np.ascontiguousarray(start), np.ones((parts, len(head)), bool))

    types = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"vec_id {types['vec_id']}, label {types['label']}, ints array<bigint>, code binary, distances array<bigint>"
    state = materialize(kept.where(codable).mapInArrow(_assigner(books, True), schema), "vector-state")
    for _ in range(rounds):
        books = _update(state, books)
        state = materialize(state.mapInArrow(_assigner(books, False), schema), "vector-state")
    total = F.aggregate("distances", F.lit(0).cast("long"), lambda a, b: a + b)
    coded = state.select("vec_id", "label", "code", total.alias("error"))
    other = kept.where(~codable).select("vec_id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
    return materialize(coded.unionByName(other), "vector-codes"), books
