"""Target-distribution importance resampling over hashed word features.

A text's features are its runs of ``ngrams[0]`` to ``ngrams[1]`` consecutive
words (see ``words``), joined by one space, repeats counted; a feature falls
into the bucket CRC-32 of its UTF-8 bytes modulo ``n_buckets``.  A bucket's
gain is the floored thousandfold log ratio of its smoothed shares in the
target and in the documents; a document's weight is the floored mean of the
gains of its features, and its score adds Gumbel noise made from a digest of
seed and id, so that the highest scores are a draw without replacement in
proportion to exp(weight / 1000).

CRC-32 by position tables: apart from a constant for each length, the CRC of
a span is the exclusive or of a contribution of each byte, which depends on
the byte and its distance from the end alone.  Contributions of up to 64
distances are computed once; a batch looks up those of all its bytes at once
and folds each span with ``bitwise_xor.reduceat``.  Longer spans are cut into
blocks of 64 bytes from the end: the state before a block moves through it by
the contributions of its own four bytes.

Plan: one pass over the texts writes the buckets of each document (two bytes
a feature) under ``spark.checkpoint.dir``; counts are added up within tasks,
then by bucket (``n_buckets`` rows reach the driver); a second pass reads the
buckets and writes the narrow weights; ranks come from the distributed
ordinal of the narrow rows.

Defined results: a null or empty text has no feature and the weight 0.  Rows
without an id count in the documents' features, but have no score and aren't
drawn.  Rows that share an id are scored each by itself and share their
noise; equal scores go by id, then in the order of the rows.  Without
documents or target, the other's counts stand against the smoothing alone.
Other columns are left out.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slaflow.llm.common import bound_batches, materialize, split_batch, string_buffers
from slaflow.llm.words import LOWER_BYTE, words
from slaflow.operators.ordinal import with_ordinal

#: Distances from the end that have a table of contributions.
DEPTH = 64
#: Bytes folded at a time.
BLOCK = 1 << 19
_FULL = 0xFFFFFFFF


def _contributions() -> np.ndarray:
    """``[distance * 256 + byte]``: what a byte that many bytes before the end
    adds to a CRC without initial and final inversion."""
    one = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        one = np.where(one & 1, (one >> np.uint32(1)) ^ np.uint32(0xEDB88320), one >> np.uint32(1)).astype(np.uint32)
    rows = [one]
    for _ in range(DEPTH - 1):
        rows.append((rows[-1] >> np.uint32(8)) ^ one[rows[-1] & np.uint32(0xFF)])
    return np.concatenate(rows)


TABLE = _contributions()
#: What the inversions add for each length up to DEPTH.
LENGTH_CONSTANT = np.array([zlib.crc32(bytes(n)) for n in range(DEPTH + 1)], np.uint32)


def _fold(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Contributions of spans of 1 to DEPTH bytes, folded."""
    out = np.empty(len(starts), np.uint32)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(starts):
        base = ends[i] - lengths[i]
        j = max(int(np.searchsorted(ends, base + BLOCK, side="right")), i + 1)
        size, at = lengths[i:j], ends[i:j] - lengths[i:j] - base
        within = np.arange(int(ends[j - 1] - base)) - np.repeat(at, size)
        byte = raw[np.repeat(starts[i:j], size) + within]
        distance = np.repeat(size, size) - 1 - within
        out[i:j] = np.bitwise_xor.reduceat(TABLE[distance * 256 + byte], at)
        i = j
    return out


def _through(state: int, n: int = DEPTH) -> int:
    """A state of four bytes moved through ``n`` >= 4 zero bytes."""
    out = 0
    for j in range(4):
        out ^= int(TABLE[(n - 1 - j) * 256 + (state >> 8 * j & 0xFF)])
    return out


def crc32_spans(raw: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRC-32 of the spans of ``raw``, which may overlap."""
    out = np.zeros(len(starts), np.uint32)
    short = np.flatnonzero((lengths > 0) & (lengths <= DEPTH))
    out[short] = _fold(raw, starts[short], lengths[short]) ^ LENGTH_CONSTANT[lengths[short]]
    for k in np.flatnonzero(lengths > DEPTH):
        start, n = int(starts[k]), int(lengths[k])
        head = n % DEPTH or DEPTH
        cuts = np.concatenate([[start], np.arange(start + head, start + n, DEPTH)])
        parts = _fold(raw, cuts, np.diff(np.append(cuts, start + n)))
        state = int(parts[0]) ^ int(LENGTH_CONSTANT[head]) ^ _FULL
        for part in parts[1:]:
            state = _through(state) ^ int(part)
        out[k] = state ^ _FULL
    return out


def feature_buckets(
    raw: np.ndarray, bounds: np.ndarray, n_buckets: int, ngrams: tuple[int, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts laid end to end: the buckets of all their features text by
    text, the number of features and the number of words of each text."""
    _, starts, ends, word_bounds = words(raw, bounds)
    size = ends - starts
    n_words = np.diff(word_bounds)
    if not len(starts):
        return np.zeros(0, np.uint32), n_words, n_words
    # the words one after the other, each followed by a space
    at = np.cumsum(size + 1) - size - 1
    within = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    line = np.full(int(at[-1] + size[-1] + 1), 0x20, np.uint8)
    line[np.repeat(at, size) + within] = LOWER_BYTE[raw[np.repeat(starts, size) + within]]
    text_of = np.repeat(np.arange(len(n_words)), n_words)
    found, of = [], []
    for n in range(ngrams[0], ngrams[1] + 1):
        first = np.arange(len(starts) - n + 1)
        first = first[text_of[first] == text_of[first + n - 1]] if len(first) else first
        found.append(crc32_spans(line, at[first], at[first + n - 1] + size[first + n - 1] - at[first]) % np.uint32(n_buckets))
        of.append(text_of[first])
    buckets, owner = np.concatenate(found), np.concatenate(of)
    order = np.argsort(owner, kind="stable")
    return buckets[order], np.bincount(owner, minlength=len(n_words)), n_words


def _kind(n_buckets: int) -> type:
    return np.uint16 if n_buckets <= 1 << 16 else np.uint32


Batches = Iterator[pa.RecordBatch]


def _writer(n_buckets: int, ngrams: tuple[int, int]) -> Callable[[Batches], Batches]:
    """(doc_id, text) to (doc_id, n_words, n_features, buckets)."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for part in split_batch(batch):
                raw, bounds = string_buffers(part.column(1))
                buckets, n, n_words = feature_buckets(raw, bounds, n_buckets, ngrams)
                data, ends = buckets.astype(_kind(n_buckets)), np.cumsum(n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0), pa.array(n_words.astype(np.int64)), pa.array(n.astype(np.int64)),
                        pa.array([data[e - k : e].tobytes() for e, k in zip(ends, n)], pa.binary()),
                    ],
                    ["doc_id", "n_words", "n_features", "buckets"],
                )

    return run


def _counter(n_buckets: int) -> Callable[[Batches], Batches]:
    """Rows (bucket, n) of what a task holds, a row for each bucket at most."""

    def run(batches: Batches) -> Batches:
        counts = np.zeros(n_buckets, np.int64)
        for batch in batches:
            for value in batch.column(0):
                counts += np.bincount(np.frombuffer(value.as_buffer(), _kind(n_buckets)), minlength=n_buckets)
        there = np.flatnonzero(counts)
        if len(there):
            yield pa.RecordBatch.from_arrays([pa.array(there.astype(np.int32)), pa.array(counts[there])], ["bucket", "n"])

    return run


def _weigher(gains: np.ndarray, n_buckets: int) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        for batch in batches:
            n = np.asarray(batch.column(2))
            total = [
                int(gains[np.frombuffer(value.as_buffer(), _kind(n_buckets))].sum()) // k if k else 0
                for value, k in zip(batch.column(3), n.tolist())
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(2), pa.array(total, pa.int64())],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return run


def hashed_features(texts: DataFrame, n_buckets: int, ngrams: tuple[int, int], id_col: str, text_col: str) -> DataFrame:
    """(doc_id, n_words, n_features, buckets) of every row; buckets are
    little-endian numbers of two bytes (four beyond 65,536 buckets)."""
    if not (0 < n_buckets <= 1 << 32 and 0 < ngrams[0] <= ngrams[1]):
        raise ValueError("features need at least one bucket and runs of at least one word")
    bound_batches(texts.sparkSession)
    picked = texts.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["doc_id"].dataType.simpleString()
    return picked.mapInArrow(_writer(n_buckets, ngrams), f"doc_id {kind}, n_words long, n_features long, buckets binary")


def bucket_counts(features: DataFrame, n_buckets: int) -> np.ndarray:
    found = features.select("buckets").mapInArrow(_counter(n_buckets), "bucket int, n long")
    counts = np.zeros(n_buckets, np.int64)
    for r in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # n_buckets rows at most
        counts[r["bucket"]] = r["n"]
    return counts


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    n = len(source)
    above, below = float(source.sum() + n), float(target.sum() + n)
    return np.array(
        [math.floor(1000 * math.log(float(t + 1) * above / (float(s + 1) * below))) for s, t in zip(source.tolist(), target.tolist())],
        np.int64,
    )


def resample(
    docs: DataFrame,
    target: DataFrame,
    n_buckets: int = 10_000,
    ngrams: tuple[int, int] = (1, 1),
    seed: int = 2024,
    min_words: int = 20,
    percent: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_text_col: str = "text",
) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; ``rank``
    counts the drawn ones from 1, highest score first, and is null for the
    rest.  Drawn are floor(``percent`` N / 100) of the N documents with
    ``min_words`` words or more."""
    features = materialize(hashed_features(docs, n_buckets, ngrams, id_col, text_col), "features")
    aim = hashed_features(target.select(F.lit(None).cast("long").alias("id"), F.col(target_text_col).alias("text")), n_buckets, ngrams, "id", "text")
    gains = bucket_gains(bucket_counts(features, n_buckets), bucket_counts(aim, n_buckets))
    kind = features.schema["doc_id"].dataType.simpleString()
    weights = materialize(
        features.mapInArrow(_weigher(gains, n_buckets), f"doc_id {kind}, n_words long, n_features long, weight long"), "weights"
    )
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296)))
    scored = weights.withColumn("score", F.col("weight") + noise)
    fits = (F.col("n_words") >= min_words) & F.col("doc_id").isNotNull()
    drawn = weights.where(fits).count() * percent // 100
    keyed = scored.select(
        "doc_id", "n_features", "weight", "score", (~fits).alias("unfit"),
        F.monotonically_increasing_id().alias("row"),  # splits rows that are equal in all else between tasks
    )
    ranked = with_ordinal(keyed, ["unfit", F.col("score").desc(), "doc_id", "row"], name="place")
    rank = F.when(~F.col("unfit") & (F.col("place") <= drawn), F.col("place")).cast("long")
    return ranked.select("doc_id", "n_features", "weight", "score", rank.alias("rank"))
