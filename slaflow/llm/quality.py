"""Quality classifier from trusted positives and unlabelled web text.

Positive-unlabelled learning: negatives are never taken from labels.  The
risk of a scoring function is written with the positives and the unlabelled
texts alone, given the share of positives (the class prior), and the part
that stands for the negatives is kept from going below zero:

    prior * E_pos[loss(f)] + max(0, E_unl[loss(-f)] - prior * E_pos[loss(-f)])

The prior is estimated from the positives and the unlabelled texts too, by
the best bin: ids are dealt into five parts, and each part is scored by a
network that tells positives from unlabelled texts, fitted on the others.  The
share of unlabelled texts above a threshold is divided by the share of
positives above it; of all thresholds the one with the least upper bound is
taken (texts that score like the best positives are all positive).

The scoring function is a small network over surface statistics of a whole
text (character classes, word shapes, repeated words, line shapes).  They are
written once for all texts that may be learnt from; mean, deviation and the
unlabelled part of the risk are taken over all of them, whatever their label:
``max_unlabelled`` ids with the smallest hashes, one text each, are points,
and a point has the weight of all texts that are nearest to it.  Of the
positives at most ``max_positive`` are used, again with the smallest hashes.

Defined results: a null text is empty; an empty text has all statistics zero
and gets a score like any other; an id with several labels is positive only
if all say so; of an id with several texts, a sample has the one with the
smallest hash; a null id is never learnt from; without positives, or with
nothing else to learn from, every score is 0.5; the prior is 0.5 where all
positives or all texts are in one part; other columns aren't read.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from slaflow.llm.common import materialize, split_batch, string_buffers, text_or_empty, without
from slaflow.llm.words import words
from slaflow.operators.ordinal import scratch

MAX_POSITIVE = 6000
MAX_UNLABELLED = 12000
#: Of the ids, for the estimate of the prior.
PARTS = 5

_UPPER, _LOWER, _DIGIT, _SPACE, _NEWLINE, _HIGH, _END, _OTHER = range(8)
_CLASS = np.full(256, _OTHER, np.uint8)
for _c, _chars in (
    (_UPPER, range(0x41, 0x5B)), (_LOWER, range(0x61, 0x7B)), (_DIGIT, range(0x30, 0x3A)), (_SPACE, b" \t\r"),
    (_NEWLINE, b"\n"), (_HIGH, range(0x80, 0x100)), (_END, b".,;:'\"()-"),
):
    _CLASS[list(_chars)] = _c
N_FEATURES = 17


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[bounds]).astype(float)


def features(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text."""
    raw, bounds = string_buffers(column)
    n = len(bounds) - 1
    size = np.maximum(np.diff(bounds), 1).astype(float)
    kinds = _CLASS[raw]
    shares = [_per_text(kinds == k, bounds) / size for k in range(8)]
    other = kinds == _OTHER
    doubled = np.zeros(len(raw), bool)
    doubled[1:] = other[1:] & (raw[1:] == raw[:-1])
    h, starts, ends, at = words(raw, bounds)
    n_words = np.diff(at).astype(float)
    per_word = np.maximum(n_words, 1)
    same = np.zeros(len(h), bool)
    near = np.zeros(len(h), bool)
    same[1:] = h[1:] == h[:-1]
    near[2:] = h[2:] == h[:-2]
    first, second = at[:-1][n_words > 0], at[:-1][n_words > 1] + 1
    same[first], near[first], near[second] = False, False, False
    upper = (kinds == _UPPER) | (kinds == _HIGH)
    shouted = np.zeros(len(h), bool)
    if len(h):
        lower = np.concatenate([[0], np.cumsum(kinds == _LOWER)])
        caps = np.concatenate([[0], np.cumsum(upper)])
        shouted = (lower[ends] == lower[starts]) & (caps[ends] - caps[starts] > 1)
    lines = _per_text(kinds == _NEWLINE, bounds) + 1
    columns = [
        *shares,
        _per_text(doubled, bounds) / size,
        _per_text(same, at) / per_word,
        _per_text(near, at) / per_word,
        _per_text(shouted, at) / per_word,
        _per_text(ends - starts, at) / per_word / 10,
        np.log1p(n_words) / 10,
        np.log1p(size / lines) / 10,
        _per_text(other, bounds) / per_word,
        _per_text(other, bounds) / lines / 10,
    ]
    return np.stack(columns, 1) if n else np.zeros((0, N_FEATURES))


def _loss(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, -z)


def _slope(z: np.ndarray) -> np.ndarray:
    return -1 / (1 + np.exp(np.clip(z, -500, 500)))


def pu_risk(
    f_pos: np.ndarray, f_unl: np.ndarray, prior: float, weights: np.ndarray | None = None
) -> tuple[float, np.ndarray, np.ndarray]:
    """The non-negative unbiased risk under the logistic loss, and the
    gradient to follow at each score: that of the risk, or, while the part
    for the negatives is below zero, the one that raises that part."""
    part = np.full(len(f_unl), 1 / len(f_unl)) if weights is None else weights / weights.sum()
    positive = prior * _loss(f_pos).mean()
    negative = part @ _loss(-f_unl) - prior * _loss(-f_pos).mean()
    g_pos, g_unl = prior * _slope(f_pos) / len(f_pos), np.zeros(len(f_unl))
    neg_pos, neg_unl = prior * _slope(-f_pos) / len(f_pos), -_slope(-f_unl) * part
    if negative >= 0:
        return positive + negative, g_pos + neg_pos, neg_unl
    return positive, -neg_pos, -neg_unl


def versus_risk(
    f_pos: np.ndarray, f_unl: np.ndarray, prior: float, weights: np.ndarray
) -> tuple[float, np.ndarray, np.ndarray]:
    """The logistic loss of telling positives from unlabelled texts."""
    part = weights / weights.sum()
    risk = (_loss(f_pos).mean() + part @ _loss(-f_unl)) / 2
    return risk, _slope(f_pos) / len(f_pos) / 2, -_slope(-f_unl) * part / 2


class Model:
    """A network with one hidden layer over scaled statistics."""

    def __init__(self, prior: float, hidden: int = 24, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.prior, self.fitted = prior, False
        self.mean, self.scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
        self.w = [
            rng.normal(0, 1 / np.sqrt(N_FEATURES), (N_FEATURES, hidden)), np.zeros(hidden),
            rng.normal(0, 1 / np.sqrt(hidden), hidden), np.full(1, np.log(prior / (1 - prior))),
        ]

    def _forward(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hidden = np.tanh(x @ self.w[0] + self.w[1])
        return hidden, hidden @ self.w[2] + self.w[3]

    def fit(
        self, pos: np.ndarray, unl: np.ndarray, weights: np.ndarray | None = None, risk: Callable = pu_risk,
        epochs: int = 60, least_steps: int = 600, batch: int = 1024, seed: int = 7,
    ) -> Model:
        """Fit on statistics, under ``mean`` and ``scale`` as they are."""
        weights = np.ones(len(unl)) if weights is None else weights.astype(float)
        rng = np.random.default_rng(seed)
        pos, unl = self.scaled(pos), self.scaled(unl)
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        steps = max(1, len(unl) // batch)
        epochs = max(epochs, least_steps // steps)
        for epoch in range(epochs):
            rate = 0.01 * (1 - epoch / epochs)
            for p, u in zip(
                np.array_split(rng.permutation(len(pos)), steps), np.array_split(rng.permutation(len(unl)), steps)
            ):
                if not len(p) or not len(u):
                    continue
                hidden, f = self._forward(x := np.concatenate([pos[p], unl[u]]))
                _, g_pos, g_unl = risk(f[: len(p)], f[len(p) :], self.prior, weights[u])
                g = np.concatenate([g_pos, g_unl])
                back = np.outer(g, self.w[2]) * (1 - hidden**2)
                grads = [x.T @ back + 1e-4 * self.w[0], back.sum(0), hidden.T @ g + 1e-4 * self.w[2], g.sum(keepdims=True)]
                t += 1
                for k, d in enumerate(grads):
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v[k] = 0.999 * v[k] + 0.001 * d * d
                    self.w[k] = self.w[k] - rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
        self.fitted = True
        return self

    def scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self._forward(self.scaled(x))[1]

    def score(self, x: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(x), self.prior)
        return np.round(1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30))), 9)


def best_bin(s_pos: np.ndarray, s_unl: np.ndarray, weights: np.ndarray, delta: float = 0.1, gamma: float = 0.01) -> float:
    """The share of positives in the unlabelled part, from scores of both."""
    cuts = np.unique(s_pos)
    order = np.argsort(s_unl, kind="stable")
    above = np.concatenate([np.cumsum(weights[order][::-1])[::-1], [0]]) / weights.sum()
    q_unl = above[np.searchsorted(s_unl[order], cuts, side="left")]
    q_pos = 1 - np.searchsorted(np.sort(s_pos), cuts, side="left") / len(s_pos)
    slack = sum(math.sqrt(math.log(4 / delta) / 2 / len(s)) for s in (s_pos, s_unl))
    best = np.argmin((q_unl + (1 + gamma) * slack) / q_pos)
    return float(min(1.0, q_unl[best] / q_pos[best]))


def class_prior(
    pos: np.ndarray, unl: np.ndarray, weights: np.ndarray, pos_part: np.ndarray, unl_part: np.ndarray,
    mean: np.ndarray, scale: np.ndarray,
) -> float:
    """The class prior by the best bin over the scores of all parts, each
    scored by a network that is fitted on the others."""
    s_pos, s_unl, own_weights = [], [], []
    for part in range(PARTS):
        own_pos, own_unl = pos_part == part, unl_part == part
        if own_pos.all() or own_unl.all():
            continue
        teller = Model(0.5)
        teller.mean, teller.scale = mean, scale
        teller.fit(pos[~own_pos], unl[~own_unl], weights[~own_unl], versus_risk, epochs=1, least_steps=120)
        s_pos.append(teller.margin(pos[own_pos]))
        s_unl.append(teller.margin(unl[own_unl]))
        own_weights.append(weights[own_unl])
    if not sum(map(len, s_pos)) or not sum(w.sum() for w in own_weights):
        return 0.5
    found = best_bin(np.concatenate(s_pos), np.concatenate(s_unl), np.concatenate(own_weights))
    return float(np.clip(found, 0.01, 0.99))


def held_out(id_col: str | Column) -> Column:
    """Whether crc32 of the id as text has the remainder 1 by 3; a null id
    isn't held out."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(F.encode(c.cast("string"), "UTF-8")) % 3 == 1, F.lit(False))


def _statistics(rows: DataFrame) -> DataFrame:
    """(doc_id, key, x) of (doc_id, text): a hash and the statistics."""
    id_type = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole):
                x = features(batch.column(1))
                lists = pa.ListArray.from_arrays(np.arange(len(x) + 1, dtype=np.int32) * N_FEATURES, x.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).cast(to_arrow_type(id_type)), batch.column(2), lists], ["doc_id", "key", "x"]
                )

    hashed = rows.select("doc_id", "text", F.xxhash64("text").alias("key"))
    return hashed.mapInArrow(run, f"doc_id {id_type.simpleString()}, key long, x array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), float).reshape(-1, N_FEATURES)


def _sampled(stats: DataFrame) -> tuple[list, np.ndarray]:
    """A bounded number of ids and their statistics, one text each, in order
    of the ids."""
    rows = stats.groupBy("doc_id").agg(F.min(F.struct("key", "x")).alias("least")).select("doc_id", "least.x").collect()
    pairs = sorted((r["doc_id"], r["x"]) for r in rows)
    return [i for i, _ in pairs], np.array([x for _, x in pairs]).reshape(-1, N_FEATURES)


def _features_of(sample: DataFrame) -> np.ndarray:
    return _sampled(_statistics(sample))[1]


def _parts(ids: list) -> np.ndarray:
    return np.array([zlib.crc32(str(i).encode()) % PARTS for i in ids])


def _weights(stats: DataFrame, points: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """For each point the number of texts that are nearest to it (equally
    near: the first one)."""
    frame = Model(0.5)
    frame.mean, frame.scale = mean, scale
    own = frame.scaled(points)
    norms = (own * own).sum(1) / 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(own), np.int64)
        for batch in batches:
            x = frame.scaled(_matrix(batch.column(0)))
            for i in range(0, len(x), 256):
                counts += np.bincount(np.argmin(norms - x[i : i + 256] @ own.T, axis=1), minlength=len(own))
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(counts[used])], ["point", "n"])

    weights = np.zeros(len(own))
    for r in stats.select("x").mapInArrow(run, "point int, n long").groupBy("point").agg(F.sum("n").alias("n")).collect():
        weights[r["point"]] = r["n"]
    return weights


#: Statistics are summed as multiples of 1 / UNIT, so the sums don't depend on their order.
UNIT = 1 << 24


def _mean_and_scale(stats: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each statistic over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, squares = 0, [0] * N_FEATURES, [0] * N_FEATURES
        for batch in batches:
            x = np.rint(_matrix(batch.column(0)) * UNIT).astype(np.int64).astype(object)
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(0))]
            squares = [a + int(b) for a, b in zip(squares, (x * x).sum(0))]
        exact = lambda sums: pa.array(map(Decimal, sums), pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(N_FEATURES), pa.int32()), pa.array([n] * N_FEATURES, pa.int64()), exact(total), exact(squares)],
            ["k", "n", "total", "squares"],
        )

    parts = stats.select("x").mapInArrow(run, "k int, n long, total decimal(38,0), squares decimal(38,0)")
    mean, scale = np.zeros(N_FEATURES), np.ones(N_FEATURES)
    for r in parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in ("n", "total", "squares")]).collect():
        if n := r["n"]:
            total, squares = int(r["total"]), int(r["squares"])
            mean[r["k"]] = total / n / UNIT
            scale[r["k"]] = math.sqrt((n * squares - total * total) / (n * n)) / UNIT + 1e-6
    return mean, scale


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_positive: int = MAX_POSITIVE,
    max_unlabelled: int = MAX_UNLABELLED,
    may_learn: Callable[[str], Column] = lambda c: ~held_out(c),
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Model:
    """Fit on rows where ``may_learn`` holds, labelled or not; others aren't
    seen in training at all."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(text_col).alias("text")).where(
        F.col("doc_id").isNotNull() & may_learn("doc_id")
    )
    known = (
        labels.where(F.col(id_col).isNotNull() & may_learn(id_col) & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("doc_id")).agg(F.min(label_col).alias("label"))
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    positive = known.where(F.col("label") == 1).orderBy(*order).limit(max_positive).select("doc_id")
    unlabelled = rows.select("doc_id").distinct().orderBy(*order).limit(max_unlabelled)
    with scratch(docs.sparkSession):
        stats = materialize(_statistics(rows), "quality-statistics")
        # Both samples are bounded by their parameters, so their ids can be broadcast.
        pos_ids, pos = _sampled(stats.join(F.broadcast(positive), "doc_id", "left_semi"))
        unl_ids, unl = _sampled(stats.join(F.broadcast(unlabelled), "doc_id", "left_semi"))
        if not len(pos) or not len(unl):
            return Model(0.5)
        mean, scale = _mean_and_scale(stats)
        weights = _weights(stats, unl, mean, scale)
    model = Model(class_prior(pos, unl, weights, _parts(pos_ids), _parts(unl_ids), mean, scale))
    model.mean, model.scale = mean, scale
    return model.fit(pos, unl, weights)


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with a column ``score``; a column of that name is replaced."""
    own = without(docs, "score")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields) + ", score double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in split_batch(whole, text_col):
                s = model.score(features(batch.column(batch.schema.get_field_index(text_col))))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], names=[*batch.schema.names, "score"])

    return own.mapInArrow(run, schema)
