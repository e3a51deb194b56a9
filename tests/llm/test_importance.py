import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from llm.conftest import load
from slaflow.llm import importance
from slaflow.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text, a=1, b=1):
    w = WORD.findall((text or "").translate(UPPER))
    return [" ".join(w[i : i + n]) for n in range(a, b + 1) for i in range(len(w) - n + 1)], len(w)


def brute(rows, target, n_buckets=10_000, ngrams=(1, 1), seed=2024, min_words=20, percent=10):
    """(doc_id, n_features, weight, score, rank) of each row, by plain Python."""
    bucket = lambda f: zlib.crc32(f.encode()) % n_buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t, *ngrams)[0])
    t = Counter(bucket(f) for x in target for f in features(x, *ngrams)[0])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda k: math.floor(1000 * math.log((t[k] + 1) * (big_s + n_buckets) / ((s[k] + 1) * (big_t + n_buckets))))
    out = []
    for i, text in rows:
        fs, n = features(text, *ngrams)
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, n >= min_words and i is not None])
    fit = sorted((r for r in out if r[5]), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(fit[: len(fit) * percent // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in out), key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("sizes", [range(1, 70), [63, 64, 65, 127, 128, 129, 1000, 70_001], [0, 5]])
def test_crc_equals_zlib(sizes):
    rng = np.random.default_rng(1)
    raw = rng.integers(0, 256, 200_000, dtype=np.uint8)
    starts = rng.integers(0, 100_000, len(list(sizes)))
    lengths = np.array(list(sizes))
    got = importance.crc32_spans(raw, starts, lengths)
    assert got.tolist() == [zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


def test_crc_folds_in_blocks(monkeypatch):
    monkeypatch.setattr(importance, "BLOCK", 100)
    raw = np.frombuffer(random.Random(2).randbytes(5000), np.uint8)
    starts = np.arange(0, 4900, 7)
    lengths = 1 + starts % 90
    assert importance.crc32_spans(raw, starts, lengths).tolist() == [zlib.crc32(raw[s : s + n].tobytes()) for s, n in zip(starts, lengths)]


@pytest.mark.parametrize(("ngrams", "n_buckets"), [((1, 1), 50), ((1, 3), 70_000), ((2, 2), 97)])
def test_against_brute_force(spark, make_docs, ngrams, n_buckets):
    rng = random.Random(n_buckets)
    pool = ["the", "Of", "and", "ÉTÉ", "x" * 70, "y" * 200, "naïve", "zürich", "42", "cat"]
    rows = [(i, ", ".join(rng.choice(pool) for _ in range(rng.randint(0, 60)))) for i in range(150)]
    target = [" ".join(rng.choice(pool[:4]) for _ in range(30)) for _ in range(5)] + [None, ""]
    aim = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(make_docs(rows).repartition(4), aim, n_buckets, ngrams, seed=7, min_words=5, percent=33)
    assert rows_of(got) == brute(rows, target, n_buckets, ngrams, 7, 5, 33)


def test_odd_rows(spark, odd_docs, odd_rows):
    aim = spark.createDataFrame([("one two three", 1)], "text string, score int")
    got = importance.resample(odd_docs, aim, min_words=2, percent=50)
    assert rows_of(got) == brute(odd_rows, ["one two three"], min_words=2, percent=50)


def test_equal_rows_and_ids(spark, make_docs):
    rows = [(5, "same words here")] * 40 + [(None, "same words here")] * 40 + [(6, "other words here")]
    aim = spark.createDataFrame([("words",)], "text string")
    got = [tuple(r) for r in importance.resample(make_docs(rows).repartition(5), aim, min_words=1, percent=50).collect()]
    assert sorted(r[4] for r in got if r[4]) == list(range(1, 21)) and all(r[0] is not None for r in got if r[4])
    assert len(got) == 81


def test_empty_tables(spark, make_docs, no_docs):
    none = spark.createDataFrame([], "text string")
    assert importance.resample(no_docs, none).count() == 0
    rows = [(1, "a b c"), (2, "d")]
    assert rows_of(importance.resample(make_docs(rows), none, min_words=1, percent=100)) == brute(rows, [], min_words=1, percent=100)


def test_names_that_clash(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, "c")])
    for name in ("n_features", "buckets", "weight", "rank", "unfit", "place"):
        docs = docs.withColumn(name, F.lit("x"))
    assert importance.resample(docs, docs, min_words=1).columns == ["doc_id", "n_features", "weight", "score", "rank"]


def test_query_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in load(f"{SF001}/documents.parquet")]
    target = [r["text"] for r in load(f"{SF001}/benchmark.parquet")]
    assert rows_of(QUERIES["op12_importance_resampling"](spark, SF001)) == brute(rows, target)
