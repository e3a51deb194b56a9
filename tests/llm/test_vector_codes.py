import hashlib
import random

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from llm.conftest import load
from slaflow.llm import vector_codes
from slaflow.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<float>, label int"


def lloyd(vectors, parts, entries, rounds):
    """Plain Lloyd rounds with full scans over integer vectors, in Python."""
    width = len(vectors[0]) // parts
    cut = [[tuple(v[p * width : (p + 1) * width]) for p in range(parts)] for v in vectors]
    books = [[list(row[p]) for row in cut[:entries]] for p in range(parts)]

    def assign():
        out = []
        for row in cut:
            best = []
            for p in range(parts):
                best.append(min((sum((a - b) ** 2 for a, b in zip(row[p], e)), k) for k, e in enumerate(books[p])))
            out.append(best)
        return out

    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for k in range(len(books[p])):
                own = [row[p] for row, best in zip(cut, found) if best[p][1] == k]
                if own:
                    books[p][k] = [sum(x) // len(own) for x in zip(*own)]
    final = assign()
    digest = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    return [("".join(f"{k:02x}" for _, k in best), sum(d for d, _ in best)) for best in final], digest


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def coded(df):
    return {r["vec_id"]: (None if r["code"] is None else bytes(r["code"]).hex(), r["error"]) for r in df.collect()}


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_equals_full_scans(spark, rounds):
    rng = random.Random(rounds)
    # few values: many ties, moved and fixed entries side by side
    rows = [(i, [rng.choice([-0.5, -0.25, 0.0, 0.25, 0.3]) for _ in range(8)], i % 3) for i in range(150)]
    out, books = vector_codes.compress(table(spark, rows), parts=4, entries=10, rounds=rounds)
    want, digest = lloyd([[int(np.floor(256 * float(np.float32(x)))) for x in v] for _, v, _ in rows], 4, 10, rounds)
    assert coded(out) == dict(enumerate(want)) and books.digest() == digest


def test_active_scan_equals_full_scan():
    rng = np.random.default_rng(3)
    for _ in range(20):
        parts = rng.integers(-3, 4, (200, 2, 2))
        old = vector_codes.Codebooks(rng.integers(-3, 4, (2, 7, 2)), np.ones((2, 7), bool))
        codes, distances = vector_codes.assign_all(parts, old)
        entries = old.entries.copy()
        entries[0, [1, 4]] += rng.integers(-1, 2, (2, 2))
        entries[1, 6] += 1
        new = vector_codes.Codebooks(entries, (entries != old.entries).any(2))
        got, want = vector_codes.assign_active(parts, new, codes, distances), vector_codes.assign_all(parts, new)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_large_integers_stay_exact():
    a = np.array([[1 << 24, -(1 << 24)], [(1 << 24) - 1, 3]])
    d = vector_codes._distances(a, a)
    assert d[0, 1] == 1 + ((1 << 24) + 3) ** 2 and d[0, 0] == 0


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    good = [0.1, -0.2, 0.3, 0.4]
    rows = [
        (1, None, 1), (2, [0.1, None, 0.3, 0.4], 1), (3, [nan, 0.0, 0.0, 0.0], 1), (4, [0.0, -inf, 0.0, 0.0], 1),
        (5, good, 1), (6, good, None), (6, good, None), (7, [-x for x in good], None), (None, good, 2),
        (8, [0.1, 0.2], 3), (9, [], 3), (10, [1e30, 0.0, 0.0, 0.0], 4), (11, [0.1, 0.2, 0.3], 1),
    ]
    df = table(spark, rows)
    for name in ("code", "error", "ints", "distances", "of", "n", "s", "Label_Error"):
        df = df.withColumn(name, F.lit(7))
    out, books = vector_codes.compress(df, parts=4, entries=2, rounds=2)
    got = sorted(((r["vec_id"], r["code"] and bytes(r["code"]).hex(), r["error"]) for r in out.collect()), key=repr)
    whole = lambda v: [int(np.floor(256 * float(np.float32(x)))) for x in v]
    codable = [(5, good, 1), (6, good, None), (6, good, None), (7, [-x for x in good], None), (None, good, 2)]
    want, digest = lloyd([whole(v) for _, v, _ in codable], 4, 2, 2)
    left_over = [(i, None, None) for i in (8, 9, 10, 11)]
    assert got == sorted([(i, *w) for (i, _, _), w in zip(codable, want)] + left_over, key=repr)
    assert books.digest() == digest
    errors = vector_codes.with_label_error(out).collect()
    assert len(errors) == len(got)
    by = {(r["vec_id"], r["label"]): r["label_error"] for r in errors}
    assert by[(11, 1)] == want[0][1] and by[(8, 3)] is None and by[(10, 4)] is None
    assert by[(6, None)] == by[(7, None)] == want[1][1] + want[2][1] + want[3][1]


def test_fewer_rows_than_entries_and_an_empty_table(spark):
    out, books = vector_codes.compress(table(spark, [(3, [0.5, 0.25], 1), (1, [0.0, 0.0], 1)]), parts=2)
    assert coded(out) == {1: ("0000", 0), 3: ("0101", 0)} and books.entries.shape == (2, 2, 1)
    out, books = vector_codes.compress(table(spark, []))
    assert out.count() == 0 and books is None and vector_codes.with_label_error(out).count() == 0


def test_heavy_and_light_labels(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "HEAVY_SHARE", 10)
    rows = [(i, None if i % 7 == 0 else 1 if i % 3 else i, i) for i in range(300)]
    df = spark.createDataFrame([(i, lab, None, e) for i, lab, e in rows], "vec_id long, label int, code binary, error long")
    want = {}
    for _, lab, e in rows:
        want[lab] = want.get(lab, 0) + e
    got = vector_codes.with_label_error(df).collect()
    assert len(got) == 300 and all(r["label_error"] == want[r["label"]] for r in got)


def test_query_against_brute_force(spark):
    rows = sorted((r["vec_id"], r["embedding"], r["label"]) for r in load(f"{SF001}/embeddings.parquet"))
    want, digest = lloyd([[int(np.floor(256 * x)) for x in v] for _, v, _ in rows], 16, 64, 2)
    by = {}
    for (_, _, lab), (_, e) in zip(rows, want):
        by[lab] = by.get(lab, 0) + e
    got = {r["vec_id"]: tuple(r)[1:] for r in QUERIES["op13_vector_codes"](spark, SF001).collect()}
    assert got == {i: (c, e, by[lab], digest) for (i, _, lab), (c, e) in zip(rows, want)}
