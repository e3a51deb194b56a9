import random

import numpy as np
import pytest

from slaflow.operators import process, sketches
from slaflow.operators.quantiles import exact_quantiles

ASKED = {"q10": 0.1, "median": 0.5, "p99": 0.99}


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds a third of all rows; values are heavy-tailed, with
    nulls and a null group."""
    rng = random.Random(3)
    rows = []
    for k in range(60_000):
        group = "hot" if k % 3 == 0 else None if k % 3 == 1 and k % 5 == 0 else f"g{k % 11}"
        rows.append((group, k % 30, None if k % 17 == 0 else int(rng.paretovariate(1.2) * 10)))
    return spark.createDataFrame(rows, "g string, day int, v long").repartition(6).cache()


def test_daily_sketches_merge_within_the_stated_error(skewed):
    daily = sketches.sketch(skewed, ["day", "g"], "v")
    for keys in (["g"], ["day"], []):
        merged = sketches.merge(daily, keys)
        estimates = sketches.quantiles(merged, ASKED)
        off = sketches.rank_errors(skewed, estimates, keys, "v", ASKED).collect()
        assert len(off) == estimates.count() and off
        assert all(r[n] <= sketches.rank_error() for r in off for n in ASKED), off


def test_counts_and_sums_are_exact(skewed):
    daily = sketches.sketch(skewed, ["day", "g"], "v", sums={"total": "v"})
    got = {r["g"]: (r["n"], r["total"]) for r in sketches.merge(daily, ["g"], sums=["total"]).collect()}
    want = {r["g"]: (r["n"], r["t"]) for r in skewed.groupBy("g").agg({"v": "count", "g": "max"}).selectExpr("g", "`count(v)` AS n", "0L AS t").collect()}
    assert {g: n for g, (n, _) in got.items()} == {g: n for g, (n, _) in want.items()}
    assert sum(t for _, t in got.values()) == skewed.agg({"v": "sum"}).first()[0]


def test_small_groups_are_exact(spark):
    rows = [(k % 5, float(k)) for k in range(500)]
    df = spark.createDataFrame(rows, "g int, v double")
    got = {r["g"]: r["q"] for r in sketches.quantiles(sketches.sketch(df, ["g"], "v"), {"q": 0.5}).collect()}
    for g, q in got.items():
        assert q in (np.quantile([v for h, v in rows if h == g], 0.5, method=m) for m in ("lower", "higher"))


def test_rank_errors_are_measured_against_exact_ranks(spark):
    df = spark.createDataFrame([("a", v) for v in [1, 2, 2, 2, 3, 4, 5, 6, 7, 8]], "g string, v int")
    estimates = spark.createDataFrame([("a", 2.0, 8.0)], "g string, low double, high double")
    (r,) = sketches.rank_errors(df, estimates, ["g"], "v", {"low": 0.3, "high": 0.5}).collect()
    assert r["low"] == 0 and abs(r["high"] - 0.4) < 1e-12


def test_transitions_of_sketches_equal_the_exact_table(spark):
    rng = random.Random(1)
    waits = [rng.choice([5, 60, 600]) * 60_000_000 * rng.randint(1, 50) for _ in range(3000)]
    pairs = spark.createDataFrame([(f"a{k % 2}", None if k % 7 == 0 else "b", w, w / 6e7, k % 9) for k, w in enumerate(waits)],
                                  "source_activity string, target_activity string, wait_us long, wait_minutes double, day int")
    stored = process.transition_sketches(pairs, ["day"])
    key = lambda r: (r["source_activity"], r["target_activity"])
    got = {key(r): r for r in process.transitions_of_sketches(stored).collect()}
    for r in process.transition_performance(pairs).collect():
        other = got.pop(key(r))
        assert (r["case_count"], r["average_wait_minutes"]) == (other["case_count"], other["average_wait_minutes"])
    assert not got
    exact = exact_quantiles(pairs, ["source_activity"], "wait_minutes", {"m": 0.5})
    assert exact.count() == 2
