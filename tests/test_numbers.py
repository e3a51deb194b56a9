"""Rounding and number parsing against Python."""

import random

import numpy as np
from pyspark.sql import functions as F

from slaflow.functions import numeric, temporal


def _rounded(spark, values, digits, f=numeric.kpi_round):
    rows = spark.createDataFrame([(v,) for v in values], "v double").select(f(F.col("v"), digits).alias("r")).collect()
    return [r["r"] for r in rows]


def test_kpi_rounding_is_pythons(spark):
    rng = random.Random(7)
    ties = [1 / 40, 3 / 40, 1 / 160, 1 / 32, 2.5, 0.125, 0.375, 2.675, 1.005, -1.005, -0.125, 0.0, 1e9 + 0.125]
    values = ties + [n / d for d in range(1, 400, 7) for n in range(0, d, 5)] + [rng.uniform(-5000, 5000) for _ in range(3000)]
    for digits in (2, 4):
        assert _rounded(spark, values, digits) == [round(v, digits) for v in values]
    assert _rounded(spark, [1 / 40], 2) == [0.03] and _rounded(spark, [1 / 160], 4) == [0.0063]
    assert _rounded(spark, [None], 2) == [None]


def test_scaled_rounding_is_numpys(spark):
    values = [n / 40 for n in range(400)] + [1.005, 2.675]
    assert _rounded(spark, values, 2, numeric.scaled_round) == [float(np.round(v, 2)) for v in values]


def test_numbers_are_decimal_text(spark):
    good = {"240": 240.0, "+5": 5.0, "-5": -5.0, "1e3": 1000.0, "480.0": 480.0, ".5": 0.5, "5.": 5.0, "2E+1": 20.0}
    bad = ["", "240d", "240f", "0x1p3", "nan", "NaN", "1_000", "1,000", "abc", "1e", "--1", "5 5", "\u0665", "Infinityx"]
    values = [*good, *bad, "inf", "-Infinity"]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r["v"]: (r["n"], r["i"]) for r in rows.select("v", numeric.parse_number(F.col("v")).alias("n")).withColumn("i", numeric.is_integral(F.col("n"))).collect()}
    assert {v: got[v][0] for v in good} == good
    assert all(got[v][0] is None for v in bad)
    assert abs(got["inf"][0]) == float("inf") and not got["inf"][1] and not got["-Infinity"][1]
    assert not got[".5"][1] and got["480.0"][1]


def test_fractions_of_long_durations_are_exact(spark):
    durations = [10**15 + 7, 9 * 10**15 + 99, 101, 99, 0]
    rows = spark.createDataFrame([(d,) for d in durations], "d long").select("d", temporal.fraction_micros(F.lit(5).cast("long"), F.col("d"), 47).alias("f"))
    assert {r["d"]: r["f"] for r in rows.collect()} == {d: 5 + d * 47 // 100 for d in durations}
