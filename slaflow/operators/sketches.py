"""Mergeable quantile sketches (KLL) beside the exact quantiles.

A sketch of a group holds a few thousand weighted values, however many rows
the group has, and two sketches merge into one of both groups.  Sketches are
therefore taken once, at the finest grain that is stored (say, a day and its
keys), and any coarser mart is made of them without its rows: a day that is
loaded late replaces its own sketches, nothing else.

Every task sketches its own rows before anything is shuffled, so a group that
holds a third of all rows costs one small value for each task.

``rank_error(k)`` is the stated error: the share of the rows by which the rank
of an estimate may be off.  It is three times the error that the sketch keeps
to with 99 % probability for one estimate.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of the sketches: a rank error of 0.83 %.
K = 1000


def rank_error(k: int = K) -> float:
    return 3 * 2.296 / k**0.9723


def sketch(df: DataFrame, keys: Sequence[str], value: str, k: int = K, sums: Mapping[str, str] | None = None) -> DataFrame:
    """One row for each group (a null key is a group) with the sketch of its
    values, their number (nulls don't count) and exact sums of integers."""
    values = F.col(value).cast("double")
    return df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.kll_sketch_agg_double(values, k).alias("sketch"),
        F.count(values).alias("n"),
        *[F.sum(c).alias(name) for name, c in (sums or {}).items()],
    )


def merge(sketches: DataFrame, keys: Sequence[str], k: int = K, sums: Sequence[str] = ()) -> DataFrame:
    """Sketches of a coarser grain, made of finer ones."""
    return sketches.groupBy(*keys).agg(
        F.kll_merge_agg_double("sketch", k).alias("sketch"), F.sum("n").alias("n"), *[F.sum(c).alias(c) for c in sums]
    )


def quantile(p: float, column: str = "sketch") -> Column:
    return F.kll_sketch_get_quantile_double(column, F.lit(float(p)))


def quantiles(sketches: DataFrame, probabilities: Mapping[str, float]) -> DataFrame:
    """The sketched groups with a column for each probability."""
    return sketches.select("*", *[quantile(p).alias(name) for name, p in probabilities.items()]).drop("sketch")


def rank_errors(
    df: DataFrame, estimates: DataFrame, keys: Sequence[str], value: str, probabilities: Mapping[str, float]
) -> DataFrame:
    """How far, as a share of the rows, the estimates' ranks among the exact
    values are from what was asked: one row for each group, a column for each
    probability.  Values equal to the estimate cover a range of ranks; inside
    it the error is zero."""
    names = list(probabilities)
    own = estimates.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], *names)
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)] or F.lit(True)  # one group: one row
    # a group's estimates are the same in all its rows
    counted = (
        df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("__v")).groupBy(*keys, "__v").agg(F.count(F.lit(1)).alias("__c"))
        .join(own, same).groupBy(*keys).agg(
            F.sum("__c").alias("__n"),
            *[F.sum(F.when(F.col("__v") < F.col(n), F.col("__c")).otherwise(0)).alias(f"__{n}_below") for n in names],
            *[F.sum(F.when(F.col("__v") <= F.col(n), F.col("__c")).otherwise(0)).alias(f"__{n}_upto") for n in names],
        )
    )

    def off(n: str) -> Column:
        low, high = F.col(f"__{n}_below") / F.col("__n"), F.col(f"__{n}_upto") / F.col("__n")
        return F.greatest(low - probabilities[n], probabilities[n] - high, F.lit(0.0)).alias(n)

    return counted.select(*keys, *[off(n) for n in names])
