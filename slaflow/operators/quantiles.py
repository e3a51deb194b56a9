"""Exact, linearly interpolated quantiles per group (same definition as
``quantile_cont`` / pandas ``quantile``), built from ordinary aggregates.

Spark's ``percentile`` keeps a value->count map per group in memory, so a
group with many distinct values must fit in one task's heap, and a window
over the group would sort all of them in one task.  Here:

1. values are counted per (group, value) - map-side combined, so a hot
   group is pre-reduced in every task;
2. the counted table is range-partitioned on (group, value), so a group
   with many distinct values spans many partitions, and frozen with its
   partition ids (materialised, so both later uses see the same split);
3. running counts are computed per (partition, group) slice, each bounded
   by one partition;
4. per-group offsets come from a table with one row per slice (bounded
   by partitions + groups) and turn slice ranks into group ranks;
5. the rows holding the two ranks around (n-1)p are picked by a
   map-side-combined aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slaflow.operators.ordinal import materialize

_PART = "__qpart"


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    count_name: str | None = None,
    sum_of: str | None = None,
    sum_name: str | None = None,
) -> DataFrame:
    """One row per group (a NULL key is a group) with one column per requested
    probability, and optionally the row count and the (exact, integer) sum of ``sum_of``."""
    keys = list(keys)
    partial = [F.count(F.lit(1)).alias("__c")]
    if sum_of:
        partial.append(F.sum(sum_of).alias("__s"))
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(*partial)
    frozen = materialize(
        counted.repartitionByRange(*[F.col(k) for k in keys], F.col(value)).withColumn(_PART, F.spark_partition_id()),
        "quantile-slices",
    )

    in_slice = Window.partitionBy(_PART, *keys).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = frozen.withColumn("__local_end", F.sum("__c").over(in_slice))

    slices = frozen.groupBy(_PART, *keys).agg(F.sum("__c").alias("__slice"))
    group = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
    before = group.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = slices.select(
        _PART,
        *keys,
        F.coalesce(F.sum("__slice").over(before), F.lit(0)).alias("__offset"),
        F.sum("__slice").over(group).alias("__n"),
    )
    same = [local[c].eqNullSafe(offsets[c]) for c in (_PART, *keys)]
    ranked = local.join(offsets, same).select(
        *[local[k] for k in keys],
        value,
        *(["__s"] if sum_of else []),
        (F.col("__offset") + F.col("__local_end") - F.col("__c")).alias("__start"),
        (F.col("__offset") + F.col("__local_end")).alias("__end"),
        "__n",
    )

    picks = [F.max("__n").alias("__n")]
    if sum_of:
        picks.append(F.sum("__s").alias("__sum"))
    for name, p in probabilities.items():
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.floor(h), F.ceil(h)
        picks += [
            F.max(F.when((F.col("__start") <= lo) & (lo < F.col("__end")), F.col(value))).alias(f"__{name}_lo"),
            F.max(F.when((F.col("__start") <= hi) & (hi < F.col("__end")), F.col(value))).alias(f"__{name}_hi"),
            F.max(h - lo).alias(f"__{name}_d"),
        ]
    agg = ranked.groupBy(*keys).agg(*picks)
    out = [F.col(k) for k in keys]
    if count_name:
        out.append(F.col("__n").cast("long").alias(count_name))
    if sum_of and sum_name:
        out.append(F.col("__sum").alias(sum_name))
    for name in probabilities:
        lo_v, hi_v, d = F.col(f"__{name}_lo"), F.col(f"__{name}_hi"), F.col(f"__{name}_d")
        out.append((lo_v + (hi_v - lo_v) * d).alias(name))
    return agg.select(*out)
