"""Generic integrity operators usable on any table: duplicate keys
(every occurrence flagged) and end-before-start temporal violations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def duplicate_key_rows(df: DataFrame, keys: Sequence[str], count_col: str = "key_occurrences") -> DataFrame:
    """All rows whose key occurs more than once, with the occurrence count.

    The count is an aggregate (map-side combined, so a hot key is
    pre-counted in every task) joined back on the key; AQE broadcasts the
    repeated-key side when small and splits a skewed key when not.
    """
    keys = list(keys)
    repeated = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)
    )
    return df.join(repeated, keys, "inner")


def end_before_start(
    starts: DataFrame,
    start_key: str,
    start_col: str,
    ends: DataFrame,
    end_key: str,
    end_col: str,
) -> DataFrame:
    """Entities whose latest end (e.g. last shipment) precedes their start
    (e.g. order date); equality is legal, entities without an end are not
    reported.  The end side is reduced to one row per key before the join."""
    last_end = ends.groupBy(F.col(end_key).alias(start_key)).agg(F.max(end_col).alias("last_end"))
    joined = starts.select(start_key, start_col).join(last_end, start_key, "inner")
    return joined.where(F.col("last_end") < F.col(start_col))
