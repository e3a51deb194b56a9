"""Gold star schema: dimensions, surrogate keys, fact table, FK checks.

Dimension members are few by construction (contract domains, observed
calendar days); Spark broadcasts the written dimensions into the fact joins
while their size allows it.
Keys are positions in the sorted member list, so they are rebuilt on
every run and never joined across runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from slaflow.contract import PRIORITY_ORDER
from slaflow.functions.temporal import calendar_columns, date_key
from slaflow.operators.ordinal import with_ordinal

FACT_COLUMNS = [
    "ticket_id",
    "created_date_key",
    "closed_date_key",
    "team_key",
    "category_key",
    "priority_key",
    "status",
    "sla_target_minutes",
    "resolution_minutes",
    "reopened_count",
    "escalated",
    "sla_met",
    "customer_segment",
    "source_system",
    "source_row",
    "ingestion_batch_id",
]


def string_dimension(df: DataFrame, value_col: str, key_col: str) -> DataFrame:
    """Sorted distinct non-null values with keys 1..n, numbered in Spark."""
    members = df.where(F.col(value_col).isNotNull()).select(F.col(value_col).cast("string").alias(value_col)).distinct()
    return with_ordinal(members, [value_col], name=key_col).select(F.col(key_col).cast("long").alias(key_col), value_col)


def ordered_dimension(
    df: DataFrame,
    value_col: str,
    key_col: str,
    order: Sequence[str],
    attribute_cols: Sequence[str] = (),
) -> DataFrame:
    """Members in a fixed order (observed ones only), keys 1..n, with
    attributes taken from the data (one value per member expected).  The
    window has a row for each member of the order."""
    rank = F.array_position(F.array(*[F.lit(v) for v in order]), F.col(value_col))
    members = df.where(rank > 0).groupBy(value_col).agg(F.min(rank).alias("__rank"), *[F.min(a).alias(a) for a in attribute_cols])
    return members.select(
        F.row_number().over(Window.orderBy("__rank")).cast("long").alias(key_col), value_col, *attribute_cols
    )


def priority_dimension(valid: DataFrame, order: Sequence[str] = PRIORITY_ORDER) -> DataFrame:
    return ordered_dimension(valid, "priority", "priority_key", order, ["sla_target_minutes"])


def date_dimension(valid: DataFrame, timestamp_cols: Sequence[str] = ("created_at", "closed_at")) -> DataFrame:
    """Observed UTC days (union of the timestamp columns, not a gap-free
    calendar) with key yyyyMMdd and calendar attributes."""
    days = valid.select(F.explode(F.array(*[F.to_date(c) for c in timestamp_cols])).alias("full_date"))
    distinct_days = days.where(F.col("full_date").isNotNull()).distinct()
    return distinct_days.select(
        date_key(F.col("full_date")).alias("date_key"), "full_date", *calendar_columns(F.col("full_date"))
    )


def resolve_key(fact: DataFrame, dim: DataFrame, value_col: str, key_col: str) -> DataFrame:
    """Look a surrogate key up; a value that the dimension lacks fails the
    job.  Dimensions are written tables, which Spark broadcasts by their size."""
    joined = fact.join(dim.select(value_col, key_col), value_col, "left")
    message = F.lit(f"Gold fact contains unresolved foreign key values in {key_col}.")
    return joined.withColumn(key_col, F.coalesce(F.col(key_col), F.raise_error(message).cast("long")))


def fact_table(valid: DataFrame, dim_team: DataFrame, dim_category: DataFrame, dim_priority: DataFrame) -> DataFrame:
    fact = valid.withColumn("created_date_key", date_key(F.col("created_at"))).withColumn(
        "closed_date_key", date_key(F.col("closed_at"))
    )
    fact = resolve_key(fact, dim_team, "assigned_team", "team_key")
    fact = resolve_key(fact, dim_category, "category", "category_key")
    fact = resolve_key(fact, dim_priority.select("priority", "priority_key"), "priority", "priority_key")
    return fact.select(*FACT_COLUMNS)


def foreign_key_violations(
    fact: DataFrame, dim_date: DataFrame, dim_team: DataFrame, dim_category: DataFrame, dim_priority: DataFrame
) -> DataFrame:
    """One row per foreign key: fact rows whose key is absent from its
    dimension (a NULL closed-date key is exempt; other NULL keys count).

    One scan of the fact's key columns, left-joined to each dimension's
    key set, and one aggregate counting misses.
    """
    checks: list[tuple[str, str, DataFrame, str]] = [
        ("created_date_key", "date_key", dim_date, "dim_date"),
        ("closed_date_key", "date_key", dim_date, "dim_date"),
        ("team_key", "team_key", dim_team, "dim_team"),
        ("category_key", "category_key", dim_category, "dim_category"),
        ("priority_key", "priority_key", dim_priority, "dim_priority"),
    ]
    keys = fact.select(*[c for c, _, _, _ in checks])
    misses = []
    for i, (fact_col, dim_col, dim, _) in enumerate(checks):
        found = f"__found{i}"
        members = dim.select(F.col(dim_col).alias(f"__k{i}")).distinct().withColumn(found, F.lit(True))
        keys = keys.join(members, F.col(fact_col) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        missing = F.col(found).isNull()
        if fact_col == "closed_date_key":
            missing = missing & F.col(fact_col).isNotNull()
        misses.append(F.count_if(missing).alias(f"__miss{i}"))
    counted = keys.agg(*misses)
    rows = [
        F.struct(F.lit(fact_col).alias("foreign_key"), F.lit(dim_name).alias("dimension"), F.col(f"__miss{i}").alias("violations"))
        for i, (fact_col, _, _, dim_name) in enumerate(checks)
    ]
    return counted.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
