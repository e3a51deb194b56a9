"""Queries over quantile sketches: daily sketches rolled up into marts, held
against the exact ranks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.operators import process, sketches
from slaflow.operators.ordinal import materialize
from slaflow.plans.layers import MedallionLayers, ObservedLog
from slaflow.session import prepare_session

ASKED = {"median": 0.5, "p90": 0.9}


def _holds(df: DataFrame, merged: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(*keys, median_holds, p90_holds): is the estimate within the stated
    rank error?"""
    off = sketches.rank_errors(df, sketches.quantiles(merged, ASKED), keys, value, ASKED)
    return off.select(*keys, *[(F.col(n) <= sketches.rank_error()).alias(f"{n}_holds") for n in ASKED])


def sketched_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolution times: sketches by day, team and category are stored once
    and merged into three marts."""
    prepare_session(spark)
    closed = MedallionLayers.for_requests(spark, sf_dir).enriched.where("status = 'closed'")
    daily = sketches.sketch(closed, ["created_date", "assigned_team", "category"], "resolution_minutes")
    daily = materialize(daily, "daily-sketches")
    marts = None
    for name, keys in (("team", ["assigned_team"]), ("category", ["category"]), ("team_category", ["assigned_team", "category"])):
        merged = sketches.merge(daily, keys)
        one = merged.select(*[F.col(k).alias(f"_{k}") for k in keys], "n")
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        held = _holds(closed, merged, keys, "resolution_minutes").join(one, same)
        columns = [F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("assigned_team", "category")]
        held = held.select(F.lit(name).alias("mart"), *columns, F.col("n").alias("closed_requests"), "median_holds", "p90_holds")
        marts = held if marts is None else marts.unionByName(held)
    return marts


def sketched_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Waits between observed events: sketches by day are stored and merged;
    counts and means are exact."""
    prepare_session(spark)
    pairs = ObservedLog.for_events(spark, sf_dir).pairs
    keys = ["source_activity", "target_activity"]
    daily = materialize(process.transition_sketches(pairs.withColumn("day", F.to_date("at")), ["day"]), "daily-sketches")
    table = process.transitions_of_sketches(daily)
    held = _holds(pairs, sketches.merge(daily, keys), keys, "wait_minutes").select(*[F.col(k).alias(f"_{k}") for k in keys], "median_holds", "p90_holds")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return table.join(held, same).select(*keys, "case_count", "average_wait_minutes", "median_holds", "p90_holds")
