"""KPI row and the SLA marts.

Every measure names its population (closed rows, all rows) and its
denominator explicitly.  Two null policies exist on purpose: the KPI row
and process tables use ``safe_rate`` (0.0 on a zero denominator), the
marts use ``sql_ratio`` (NULL).  Medians are exact; their aggregation
state holds one entry per distinct value, which for integer minutes is
bounded by the range of resolution times, not by the row count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slaflow.functions.numeric import count_when, kpi_round, safe_rate, sql_ratio, sql_round


def _closed() -> Column:
    return F.col("status") == "closed"


def _open() -> Column:
    return F.col("status") == "open"


# --------------------------------------------------------------------------- KPI row (A1)


def kpis(valid: DataFrame) -> DataFrame:
    """The one-row KPI table over typed accepted requests.

    ``reopened_requests`` and ``sla_met_requests`` count closed requests
    only; ``escalated_requests`` counts all requests.
    """
    closed_res = F.when(_closed(), F.col("resolution_minutes").cast("double"))
    agg = valid.agg(
        F.count(F.lit(1)).alias("total_requests"),
        count_when(_closed()).alias("closed_requests"),
        count_when(_closed() & F.col("sla_met")).alias("sla_met_requests"),
        F.avg(closed_res).alias("__avg"),
        F.median(closed_res).alias("__median"),
        count_when(F.col("escalated")).alias("escalated_requests"),
        count_when(_closed() & (F.col("reopened_count") > 0)).alias("reopened_requests"),
    )
    total, closed = F.col("total_requests"), F.col("closed_requests")
    open_backlog = total - closed
    return agg.select(
        "total_requests",
        "closed_requests",
        open_backlog.alias("open_backlog"),
        safe_rate(open_backlog, total).alias("open_backlog_rate"),
        closed.alias("sla_eligible_requests"),
        "sla_met_requests",
        safe_rate(F.col("sla_met_requests"), closed).alias("sla_compliance_rate"),
        kpi_round(F.col("__avg"), 2).alias("average_resolution_minutes"),
        kpi_round(F.col("__median"), 2).alias("median_resolution_minutes"),
        "escalated_requests",
        safe_rate(F.col("escalated_requests"), total).alias("escalation_rate"),
        closed.alias("reopen_eligible_requests"),
        "reopened_requests",
        safe_rate(F.col("reopened_requests"), closed).alias("reopen_rate"),
    )


def kpi_range_violations(kpi_row: DataFrame, ranges: dict[str, Sequence[float]]) -> DataFrame:
    """One row per KPI with a design range: value, bounds, inside flag."""
    rows = [
        F.struct(
            F.lit(name).alias("kpi"),
            F.col(name).cast("double").alias("value"),
            F.lit(float(lo)).alias("lower_bound"),
            F.lit(float(hi)).alias("upper_bound"),
        )
        for name, (lo, hi) in ranges.items()
    ]
    exploded = kpi_row.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return exploded.withColumn("inside", F.col("value").between(F.col("lower_bound"), F.col("upper_bound")))


# --------------------------------------------------------------------------- enriched view (A10)


def enriched(
    fact: DataFrame, dim_date: DataFrame, dim_team: DataFrame, dim_category: DataFrame, dim_priority: DataFrame
) -> DataFrame:
    """Denormalised fact: role-playing date dimension (created inner,
    closed left), team/category/priority labels, breach flag, ratio,
    overrun.  Spark broadcasts the dimensions by their size."""
    created = dim_date.select(F.col("date_key").alias("created_date_key"), F.col("full_date").alias("created_date"))
    closed = dim_date.select(F.col("date_key").alias("closed_date_key"), F.col("full_date").alias("closed_date"))
    joined = (
        fact.join(created, "created_date_key", "inner")
        .join(closed, "closed_date_key", "left")
        .join(dim_team, "team_key", "inner")
        .join(dim_category, "category_key", "inner")
        .join(dim_priority.select("priority_key", "priority"), "priority_key", "inner")
    )
    breached = _closed() & (F.col("sla_met") == F.lit(False))
    return joined.select(
        "ticket_id",
        F.col("created_date").cast("date").alias("created_date"),
        F.col("closed_date").cast("date").alias("closed_date"),
        "assigned_team",
        "category",
        "priority",
        "status",
        "sla_target_minutes",
        "resolution_minutes",
        "reopened_count",
        "escalated",
        "sla_met",
        F.coalesce(breached, F.lit(False)).alias("sla_breached"),
        F.when(_closed(), sql_ratio(F.col("resolution_minutes"), F.col("sla_target_minutes"))).alias("resolution_ratio"),
        F.when(F.coalesce(breached, F.lit(False)), F.col("resolution_minutes") - F.col("sla_target_minutes"))
        .otherwise(F.lit(0).cast("long"))
        .alias("resolution_overrun_minutes"),
        "customer_segment",
        "source_system",
        "source_row",
        "ingestion_batch_id",
    )


# --------------------------------------------------------------------------- rate marts (A4-A7)


def _is_true(c: str) -> Column:
    return F.col(c) == F.lit(True)


def sla_measures(full: bool = True) -> list[Column]:
    """Measures of an SLA mart over closed rows (denominator: closed rows)."""
    n = F.count(F.lit(1))
    met = count_when(_is_true("sla_met"))
    breaches = count_when(_is_true("sla_breached"))
    out = [
        n.alias("closed_requests"),
        met.alias("sla_met_requests"),
        breaches.alias("sla_breaches"),
        sql_ratio(met, n).alias("sla_compliance_rate"),
        sql_ratio(breaches, n).alias("sla_breach_rate"),
    ]
    if full:
        escalated = count_when(_is_true("escalated"))
        reopened = count_when(F.col("reopened_count") > 0)
        res = F.col("resolution_minutes").cast("double")
        out += [
            escalated.alias("escalated_closed_requests"),
            sql_ratio(escalated, n).alias("closed_escalation_rate"),
            reopened.alias("reopened_requests"),
            sql_ratio(reopened, n).alias("reopen_rate"),
            sql_round(F.avg(res), 2).alias("average_resolution_minutes"),
            sql_round(F.median(res), 2).alias("median_resolution_minutes"),
        ]
    return out


def sla_mart(enriched_df: DataFrame, keys: Sequence[str], full: bool = True) -> DataFrame:
    """Generic SLA mart: closed requests grouped by ``keys``."""
    return enriched_df.where(_closed()).groupBy(*keys).agg(*sla_measures(full))


def sla_grouping_sets(enriched_df: DataFrame, key_sets: Sequence[Sequence[str]]) -> DataFrame:
    """Several SLA marts in one aggregate over one scan (GROUPING SETS);
    ``mart`` names the key set of each row."""
    all_keys = list(dict.fromkeys(k for ks in key_sets for k in ks))
    closed = enriched_df.where(_closed())
    agg = closed.groupingSets([[F.col(k) for k in ks] for ks in key_sets], *[F.col(k) for k in all_keys]).agg(
        F.grouping_id(*[F.col(k) for k in all_keys]).alias("__gid"), *sla_measures(True)
    )
    label = None
    for ks in key_sets:
        gid = sum(1 << (len(all_keys) - 1 - i) for i, k in enumerate(all_keys) if k not in ks)
        name = "sla_by_" + "_".join("team" if k == "assigned_team" else k for k in ks)
        label = (F.when(F.col("__gid") == gid, F.lit(name)) if label is None else label.when(F.col("__gid") == gid, F.lit(name)))
    return agg.select(label.alias("mart"), *[c for c in agg.columns if c not in ("__gid",)])


# --------------------------------------------------------------------------- daily mart (A8)


def daily_operations(enriched_df: DataFrame, day_col: str = "created_date") -> DataFrame:
    """All requests by day; rates are NULL on days without closures."""
    closed = count_when(_closed())
    met = count_when(_is_true("sla_met"))
    breaches = count_when(_is_true("sla_breached"))
    return (
        enriched_df.groupBy(day_col)
        .agg(
            F.count(F.lit(1)).alias("total_requests"),
            closed.alias("closed_requests"),
            count_when(_open()).alias("open_requests"),
            closed.alias("sla_eligible_requests"),
            met.alias("sla_met_requests"),
            breaches.alias("sla_breaches"),
            sql_ratio(met, closed).alias("sla_compliance_rate"),
            sql_ratio(breaches, closed).alias("sla_breach_rate"),
            count_when(_is_true("escalated")).alias("escalated_requests"),
            count_when(F.col("reopened_count") > 0).alias("reopened_requests"),
        )
    )


# --------------------------------------------------------------------------- breach list (A9)

BREACH_COLUMNS = [
    "ticket_id",
    "created_date",
    "closed_date",
    "assigned_team",
    "category",
    "priority",
    "customer_segment",
    "status",
    "sla_target_minutes",
    "resolution_minutes",
    "resolution_overrun_minutes",
    "resolution_ratio",
    "reopened_count",
    "escalated",
    "ingestion_batch_id",
]


def breach_details(enriched_df: DataFrame) -> DataFrame:
    return enriched_df.where(_is_true("sla_breached")).select(*BREACH_COLUMNS)


def weighted_rate(mart: DataFrame, numerator: str, denominator: str, digits: int = 4) -> DataFrame:
    """sum(numerator) / sum(denominator) over a mart (never an average of rates)."""
    return mart.agg(safe_rate(F.sum(numerator), F.sum(denominator), digits).alias("weighted_rate"))
