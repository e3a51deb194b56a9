"""Named queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver tables of ``sf_dir`` (through the request
source or the ``events`` / ``lineitem`` / ``orders`` tables), so its work
grows with them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.operators import integrity, metrics, validation
from slaflow.plans import files, published, sketched
from slaflow.plans.layers import (
    MedallionLayers,
    ObservedLog,
    analytics_controls,
    medallion_controls,
    process_controls,
)
from slaflow.session import prepare_session
from slaflow.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def _layers(spark: SparkSession, sf_dir: str) -> MedallionLayers:
    prepare_session(spark)
    return MedallionLayers.for_requests(spark, sf_dir)


def _observed(spark: SparkSession, sf_dir: str) -> ObservedLog:
    prepare_session(spark)
    return ObservedLog.for_events(spark, sf_dir)


def _on_layers(build: Callable[[MedallionLayers], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(_layers(spark, sf_dir))


SLA_KEY_SETS = [["assigned_team"], ["category"], ["priority"], ["assigned_team", "category"]]


def _issue_counts(L: MedallionLayers) -> DataFrame:
    return validation.issue_counts(L.issues)


def _lineitem_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    lineitem = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"
    )
    return integrity.duplicate_key_rows(lineitem, ["l_orderkey", "l_linenumber"])


def _orders_end_before_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare_session(spark)
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    lineitem = read_table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("l_shipdate"))
    return integrity.end_before_start(orders, "o_orderkey", "o_orderdate", lineitem, "l_orderkey", "l_shipdate")


QUERIES: dict[str, Query] = {
    # validation / bronze / silver
    "bronze_requests": _on_layers(lambda L: L.bronze),
    "dq_issues": _on_layers(lambda L: L.issues),
    "dq_issue_counts": _on_layers(_issue_counts),
    "dq_report": _on_layers(lambda L: validation.row_totals(L.annotated)),
    "silver_valid": _on_layers(lambda L: L.silver_valid),
    "silver_rejected": _on_layers(lambda L: L.silver_rejected),
    # gold
    "dim_date": _on_layers(lambda L: L.dim_date),
    "dim_team": _on_layers(lambda L: L.dim_team),
    "dim_category": _on_layers(lambda L: L.dim_category),
    "dim_priority": _on_layers(lambda L: L.dim_priority),
    "fact_requests": _on_layers(lambda L: L.fact),
    "fk_violations": _on_layers(lambda L: L.fk_violations),
    "kpis": _on_layers(lambda L: L.kpis),
    "kpi_design_ranges": _on_layers(lambda L: metrics.kpi_range_violations(L.kpis, L.contract["scenario"]["kpi_design_ranges"])),
    # analytics marts
    "requests_enriched": _on_layers(lambda L: L.mart("service_requests_enriched")),
    "sla_by_team": _on_layers(lambda L: L.mart("sla_by_team")),
    "sla_by_category": _on_layers(lambda L: L.mart("sla_by_category")),
    "sla_by_priority": _on_layers(lambda L: L.mart("sla_by_priority")),
    "sla_by_team_category": _on_layers(lambda L: L.mart("sla_by_team_category")),
    "sla_grouping_sets": _on_layers(lambda L: metrics.sla_grouping_sets(L.enriched, SLA_KEY_SETS)),
    "daily_operations": _on_layers(lambda L: L.mart("daily_service_operations")),
    "breach_details": _on_layers(lambda L: L.mart("sla_breach_details")),
    # process intelligence (derived log)
    "event_log": _on_layers(lambda L: L.event_log),
    "process_cases": _on_layers(lambda L: L.cases),
    "process_variants": _on_layers(lambda L: L.variants()),
    "transition_performance": _on_layers(lambda L: L.transitions),
    "bottlenecks": _on_layers(lambda L: L.bottlenecks),
    "exception_paths": _on_layers(lambda L: L.exception_paths()),
    # controls
    "controls_medallion": _on_layers(medallion_controls),
    "controls_analytics": _on_layers(analytics_controls),
    "controls_process": _on_layers(process_controls),
    # process operators on the observed events table
    "observed_transitions": lambda spark, sf: _observed(spark, sf).transitions,
    "observed_bottlenecks": lambda spark, sf: _observed(spark, sf).bottlenecks(),
    "observed_variants": lambda spark, sf: _observed(spark, sf).variants(),
    "observed_variant_steps": lambda spark, sf: _observed(spark, sf).variant_steps(),
    # generic integrity operators on other tables
    "duplicate_keys_lineitem": _lineitem_duplicates,
    "closed_before_created_orders": _orders_end_before_start,
    # text files
    "csv_documents": files.csv_documents,
    "csv_malformed_documents": files.csv_malformed_documents,
    # publications
    "published_row_counts": published.published_row_counts,
    "published_controls": published.published_controls,
    "gold_views": published.gold_views,
    "published_order": published.published_order,
    "mart_differences": published.mart_differences,
    "fact_by_month": published.fact_by_month,
    # quantile sketches
    "sketched_resolution": sketched.sketched_resolution,
    "sketched_transitions": sketched.sketched_transitions,
}
