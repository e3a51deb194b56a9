"""Batch jobs: validate, medallion (Bronze/Silver/Gold), analytics marts,
process intelligence.

Each job stages its tables in a folder of its own, sorted into their
published order; their figures are observed on the way.  Its reconciliation
controls are evaluated on these figures, once, and the run is published, by
replacing its manifest, only if all of them pass (see ``publication``).  The
layers that several tables need (Bronze, the annotated rows, the fact, the
requests with their events) are written once to the checkpoint folder and
deleted at the end of the job.
"""

from __future__ import annotations

import copy
from functools import cached_property
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.contract import EVENT_ORIGIN, default_contract
from slaflow.functions.numeric import safe_rate
from slaflow.operators import controls as ctl
from slaflow.operators import metrics, process, star, validation
from slaflow.operators.ordinal import materialize, scratch
from slaflow.plans.layers import MedallionLayers, medallion_controls, process_controls
from slaflow.plans.publication import Published, Run, manifest_text, replace_text
from slaflow.session import prepare_session
from slaflow.sources.bronze import bronze_and_malformed, bronze_from_csv
from slaflow.sources.tables import require_rows

#: Versions of this engine's outputs.
PIPELINE_VERSION = "2.0.0"
ANALYTICS_VERSION = "2.0.0"
PROCESS_VERSION = "2.0.0"
MART_NAMES = [
    "service_requests_enriched",
    "sla_by_team",
    "sla_by_category",
    "sla_by_priority",
    "sla_by_team_category",
    "daily_service_operations",
    "sla_breach_details",
]
GOLD_TABLES = ["gold_fact", "kpis", "dim_date", "dim_team", "dim_category", "dim_priority"]
# Fixed value: the note that the process manifest carries.
PROCESS_BOUNDARY = (
    "Event timestamps between ticket creation and closure are deterministic scenario "
    "derivations. The outputs support process-analysis practice but do not represent "
    "observed production history or causal root-cause evidence."
)
# Messages about inputs that are missing or empty.
MISSING_GOLD = "Missing Gold Parquet input"
NO_CASES = "Process-intelligence source must contain at least one valid case."
# publication order of each table: column, or -column for descending
TABLE_ORDER = {
    "bronze": ["source_row"],
    "silver_valid": ["source_row"],
    "silver_rejected": ["source_row"],
    "silver_issues": ["source_row", "issue_code", "issue_position"],
    "fact": ["source_row"],
    "dim_date": ["date_key"],
    "dim_team": ["team_key"],
    "dim_category": ["category_key"],
    "dim_priority": ["priority_key"],
    "service_requests_enriched": ["ticket_id"],
    "sla_by_team": ["assigned_team"],
    "sla_by_category": ["category"],
    "sla_by_priority": ["priority"],
    "sla_by_team_category": ["assigned_team", "category"],
    "daily_service_operations": ["created_date"],
    "sla_breach_details": ["-resolution_overrun_minutes", "ticket_id"],
    "event_log": ["case_id", "event_index"],
    "process_cases": ["case_id"],
    "process_variants": ["-case_count", "process_variant"],
    "transition_performance": ["-case_count", "source_activity", "target_activity"],
    "bottlenecks": ["bottleneck_rank"],
    "exception_paths": ["-case_count", "exception_type"],
}


#: Published tables that stand under another name in ``TABLE_ORDER``.
ORDER_OF = {"gold_fact": "fact"}


def in_order(df: DataFrame, name: str) -> DataFrame:
    """The table in its published order."""
    return df.orderBy(*[F.col(c[1:]).desc() if c[0] == "-" else F.col(c).asc() for c in TABLE_ORDER[name]])


# --------------------------------------------------------------------------- sinks


def refuse_forbidden(tables: dict[str, DataFrame], contract: dict[str, Any]) -> None:
    """No published table may hold a column that the contract forbids."""
    found = {n: c for n, df in tables.items() if (c := validation.forbidden_columns_present(df, contract))}
    if found:
        raise ValueError("Forbidden columns: " + "; ".join(f"{n}: {', '.join(c)}" for n, c in sorted(found.items())))


def write_manifest(manifest: dict[str, Any], path: str | Path, spark: SparkSession) -> str:
    """Sorted-key JSON on the file system of the path, whole or not at all."""
    return replace_text(spark, path, manifest_text(manifest))


def one_row(df: DataFrame) -> dict[str, Any]:
    row = df.first()
    return row.asDict() if row else {}


# --------------------------------------------------------------------------- validate (B1)


def validate_source(bronze: DataFrame, contract: dict[str, Any] | None = None) -> dict[str, Any]:
    """Validation summary of a Bronze-shaped source."""
    contract = contract or default_contract()
    annotated = materialize(validation.annotate(bronze, contract), "validated")
    return validation.validation_report(annotated, contract)


def write_report(report: dict[str, Any], path: str | Path, spark: SparkSession) -> str:
    return write_manifest(report, path, spark)


def validate_file(
    spark: SparkSession, input_path: str, contract: dict[str, Any] | None = None
) -> dict[str, Any]:
    prepare_session(spark)
    with scratch(spark):
        return validate_source(bronze_from_csv(spark, input_path), contract)


# --------------------------------------------------------------------------- medallion (B2-B4)

MEDALLION, ANALYTICS, PROCESS = "medallion_manifest.json", "analytics_manifest.json", "process_intelligence_manifest.json"


def write_medallion(layers: MedallionLayers, output_dir: str | Path, malformed: DataFrame | None = None) -> str:
    """Stage all tables, check them and publish them; the manifest's path."""
    L, spark = layers, layers.bronze.sparkSession
    tables = {
        "bronze": (L.bronze, "bronze", "bronze/service_requests"),
        "silver_valid": (L.silver_valid, "silver_valid", "silver/service_requests_valid"),
        "silver_rejected": (L.silver_rejected, "silver_rejected", "silver/service_requests_rejected"),
        "gold_fact": (L.fact, "fact", "gold/fact_service_requests"),
        **{n: (getattr(L, n), n, f"gold/{n}") for n in ("dim_date", "dim_team", "dim_category", "dim_priority")},
    }
    refuse_forbidden({n: df for n, (df, _, _) in tables.items()} | {"silver_issues": L.issues}, L.contract)
    run = Run(spark, output_dir, MEDALLION)
    staged = {n: run.write(n, in_order(df, order), path) for n, (df, order, path) in tables.items()}
    issues = in_order(L.issues, "silver_issues").drop("issue_position")
    staged["silver_issues"] = run.write("silver_issues", issues, "silver/service_request_issues")
    if malformed is not None:
        run.write("malformed_records", malformed.orderBy("source_row"), "bronze/malformed_records")
    kpis = run.write("kpis", metrics.kpis(staged["silver_valid"]), "gold/service_operations_kpis")
    run.write_csv(kpis, "gold/service_operations_kpis_csv")
    keys = star.foreign_key_violations(*[staged[n] for n in ("gold_fact", "dim_date", "dim_team", "dim_category", "dim_priority")])
    violations = keys.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("n")).first()["n"]
    rows = run.figure
    checks = [
        ("bronze_equals_valid_plus_rejected", rows("silver_valid") + rows("silver_rejected"), rows("bronze")),
        ("valid_equals_fact", rows("gold_fact"), rows("silver_valid")),
        ("foreign_keys_complete", violations, 0),
    ]
    passed = run.check(checks, "Medallion")
    issue_counts = {r["issue_code"]: int(r["issue_count"]) for r in validation.issue_counts(staged["silver_issues"]).collect()}
    meta = one_row(staged["bronze"].select("source_file", "ingestion_batch_id"))
    counts = {n: c for n, c in run.row_counts().items() if n != "kpis"}
    manifest = {
        "pipeline_version": PIPELINE_VERSION,
        "source_file": meta.get("source_file"),
        "ingestion_batch_id": meta.get("ingestion_batch_id"),
        "row_counts": counts,
        "issue_counts": dict(sorted(issue_counts.items())),
        "controls": passed,
        "kpis": one_row(kpis),
    }
    return run.publish(manifest)


def run_medallion(
    spark: SparkSession, input_path: str, output_dir: str, contract: dict[str, Any] | None = None, malformed: str = "refuse"
) -> str:
    """Medallion of CSV files.  A malformed record stops the job, or, with
    ``malformed="keep"``, is published in a table beside Bronze with its row
    and text."""
    if malformed not in ("refuse", "keep"):
        raise ValueError(f"malformed records are refused or kept, not {malformed!r}")
    prepare_session(spark)
    with scratch(spark):
        if malformed == "keep":
            bronze, bad = bronze_and_malformed(spark, input_path)
        else:
            bronze, bad = bronze_from_csv(spark, input_path), None
        return write_medallion(MedallionLayers(bronze, contract), output_dir, bad)


def published_medallion(spark: SparkSession, medallion_dir: str | Path) -> Published:
    return Published(spark, medallion_dir, MEDALLION, "Medallion manifest")


# --------------------------------------------------------------------------- analytics (B5)


class GoldTables:
    """Gold tables of a published medallion, all of which must be there; each
    is a temporary view too, and so are the enriched requests, which are
    joined when they are read and written once for the marts."""

    def __init__(self, published: Published):
        names = {"gold_fact": "fact_service_requests", "kpis": "service_operations_kpis"}
        tables = published.register_views(GOLD_TABLES, MISSING_GOLD)
        self.fact, self.kpis = tables["gold_fact"], tables["kpis"]
        for own, view in names.items():
            tables[own].createOrReplaceTempView(view)
        self.dim_date, self.dim_team = tables["dim_date"], tables["dim_team"]
        self.dim_category, self.dim_priority = tables["dim_category"], tables["dim_priority"]
        self._joined = metrics.enriched(self.fact, self.dim_date, self.dim_team, self.dim_category, self.dim_priority)
        self._joined.createOrReplaceTempView("service_requests_enriched")

    @cached_property
    def enriched(self) -> DataFrame:
        return materialize(self._joined, "analytics-enriched")

    def mart(self, name: str) -> DataFrame:
        return MedallionLayers.mart(self, name)  # type: ignore[arg-type]


#: Figures of the marts that the analytics controls need.
MART_FIGURES = {
    **{n: {"closed": "closed_requests", "met": "sla_met_requests"} for n in MART_NAMES if n.startswith("sla_by_")},
    "daily_service_operations": {"total": "total_requests"},
    "sla_breach_details": {"not_closed": "int(status <> 'closed')", "not_positive": "int(resolution_overrun_minutes <= 0)"},
}


def write_analytics(spark: SparkSession, medallion_dir: str | Path, output_dir: str | Path) -> str:
    """Marts over published Gold tables, reconciled with the counts and KPIs
    that the medallion's manifest recorded, and published."""
    published = published_medallion(spark, medallion_dir)
    recorded = published.manifest
    gold = GoldTables(published)
    run = Run(spark, output_dir, ANALYTICS)
    for name in MART_NAMES:
        written = run.write(name, in_order(gold.mart(name), name), name, MART_FIGURES.get(name))
        if name in ("sla_by_team", "sla_by_category", "sla_by_priority"):
            run.write_csv(in_order(written, name), f"{name}_csv")
    kpi, of = recorded["kpis"], run.figure
    closed, met = kpi.get("closed_requests") or 0, kpi.get("sla_met_requests") or 0
    team_closed = of("sla_by_team", "closed")
    checks = [
        ("enriched_equals_gold_fact", of("service_requests_enriched"), recorded["row_counts"]["gold_fact"]),
        ("breach_details_equals_global_breaches", of("sla_breach_details"), closed - met),
        *[(f"{k}_closed_reconciles", of(f"sla_by_{k}", "closed"), closed) for k in ("team", "category", "priority", "team_category")],
        ("daily_requests_reconcile", of("daily_service_operations", "total"), kpi["total_requests"]),
        ("all_breach_rows_are_closed", of("sla_breach_details", "not_closed"), 0),
        ("all_breach_overruns_are_positive", of("sla_breach_details", "not_positive"), 0),
    ]
    rate = safe_rate(F.lit(of("sla_by_team", "met")), F.lit(team_closed))
    weighted = ctl.rows(spark.range(1), [("weighted_team_sla_equals_global", rate, F.lit(kpi["sla_compliance_rate"]))])
    passed = run.check(checks, "Analytics", weighted)
    manifest = {
        "analytics_version": ANALYTICS_VERSION,
        "source_ingestion_batch_id": recorded["ingestion_batch_id"],
        "source_run": recorded["run"],
        "row_counts": run.row_counts(),
        "controls": passed,
        "global_kpis": {
            k: kpi.get(k)
            for k in [
                "total_requests",
                "closed_requests",
                "sla_met_requests",
                "sla_compliance_rate",
                "reopened_requests",
                "reopen_rate",
                "escalated_requests",
                "escalation_rate",
                "open_backlog",
                "open_backlog_rate",
            ]
        }
        | {"sla_breaches": closed - met},
    }
    return run.publish(manifest)


def run_analytics(spark: SparkSession, medallion_dir: str, output_dir: str) -> str:
    prepare_session(spark)
    with scratch(spark):
        return write_analytics(spark, medallion_dir, output_dir)


# --------------------------------------------------------------------------- process intelligence (B6)


#: Figures of the case table for the manifest.
CASE_FIGURES = {
    "closed": "int(status = 'closed')",
    "open": "int(status = 'open')",
    "escalated": "int(escalated_case)",
    "reopened": "int(reopened_count > 0)",
    "reopen_occurrences": "reopened_count",
}


def write_process_intelligence(layers: MedallionLayers, output_dir: str | Path) -> str:
    """Stage the process tables, check the staged event log and cases against
    the accepted requests, and publish them."""
    L, spark = layers, layers.bronze.sparkSession
    process.check_process_source(L.silver_valid)
    require_rows(L.silver_valid, NO_CASES)
    refuse_forbidden({"event_log": L.event_log, "process_cases": L.cases}, L.contract)
    run = Run(spark, output_dir, PROCESS)

    def stage(name: str, df: DataFrame, single: bool = True) -> DataFrame:
        written = run.write(name, in_order(df, name), name, CASE_FIGURES if name == "process_cases" else None)
        run.write_csv(in_order(written, name), f"{name}_csv", single)
        return written

    checked = copy.copy(L)  # the controls read what has been staged
    checked.__dict__["event_log"] = stage("event_log", L.event_log, single=False)
    checked.__dict__["cases"] = stage("process_cases", L.cases, single=False)
    passed = run.check([], "Process-intelligence", process_controls(checked))
    stage("process_variants", process.variants(checked.cases))
    transitions = stage("transition_performance", L.transitions)
    stage("exception_paths", process.exception_paths(checked.cases))
    stage("bottlenecks", process.bottlenecks(transitions))
    rows = run.row_counts()
    manifest = {
        "process_intelligence_version": PROCESS_VERSION,
        "event_origin": EVENT_ORIGIN,
        "interpretation_boundary": PROCESS_BOUNDARY,
        "row_counts": {
            "cases": rows["process_cases"],
            "events": rows["event_log"],
            "variants": rows["process_variants"],
            "transitions": rows["transition_performance"],
            "bottlenecks": rows["bottlenecks"],
            "exception_paths": rows["exception_paths"],
        },
        "case_counts": {k: int(run.figure("process_cases", k)) for k in CASE_FIGURES},
        "controls": passed,
    }
    return run.publish(manifest)


def run_process_intelligence(spark: SparkSession, input_path: str, output_dir: str, contract: dict[str, Any] | None = None) -> str:
    """Process outputs of CSV files, whose medallion must pass its controls
    first."""
    prepare_session(spark)
    with scratch(spark):
        layers = MedallionLayers(bronze_from_csv(spark, input_path), contract)
        ctl.gate(medallion_controls(layers), "Medallion")
        return write_process_intelligence(layers, output_dir)


def run_process_of_medallion(
    spark: SparkSession, medallion_dir: str, output_dir: str, contract: dict[str, Any] | None = None
) -> str:
    """Process outputs of a published medallion, whose recorded controls must
    all have passed and whose accepted requests must be as many as recorded."""
    prepare_session(spark)
    published = published_medallion(spark, medallion_dir)
    recorded = published.manifest
    with scratch(spark):
        layers = MedallionLayers.of_tables(published.table("bronze"), published.table("silver_valid"), contract)
        bad = sorted(name for name, ok in recorded["controls"].items() if not ok)
        if layers.silver_valid.count() != recorded["row_counts"]["silver_valid"]:
            bad.append("silver_valid_as_recorded")
        if bad or not recorded["controls"]:
            raise ValueError(f"Medallion reconciliation controls failed: {', '.join(bad) or 'none recorded'}")
        return write_process_intelligence(layers, output_dir)
