"""Lazy wiring of the layers for one request source.

``MedallionLayers`` holds the DataFrames of one run, built once and shared
so jobs and the query catalog compose the same plans.  Layer boundaries
read by several consumers (Bronze snapshot, annotated Silver, dimensions,
fact, enriched view, event log) are materialised once; everything else is
a lazy plan on top of them.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Callable
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.contract import default_contract
from slaflow.functions.numeric import safe_rate
from slaflow.operators import controls, metrics, process, quarantine, star, validation
from slaflow.operators.ordinal import materialize
from slaflow.session import session_key
from slaflow.sources.bronze import bronze_columns, bronze_requests
from slaflow.sources.requests import request_contract
from slaflow.sources.tables import read_table, table_version


#: Layers of a session by folder and version of the files they were made of;
#: the last few are kept.
_KEPT: OrderedDict[tuple, Any] = OrderedDict()
MAX_KEPT = 4


def shared(spark: SparkSession, sf_dir: str, names: tuple[str, ...], build: Callable[[], Any], what: str = "layers") -> Any:
    """What ``build`` makes of the tables, shared by the queries of a session
    until a file of the tables changes."""
    slot = (session_key(spark), what, sf_dir, names, table_version(spark, sf_dir, names))
    if slot not in _KEPT:
        _KEPT[slot] = build()
        while len(_KEPT) > MAX_KEPT:
            _KEPT.popitem(last=False)
    _KEPT.move_to_end(slot)
    return _KEPT[slot]


def forget_layers() -> None:
    """Let the next query build its layers anew."""
    _KEPT.clear()


class MedallionLayers:
    def __init__(self, bronze: DataFrame, contract: dict[str, Any] | None = None):
        self.bronze = bronze
        self.contract = contract or default_contract()

    @classmethod
    def of_tables(cls, bronze: DataFrame, silver_valid: DataFrame, contract: dict[str, Any] | None = None) -> MedallionLayers:
        """The layers of tables that are there already: accepted requests are
        read, not made again."""
        layers = cls(bronze, contract)
        layers.__dict__["silver_valid"] = silver_valid
        return layers

    @classmethod
    def for_requests(cls, spark: SparkSession, sf_dir: str) -> MedallionLayers:
        """The layers of the request source of ``sf_dir``, shared by the
        queries of the session (Bronze and Silver are materialised once)."""
        return shared(
            spark, sf_dir, ("orders", "customer"), lambda: cls(bronze_requests(spark, sf_dir), request_contract())
        )

    # ----------------------------------------------------------------- silver
    @cached_property
    def annotated(self) -> DataFrame:
        """Bronze + issue mask + parsed numbers/timestamps, materialised: the
        Silver boundary every later layer reads (three consumers: accepted,
        rejected, issues)."""
        annotated = validation.annotate(self.bronze, self.contract)
        # raw text + issue mask + parsed numbers/timestamps; trimmed copies of
        # the text are recomputed on read rather than written twice
        return materialize(annotated.drop(*validation.trimmed_helpers(self.contract)), "silver-annotated")

    @cached_property
    def lifecycle(self) -> DataFrame:
        """The accepted requests with their derived events, materialised: the
        event log, cases and transitions are all read from it."""
        process.check_process_source(self.silver_valid)
        return materialize(process.with_lifecycle(self.silver_valid), "lifecycle")

    @cached_property
    def issues(self) -> DataFrame:
        return validation.issue_table(self.annotated, self.contract)

    @cached_property
    def silver_valid(self) -> DataFrame:
        return quarantine.type_accepted(quarantine.accepted(self.annotated), self.contract)

    @cached_property
    def silver_rejected(self) -> DataFrame:
        return quarantine.rejected(self.annotated, [c for c in bronze_columns() if c in self.bronze.columns], self.contract)

    # ----------------------------------------------------------------- gold
    # Dimensions are small (contract domains, observed days) but read by the
    # fact, the enriched view, the FK checks and the controls: written once.
    @cached_property
    def dim_team(self) -> DataFrame:
        return materialize(star.string_dimension(self.silver_valid, "assigned_team", "team_key"), "gold-dim-team")

    @cached_property
    def dim_category(self) -> DataFrame:
        return materialize(star.string_dimension(self.silver_valid, "category", "category_key"), "gold-dim-category")

    @cached_property
    def dim_priority(self) -> DataFrame:
        return materialize(star.priority_dimension(self.silver_valid), "gold-dim-priority")

    @cached_property
    def dim_date(self) -> DataFrame:
        return materialize(star.date_dimension(self.silver_valid), "gold-dim-date")

    @cached_property
    def fact(self) -> DataFrame:
        """Gold fact, materialised (read by the marts, controls and FK checks)."""
        return materialize(star.fact_table(self.silver_valid, self.dim_team, self.dim_category, self.dim_priority), "gold-fact")

    @cached_property
    def kpis(self) -> DataFrame:
        return metrics.kpis(self.silver_valid)

    @cached_property
    def fk_violations(self) -> DataFrame:
        return star.foreign_key_violations(self.fact, self.dim_date, self.dim_team, self.dim_category, self.dim_priority)

    # ----------------------------------------------------------------- analytics
    @cached_property
    def enriched(self) -> DataFrame:
        """Denormalised fact, materialised once: seven marts and the analytics
        controls read it."""
        return materialize(
            metrics.enriched(self.fact, self.dim_date, self.dim_team, self.dim_category, self.dim_priority),
            "gold-enriched",
        )

    def mart(self, name: str) -> DataFrame:
        keys = {
            "sla_by_team": (["assigned_team"], True),
            "sla_by_category": (["category"], True),
            "sla_by_priority": (["priority"], True),
            "sla_by_team_category": (["assigned_team", "category"], False),
        }
        if name in keys:
            k, full = keys[name]
            return metrics.sla_mart(self.enriched, k, full)
        if name == "daily_service_operations":
            return metrics.daily_operations(self.enriched)
        if name == "sla_breach_details":
            return metrics.breach_details(self.enriched)
        if name == "service_requests_enriched":
            return self.enriched
        raise KeyError(name)

    # ----------------------------------------------------------------- process
    @cached_property
    def event_log(self) -> DataFrame:
        return process.event_log(self.lifecycle)

    @cached_property
    def cases(self) -> DataFrame:
        return process.cases(self.lifecycle)

    @cached_property
    def transitions(self) -> DataFrame:
        return process.transition_performance(process.derived_pairs(self.lifecycle))

    @cached_property
    def bottlenecks(self) -> DataFrame:
        return process.bottlenecks(self.transitions)

    def variants(self) -> DataFrame:
        return process.variants(self.cases)

    def exception_paths(self) -> DataFrame:
        return process.exception_paths(self.cases)


DAILY_CASE = ["user_id", "activity_date"]


class ObservedLog:
    """The ``events`` table read as a process log: one case per user (or per
    user and day), activity = event type, ordered by (ts, event_id)."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.events = read_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")

    @classmethod
    def for_events(cls, spark: SparkSession, sf_dir: str) -> ObservedLog:
        """Shared by the queries of a session (the events are numbered and
        their pairs materialised once)."""
        return shared(spark, sf_dir, ("events",), lambda: cls(spark, sf_dir))

    @cached_property
    def numbered(self) -> DataFrame:
        """Events with a global rank in (user, ts, event_id) order - shared by
        the successor pairs and the per-day cases (the day follows ts)."""
        return process.number_events(self.events, ["user_id"], ["ts", "event_id"], "event_type", "ts")

    @cached_property
    def pairs(self) -> DataFrame:
        return materialize(process.pairs_of_numbered(self.numbered, ["user_id"]), "observed-pairs")

    @cached_property
    def transitions(self) -> DataFrame:
        return process.transition_performance(self.pairs)

    def bottlenecks(self) -> DataFrame:
        return process.bottlenecks(self.transitions, boundary=process.OBSERVED_BOUNDARY)

    @cached_property
    def positioned(self) -> DataFrame:
        """Events with their position in their case of one user and day."""
        by_day = self.numbered.withColumn("activity_date", F.to_date("__t"))
        return materialize(process.numbered_in_case(by_day, DAILY_CASE), "observed-positions")

    @cached_property
    def daily_cases(self) -> DataFrame:
        return process.observed_cases(self.positioned, DAILY_CASE)

    def variants(self) -> DataFrame:
        return process.observed_variants(self.daily_cases)

    def variant_steps(self) -> DataFrame:
        return process.observed_variant_steps(self.positioned, self.daily_cases, DAILY_CASE)


# --------------------------------------------------------------------------- controls


def medallion_controls(L: MedallionLayers) -> DataFrame:
    m = controls.measures(
        {
            "bronze": (L.bronze, controls.one()),
            "valid": (L.silver_valid, controls.one()),
            "rejected": (L.silver_rejected, controls.one()),
            "fact": (L.fact, controls.one()),
            "fk_violations": (L.fk_violations, F.col("violations")),
        }
    )
    c = F.col
    return controls.rows(
        m,
        [
            ("bronze_equals_valid_plus_rejected", c("valid") + c("rejected"), c("bronze")),
            ("valid_equals_fact", c("fact"), c("valid")),
            ("foreign_keys_complete", c("fk_violations"), F.lit(0.0)),
        ],
    )


def analytics_controls(L: MedallionLayers, recorded: dict[str, Any] | None = None) -> DataFrame:
    """The marts against the Gold row count and KPIs: those of ``recorded``,
    a medallion manifest, or else of the layers themselves."""
    breaches = L.mart("sla_breach_details")
    team = L.mart("sla_by_team")
    closed = F.col("closed_requests")
    m = controls.measures(
        {
            "enriched": (L.enriched, controls.one()),
            "fact": (L.fact, controls.one()),
            "breach_rows": (breaches, controls.one()),
            "kpi_total": (L.kpis, F.col("total_requests")),
            "kpi_closed": (L.kpis, closed),
            "kpi_met": (L.kpis, F.col("sla_met_requests")),
            "kpi_rate": (L.kpis, F.col("sla_compliance_rate")),
            "team_closed": (team, closed),
            "team_met": (team, F.col("sla_met_requests")),
            "category_closed": (L.mart("sla_by_category"), closed),
            "priority_closed": (L.mart("sla_by_priority"), closed),
            "team_category_closed": (L.mart("sla_by_team_category"), closed),
            "daily_total": (L.mart("daily_service_operations"), F.col("total_requests")),
            "breach_not_closed": (breaches, controls.flag(F.col("status") != "closed")),
            "breach_not_positive": (breaches, controls.flag(F.col("resolution_overrun_minutes") <= 0)),
        }
    )
    if recorded:
        kpi = recorded["kpis"]
        m = m.withColumns(
            {
                "fact": F.lit(recorded["row_counts"]["gold_fact"]),
                "kpi_total": F.lit(kpi["total_requests"]),
                "kpi_closed": F.lit(kpi["closed_requests"]),
                "kpi_met": F.lit(kpi["sla_met_requests"]),
                "kpi_rate": F.lit(kpi["sla_compliance_rate"]),
            }
        )
    c = F.col
    return controls.rows(
        m,
        [
            ("enriched_equals_gold_fact", c("enriched"), c("fact")),
            ("breach_details_equals_global_breaches", c("breach_rows"), c("kpi_closed") - c("kpi_met")),
            ("team_closed_reconciles", c("team_closed"), c("kpi_closed")),
            ("category_closed_reconciles", c("category_closed"), c("kpi_closed")),
            ("priority_closed_reconciles", c("priority_closed"), c("kpi_closed")),
            ("team_category_closed_reconciles", c("team_category_closed"), c("kpi_closed")),
            ("daily_requests_reconcile", c("daily_total"), c("kpi_total")),
            ("weighted_team_sla_equals_global", safe_rate(c("team_met"), c("team_closed")), c("kpi_rate")),
            ("all_breach_rows_are_closed", c("breach_not_closed"), F.lit(0.0)),
            ("all_breach_overruns_are_positive", c("breach_not_positive"), F.lit(0.0)),
        ],
    )


def cases_by_id(log: DataFrame, cases: DataFrame, source: DataFrame) -> DataFrame:
    """One row for each case id of the event log, the case table and the
    accepted requests: a tagged union of narrow rows, aggregated once, so the
    three tables meet in one exchange and no join is needed.  A case has few
    events."""
    c = F.col
    event = F.struct("event_index", "activity", "event_timestamp")
    own_id = F.col("event_id").eqNullSafe(process.event_id(c("case_id"), c("event_index")))
    case = F.struct("status", "event_count", "first_event_at", "last_event_at", "process_variant", "throughput_minutes")
    request = F.struct(c("resolution_minutes").cast("double").alias("res"), "reopened_count", F.coalesce("escalated", F.lit(False)).alias("escalated"))
    parts = [
        log.select("case_id", event.alias("event"), "status", (~own_id).alias("foreign")),
        cases.select("case_id", case.alias("case")),
        source.select(c("ticket_id").alias("case_id"), request.alias("request")),
    ]
    rows = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return rows.groupBy("case_id").agg(
        F.sort_array(F.collect_list("event")).alias("events"), F.first("status", ignorenulls=True).alias("status"),
        F.count_if("foreign").alias("foreign"), F.count("case").alias("k"), F.max("case").alias("case"),
        F.max("request.res").alias("res"), F.count("request").alias("requests"),
        F.sum("request.reopened_count").alias("reopened_source"), F.count_if("request.escalated").alias("escalated_source"),
    )


def process_controls(L: MedallionLayers) -> DataFrame:
    """Controls of the event log and the case table.  A case counts if it is
    the only one of its id and agrees with its logged events.  The id of an
    event is made of its case and place, so ids are unique if each is that of
    its event and no place is taken twice in a case."""
    c = F.col
    by_id = cases_by_id(L.event_log, L.cases, L.silver_valid)
    events, case = c("events"), c("case")
    times, names = events["event_timestamp"], events["activity"]
    n = F.size(events)
    places = F.size(F.array_distinct(events["event_index"]))
    logged = n > 0
    last = F.element_at(names, -1)
    agrees = (
        (c("k") == 1) & (case["event_count"] == n) & (case["first_event_at"] == F.array_min(times))
        & (case["last_event_at"] == F.array_max(times)) & (case["process_variant"] == F.array_join(names, process.SEPARATOR))
    )
    broken = (F.array_min(events["event_index"]) != 1) | (F.array_max(events["event_index"]) != n) | (places != n)
    count_of = lambda name: F.size(F.filter(names, lambda a: a == name))
    per_case = {
        "cases": controls.flag(agrees),
        "valid": c("requests"),
        "reopened_source": c("reopened_source"),
        "escalated_source": c("escalated_source"),
        "extra_event_ids": c("foreign") + n - places,
        "non_contiguous": controls.flag(logged & broken),
        "backwards": controls.flag(times != F.sort_array(times)),
        "first_not_created": controls.flag(logged & (F.get(names, 0) != "ticket_created")),
        "closed_bad_end": controls.flag(logged & (c("status") == "closed") & (last != "ticket_closed")),
        "open_bad_end": controls.flag(logged & (c("status") == "open") & (last == "ticket_closed")),
        "reopened_events": count_of("reopened"),
        "escalated_events": count_of("escalated"),
        "throughput_mismatch": controls.flag((case["status"] == "closed") & ~case["throughput_minutes"].eqNullSafe(c("res"))),
    }
    m = controls.measures({name: (by_id, value) for name, value in per_case.items()})
    zero = F.lit(0.0)
    return controls.rows(
        m,
        [
            ("case_count_matches_valid_source", c("cases"), c("valid")),
            ("event_ids_unique", c("extra_event_ids"), zero),
            ("event_indexes_contiguous", c("non_contiguous"), zero),
            ("event_timestamps_monotonic", c("backwards"), zero),
            ("first_activity_is_ticket_created", c("first_not_created"), zero),
            ("closed_cases_end_with_ticket_closed", c("closed_bad_end"), zero),
            ("open_cases_do_not_end_with_ticket_closed", c("open_bad_end"), zero),
            ("reopened_events_reconcile", c("reopened_events"), c("reopened_source")),
            ("escalation_events_reconcile", c("escalated_events"), c("escalated_source")),
            ("closed_throughput_matches_source", c("throughput_mismatch"), zero),
        ],
    )
