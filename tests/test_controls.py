import copy

import pytest
from pyspark.sql import functions as F

from fixtures import VALID_CLOSED, VALID_OPEN, bronze_rows
from slaflow.operators import controls as ctl
from slaflow.operators.ordinal import materialize
from slaflow.plans.layers import MedallionLayers, analytics_controls, medallion_controls, process_controls

ROWS = [VALID_CLOSED, VALID_OPEN, VALID_CLOSED | {"ticket_id": "SR-000003", "resolution_minutes": "900", "closed_at": "2026-05-01T23:00:00Z"}]


def fresh(spark):
    return MedallionLayers(bronze_rows(spark, ROWS))


def test_all_controls_pass_on_clean_input(spark):
    L = fresh(spark)
    for build in (medallion_controls, analytics_controls, process_controls):
        rows = build(L).collect()
        assert rows and all(r["passed"] for r in rows), [r for r in rows if not r["passed"]]


def test_missing_fact_row_fails_medallion_gate(spark):
    L = fresh(spark)
    L.__dict__["fact"] = L.fact.where(F.col("ticket_id") != "SR-000003")
    with pytest.raises(ValueError, match="valid_equals_fact"):
        ctl.gate(medallion_controls(L), "Medallion")


def test_unresolved_key_fails_the_fact(spark):
    L = fresh(spark)
    L.__dict__["dim_team"] = L.dim_team.where(F.col("assigned_team") != "service_desk")
    with pytest.raises(Exception, match="unresolved foreign key values in team_key"):
        L.fact.count()


def _change(layer, edit):
    def broken(L):
        changed = edit(getattr(L, layer))
        L.__dict__[layer] = changed

    return broken


def _mart(name, edit):
    def broken(L):
        whole = MedallionLayers.mart
        L.mart = lambda n: edit(whole(L, n)) if n == name else whole(L, n)

    return broken


def _set(column, value, where="true"):
    """A column set to a SQL expression where a condition holds."""
    return lambda df: df.withColumn(column, F.expr(f"CASE WHEN {where} THEN {value} ELSE {column} END"))


BAD_ROW = VALID_CLOSED | {"ticket_id": "SR-000009", "priority": "P9"}
BROKEN = [
    (medallion_controls, "bronze_equals_valid_plus_rejected", _change("silver_rejected", lambda df: df.limit(0))),
    (medallion_controls, "valid_equals_fact", _change("fact", lambda df: df.where("ticket_id <> 'SR-000003'"))),
    (medallion_controls, "foreign_keys_complete", _change("fact", _set("team_key", "99L"))),
    (analytics_controls, "enriched_equals_gold_fact", _change("enriched", lambda df: df.where("status = 'closed'"))),
    (analytics_controls, "breach_details_equals_global_breaches", _mart("sla_breach_details", lambda df: df.limit(0))),
    (analytics_controls, "team_closed_reconciles", _mart("sla_by_team", _set("closed_requests", "7"))),
    (analytics_controls, "category_closed_reconciles", _mart("sla_by_category", _set("closed_requests", "7"))),
    (analytics_controls, "priority_closed_reconciles", _mart("sla_by_priority", _set("closed_requests", "7"))),
    (analytics_controls, "team_category_closed_reconciles", _mart("sla_by_team_category", _set("closed_requests", "7"))),
    (analytics_controls, "daily_requests_reconcile", _mart("daily_service_operations", _set("total_requests", "1"))),
    (analytics_controls, "weighted_team_sla_equals_global", _mart("sla_by_team", _set("sla_met_requests", "2"))),
    (analytics_controls, "all_breach_rows_are_closed", _mart("sla_breach_details", _set("status", "'open'"))),
    (analytics_controls, "all_breach_overruns_are_positive", _mart("sla_breach_details", _set("resolution_overrun_minutes", "0"))),
    (process_controls, "case_count_matches_valid_source", _change("cases", lambda df: df.where("case_id <> 'SR-000003'"))),
    (process_controls, "case_count_matches_valid_source", _change("cases", _set("process_variant", "'other'", "status = 'closed'"))),
    (process_controls, "case_count_matches_valid_source", _change("cases", lambda df: df.unionByName(df))),
    (process_controls, "event_ids_unique", _change("event_log", _set("event_id", "'same'"))),
    (process_controls, "event_indexes_contiguous", _change("event_log", _set("event_index", "event_index + 1"))),
    (process_controls, "event_timestamps_monotonic", _change("event_log", _set("event_timestamp", "timestamp'2001-01-01'", "event_index = 2"))),
    (process_controls, "first_activity_is_ticket_created", _change("event_log", _set("activity", "'x'", "event_index = 1"))),
    (process_controls, "closed_cases_end_with_ticket_closed", _change("event_log", _set("activity", "'x'", "activity = 'ticket_closed'"))),
    (process_controls, "open_cases_do_not_end_with_ticket_closed", _change("event_log", _set("activity", "'ticket_closed'", "status = 'open'"))),
    (process_controls, "reopened_events_reconcile", _change("event_log", _set("activity", "'reopened'", "event_index = 2"))),
    (process_controls, "escalation_events_reconcile", _change("event_log", _set("activity", "'escalated'", "event_index = 2"))),
    (process_controls, "closed_throughput_matches_source", _change("cases", _set("throughput_minutes", "1.0D"))),
]


@pytest.fixture(scope="module")
def whole(spark):
    """Layers that are written once; each test breaks a copy."""
    L = MedallionLayers(bronze_rows(spark, [*ROWS, BAD_ROW]))
    L.__dict__["bronze"] = materialize(L.bronze, "bronze")
    for name in ("silver_valid", "silver_rejected", "cases", "event_log", "kpis"):
        L.__dict__[name] = materialize(getattr(L, name), name)
    assert L.enriched and L.lifecycle
    return L


@pytest.mark.parametrize("k", range(len(BROKEN)), ids=[b[1] for b in BROKEN])
def test_every_control_fails_when_broken(whole, k):
    build, name, breaks = BROKEN[k]
    L = copy.copy(whole)
    breaks(L)
    with pytest.raises(ValueError, match=name):
        ctl.gate(build(L), "Test")


def test_a_control_without_a_verdict_has_failed(spark):
    one = spark.range(1)
    rows = ctl.rows(one, [("unknown", F.lit(None), F.lit(1)), ("both", F.lit(None), F.lit(None)), ("fine", F.lit(1), F.lit(1))])
    with pytest.raises(ValueError, match="both, unknown"):
        ctl.gate(rows, "Test")


def test_duplicated_event_fails_process_gate(spark):
    L = fresh(spark)
    log = L.event_log
    L.__dict__["event_log"] = log.unionByName(log.where(F.col("event_index") == 1))
    with pytest.raises(ValueError, match="event_ids_unique"):
        ctl.gate(process_controls(L), "Process-intelligence")


def test_breach_list_drift_fails_analytics_gate(spark):
    L = fresh(spark)
    L.__dict__["enriched"] = L.enriched.where(F.col("ticket_id") != "SR-000003")
    failed = {r["control"] for r in analytics_controls(L).collect() if not r["passed"]}
    assert {"enriched_equals_gold_fact", "breach_details_equals_global_breaches"} <= failed


def test_grouping_sets_equal_individual_marts_and_weighted_rate(spark):
    from slaflow.operators import metrics

    rows = ROWS + [
        VALID_CLOSED | {"ticket_id": "SR-000004", "assigned_team": "workplace", "category": "network", "priority": "P3", "sla_target_minutes": "1440", "resolution_minutes": "2000", "closed_at": "2026-05-02T17:20:00Z"},
        VALID_CLOSED | {"ticket_id": "SR-000005", "assigned_team": "workplace", "escalated": "true", "reopened_count": "1"},
    ]
    L = MedallionLayers(bronze_rows(spark, rows))
    sets = metrics.sla_grouping_sets(L.enriched, [["assigned_team"], ["category"], ["priority"], ["assigned_team", "category"]])
    for mart, keys in [("sla_by_team", ["assigned_team"]), ("sla_by_category", ["category"]), ("sla_by_priority", ["priority"])]:
        single = {tuple(r[k] for k in keys): r.asDict() for r in L.mart(mart).collect()}
        grouped = {tuple(r[k] for k in keys): r.asDict() for r in sets.where(F.col("mart") == mart).collect()}
        assert single.keys() == grouped.keys()
        for key, row in single.items():
            assert {c: grouped[key][c] for c in row} == row
    rate = metrics.weighted_rate(L.mart("sla_by_team"), "sla_met_requests", "closed_requests").first()["weighted_rate"]
    assert rate == L.kpis.first()["sla_compliance_rate"]
