import pytest

from fixtures import VALID_CLOSED, VALID_OPEN, bronze_rows
from slaflow.contract import default_contract
from slaflow.operators import quarantine, validation
from slaflow.sources.requests import REQUEST_COLUMNS

CASES = [
    ({}, set()),
    ({"status": " closed ", "priority": " P2"}, set()),
    ({"escalated": "TRUE"}, set()),
    ({"closed_at": "2026-05-01T08:00:00Z"}, set()),  # closed == created is legal
    ({"ticket_id": ""}, {"missing_required_value"}),
    ({"ticket_id": "SR-12"}, {"invalid_ticket_id_format"}),
    ({"ticket_id": "SR-1234567"}, {"invalid_ticket_id_format"}),
    ({"created_at": ""}, {"missing_required_value"}),
    ({"created_at": "2026/05/01"}, {"invalid_created_at"}),
    ({"created_at": " 2026-05-01T08:00:00Z"}, {"invalid_created_at"}),
    ({"created_at": "2026-02-30T08:00:00Z"}, {"invalid_created_at"}),
    ({"closed_at": "yesterday"}, {"invalid_closed_at"}),
    ({"priority": "P5"}, {"invalid_priority"}),
    ({"priority": ""}, {"missing_required_value"}),
    ({"category": "printer"}, {"invalid_category"}),
    ({"assigned_team": "unknown_team"}, {"invalid_assigned_team"}),
    ({"status": "pending"}, {"invalid_status"}),
    ({"customer_segment": "government"}, {"invalid_customer_segment"}),
    ({"source_system": "email"}, {"invalid_source_system"}),
    ({"sla_target_minutes": "abc"}, {"invalid_sla_target_minutes_type"}),
    ({"sla_target_minutes": "999"}, {"sla_priority_mismatch"}),
    ({"sla_target_minutes": "0"}, {"invalid_sla_target_range", "sla_priority_mismatch"}),
    ({"sla_target_minutes": "480.5"}, {"invalid_sla_target_minutes_type", "sla_priority_mismatch"}),
    ({"resolution_minutes": "-5"}, {"negative_resolution_minutes"}),
    ({"resolution_minutes": "abc"}, {"invalid_resolution_minutes_type", "closed_missing_resolution_minutes"}),
    ({"resolution_minutes": ""}, {"closed_missing_resolution_minutes"}),
    ({"reopened_count": "9"}, {"invalid_reopened_count_range"}),
    ({"reopened_count": "-1"}, {"invalid_reopened_count_range"}),
    ({"reopened_count": "x"}, {"invalid_reopened_count_type"}),
    ({"reopened_count": "nan"}, {"invalid_reopened_count_type"}),
    ({"reopened_count": ""}, {"missing_required_value"}),
    ({"escalated": "maybe"}, {"invalid_escalated"}),
    ({"closed_at": ""}, {"closed_missing_closed_at"}),
    ({"closed_at": "2026-05-01T07:45:00Z"}, {"closed_before_created"}),
]


@pytest.fixture(scope="module")
def single_rule_issues(spark):
    """All cases validated in one job: case i is source row i + 2 with its own id."""
    rows = []
    for i, (overrides, _) in enumerate(CASES):
        row = VALID_CLOSED | {"ticket_id": f"SR-{100000 + i}"} | overrides
        rows.append(row)
    contract = default_contract()
    issues = validation.issue_table(validation.annotate(bronze_rows(spark, rows), contract), contract).collect()
    by_row: dict[int, set[str]] = {}
    for r in issues:
        by_row.setdefault(r["source_row"], set()).add(r["issue_code"])
    return by_row


@pytest.mark.parametrize("case", range(len(CASES)))
def test_single_rule(single_rule_issues, case):
    overrides, expected = CASES[case]
    assert single_rule_issues.get(case + 2, set()) == expected, overrides


def test_open_rules(spark):
    rows = [
        VALID_OPEN,
        VALID_OPEN | {"ticket_id": "SR-000003", "closed_at": "2026-05-01T10:00:00Z"},
        VALID_OPEN | {"ticket_id": "SR-000004", "resolution_minutes": "12"},
    ]
    contract = default_contract()
    issues = validation.issue_table(validation.annotate(bronze_rows(spark, rows), contract), contract).collect()
    assert sorted((r["source_row"], r["issue_code"]) for r in issues) == [
        (3, "open_has_closed_at"),
        (4, "open_has_resolution_minutes"),
    ]


def test_duplicates_reject_every_occurrence_but_not_blanks(spark):
    rows = [VALID_CLOSED, VALID_CLOSED | {"ticket_id": " SR-000001"}, VALID_CLOSED | {"ticket_id": ""}, VALID_CLOSED | {"ticket_id": ""}]
    contract = default_contract()
    issues = validation.issue_table(validation.annotate(bronze_rows(spark, rows), contract), contract).collect()
    dup = sorted(r["source_row"] for r in issues if r["issue_code"] == "duplicate_ticket_id")
    assert dup == [2, 3]
    assert sorted(r["observed_value"] for r in issues if r["issue_code"] == "duplicate_ticket_id") == [" SR-000001", "SR-000001"]


def test_multi_issue_row_and_rejection_summary(spark):
    bad = VALID_CLOSED | {"priority": "P5", "escalated": "maybe", "resolution_minutes": "-5", "category": ""}
    contract = default_contract()
    annotated = validation.annotate(bronze_rows(spark, [bad, VALID_OPEN]), contract)
    issues = validation.issue_table(annotated, contract).orderBy("source_row", "issue_code", "issue_position").collect()
    assert [r["issue_code"] for r in issues] == [
        "invalid_escalated",
        "invalid_priority",
        "missing_required_value",
        "negative_resolution_minutes",
    ]
    rejected = quarantine.rejected(annotated, ["source_row", *REQUEST_COLUMNS], contract).collect()
    assert len(rejected) == 1
    assert rejected[0]["issue_count"] == 4
    assert rejected[0]["rejection_reasons"] == "invalid_escalated|invalid_priority|missing_required_value|negative_resolution_minutes"
    valid = quarantine.type_accepted(quarantine.accepted(annotated), contract).collect()
    assert [r["ticket_id"] for r in valid] == ["SR-000002"]
    assert valid[0]["sla_met"] is None


def test_typing_and_sla_met(spark):
    rows = [VALID_CLOSED, VALID_CLOSED | {"ticket_id": "SR-000009", "resolution_minutes": "481", "closed_at": "2026-05-01T16:01:00Z"}]
    contract = default_contract()
    typed = quarantine.type_accepted(quarantine.accepted(validation.annotate(bronze_rows(spark, rows), contract)), contract)
    got = {r["ticket_id"]: r for r in typed.collect()}
    assert got["SR-000001"]["sla_met"] is True and got["SR-000009"]["sla_met"] is False
    assert got["SR-000001"]["resolution_minutes"] == 120 and got["SR-000001"]["escalated"] is False


def test_missing_column_fails_fast(spark):
    df = bronze_rows(spark, [VALID_CLOSED]).drop("category")
    with pytest.raises(ValueError, match="missing required columns: category"):
        validation.annotate(df, default_contract())


def test_report_and_expectation_gate(spark):
    rows = [VALID_CLOSED, VALID_OPEN, VALID_CLOSED | {"ticket_id": "SR-000007", "priority": "P9"}]
    contract = default_contract()
    report = validation.validation_report(validation.annotate(bronze_rows(spark, rows), contract), contract)
    assert report == {
        "total_rows": 3,
        "valid_rows": 2,
        "invalid_rows": 1,
        "valid_rate": 0.6667,
        "issue_counts": {"invalid_priority": 1},
    }
    assert validation.expectation_gate(report, 3, 1)
    assert not validation.expectation_gate(report, 3, 0)
    assert not validation.expectation_gate(report)


def test_forbidden_columns(spark):
    df = bronze_rows(spark, [VALID_CLOSED]).withColumnRenamed("source_file", "email")
    assert validation.forbidden_columns_present(df, default_contract()) == ["email"]


def test_a_timestamp_is_parsed_once(spark):
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    try:
        plan = validation.annotate(bronze_rows(spark, [VALID_CLOSED]), default_contract())._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.debug.maxToStringFields")
    assert plan.count("gettimestamp") == 2  # one for each timestamp column
