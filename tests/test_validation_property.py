"""Property test: the Spark validator against a plain-Python brute force of
the contract rules on random rows (mixed valid, invalid, padded, blank and
duplicated values)."""

from __future__ import annotations

import datetime as dt
import math
import random
import re

import pytest

from fixtures import bronze_rows
from slaflow.contract import column_spec, default_contract
from slaflow.operators import quarantine, validation
from slaflow.sources.requests import REQUEST_COLUMNS

C = default_contract()
SPEC = column_spec(C)

POOLS = {
    "ticket_id": [f"SR-{i:06d}" for i in range(1, 60)] + ["SR-12", "", " SR-000003", "XX-1", "SR-0000001"],
    "created_at": ["2026-05-01T08:00:00Z", "2026-05-02T23:59:59Z", "", "2026/05/01", " 2026-05-01T09:00:00Z", "2026-02-30T08:00:00Z", "2026-05-01T08:00:00"],
    "closed_at": ["2026-05-01T10:00:00Z", "2026-05-01T07:00:00Z", "2026-05-01T08:00:00Z", "", " 2026-05-03T09:00:00Z ", "bad"],
    "priority": ["P1", "P2", "P3", "P4", "P5", "", " P2"],
    "category": ["access", "application", "hardware", "network", "reporting", "", "printer", " network"],
    "assigned_team": ["business_apps", "data_platform", "network_ops", "service_desk", "workplace", "", "unknown_team"],
    "status": ["closed", "open", " closed", "Closed", "", "pending"],
    "sla_target_minutes": ["240", "480", "1440", "2880", "999", "0", "", "abc", "480.0", "1.5", "nan", "Infinity", " 1440 "],
    "resolution_minutes": ["", "0", "5", "-5", "120", "abc", "1e3", "7.5", "\t30"],
    "reopened_count": ["0", "1", "2", "5", "6", "-1", "", "x", "2.0", "nan"],
    "escalated": ["true", "false", "TRUE", " false", "maybe", ""],
    "customer_segment": ["enterprise", "internal", "smb", "", "government"],
    "source_system": ["service_portal", "", "email", "service_portal "],
}
TS = re.compile(r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z\Z")


def _ts(text: str):
    if not TS.match(text):
        return None
    try:
        return dt.datetime.strptime(text, "%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return None


def _num(text: str):
    if text == "":
        return None
    try:
        n = float(text)
    except ValueError:
        return None
    return None if math.isnan(n) else n


def brute_force(rows: list[dict]) -> list[list[str]]:
    """Issue codes per row, in rule order, straight from the contract text."""
    ids = [r["ticket_id"].strip() for r in rows]
    counts = {i: ids.count(i) for i in ids}
    out = []
    for r in rows:
        t = {c: r[c].strip() for c in REQUEST_COLUMNS}
        codes = []
        for name, d in SPEC.items():
            if not d.get("nullable", True) and t[name] == "":
                codes.append("missing_required_value")
            if d.get("allowed_values") and t[name] not in d["allowed_values"] and t[name] != "":
                codes.append(f"invalid_{name}")
        if t["ticket_id"] != "" and not re.fullmatch(r"SR-[0-9]{6}", t["ticket_id"]):
            codes.append("invalid_ticket_id_format")
        if t["ticket_id"] != "" and counts[t["ticket_id"]] > 1:
            codes.append("duplicate_ticket_id")
        created = _ts(r["created_at"]) if t["created_at"] else None
        closed = _ts(t["closed_at"]) if t["closed_at"] else None
        if created is None and t["created_at"] != "":
            codes.append("invalid_created_at")
        if closed is None and t["closed_at"] != "":
            codes.append("invalid_closed_at")
        n = {c: _num(t[c]) for c in ("sla_target_minutes", "resolution_minutes", "reopened_count")}
        for c, v in n.items():
            if t[c] != "" and not (v is not None and math.isfinite(v) and v == math.floor(v)):
                codes.append(f"invalid_{c}_type")
        if n["sla_target_minutes"] is not None and n["sla_target_minutes"] < 1:
            codes.append("invalid_sla_target_range")
        if n["resolution_minutes"] is not None and n["resolution_minutes"] < 0:
            codes.append("negative_resolution_minutes")
        if n["reopened_count"] is not None and not (0 <= n["reopened_count"] <= 5):
            codes.append("invalid_reopened_count_range")
        if t["escalated"].lower() not in ("true", "false") and t["escalated"] != "":
            codes.append("invalid_escalated")
        expected = C["business_rules"]["sla_target_by_priority"].get(t["priority"])
        if expected is not None and n["sla_target_minutes"] is not None and n["sla_target_minutes"] != expected:
            codes.append("sla_priority_mismatch")
        is_closed, is_open = t["status"] == "closed", t["status"] == "open"
        if is_closed and t["closed_at"] == "":
            codes.append("closed_missing_closed_at")
        if is_closed and n["resolution_minutes"] is None:
            codes.append("closed_missing_resolution_minutes")
        if is_open and t["closed_at"] != "":
            codes.append("open_has_closed_at")
        if is_open and n["resolution_minutes"] is not None:
            codes.append("open_has_resolution_minutes")
        if is_closed and created and closed and closed < created:
            codes.append("closed_before_created")
        out.append(codes)
    return out


@pytest.fixture(scope="module")
def random_rows():
    rng = random.Random(20261203)
    rows = []
    for _ in range(400):
        # mostly plausible rows, each column replaced by a random pool value with some probability
        base = {c: POOLS[c][0] for c in REQUEST_COLUMNS}
        base["ticket_id"] = rng.choice(POOLS["ticket_id"])
        for c in REQUEST_COLUMNS:
            if c != "ticket_id" and rng.random() < 0.35:
                base[c] = rng.choice(POOLS[c])
        rows.append(base)
    return rows


def test_validator_matches_brute_force(spark, random_rows):
    annotated = validation.annotate(bronze_rows(spark, random_rows), C)
    issues = validation.issue_table(annotated, C).collect()
    got: dict[int, list[tuple[int, str]]] = {}
    for r in issues:
        got.setdefault(r["source_row"], []).append((r["issue_position"], r["issue_code"]))
    expected = brute_force(random_rows)
    mismatches = []
    for i, codes in enumerate(expected):
        spark_codes = [code for _, code in sorted(got.get(i + 2, []))]
        if spark_codes != codes:
            mismatches.append((random_rows[i], codes, spark_codes))
    assert not mismatches, mismatches[:3]

    totals = validation.row_totals(annotated).first()
    invalid = sum(1 for codes in expected if codes)
    assert (totals["total_rows"], totals["invalid_rows"], totals["valid_rows"]) == (400, invalid, 400 - invalid)
    valid = quarantine.type_accepted(quarantine.accepted(annotated), C).count()
    rejected = quarantine.rejected(annotated, ["source_row", *REQUEST_COLUMNS], C).count()
    assert valid + rejected == 400 and rejected == invalid
