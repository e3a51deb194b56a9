"""The service-request data contract.

The contract is plain data on the driver; operators turn it into column
expressions.  ``SERVICE_REQUEST_CONTRACT`` holds the fixed values the
results depend on (domains, pattern, SLA mapping, timestamp format).
"""

from __future__ import annotations

import copy
import json
from pathlib import Path
from typing import Any

# ---------------------------------------------------------------------------
# Fixed values (must equal the published contract for identical results):
# column order, nullability, domains, ticket pattern, timestamp format,
# SLA target per priority, priority order, KPI design ranges, forbidden
# (personal-data) column names, ingestion timestamp and event origin label.
# ---------------------------------------------------------------------------
SERVICE_REQUEST_CONTRACT: dict[str, Any] = {
    "primary_key": ["ticket_id"],
    "timestamp_format": "%Y-%m-%dT%H:%M:%SZ",
    "columns": [
        {"name": "ticket_id", "type": "string", "nullable": False, "unique": True, "pattern": r"^SR-\d{6}$"},
        {"name": "created_at", "type": "datetime", "nullable": False},
        {"name": "closed_at", "type": "datetime", "nullable": True},
        {"name": "priority", "type": "string", "nullable": False, "allowed_values": ["P1", "P2", "P3", "P4"]},
        {
            "name": "category",
            "type": "string",
            "nullable": False,
            "allowed_values": ["access", "application", "hardware", "network", "reporting"],
        },
        {
            "name": "assigned_team",
            "type": "string",
            "nullable": False,
            "allowed_values": ["business_apps", "data_platform", "network_ops", "service_desk", "workplace"],
        },
        {"name": "status", "type": "string", "nullable": False, "allowed_values": ["closed", "open"]},
        {"name": "sla_target_minutes", "type": "integer", "nullable": False, "minimum": 1},
        {"name": "resolution_minutes", "type": "integer", "nullable": True, "minimum": 0},
        {"name": "reopened_count", "type": "integer", "nullable": False, "minimum": 0, "maximum": 5},
        {"name": "escalated", "type": "boolean", "nullable": False},
        {
            "name": "customer_segment",
            "type": "string",
            "nullable": False,
            "allowed_values": ["enterprise", "internal", "smb"],
        },
        {"name": "source_system", "type": "string", "nullable": False, "allowed_values": ["service_portal"]},
    ],
    "business_rules": {
        "sla_target_by_priority": {"P1": 240, "P2": 480, "P3": 1440, "P4": 2880},
        "closed_status_requires": ["closed_at", "resolution_minutes"],
        "open_status_requires_null": ["closed_at", "resolution_minutes"],
        "closed_at_not_before_created_at": True,
    },
    "scenario": {
        "kpi_design_ranges": {
            "sla_compliance_rate": [0.93, 0.96],
            "reopen_rate": [0.05, 0.09],
            "escalation_rate": [0.07, 0.12],
            "open_backlog_rate": [0.1, 0.18],
        }
    },
    "safety": {
        "forbidden_columns": ["name", "email", "phone", "address", "customer_name", "user_name"],
    },
}

PRIORITY_ORDER = ["P1", "P2", "P3", "P4"]
DEFAULT_INGESTED_AT = "2026-07-29T00:00:00Z"
EVENT_ORIGIN = "derived_synthetic_scenario"
BOTTLENECK_BOUNDARY = "Derived synthetic waiting time; concentration signal, not causal root cause."
MIN_BOTTLENECK_CASES = 10
# --------------------------------------------------------------------------- end of fixed values

REQUIRED_CONTRACT_KEYS = ("columns", "timestamp_format", "business_rules")


def default_contract() -> dict[str, Any]:
    return copy.deepcopy(SERVICE_REQUEST_CONTRACT)


def load_contract(path: str | Path) -> dict[str, Any]:
    """Read a JSON contract and check that the keys the validator needs exist."""
    contract = json.loads(Path(path).read_text(encoding="utf-8"))
    missing = [key for key in REQUIRED_CONTRACT_KEYS if key not in contract]
    if missing:
        raise ValueError(f"Contract is missing required keys: {', '.join(missing)}")
    return contract


def column_names(contract: dict[str, Any]) -> list[str]:
    return [column["name"] for column in contract["columns"]]


def column_spec(contract: dict[str, Any]) -> dict[str, dict[str, Any]]:
    return {column["name"]: column for column in contract["columns"]}


def integer_columns(contract: dict[str, Any]) -> list[str]:
    return [c["name"] for c in contract["columns"] if c.get("type") == "integer"]


def java_timestamp_pattern(strftime_format: str) -> str:
    """Translate the contract's strftime format to a Spark datetime pattern."""
    out = []
    i = 0
    mapping = {"Y": "yyyy", "m": "MM", "d": "dd", "H": "HH", "M": "mm", "S": "ss"}
    while i < len(strftime_format):
        ch = strftime_format[i]
        if ch == "%" and i + 1 < len(strftime_format):
            code = strftime_format[i + 1]
            if code not in mapping:
                raise ValueError(f"Unsupported timestamp directive %{code}")
            out.append(mapping[code])
            i += 2
            continue
        if ch.isalpha():
            out.append(f"'{ch}'")
        else:
            out.append(ch)
        i += 1
    return "".join(out)
