"""Hand-written request rows for rule-level tests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from slaflow.sources.requests import REQUEST_COLUMNS

VALID_CLOSED = {
    "ticket_id": "SR-000001",
    "created_at": "2026-05-01T08:00:00Z",
    "closed_at": "2026-05-01T10:00:00Z",
    "priority": "P2",
    "category": "access",
    "assigned_team": "service_desk",
    "status": "closed",
    "sla_target_minutes": "480",
    "resolution_minutes": "120",
    "reopened_count": "0",
    "escalated": "false",
    "customer_segment": "smb",
    "source_system": "service_portal",
}
VALID_OPEN = VALID_CLOSED | {"ticket_id": "SR-000002", "status": "open", "closed_at": "", "resolution_minutes": ""}


def bronze_rows(spark: SparkSession, rows: list[dict]) -> DataFrame:
    data = [
        (i + 2, *[r[c] for c in REQUEST_COLUMNS], "fixture.csv", "0" * 16, "2026-07-29T00:00:00Z")
        for i, r in enumerate(rows)
    ]
    schema = "source_row long, " + ", ".join(f"{c} string" for c in REQUEST_COLUMNS) + (
        ", source_file string, ingestion_batch_id string, ingested_at_utc string"
    )
    return spark.createDataFrame(data, schema)
