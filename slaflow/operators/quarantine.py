"""Silver: split validated rows into typed accepted rows and auditable
rejections.  Both come from the same issue-annotated DataFrame
(``issue_mask = 0`` vs ``<> 0``), so the split needs no join."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slaflow.contract import column_spec
from slaflow.operators.validation import ISSUES, helper, is_valid, issue_codes, parsed_column_map

SILVER_METADATA = ["source_file", "ingestion_batch_id", "ingested_at_utc"]


def accepted(annotated: DataFrame) -> DataFrame:
    return annotated.where(is_valid()).drop(ISSUES)


def rejected(annotated: DataFrame, columns: list[str], contract: dict[str, Any]) -> DataFrame:
    """Rejected rows keep their raw text, plus the sorted distinct issue codes
    joined by ``|`` and the number of issues (not of distinct codes)."""
    codes = issue_codes(contract)
    return annotated.where(~is_valid()).select(
        *columns,
        F.array_join(F.array_sort(F.array_distinct(codes)), "|").alias("rejection_reasons"),
        F.bit_count(F.col(ISSUES)).cast("long").alias("issue_count"),
    )


def type_accepted(valid: DataFrame, contract: dict[str, Any], status_col: str = "status") -> DataFrame:
    """Type accepted text rows: timestamps (UTC), integers, booleans; domain
    text trimmed; ``sla_met`` = resolution <= target for closed rows, NULL
    for open ones.  Helper columns already on the frame (parsed numbers and
    timestamps of the annotated Silver snapshot) are reused; missing ones,
    such as the trimmed text the snapshot does not store, are computed."""
    spec = column_spec(contract)
    helpers = parsed_column_map(contract)

    def h(kind: str, name: str) -> Column:
        col = helper(kind, name)
        return F.col(col) if col in valid.columns else helpers[col]

    out = [F.col("source_row").cast("long").alias("source_row")]
    for name, definition in spec.items():
        kind = definition.get("type")
        if kind == "datetime":
            out.append(h("ts", name).alias(name))
        elif kind == "integer":
            out.append(h("n", name).cast("long").alias(name))
        elif kind == "boolean":
            t = h("t", name)
            out.append(F.when(t != "", F.lower(t) == "true").alias(name))
        else:
            out.append(h("t", name).alias(name))
    extra = [c for c in SILVER_METADATA if c in valid.columns]
    typed = valid.select(*out, *extra)
    closed = F.col(status_col) == "closed"
    return typed.withColumn(
        "sla_met", F.when(closed, F.col("resolution_minutes") <= F.col("sla_target_minutes"))
    )
