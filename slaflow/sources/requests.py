"""Service-request source over the driver tables.

Each order becomes one contract-shaped request row of text values
(orders left-joined to customer; an order without one has blank values that
validation rejects), with deterministic defects injected by key arithmetic
so that every rule fires, and padded, fractional and exponent values that
are valid.  The join is left to the optimizer: customer is broadcast when its scan is
small, otherwise a sort-merge join whose skewed partitions AQE splits.
"""

from __future__ import annotations

import hashlib
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from slaflow.contract import DEFAULT_INGESTED_AT, column_spec, default_contract
from slaflow.functions.temporal import MICROS_PER_MINUTE
from slaflow.operators.ordinal import with_ordinal
from slaflow.sources.tables import read_table

REQUEST_COLUMNS = [
    "ticket_id",
    "created_at",
    "closed_at",
    "priority",
    "category",
    "assigned_team",
    "status",
    "sla_target_minutes",
    "resolution_minutes",
    "reopened_count",
    "escalated",
    "customer_segment",
    "source_system",
]
REQUEST_SOURCE_FILE = "orders.parquet"
REQUEST_SOURCE_TABLES = ("customer.parquet", "orders.parquet")
TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def request_batch_id() -> str:
    """Lineage tag of the request source: SHA-256 prefix of its table names."""
    return hashlib.sha256("|".join(REQUEST_SOURCE_TABLES).encode()).hexdigest()[:16]


def request_contract() -> dict[str, Any]:
    """The contract of this source: order keys have six digits or more, so an
    id keeps all digits of its key (files keep the published pattern)."""
    contract = default_contract()
    column_spec(contract)["ticket_id"]["pattern"] = r"^SR-\d{6,}$"
    return contract


def _ticket(k: Column) -> Column:
    return F.format_string("SR-%06d", k)


def _ts_text(micros: Column) -> Column:
    return F.date_format(F.timestamp_micros(micros), TS_TEXT)


def request_rows(spark: SparkSession, sf_dir: str, number: str | None = None) -> DataFrame:
    """Contract-shaped text rows plus the order key ``request_key`` and, if
    named, the record number (2 for the smallest key)."""
    orders = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"
    )
    if number:
        orders = with_ordinal(orders, ["o_orderkey"], name=number, start=2)
    numbers = [number] if number else []
    customer = read_table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    k = F.col("o_orderkey")
    pn = F.substring("o_orderpriority", 1, 1).cast("int")
    sla = (
        F.when(pn == 1, F.lit(240)).when(pn == 2, F.lit(480)).when(pn == 3, F.lit(1440)).otherwise(F.lit(2880))
    )
    base = orders.join(customer, orders.o_custkey == customer.c_custkey, "left").select(
        k.alias("k"),
        F.col("o_orderstatus").alias("os"),
        pn.alias("pn"),
        F.col("c_mktsegment").alias("seg"),
        F.col("c_nationkey").cast("int").alias("nk"),
        (
            F.unix_micros(F.col("o_orderdate").cast("timestamp"))
            + ((k * 37) % 1440).cast("long") * F.lit(MICROS_PER_MINUTE)
        ).alias("created_us"),
        sla.alias("sla"),
        *numbers,
    )
    k = F.col("k")
    is_closed = F.col("os") != "O"
    res = (F.lit(20) + (k * 7919) % F.floor(F.col("sla") * F.lit(1.05)).cast("int")).cast("int")
    reo = F.when(k % 101 == 0, F.lit(2)).when(k % 17 == 0, F.lit(1)).otherwise(F.lit(0))
    created_us = F.col("created_us")
    seg, nk = F.col("seg"), F.col("nk")
    created, closed = _ts_text(created_us), _ts_text(created_us + res.cast("long") * MICROS_PER_MINUTE)
    priority = F.concat(F.lit("P"), F.least(F.col("pn"), F.lit(4)).cast("string"))
    status = F.when(is_closed, F.lit("closed")).otherwise(F.lit("open"))
    sla = F.col("sla").cast("string")
    return base.select(
        k.alias("request_key"),
        *numbers,
        F.when(k % 997 == 0, _ticket(k + 1))
        .when(k % 991 == 1, F.concat(F.lit("XX-"), k.cast("string")))
        .when(k % 1009 == 5, F.lit(""))
        .otherwise(_ticket(k))
        .alias("ticket_id"),
        F.when(k % 1013 == 6, F.lit("2024/01/01"))
        .when(k % 1091 == 18, F.lit(""))
        .when(k % 1093 == 19, F.concat(F.lit(" "), created))
        .otherwise(created)
        .alias("created_at"),
        F.when(k % 1019 == 7, _ts_text(created_us - 15 * MICROS_PER_MINUTE))
        .when(k % 1021 == 8, F.lit(""))
        .when(k % 1097 == 20, F.lit("yesterday"))
        .when(is_closed & (k % 1103 == 21), F.concat(closed, F.lit(" ")))
        .when(is_closed | (k % 1031 == 9), closed)
        .otherwise(F.lit(""))
        .alias("closed_at"),
        F.when(k % 983 == 2, F.lit("P5"))
        .when(k % 1109 == 22, F.lit(""))
        .when(k % 1117 == 23, F.concat(F.lit(" "), priority, F.lit("\t")))
        .otherwise(priority)
        .alias("priority"),
        F.when((k % 1033 == 10) | seg.isNull(), F.lit(""))
        .when(k % 1123 == 24, F.lit("printer"))
        .when(seg == "AUTOMOBILE", F.lit("access"))
        .when(seg == "BUILDING", F.lit("application"))
        .when(seg == "FURNITURE", F.lit("hardware"))
        .when(seg == "HOUSEHOLD", F.lit("network"))
        .otherwise(F.lit("reporting"))
        .alias("category"),
        F.when(k % 1039 == 11, F.lit("unknown_team"))
        .when((k % 1129 == 25) | nk.isNull(), F.lit(""))
        .when(nk % 5 == 0, F.lit("business_apps"))
        .when(nk % 5 == 1, F.lit("data_platform"))
        .when(nk % 5 == 2, F.lit("network_ops"))
        .when(nk % 5 == 3, F.lit("service_desk"))
        .otherwise(F.lit("workplace"))
        .alias("assigned_team"),
        F.when(k % 1151 == 26, F.lit(""))
        .when(k % 1153 == 27, F.lit("pending"))
        .when(k % 1163 == 28, F.concat(status, F.lit(" ")))
        .otherwise(status)
        .alias("status"),
        F.when(k % 977 == 3, F.lit("999"))
        .when(k % 1171 == 29, F.lit(""))
        .when(k % 1181 == 30, F.lit("240d"))
        .when(k % 1187 == 31, F.lit("0"))
        .when(k % 1193 == 32, F.concat(sla, F.lit(".0")))
        .otherwise(sla)
        .alias("sla_target_minutes"),
        F.when(k % 1049 == 12, F.lit("-5"))
        .when(k % 1051 == 13, F.lit("abc"))
        .when(k % 1061 == 14, F.lit(""))
        .when(is_closed & (k % 1201 == 33), F.concat(res.cast("string"), F.lit(".5")))
        .when(is_closed | (k % 1063 == 15), res.cast("string"))
        .otherwise(F.lit(""))
        .alias("resolution_minutes"),
        F.when(k % 1069 == 16, F.lit("9"))
        .when(k % 1213 == 34, F.lit(""))
        .when(k % 1217 == 35, F.lit("0x1p3"))
        .when(is_closed & (k % 1223 == 36), F.concat(reo.cast("string"), F.lit("e0")))
        .when(is_closed, reo.cast("string"))
        .otherwise(F.lit("0"))
        .alias("reopened_count"),
        F.when(k % 1087 == 17, F.lit("maybe"))
        .when(k % 1229 == 37, F.lit(""))
        .when(k % 11 == 0, F.lit("true"))
        .otherwise(F.lit("false"))
        .alias("escalated"),
        F.when(k % 1231 == 38, F.lit(""))
        .when(k % 1237 == 39, F.lit("government"))
        .when(k % 3 == 0, F.lit("enterprise"))
        .when(k % 3 == 1, F.lit("internal"))
        .otherwise(F.lit("smb"))
        .alias("customer_segment"),
        F.when(k % 1249 == 40, F.lit(""))
        .when(k % 1259 == 41, F.lit("email"))
        .otherwise(F.lit("service_portal"))
        .alias("source_system"),
    )


def request_metadata() -> dict[str, str]:
    return {
        "source_file": REQUEST_SOURCE_FILE,
        "ingestion_batch_id": request_batch_id(),
        "ingested_at_utc": DEFAULT_INGESTED_AT,
    }
