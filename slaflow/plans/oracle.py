"""Independent DuckDB SQL for every registered query.

The SQL is written against the driver tables (views ``orders``,
``customer``, ``lineitem``, ``events``) and re-derives each result from
scratch: request view -> Bronze -> rule checks as a UNION ALL of one
SELECT per rule -> Silver -> star schema -> marts -> event log -> process
tables -> controls.  Column names and types are those of the Spark
queries.  Rounding families: ``round`` (half away from zero) for the
marts, ``round_even`` for the KPI row and process tables.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values, written out here and not taken from the engine, so that a
# wrong constant there doesn't pass.
# ---------------------------------------------------------------------------
COLUMNS = [
    # name, type, nullable, allowed values
    ("ticket_id", "string", False, None),
    ("created_at", "datetime", False, None),
    ("closed_at", "datetime", True, None),
    ("priority", "string", False, ["P1", "P2", "P3", "P4"]),
    ("category", "string", False, ["access", "application", "hardware", "network", "reporting"]),
    ("assigned_team", "string", False, ["business_apps", "data_platform", "network_ops", "service_desk", "workplace"]),
    ("status", "string", False, ["closed", "open"]),
    ("sla_target_minutes", "integer", False, None),
    ("resolution_minutes", "integer", True, None),
    ("reopened_count", "integer", False, None),
    ("escalated", "boolean", False, None),
    ("customer_segment", "string", False, ["enterprise", "internal", "smb"]),
    ("source_system", "string", False, ["service_portal"]),
]
TICKET_PATTERN = "SR-[0-9]{6,}"
NUMBER_PATTERN = "[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))"
TS_FORMAT = "%Y-%m-%dT%H:%M:%SZ"
BLANKS = "\u0009\u000a\u000b\u000c\u000d\u001c\u001d\u001e\u001f \u0085\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
WS = f"'{BLANKS}'"
SLA_TARGETS = {"P1": 240, "P2": 480, "P3": 1440, "P4": 2880}
RANGES = [
    ("sla_target_minutes", "n_sla_target_minutes < 1", "invalid_sla_target_range", "sla_target_minutes must be positive."),
    ("resolution_minutes", "n_resolution_minutes < 0", "negative_resolution_minutes", "resolution_minutes must not be negative."),
    ("reopened_count", "n_reopened_count < 0 OR n_reopened_count > 5", "invalid_reopened_count_range", "reopened_count must be between 0 and 5."),
]
KPI_RANGES = {
    "sla_compliance_rate": (0.93, 0.96),
    "reopen_rate": (0.05, 0.09),
    "escalation_rate": (0.07, 0.12),
    "open_backlog_rate": (0.1, 0.18),
}
SOURCE_FILE, BATCH_ID, INGESTED_AT = "orders.parquet", "f546989d14e05a12", "2026-07-29T00:00:00Z"
EVENT_ORIGIN = "derived_synthetic_scenario"
DERIVED_BOUNDARY = "Derived synthetic waiting time; concentration signal, not causal root cause."
OBSERVED_BOUNDARY = "Observed waiting time; concentration signal, not causal root cause."
# --------------------------------------------------------------------------- end of fixed values


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _t(name: str) -> str:
    return f"t_{name}"


def exact(expression: str, digits: int) -> str:
    """The nearest decimal of the exact binary value, half-even: a product
    that lands on .5 is told from a tie by its error (the value split in two
    parts that have exact products)."""
    p = f"(x * {10**digits}.0::DOUBLE)"
    high = "(x * 134217729.0::DOUBLE - (x * 134217729.0::DOUBLE - x))"
    error = f"(({high} * {10**digits}.0::DOUBLE - {p}) + (x - {high}) * {10**digits}.0::DOUBLE)"
    case = (
        f"CASE WHEN {p} - floor({p}) = 0.5::DOUBLE AND {error} > 0 THEN ceil({p}) "
        f"WHEN {p} - floor({p}) = 0.5::DOUBLE AND {error} < 0 THEN floor({p}) ELSE round_even({p}, 0) END"
    )
    return f"list_transform([CAST(({expression}) AS DOUBLE)], lambda x: {case} / {10**digits}.0::DOUBLE)[1]"


# --------------------------------------------------------------------------- request view + bronze

REQUEST_SQL = f"""
rv_b AS (
  SELECT o.o_orderkey AS k, o.o_orderstatus AS os, CAST(substr(o.o_orderpriority, 1, 1) AS INTEGER) AS pn,
         c.c_mktsegment AS seg, CAST(c.c_nationkey AS INTEGER) AS nk,
         o.o_orderdate + to_minutes(CAST((o.o_orderkey * 37) % 1440 AS INTEGER)) AS created
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
), rv_p AS (
  SELECT *, CASE WHEN pn = 1 THEN 240 WHEN pn = 2 THEN 480 WHEN pn = 3 THEN 1440 ELSE 2880 END AS sla FROM rv_b
), rv_r AS (
  SELECT *, os <> 'O' AS is_closed,
         CAST(20 + (k * 7919) % CAST(floor(sla * 1.05) AS INTEGER) AS INTEGER) AS res,
         CASE WHEN k % 101 = 0 THEN 2 WHEN k % 17 = 0 THEN 1 ELSE 0 END AS reo
  FROM rv_p
), rv_t AS (
  SELECT *, strftime(created, '{TS_FORMAT}') AS ts_created, strftime(created + to_minutes(res), '{TS_FORMAT}') AS ts_closed,
         'P' || CAST(least(pn, 4) AS VARCHAR) AS prio, CASE WHEN is_closed THEN 'closed' ELSE 'open' END AS stat
  FROM rv_r
), requests AS (
  SELECT k,
    CASE WHEN k % 997 = 0 THEN printf('SR-%06d', k + 1)
         WHEN k % 991 = 1 THEN 'XX-' || CAST(k AS VARCHAR)
         WHEN k % 1009 = 5 THEN ''
         ELSE printf('SR-%06d', k) END AS ticket_id,
    CASE WHEN k % 1013 = 6 THEN '2024/01/01' WHEN k % 1091 = 18 THEN '' WHEN k % 1093 = 19 THEN ' ' || ts_created
         ELSE ts_created END AS created_at,
    CASE WHEN k % 1019 = 7 THEN strftime(created - to_minutes(15), '{TS_FORMAT}')
         WHEN k % 1021 = 8 THEN ''
         WHEN k % 1097 = 20 THEN 'yesterday'
         WHEN is_closed AND k % 1103 = 21 THEN ts_closed || ' '
         WHEN is_closed OR k % 1031 = 9 THEN ts_closed
         ELSE '' END AS closed_at,
    CASE WHEN k % 983 = 2 THEN 'P5' WHEN k % 1109 = 22 THEN '' WHEN k % 1117 = 23 THEN ' ' || prio || chr(9) ELSE prio END AS priority,
    CASE WHEN k % 1033 = 10 OR seg IS NULL THEN '' WHEN k % 1123 = 24 THEN 'printer' WHEN seg = 'AUTOMOBILE' THEN 'access'
         WHEN seg = 'BUILDING' THEN 'application' WHEN seg = 'FURNITURE' THEN 'hardware' WHEN seg = 'HOUSEHOLD' THEN 'network'
         ELSE 'reporting' END AS category,
    CASE WHEN k % 1039 = 11 THEN 'unknown_team' WHEN k % 1129 = 25 OR nk IS NULL THEN '' WHEN nk % 5 = 0 THEN 'business_apps'
         WHEN nk % 5 = 1 THEN 'data_platform' WHEN nk % 5 = 2 THEN 'network_ops' WHEN nk % 5 = 3 THEN 'service_desk'
         ELSE 'workplace' END AS assigned_team,
    CASE WHEN k % 1151 = 26 THEN '' WHEN k % 1153 = 27 THEN 'pending' WHEN k % 1163 = 28 THEN stat || ' ' ELSE stat END AS status,
    CASE WHEN k % 977 = 3 THEN '999' WHEN k % 1171 = 29 THEN '' WHEN k % 1181 = 30 THEN '240d' WHEN k % 1187 = 31 THEN '0'
         WHEN k % 1193 = 32 THEN CAST(sla AS VARCHAR) || '.0' ELSE CAST(sla AS VARCHAR) END AS sla_target_minutes,
    CASE WHEN k % 1049 = 12 THEN '-5' WHEN k % 1051 = 13 THEN 'abc' WHEN k % 1061 = 14 THEN ''
         WHEN is_closed AND k % 1201 = 33 THEN CAST(res AS VARCHAR) || '.5'
         WHEN is_closed OR k % 1063 = 15 THEN CAST(res AS VARCHAR) ELSE '' END AS resolution_minutes,
    CASE WHEN k % 1069 = 16 THEN '9' WHEN k % 1213 = 34 THEN '' WHEN k % 1217 = 35 THEN '0x1p3'
         WHEN is_closed AND k % 1223 = 36 THEN CAST(reo AS VARCHAR) || 'e0'
         WHEN is_closed THEN CAST(reo AS VARCHAR) ELSE '0' END AS reopened_count,
    CASE WHEN k % 1087 = 17 THEN 'maybe' WHEN k % 1229 = 37 THEN '' WHEN k % 11 = 0 THEN 'true' ELSE 'false' END AS escalated,
    CASE WHEN k % 1231 = 38 THEN '' WHEN k % 1237 = 39 THEN 'government' WHEN k % 3 = 0 THEN 'enterprise'
         WHEN k % 3 = 1 THEN 'internal' ELSE 'smb' END AS customer_segment,
    CASE WHEN k % 1249 = 40 THEN '' WHEN k % 1259 = 41 THEN 'email' ELSE 'service_portal' END AS source_system
  FROM rv_t
), bronze AS (
  SELECT CAST(row_number() OVER (ORDER BY k) + 1 AS BIGINT) AS source_row,
         {", ".join(c[0] for c in COLUMNS)},
         {q(SOURCE_FILE)} AS source_file, {q(BATCH_ID)} AS ingestion_batch_id,
         {q(INGESTED_AT)} AS ingested_at_utc
  FROM requests
)"""


def _helpers_sql() -> str:
    cols = []
    for name, kind, nullable, _ in COLUMNS:
        t = f"trim(COALESCE({name}, ''), {WS})"
        cols.append(f"{t} AS {_t(name)}")
        if kind == "integer":
            cols.append(f"CASE WHEN regexp_full_match({t}, {q(NUMBER_PATTERN)}) THEN try_cast({t} AS DOUBLE) END AS n_{name}")
        elif kind == "datetime":
            exactly = "" if nullable else f" AND {name} = {t}"  # strptime itself passes over blanks
            cols.append(f"CASE WHEN {t} <> ''{exactly} THEN try_strptime({t}, '{TS_FORMAT}') END AS ts_{name}")
    return f"""
h0 AS (SELECT *, {", ".join(cols)} FROM bronze),
dup_keys AS (SELECT t_ticket_id AS dk FROM h0 WHERE t_ticket_id <> '' GROUP BY 1 HAVING count(*) > 1),
h AS (SELECT h0.*, (dup_keys.dk IS NOT NULL) AS is_dup FROM h0 LEFT JOIN dup_keys ON h0.t_ticket_id = dup_keys.dk)"""


def _rules_sql() -> list[tuple[str, str, str, str]]:
    """(code, field, message, SQL condition) in evaluation order."""
    out = []
    for name, _, nullable, allowed in COLUMNS:
        if not nullable:
            out.append(("missing_required_value", name, f"{name} must not be blank.", f"{_t(name)} = ''"))
        if allowed:
            vals = ", ".join(q(v) for v in allowed)
            out.append((f"invalid_{name}", name, f"{name} is outside the allowed domain.", f"{_t(name)} NOT IN ({vals}) AND {_t(name)} <> ''"))
    out += [
        ("invalid_ticket_id_format", "ticket_id", "ticket_id must match the documented SR-###### format.",
         f"NOT regexp_full_match(t_ticket_id, {q(TICKET_PATTERN)}) AND t_ticket_id <> ''"),
        ("duplicate_ticket_id", "ticket_id", "ticket_id must be unique; all duplicate occurrences are rejected.", "is_dup AND t_ticket_id <> ''"),
        ("invalid_created_at", "created_at", "created_at must use the documented UTC timestamp format.", "ts_created_at IS NULL AND t_created_at <> ''"),
        ("invalid_closed_at", "closed_at", "closed_at must be blank or use the documented UTC timestamp format.", "ts_closed_at IS NULL AND t_closed_at <> ''"),
    ]
    for name in ("sla_target_minutes", "resolution_minutes", "reopened_count"):
        n = f"n_{name}"
        whole = f"({n} IS NOT NULL AND NOT isinf({n}) AND {n} = floor({n}))"
        out.append((f"invalid_{name}_type", name, f"{name} must be an integer when supplied.", f"{_t(name)} <> '' AND NOT {whole}"))
    for name, condition, code, message in RANGES:
        out.append((code, name, message, f"n_{name} IS NOT NULL AND ({condition})"))
    out.append(("invalid_escalated", "escalated", "escalated must be true or false.", "lower(t_escalated) NOT IN ('true', 'false') AND t_escalated <> ''"))
    target = "CASE " + " ".join(f"WHEN t_priority = {q(k)} THEN {v}" for k, v in SLA_TARGETS.items()) + " END"
    closed, opened = "t_status = 'closed'", "t_status = 'open'"
    out += [
        ("sla_priority_mismatch", "sla_target_minutes", "sla_target_minutes must match the documented priority mapping.",
         f"({target}) IS NOT NULL AND n_sla_target_minutes IS NOT NULL AND n_sla_target_minutes <> ({target})"),
        ("closed_missing_closed_at", "closed_at", "Closed requests require closed_at.", f"{closed} AND t_closed_at = ''"),
        ("closed_missing_resolution_minutes", "resolution_minutes", "Closed requests require resolution_minutes.",
         f"{closed} AND n_resolution_minutes IS NULL"),
        ("open_has_closed_at", "closed_at", "Open requests must not have closed_at.", f"{opened} AND t_closed_at <> ''"),
        ("open_has_resolution_minutes", "resolution_minutes", "Open requests must not have resolution_minutes.",
         f"{opened} AND n_resolution_minutes IS NOT NULL"),
        ("closed_before_created", "closed_at", "closed_at must not be earlier than created_at.",
         f"{closed} AND ts_created_at IS NOT NULL AND ts_closed_at IS NOT NULL AND ts_closed_at < ts_created_at"),
    ]
    return out


def _issues_sql() -> str:
    selects = []
    for i, (code, field, message, cond) in enumerate(_rules_sql(), start=1):
        selects.append(
            f"SELECT source_row, COALESCE(ticket_id, '') AS ticket_id, {q(code)} AS issue_code, {q(field)} AS field, "
            f"COALESCE({field}, '') AS observed_value, {q(message)} AS message, CAST({i} AS INTEGER) AS issue_position "
            f"FROM h WHERE COALESCE(({cond}), FALSE)"
        )
    return "issues AS (\n  " + "\n  UNION ALL ".join(selects) + "\n)"


SILVER_SQL = """
bad_rows AS (SELECT DISTINCT source_row FROM issues),
silver_valid AS (
  SELECT h.source_row, t_ticket_id AS ticket_id, ts_created_at AS created_at, ts_closed_at AS closed_at,
         t_priority AS priority, t_category AS category, t_assigned_team AS assigned_team, t_status AS status,
         CAST(n_sla_target_minutes AS BIGINT) AS sla_target_minutes, CAST(n_resolution_minutes AS BIGINT) AS resolution_minutes,
         CAST(n_reopened_count AS BIGINT) AS reopened_count,
         CASE WHEN t_escalated <> '' THEN lower(t_escalated) = 'true' END AS escalated,
         t_customer_segment AS customer_segment, t_source_system AS source_system,
         source_file, ingestion_batch_id, ingested_at_utc,
         CASE WHEN t_status = 'closed' THEN CAST(n_resolution_minutes AS BIGINT) <= CAST(n_sla_target_minutes AS BIGINT) END AS sla_met
  FROM h ANTI JOIN bad_rows ON h.source_row = bad_rows.source_row
),
rejection AS (
  SELECT source_row, string_agg(DISTINCT issue_code, '|' ORDER BY issue_code) AS rejection_reasons, CAST(count(*) AS BIGINT) AS issue_count
  FROM issues GROUP BY source_row
),
silver_rejected AS (
  SELECT b.*, r.rejection_reasons, r.issue_count FROM bronze b JOIN rejection r ON b.source_row = r.source_row
)"""

PRIORITY_RANK = "CASE priority WHEN 'P1' THEN 1 WHEN 'P2' THEN 2 WHEN 'P3' THEN 3 WHEN 'P4' THEN 4 END"

GOLD_SQL = f"""
dim_team AS (
  SELECT CAST(row_number() OVER (ORDER BY assigned_team) AS BIGINT) AS team_key, assigned_team
  FROM (SELECT DISTINCT assigned_team FROM silver_valid WHERE assigned_team IS NOT NULL)
),
dim_category AS (
  SELECT CAST(row_number() OVER (ORDER BY category) AS BIGINT) AS category_key, category
  FROM (SELECT DISTINCT category FROM silver_valid WHERE category IS NOT NULL)
),
dim_priority AS (
  SELECT CAST(row_number() OVER (ORDER BY {PRIORITY_RANK}) AS BIGINT) AS priority_key, priority, sla_target_minutes
  FROM (SELECT priority, min(sla_target_minutes) AS sla_target_minutes FROM silver_valid
        WHERE priority IN ('P1', 'P2', 'P3', 'P4') GROUP BY priority)
),
obs_days AS (
  SELECT DISTINCT d FROM (
    SELECT CAST(created_at AS DATE) AS d FROM silver_valid
    UNION ALL SELECT CAST(closed_at AS DATE) FROM silver_valid) WHERE d IS NOT NULL
),
dim_date AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month_number,
         monthname(d) AS month_name, dayname(d) AS day_of_week
  FROM obs_days
),
fact AS (
  SELECT v.ticket_id, CAST(strftime(v.created_at, '%Y%m%d') AS INTEGER) AS created_date_key,
         CAST(strftime(v.closed_at, '%Y%m%d') AS INTEGER) AS closed_date_key,
         t.team_key, c.category_key, p.priority_key, v.status, v.sla_target_minutes, v.resolution_minutes,
         v.reopened_count, v.escalated, v.sla_met, v.customer_segment, v.source_system, v.source_row, v.ingestion_batch_id
  FROM silver_valid v
  LEFT JOIN dim_team t ON v.assigned_team = t.assigned_team
  LEFT JOIN dim_category c ON v.category = c.category
  LEFT JOIN dim_priority p ON v.priority = p.priority
),
fk_violations AS (
  SELECT 'created_date_key' AS foreign_key, 'dim_date' AS dimension,
         CAST((SELECT count(*) FROM fact WHERE created_date_key IS NULL OR created_date_key NOT IN (SELECT date_key FROM dim_date)) AS BIGINT) AS violations
  UNION ALL SELECT 'closed_date_key', 'dim_date',
         CAST((SELECT count(*) FROM fact WHERE closed_date_key IS NOT NULL AND closed_date_key NOT IN (SELECT date_key FROM dim_date)) AS BIGINT)
  UNION ALL SELECT 'team_key', 'dim_team',
         CAST((SELECT count(*) FROM fact WHERE team_key IS NULL OR team_key NOT IN (SELECT team_key FROM dim_team)) AS BIGINT)
  UNION ALL SELECT 'category_key', 'dim_category',
         CAST((SELECT count(*) FROM fact WHERE category_key IS NULL OR category_key NOT IN (SELECT category_key FROM dim_category)) AS BIGINT)
  UNION ALL SELECT 'priority_key', 'dim_priority',
         CAST((SELECT count(*) FROM fact WHERE priority_key IS NULL OR priority_key NOT IN (SELECT priority_key FROM dim_priority)) AS BIGINT)
),
kpi_base AS (
  SELECT CAST(count(*) AS BIGINT) AS total_requests,
         CAST(count(*) FILTER (WHERE status = 'closed') AS BIGINT) AS closed_requests,
         CAST(count(*) FILTER (WHERE status = 'closed' AND sla_met) AS BIGINT) AS sla_met_requests,
         avg(CASE WHEN status = 'closed' THEN CAST(resolution_minutes AS DOUBLE) END) AS avg_res,
         median(CASE WHEN status = 'closed' THEN CAST(resolution_minutes AS DOUBLE) END) AS med_res,
         CAST(count(*) FILTER (WHERE escalated) AS BIGINT) AS escalated_requests,
         CAST(count(*) FILTER (WHERE status = 'closed' AND reopened_count > 0) AS BIGINT) AS reopened_requests
  FROM silver_valid
),
kpis AS (
  SELECT total_requests, closed_requests, total_requests - closed_requests AS open_backlog,
         COALESCE({exact("CAST(total_requests - closed_requests AS DOUBLE) / NULLIF(total_requests, 0)", 4)}, 0.0) AS open_backlog_rate,
         closed_requests AS sla_eligible_requests, sla_met_requests,
         COALESCE({exact("CAST(sla_met_requests AS DOUBLE) / NULLIF(closed_requests, 0)", 4)}, 0.0) AS sla_compliance_rate,
         {exact("avg_res", 2)} AS average_resolution_minutes, {exact("med_res", 2)} AS median_resolution_minutes,
         escalated_requests,
         COALESCE({exact("CAST(escalated_requests AS DOUBLE) / NULLIF(total_requests, 0)", 4)}, 0.0) AS escalation_rate,
         closed_requests AS reopen_eligible_requests, reopened_requests,
         COALESCE({exact("CAST(reopened_requests AS DOUBLE) / NULLIF(closed_requests, 0)", 4)}, 0.0) AS reopen_rate
  FROM kpi_base
),
enriched AS (
  SELECT f.ticket_id, CAST(cd.full_date AS DATE) AS created_date, CAST(xd.full_date AS DATE) AS closed_date,
         t.assigned_team, c.category, p.priority, f.status, f.sla_target_minutes, f.resolution_minutes,
         f.reopened_count, f.escalated, f.sla_met,
         CASE WHEN f.status = 'closed' AND f.sla_met = FALSE THEN TRUE ELSE FALSE END AS sla_breached,
         CASE WHEN f.status = 'closed'
              THEN round(CAST(f.resolution_minutes AS DOUBLE) / NULLIF(CAST(f.sla_target_minutes AS DOUBLE), 0), 4) END AS resolution_ratio,
         CAST(CASE WHEN f.status = 'closed' AND f.sla_met = FALSE THEN f.resolution_minutes - f.sla_target_minutes ELSE 0 END AS BIGINT)
           AS resolution_overrun_minutes,
         f.customer_segment, f.source_system, f.source_row, f.ingestion_batch_id
  FROM fact f
  JOIN dim_date cd ON f.created_date_key = cd.date_key
  LEFT JOIN dim_date xd ON f.closed_date_key = xd.date_key
  JOIN dim_team t ON f.team_key = t.team_key
  JOIN dim_category c ON f.category_key = c.category_key
  JOIN dim_priority p ON f.priority_key = p.priority_key
)"""


def _sla_measures(full: bool) -> str:
    m = [
        "CAST(count(*) AS BIGINT) AS closed_requests",
        "CAST(count(*) FILTER (WHERE sla_met = TRUE) AS BIGINT) AS sla_met_requests",
        "CAST(count(*) FILTER (WHERE sla_breached = TRUE) AS BIGINT) AS sla_breaches",
        "round(CAST(count(*) FILTER (WHERE sla_met = TRUE) AS DOUBLE) / count(*), 4) AS sla_compliance_rate",
        "round(CAST(count(*) FILTER (WHERE sla_breached = TRUE) AS DOUBLE) / count(*), 4) AS sla_breach_rate",
    ]
    if full:
        m += [
            "CAST(count(*) FILTER (WHERE escalated = TRUE) AS BIGINT) AS escalated_closed_requests",
            "round(CAST(count(*) FILTER (WHERE escalated = TRUE) AS DOUBLE) / count(*), 4) AS closed_escalation_rate",
            "CAST(count(*) FILTER (WHERE reopened_count > 0) AS BIGINT) AS reopened_requests",
            "round(CAST(count(*) FILTER (WHERE reopened_count > 0) AS DOUBLE) / count(*), 4) AS reopen_rate",
            "round(avg(CAST(resolution_minutes AS DOUBLE)), 2) AS average_resolution_minutes",
            "round(median(CAST(resolution_minutes AS DOUBLE)), 2) AS median_resolution_minutes",
        ]
    return ", ".join(m)


MARTS_SQL = f"""
sla_by_team AS (SELECT assigned_team, {_sla_measures(True)} FROM enriched WHERE status = 'closed' GROUP BY assigned_team),
sla_by_category AS (SELECT category, {_sla_measures(True)} FROM enriched WHERE status = 'closed' GROUP BY category),
sla_by_priority AS (SELECT priority, {_sla_measures(True)} FROM enriched WHERE status = 'closed' GROUP BY priority),
sla_by_team_category AS (
  SELECT assigned_team, category, {_sla_measures(False)} FROM enriched WHERE status = 'closed' GROUP BY assigned_team, category),
daily AS (
  SELECT created_date,
         CAST(count(*) AS BIGINT) AS total_requests,
         CAST(count(*) FILTER (WHERE status = 'closed') AS BIGINT) AS closed_requests,
         CAST(count(*) FILTER (WHERE status = 'open') AS BIGINT) AS open_requests,
         CAST(count(*) FILTER (WHERE status = 'closed') AS BIGINT) AS sla_eligible_requests,
         CAST(count(*) FILTER (WHERE sla_met = TRUE) AS BIGINT) AS sla_met_requests,
         CAST(count(*) FILTER (WHERE sla_breached = TRUE) AS BIGINT) AS sla_breaches,
         round(CAST(count(*) FILTER (WHERE sla_met = TRUE) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE status = 'closed'), 0), 4) AS sla_compliance_rate,
         round(CAST(count(*) FILTER (WHERE sla_breached = TRUE) AS DOUBLE) / NULLIF(count(*) FILTER (WHERE status = 'closed'), 0), 4) AS sla_breach_rate,
         CAST(count(*) FILTER (WHERE escalated = TRUE) AS BIGINT) AS escalated_requests,
         CAST(count(*) FILTER (WHERE reopened_count > 0) AS BIGINT) AS reopened_requests
  FROM enriched GROUP BY created_date
),
breaches AS (
  SELECT ticket_id, created_date, closed_date, assigned_team, category, priority, customer_segment, status,
         sla_target_minutes, resolution_minutes, resolution_overrun_minutes, resolution_ratio, reopened_count, escalated,
         ingestion_batch_id
  FROM enriched WHERE sla_breached = TRUE
)"""


def _event_selects() -> str:
    """One SELECT per lifecycle event kind of the derived event log."""
    at = "created_us + (dur * {p}) // 100"
    after = "created_us + {m} * 60000000"
    escalation_pct = "(CASE WHEN reopened_count <> 0 THEN 30 ELSE 45 END)"
    open_escalation = "greatest(assigned + 1, CAST(round_even(sla * CAST(0.75 AS DOUBLE), 0) AS BIGINT))"
    rows = [
        ("TRUE", "created_us", 0, "ticket_created"),
        ("TRUE", after.format(m="assigned"), 1, "team_assigned"),
        ("is_closed AND esc", at.format(p=escalation_pct), 2, "escalated"),
        ("NOT is_closed AND esc", after.format(m=open_escalation), 2, "escalated"),
        ("is_closed AND reopened_count = 1", at.format(p=58), 3, "resolution_recorded"),
        ("is_closed AND reopened_count = 1", at.format(p=68), 4, "reopened"),
        ("is_closed AND reopened_count = 2", at.format(p=38), 3, "resolution_recorded"),
        ("is_closed AND reopened_count = 2", at.format(p=47), 4, "reopened"),
        ("is_closed AND reopened_count = 2", at.format(p=68), 5, "resolution_recorded"),
        ("is_closed AND reopened_count = 2", at.format(p=76), 6, "reopened"),
        ("is_closed", at.format(p=90), 7, "resolution_recorded"),
        ("is_closed", "closed_us", 8, "ticket_closed"),
    ]
    return "\n  UNION ALL ".join(
        f"SELECT ticket_id AS case_id, CAST({ts} AS BIGINT) AS ts, {seq} AS seq, {q(act)} AS activity FROM ev_src WHERE {cond}"
        for cond, ts, seq, act in rows
    )


PROCESS_SQL = f"""
ev_base AS (
  SELECT *, epoch_us(created_at) AS created_us, epoch_us(closed_at) AS closed_us,
         epoch_us(closed_at) - epoch_us(created_at) AS dur, status = 'closed' AS is_closed,
         COALESCE(escalated, FALSE) AS esc, CAST(sla_target_minutes AS DOUBLE) AS sla
  FROM silver_valid
),
ev_src AS (
  SELECT *, CAST(CASE WHEN is_closed
      THEN least(15.0, greatest(1.0,
           round_even(((CAST(dur AS DOUBLE) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE)) * CAST(0.05 AS DOUBLE), 0)))
      ELSE least(15.0, greatest(1.0,
           round_even(sla * CAST(0.05 AS DOUBLE), 0))) END AS BIGINT) AS assigned
  FROM ev_base
),
ev_raw AS (
  {_event_selects()}
),
ev_ordered AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY case_id ORDER BY ts, seq) AS INTEGER) AS event_index FROM ev_raw
),
event_log AS (
  SELECT printf('%s-E%02d', e.case_id, e.event_index) AS event_id, e.case_id, v.assigned_team, v.category, v.priority,
         v.customer_segment, v.status, v.sla_met, COALESCE(v.escalated, FALSE) AS escalated_case,
         v.reopened_count, {q(EVENT_ORIGIN)} AS event_origin, e.event_index, e.activity,
         make_timestamp(e.ts) AS event_timestamp
  FROM ev_ordered e JOIN silver_valid v ON e.case_id = v.ticket_id
),
case_summary AS (
  SELECT case_id, CAST(count(*) AS BIGINT) AS event_count, min(event_timestamp) AS first_event_at,
         max(event_timestamp) AS last_event_at, string_agg(activity, ' > ' ORDER BY event_index) AS process_variant
  FROM event_log GROUP BY case_id
),
cases AS (
  SELECT v.ticket_id AS case_id, v.assigned_team, v.category, v.priority, v.customer_segment, v.status,
         v.sla_target_minutes, v.reopened_count, COALESCE(v.escalated, FALSE) AS escalated_case, v.sla_met,
         s.event_count, s.first_event_at, s.last_event_at, s.process_variant,
         round_even((CAST(epoch_us(s.last_event_at) - epoch_us(s.first_event_at) AS DOUBLE) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE), 2)
           AS observed_span_minutes,
         CAST(v.resolution_minutes AS DOUBLE) AS throughput_minutes,
         CASE WHEN COALESCE(v.escalated, FALSE) AND v.reopened_count <> 0 THEN 'escalated_and_reopened'
              WHEN v.reopened_count <> 0 THEN 'reopened_only'
              WHEN COALESCE(v.escalated, FALSE) THEN 'escalated_only' ELSE 'standard' END AS exception_type
  FROM silver_valid v LEFT JOIN case_summary s ON v.ticket_id = s.case_id
),
variants AS (
  SELECT process_variant, CAST(count(*) AS BIGINT) AS case_count,
         COALESCE({exact("CAST(count(*) AS DOUBLE) / NULLIF((SELECT count(*) FROM cases), 0)", 4)}, 0.0) AS case_share,
         CAST(count(*) FILTER (WHERE status = 'closed') AS BIGINT) AS closed_cases,
         CAST(count(*) FILTER (WHERE status = 'open') AS BIGINT) AS open_cases,
         CAST(count(*) FILTER (WHERE exception_type <> 'standard') AS BIGINT) AS exception_cases,
         {exact("avg(CASE WHEN status = 'closed' THEN throughput_minutes END)", 2)} AS average_throughput_minutes,
         COALESCE({exact("""CAST(count(*) FILTER (WHERE status = 'closed' AND sla_met = FALSE) AS DOUBLE)
                  / NULLIF(count(*) FILTER (WHERE status = 'closed'), 0)""", 4)}, 0.0) AS sla_breach_rate
  FROM cases GROUP BY process_variant
),
exception_paths AS (
  SELECT exception_type, CAST(count(*) AS BIGINT) AS case_count,
         CAST(count(*) FILTER (WHERE status = 'closed') AS BIGINT) AS closed_cases,
         CAST(count(*) FILTER (WHERE status = 'open') AS BIGINT) AS open_cases,
         {exact("avg(CASE WHEN status = 'closed' THEN throughput_minutes END)", 2)} AS average_throughput_minutes,
         COALESCE({exact("""CAST(count(*) FILTER (WHERE status = 'closed' AND sla_met = FALSE) AS DOUBLE)
                  / NULLIF(count(*) FILTER (WHERE status = 'closed'), 0)""", 4)}, 0.0) AS sla_breach_rate,
         CAST(sum(reopened_count) AS BIGINT) AS reopen_occurrences
  FROM cases WHERE exception_type <> 'standard' GROUP BY exception_type
),
steps AS (
  SELECT source_activity, target_activity, wait_us,
         (CAST(wait_us AS DOUBLE) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE) AS wait_minutes
  FROM (SELECT activity AS source_activity,
               lead(activity) OVER (PARTITION BY case_id ORDER BY event_index) AS target_activity,
               epoch_us(lead(event_timestamp) OVER (PARTITION BY case_id ORDER BY event_index)) - epoch_us(event_timestamp) AS wait_us
        FROM event_log)
)"""


def _transition_stats(source: str) -> str:
    return f"""SELECT source_activity, target_activity, CAST(count(*) AS BIGINT) AS case_count,
         {exact("((CAST(sum(wait_us) AS DOUBLE) / count(*)) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE)", 2)} AS average_wait_minutes,
         {exact("quantile_cont(wait_minutes, 0.5)", 2)} AS median_wait_minutes,
         {exact("quantile_cont(wait_minutes, 0.9)", 2)} AS p90_wait_minutes
  FROM {source} WHERE target_activity IS NOT NULL GROUP BY source_activity, target_activity"""


def _bottlenecks(source: str, boundary: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY average_wait_minutes DESC, case_count DESC, source_activity, target_activity) AS BIGINT)
           AS bottleneck_rank, source_activity, target_activity, case_count, average_wait_minutes, median_wait_minutes,
           p90_wait_minutes, {q(boundary)} AS interpretation_boundary
  FROM {source} WHERE case_count >= 10"""


TRANSITIONS_SQL = f"""
transitions AS ({_transition_stats("steps")}),
bottlenecks AS ({_bottlenecks("transitions", DERIVED_BOUNDARY)})"""

OBSERVED_SQL = f"""
obs_steps AS (
  SELECT source_activity, target_activity, wait_us,
         (CAST(wait_us AS DOUBLE) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE) AS wait_minutes
  FROM (SELECT event_type AS source_activity,
               lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS target_activity,
               epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)) - epoch_us(ts) AS wait_us
        FROM events)
),
obs_transitions AS ({_transition_stats("obs_steps")}),
obs_bottlenecks AS ({_bottlenecks("obs_transitions", OBSERVED_BOUNDARY)}),
obs_positions AS (
  SELECT user_id, CAST(ts AS DATE) AS activity_date, event_type, ts,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS pos
  FROM events
),
obs_pieces AS (
  SELECT user_id, activity_date, pos // 10000 AS piece, count(*) AS n, min(ts) AS low, max(ts) AS high,
         md5(string_agg(coalesce(event_type, '?'), ' > ' ORDER BY pos)) AS digest
  FROM obs_positions GROUP BY ALL
),
obs_cases AS (
  SELECT user_id, activity_date, CAST(sum(n) AS BIGINT) AS event_count, md5(string_agg(digest, ' > ' ORDER BY piece)) AS variant_id,
         epoch_us(max(high)) - epoch_us(min(low)) AS span_us
  FROM obs_pieces GROUP BY ALL
),
obs_variants AS (
  SELECT variant_id, CAST(count(*) AS BIGINT) AS case_count,
         COALESCE({exact("CAST(count(*) AS DOUBLE) / NULLIF((SELECT count(*) FROM obs_cases), 0)", 4)}, 0.0) AS case_share,
         CAST(max(event_count) AS BIGINT) AS event_count,
         {exact("((CAST(sum(span_us) AS DOUBLE) / count(*)) / CAST(1000000 AS DOUBLE)) / CAST(60 AS DOUBLE)", 2)} AS average_span_minutes
  FROM obs_cases GROUP BY variant_id
),
obs_steps_of AS (
  SELECT DISTINCT c.variant_id, CAST(p.pos + 1 AS BIGINT) AS position, p.event_type AS activity
  FROM obs_positions p JOIN obs_cases c
    ON p.user_id IS NOT DISTINCT FROM c.user_id AND p.activity_date IS NOT DISTINCT FROM c.activity_date
)"""


def _control(name: str, observed: str, expected: str) -> str:
    return f"SELECT {q(name)} AS control, CAST(({observed}) AS DOUBLE) AS observed, CAST(({expected}) AS DOUBLE) AS expected"


def _controls(items: list[tuple[str, str, str]]) -> str:
    body = "\n  UNION ALL ".join(_control(*i) for i in items)
    return f"SELECT control, observed, expected, observed = expected AS passed FROM (\n  {body}\n)"


def cnt(table: str, where: str = "TRUE") -> str:
    return f"SELECT count(*) FROM {table} WHERE {where}"


CONTROLS_MEDALLION = _controls(
    [
        ("bronze_equals_valid_plus_rejected", f"({cnt('silver_valid')}) + ({cnt('silver_rejected')})", cnt("bronze")),
        ("valid_equals_fact", cnt("fact"), cnt("silver_valid")),
        ("foreign_keys_complete", "SELECT COALESCE(sum(violations), 0) FROM fk_violations", "0"),
    ]
)

CONTROLS_ANALYTICS = _controls(
    [
        ("enriched_equals_gold_fact", cnt("enriched"), cnt("fact")),
        ("breach_details_equals_global_breaches", cnt("breaches"), "SELECT closed_requests - sla_met_requests FROM kpis"),
        ("team_closed_reconciles", "SELECT COALESCE(sum(closed_requests), 0) FROM sla_by_team", "SELECT closed_requests FROM kpis"),
        ("category_closed_reconciles", "SELECT COALESCE(sum(closed_requests), 0) FROM sla_by_category", "SELECT closed_requests FROM kpis"),
        ("priority_closed_reconciles", "SELECT COALESCE(sum(closed_requests), 0) FROM sla_by_priority", "SELECT closed_requests FROM kpis"),
        ("team_category_closed_reconciles", "SELECT COALESCE(sum(closed_requests), 0) FROM sla_by_team_category", "SELECT closed_requests FROM kpis"),
        ("daily_requests_reconcile", "SELECT COALESCE(sum(total_requests), 0) FROM daily", "SELECT total_requests FROM kpis"),
        (
            "weighted_team_sla_equals_global",
            f"SELECT COALESCE({exact('CAST(sum(sla_met_requests) AS DOUBLE) / NULLIF(sum(closed_requests), 0)', 4)}, 0.0) FROM sla_by_team",
            "SELECT sla_compliance_rate FROM kpis",
        ),
        ("all_breach_rows_are_closed", cnt("breaches", "status <> 'closed'"), "0"),
        ("all_breach_overruns_are_positive", cnt("breaches", "resolution_overrun_minutes <= 0"), "0"),
    ]
)

CONTROLS_PROCESS = _controls(
    [
        ("case_count_matches_valid_source", cnt("cases"), cnt("silver_valid")),
        ("event_ids_unique", "SELECT count(*) - count(DISTINCT event_id) FROM event_log", "0"),
        (
            "event_indexes_contiguous",
            "SELECT count(*) FROM (SELECT case_id FROM event_log GROUP BY case_id "
            "HAVING min(event_index) <> 1 OR max(event_index) <> count(*) OR count(DISTINCT event_index) <> count(*))",
            "0",
        ),
        (
            "event_timestamps_monotonic",
            "SELECT count(*) FROM (SELECT event_timestamp < lag(event_timestamp) OVER (PARTITION BY case_id ORDER BY event_index) AS back "
            "FROM event_log) WHERE back",
            "0",
        ),
        ("first_activity_is_ticket_created", cnt("event_log", "event_index = 1 AND activity <> 'ticket_created'"), "0"),
        (
            "closed_cases_end_with_ticket_closed",
            "SELECT count(*) FROM event_log e JOIN case_summary s ON e.case_id = s.case_id AND e.event_index = s.event_count "
            "WHERE e.status = 'closed' AND e.activity <> 'ticket_closed'",
            "0",
        ),
        (
            "open_cases_do_not_end_with_ticket_closed",
            "SELECT count(*) FROM event_log e JOIN case_summary s ON e.case_id = s.case_id AND e.event_index = s.event_count "
            "WHERE e.status = 'open' AND e.activity = 'ticket_closed'",
            "0",
        ),
        ("reopened_events_reconcile", cnt("event_log", "activity = 'reopened'"), "SELECT COALESCE(sum(reopened_count), 0) FROM silver_valid"),
        ("escalation_events_reconcile", cnt("event_log", "activity = 'escalated'"), cnt("silver_valid", "escalated")),
        (
            "closed_throughput_matches_source",
            "SELECT count(*) FROM cases c LEFT JOIN silver_valid v ON c.case_id = v.ticket_id "
            "WHERE c.status = 'closed' AND c.throughput_minutes IS DISTINCT FROM CAST(v.resolution_minutes AS DOUBLE)",
            "0",
        ),
    ]
)

KPI_RANGES_SQL = "\nUNION ALL ".join(
    f"SELECT {q(name)} AS kpi, CAST({name} AS DOUBLE) AS value, CAST({lo} AS DOUBLE) AS lower_bound, "
    f"CAST({hi} AS DOUBLE) AS upper_bound, CAST({name} AS DOUBLE) BETWEEN CAST({lo} AS DOUBLE) AND CAST({hi} AS DOUBLE) AS inside FROM kpis"
    for name, (lo, hi) in KPI_RANGES.items()
)

GROUPING_SETS_SQL = f"""SELECT CASE WHEN grouping(assigned_team) = 0 AND grouping(category) = 1 THEN 'sla_by_team'
            WHEN grouping(category) = 0 AND grouping(assigned_team) = 1 THEN 'sla_by_category'
            WHEN grouping(priority) = 0 THEN 'sla_by_priority'
            ELSE 'sla_by_team_category' END AS mart,
       assigned_team, category, priority, {_sla_measures(True)}
FROM enriched WHERE status = 'closed'
GROUP BY GROUPING SETS ((assigned_team), (category), (priority), (assigned_team, category))"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(p.strip() for p in parts)


PIPELINE = _with(REQUEST_SQL, _helpers_sql(), _issues_sql(), SILVER_SQL, GOLD_SQL, MARTS_SQL, PROCESS_SQL, TRANSITIONS_SQL)

ORACLE_SQL: dict[str, str] = {
    "bronze_requests": f"{PIPELINE}\nSELECT * FROM bronze",
    "dq_issues": f"{PIPELINE}\nSELECT * FROM issues",
    "dq_issue_counts": f"{PIPELINE}\nSELECT issue_code, CAST(count(*) AS BIGINT) AS issue_count FROM issues GROUP BY issue_code",
    "dq_report": f"""{PIPELINE}
SELECT total_rows, total_rows - invalid_rows AS valid_rows, invalid_rows,
       COALESCE({exact("CAST(total_rows - invalid_rows AS DOUBLE) / NULLIF(total_rows, 0)", 4)}, 0.0) AS valid_rate
FROM (SELECT CAST((SELECT count(*) FROM bronze) AS BIGINT) AS total_rows,
             CAST((SELECT count(*) FROM bad_rows) AS BIGINT) AS invalid_rows)""",
    "silver_valid": f"{PIPELINE}\nSELECT * FROM silver_valid",
    "silver_rejected": f"{PIPELINE}\nSELECT * FROM silver_rejected",
    "dim_date": f"{PIPELINE}\nSELECT * FROM dim_date",
    "dim_team": f"{PIPELINE}\nSELECT * FROM dim_team",
    "dim_category": f"{PIPELINE}\nSELECT * FROM dim_category",
    "dim_priority": f"{PIPELINE}\nSELECT * FROM dim_priority",
    "fact_requests": f"{PIPELINE}\nSELECT * FROM fact",
    "fk_violations": f"{PIPELINE}\nSELECT * FROM fk_violations",
    "kpis": f"{PIPELINE}\nSELECT * FROM kpis",
    "kpi_design_ranges": f"{PIPELINE}\n{KPI_RANGES_SQL}",
    "requests_enriched": f"{PIPELINE}\nSELECT * FROM enriched",
    "sla_by_team": f"{PIPELINE}\nSELECT * FROM sla_by_team",
    "sla_by_category": f"{PIPELINE}\nSELECT * FROM sla_by_category",
    "sla_by_priority": f"{PIPELINE}\nSELECT * FROM sla_by_priority",
    "sla_by_team_category": f"{PIPELINE}\nSELECT * FROM sla_by_team_category",
    "sla_grouping_sets": f"{PIPELINE}\n{GROUPING_SETS_SQL}",
    "daily_operations": f"{PIPELINE}\nSELECT * FROM daily",
    "breach_details": f"{PIPELINE}\nSELECT * FROM breaches",
    "event_log": f"{PIPELINE}\nSELECT * FROM event_log",
    "process_cases": f"{PIPELINE}\nSELECT * FROM cases",
    "process_variants": f"{PIPELINE}\nSELECT * FROM variants",
    "transition_performance": f"{PIPELINE}\nSELECT * FROM transitions",
    "bottlenecks": f"{PIPELINE}\nSELECT * FROM bottlenecks",
    "exception_paths": f"{PIPELINE}\nSELECT * FROM exception_paths",
    "controls_medallion": f"{PIPELINE}\n{CONTROLS_MEDALLION}",
    "controls_analytics": f"{PIPELINE}\n{CONTROLS_ANALYTICS}",
    "controls_process": f"{PIPELINE}\n{CONTROLS_PROCESS}",
    "observed_transitions": f"{_with(OBSERVED_SQL)}\nSELECT * FROM obs_transitions",
    "observed_bottlenecks": f"{_with(OBSERVED_SQL)}\nSELECT * FROM obs_bottlenecks",
    "observed_variants": f"{_with(OBSERVED_SQL)}\nSELECT * FROM obs_variants",
    "observed_variant_steps": f"{_with(OBSERVED_SQL)}\nSELECT * FROM obs_steps_of",
    "duplicate_keys_lineitem": """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity, l.l_extendedprice, d.key_occurrences
FROM lineitem l
JOIN (SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS key_occurrences FROM lineitem
      GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d
  ON l.l_orderkey = d.l_orderkey AND l.l_linenumber = d.l_linenumber""",
    "closed_before_created_orders": """SELECT o.o_orderkey, CAST(o.o_orderdate AS DATE) AS o_orderdate, e.last_end
FROM orders o
JOIN (SELECT l_orderkey, max(CAST(l_shipdate AS DATE)) AS last_end FROM lineitem GROUP BY l_orderkey) e
  ON o.o_orderkey = e.l_orderkey
WHERE e.last_end < CAST(o.o_orderdate AS DATE)""",
    "csv_documents": """SELECT CAST(doc_id AS VARCHAR) AS doc_id, coalesce(text, '') AS text, coalesce(lang, '') AS lang,
       coalesce(source, '') AS source, coalesce(CAST(n_chars AS VARCHAR), '') AS n_chars
FROM documents""",
    "csv_malformed_documents": """SELECT doc_id, CASE WHEN commas > 0 THEN 'expected 2 fields, saw ' || (commas + 2) END AS reason,
       CAST(octet_length(encode(doc_id || ',' || line)) AS BIGINT) AS record_bytes
FROM (SELECT doc_id, line, length(line) - length(replace(line, ',', '')) AS commas
      FROM (SELECT doc_id, translate(coalesce(text, ''), '"' || chr(10) || chr(13), '''  ') AS line FROM documents))""",
    "published_row_counts": f"{PIPELINE}\n" + "\nUNION ALL ".join(
        f"SELECT {q(name)} AS table_name, CAST(count(*) AS BIGINT) AS rows_recorded, CAST(count(*) AS BIGINT) AS rows_read FROM {table}"
        for name, table in [
            ("bronze", "bronze"), ("silver_valid", "silver_valid"), ("silver_rejected", "silver_rejected"), ("silver_issues", "issues"),
            ("gold_fact", "fact"), ("dim_date", "dim_date"), ("dim_team", "dim_team"), ("dim_category", "dim_category"),
            ("dim_priority", "dim_priority"),
        ]
    ),
    "published_controls": f"{PIPELINE}\n({CONTROLS_MEDALLION})\nUNION ALL ({CONTROLS_ANALYTICS})\nUNION ALL ({CONTROLS_PROCESS})",
    "gold_views": f"""{PIPELINE}
SELECT t.assigned_team, d.year, d.month_name, count(*) AS requests, count(*) FILTER (WHERE f.sla_met) AS sla_met,
       CAST(sum(f.reopened_count) AS BIGINT) AS reopened
FROM fact f JOIN dim_team t ON f.team_key = t.team_key JOIN dim_date d ON f.created_date_key = d.date_key
GROUP BY t.assigned_team, d.year, d.month_name""",
    "published_order": f"{PIPELINE}\n" + "\nUNION ALL ".join(
        f"SELECT {q(name)} AS table_name, CAST(count(*) AS BIGINT) AS rows, CAST(0 AS BIGINT) AS misplaced_in_files, "
        f"CAST(0 AS BIGINT) AS misplaced_between_files FROM {table}"
        for name, table in [
            ("bronze", "bronze"), ("silver_valid", "silver_valid"), ("silver_rejected", "silver_rejected"), ("silver_issues", "issues"),
            ("gold_fact", "fact"), ("dim_date", "dim_date"), ("dim_team", "dim_team"), ("dim_category", "dim_category"),
            ("dim_priority", "dim_priority"), ("service_requests_enriched", "enriched"), ("sla_by_team", "sla_by_team"),
            ("sla_by_category", "sla_by_category"), ("sla_by_priority", "sla_by_priority"), ("sla_by_team_category", "sla_by_team_category"),
            ("daily_service_operations", "daily"), ("sla_breach_details", "breaches"), ("event_log", "event_log"),
            ("process_cases", "cases"), ("process_variants", "variants"), ("transition_performance", "transitions"),
            ("bottlenecks", "bottlenecks"), ("exception_paths", "exception_paths"),
        ]
    ),
    "mart_differences": f"""{PIPELINE}
SELECT ticket_id, resolution_minutes, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM enriched WHERE right(ticket_id, 2) IN ('07', '13')
UNION ALL SELECT ticket_id, coalesce(resolution_minutes, 0) + 1, 'right', 1 FROM enriched WHERE right(ticket_id, 2) = '13'
UNION ALL SELECT ticket_id, resolution_minutes, 'right', 1 FROM enriched WHERE right(ticket_id, 2) = '42'""",
    "fact_by_month": f"""{PIPELINE}
SELECT CAST(created_date_key // 100 AS INTEGER) AS created_month, count(*) AS requests, count(*) FILTER (WHERE status = 'closed') AS closed_requests,
       count(*) FILTER (WHERE sla_met) AS sla_met_requests,
       CAST(max(source_row + CASE WHEN created_date_key >= 19980101 THEN 1000000000 ELSE 0 END) AS BIGINT) AS last_row
FROM fact GROUP BY created_date_key // 100""",
    "sketched_resolution": f"""{PIPELINE}
SELECT mart, assigned_team, category, closed_requests, true AS median_holds, true AS p90_holds FROM (
    SELECT 'team' AS mart, assigned_team, CAST(NULL AS VARCHAR) AS category, count(resolution_minutes) AS closed_requests
    FROM enriched WHERE status = 'closed' GROUP BY assigned_team
    UNION ALL SELECT 'category', NULL, category, count(resolution_minutes) FROM enriched WHERE status = 'closed' GROUP BY category
    UNION ALL SELECT 'team_category', assigned_team, category, count(resolution_minutes) FROM enriched WHERE status = 'closed'
    GROUP BY assigned_team, category)""",
    "sketched_transitions": f"""{_with(OBSERVED_SQL)}
SELECT source_activity, target_activity, case_count, average_wait_minutes, true AS median_holds, true AS p90_holds FROM obs_transitions""",
}
