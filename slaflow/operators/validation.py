"""Contract-driven row validation.

One projection evaluates every rule and records the violated ones as a
bitmask (bit i-1 set = rule i violated), built from plain ``CASE`` and
bitwise-or expressions so the whole projection stays in generated code.
Rules do not short-circuit: a row can carry many issues.  Only rejected
rows expand the mask into rule numbers (rule order is the stable
tie-break of the issue table).  The only shuffle is the uniqueness
rule: ids are aggregated (map-side combined; blank ids never leave the
scan), and the rows of ids seen more than once are joined back by their
number.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slaflow.contract import column_spec
from slaflow.functions.numeric import is_integral, parse_number, safe_rate
from slaflow.functions.temporal import any_timestamp, in_range, parse_timestamp
from slaflow.functions.text import full_match, text, trimmed
from slaflow.sources.tables import require_columns

ISSUES = "issue_mask"
MAX_RULES = 62

# ---------------------------------------------------------------------------
# Issue codes and messages of rules whose wording is not
# derived from a column name (they must match the published issue table).
# ---------------------------------------------------------------------------
FIXED_MESSAGES = {
    "invalid_ticket_id_format": "ticket_id must match the documented SR-###### format.",
    "duplicate_ticket_id": "ticket_id must be unique; all duplicate occurrences are rejected.",
    "invalid_created_at": "created_at must use the documented UTC timestamp format.",
    "invalid_closed_at": "closed_at must be blank or use the documented UTC timestamp format.",
    "invalid_sla_target_range": "sla_target_minutes must be positive.",
    "negative_resolution_minutes": "resolution_minutes must not be negative.",
    "invalid_reopened_count_range": "reopened_count must be between 0 and 5.",
    "invalid_escalated": "escalated must be true or false.",
    "sla_priority_mismatch": "sla_target_minutes must match the documented priority mapping.",
    "closed_missing_closed_at": "Closed requests require closed_at.",
    "closed_missing_resolution_minutes": "Closed requests require resolution_minutes.",
    "open_has_closed_at": "Open requests must not have closed_at.",
    "open_has_resolution_minutes": "Open requests must not have resolution_minutes.",
    "closed_before_created": "closed_at must not be earlier than created_at.",
}
RANGE_CODES = {
    "sla_target_minutes": "invalid_sla_target_range",
    "resolution_minutes": "negative_resolution_minutes",
    "reopened_count": "invalid_reopened_count_range",
}
# --------------------------------------------------------------------------- end of fixed values


@dataclass(frozen=True)
class Rule:
    code: str
    field: str
    message: str
    condition: Column


def _message(code: str, default: str) -> str:
    return FIXED_MESSAGES.get(code, default)


def helper(kind: str, name: str) -> str:
    """Name of a per-row helper column (trimmed text, number, timestamp)."""
    return f"__{kind}_{name}"


def parsed_column_map(contract: dict[str, Any]) -> dict[str, Column]:
    """Helper column name -> expression: each source column trimmed once,
    each integer/datetime parsed once."""
    spec = column_spec(contract)
    out = {helper("t", name): trimmed(name) for name in spec}
    for name, definition in spec.items():
        t = trimmed(name)
        if definition.get("type") == "integer":
            out[helper("n", name)] = parse_number(t)
        elif definition.get("type") == "datetime":
            # Required datetimes are parsed exactly as supplied, optional ones
            # after trimming (a padded required timestamp is a format error).
            source = t if definition.get("nullable", True) else text(name)
            out[helper("ts", name)] = F.when(t != "", parse_timestamp(source, contract["timestamp_format"]))
    return out


def parsed_columns(contract: dict[str, Any]) -> list[Column]:
    """The helper columns of ``parsed_column_map``, aliased.

    Rules and typing refer to these columns, which keeps the rule
    projection small (fast planning, no repeated parsing per row).
    """
    return [expr.alias(name) for name, expr in parsed_column_map(contract).items()]


def with_parsed(df: DataFrame, contract: dict[str, Any]) -> DataFrame:
    """The frame with the helper columns of ``parsed_column_map``, made in
    steps: texts are trimmed, then parsed, then held against their limits.
    Each step refers to columns of the one before, so nothing is trimmed or
    parsed more than once in a row."""
    spec = column_spec(contract)
    stamps = [n for n, d in spec.items() if d.get("type") == "datetime"]
    df = df.select("*", *[trimmed(n).alias(helper("t", n)) for n in spec])
    numbers = [parse_number(F.col(helper("t", n))).alias(helper("n", n)) for n, d in spec.items() if d.get("type") == "integer"]
    df = df.select("*", *numbers, *[_any_timestamp(n, contract).alias(helper("ts", n)) for n in stamps])
    return df.withColumns({helper("ts", n): in_range(F.col(helper("ts", n))) for n in stamps})


def _any_timestamp(name: str, contract: dict[str, Any]) -> Column:
    t = F.col(helper("t", name))
    source = t if column_spec(contract)[name].get("nullable", True) else text(name)
    return F.when(t != "", any_timestamp(source, contract["timestamp_format"]))


def trimmed_helpers(contract: dict[str, Any]) -> list[str]:
    """Names of the trimmed-text helpers (cheap to recompute, so not stored)."""
    return [helper("t", name) for name in column_spec(contract)]


class _Parsed:
    """Accessors for the helper columns of ``parsed_columns``."""

    def __init__(self, contract: dict[str, Any]):
        self.spec = column_spec(contract)

    def t(self, name: str) -> Column:
        return F.col(helper("t", name))

    def number(self, name: str) -> Column:
        return F.col(helper("n", name))

    def timestamp(self, name: str) -> Column:
        return F.col(helper("ts", name))


def rules(contract: dict[str, Any], duplicate_flag: Column | None = None) -> list[Rule]:
    """All rules of the contract in evaluation (append) order."""
    p = _Parsed(contract)
    spec = p.spec
    out: list[Rule] = []

    for name, definition in spec.items():
        if not definition.get("nullable", True):
            out.append(Rule("missing_required_value", name, f"{name} must not be blank.", p.t(name) == ""))
        allowed = definition.get("allowed_values")
        if allowed:
            t = p.t(name)
            out.append(
                Rule(f"invalid_{name}", name, f"{name} is outside the allowed domain.", ~t.isin(*allowed) & (t != ""))
            )

    for name, definition in spec.items():
        if definition.get("pattern"):
            t = p.t(name)
            code = f"invalid_{name}_format"
            out.append(Rule(code, name, _message(code, f"{name} must match its pattern."), ~full_match(t, definition["pattern"]) & (t != "")))

    for key in contract.get("primary_key", []):
        if duplicate_flag is not None:
            code = f"duplicate_{key}"
            out.append(Rule(code, key, _message(code, f"{key} must be unique."), duplicate_flag & (p.t(key) != "")))

    datetimes = [n for n, d in spec.items() if d.get("type") == "datetime"]
    for name in datetimes:
        code = f"invalid_{name}"
        out.append(Rule(code, name, _message(code, f"{name} must use the documented timestamp format."), p.timestamp(name).isNull() & (p.t(name) != "")))

    integers = [n for n, d in spec.items() if d.get("type") == "integer"]
    for name in integers:
        n, t = p.number(name), p.t(name)
        out.append(Rule(f"invalid_{name}_type", name, f"{name} must be an integer when supplied.", (t != "") & ~is_integral(n)))
    for name in integers:
        lo, hi = spec[name].get("minimum"), spec[name].get("maximum")
        if lo is None and hi is None:
            continue
        n = p.number(name)
        bad = F.lit(False)
        if lo is not None:
            bad = bad | (n < F.lit(lo))
        if hi is not None:
            bad = bad | (n > F.lit(hi))
        code = RANGE_CODES.get(name, f"invalid_{name}_range")
        out.append(Rule(code, name, _message(code, f"{name} is out of range."), n.isNotNull() & bad))

    for name, definition in spec.items():
        if definition.get("type") == "boolean":
            t = F.lower(p.t(name))
            code = f"invalid_{name}"
            out.append(Rule(code, name, _message(code, f"{name} must be true or false."), ~t.isin("true", "false") & (t != "")))

    business = contract.get("business_rules", {})
    sla_map = business.get("sla_target_by_priority")
    if sla_map:
        mapping = F.create_map(*[x for k, v in sla_map.items() for x in (F.lit(k), F.lit(float(v)))])
        expected = F.try_element_at(mapping, p.t("priority"))
        n = p.number("sla_target_minutes")
        out.append(
            Rule(
                "sla_priority_mismatch",
                "sla_target_minutes",
                FIXED_MESSAGES["sla_priority_mismatch"],
                expected.isNotNull() & n.isNotNull() & (n != expected),
            )
        )

    status = p.t("status")
    closed, is_open = status == "closed", status == "open"

    def present(name: str) -> Column:
        return p.number(name).isNotNull() if name in integers else (p.t(name) != "")

    for name in business.get("closed_status_requires", []):
        code = f"closed_missing_{name}"
        out.append(Rule(code, name, _message(code, f"Closed requests require {name}."), closed & ~present(name)))
    for name in business.get("open_status_requires_null", []):
        code = f"open_has_{name}"
        out.append(Rule(code, name, _message(code, f"Open requests must not have {name}."), is_open & present(name)))
    if business.get("closed_at_not_before_created_at"):
        created, closed_ts = p.timestamp("created_at"), p.timestamp("closed_at")
        out.append(
            Rule(
                "closed_before_created",
                "closed_at",
                FIXED_MESSAGES["closed_before_created"],
                closed & created.isNotNull() & closed_ts.isNotNull() & (closed_ts < created),
            )
        )
    return out


def duplicate_keys(df: DataFrame, key_cols: list[str], row_col: str, flag: str = "__duplicate") -> DataFrame:
    """Flag every occurrence of a key seen more than once (keep=False).

    The count is an aggregate (combined map-side, so a key holding a third of
    the rows never lands whole in one task; blank keys are dropped before the
    shuffle).  Repeated keys are joined to the narrow (row, key) pairs, and
    the rows found to the frame by their unique number; no wide row and no
    blank key is shuffled by key.
    """
    names = [f"__k{i}" for i in range(len(key_cols))]
    pairs = df.select(row_col, *[trimmed(c).alias(n) for c, n in zip(key_cols, names)])
    for n in names:
        pairs = pairs.where(F.col(n) != "")
    repeated = pairs.groupBy(*names).agg(F.count(F.lit(1)).alias("__occurrences")).where("__occurrences > 1").select(*names)
    rows = pairs.join(repeated, names).select(row_col, F.lit(True).alias(flag))
    return df.join(rows, row_col, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def annotate(df: DataFrame, contract: dict[str, Any], row_col: str = "source_row") -> DataFrame:
    """Add ``issue_mask`` (0 for a valid row) and the per-row helper columns
    (``__t_*``, ``__n_*``, ``__ts_*``) later layers reuse.  ``row_col``
    numbers the rows."""
    names = [c["name"] for c in contract["columns"]]
    require_columns(df, [*names, row_col])
    pk = contract.get("primary_key", [])
    flagged = duplicate_keys(df, pk, row_col) if pk else df
    flagged = with_parsed(flagged, contract)
    dup = F.col("__duplicate") if pk else None
    catalogue = rules(contract, dup)
    if len(catalogue) > MAX_RULES:
        raise ValueError(f"At most {MAX_RULES} rules fit the issue mask, got {len(catalogue)}")
    mask = F.lit(0).cast("long")
    for i, rule in enumerate(catalogue):
        mask = mask.bitwiseOR(F.when(F.coalesce(rule.condition, F.lit(False)), F.lit(1 << i)).otherwise(F.lit(0)).cast("long"))
    out = flagged.withColumn(ISSUES, mask)
    return out.drop("__duplicate") if pk else out


def is_valid() -> Column:
    return F.col(ISSUES) == 0


def rule_catalogue(contract: dict[str, Any]) -> list[Rule]:
    """The rules in numbering order (conditions are not evaluated)."""
    return rules(contract, F.lit(False) if contract.get("primary_key") else None)


def _lookup(values: list[str], number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), number)


def issue_codes(contract: dict[str, Any]) -> Column:
    """A row's violated rules mapped to their issue codes, in rule order."""
    return _violated([r.code for r in rule_catalogue(contract)])


def _violated(values: list) -> Column:
    """The values, one for each rule, of the rules that a row violates."""
    return F.array_compact(F.array(*[F.when(F.getbit(ISSUES, F.lit(i)) == 1, F.lit(v)) for i, v in enumerate(values)]))


def issue_table(
    annotated: DataFrame,
    contract: dict[str, Any],
    row_col: str = "source_row",
    key_col: str = "ticket_id",
) -> DataFrame:
    """One row per (source row, violated rule).  ``issue_position`` is the
    rule's place in evaluation order: the tie-break for equal
    (source_row, issue_code).  The raw (untrimmed) id and field value are
    reported."""
    catalogue = rule_catalogue(contract)
    fields = list(dict.fromkeys(r.field for r in catalogue))
    field_no = [fields.index(r.field) + 1 for r in catalogue]
    exploded = annotated.where(~is_valid()).select(
        F.col(row_col).cast("long").alias("source_row"),
        text(key_col).alias("ticket_id"),
        F.array(*[text(f) for f in fields]).alias("__values"),
        F.explode(_violated(list(range(1, len(catalogue) + 1)))).alias("issue_position"),
    )
    rule = F.col("issue_position")
    field_index = F.element_at(F.array(*[F.lit(n) for n in field_no]), rule)
    return exploded.select(
        "source_row",
        "ticket_id",
        _lookup([r.code for r in catalogue], rule).alias("issue_code"),
        _lookup([r.field for r in catalogue], rule).alias("field"),
        F.element_at(F.col("__values"), field_index).alias("observed_value"),
        _lookup([r.message for r in catalogue], rule).alias("message"),
        rule.cast("int").alias("issue_position"),
    )


def issue_counts(issues: DataFrame) -> DataFrame:
    return issues.groupBy("issue_code").agg(F.count(F.lit(1)).alias("issue_count"))


def row_totals(annotated: DataFrame) -> DataFrame:
    """total / valid / invalid rows and valid_rate (half-even, 0.0 on no rows)."""
    total = F.count(F.lit(1))
    invalid = F.count_if(~is_valid())
    return annotated.agg(total.alias("total_rows"), invalid.alias("invalid_rows")).select(
        "total_rows",
        (F.col("total_rows") - F.col("invalid_rows")).alias("valid_rows"),
        "invalid_rows",
        safe_rate(F.col("total_rows") - F.col("invalid_rows"), F.col("total_rows")).alias("valid_rate"),
    )


def validation_report(annotated: DataFrame, contract: dict[str, Any]) -> dict[str, Any]:
    """The validation summary as a dict (one collected row + the code counts,
    both bounded: one row and one row per issue code)."""
    totals = row_totals(annotated).first().asDict()
    counts = issue_counts(issue_table(annotated, contract)).collect()
    totals["issue_counts"] = {r["issue_code"]: int(r["issue_count"]) for r in sorted(counts, key=lambda r: r["issue_code"])}
    return totals


def expectation_gate(report: dict[str, Any], expected_rows: int | None = None, expected_invalid: int | None = None) -> bool:
    """Pass iff the totals equal the expectations; without expectations pass
    iff no row is invalid."""
    if expected_rows is None and expected_invalid is None:
        return report["invalid_rows"] == 0
    ok = True
    if expected_rows is not None:
        ok &= report["total_rows"] == expected_rows
    if expected_invalid is not None:
        ok &= report["invalid_rows"] == expected_invalid
    return ok


def forbidden_columns_present(df: DataFrame, contract: dict[str, Any]) -> list[str]:
    forbidden = set(contract.get("safety", {}).get("forbidden_columns", []))
    return [c for c in df.columns if c in forbidden]
