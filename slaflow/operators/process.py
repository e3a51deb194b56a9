"""Process intelligence: event logs, cases, variants, transitions,
bottlenecks and exception paths.

Two kinds of event log are handled:

* **derived** logs (one service request -> its lifecycle events): the
  events are generated inside the row as one sorted array, so event index,
  case summary, variant and transition pairs need no shuffle at all;
* **observed** logs (rows of an event table such as ``events``): events of
  a case are ordered by a distributed ordinal and paired in blocks of
  consecutive ordinals, so a case holding a third of all rows is still
  spread over every task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from slaflow.contract import BOTTLENECK_BOUNDARY, EVENT_ORIGIN, MIN_BOTTLENECK_CASES
from slaflow.functions.numeric import clamp, count_when, kpi_round, safe_rate, scaled_round
from slaflow.functions.temporal import add_minutes_micros, fraction_micros, micros_to_minutes
from slaflow.operators import sketches
from slaflow.operators.ordinal import with_ordinal
from slaflow.operators.quantiles import exact_quantiles
from slaflow.sources.tables import require_columns

PROCESS_SOURCE_COLUMNS = [
    "ticket_id",
    "created_at",
    "closed_at",
    "assigned_team",
    "category",
    "priority",
    "customer_segment",
    "status",
    "sla_target_minutes",
    "resolution_minutes",
    "reopened_count",
    "escalated",
    "sla_met",
]
# ---------------------------------------------------------------------------
# Lifecycle derivation of a service request.  Percentages are
# of the closed duration (closed_at - created_at); shares are of the
# duration in minutes (closed) or of the SLA target (open).
# ---------------------------------------------------------------------------
ASSIGNMENT_SHARE = 0.05
ASSIGNMENT_MIN_MINUTES = 1.0
ASSIGNMENT_MAX_MINUTES = 15.0
ESCALATION_PERCENT = 45
ESCALATION_PERCENT_WHEN_REOPENED = 30
OPEN_ESCALATION_SHARE = 0.75
ONE_REOPEN_PERCENTS = (58, 68)  # resolution recorded, reopened
TWO_REOPEN_PERCENTS = (38, 47, 68, 76)  # resolution, reopened, resolution, reopened
FINAL_RESOLUTION_PERCENT = 90
# Interpretation note attached to bottlenecks of observed logs (our wording).
OBSERVED_BOUNDARY = "Observed waiting time; concentration signal, not causal root cause."
# --------------------------------------------------------------------------- end of fixed values
CASE_CONTEXT = ["assigned_team", "category", "priority", "customer_segment", "status"]
EVENTS = "__events"
SEPARATOR = " > "
#: An unnamed activity in a sequence that is digested.
NO_ACTIVITY = "?"


# --------------------------------------------------------------------------- derived log (G1-G9)


def _event(condition: Column | None, ts_micros: Column, seq: int, activity: str) -> tuple[Column | None, Column]:
    value = F.struct(ts_micros.cast("long").alias("ts"), F.lit(seq).alias("seq"), F.lit(activity).alias("activity"))
    return condition, (value if condition is None else F.when(condition, value))


def lifecycle_events() -> Column:
    """Sorted ``array<struct<ts:long micros, seq:int, activity:string>>`` of one
    request's lifecycle.

    Closed requests: created, team assigned after clamp(1..15, round-half-even
    of 5 % of the duration) minutes, an escalation at 45 % of the duration
    (30 % when reopened), resolution/reopen pairs at 58/68 % (one reopen) or
    38/47/68/76 % (two), the final resolution at 90 % and the closure.  Open
    requests: created, team assigned after clamp(1..15, 5 % of the SLA
    target) minutes, and an escalation at max(assigned + 1, 75 % of the
    target) minutes.  Events are ordered by (timestamp, sequence).

    Built from codegen-capable expressions only: absent events are NULL,
    ``sort_array`` puts NULLs first, and ``slice`` skips exactly as many as
    the event conditions say are absent (no lambda functions per row).
    """
    created = F.unix_micros(F.col("created_at"))
    closed_ts = F.unix_micros(F.col("closed_at"))
    duration = closed_ts - created
    is_closed = F.col("status") == "closed"
    escalated = F.coalesce(F.col("escalated"), F.lit(False))
    reopened = F.col("reopened_count")
    sla = F.col("sla_target_minutes").cast("double")

    lo, hi = ASSIGNMENT_MIN_MINUTES, ASSIGNMENT_MAX_MINUTES
    assigned_closed = clamp(F.rint(micros_to_minutes(duration) * F.lit(ASSIGNMENT_SHARE)), lo, hi)
    assigned_open = clamp(F.rint(sla * F.lit(ASSIGNMENT_SHARE)), lo, hi)
    assigned = F.when(is_closed, assigned_closed).otherwise(assigned_open).cast("long")
    escalation_open = F.greatest(assigned + 1, F.rint(sla * F.lit(OPEN_ESCALATION_SHARE)).cast("long"))

    def at(percent: Column | int) -> Column:
        return fraction_micros(created, duration, percent)

    def minutes_after(minutes: Column) -> Column:
        return add_minutes_micros(created, minutes)

    one, two = is_closed & (reopened == 1), is_closed & (reopened == 2)
    escalation_pct = F.when(reopened != 0, F.lit(ESCALATION_PERCENT_WHEN_REOPENED)).otherwise(F.lit(ESCALATION_PERCENT))
    r1_res, r1_reo = ONE_REOPEN_PERCENTS
    r2_res1, r2_reo1, r2_res2, r2_reo2 = TWO_REOPEN_PERCENTS
    events = [
        _event(None, created, 0, "ticket_created"),
        _event(None, minutes_after(assigned), 1, "team_assigned"),
        _event(is_closed & escalated, at(escalation_pct), 2, "escalated"),
        _event(~is_closed & escalated, minutes_after(escalation_open), 2, "escalated"),
        _event(one, at(r1_res), 3, "resolution_recorded"),
        _event(one, at(r1_reo), 4, "reopened"),
        _event(two, at(r2_res1), 3, "resolution_recorded"),
        _event(two, at(r2_reo1), 4, "reopened"),
        _event(two, at(r2_res2), 5, "resolution_recorded"),
        _event(two, at(r2_reo2), 6, "reopened"),
        _event(is_closed, at(FINAL_RESOLUTION_PERCENT), 7, "resolution_recorded"),
        _event(is_closed, closed_ts, 8, "ticket_closed"),
    ]
    absent = F.lit(0)
    for condition, _ in events:
        if condition is not None:
            absent = absent + F.when(condition, F.lit(0)).otherwise(F.lit(1))
    ordered = F.sort_array(F.array(*[value for _, value in events]), asc=True)
    return F.slice(ordered, absent + 1, F.lit(len(events)) - absent)


def check_process_source(valid: DataFrame) -> None:
    require_columns(valid, sorted(PROCESS_SOURCE_COLUMNS), "Process-intelligence source")


def with_lifecycle(valid: DataFrame) -> DataFrame:
    """The requests with their events; those that have them are left alone,
    so the events can be derived once and written."""
    return valid if EVENTS in valid.columns else valid.withColumn(EVENTS, lifecycle_events())


def event_id(case_id: Column, index: Column) -> Column:
    return F.format_string("%s-E%02d", case_id, index)


def event_log(valid: DataFrame) -> DataFrame:
    """One row per derived event, with the case context copied to each."""
    arr = with_lifecycle(valid)
    exploded = arr.select(
        F.col("ticket_id").alias("case_id"),
        *CASE_CONTEXT,
        "sla_met",
        F.coalesce(F.col("escalated"), F.lit(False)).alias("escalated_case"),
        F.col("reopened_count").cast("long").alias("reopened_count"),
        F.posexplode(EVENTS).alias("__pos", "__e"),
    )
    index = (F.col("__pos") + 1).cast("int")
    return exploded.select(
        event_id(F.col("case_id"), index).alias("event_id"),
        "case_id",
        *CASE_CONTEXT,
        "sla_met",
        "escalated_case",
        "reopened_count",
        F.lit(EVENT_ORIGIN).alias("event_origin"),
        index.alias("event_index"),
        F.col("__e.activity").alias("activity"),
        F.timestamp_micros(F.col("__e.ts")).alias("event_timestamp"),
    )


def exception_type(escalated: Column, reopened: Column) -> Column:
    return (
        F.when(escalated & (reopened != 0), F.lit("escalated_and_reopened"))
        .when(reopened != 0, F.lit("reopened_only"))
        .when(escalated, F.lit("escalated_only"))
        .otherwise(F.lit("standard"))
    )


def variant_of(events: Column) -> Column:
    return F.array_join(events["activity"], " > ")


def cases(valid: DataFrame) -> DataFrame:
    """One row per case, summarised from its in-row event array (no shuffle)."""
    arr = with_lifecycle(valid)
    first = F.col(EVENTS)[0]["ts"]
    last = F.element_at(F.col(EVENTS), -1)["ts"]
    escalated = F.coalesce(F.col("escalated"), F.lit(False))
    return arr.select(
        F.col("ticket_id").alias("case_id"),
        *CASE_CONTEXT,
        F.col("sla_target_minutes").cast("long").alias("sla_target_minutes"),
        F.col("reopened_count").cast("long").alias("reopened_count"),
        escalated.alias("escalated_case"),
        "sla_met",
        F.size(EVENTS).cast("long").alias("event_count"),
        F.timestamp_micros(first).alias("first_event_at"),
        F.timestamp_micros(last).alias("last_event_at"),
        variant_of(F.col(EVENTS)).alias("process_variant"),
        scaled_round(micros_to_minutes(last - first), 2).alias("observed_span_minutes"),
        F.col("resolution_minutes").cast("double").alias("throughput_minutes"),
        exception_type(escalated, F.col("reopened_count")).alias("exception_type"),
    )


def derived_pairs(valid: DataFrame) -> DataFrame:
    """(source, target, wait) of consecutive derived events, from the row's
    own sorted array."""
    arr = with_lifecycle(valid)
    n = F.size(EVENTS) - 1
    ts, act = F.col(EVENTS)["ts"], F.col(EVENTS)["activity"]
    steps = F.arrays_zip(
        F.slice(act, 1, n).alias("source_activity"),
        F.slice(act, 2, n).alias("target_activity"),
        F.slice(ts, 1, n).alias("source_ts"),
        F.slice(ts, 2, n).alias("target_ts"),
    )
    wait_us = F.col("s.target_ts") - F.col("s.source_ts")
    return arr.select(F.explode(steps).alias("s")).select(
        "s.source_activity",
        "s.target_activity",
        wait_us.alias("wait_us"),
        micros_to_minutes(wait_us).alias("wait_minutes"),
    )


# --------------------------------------------------------------------------- observed logs


RANK = "__r"
BLOCK_EVENTS = 100_000
PIECE_EVENTS = 10_000


def number_events(
    log: DataFrame,
    case_cols: Sequence[str],
    order_cols: Sequence[str],
    activity_col: str,
    ts_col: str,
) -> DataFrame:
    """Events of an observed log with a global rank in (case, order) order:
    ranks are contiguous inside each case.  The ordinal's snapshot is
    materialised, so every consumer sees the same numbering."""
    case_cols, order_cols = list(case_cols), list(order_cols)
    base = log.select(
        *case_cols,
        *[c for c in order_cols if c not in case_cols],
        F.col(activity_col).alias("__a"),
        F.col(ts_col).cast("timestamp").alias("__t"),
    )
    return with_ordinal(base, [*case_cols, *order_cols], name=RANK)


def pairs_of_numbered(numbered: DataFrame, case_cols: Sequence[str], block: int = BLOCK_EVENTS) -> DataFrame:
    """(source, target, wait, time) of consecutive events of a case.  ``lead`` runs
    in blocks of ``block`` consecutive ranks, so a case of any size is spread
    over tasks; the last event of a block meets the first one of the next
    through a join of one row for each block.  A NULL case is a case like any
    other, as in SQL's grouping."""
    case_cols = list(case_cols)
    case = F.struct(*[F.col(c) for c in case_cols]).alias("case")
    rows = numbered.select(
        RANK, F.floor(F.col(RANK) / block).alias("__block"), F.struct(case, F.col("__a").alias("a"), F.col("__t").alias("t")).alias("e")
    )
    order = Window.partitionBy("__block").orderBy(RANK)
    paired = rows.withColumn("next", F.lead("e").over(order))
    heads = rows.groupBy("__block").agg(F.min_by("e", RANK).alias("head"), F.min(RANK).alias("first"))
    heads = heads.select((F.col("__block") - 1).alias("__block"), "head")
    last = paired.where(F.col("next").isNull()).drop("next").join(heads, "__block")
    both = paired.where(F.col("next").isNotNull()).select("e", "next").unionByName(last.select("e", F.col("head").alias("next")))
    wait_us = F.unix_micros("next.t") - F.unix_micros("e.t")
    return both.where(F.col("e.case").eqNullSafe(F.col("next.case"))).select(
        F.col("e.a").alias("source_activity"),
        F.col("next.a").alias("target_activity"),
        wait_us.alias("wait_us"),
        micros_to_minutes(wait_us).alias("wait_minutes"),
        F.col("next.t").alias("at"),
    )


def successor_pairs(
    log: DataFrame,
    case_cols: Sequence[str],
    order_cols: Sequence[str],
    activity_col: str,
    ts_col: str,
) -> DataFrame:
    """(source, target, wait) of consecutive events of each case of an
    observed log, ordered by ``order_cols`` within the case."""
    return pairs_of_numbered(number_events(log, case_cols, order_cols, activity_col, ts_col), case_cols)


def numbered_in_case(numbered: DataFrame, case_cols: Sequence[str]) -> DataFrame:
    """The events with their position in their case, from 0."""
    case_cols = list(case_cols)
    firsts = numbered.groupBy(*[F.col(c).alias(f"__first_{c}") for c in case_cols]).agg(F.min(RANK).alias("__first_rank"))
    same = [F.col(c).eqNullSafe(F.col(f"__first_{c}")) for c in case_cols]
    joined = numbered.join(firsts, same)
    return joined.select(*case_cols, RANK, (F.col(RANK) - F.col("__first_rank")).alias("__pos"), "__a", "__t")


def observed_cases(positioned: DataFrame, case_cols: Sequence[str], piece_events: int = PIECE_EVENTS) -> DataFrame:
    """Per case of an observed log (``numbered_in_case``): event count,
    first/last time, span and the digest of its activity sequence.

    Sequences are digested in pieces of at most ``piece_events`` events, each
    in its own group, and a case's digest is that of its pieces' digests in
    order; so no task holds a hot case's events, and no sequence is a value
    that is shuffled or grouped by.
    """
    case_cols = list(case_cols)
    ordered = F.sort_array(F.collect_list(F.struct("__pos", "__a")))["__a"]
    pieces = positioned.groupBy(*case_cols, F.floor(F.col("__pos") / F.lit(piece_events)).alias("__piece")).agg(
        F.count(F.lit(1)).alias("__n"),
        F.min("__t").alias("__first"),
        F.max("__t").alias("__last"),
        F.md5(F.array_join(ordered, SEPARATOR, NO_ACTIVITY)).alias("__digest"),
    )
    cases = pieces.groupBy(*case_cols).agg(
        F.sum("__n").alias("event_count"),
        F.min("__first").alias("first_event_at"),
        F.max("__last").alias("last_event_at"),
        F.md5(F.array_join(F.sort_array(F.collect_list(F.struct("__piece", "__digest")))["__digest"], SEPARATOR)).alias("variant_id"),
    )
    first, last = F.col("first_event_at"), F.col("last_event_at")
    return cases.select(
        *case_cols,
        F.col("event_count").cast("long").alias("event_count"),
        first,
        last,
        "variant_id",
        scaled_round(micros_to_minutes(F.unix_micros(last) - F.unix_micros(first)), 2).alias("observed_span_minutes"),
    )


def observed_variant_steps(positioned: DataFrame, case_table: DataFrame, case_cols: Sequence[str]) -> DataFrame:
    """The activity sequence of each variant, one row for each position (from
    1), read from the variant's smallest case."""
    case_cols = list(case_cols)
    case = F.struct(*[F.col(c) for c in case_cols])
    shown = case_table.groupBy("variant_id").agg(F.min(case).alias("__case"))
    same = [F.col(c).eqNullSafe(F.col("__case")[c]) for c in case_cols]
    return positioned.join(shown, same).select(
        "variant_id", (F.col("__pos") + 1).cast("long").alias("position"), F.col("__a").alias("activity")
    )


# --------------------------------------------------------------------------- aggregates


def transition_performance(pairs: DataFrame) -> DataFrame:
    """Per (source, target): occurrences (named ``case_count``), mean,
    median and 90th percentile wait, rounded half-even to 2 decimals.  The
    mean is taken from the exact integer sum of microsecond waits, so it
    does not depend on summation order."""
    stats = exact_quantiles(
        pairs,
        ["source_activity", "target_activity"],
        "wait_minutes",
        {"__median": 0.5, "__p90": 0.9},
        count_name="case_count",
        sum_of="wait_us",
        sum_name="__sum_us",
    )
    mean = micros_to_minutes(F.col("__sum_us").cast("double") / F.col("case_count"))
    return stats.select(
        "source_activity",
        "target_activity",
        "case_count",
        kpi_round(mean, 2).alias("average_wait_minutes"),
        kpi_round(F.col("__median"), 2).alias("median_wait_minutes"),
        kpi_round(F.col("__p90"), 2).alias("p90_wait_minutes"),
    )


def transition_sketches(pairs: DataFrame, grain: Sequence[str] = (), k: int = sketches.K) -> DataFrame:
    """Occurrences, exact sum and sketch of the waits per (source, target) and
    the columns of ``grain``, to be stored and merged."""
    return sketches.sketch(pairs, [*grain, "source_activity", "target_activity"], "wait_minutes", k, {"sum_us": "wait_us"})


def transitions_of_sketches(stored: DataFrame, k: int = sketches.K) -> DataFrame:
    """``transition_performance`` made of stored sketches of any grain: means
    and counts are exact, quantiles hold to the stated rank error."""
    merged = sketches.merge(stored, ["source_activity", "target_activity"], k, ["sum_us"])
    mean = micros_to_minutes(F.col("sum_us").cast("double") / F.col("n"))
    return merged.select(
        "source_activity",
        "target_activity",
        F.col("n").alias("case_count"),
        kpi_round(mean, 2).alias("average_wait_minutes"),
        kpi_round(sketches.quantile(0.5), 2).alias("median_wait_minutes"),
        kpi_round(sketches.quantile(0.9), 2).alias("p90_wait_minutes"),
    )


def bottlenecks(
    transitions: DataFrame, min_cases: int = MIN_BOTTLENECK_CASES, boundary: str = BOTTLENECK_BOUNDARY
) -> DataFrame:
    """Transitions with enough support ranked by mean wait.  The ranked table
    has one row per activity pair, so its one-partition window is bounded
    by the squared number of activities."""
    order = Window.orderBy(
        F.col("average_wait_minutes").desc(), F.col("case_count").desc(), "source_activity", "target_activity"
    )
    return (
        transitions.where(F.col("case_count") >= min_cases)
        .select(
            F.row_number().over(order).cast("long").alias("bottleneck_rank"),
            "source_activity",
            "target_activity",
            "case_count",
            "average_wait_minutes",
            "median_wait_minutes",
            "p90_wait_minutes",
            F.lit(boundary).alias("interpretation_boundary"),
        )
    )


def _closed() -> Column:
    return F.col("status") == "closed"


def _total(df: DataFrame) -> Column:
    """The number of rows, as a scalar subquery of the plan."""
    return df.agg(F.count(F.lit(1))).scalar()


def variants(case_table: DataFrame) -> DataFrame:
    """Variant table of service-request cases."""
    closed = count_when(_closed())
    breaches = count_when(_closed() & (F.col("sla_met") == F.lit(False)))
    return (
        case_table.groupBy("process_variant")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            closed.alias("closed_cases"),
            count_when(F.col("status") == "open").alias("open_cases"),
            count_when(F.col("exception_type") != "standard").alias("exception_cases"),
            F.avg(F.when(_closed(), F.col("throughput_minutes"))).alias("__avg"),
            breaches.alias("__breaches"),
        )
        .select(
            "process_variant",
            "case_count",
            safe_rate(F.col("case_count"), _total(case_table)).alias("case_share"),
            "closed_cases",
            "open_cases",
            "exception_cases",
            kpi_round(F.col("__avg"), 2).alias("average_throughput_minutes"),
            safe_rate(F.col("__breaches"), F.col("closed_cases")).alias("sla_breach_rate"),
        )
    )


def observed_variants(case_table: DataFrame) -> DataFrame:
    """Variant table of an observed log: cases, share, events per case and
    mean span (from the exact integer sum of microsecond spans)."""
    return (
        case_table.groupBy("variant_id")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            F.max("event_count").alias("event_count"),
            F.sum(F.unix_micros("last_event_at") - F.unix_micros("first_event_at")).alias("__span_us"),
        )
        .select(
            "variant_id",
            "case_count",
            safe_rate(F.col("case_count"), _total(case_table)).alias("case_share"),
            "event_count",
            kpi_round(micros_to_minutes(F.col("__span_us").cast("double") / F.col("case_count")), 2).alias(
                "average_span_minutes"
            ),
        )
    )


def exception_paths(case_table: DataFrame) -> DataFrame:
    closed = count_when(_closed())
    breaches = count_when(_closed() & (F.col("sla_met") == F.lit(False)))
    return (
        case_table.where(F.col("exception_type") != "standard")
        .groupBy("exception_type")
        .agg(
            F.count(F.lit(1)).alias("case_count"),
            closed.alias("closed_cases"),
            count_when(F.col("status") == "open").alias("open_cases"),
            F.avg(F.when(_closed(), F.col("throughput_minutes"))).alias("__avg"),
            breaches.alias("__breaches"),
            F.sum("reopened_count").cast("long").alias("reopen_occurrences"),
        )
        .select(
            "exception_type",
            "case_count",
            "closed_cases",
            "open_cases",
            kpi_round(F.col("__avg"), 2).alias("average_throughput_minutes"),
            safe_rate(F.col("__breaches"), F.col("closed_cases")).alias("sla_breach_rate"),
            "reopen_occurrences",
        )
    )
