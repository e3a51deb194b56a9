"""Golden checks recomputed from the reference's published evidence values
(fixed values copied as data: transition and variant tables of its
1,000-row fixture)."""

from pyspark.sql import functions as F

from slaflow.contract import BOTTLENECK_BOUNDARY
from slaflow.operators import process

# Published transition table (source, target, occurrences, mean, median, p90).
TRANSITIONS = [
    ("ticket_created", "team_assigned", 989, 14.18, 15.0, 15.0),
    ("resolution_recorded", "ticket_closed", 833, 83.58, 69.4, 171.36),
    ("team_assigned", "resolution_recorded", 758, 712.59, 601.95, 1458.03),
    ("team_assigned", "escalated", 85, 450.94, 339.15, 1046.28),
    ("escalated", "resolution_recorded", 75, 411.04, 312.75, 888.75),
    ("reopened", "resolution_recorded", 51, 190.3, 126.28, 381.26),
    ("resolution_recorded", "reopened", 51, 86.85, 60.2, 173.3),
]
# Published variant table (variant, cases, closed, open).
VARIANTS = [
    ("ticket_created > team_assigned > resolution_recorded > ticket_closed", 714, 714, 0),
    ("ticket_created > team_assigned", 146, 0, 146),
    ("ticket_created > team_assigned > escalated > resolution_recorded > ticket_closed", 71, 71, 0),
    ("ticket_created > team_assigned > resolution_recorded > reopened > resolution_recorded > ticket_closed", 41, 41, 0),
    ("ticket_created > team_assigned > escalated", 10, 0, 10),
    ("ticket_created > team_assigned > escalated > resolution_recorded > reopened > resolution_recorded > ticket_closed", 4, 4, 0),
    (
        "ticket_created > team_assigned > resolution_recorded > reopened > resolution_recorded > reopened > resolution_recorded > ticket_closed",
        3,
        3,
        0,
    ),
]


def test_bottleneck_ranking_reproduces_published_order(spark):
    t = spark.createDataFrame(
        TRANSITIONS,
        "source_activity string, target_activity string, case_count long, average_wait_minutes double, median_wait_minutes double, p90_wait_minutes double",
    )
    got = [(r["bottleneck_rank"], r["source_activity"], r["target_activity"]) for r in process.bottlenecks(t).collect()]
    assert got == [
        (1, "team_assigned", "resolution_recorded"),
        (2, "team_assigned", "escalated"),
        (3, "escalated", "resolution_recorded"),
        (4, "reopened", "resolution_recorded"),
        (5, "resolution_recorded", "reopened"),
        (6, "resolution_recorded", "ticket_closed"),
        (7, "ticket_created", "team_assigned"),
    ]
    assert {r["interpretation_boundary"] for r in process.bottlenecks(t).collect()} == {BOTTLENECK_BOUNDARY}


def _case_table(spark):
    rows = []
    n = 0
    for variant, count, closed, _ in VARIANTS:
        acts = variant.split(" > ")
        for i in range(count):
            n += 1
            rows.append(
                (
                    f"C{n}",
                    variant,
                    "closed" if i < closed else "open",
                    acts.count("reopened"),
                    "escalated" in acts,
                    100.0 if i < closed else None,
                    True if i < closed else None,
                )
            )
    df = spark.createDataFrame(rows, "case_id string, process_variant string, status string, reopened_count long, escalated_case boolean, throughput_minutes double, sla_met boolean")
    return df.withColumn("exception_type", process.exception_type(F.col("escalated_case"), F.col("reopened_count")))


def test_exception_paths_from_published_variants(spark):
    paths = {r["exception_type"]: r for r in process.exception_paths(_case_table(spark)).collect()}
    assert {k: v["case_count"] for k, v in paths.items()} == {"escalated_only": 81, "reopened_only": 44, "escalated_and_reopened": 4}
    assert paths["reopened_only"]["reopen_occurrences"] == 47
    assert paths["escalated_and_reopened"]["reopen_occurrences"] == 4
    assert (paths["escalated_only"]["closed_cases"], paths["escalated_only"]["open_cases"]) == (71, 10)


def test_variant_table_shares(spark):
    v = {r["process_variant"]: r for r in process.variants(_case_table(spark)).collect()}
    top = v[VARIANTS[0][0]]
    assert (top["case_count"], top["case_share"]) == (714, 0.7219)
    assert v[VARIANTS[1][0]]["average_throughput_minutes"] is None
    assert v[VARIANTS[1][0]]["sla_breach_rate"] == 0.0


def test_transition_counts_from_published_variants(spark):
    rows = []
    for variant, count, _, _ in VARIANTS:
        acts = variant.split(" > ")
        rows += [(a, b, 60_000_000, 1.0) for a, b in zip(acts, acts[1:])] * count
    pairs = spark.createDataFrame(rows, "source_activity string, target_activity string, wait_us long, wait_minutes double")
    got = {(r["source_activity"], r["target_activity"]): r["case_count"] for r in process.transition_performance(pairs).collect()}
    assert got == {(s, t, ): c for s, t, c, *_ in TRANSITIONS}
