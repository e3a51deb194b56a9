import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from fixtures import VALID_CLOSED, VALID_OPEN, bronze_rows
from slaflow.operators import process
from slaflow.plans.layers import MedallionLayers, process_controls


def _layers(spark, rows):
    return MedallionLayers(bronze_rows(spark, rows))


T0 = dt.datetime(2026, 5, 1, 8, 0, 0)


def _ts(minutes: float) -> dt.datetime:
    return T0 + dt.timedelta(minutes=minutes)


def _closed(tid, minutes, **kw):
    closed = (T0 + dt.timedelta(minutes=minutes)).strftime("%Y-%m-%dT%H:%M:%SZ")
    return VALID_CLOSED | {"ticket_id": tid, "closed_at": closed, "resolution_minutes": str(int(minutes)), "sla_target_minutes": "2880", "priority": "P4"} | kw


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        _closed("SR-000010", 120),
        _closed("SR-000011", 1000, reopened_count="2", escalated="true"),
        VALID_OPEN | {"ticket_id": "SR-000012", "priority": "P1", "sla_target_minutes": "240", "escalated": "true"},
        _closed("SR-000013", 1),
        _closed("SR-000014", 1000, reopened_count="1"),
    ]
    L = _layers(spark, rows)
    events = L.event_log.orderBy("case_id", "event_index").collect()
    by_case = {}
    for e in events:
        by_case.setdefault(e["case_id"], []).append((e["activity"], e["event_timestamp"]))
    return L, by_case


def test_plain_closed_case(log):
    _, by_case = log
    assert by_case["SR-000010"] == [
        ("ticket_created", _ts(0)),
        ("team_assigned", _ts(6)),
        ("resolution_recorded", _ts(108)),
        ("ticket_closed", _ts(120)),
    ]


def test_escalated_twice_reopened_case(log):
    _, by_case = log
    assert by_case["SR-000011"] == [
        ("ticket_created", _ts(0)),
        ("team_assigned", _ts(15)),
        ("escalated", _ts(300)),
        ("resolution_recorded", _ts(380)),
        ("reopened", _ts(470)),
        ("resolution_recorded", _ts(680)),
        ("reopened", _ts(760)),
        ("resolution_recorded", _ts(900)),
        ("ticket_closed", _ts(1000)),
    ]


def test_open_escalated_case(log):
    _, by_case = log
    assert by_case["SR-000012"] == [("ticket_created", _ts(0)), ("team_assigned", _ts(12)), ("escalated", _ts(180))]


def test_one_minute_case_reorders_assignment(log):
    _, by_case = log
    # assignment is never earlier than +1 minute, so it follows the 90 % resolution
    assert [a for a, _ in by_case["SR-000013"]] == ["ticket_created", "resolution_recorded", "team_assigned", "ticket_closed"]


def test_cases_variants_and_controls(log):
    L, _ = log
    cases = {r["case_id"]: r for r in L.cases.collect()}
    assert cases["SR-000011"]["exception_type"] == "escalated_and_reopened"
    assert cases["SR-000014"]["exception_type"] == "reopened_only"
    assert cases["SR-000012"]["exception_type"] == "escalated_only"
    assert cases["SR-000010"]["observed_span_minutes"] == 120.0
    assert cases["SR-000012"]["throughput_minutes"] is None
    assert all(r["passed"] for r in process_controls(L).collect())


def test_zero_length_case_fails_closure_control(spark):
    L = _layers(spark, [_closed("SR-000020", 0)])
    failed = {r["control"] for r in process_controls(L).collect() if not r["passed"]}
    assert "closed_cases_end_with_ticket_closed" in failed


def test_reopen_count_beyond_two_fails_reconciliation(spark):
    L = _layers(spark, [_closed("SR-000021", 100, reopened_count="3")])
    failed = {r["control"] for r in process_controls(L).collect() if not r["passed"]}
    assert failed == {"reopened_events_reconcile"}


def test_process_source_gates(spark):
    with pytest.raises(ValueError, match="missing required columns"):
        process.check_process_source(spark.createDataFrame([("SR-1",)], "ticket_id string"))


def test_observed_successors_match_brute_force(spark):
    rows = []
    for i in range(300):
        user = 0 if i % 3 == 0 else i % 7  # user 0 holds a third of the events
        rows.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(i * 37) % 500), user, ["a", "b", "c"][i * 5 % 3]))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string")
    pairs = process.successor_pairs(events, ["user_id"], ["ts", "event_id"], "event_type", "ts")
    got = sorted((r["source_activity"], r["target_activity"], r["wait_us"]) for r in pairs.collect())
    expected = []
    for user in {r[2] for r in rows}:
        seq = sorted((r for r in rows if r[2] == user), key=lambda r: (r[1], r[0]))
        for a, b in zip(seq, seq[1:]):
            expected.append((a[3], b[3], int((b[1] - a[1]).total_seconds() * 1_000_000)))
    assert got == sorted(expected)


def test_exact_quantiles_match_numpy(spark):
    import numpy as np

    from slaflow.operators.quantiles import exact_quantiles

    vals = [(g, float(v)) for g in range(3) for v in np.random.default_rng(g).integers(0, 50, 40 + g)]
    df = spark.createDataFrame(vals, "g long, v double")
    out = {r["g"]: r for r in exact_quantiles(df, ["g"], "v", {"med": 0.5, "p90": 0.9}, count_name="n").collect()}
    for g in range(3):
        arr = np.array([v for gg, v in vals if gg == g])
        assert out[g]["n"] == len(arr)
        assert out[g]["med"] == pytest.approx(np.quantile(arr, 0.5), abs=1e-9)
        assert out[g]["p90"] == pytest.approx(np.quantile(arr, 0.9), abs=1e-9)


def _observed_log(spark, n=240):
    rows = []
    for i in range(n):
        user = 0 if i % 3 == 0 else (None if i % 7 == 1 else i % 5)  # user 0 holds a third of the events
        rows.append((i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=(i * 53) % 4000), user, ["a", "b", "c", "d"][i * 7 % 4]))
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string")
    return rows, process.number_events(events, ["user_id"], ["ts", "event_id"], "event_type", "ts")


def _digest(sequence, piece):
    md5 = lambda text: hashlib.md5(text.encode()).hexdigest()
    return md5(" > ".join(md5(" > ".join(sequence[i : i + piece])) for i in range(0, len(sequence), piece)))


def test_observed_cases_digest_pieces_like_brute_force(spark):
    rows, numbered = _observed_log(spark)
    keys = ["user_id", "activity_date"]
    positioned = process.numbered_in_case(numbered.withColumn("activity_date", F.to_date("__t")), keys)
    cases = process.observed_cases(positioned, keys, piece_events=3)
    got = {(r["user_id"], r["activity_date"]): (r["event_count"], r["variant_id"]) for r in cases.collect()}
    expected, sequences = {}, {}
    for user in {r[2] for r in rows}:
        for day in {r[1].date() for r in rows if r[2] == user}:
            seq = [r[3] for r in sorted((r for r in rows if r[2] == user and r[1].date() == day), key=lambda r: (r[1], r[0]))]
            expected[(user, day)] = (len(seq), _digest(seq, 3))
            sequences[_digest(seq, 3)] = seq
    assert got == expected
    steps = process.observed_variant_steps(positioned, cases, keys).collect()
    shown = {v: [r["activity"] for r in sorted((r for r in steps if r["variant_id"] == v), key=lambda r: r["position"])] for v in sequences}
    assert shown == sequences and len(steps) == sum(map(len, sequences.values()))


def test_pairs_in_blocks_meet_at_their_edges(spark):
    rows, numbered = _observed_log(spark)
    pairs = [process.pairs_of_numbered(numbered, ["user_id"], block=b).collect() for b in (1, 7, 1000)]
    seen = [sorted((r["source_activity"], r["target_activity"], r["wait_us"]) for r in p) for p in pairs]
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) == len(rows) - len({r[2] for r in rows})
