"""The parallel scores must equal the plain recurrence, bit for bit in the states."""

import math
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewright.operators import anomaly as an

LEVEL = {"low": 1.0, "medium": 2.0, "high": 3.0, "critical": 4.0}
SCHEMA = "ts long, event_id long, service string, event_type string, severity string"


def brute(rows, threshold=2.5, states=None):
    states, out = dict(states or {}), {}
    for _, i, service, kind, severity in sorted(rows):
        key, x = f"{service}:{kind}", LEVEL[severity]
        mean, var, n = states.get(key, (0.0, 0.0, 0))
        z = 0.0 if n < 3 else (x - mean) / (math.sqrt(var) if var > 0 else 1.0)
        out[i] = (z, abs(z) > threshold)
        if n == 0:
            states[key] = (x, 0.0, 1)
        else:
            d = x - mean
            states[key] = (0.3 * x + 0.7 * mean, 0.7 * (var + 0.3 * d * d), n + 1)
    return out, states


def rows_of(severities, service="s", kind="t", start=0):
    return [(start + i, start + i, service, kind, s) for i, s in enumerate(severities)]


def flags(frame, rows, **options):
    return {r.event_id: r.is_anomaly for r in an.EwmaRun(frame(rows, SCHEMA), **options).scores().collect()}


def hot_rows(n=6000, seed=5):
    rng, rows = random.Random(seed), []
    kinds = ["mixed", "constant", "alternating", "rare", "small"]
    turn = 0
    for i in range(n):
        kind = rng.choices(kinds, [4, 3, 2, 2, 1])[0]
        if kind == "mixed":
            severity = rng.choice(list(LEVEL))
        elif kind == "constant":
            severity = "high" if i != n * 3 // 4 else "critical"
        elif kind == "alternating":
            severity, turn = ("medium", "high")[turn % 2], turn + 1
        elif kind == "rare":
            severity = "critical" if rng.random() < 0.002 else "low"
        else:
            kind, severity = f"small{rng.randrange(200)}", rng.choice(list(LEVEL))
        rows.append((i // 3, i, "svc", kind, severity))
    return rows


@pytest.mark.parametrize("partitions", [1, 4, 23])
def test_equals_recurrence_over_partitions(frame, partitions):
    rows = hot_rows()
    want, states = brute(rows)
    run = an.EwmaRun(frame(rows, SCHEMA).repartition(3), partitions=partitions)
    got = {r.event_id: r for r in run.scores().collect()}
    assert len(got) == len(rows)
    for i, (z, flag) in want.items():
        assert got[i].is_anomaly == flag
        assert abs(got[i].z_score - z) <= 1e-3 * max(1.0, abs(z))
    assert {r.bucket: (r.mean, r.variance, r["count"]) for r in run.states().collect()} == states
    assert run.rounds <= 6  # replays run side by side, not one partition after the other


def test_saved_states_continue_exactly(frame):
    rows = hot_rows()
    half = len(rows) // 2
    want, states = brute(rows)
    first = an.EwmaRun(frame(rows[:half], SCHEMA), partitions=5)
    second = an.EwmaRun(frame(rows[half:], SCHEMA), states=first.states(), partitions=7)
    got = {r.event_id: r.is_anomaly for r in first.scores().unionByName(second.scores()).collect()}
    assert got == {i: f for i, (_, f) in want.items()}
    assert {r.bucket: (r.mean, r.variance, r["count"]) for r in second.states().collect()} == states


def test_few_points_are_never_flagged(frame):
    assert not any(flags(frame, rows_of(["low"] * 3)).values())


def test_spike_is_flagged_at_two(frame):
    got = flags(frame, rows_of(["low"] * 10 + ["critical"]), threshold=2.0)
    assert got[10] and sum(got.values()) == 1


def test_constant_is_not_flagged(frame):
    assert not any(flags(frame, rows_of(["medium"] * 20)).values())


def test_buckets_are_independent(frame):
    rows = rows_of(["low"] * 10, "a") + rows_of(["high"] * 10, "b", start=100)
    assert not any(flags(frame, rows).values())


def test_zero_variance_counts_as_one(frame):
    # After a run of 2.0 a 4.0 scores exactly 2 and is not flagged; after 3.0 the residue makes it huge.
    rows = rows_of(["medium"] * 5 + ["critical"], "a") + rows_of(["high"] * 5 + ["critical"], "b", start=100)
    got = {r.event_id: r for r in an.EwmaRun(frame(rows, SCHEMA)).scores().collect()}
    assert got[5].z_score == 2.0 and not got[5].is_anomaly
    assert got[105].z_score > 1e12 and got[105].is_anomaly


def test_snapshot_status(frame):
    rows = rows_of(["low"] * 2, "a") + rows_of(["low", "high", "low", "high"], "b", start=50)
    got = {r.bucket: r for r in an.snapshot(an.EwmaRun(frame(rows, SCHEMA)).states()).collect()}
    assert got["a:t"].status == "training" and got["a:t"].std == 0.0
    assert got["b:t"].status == "active" and got["b:t"]["count"] == 4


def test_detect_keeps_all_columns(frame):
    df = frame(rows_of(["low"] * 4), SCHEMA).withColumn("extra", F.lit("x"))
    assert set(an.detect(df).columns) == {*df.columns, "z_score", "is_anomaly"}


def test_events_are_replayed_once(frame, capsys):
    at = datetime(2024, 1, 1)
    rows = [(i, at + timedelta(seconds=i), f"s{i % 2}", "log", ("low", "high", "critical")[i % 3]) for i in range(60)]
    schema = "event_id long, ts timestamp_ntz, service string, event_type string, severity string"
    scored, states = an.detect_and_keep(frame(rows, schema))
    assert scored.count() == 60 and states.count() == 2
    scored.explain()
    states.explain()
    assert "MapIn" not in capsys.readouterr().out  # both are read from what one replay has stored


@pytest.mark.parametrize("known", [None, (2.5, 0.7, 9), (80.0, 3.0, 4)])
def test_end_of_a_stretch_tells_its_state(known):
    rng = random.Random(4)
    n = 3 * an.TAIL + 7
    stretches = {
        "mixed": [float(rng.randrange(1, 5)) for _ in range(n)], "constant": [2.0] * n, "alternating": [1.0, 4.0] * (n // 2),
        "late": [1.0] * (n - 20) + [float(rng.randrange(1, 5)) for _ in range(20)], "broken": [float("nan")] + [1.0, 2.0, 4.0] * an.TAIL,
        "short": [1.0, 3.0, 2.0],
    }
    for name, values in stretches.items():
        whole = an._Stretch(3, name, an.ALPHA)
        if known:
            whole.push(0, None, known)
        for v in values:
            whole.push(1, v, None)
        assert repr(an._summary_of(3, name, known, np.array(values), an.ALPHA)) == repr(whole.row())
