"""Classification, extraction, risk, alerts and the whole job."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators import classify as cl
from tidewright.operators import extract as ex
from tidewright.operators import risk as rk
from tidewright.operators.scorer import score_with, with_retry
from tidewright.plans import monitoring as mon
from tidewright.sources import writers
from tidewright.streaming import monitor as mo

SCHEMA = "event_id long, ts timestamp_ntz, source string, service string, raw_payload string, metadata string"


@pytest.fixture
def events(frame):
    from datetime import datetime, timedelta

    texts = [
        ("cloud_logging", "checkout", "ERROR pod-1 NullPointerException: address was null"),
        ("application", "payments", "CRITICAL pod-2 upstream timeout after 10 s, HTTP 504"),
        ("cloud_logging", "inventory", "CRITICAL pod-3 OOMKilled: over the memory limit"),
        ("deploy", "checkout", "DEPLOY checkout v2: adds a cache"),
        ("cloud_logging", "frontend", "INFO pod-4 health check passed"),
    ]
    at = datetime(2024, 1, 1)
    return frame([(i, at + timedelta(minutes=i), s, v, p, "{}") for i, (s, v, p) in enumerate(texts)], SCHEMA)


def by_id(df):
    return {r.event_id: r for r in df.collect()}


def test_offline_classification(events):
    got = by_id(cl.classify(events))
    assert (got[0].event_type, got[0].severity) == ("app_error", "high")
    assert (got[2].event_type, got[2].severity) == ("metric_alert", "critical")
    assert (got[3].event_type, got[3].severity) == ("deploy", "low")
    assert got[4].severity == "low" and got[4].classification_method == "llm"
    # "log" with critical severity is not trusted
    assert got[1].event_type == "log" and got[1].classification_confidence == 0.4
    assert got[1].reasoning.endswith(cl.ADJUSTED)


def test_lists_disagree_about_timeout(frame, events):
    one = events.filter("event_id = 4").withColumn("raw_payload", F.lit("timeout"))
    failed = F.lit(None).cast("struct<event_type:string,severity:string,confidence:double,reasoning:string>")
    assert cl.classify(one).first().severity == "high"
    heuristic = cl.classify(one, failed).first()
    assert (heuristic.severity, heuristic.classification_method, heuristic.classification_confidence) == ("medium", "heuristic", 0.6)


@pytest.mark.parametrize("answer", [("bad_type", "low", 0.5, "r"), ("log", "none", 0.5, "r"), ("log", "low", 1.5, "r"), ("log", "low", 0.5, "r" * 501)])
def test_broken_answers_fall_back(events, answer):
    model = F.struct(*[F.lit(v).alias(n) for v, n in zip(answer, ("event_type", "severity", "confidence", "reasoning"))])
    assert {r.classification_method for r in cl.classify(events, model).collect()} == {"heuristic"}


def test_coherence_of_unknown_and_blank(frame):
    df = frame([("unknown", "low", 0.9, " \t "), ("unknown", "low", 0.5, " x ")], "k string, s string, c double, r string")
    assert [(r.c, r.r) for r in cl.cohere(df, "k", "s", "c", "r").collect()] == [(0.3, cl.NO_REASON), (0.5, "x")]


def test_regex_fields(events):
    got = {r.event_id: r.f for r in events.select("event_id", ex.regex_fields().alias("f")).collect()}
    assert got[2].error_code == "OOMKilled" and got[1].error_code == "timeout" and got[4].error_code == ""


def test_cause_rules_first_match(events):
    got = by_id(ex.root_cause(ex.extract(cl.classify(events))))
    assert got[2].root_cause.startswith("Memory") and got[3].root_cause.startswith("Recent deployment")
    assert len(got) == 5 and all(r.recommendations for r in got.values())


def test_risk_rounds_half_to_even(frame):
    rows = [("critical", "app_error", "checkout", False, 0.0, 0.85), ("critical", "app_error", "checkout", True, 50.0, 1.0), ("low", "log", "none", True, 1.0, 0.6)]
    df = frame(rows, "severity string, event_type string, service string, is_anomaly boolean, z_score double, classification_confidence double")
    got = [(r.risk_score, r.risk_level) for r in rk.score_risk(df).collect()]
    # 68.5 -> 68, 100 at most, 5 + 3 + 7 + 20 + 3 - 4 = 34
    assert got == [(68, "high"), (100, "critical"), (34, "low")]


def test_enrich_and_alerts(events):
    rich = mon.enrich(events, "r1")
    rows = by_id(rich)
    assert len(rows) == 5 and all(r.root_cause and r.extracted_summary and r.risk_level for r in rows.values())
    assert rk.build_alerts(rich, "r1", threshold=40).filter("event_id = 2").count() == 1
    assert rk.build_alerts(rich, "r1", threshold=80).filter("event_id = 4").count() == 0
    a, b = (rk.build_alerts(rich, "r1", 40).select("alert_id").collect() for _ in range(2))
    assert sorted(a) == sorted(b)


def test_prices_and_failed_calls(frame):
    df = frame([("gpt-4o", 1000, 100), ("mine", 1000, 100), (None, 0, 0)], "model_id string, input_tokens int, output_tokens int")
    got = {r.model_id: r.estimated_cost_usd for r in rk.price_calls(df).collect()}
    assert got == {"gpt-4o": 0.0035, "mine": 0.0045, None: 0.0}


def test_no_calls_gives_zeros(frame):
    df = frame([], "input_tokens int, output_tokens int, estimated_cost_usd double, fallback_used boolean, latency_ms double")
    assert tuple(rk.calls_summary(df).first()) == (0, 0, 0, 0.0, 0.0, 0.0)


def test_delta_over_cycles(frame):
    df = frame([(1, 2, 10.0), (2, 5, 16.0), (3, 5, 13.0), (7, 1, 2.0)], "cycle long, anomalies long, avg_risk double")
    got = [(r.anomaly_delta, r.anomaly_trend, r.risk_delta, r.risk_trend) for r in rk.delta_vs_previous(df).orderBy("cycle").collect()]
    assert got == [(None, None, None, None), (3, "up", 6.0, "up"), (0, "flat", -3.0, "flat"), (-4, "down", -11.0, "down")]


def test_scorer_isolates_failing_rows(frame):
    def score(pdf):
        if (pdf["x"] == 7).any():
            raise ValueError("seven")
        return pd.DataFrame({"y": pdf["x"] * 2.0})

    df = frame([(i,) for i in range(20)], "x long")
    got = {r.x: r.answer for r in score_with(df, score, "y double", wait=0.0).collect()}
    assert got[7] is None and all(got[i].y == 2.0 * i for i in range(20) if i != 7)


def test_scorer_is_not_asked_once_per_good_row(frame, tmp_path):
    def score(pdf):
        with open(tmp_path / f"{os.getpid()}-{time.time_ns()}", "w") as f:
            f.write(str(len(pdf)))
        if (pdf["t"].str.len() > 50).any():
            raise ValueError("too long")
        return pd.DataFrame({"y": pdf["x"] * 2.0})

    rows = [(i, "a" * (60 if i % 10 == 3 else i % 40) if i % 17 else None) for i in range(1000)]
    df = frame(rows, "x long, t string").coalesce(1)
    got = {r.x: r.answer for r in score_with(df, score, "y double", attempts=1).collect()}
    bad = {i for i, t in rows if t and len(t) > 50}
    assert all((got[i] is None) if i in bad else (got[i].y == 2.0 * i) for i, _ in rows)
    assert len(os.listdir(tmp_path)) < len(bad) + 60


def test_retry_gives_up_after_attempts():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 2:
            raise OSError("once")
        return "ok"

    assert with_retry(flaky, 2, wait=0.0) == "ok"
    with pytest.raises(ZeroDivisionError):
        with_retry(lambda: 1 / 0, 2, wait=0.0)


def test_one_failing_sink_does_not_stop_the_other(events, tmp_path):
    def refuse(df, batch_id):
        raise OSError("down")

    outcome = writers.emit(events, 3, {"bad": refuse, "good": writers.table_sink(str(tmp_path / "a"))})
    assert outcome["good"] is None and "down" in outcome["bad"]
    assert events.sparkSession.read.parquet(str(tmp_path / "a")).count() == 5


def test_repeated_batch_replaces_itself(spark, events, tmp_path):
    out, states = str(tmp_path / "out"), str(tmp_path / "states")
    for _ in range(2):
        mo.process_batch(events, 0, out, states, "r")
    mo.process_batch(events.withColumn("event_id", F.col("event_id") + 10).withColumn("ts", F.col("ts") + F.expr("interval 1 day")), 1, out, states, "r")
    assert mo.read_results(spark, out).count() == 10
    assert mo.read_states(spark, states, 1).agg(F.sum("count")).first()[0] == 10


def test_reset_forgets(spark, events, tmp_path):
    out, states = str(tmp_path / "out"), str(tmp_path / "states")
    mo.process_batch(events, 0, out, states, "r")
    mo.reset_states(spark, states, 0)
    assert mo.read_states(spark, states, 0).count() == 0
