"""The monitoring job with models: contracts, dead letters, retrieval, call and run records."""

import os
from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidewright.operators.contract import CONTRACTS, Contract, Malformed, Model, ask
from tidewright.operators.quality import check, log_compliance, log_line, write_checked
from tidewright.plans import monitoring as mon
from tidewright.streaming import monitor as mo

SCHEMA = "event_id long, ts timestamp_ntz, source string, service string, raw_payload string, metadata string"


@pytest.fixture
def events(frame):
    at = datetime(2024, 1, 1)
    payloads = ["ERROR broke", "BOOM refuses", "odd answer", "CRITICAL oom", "INFO fine", None]
    rows = [(i, at + timedelta(minutes=i), "application", "checkout" if i % 2 else "auth", p, "{}") for i, p in enumerate(payloads * 3)]
    return frame(rows + [(99, None, "application", "auth", "ERROR without a time", "{}")], SCHEMA)


def cause_model(log=None, **more):
    def score(asked):
        if log:
            with open(log, "a") as f:
                f.write("".join(f"{i}\n" for i in asked["event_id"]))
        text = asked["raw_payload"].fillna("")
        return pd.DataFrame({
            "root_cause": ["because of " + x for x in text], "confidence": ["much" if "odd" in x else 0.8 for x in text],
            "contributing_factors": [["a"] * 9] * len(asked), "recommendations": [["r" * 500]] * len(asked), "similar_incidents": None,
            "error": ["ValueError: refused" if "BOOM" in x else None for x in text],
        })

    return Model(score, provider="here", model_id="m1", wait=0.0, **more)


def test_failing_and_malformed_answers_become_dead_letters(events, tmp_path):
    log = str(tmp_path / "asked")
    done = mon.run_job(events, "r1", str(tmp_path / "out"), models={"root_cause": cause_model(log)}, failed="route")
    letters = {(r.event_id, r.step, r.error_type, r.error) for r in done.dead_letters.collect()}
    boom, odd = {1, 7, 13}, {2, 8, 14}
    assert letters == {(i, "root_cause", "ValueError", "refused") for i in boom} | {(i, "root_cause", "Malformed", "confidence is not a double") for i in odd}
    assert all(("much" in r.raw) == (r.event_id in odd) if r.raw else r.event_id in boom for r in done.dead_letters.collect())
    rows = {r.event_id: r for r in done.enriched.collect()}
    assert set(rows) == (set(range(18)) | {99}) - boom - odd
    assert rows[0].root_cause == "because of ERROR broke" and rows[0].cause_confidence == 0.8 and len(rows[0].recommendations[0]) == 200
    # Each event was put to the model once.
    with open(log) as f:
        asked = sorted(int(x) for x in f)
    assert asked == sorted([*range(18), 99])
    calls = done.calls.collect()
    assert len(calls) == 19 and {(c.provider, c.model_id, c.attempts) for c in calls} == {("here", "m1", 1)}
    assert {c.event_id for c in calls if not c.success} == boom and {c.event_id for c in calls if not c.parse_success} == boom | odd
    assert all(c.latency_ms >= 0 and c.asked_at for c in calls) and all((c.estimated_cost_usd > 0) == c.success for c in calls)


def test_kept_events_have_the_fixed_answer_and_the_record_counts_them(events, tmp_path):
    done = mon.run_job(events, "r2", str(tmp_path), models={"root_cause": cause_model()})
    rows = {r.event_id: r for r in done.enriched.collect()}
    assert len(rows) == 19 and rows[1].root_cause == "Unable to determine root cause (LLM failed: ValueError)" and rows[1].cause_confidence == 0.1
    record = done.record.first()
    assert (record.events_processed, record.total_calls, record.fallback_rate, record.prompt_version) == (19, 19, round(6 / 19, 4), "v1")
    assert record.finished_at >= record.started_at and record.total_input_tokens > 0 and record.total_cost_usd > 0
    again = mon.run_job(events, "r2", str(tmp_path), models={"root_cause": cause_model()})
    assert again.enriched.count() == 19 and again.dead_letters.count() == 6


def test_models_of_all_steps(events, tmp_path):
    def classify(asked):
        return pd.DataFrame({"event_type": "log", "severity": ["low" if "Classify" in p else "?" for p in asked["prompt"]], "confidence": 0.9, "reasoning": " because "})

    def extract(asked):
        return pd.DataFrame({"summary": ["s" * (600 if (x or "").startswith("INFO") else 5) for x in asked["raw_payload"]], "affected_component": "db", "error_code": None, "user_impact": ""})

    models = {"classify": Model(classify), "extract": Model(extract), "root_cause": cause_model()}
    done = mon.run_job(events, "r3", str(tmp_path), models=models)
    rows = {r.event_id: r for r in done.enriched.collect()}
    assert {(r.event_type, r.severity, r.classification_confidence) for r in rows.values()} == {("log", "low", 0.9)}
    assert rows[0].extracted_summary == "sssss" and rows[4].extracted_summary == "INFO fine"
    assert {(r.step, r.error) for r in done.dead_letters.where("event_id = 4").collect()} == {("extract", "summary has more than 500 characters")}
    assert done.calls.count() == 57 and done.record.first().total_calls == 57


def test_without_models_there_are_no_calls(events, tmp_path):
    done = mon.run_job(events, "r4", str(tmp_path))
    record = done.record.first()
    assert (done.enriched.count(), done.calls.count(), done.dead_letters.count()) == (19, 0, 0)
    assert (record.events_processed, record.total_calls, record.avg_latency_ms, record.fallback_rate) == (19, 0, 0.0, 0.0)


def test_documents_reach_the_model(events, frame, tmp_path):
    documents = frame([("kb/1", "the runbook", "runbook", "here.md"), ("kb/2", "the other", "note", "there.md")], "item_id string, content string, type string, source string")

    def score(asked):
        return pd.DataFrame({"root_cause": ["runbook" if "(runbook) kb/1" in p and "Known documents" in p else "none" for p in asked["prompt"]], "confidence": 0.7,
                             "contributing_factors": None, "recommendations": None, "similar_incidents": None})

    done = mon.run_job(events, "r5", str(tmp_path), models={"root_cause": Model(score)}, documents=documents, version="v2")
    rows = done.enriched.collect()
    assert {r.root_cause for r in rows} == {"runbook"} and all("Fonte: here.md" in r.rag_context for r in rows) and {tuple(r.recommendations) for r in rows} == {()}
    # Context is sought without a model as well.
    rich = mon.enrich(events, "r6", documents=documents)
    assert rich.count() == 19 and rich.where("rag_context IS NULL").count() == 0


def test_a_raising_model_costs_its_own_rows(events):
    def score(asked):
        if asked["raw_payload"].eq("BOOM refuses").any():
            raise OSError("down")
        return pd.DataFrame({"event_type": "log", "severity": "low", "confidence": 0.5, "reasoning": "r"}, index=range(len(asked)))

    told = ask(events, Model(score, wait=0.0), CONTRACTS["classify"], "a").collect()
    assert {r.event_id for r in told if r.a is None} == {1, 7, 13}
    assert {(r.a_call.error_type, r.a_call.error, r.a_call.attempts) for r in told if r.a is None} == {("OSError", "down", 2)}


@pytest.mark.parametrize(
    "answer,fault",
    [
        ({"event_type": "bad", "severity": "low", "confidence": 0.5}, "event_type is none of"), ({"severity": "low", "confidence": 0.5}, "event_type is missing"),
        ({"event_type": "log", "severity": "low", "confidence": 1.5}, "confidence is not from 0.0 to 1.0"),
        ({"event_type": "log", "severity": "low", "confidence": True}, "confidence is not a double"),
        ({"event_type": 3, "severity": "low", "confidence": 0.5}, "event_type is not a string"),
        ({"event_type": "log", "severity": "low", "confidence": float("inf")}, "confidence is not a double"),
        ({"event_type": "log", "severity": "low", "confidence": 0.5, "reasoning": "x" * 501}, "reasoning has more than 500 characters"),
    ],
)
def test_contract_names_the_fault(answer, fault):
    with pytest.raises(Malformed, match=fault):
        CONTRACTS["classify"].read(answer)


def test_contract_reads_what_it_can():
    c = Contract({"x": "double", "l": "array<string>"}, lists={"l": 2}, cut_lists=("l",), item_chars=3)
    assert c.read({"x": "1.5", "l": ["abcd", "e", "f"], "more": 1}) == {"x": 1.5, "l": ["abc", "e"]}
    with pytest.raises(Malformed, match="more than 2 items"):
        Contract({"l": "array<string>"}, lists={"l": 2}).read({"l": ["a", "b", "c"]})


def test_job_log_is_accepted(frame, tmp_path):
    df = check(frame([(i, i * 10) for i in range(7)], "a long, b long"), {"small": F.col("b") < 40})
    entry = write_checked(df, str(tmp_path / "t"), str(tmp_path / "d"), "load_complete", "orders")
    row = entry.first()
    assert (row.valid_records, row.dlq_records, row.success) == (4, 3, False) and row.duration_seconds >= 0
    judged = log_compliance(entry.withColumn("line", log_line())).first()
    assert judged.compliant and not judged.missing


def folder_stream(spark, rows, path, parts):
    rows.repartition(parts).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path)


def test_cycles_hold_at_most_n_and_equal_the_batch_job(spark, events, tmp_path):
    path, out, states, letters = (str(tmp_path / n) for n in ("in", "out", "states", "letters"))
    log = str(tmp_path / "asked")
    stream = folder_stream(spark, events, path, 5)
    mo.monitor(stream, out, states, str(tmp_path / "cp"), "r", per_cycle=4, models={"root_cause": cause_model(log)}, letters=letters).awaitTermination()
    got = mo.read_results(spark, out)
    sizes = {r.cycle: r["count"] for r in got.groupBy("cycle").count().collect()}
    assert sizes == {0: 4, 1: 4, 2: 4, 3: 4, 4: 3}
    pick = ["event_id", "is_anomaly", "z_score", "risk_score", "root_cause"]
    batch = mon.enrich(events, "r", models={"root_cause": cause_model()}).select(pick)
    assert sorted(map(tuple, got.select(pick).collect())) == sorted(map(tuple, batch.collect()))
    assert sorted(int(x) for x in open(log)) == sorted([*range(18), 99])
    assert {r.event_id for r in spark.read.parquet(letters).collect()} == {1, 7, 13, 2, 8, 14}
    # Again with other cycles: the batch is replaced as a whole.
    mo.process_batch(events, 0, out, states, "r", per_cycle=10)
    assert mo.read_results(spark, out).count() == 19


def test_events_without_a_time_stay_in_the_stream(spark, events, tmp_path):
    mo.process_batch(events, 0, str(tmp_path / "o"), str(tmp_path / "s"), "r")
    assert mo.read_results(spark, str(tmp_path / "o")).where("ts IS NULL").count() == 1


def test_late_events_are_counted_and_told(spark, frame, tmp_path):
    at = datetime(2024, 1, 1)
    schema = "event_id long, ts timestamp_ntz, service string"
    path, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    first = [(i, at + timedelta(minutes=30 * i), "a") for i in range(10)] + [(100, None, "a")]
    second = [(20, at, "a"), (21, at + timedelta(minutes=1), "a"), (22, at + timedelta(minutes=270), "a"), (23, at + timedelta(minutes=3), None)]
    for rows in (first, second, []):
        stream = folder_stream(spark, frame(rows, schema), path, 2)
        mo.count_windows(stream, out, cp).awaitTermination()
    counts = {(r.start, r.service): r.events for r in mo.window_counts(spark, out).collect()}
    assert counts[(at, "a")] == 3 and counts[(at, None)] == 1 and counts[(None, "a")] == 1 and counts[(at + timedelta(minutes=270), "a")] == 2
    assert sum(counts.values()) == 15
    # All that came for the first window was late; 04:30 was open.
    assert sorted(r.event_id for r in mo.late_events(spark, out).collect()) == [20, 21, 23]
    fixed = {(r.start, r.service): (r.before, r.events) for r in mo.corrections(spark, out).collect()}
    assert fixed[(at, "a")] == (1, 3)
    # A repeated batch changes nothing.
    os.remove(os.path.join(cp, "commits", "1"))
    mo.count_batch(frame(second, schema), 1, out)
    assert {(r.start, r.service): r.events for r in mo.window_counts(spark, out).collect()} == counts
