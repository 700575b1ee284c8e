"""Deterministic risk score, alerts and run statistics."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numbers import call_cost_usd, clamp, risk_level, round_half_even
from ..functions.text import lookup, token_estimate
from ..sources.literals import literal_table
from .layout import lag_over_all, running_totals

# Weights of the score.
SEVERITY_POINTS = {"critical": 40, "high": 28, "medium": 15, "low": 5}
TYPE_POINTS = {"app_error": 15, "metric_alert": 12, "deploy": 8, "log": 3, "unknown": 5}
SERVICE_POINTS = {
    "checkout": 15, "payments": 15, "auth": 12, "inventory": 10, "api-gateway": 12, "frontend": 8, "notifications": 5,
}
DEFAULT_SERVICE_POINTS = 7
ALERT_THRESHOLD = 60

# US dollars per million tokens (in, out), and the rate of unlisted models.
PRICES = [
    ("claude-sonnet-4-20250514", 3.0, 15.0),
    ("claude-sonnet-4-6", 3.0, 15.0),
    ("claude-haiku-4-20250414", 0.80, 4.0),
    ("gpt-4o-mini", 0.15, 0.60),
    ("gpt-4o", 2.50, 10.0),
    ("dummy-heuristic-v1", 0.0, 0.0),
]
DEFAULT_PRICE = (3.0, 15.0)
# Assumed answer length per step.
OUTPUT_TOKENS = {"classify": 80, "extract": 100, "root_cause": 200}


def factors() -> Column:
    """Contribution of each factor as a struct of doubles."""
    anomaly = F.when(F.col("is_anomaly"), F.lit(20.0) + F.least(F.lit(10.0), F.abs("z_score") * 3.0)).otherwise(0.0)
    penalty = F.greatest(F.lit(0.0), (F.lit(1.0) - F.col("classification_confidence")) * 10.0)
    return F.struct(
        lookup(F.col("severity"), SEVERITY_POINTS, 5).cast("double").alias("severity"),
        lookup(F.col("event_type"), TYPE_POINTS, 5).cast("double").alias("event_type"),
        lookup(F.col("service"), SERVICE_POINTS, DEFAULT_SERVICE_POINTS).cast("double").alias("service_criticality"),
        anomaly.alias("anomaly_bonus"), (-penalty).alias("confidence_penalty"),
    )


def score_risk(events: DataFrame) -> DataFrame:
    """Add ``risk_factors``, ``risk_score`` (0..100, half-even rounding) and ``risk_level``."""
    f = F.col("risk_factors")
    raw = (
        f["severity"] + f["event_type"] + f["service_criticality"] + f["anomaly_bonus"] + f["confidence_penalty"]
    )
    return (
        events.withColumn("risk_factors", factors())
        .withColumn("risk_score", clamp(round_half_even(raw), 0.0, 100.0).cast("int"))
        .withColumn("risk_level", risk_level(F.col("risk_score")))
    )


def title(severity: Column, service: Column, event_type: Column) -> Column:
    return F.concat(F.upper(severity), F.lit(" — "), service, F.lit(": "), event_type)


def build_alerts(enriched: DataFrame, run_id: str, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """One alert per event at or above the threshold; the id is a hash, so reruns repeat it."""
    return enriched.filter(F.col("risk_score") >= threshold).select(
        F.sha2(F.concat_ws("|", F.lit(run_id), F.col("event_id").cast("string")), 256).alias("alert_id"),
        F.col("ts").alias("timestamp"), "event_id", "service", "severity", "risk_score", "risk_level",
        title(F.col("severity"), F.col("service"), F.col("event_type")).alias("title"),
        F.col("extracted_summary").alias("summary"), "root_cause", "recommendations",
        F.lit(run_id).alias("pipeline_run_id"),
    )


def alert_summary(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("service", "severity", "title").agg(
        F.count(F.lit(1)).alias("alerts"), F.max("risk_score").alias("max_score"),
        F.round(F.avg("risk_score"), 4).alias("mean_score"),
    )


def price_calls(calls: DataFrame) -> DataFrame:
    """Add the cost of each call; unlisted models take the default rate, failed calls have no model and cost nothing."""
    table = literal_table(calls.sparkSession, PRICES, "model_id string, _in double, _out double")
    rate_in, rate_out = F.coalesce("_in", F.lit(DEFAULT_PRICE[0])), F.coalesce("_out", F.lit(DEFAULT_PRICE[1]))
    cost = call_cost_usd(F.col("input_tokens"), F.col("output_tokens"), rate_in, rate_out)
    return (
        calls.join(F.broadcast(table), "model_id", "left")
        .withColumn("estimated_cost_usd", F.when(F.col("model_id").isNull(), 0.0).otherwise(cost))
        .drop("_in", "_out")
    )


def calls_log(events: DataFrame, prompts: dict[str, Column], model_id: Column, failed: Column) -> DataFrame:
    """One row per event and scoring step; one pass, no shuffle. ``prompts`` maps step to prompt text."""
    steps = F.array(*[
        F.struct(
            F.lit(name).alias("step"),
            F.when(failed, F.lit(None)).otherwise(model_id).alias("model_id"),
            F.when(failed, 0).otherwise(token_estimate(text)).alias("input_tokens"),
            F.when(failed, 0).otherwise(OUTPUT_TOKENS[name]).alias("output_tokens"),
            (~failed).alias("success"), failed.alias("fallback_used"),
        )
        for name, text in prompts.items()
    ])
    key = F.concat_ws("|", F.col("event_id").cast("string"), F.col("step"))
    rows = events.select("event_id", F.inline(steps))
    return price_calls(rows.withColumn("call_id", F.sha2(key, 256)))


def calls_summary(calls: DataFrame, *by: str) -> DataFrame:
    """Calls, tokens, cost, fallback rate; all zero when there are no calls."""
    zero = F.lit(0)
    return calls.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_calls"),
        F.coalesce(F.sum("input_tokens"), zero).alias("total_input_tokens"),
        F.coalesce(F.sum("output_tokens"), zero).alias("total_output_tokens"),
        F.coalesce(F.round(F.sum("estimated_cost_usd"), 6), F.lit(0.0)).alias("total_cost_usd"),
        F.coalesce(F.round(F.avg(F.col("fallback_used").cast("int")), 4), F.lit(0.0)).alias("fallback_rate"),
        *([F.coalesce(F.round(F.avg("latency_ms"), 2), F.lit(0.0)).alias("avg_latency_ms")] if "latency_ms" in calls.columns else []),
    )


RUN_SCHEMA = (
    "run_id string, prompt_version string, started_at timestamp, finished_at timestamp, events_processed long, events_classified long, "
    "anomalies_detected long, alerts_emitted long, total_calls long, total_input_tokens long, total_output_tokens long, total_cost_usd double, "
    "avg_latency_ms double, fallback_rate double"
)


def run_facts(threshold: int = ALERT_THRESHOLD) -> list[Column]:
    """What a run's record says of its events, as aggregates to observe while they are written."""
    return [
        F.count(F.lit(1)).alias("events_processed"), F.count("event_type").alias("events_classified"),
        F.count_if("is_anomaly").alias("anomalies_detected"), F.count_if(F.col("risk_score") >= threshold).alias("alerts_emitted"),
    ]


def call_facts(latency: str | None = "latency_ms") -> list[Column]:
    """What a run's record says of its calls, as aggregates to observe while they are written."""
    return [
        F.count(F.lit(1)).alias("total_calls"), F.sum("input_tokens").alias("total_input_tokens"), F.sum("output_tokens").alias("total_output_tokens"),
        F.sum("estimated_cost_usd").alias("total_cost_usd"), F.sum(F.col("fallback_used").cast("int")).alias("fallbacks"),
        (F.sum(latency) if latency else F.lit(None).cast("double")).alias("latency_ms"),
    ]


def run_row(spark, run_id: str, version: str, started: datetime, finished: datetime, events: dict, calls: dict) -> DataFrame:
    """The record of a run as one row, from two observations; all call numbers are zero when nothing was asked."""
    n = calls["total_calls"]
    row = (
        run_id, version, started, finished, *[events[c] for c in ("events_processed", "events_classified", "anomalies_detected", "alerts_emitted")],
        n, calls["total_input_tokens"] or 0, calls["total_output_tokens"] or 0, round(calls["total_cost_usd"] or 0.0, 6),
        round((calls["latency_ms"] or 0.0) / n, 2) if n else 0.0, round((calls["fallbacks"] or 0) / n, 4) if n else 0.0,
    )
    return literal_table(spark, [row], RUN_SCHEMA)


def run_record(enriched: DataFrame, calls: DataFrame, run_id: str, out: str, threshold: int = ALERT_THRESHOLD, version: str = "v1") -> DataFrame:
    """Store the events and calls of a run below ``out``; its record, one row, is taken while they are written: one pass over each."""
    started, seen, asked = datetime.now(timezone.utc), Observation("run"), Observation("calls")
    enriched.observe(seen, *run_facts(threshold)).write.mode("overwrite").parquet(f"{out}/enriched")
    latency = "latency_ms" if "latency_ms" in calls.columns else None
    calls.observe(asked, *call_facts(latency)).write.mode("overwrite").parquet(f"{out}/calls")
    return run_row(enriched.sparkSession, run_id, version, started, datetime.now(timezone.utc), seen.get, asked.get)


def cycle_stats(enriched: DataFrame, cycle: Column, threshold: int = ALERT_THRESHOLD) -> DataFrame:
    """Per cycle: events, anomalies, alerts, mean risk, and running totals over all cycles."""
    per = enriched.groupBy(cycle.alias("cycle")).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_anomaly").alias("anomalies"),
        F.count_if(F.col("risk_score") >= threshold).alias("alerts"), F.avg("risk_score").alias("avg_risk"),
    )
    return running_totals(
        per, [], ["cycle"], {"total_events": "events", "total_anomalies": "anomalies", "total_alerts": "alerts"}
    )


def delta_vs_previous(cycles: DataFrame, dead_band: float = 5.0) -> DataFrame:
    """Change against the previous cycle with its direction; none for the first one."""
    lagged = lag_over_all(cycles, "cycle", ["anomalies", "avg_risk"])
    anomalies = F.col("anomalies") - F.col("prev_anomalies")
    risk = F.col("avg_risk") - F.col("prev_avg_risk")

    def arrow(delta: Column, band: float) -> Column:
        return F.when(delta > band, "up").when(delta < -band, "down").when(delta.isNotNull(), "flat")

    return lagged.withColumns({
        "anomaly_delta": anomalies, "anomaly_trend": arrow(anomalies, 0),
        "risk_delta": F.round(risk, 1), "risk_trend": arrow(risk, dead_band),
    }).drop("prev_anomalies", "prev_avg_risk")


def recent_errors(events: DataFrame, is_error: Column, minutes: int = 15) -> DataFrame:
    """Errors per service in the last minutes of the data (data time, not wall clock)."""
    latest = events.select(F.max("ts").alias("m")).scalar()
    since = latest - F.make_interval(mins=F.lit(minutes))
    return (
        events.filter((F.col("ts") > since) & is_error).groupBy("service").agg(F.count(F.lit(1)).alias("errors"))
        .orderBy(F.col("errors").desc(), "service")
    )
