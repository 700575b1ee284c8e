"""Severity and type of an event by keyword, model score with fallback, and consistency rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import first_keyword, strip_whitespace

# Keyword lists; the first keyword in list order wins, anywhere in the text.
HEURISTIC_SEVERITY = [
    ("critical", "critical"), ("fatal", "critical"), ("oomkilled", "critical"), ("panic", "critical"),
    ("error", "high"), ("exception", "high"), ("5xx", "high"), ("500", "high"),
    ("warning", "medium"), ("timeout", "medium"), ("latency", "medium"), ("slow", "medium"),
]
HEURISTIC_TYPE = [
    ("deploy", "deploy"), ("release", "deploy"), ("rollback", "deploy"),
    ("cpu", "metric_alert"), ("memory", "metric_alert"), ("p99", "metric_alert"),
    ("error", "app_error"), ("exception", "app_error"), ("traceback", "app_error"),
]
OFFLINE_SEVERITY = [
    ("critical", "critical"), ("fatal", "critical"), ("oomkilled", "critical"),
    ("error", "high"), ("exception", "high"), ("5xx", "high"), ("timeout", "high"),
    ("warning", "medium"), ("warn", "medium"), ("slow", "medium"), ("latency", "medium"),
    ("info", "low"), ("deploy", "low"), ("success", "low"),
]
OFFLINE_TYPE = [
    ("deploy", "deploy"), ("release", "deploy"), ("rollback", "deploy"),
    ("cpu", "metric_alert"), ("memory", "metric_alert"), ("latency", "metric_alert"), ("p99", "metric_alert"),
    ("error", "app_error"), ("exception", "app_error"), ("traceback", "app_error"), ("panic", "app_error"),
]
# Allowed labels, confidences and texts.
EVENT_TYPES = ("log", "metric_alert", "app_error", "deploy", "unknown")
SEVERITIES = ("low", "medium", "high", "critical")
HEURISTIC_CONFIDENCE, OFFLINE_CONFIDENCE = 0.6, 0.85
NO_REASON = "Classificacao sem justificativa."
ADJUSTED = " [ajustado: log + sev alta = confianca reduzida]"

# Length limits of scored text; a longer text is a failed answer.
TEXT_LIMITS = {
    "reasoning": 500, "summary": 500, "affected_component": 200, "error_code": 100,
    "user_impact": 300, "root_cause": 500,
}
LIST_LIMITS = {"contributing_factors": 5, "recommendations": 5, "similar_incidents": 5}


LOW, LOW_ALL = "_low", "_low_all"


def with_lowered(events: DataFrame) -> DataFrame:
    """Lower-cased payload, and payload with service and source, each computed once per row."""
    everything = F.concat_ws(" ", "raw_payload", "service", "source")
    return events.withColumns({LOW: F.lower("raw_payload"), LOW_ALL: F.lower(everything)})


def _result(event_type: Column, severity: Column, confidence: float, reasoning: str) -> Column:
    return F.struct(
        event_type.alias("event_type"), severity.alias("severity"),
        F.lit(confidence).alias("confidence"), F.lit(reasoning).alias("reasoning"),
    )


def heuristic_result() -> Column:
    """By keywords over payload, service and source (needs ``with_lowered``)."""
    return _result(
        first_keyword(F.col(LOW_ALL), HEURISTIC_TYPE, "log", lowered=True),
        first_keyword(F.col(LOW_ALL), HEURISTIC_SEVERITY, "low", lowered=True),
        HEURISTIC_CONFIDENCE, "Heuristic keyword match",
    )


def offline_result() -> Column:
    """What the offline model answers: other lists, payload only (needs ``with_lowered``)."""
    return _result(
        first_keyword(F.col(LOW), OFFLINE_TYPE, "log", lowered=True),
        first_keyword(F.col(LOW), OFFLINE_SEVERITY, "low", lowered=True),
        OFFLINE_CONFIDENCE, "Heuristic classification based on keyword matching",
    )


def within_limits(fields: dict[str, Column]) -> Column:
    """True when no scored text or list is too long; keys are the field names of the limits."""
    ok = F.lit(True)
    for name, value in fields.items():
        if name in TEXT_LIMITS:
            ok = ok & F.coalesce(F.length(value) <= TEXT_LIMITS[name], F.lit(True))
        else:
            ok = ok & F.coalesce(F.size(value) <= LIST_LIMITS[name], F.lit(True))
    return ok


def _valid(ok_text: Column, kind: Column, severity: Column, confidence: Column) -> Column:
    ok = ok_text & kind.isin(*EVENT_TYPES) & severity.isin(*SEVERITIES) & confidence.between(0.0, 1.0)
    return F.coalesce(ok, F.lit(False))


def cohere(df: DataFrame, kind: str, severity: str, confidence: str, reason: str) -> DataFrame:
    """Consistency rules in place, in order: reason text, log with high severity, unknown with high confidence."""
    loud_log = (F.col(kind) == "log") & F.col(severity).isin("critical", "high")
    base = df.withColumns({
        "_loud": loud_log, reason: strip_whitespace(F.coalesce(F.col(reason), F.lit(""))),
        confidence: F.when(loud_log, F.least(F.col(confidence), F.lit(0.4))).otherwise(F.col(confidence)),
    })
    text = F.when(F.col(reason) == "", NO_REASON).otherwise(F.col(reason))
    return base.withColumns({
        confidence: F.when((F.col(kind) == "unknown") & (F.col(confidence) > 0.5), 0.3).otherwise(F.col(confidence)),
        reason: F.concat(text, F.when(F.col("_loud"), ADJUSTED).otherwise("")),
    }).drop("_loud")


def classify(events: DataFrame, model: Column | None = None) -> DataFrame:
    """Add type, severity, confidence, method and reason; ``model`` is a struct column, null where it failed.

    Works on flat columns stage by stage, so each keyword chain is evaluated
    once per row, and the fallback chains only where the model failed.
    """
    answer = offline_result() if model is None else model
    flat = with_lowered(events).withColumns({
        "_t": answer["event_type"], "_s": answer["severity"], "_c": answer["confidence"], "_r": answer["reasoning"],
    })
    judged = flat.withColumn(
        "_ok", _valid(within_limits({"reasoning": F.col("_r")}), F.col("_t"), F.col("_s"), F.col("_c"))
    )
    backup = heuristic_result()
    merged = judged.withColumns({
        "event_type": F.when(F.col("_ok"), F.col("_t")).otherwise(backup["event_type"]),
        "severity": F.when(F.col("_ok"), F.col("_s")).otherwise(backup["severity"]),
        "classification_confidence": F.when(F.col("_ok"), F.col("_c")).otherwise(backup["confidence"]),
        "classification_method": F.when(F.col("_ok"), "llm").otherwise("heuristic"),
        "reasoning": F.when(F.col("_ok"), F.col("_r")).otherwise(backup["reasoning"]),
    }).drop("_t", "_s", "_c", "_r", "_ok", LOW, LOW_ALL)
    return cohere(merged, "event_type", "severity", "classification_confidence", "reasoning")
