"""Structured fields and probable cause of an event."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cap_items, first_keyword, truncate_with_dots
from ..sources.literals import literal_table
from .classify import within_limits

# Patterns and keyword lists of the extraction.
ERROR_CODE = r"(?i)(HTTP\s*\d{3}|OOMKilled|TIMEOUT|SIGKILL|ECONNREFUSED)"
COMPONENTS = [("checkout", "checkout"), ("payment", "payments"), ("inventory", "inventory")]
ERROR_CODES = [("500", "HTTP 500"), ("502", "HTTP 502"), ("503", "HTTP 503"), ("oom", "OOMKilled")]
IMPACTS = [("timeout", "Users experiencing timeouts"), ("error", "Users seeing errors")]
NO_IMPACT = "No direct user impact detected"
REGEX_IMPACT = "Unknown — extracted via regex fallback"

# Cause rules, first match wins: (rule id, keywords, cause, advice).
CAUSE_RULES = [
    ("memory", ("memory", "oom"), "Memory leak or insufficient memory allocation",
     ["Increase memory limits", "Profile application memory usage", "Check for memory leaks in recent changes"]),
    ("cpu", ("cpu",), "CPU saturation due to high load or inefficient processing",
     ["Scale horizontally", "Profile CPU-intensive code paths", "Check for runaway processes"]),
    ("http", ("5xx", "500"), "Application errors causing 5xx responses",
     ["Check application logs for stack traces", "Review recent deployments", "Verify downstream service health"]),
    ("deploy", ("deploy",), "Recent deployment may have introduced issues",
     ["Compare metrics before and after deploy", "Review changelog for breaking changes", "Consider rollback if issues persist"]),
    ("unknown", (), "Unable to determine root cause from available data",
     ["Investigate logs further", "Check recent deployments"]),
]
CAUSE_CONFIDENCE = 0.7
FAILED_CAUSE = ("Unable to determine root cause (LLM failed: {error})", 0.1, ["Manual investigation required", "Check service logs"])


def _fields(summary: Column, component: Column, code: Column, impact: Column) -> Column:
    return F.struct(
        summary.alias("summary"), component.alias("affected_component"), code.alias("error_code"), impact.alias("user_impact")
    )


def regex_fields() -> Column:
    payload = F.col("raw_payload")
    return _fields(truncate_with_dots(payload), F.col("service"), F.regexp_extract(payload, ERROR_CODE, 1), F.lit(REGEX_IMPACT))


def offline_fields(lowered: str = "_low") -> Column:
    """What the offline model answers, matched on the (lower-cased) payload alone."""
    low = F.col(lowered)
    return _fields(
        F.concat(F.lit("Event detected: "), F.substring("raw_payload", 1, 120)),
        first_keyword(low, COMPONENTS, "unknown", lowered=True), first_keyword(low, ERROR_CODES, "", lowered=True),
        first_keyword(low, IMPACTS, NO_IMPACT, lowered=True),
    )


_OUT = {"summary": "extracted_summary", "affected_component": "affected_component", "error_code": "error_code", "user_impact": "user_impact"}


def extract(events: DataFrame, model: Column | None = None) -> DataFrame:
    """Add the extracted fields; ``model`` is a struct column, null where it failed."""
    lowered = events.withColumn("_low", F.lower("raw_payload"))
    answer = offline_fields() if model is None else model
    flat = lowered.withColumns({f"_{f}": answer[f] for f in _OUT})
    judged = flat.withColumn(
        "_ok", F.col("_summary").isNotNull() & within_limits({f: F.col(f"_{f}") for f in _OUT})
    )
    backup = regex_fields()
    return judged.withColumns(
        {out: F.when(F.col("_ok"), F.col(f"_{f}")).otherwise(backup[f]) for f, out in _OUT.items()}
    ).drop("_low", "_ok", *[f"_{f}" for f in _OUT])


def cause_rule_id(text: Column) -> Column:
    """Rule for a lower-cased text."""
    return first_keyword(text, [(k, r[0]) for r in CAUSE_RULES for k in r[1]], "unknown", lowered=True)


def root_cause(events: DataFrame, failed: Column | None = None, error: str | Column = "RuntimeError", model: Column | None = None) -> DataFrame:
    """Cause, confidence and advice: by rule, or as a model answered.

    ``model`` is a struct column (root_cause, confidence, recommendations), null where it failed; ``failed`` marks failures of the rules' caller. Where
    it failed the fixed answer stands, with the type of the ``error``.
    """
    said_error = F.lit(error) if isinstance(error, str) else F.coalesce(error, F.lit("RuntimeError"))
    before, after = FAILED_CAUSE[0].split("{error}")
    fixed = {
        "root_cause": F.concat(F.lit(before), said_error, F.lit(after)), "cause_confidence": F.lit(FAILED_CAUSE[1]),
        "recommendations": F.array(*map(F.lit, FAILED_CAUSE[2])),
    }
    if model is not None:
        there = model.isNotNull()
        answer = {
            "root_cause": F.coalesce(model["root_cause"], F.lit("")), "cause_confidence": model["confidence"],
            "recommendations": F.coalesce(cap_items(model["recommendations"]), F.array().cast("array<string>")),
        }
        return events.withColumns({c: F.when(there, answer[c]).otherwise(fixed[c]) for c in fixed})
    rows = [(r[0], r[2], CAUSE_CONFIDENCE, r[3]) for r in CAUSE_RULES]
    table = literal_table(
        events.sparkSession, rows, "_rule string, root_cause string, cause_confidence double, recommendations array<string>"
    ).withColumn("recommendations", cap_items(F.col("recommendations")))
    # Five constant rows: always broadcast, and every rule id has its row.
    said = events.withColumn("_said", F.lower(F.concat_ws(" ", "raw_payload", "extracted_summary")))
    caused = said.withColumn("_rule", cause_rule_id(F.col("_said"))).drop("_said").join(F.broadcast(table), "_rule").drop("_rule")
    if failed is None:
        return caused
    return caused.withColumns({c: F.when(failed, fixed[c]).otherwise(F.col(c)) for c in fixed})


def actionable(recommendations: Column, confidence: Column) -> Column:
    return (F.size(recommendations) > 0) & (confidence >= 0.5)
