"""The whole monitoring job: raw events to enriched events, alerts and call records."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.text import fill_template, token_estimate
from ..operators.anomaly import THRESHOLD, detect
from ..operators.classify import classify
from ..operators.contract import CALL_SCHEMA, CONTRACTS, Model, ask
from ..operators.extract import extract, root_cause
from ..operators.metric_index import settled
from ..operators.risk import ALERT_THRESHOLD, OUTPUT_TOKENS, call_facts, price_calls, run_facts, run_row, score_risk
from ..operators.sizes import join_hot
from .retrieval import retrieve_context

PROMPT_VERSION = "v1"
# Our own request texts; a version is a key, so old rows can be read with the text they used.
PROMPTS = {
    "v1": {
        "classify": "Classify this event.\nService: {service}\nSource: {source}\nPayload:\n{raw_payload}\nMetadata: {metadata}\n",
        "extract": "Extract fields.\nService: {service}\nType: {event_type}\nSeverity: {severity}\nPayload:\n{raw_payload}\n",
        "root_cause": "Find the cause.\nService: {service}\nType: {event_type}\nSummary: {extracted_summary}\nAnomaly: {is_anomaly}\n",
    },
    "v2": {
        "classify": "Classify this event.\nService: {service}\nSource: {source}\nPayload:\n{raw_payload}\nMetadata: {metadata}\n",
        "extract": "Extract fields.\nService: {service}\nType: {event_type}\nSeverity: {severity}\nPayload:\n{raw_payload}\n",
        "root_cause": "Find the cause.\nService: {service}\nType: {event_type}\nSummary: {extracted_summary}\nAnomaly: {is_anomaly}\n"
                      "Score: {z_score}\nPayload:\n{raw_payload}\nKnown documents:\n{rag_context}\n",
    },
}


def prompt(step: str, version: str = PROMPT_VERSION) -> Column:
    """Request text of one step as a column."""
    template = PROMPTS[version][step]
    names = ("service", "source", "raw_payload", "metadata", "event_type", "severity", "extracted_summary", "is_anomaly", "z_score", "rag_context")
    return fill_template(template, {n: F.col(n) for n in names if "{" + n + "}" in template})


def retrieval_query() -> Column:
    return F.concat_ws(" ", "service", "event_type", "severity", "extracted_summary")


def enrich(
    events: DataFrame, run_id: str, model: Column | None = None, states: DataFrame | None = None,
    z_threshold: float = THRESHOLD, version: str = PROMPT_VERSION, models: Mapping[str, Model] | None = None, documents: DataFrame | None = None,
) -> DataFrame:
    """Classify, extract, score against history, explain and rate.

    All steps but the anomaly score are column expressions over one scan; the
    score costs one range shuffle of the keys and one join on the event key.

    ``models`` may hold a model for the steps classify, extract and root_cause; a step without one takes the built-in answer. Each model adds a column
    ``<step>_call`` and gets the request text as column ``prompt``. ``documents`` (item_id, content, type, source) are searched before causes are sought;
    what is found is column ``rag_context``.
    """
    described = describe(events, model, models, version)
    return explain(detect(described, states=states, threshold=z_threshold), run_id, models, documents, version)


def _asked(df: DataFrame, step: str, models: Mapping[str, Model] | None, version: str) -> tuple[DataFrame, Column | None]:
    """The rows with a model's answer to a step, if the step has a model."""
    if not models or step not in models:
        return df, None
    told = ask(df.withColumn("prompt", prompt(step, version)), models[step], CONTRACTS[step], f"_{step}")
    return told.withColumnRenamed(f"_{step}_call", f"{step}_call").drop("prompt"), F.col(f"_{step}")


def describe(events: DataFrame, model: Column | None = None, models: Mapping[str, Model] | None = None, version: str = PROMPT_VERSION) -> DataFrame:
    """The steps before the anomaly score: classify and extract."""
    asking, answer = _asked(events, "classify", models, version)
    described = classify(asking, answer if answer is not None else model).drop("_classify")
    asking, answer = _asked(described, "extract", models, version)
    return extract(asking, answer).drop("_extract")


def explain(
    scored: DataFrame, run_id: str, models: Mapping[str, Model] | None = None, documents: DataFrame | None = None, version: str = PROMPT_VERSION
) -> DataFrame:
    """The steps after the anomaly score: retrieve, find the cause, rate."""
    scored = scored.withColumn("rag_context", F.lit(None).cast("string")) if documents is None else with_context(scored, documents)
    asking, answer = _asked(scored, "root_cause", models, version)
    if answer is None:
        explained = root_cause(asking)
    else:
        explained = root_cause(asking, model=answer, error=F.col("root_cause_call.error_type")).drop("_root_cause")
    if documents is None:
        explained = explained.drop("rag_context")
    return score_risk(explained).withColumns({"pipeline_run_id": F.lit(run_id), "prompt_version": F.lit(version)})


def refused(df: DataFrame) -> Column:
    """Whether one of a row's model calls brought no usable answer."""
    bad = F.lit(False)
    for c in df.columns:
        if c.endswith("_call"):
            bad = bad | ~F.col(f"{c}.parse_success")
    return bad


def with_context(events: DataFrame, documents: DataFrame) -> DataFrame:
    """``rag_context``: what the documents say to an event's query. Each distinct query is searched once.

    Many events share a query, some perhaps a third of all: these meet their context by broadcast.
    """
    keyed = events.withColumn("_key", F.sha2(F.coalesce(retrieval_query(), F.lit("")), 256)).checkpoint(eager=True)
    queries = keyed.select(F.coalesce(retrieval_query(), F.lit("")).alias("query")).distinct().select(F.sha2("query", 256).alias("query_id"), "query")
    found = retrieve_context(queries, documents).select(F.col("query_id").alias("_key"), F.col("context").alias("rag_context"))
    return join_hot(keyed, settled(found, "contexts"), "_key").drop("_key")


@dataclass(frozen=True)
class JobResult:
    """The stored tables of a run below ``path``, and its record as one row."""

    path: str
    record: DataFrame

    def _read(self, name: str) -> DataFrame:
        return self.record.sparkSession.read.parquet(f"{self.path}/{name}")

    @property
    def enriched(self) -> DataFrame:
        return self._read("enriched")

    @property
    def dead_letters(self) -> DataFrame:
        return self._read("dead_letters")

    @property
    def calls(self) -> DataFrame:
        return self._read("calls")


def _calls_of(stored: DataFrame, steps: list[str], version: str) -> DataFrame:
    """One row per event and call, priced; from the stored events alone."""
    rows = [
        F.struct(
            F.lit(step).alias("step"), F.col(f"{step}_call").alias("call"),
            F.when(F.col(f"{step}_call.success"), token_estimate(F.col(f"{step}_prompt"))).otherwise(0).alias("input_tokens"),
            F.when(F.col(f"{step}_call.success"), OUTPUT_TOKENS[step]).otherwise(0).alias("output_tokens"),
        ) for step in steps
    ]
    empty = F.array().cast(f"array<struct<step:string,call:{CALL_SCHEMA},input_tokens:int,output_tokens:int>>")
    every = stored.select("event_id", F.explode(F.array(*rows) if rows else empty).alias("c")).select(
        F.sha2(F.concat_ws("|", F.col("event_id").cast("string"), "c.step", F.lit(version)), 256).alias("call_id"), "event_id", "c.step",
        "c.call.asked_at", "c.call.provider", "c.call.model_id", F.col("c.input_tokens").cast("int").alias("input_tokens"),
        F.col("c.output_tokens").cast("int").alias("output_tokens"), "c.call.latency_ms", "c.call.attempts", "c.call.success", "c.call.parse_success",
        (~F.col("c.call.parse_success")).alias("fallback_used"), "c.call.error_type", "c.call.error", "c.call.raw",
    )
    return price_calls(every)


def run_job(
    events: DataFrame, run_id: str, out: str, models: Mapping[str, Model] | None = None, documents: DataFrame | None = None,
    failed: str = "keep", alert_threshold: int = ALERT_THRESHOLD, version: str = PROMPT_VERSION, **options,
) -> JobResult:
    """Enrich, and store below ``<out>/<run_id>`` what came out: ``enriched``, ``calls``, ``dead_letters``; and the run's record.

    Each model sees each event once: everything is read from the first stored table. An answer that failed or broke its contract becomes
    a dead letter with the event's payload, the step, the error and the refused answer. ``failed="keep"`` also keeps the event, with what the step falls back on;
    ``"route"`` takes it out of ``enriched``. Counts come from the writing itself (observations), so no table is read to be counted.
    A second run under the same id replaces the first.
    """
    if failed not in ("keep", "route"):
        raise ValueError("failed events are kept or routed")
    models, spark = models or {}, events.sparkSession
    steps, base, started = [s for s in CONTRACTS if s in models], f"{out.rstrip('/')}/{run_id}", datetime.now(timezone.utc)
    rich = enrich(events, run_id, version=version, models=models, documents=documents, **options)
    if "rag_context" not in rich.columns:
        rich = rich.withColumn("rag_context", F.lit(None).cast("string"))
    rich.withColumns({f"{s}_prompt": prompt(s, version) for s in steps}).write.mode("overwrite").parquet(f"{base}/events")
    stored = spark.read.parquet(f"{base}/events")
    bad = refused(stored)
    shown = [c for c in rich.columns if not c.endswith("_call")]
    seen = Observation("run")
    kept = stored.observe(seen, *run_facts(alert_threshold)).where(~bad if failed == "route" else F.lit(True)).select(*shown)
    kept.write.mode("overwrite").parquet(f"{base}/enriched")
    asked = Observation("calls")
    calls = _calls_of(stored, steps, version)
    calls.observe(asked, *call_facts()).write.mode("overwrite").parquet(f"{base}/calls")
    letters = spark.read.parquet(f"{base}/calls").where("NOT parse_success").select("event_id", "step", "asked_at", "model_id", "error_type", "error", "raw")
    origin = stored.where(bad).select("event_id", "ts", "source", "service", "raw_payload")
    letters.join(origin, "event_id").withColumn("pipeline_run_id", F.lit(run_id)).write.mode("overwrite").parquet(f"{base}/dead_letters")
    return JobResult(base, run_row(spark, run_id, version, started, datetime.now(timezone.utc), seen.get, asked.get))
