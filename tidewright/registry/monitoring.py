"""Event-monitoring queries."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import anomaly, classify as cl, extract as ex, risk as rk
from ..operators.contract import Model
from ..plans import monitoring as mon
from ..session import scratch_path
from . import Tables, register
from .fixtures import RAW_EVENT_SQL, raw_events, values_sql

RUN = "run-1"


# ---- checking SQL, built from the same constant lists -----------------------

def kw(text: str, rules, default: str) -> str:
    arms = " ".join(f"WHEN contains(lower({text}), '{k}') THEN '{v}'" for k, v in rules)
    return f"CASE {arms} ELSE '{default}' END"


def pick(col: str, table: dict, default) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + f" ELSE {default} END"


_HTEXT = "concat(raw_payload, ' ', service, ' ', source)"
_LOUD = "(event_type = 'log' AND severity IN ('critical', 'high'))"
_STRIPPED = "regexp_replace(raw_reason, '^\\s+|\\s+$', '', 'g')"
_RAW = f"WITH raw AS ({RAW_EVENT_SQL})"
_OFF = (
    f"{_RAW}, cls0 AS (SELECT *, {kw('raw_payload', cl.OFFLINE_TYPE, 'log')} AS event_type, "
    f"{kw('raw_payload', cl.OFFLINE_SEVERITY, 'low')} AS severity, 'llm' AS classification_method, "
    "0.85::DOUBLE AS conf0, 'Heuristic classification based on keyword matching' AS raw_reason FROM raw)"
)
_COH = (
    f"cls AS (SELECT * EXCLUDE (conf0, raw_reason), CASE WHEN {_LOUD} THEN least(conf0, 0.4::DOUBLE) "
    "WHEN event_type = 'unknown' AND conf0 > 0.5 THEN 0.3::DOUBLE ELSE conf0 END AS classification_confidence, "
    f"concat(CASE WHEN {_STRIPPED} = '' THEN '{cl.NO_REASON}' ELSE {_STRIPPED} END, CASE WHEN {_LOUD} THEN '{cl.ADJUSTED}' ELSE '' END) AS reasoning FROM cls0)"
)
_EXT = (
    "ext AS (SELECT *, concat('Event detected: ', substr(raw_payload, 1, 120)) AS extracted_summary, "
    f"{kw('raw_payload', ex.COMPONENTS, 'unknown')} AS affected_component, {kw('raw_payload', ex.ERROR_CODES, '')} AS error_code, "
    f"{kw('raw_payload', ex.IMPACTS, ex.NO_IMPACT)} AS user_impact FROM cls)"
)
CLASSIFIED_SQL = f"{_OFF}, {_COH}"
EXTRACTED_SQL = f"{CLASSIFIED_SQL}, {_EXT}"
_A = "0.3::DOUBLE"
_B = "(1::DOUBLE - 0.3::DOUBLE)"
_EWMA = (
    "seq AS (SELECT event_id, concat(service, ':', event_type) AS bucket, "
    f"({pick('severity', {'low': '1.0', 'medium': '2.0', 'high': '3.0', 'critical': '4.0'}, '1.0')})::DOUBLE AS v, "
    "row_number() OVER (PARTITION BY concat(service, ':', event_type) ORDER BY ts, event_id) AS rn FROM ext), "
    "fold(event_id, bucket, rn, z, mean, variance) AS ("
    "SELECT event_id, bucket, rn, 0.0::DOUBLE, v, 0.0::DOUBLE FROM seq WHERE rn = 1 UNION ALL "
    "SELECT s.event_id, s.bucket, s.rn, CASE WHEN f.rn < 3 THEN 0.0::DOUBLE ELSE (s.v - f.mean) / (CASE WHEN f.variance > 0 THEN sqrt(f.variance) ELSE 1.0::DOUBLE END) END, "
    f"{_A} * s.v + {_B} * f.mean, {_B} * (f.variance + {_A} * (s.v - f.mean) * (s.v - f.mean)) "
    "FROM fold f JOIN seq s ON s.bucket = f.bucket AND s.rn = f.rn + 1), "
    "sc AS (SELECT ext.*, bucket, z AS z_raw, round(z, 3) AS z_score, abs(z) > 2.5 AS is_anomaly FROM ext JOIN fold USING (event_id))"
)
SCORED_SQL = f"{EXTRACTED_SQL}, {_EWMA}".replace("WITH raw", "WITH RECURSIVE raw", 1)
_RULE = kw("concat(raw_payload, ' ', extracted_summary)", [(k, r[0]) for r in ex.CAUSE_RULES for k in r[1]], "unknown")
_CAUSES = values_sql([(r[0], r[2], "|".join(r[3])) for r in ex.CAUSE_RULES], "rule, root_cause, recs")
_CAUSE = f"rc AS (SELECT sc.*, c.root_cause, c.recs FROM (SELECT *, {_RULE} AS rule FROM sc) sc JOIN {_CAUSES} c USING (rule))"
_FACT = (
    f"fac AS (SELECT *, ({pick('severity', rk.SEVERITY_POINTS, 5)})::DOUBLE AS f_sev, ({pick('event_type', rk.TYPE_POINTS, 5)})::DOUBLE AS f_type, "
    f"({pick('service', rk.SERVICE_POINTS, 7)})::DOUBLE AS f_svc, "
    "CASE WHEN is_anomaly THEN 20.0::DOUBLE + least(10.0::DOUBLE, abs(z_score) * 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS f_anom, "
    "-greatest(0.0::DOUBLE, (1.0::DOUBLE - classification_confidence) * 10.0::DOUBLE) AS f_conf FROM rc), "
    "rsk AS (SELECT *, CAST(greatest(0, least(100, round_even(f_sev + f_type + f_svc + f_anom + f_conf, 0))) AS INTEGER) AS risk_score FROM fac), "
    "enr AS (SELECT *, CASE WHEN risk_score >= 80 THEN 'critical' WHEN risk_score >= 60 THEN 'high' WHEN risk_score >= 35 THEN 'medium' ELSE 'low' END AS risk_level FROM rsk)"
)
ENRICHED_SQL = f"{SCORED_SQL}, {_CAUSE}, {_FACT}"
_SHOWN_Z = "CASE WHEN abs(z_score) < 1e6 THEN round(z_score, 3) ELSE CAST(CAST(z_score AS FLOAT) AS DOUBLE) END"
_SHOWN_SQL = f"{_SHOWN_Z} AS z_score"


def _shown_z():
    """z reaches 1e15 after constant runs: then it is compared by its first seven digits, as its third decimal has no meaning."""
    z = F.col("z_score")
    return F.when(F.abs(z) < 1e6, F.round(z, 3)).otherwise(z.cast("float").cast("double")).alias("z_score")


def classified(t: Tables):
    return cl.classify(raw_events(t))


def extracted(t: Tables):
    return ex.extract(classified(t))


def enriched(t: Tables):
    return mon.enrich(raw_events(t), RUN)


_CLS_COLS = ["event_id", "event_type", "severity", "classification_confidence", "classification_method", "reasoning"]

_HEUR = (
    f"{_RAW}, cls0 AS (SELECT *, {kw(_HTEXT, cl.HEURISTIC_TYPE, 'log')} AS event_type, {kw(_HTEXT, cl.HEURISTIC_SEVERITY, 'low')} AS severity, "
    f"'heuristic' AS classification_method, 0.6::DOUBLE AS conf0, 'Heuristic keyword match' AS raw_reason FROM raw), {_COH}"
)


@register("classify_heuristic", f"{_HEUR} SELECT {', '.join(_CLS_COLS)} FROM cls")
def _(t: Tables):
    failed = F.lit(None).cast("struct<event_type:string,severity:string,confidence:double,reasoning:string>")
    return cl.classify(raw_events(t), failed).select(*_CLS_COLS)


@register("classify_offline", f"{CLASSIFIED_SQL} SELECT {', '.join(_CLS_COLS)} FROM cls")
def _(t: Tables):
    return classified(t).select(*_CLS_COLS)


# A model whose answer for long payloads breaks the length limit of its reason text.
_WORDY = "concat(raw_payload, ' ', raw_payload)"
_MIXED = (
    f"{_RAW}, cls0 AS (SELECT *, length({_WORDY}) > 500 AS failed, "
    f"CASE WHEN length({_WORDY}) > 500 THEN {kw(_HTEXT, cl.HEURISTIC_TYPE, 'log')} ELSE {kw('raw_payload', cl.OFFLINE_TYPE, 'log')} END AS event_type, "
    f"CASE WHEN length({_WORDY}) > 500 THEN {kw(_HTEXT, cl.HEURISTIC_SEVERITY, 'low')} ELSE {kw('raw_payload', cl.OFFLINE_SEVERITY, 'low')} END AS severity, "
    f"CASE WHEN length({_WORDY}) > 500 THEN 'heuristic' ELSE 'llm' END AS classification_method, "
    f"CASE WHEN length({_WORDY}) > 500 THEN 0.6::DOUBLE ELSE 0.85::DOUBLE END AS conf0, "
    f"CASE WHEN length({_WORDY}) > 500 THEN 'Heuristic keyword match' ELSE {_WORDY} END AS raw_reason FROM raw), {_COH}"
)


def wordy_model():
    return F.struct(
        cl.offline_result()["event_type"].alias("event_type"), cl.offline_result()["severity"].alias("severity"),
        F.lit(0.85).alias("confidence"), F.concat_ws(" ", "raw_payload", "raw_payload").alias("reasoning"),
    )


@register("classify_with_fallback", f"{_MIXED} SELECT {', '.join(_CLS_COLS)} FROM cls")
def _(t: Tables):
    return cl.classify(raw_events(t), wordy_model()).select(*_CLS_COLS)


@register("response_limits", f"{_MIXED} SELECT event_type, failed, count(*) AS n FROM cls GROUP BY ALL")
def _(t: Tables):
    judged = cl.with_lowered(raw_events(t)).withColumn("m", wordy_model())
    failed = ~cl.within_limits({"reasoning": F.col("m.reasoning")})
    out = judged.withColumn("failed", failed).withColumn(
        "event_type", F.when(F.col("failed"), cl.heuristic_result()["event_type"]).otherwise(F.col("m.event_type"))
    )
    return out.groupBy("event_type", "failed").agg(F.count(F.lit(1)).alias("n"))


@register(
    "classification_coherence",
    f"{_RAW}, cls0 AS (SELECT *, CASE event_type_raw WHEN 'error' THEN 'unknown' ELSE 'log' END AS event_type, 'high' AS severity, 'llm' AS classification_method, "
    "0.9::DOUBLE AS conf0, CASE WHEN event_type_raw = 'view' THEN '  ' ELSE concat(' ', event_type_raw, ' ') END AS raw_reason FROM "
    "(SELECT raw.*, e.event_type AS event_type_raw FROM raw JOIN events e USING (event_id))), " + _COH +
    " SELECT event_id, classification_confidence, reasoning FROM cls",
)
def _(t: Tables):
    kind = F.col("event_type")
    answers = t.events.select(
        "event_id", F.when(kind == "error", "unknown").otherwise("log").alias("kind"), F.lit("high").alias("severity"),
        F.lit(0.9).alias("classification_confidence"),
        F.when(kind == "view", "  ").otherwise(F.concat(F.lit(" "), kind, F.lit(" "))).alias("reasoning"),
    )
    done = cl.cohere(answers, "kind", "severity", "classification_confidence", "reasoning")
    return done.select("event_id", "classification_confidence", "reasoning")


_REGEX_SQL = (
    "regexp_extract(raw_payload, '(?i)(HTTP\\s*\\d{3}|OOMKilled|TIMEOUT|SIGKILL|ECONNREFUSED)', 1)"
)
_CUT = "concat(regexp_replace(substr(raw_payload, 1, 200), '^\\s+|\\s+$', '', 'g'), CASE WHEN length(raw_payload) > 200 THEN '...' ELSE '' END)"


@register("extract_regex", f"{_RAW} SELECT event_id, {_CUT} AS summary, service AS affected_component, {_REGEX_SQL} AS error_code, '{ex.REGEX_IMPACT}' AS user_impact FROM raw")
def _(t: Tables):
    return raw_events(t).select("event_id", ex.regex_fields().alias("f")).select("event_id", "f.*")


_EXT_COLS = ["event_id", "extracted_summary", "affected_component", "error_code", "user_impact"]


@register("extract_offline", f"{EXTRACTED_SQL} SELECT {', '.join(_EXT_COLS)} FROM ext")
def _(t: Tables):
    return extracted(t).select(*_EXT_COLS)


@register("ewma_anomaly", f"{SCORED_SQL} SELECT event_id, bucket, {_SHOWN_SQL}, is_anomaly FROM sc")
def _(t: Tables):
    bucket = anomaly.bucket_of(F.col("service"), F.col("event_type")).alias("bucket")
    return anomaly.detect(extracted(t)).select("event_id", bucket, _shown_z(), "is_anomaly")


@register("ewma_zscore", f"{SCORED_SQL} SELECT bucket, count(*) AS events, count(*) FILTER (WHERE is_anomaly) AS flagged, min({_SHOWN_Z}) AS least_z, max({_SHOWN_Z}) AS greatest_z FROM sc GROUP BY bucket")
def _(t: Tables):
    bucket = anomaly.bucket_of(F.col("service"), F.col("event_type")).alias("bucket")
    return anomaly.detect(extracted(t)).groupBy(bucket).agg(
        F.count(F.lit(1)).alias("events"), F.count_if("is_anomaly").alias("flagged"),
        F.min(_shown_z()).alias("least_z"), F.max(_shown_z()).alias("greatest_z"),
    )


_LAST = (
    ", last AS (SELECT bucket, max(rn) AS count, arg_max(mean, rn) AS mean, arg_max(variance, rn) AS variance FROM fold GROUP BY bucket) "
    "SELECT bucket, round(mean, 3) AS mean, round(variance, 3) AS variance, CASE WHEN variance > 0 THEN round(sqrt(variance), 3) ELSE 0.0::DOUBLE END AS std, "
    "count, CASE WHEN count >= 3 THEN 'active' ELSE 'training' END AS status FROM last"
)


@register("state_snapshot", SCORED_SQL + _LAST)
def _(t: Tables):
    return anomaly.snapshot(anomaly.EwmaRun(extracted(t)).states())


@register("retrieval_query", f"{EXTRACTED_SQL} SELECT event_id, concat(service, ' ', event_type, ' ', severity, ' ', extracted_summary) AS query FROM ext")
def _(t: Tables):
    return extracted(t).select("event_id", mon.retrieval_query().alias("query"))


_CAUSE0 = _CAUSE.replace("FROM sc)", "FROM ext)", 1)


@register("root_cause_rules", f"{EXTRACTED_SQL}, {_CAUSE0} SELECT event_id, root_cause, 0.7::DOUBLE AS cause_confidence, recs AS recommendations FROM rc")
def _(t: Tables):
    return ex.root_cause(extracted(t)).select(
        "event_id", "root_cause", "cause_confidence", F.array_join("recommendations", "|").alias("recommendations")
    )


_FAIL = "length(raw_payload) > 200"


@register(
    "root_cause_fallback",
    f"{EXTRACTED_SQL}, {_CAUSE0} SELECT event_id, CASE WHEN {_FAIL} THEN 'Unable to determine root cause (LLM failed: RuntimeError)' ELSE root_cause END AS root_cause, "
    f"CASE WHEN {_FAIL} THEN 0.1::DOUBLE ELSE 0.7::DOUBLE END AS cause_confidence, CASE WHEN {_FAIL} THEN 'Manual investigation required|Check service logs' ELSE recs END AS recommendations FROM rc",
)
def _(t: Tables):
    return ex.root_cause(extracted(t), failed=F.length("raw_payload") > 200).select(
        "event_id", "root_cause", "cause_confidence", F.array_join("recommendations", "|").alias("recommendations")
    )


@register("actionable_flag", f"{EXTRACTED_SQL} SELECT {_FAIL} AS failed, NOT {_FAIL} AS actionable, count(*) AS n FROM ext GROUP BY ALL")
def _(t: Tables):
    caused = ex.root_cause(extracted(t), failed=F.length("raw_payload") > 200)
    flag = ex.actionable(F.col("recommendations"), F.col("cause_confidence")).alias("actionable")
    return caused.groupBy((F.length("raw_payload") > 200).alias("failed"), flag).agg(F.count(F.lit(1)).alias("n"))


@register("risk_score", f"{ENRICHED_SQL} SELECT event_id, risk_score, risk_level FROM enr")
def _(t: Tables):
    return rk.score_risk(anomaly.detect(extracted(t))).select("event_id", "risk_score", "risk_level")


@register("risk_factors", f"{ENRICHED_SQL} SELECT event_id, f_sev AS severity, f_type AS event_type, f_svc AS service_criticality, round(f_anom, 4) AS anomaly_bonus, round(f_conf, 4) AS confidence_penalty FROM enr")
def _(t: Tables):
    rated = rk.score_risk(anomaly.detect(extracted(t))).select("event_id", "risk_factors.*")
    return rated.withColumns({c: F.round(c, 4) for c in ("anomaly_bonus", "confidence_penalty")})


_ENR_COLS = ["event_id", "source", "service", "event_type", "severity", "classification_confidence", "classification_method",
             "extracted_summary", "is_anomaly", "root_cause", "risk_score", "risk_level"]


@register("enrich_events", f"{ENRICHED_SQL} SELECT {', '.join(_ENR_COLS)}, {_SHOWN_SQL}, recs AS recommendations, '{RUN}' AS pipeline_run_id, 'v1' AS prompt_version FROM enr")
def _(t: Tables):
    return enriched(t).select(
        *_ENR_COLS, _shown_z(), F.array_join("recommendations", "|").alias("recommendations"), "pipeline_run_id", "prompt_version"
    )


_TITLE = "concat(upper(severity), ' — ', service, ': ', event_type)"


@register("build_alert", f"{ENRICHED_SQL} SELECT sha256(concat('{RUN}|', cast(event_id AS VARCHAR))) AS alert_id, event_id, service, severity, risk_score, risk_level, {_TITLE} AS title, extracted_summary AS summary, root_cause FROM enr WHERE risk_score >= 60")
def _(t: Tables):
    return rk.build_alerts(enriched(t), RUN).drop("timestamp", "recommendations", "pipeline_run_id")


@register("alert_summary", f"{ENRICHED_SQL} SELECT service, severity, {_TITLE} AS title, count(*) AS alerts, max(risk_score) AS max_score, round(avg(risk_score), 4) AS mean_score FROM enr WHERE risk_score >= 60 GROUP BY ALL")
def _(t: Tables):
    return rk.alert_summary(rk.build_alerts(enriched(t), RUN))


@register("filter_threshold", f"{ENRICHED_SQL} SELECT event_id, risk_score FROM enr WHERE risk_score >= 60")
def _(t: Tables):
    return enriched(t).filter(F.col("risk_score") >= rk.ALERT_THRESHOLD).select("event_id", "risk_score")


# ---- scoring calls ----------------------------------------------------------

_MODEL = "CASE user_id % 4 WHEN 0 THEN 'gpt-4o-mini' WHEN 1 THEN 'gpt-4o' WHEN 2 THEN 'dummy-heuristic-v1' ELSE 'my-model' END"


def _prompt_sql(step: str) -> str:
    parts, rest = [], mon.PROMPTS["v1"][step]
    while "{" in rest:
        head, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        parts += [f"'{head}'", f"coalesce(cast({name} AS VARCHAR), '')"]
    return f"concat({', '.join([*parts, repr(rest)])})".replace("\n", "' || chr(10) || '").replace("'\\n'", "chr(10)")


def _tokens_sql(step: str) -> str:
    return f"2 * len(list_filter(string_split_regex({_prompt_sql(step)}, '\\s+'), lambda w: w <> ''))"


_CALLS = (
    f"{SCORED_SQL}, m AS (SELECT sc.*, {_FAIL} AS failed, {_MODEL} AS model FROM sc JOIN (SELECT event_id, user_id FROM events) USING (event_id)), calls0 AS ("
    + " UNION ALL ".join(
        f"SELECT event_id, '{s}' AS step, CASE WHEN failed THEN NULL ELSE model END AS model_id, CASE WHEN failed THEN 0 ELSE {_tokens_sql(s)} END AS input_tokens, "
        f"CASE WHEN failed THEN 0 ELSE {n} END AS output_tokens, NOT failed AS success, failed AS fallback_used FROM m" for s, n in rk.OUTPUT_TOKENS.items()
    )
    + f"), calls AS (SELECT c.*, CASE WHEN c.model_id IS NULL THEN 0.0::DOUBLE ELSE round((input_tokens * coalesce(pin, 3.0::DOUBLE) + output_tokens * coalesce(pout, 15.0::DOUBLE)) / 1000000, 6) END AS estimated_cost_usd "
    f"FROM calls0 c LEFT JOIN {values_sql(rk.PRICES, 'model_id, pin, pout')} p ON p.model_id = c.model_id)"
)


def _events_with_model(t: Tables):
    scored = anomaly.detect(extracted(t))
    return scored.join(t.events.selectExpr("event_id", f"{_MODEL} AS model"), "event_id")


def scoring_calls(t: Tables, events=None):
    steps = {s: mon.prompt(s) for s in rk.OUTPUT_TOKENS}
    return rk.calls_log(events if events is not None else _events_with_model(t), steps, F.col("model"), F.length("raw_payload") > 200)


@register("score_calls_log", f"{_CALLS} SELECT event_id, step, model_id, input_tokens, output_tokens, success, fallback_used, estimated_cost_usd FROM calls")
def _(t: Tables):
    return scoring_calls(t).drop("call_id")


@register(
    "scoring_call_summary",
    f"{_CALLS} SELECT step, count(*) AS total_calls, CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens, CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens, "
    "round(sum(estimated_cost_usd), 6) AS total_cost_usd, round(avg(fallback_used::INT), 4) AS fallback_rate FROM calls GROUP BY step",
)
def _(t: Tables):
    return rk.calls_summary(scoring_calls(t), "step")


@register("price_table_join", f"{_CALLS} SELECT model_id, step, round(sum(estimated_cost_usd), 6) AS cost, count(*) AS n FROM calls GROUP BY ALL")
def _(t: Tables):
    return scoring_calls(t).groupBy("model_id", "step").agg(
        F.round(F.sum("estimated_cost_usd"), 6).alias("cost"), F.count(F.lit(1)).alias("n")
    )


@register("f_cost_usd", f"{_CALLS} SELECT event_id, estimated_cost_usd FROM calls WHERE step = 'extract'")
def _(t: Tables):
    return scoring_calls(t).filter("step = 'extract'").select("event_id", "estimated_cost_usd")


_COUNTS = "count(*) AS events_processed, count(event_type) AS events_classified, count(*) FILTER (WHERE is_anomaly) AS anomalies_detected, count(*) FILTER (WHERE risk_score >= 60) AS alerts_emitted"


@register(
    "run_record",
    f"{_CALLS}, {_CAUSE}, {_FACT}, a AS (SELECT {_COUNTS} FROM enr), b AS (SELECT count(*) AS total_calls, CAST(sum(input_tokens) AS BIGINT) AS total_input_tokens, "
    "CAST(sum(output_tokens) AS BIGINT) AS total_output_tokens, round(sum(estimated_cost_usd), 6) AS total_cost_usd, round(avg(fallback_used::INT), 4) AS fallback_rate FROM calls) "
    f"SELECT '{RUN}' AS run_id, a.*, b.* FROM a, b",
)
def _(t: Tables):
    scored = _events_with_model(t)
    record = rk.run_record(rk.score_risk(scored), scoring_calls(t, scored), RUN, scratch_path(t.spark, "run"))
    return record.drop("prompt_version", "started_at", "finished_at", "avg_latency_ms")


# ---- the job with a model ---------------------------------------------------

def cause_model() -> Model:
    """A stand-in for a user's model of causes: it fails on long payloads and breaks its contract on reports."""
    def score(asked: pd.DataFrame) -> pd.DataFrame:
        text = asked["raw_payload"]
        return pd.DataFrame({
            "root_cause": "Trouble with " + asked["service"], "confidence": [1.5 if "nightly" in x else 0.9 for x in text],
            "contributing_factors": [["load"]] * len(asked), "recommendations": [["Look at " + x] * 7 for x in asked["service"]], "similar_incidents": None,
            "error": ["RuntimeError: payload too long" if len(x) > 200 else None for x in text],
        })

    return Model(score, provider="local", model_id="gpt-4o-mini", wait=0.0)


def model_run(t: Tables, failed: str = "keep") -> mon.JobResult:
    return mon.run_job(raw_events(t), RUN, scratch_path(t.spark, "job"), models={"root_cause": cause_model()}, failed=failed)


_BROKEN = "contains(raw_payload, 'nightly')"
_REFUSED = f"({_FAIL} OR {_BROKEN})"
_MODEL_CAUSE = (
    f"CASE WHEN {_FAIL} THEN 'Unable to determine root cause (LLM failed: RuntimeError)' WHEN {_BROKEN} THEN 'Unable to determine root cause (LLM failed: Malformed)' "
    "ELSE concat('Trouble with ', service) END AS root_cause"
)
_MODEL_RECS = (
    f"CASE WHEN {_REFUSED} THEN 'Manual investigation required|Check service logs' "
    "ELSE array_to_string(list_transform(range(5), lambda i: concat('Look at ', service)), '|') END AS recommendations"
)


@register(
    "root_cause_model",
    f"{ENRICHED_SQL} SELECT event_id, {_MODEL_CAUSE}, CASE WHEN {_REFUSED} THEN 0.1::DOUBLE ELSE 0.9::DOUBLE END AS cause_confidence, {_MODEL_RECS}, risk_score, is_anomaly FROM enr",
)
def _(t: Tables):
    return model_run(t).enriched.select(
        "event_id", "root_cause", "cause_confidence", F.array_join("recommendations", "|").alias("recommendations"), "risk_score", "is_anomaly"
    )


@register("enrich_routed", f"{ENRICHED_SQL} SELECT event_id, service, event_type, severity, risk_score, risk_level, {_MODEL_CAUSE} FROM enr WHERE NOT {_REFUSED}")
def _(t: Tables):
    return model_run(t, "route").enriched.select("event_id", "service", "event_type", "severity", "risk_score", "risk_level", "root_cause")


@register(
    "enrich_dead_letters",
    f"{EXTRACTED_SQL} SELECT event_id, service, raw_payload, 'root_cause' AS step, CASE WHEN {_FAIL} THEN 'RuntimeError' ELSE 'Malformed' END AS error_type, "
    f"CASE WHEN {_FAIL} THEN 'payload too long' ELSE 'confidence is not from 0.0 to 1.0' END AS error, NOT {_FAIL} AS answered, '{RUN}' AS pipeline_run_id FROM ext WHERE {_REFUSED}",
)
def _(t: Tables):
    return model_run(t).dead_letters.select(
        "event_id", "service", "raw_payload", "step", "error_type", "error", F.col("raw").isNotNull().alias("answered"), "pipeline_run_id"
    )


@register(
    "model_calls_log",
    f"{SCORED_SQL}, c AS (SELECT event_id, 'root_cause' AS step, 'local' AS provider, 'gpt-4o-mini' AS model_id, NOT {_FAIL} AS success, NOT {_REFUSED} AS parse_success, "
    f"{_REFUSED} AS fallback_used, CASE WHEN {_FAIL} THEN 0 ELSE {_tokens_sql('root_cause')} END AS input_tokens, CASE WHEN {_FAIL} THEN 0 ELSE 200 END AS output_tokens FROM sc) "
    "SELECT *, round((input_tokens * 0.15::DOUBLE + output_tokens * 0.60::DOUBLE) / 1000000, 6) AS estimated_cost_usd, true AS timed FROM c",
)
def _(t: Tables):
    return model_run(t).calls.select(
        "event_id", "step", "provider", "model_id", "success", "parse_success", "fallback_used", "input_tokens", "output_tokens", "estimated_cost_usd",
        ((F.col("latency_ms") >= 0) & F.col("asked_at").isNotNull() & (F.col("attempts") == 1)).alias("timed"),
    )


@register(
    "model_run_record",
    f"{ENRICHED_SQL}, m AS (SELECT *, CASE WHEN {_FAIL} THEN 0 ELSE {_tokens_sql('root_cause')} END AS tin, CASE WHEN {_FAIL} THEN 0 ELSE 200 END AS tout FROM enr) "
    f"SELECT '{RUN}' AS run_id, 'v1' AS prompt_version, {_COUNTS}, count(*) AS total_calls, CAST(sum(tin) AS BIGINT) AS total_input_tokens, CAST(sum(tout) AS BIGINT) AS total_output_tokens, "
    f"round(sum(round((tin * 0.15::DOUBLE + tout * 0.60::DOUBLE) / 1000000, 6)), 6) AS total_cost_usd, round(avg({_REFUSED}::INT), 4) AS fallback_rate, true AS timed FROM m",
)
def _(t: Tables):
    timed = (F.col("finished_at") >= F.col("started_at")) & (F.col("avg_latency_ms") >= 0)
    return model_run(t).record.withColumn("timed", timed).drop("started_at", "finished_at", "avg_latency_ms")


# ---- cycles -----------------------------------------------------------------

_CYC = (
    f"{ENRICHED_SQL}, cyc AS (SELECT epoch(ts)::BIGINT // 3600 AS cycle, count(*) AS events, count(*) FILTER (WHERE is_anomaly) AS anomalies, "
    "count(*) FILTER (WHERE risk_score >= 60) AS alerts, avg(risk_score) AS avg_risk FROM (SELECT * REPLACE (date_trunc('hour', ts) AS ts) FROM enr) GROUP BY 1)"
)


def hour_cycle():
    return F.expr("unix_seconds(cast(date_trunc('hour', ts) AS timestamp)) div 3600")


@register("cycle_stats", f"{_CYC} SELECT cycle, events, anomalies, alerts, round(avg_risk, 6) AS avg_risk, CAST(sum(events) OVER w AS BIGINT) AS total_events, CAST(sum(anomalies) OVER w AS BIGINT) AS total_anomalies, CAST(sum(alerts) OVER w AS BIGINT) AS total_alerts FROM cyc WINDOW w AS (ORDER BY cycle)")
def _(t: Tables):
    return rk.cycle_stats(enriched(t), hour_cycle()).withColumn("avg_risk", F.round("avg_risk", 6))


@register(
    "delta_vs_previous",
    f"{_CYC}, d AS (SELECT cycle, anomalies - lag(anomalies) OVER (ORDER BY cycle) AS anomaly_delta, avg_risk - lag(avg_risk) OVER (ORDER BY cycle) AS rd FROM cyc) "
    "SELECT cycle, anomaly_delta, CASE WHEN anomaly_delta > 0 THEN 'up' WHEN anomaly_delta < 0 THEN 'down' WHEN anomaly_delta = 0 THEN 'flat' END AS anomaly_trend, "
    "round(rd, 1) AS risk_delta, CASE WHEN rd > 5 THEN 'up' WHEN rd < -5 THEN 'down' WHEN rd IS NOT NULL THEN 'flat' END AS risk_trend FROM d",
)
def _(t: Tables):
    cycles = rk.score_risk(anomaly.detect(extracted(t))).groupBy(hour_cycle().alias("cycle")).agg(
        F.count_if("is_anomaly").alias("anomalies"), F.avg("risk_score").alias("avg_risk")
    )
    return rk.delta_vs_previous(cycles).select("cycle", "anomaly_delta", "anomaly_trend", "risk_delta", "risk_trend")


@register(
    "errors_recent_by_service",
    f"{_RAW} SELECT service, count(*) AS errors FROM raw WHERE ts > (SELECT max(ts) FROM raw) - INTERVAL 720 MINUTE AND "
    "(contains(lower(raw_payload), 'error') OR contains(raw_payload, 'HTTP 5')) GROUP BY service",
)
def _(t: Tables):
    # Twelve hours: the test events are minutes apart, fifteen minutes would hold a handful.
    is_error = F.lower("raw_payload").contains("error") | F.col("raw_payload").contains("HTTP 5")
    return rk.recent_errors(raw_events(t), is_error, minutes=720)
