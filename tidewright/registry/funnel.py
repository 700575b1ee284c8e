"""Funnel and semantic-layer queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import funnel as fn
from ..operators import semantic as sem
from . import Tables, register
from .fixtures import FUNNEL_SQL, funnel_raw, values_sql

_FORMATS = ["%d/%m/%Y %H:%M:%S", "%Y-%m-%d %H:%M:%S", "%Y-%m-%dT%H:%M:%S", "%Y/%m/%d %H:%M", "%d/%m/%Y", "%Y-%m-%d", "%Y/%m/%d"]
_PARSED = "coalesce(" + ", ".join(f"try_strptime(timestamp, '{f}')" for f in _FORMATS) + ")"
_ORDER = "CASE lower(trim(etapa)) " + " ".join(f"WHEN '{s}' THEN {i}" for i, s in enumerate(fn.STAGES, 1)) + " END"
_CTE = (
    f"WITH raw AS ({FUNNEL_SQL}), silver AS (SELECT trim(user_id) AS user_id, lower(trim(plano)) AS plano, "
    "nullif(lower(trim(device)), '') AS device, lower(trim(etapa)) AS etapa, timestamp AS timestamp_raw, "
    f"{_PARSED} AS event_ts, {_ORDER} AS stage_order FROM raw)"
)
_DIM = "min(plano) AS plano, coalesce(max(device), 'unknown') AS device, min(event_ts) AS first_event_ts, max(event_ts) AS last_event_ts, count(*) AS total_events"
_FLAGS = ", ".join(f"max(CASE WHEN etapa = '{s}' THEN 1 ELSE 0 END) AS has_{s}" for s in fn.STAGES)
_FIRSTS = ", ".join(f"min(CASE WHEN etapa = '{s}' THEN event_ts END) AS {s}_ts" for s in fn.STAGES)
_USERS = f"{_CTE}, users AS (SELECT user_id, {_DIM}, {_FLAGS}, {_FIRSTS} FROM silver GROUP BY user_id)"
_SUMS = ", ".join(f"CAST(sum(has_{s}) AS BIGINT) AS {s}" for s in fn.STAGES)


def _pct(a: str, b: str) -> str:
    return f"round(100.0::DOUBLE * {a} / nullif({b}, 0), 1)"


_RATES = ", ".join(f"{_pct(s, fn.STAGES[0])} AS pct_{s}" for s in fn.STAGES[1:])
_TRANS = ", ".join(f"{_pct(b, a)} AS trans_{a}_to_{b}" for a, b in zip(fn.STAGES, fn.STAGES[1:]))
_SEG = f"seg AS (SELECT plano, device, count(*) AS usuarios, {_SUMS} FROM users GROUP BY plano, device)"
_MART = f"{_USERS}, {_SEG}, mart AS (SELECT *, {_RATES}, {_TRANS} FROM seg)"


def _dt(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}"


def _show_ts(df: DataFrame) -> DataFrame:
    """Timestamps as text, so that both sides compare the same value."""
    stamps = [c for c, kind in df.dtypes if kind.startswith("timestamp")]
    return df.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


def silver(t: Tables) -> DataFrame:
    return fn.silver(funnel_raw(t))


def users(t: Tables) -> DataFrame:
    return fn.user_funnel(silver(t))


@register("silver_normalize", f"{_CTE} SELECT * REPLACE ({_dt('event_ts')}) FROM silver")
def _(t: Tables):
    return _show_ts(silver(t))


@register("case_stage_order", f"{_CTE} SELECT etapa, stage_order, count(*) AS n FROM silver GROUP BY ALL")
def _(t: Tables):
    return silver(t).groupBy("etapa", "stage_order").agg(F.count(F.lit(1)).alias("n"))


@register("dim_user", f"{_CTE} SELECT user_id, {_DIM} FROM silver GROUP BY user_id".replace(
    "min(event_ts) AS first_event_ts", "strftime(min(event_ts), '%Y-%m-%d %H:%M:%S') AS first_event_ts").replace(
    "max(event_ts) AS last_event_ts", "strftime(max(event_ts), '%Y-%m-%d %H:%M:%S') AS last_event_ts"))
def _(t: Tables):
    return _show_ts(fn.dim_user(silver(t)))


@register("fct_user_funnel", f"{_USERS} SELECT user_id, {', '.join('has_' + s for s in fn.STAGES)}, {', '.join(_dt(s + '_ts') for s in fn.STAGES)} FROM users")
def _(t: Tables):
    return _show_ts(fn.fct_user_funnel(silver(t)))


@register("join_using_key", f"{_USERS} SELECT user_id, plano, device, total_events, {', '.join('has_' + s for s in fn.STAGES)} FROM users")
def _(t: Tables):
    events = silver(t)
    joined = fn.join_fact_dimension(fn.fct_user_funnel(events), fn.dim_user(events))
    return joined.select("user_id", "plano", "device", "total_events", *[f"has_{s}" for s in fn.STAGES])


@register("mart_funnel_segmented", f"{_MART} SELECT * FROM mart")
def mart(t: Tables):
    return fn.mart_segmented(users(t))


@register("order_by_multi", f"{_MART} SELECT plano, device, usuarios, pct_exportacao FROM mart ORDER BY plano, device")
def _(t: Tables):
    return mart(t).select("plano", "device", "usuarios", "pct_exportacao").orderBy("plano", F.col("device").asc())


@register("funnel_overall", f"{_USERS}, one AS (SELECT count(*) AS usuarios, {_SUMS} FROM users) SELECT *, {_RATES} FROM one")
def _(t: Tables):
    return fn.funnel_overall(users(t))


@register(
    "count_filter",
    f"{_CTE} SELECT count(*) AS linhas, count(*) FILTER (WHERE device IS NULL) AS linhas_sem_device, "
    "count(*) FILTER (WHERE event_ts IS NULL) AS linhas_sem_timestamp_parseado FROM silver",
)
def _(t: Tables):
    return fn.missing_counts(silver(t))


@register("rule_device_required", f"{_CTE} SELECT plano, count(*) AS linhas, count(*) - count(device) AS sem_device FROM silver GROUP BY plano")
def _(t: Tables):
    return silver(t).groupBy("plano").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("device").isNull()).alias("sem_device")
    )


@register("rule_timestamp_parsed", f"{_CTE} SELECT etapa, count(*) AS linhas, count(*) - count(event_ts) AS sem_ts FROM silver GROUP BY etapa")
def _(t: Tables):
    return silver(t).groupBy("etapa").agg(
        F.count(F.lit(1)).alias("linhas"), F.count_if(F.col("event_ts").isNull()).alias("sem_ts")
    )


@register("safe_ratio_pct", f"{_USERS} SELECT user_id, {_pct('has_exportacao', 'has_ativacao')} AS pct_export, {_pct('has_ativacao', 'total_events')} AS pct_ativ FROM users")
def _(t: Tables):
    from ..functions.numbers import ratio_pct

    return users(t).select(
        "user_id",
        ratio_pct(F.col("has_exportacao"), F.col("has_ativacao")).alias("pct_export"),
        ratio_pct(F.col("has_ativacao"), F.col("total_events")).alias("pct_ativ"),
    )


# ---- semantic layer ---------------------------------------------------------

_N = values_sql(sem.node_rows(), "node_id, node_type, label, physical_ref, description")
_E = values_sql(sem.edge_rows(), "source_id, relation, target_id, confidence, description")
_M = values_sql(sem.metric_rows(), "metric_id, label, numerator_node, denominator_node, grain, default_segments, business_question, interpretation_warning")
_R = values_sql(sem.rule_rows(), "rule_id, rule_type, expression, description, severity")
_OBS = (
    "obs AS (SELECT 'entity_user' AS node_id, count(*) AS observed FROM users "
    "UNION ALL SELECT 'entity_event', CAST(sum(total_events) AS BIGINT) FROM users "
    "UNION ALL SELECT 'dim_plano', count(DISTINCT plano) FROM users "
    "UNION ALL SELECT 'dim_device', count(DISTINCT device) FROM users "
    + " ".join(f"UNION ALL SELECT 'stage_{s}', CAST(sum(has_{s}) AS BIGINT) FROM users" for s in fn.STAGES)
    + ")"
)
_SEM = f"{_USERS}, {_OBS}, nodes AS {_N}, edges AS {_E}"
_FOCUS = "metric_onboarding_completo_rate"


@register("table_from_literals", f"{_SEM} SELECT node_id, node_type, label, physical_ref, description, observed FROM nodes JOIN obs USING (node_id)")
def _(t: Tables):
    return sem.nodes(t.spark).join(sem.observed_nodes(users(t)), "node_id")


@register(
    "join_edge_to_nodes",
    f"{_SEM} SELECT e.source_id, e.relation, e.target_id, e.confidence, m.label AS source_label, n.label AS target_label, observed "
    "FROM edges e JOIN nodes m ON m.node_id = e.source_id JOIN nodes n ON n.node_id = e.target_id JOIN obs o ON o.node_id = e.target_id",
)
def _(t: Tables):
    resolved = sem.resolve_edges(sem.edges(t.spark), sem.nodes(t.spark))
    obs = sem.observed_nodes(users(t)).withColumnRenamed("node_id", "target_id")
    return resolved.join(obs, "target_id").select(
        "source_id", "relation", "target_id", "confidence", "source_label", "target_label", "observed"
    )


@register("filter_equals_and", f"{_SEM} SELECT source_id, target_id, observed FROM edges JOIN obs ON node_id = target_id WHERE source_id = '{_FOCUS}' AND relation = 'NUMERATOR_IS'")
def _(t: Tables):
    wanted = (F.col("source_id") == _FOCUS) & (F.col("relation") == "NUMERATOR_IS")
    obs = sem.observed_nodes(users(t)).withColumnRenamed("node_id", "target_id")
    return sem.edges(t.spark).filter(wanted).join(obs, "target_id").select("source_id", "target_id", "observed")


@register(
    "semantic_describe_metric",
    f"{_SEM} SELECT m.label AS metric, e.relation, n.label AS target, n.node_type AS kind, n.physical_ref, n.description, observed "
    f"FROM edges e JOIN nodes m ON m.node_id = e.source_id JOIN nodes n ON n.node_id = e.target_id JOIN obs o ON o.node_id = e.target_id WHERE e.source_id = '{_FOCUS}'",
)
def _(t: Tables):
    told = sem.describe_metric(sem.edges(t.spark), sem.nodes(t.spark), _FOCUS)
    obs = sem.observed_nodes(users(t)).withColumnRenamed("node_id", "target_id")
    return told.join(obs, "target_id").select(
        F.col("source_label").alias("metric"), "relation", F.col("target_label").alias("target"),
        F.col("target_type").alias("kind"), "physical_ref", F.col("target_description").alias("description"), "observed",
    )


@register(
    "semantic_recommended_segments",
    f"{_SEM} SELECT n.label AS segment, n.physical_ref, observed AS distinct_values FROM edges e JOIN nodes n ON n.node_id = e.target_id "
    f"JOIN obs o ON o.node_id = e.target_id WHERE e.source_id = '{_FOCUS}' AND e.relation = 'SHOULD_SEGMENT_BY'",
)
def _(t: Tables):
    told = sem.recommended_segments(sem.edges(t.spark), sem.nodes(t.spark), _FOCUS)
    obs = sem.observed_nodes(users(t)).withColumnRenamed("node_id", "target_id")
    return told.join(obs, "target_id").select(
        F.col("target_label").alias("segment"), "physical_ref", F.col("observed").alias("distinct_values")
    )


_FOCUS_PCT = _pct("sum(has_onboarding_completo)::BIGINT", "sum(has_cadastro)::BIGINT")


@register(
    "semantic_rule_lookup",
    f"{_USERS} SELECT rule_id, rule_type, severity, plano, device, {_FOCUS_PCT} AS rate FROM users "
    f"JOIN {_R} r ON r.rule_id = 'rule_segment_before_conclusion' GROUP BY ALL",
)
def _(t: Tables):
    rule = sem.rule_lookup(sem.rules(t.spark), "rule_segment_before_conclusion").first()
    values = sem.metric_values(users(t), sem.metrics(t.spark)).filter(F.col("metric_id") == _FOCUS)
    return values.select(
        F.lit(rule.rule_id).alias("rule_id"), F.lit(rule.rule_type).alias("rule_type"),
        F.lit(rule.severity).alias("severity"), "plano", "device", "rate",
    )


def _metric_sql(by: str) -> str:
    arms = " UNION ALL ".join(
        f"SELECT '{r[0]}' AS metric_id, {by}, CAST(sum(has_{r[2].removeprefix('stage_')}) AS BIGINT) AS numerator, "
        f"CAST(sum(has_{r[3].removeprefix('stage_')}) AS BIGINT) AS denominator FROM users GROUP BY {by}"
        for r in sem.metric_rows()
    )
    return f"{_USERS}, vals AS ({arms})"


@register("metric_from_catalogue", f"{_metric_sql('plano, device')} SELECT *, {_pct('numerator', 'denominator')} AS rate FROM vals")
def _(t: Tables):
    return sem.metric_values(users(t), sem.metrics(t.spark))


@register(
    "rule_segment_first",
    f"{_metric_sql('plano, device')}, tot AS (SELECT metric_id, {_pct('sum(numerator)::BIGINT', 'sum(denominator)::BIGINT')} AS overall_rate FROM vals GROUP BY metric_id), "
    f"r AS (SELECT *, {_pct('numerator', 'denominator')} AS rate FROM vals) SELECT r.*, overall_rate, round(rate - overall_rate, 1) AS gap FROM r JOIN tot USING (metric_id)",
)
def _(t: Tables):
    return sem.segment_gaps(sem.metric_values(users(t), sem.metrics(t.spark)))


_PAIRS = [(f"{b}<{a}", b, a) for a, b in zip(fn.STAGES, fn.STAGES[1:])]
_BROKEN = "list_filter([" + ", ".join(f"CASE WHEN has_{b} = 1 AND has_{a} = 0 THEN '{k}' END" for k, b, a in sorted(_PAIRS)) + "], lambda x: x IS NOT NULL)"


@register("rule_stage_order", f"{_USERS} SELECT user_id, plano, array_to_string(list_sort({_BROKEN}), ',') AS broken FROM users WHERE len({_BROKEN}) > 0")
def _(t: Tables):
    found = sem.stage_order_violations(users(t), sem.edges(t.spark))
    return found.select("user_id", "plano", F.array_join(F.array_sort("broken"), ",").alias("broken"))


_POS = {s: i for i, s in enumerate(fn.STAGES)}
_CHAIN = " UNION ALL ".join(
    f"SELECT 'stage_{b}' AS stage, 'stage_{a}' AS ancestor, {_POS[b] - _POS[a]} AS distance, CAST(sum(has_{b} * has_{a}) AS BIGINT) AS users_with_both FROM users"
    for b in fn.STAGES for a in fn.STAGES if _POS[a] < _POS[b]
)


@register("stage_chain", f"{_USERS} {_CHAIN}")
def _(t: Tables):
    chain = sem.stage_chain(sem.edges(t.spark))
    # The set of stages a user has, counted once per distinct set: at most 2^stages rows.
    having = F.array_compact(F.array(*[F.when(F.col(f"has_{s}") == 1, F.lit(f"stage_{s}")) for s in fn.STAGES]))
    sets = users(t).groupBy(having.alias("having")).agg(F.count(F.lit(1)).alias("n"))
    both = F.array_contains("having", F.col("stage")) & F.array_contains("having", F.col("ancestor"))
    counts = (
        sets.select(F.explode("having").alias("stage"), "having", "n")
        .join(F.broadcast(chain), "stage").groupBy("stage", "ancestor", "distance")
        .agg(F.sum(F.when(both, F.col("n")).otherwise(0)).alias("users_with_both"))
    )
    return counts


@register(
    "rule_denominator",
    f"{_USERS} SELECT plano, device, count(DISTINCT CASE WHEN has_cadastro = 1 THEN user_id END) AS first_stage_users, "
    "CAST(sum(has_cadastro) AS BIGINT) AS denominator, first_stage_users = denominator AS agrees FROM users GROUP BY plano, device",
)
def _(t: Tables):
    counted = users(t).groupBy("plano", "device").agg(
        F.count_distinct(F.when(F.col("has_cadastro") == 1, F.col("user_id"))).alias("first_stage_users"),
        F.sum("has_cadastro").alias("denominator"),
    )
    return counted.withColumn("agrees", F.col("first_stage_users") == F.col("denominator"))
