"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import numbers as nb, text as tx, vectors as vx
from ..operators import funnel as fn
from ..operators import risk as rk
from ..operators.sizes import broadcast_if_small
from ..plans import monitoring as mon
from . import Tables, register
from .fixtures import FUNNEL_SQL, RAW_EVENT_SQL, TX_SQL, funnel_raw, raw_events, transactions
from .funnel import _CTE, _show_ts, silver
from .monitoring import CLASSIFIED_SQL, EXTRACTED_SQL, _REGEX_SQL, _prompt_sql, classified, extracted, kw
from ..operators import classify as cl


@register("f_trim_lower_nullif", f"WITH raw AS ({FUNNEL_SQL}) SELECT nullif(lower(trim(device)), '') AS device, nullif(lower(trim(plano)), '') AS plano, count(*) AS n FROM raw GROUP BY ALL")
def _(t: Tables):
    cleaned = funnel_raw(t).select(tx.clean_or_null(F.col("device")).alias("device"), tx.clean_or_null(F.col("plano")).alias("plano"))
    return cleaned.groupBy("device", "plano").agg(F.count(F.lit(1)).alias("n"))


@register("f_parse_mixed_ts", f"{_CTE} SELECT timestamp_raw, strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS event_ts FROM silver")
def _(t: Tables):
    return _show_ts(silver(t).select("timestamp_raw", "event_ts"))


@register("f_coalesce_default", f"{_CTE} SELECT user_id, coalesce(max(device), 'unknown') AS device FROM silver GROUP BY user_id")
def _(t: Tables):
    return fn.dim_user(silver(t)).select("user_id", "device")


@register("f_format_date", "SELECT strftime(o_orderdate, '%Y-%m-%d') AS dt, count(*) AS n FROM orders GROUP BY 1")
def _(t: Tables):
    return t.orders.groupBy(tx.format_day(F.col("o_orderdate")).alias("dt")).agg(F.count(F.lit(1)).alias("n"))


@register("f_round_half_even", "SELECT l_orderkey, l_linenumber, l_partkey, round_even(l_quantity / 2, 0) AS half FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", nb.round_half_even(F.col("l_quantity") / 2).alias("half"))


@register("f_clamp", "SELECT event_id, greatest(0::DOUBLE, least(100::DOUBLE, value - 20)) AS score FROM events")
def _(t: Tables):
    return t.events.select("event_id", nb.clamp(F.col("value") - 20, 0.0, 100.0).alias("score"))


@register("f_keyword_first_match", f"WITH raw AS ({RAW_EVENT_SQL}) SELECT event_id, {kw('raw_payload', cl.OFFLINE_TYPE, 'log')} AS kind FROM raw")
def _(t: Tables):
    return raw_events(t).select("event_id", tx.first_keyword(F.col("raw_payload"), cl.OFFLINE_TYPE, "log").alias("kind"))


@register("f_regex_extract_ci", f"WITH raw AS ({RAW_EVENT_SQL}) SELECT event_id, {_REGEX_SQL} AS error_code FROM raw")
def _(t: Tables):
    from ..operators.extract import ERROR_CODE

    return raw_events(t).select("event_id", F.regexp_extract("raw_payload", ERROR_CODE, 1).alias("error_code"))


@register("f_truncate_ellipsis", "SELECT doc_id, concat(regexp_replace(substr(text, 1, 200), '^\\s+|\\s+$', '', 'g'), CASE WHEN length(text) > 200 THEN '...' ELSE '' END) AS short FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.truncate_with_dots(F.col("text")).alias("short"))


NARRATIVE_SQL = (
    "concat('transação ', canal, ' no merchant ', merchant, '; descrição ', descricao, '; perfil ', perfil_simulado, '; valor R$ ', "
    "cast(round(valor, 2) AS VARCHAR), '; hora ', lpad(cast(hora AS VARCHAR), 2, '0'), ':15; país ', pais, '; cidade ', cidade, "
    "'; cartão_presente ', cartao_presente, '; risco_device ', risco_device)"
)


@register("f_concat_narrative", f"WITH tx AS ({TX_SQL}) SELECT tx_id, {NARRATIVE_SQL} AS narrativa FROM tx")
def _(t: Tables):
    return transactions(t).select("tx_id", tx.narrative().alias("narrativa"))


@register("narrative_from_row", f"WITH tx AS ({TX_SQL}) SELECT canal, hora, count(*) AS n, CAST(sum(length({NARRATIVE_SQL})) AS BIGINT) AS chars, min({NARRATIVE_SQL}) AS first_text FROM tx GROUP BY canal, hora")
def _(t: Tables):
    told = transactions(t).withColumn("narrativa", tx.narrative())
    return told.groupBy("canal", "hora").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("narrativa")).alias("chars"), F.min("narrativa").alias("first_text")
    )


@register("f_title", f"{CLASSIFIED_SQL} SELECT event_id, concat(upper(severity), ' — ', service, ': ', event_type) AS title FROM cls")
def _(t: Tables):
    return classified(t).select("event_id", rk.title(F.col("severity"), F.col("service"), F.col("event_type")).alias("title"))


@register("f_template", f"WITH raw AS ({RAW_EVENT_SQL}) SELECT event_id, {_prompt_sql('classify')} AS prompt, 'v1' AS version FROM raw")
def _(t: Tables):
    return raw_events(t).select("event_id", mon.prompt("classify").alias("prompt"), F.lit("v1").alias("version"))


@register("f_token_estimate", "SELECT doc_id, CAST(2 * len(list_filter(string_split_regex(text, '\\s+'), lambda w: w <> '')) AS INTEGER) AS tokens FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.token_estimate(F.col("text")).alias("tokens"))


# Every third props text is broken on purpose.
_PROPS = "CASE WHEN event_id % 3 = 0 THEN concat('broken ', props) ELSE props END"


@register("f_json_parse_or_empty", f"SELECT event_id, CASE WHEN json_valid(p) THEN json_extract_string(p, '$.k') END AS k, CASE WHEN json_valid(p) THEN 1 ELSE 0 END AS entries FROM (SELECT event_id, {_PROPS} AS p FROM events)")
def _(t: Tables):
    parsed = t.events.selectExpr("event_id", f"{_PROPS} AS p").withColumn("m", tx.json_map_or_empty(F.col("p")))
    return parsed.select("event_id", F.try_element_at("m", F.lit("k")).alias("k"), F.size("m").alias("entries"))


@register("f_json_emit", "SELECT user_id, concat('[', string_agg('\"' || event_type || '\"', ',' ORDER BY event_type), ']') AS types FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY user_id")
def _(t: Tables):
    per_user = t.events.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"))  # five types at most
    return per_user.select("user_id", F.to_json("types").alias("types"))


@register("f_array_cap", "SELECT doc_id, array_to_string(list_transform(string_split(text, ' ')[1:5], lambda x: substr(x, 1, 200)), '|') AS items FROM documents")
def _(t: Tables):
    capped = tx.cap_items(F.split("text", " ", -1))
    return t.documents.select("doc_id", F.array_join(capped, "|").alias("items"))


@register("f_replace_newlines_preview", "SELECT doc_id, substr(replace(text, chr(10), ' '), 1, 220) AS preview FROM documents")
def _(t: Tables):
    return t.documents.select("doc_id", tx.preview(F.col("text")).alias("preview"))


@register("document_catalogue", "SELECT source, doc_id, length(text) AS chars, concat(substr(replace(text, chr(10), ' '), 1, 110), '...') AS preview FROM documents")
def _(t: Tables):
    return t.documents.select("source", "doc_id", F.length("text").cast("long").alias("chars"), F.concat(tx.preview(F.col("text"), 110), F.lit("...")).alias("preview"))


@register("f_severity_value", f"{CLASSIFIED_SQL} SELECT severity, CASE severity WHEN 'low' THEN 1.0::DOUBLE WHEN 'medium' THEN 2.0 WHEN 'high' THEN 3.0 WHEN 'critical' THEN 4.0 ELSE 1.0 END AS level, count(*) AS n FROM cls GROUP BY ALL")
def _(t: Tables):
    return classified(t).groupBy("severity", nb.severity_value(F.col("severity")).alias("level")).agg(F.count(F.lit(1)).alias("n"))


@register("f_level_from_score", "SELECT event_id, CASE WHEN value >= 80 THEN 'critical' WHEN value >= 60 THEN 'high' WHEN value >= 35 THEN 'medium' ELSE 'low' END AS level FROM events")
def _(t: Tables):
    return t.events.select("event_id", nb.risk_level(F.col("value")).alias("level"))


@register("f_add_hours_ts", "SELECT event_id, strftime(ts - to_minutes(20 - 2 * (user_id % 10)::INT), '%Y-%m-%d %H:%M:%S') AS moved FROM events")
def _(t: Tables):
    shift = -(F.lit(20) - F.col("user_id") % 10 * 2)
    return t.events.select("event_id", F.date_format(tx.shift_minutes(F.col("ts"), shift), "yyyy-MM-dd HH:mm:ss").alias("moved"))


# ---- vectors ----------------------------------------------------------------

_V = "embedding::DOUBLE[]"


@register("f_l2_norm", f"SELECT vec_id, round(sqrt(list_dot_product({_V}, {_V})), 6) AS norm, round(list_sum(list_transform({_V}, lambda x: x / sqrt(list_dot_product({_V}, {_V})))), 6) AS unit_sum FROM embeddings")
def _(t: Tables):
    v = F.col("embedding")
    return t.embeddings.select("vec_id", F.round(vx.norm(v), 6).alias("norm"), F.round(vx.total(vx.normalized(v)), 6).alias("unit_sum"))


_CENTRE = "c AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(x::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"


def centres(t: Tables, vec="embedding", key="label"):
    """Mean vector per label, over all numbers of the vectors, however long they are."""
    dim = t.embeddings.select(F.max(F.size(vec))).first()[0] or 0
    return t.embeddings.groupBy(key).agg(vx.mean_columns(vec, dim).alias("centre"))


@register("f_cosine", f"WITH {_CENTRE} SELECT vec_id, round(list_cosine_similarity({_V}, centre), 6) AS similarity FROM embeddings JOIN c USING (label)")
def _(t: Tables):
    joined = t.embeddings.join(broadcast_if_small(centres(t)), "label")
    return joined.select("vec_id", F.round(vx.cosine(F.col("embedding"), F.col("centre")), 6).alias("similarity"))


@register("f_l2_distance", f"WITH {_CENTRE} SELECT vec_id, round(list_distance({_V}, centre), 6) AS distance FROM embeddings JOIN c USING (label)")
def _(t: Tables):
    joined = t.embeddings.join(broadcast_if_small(centres(t)), "label")
    return joined.select("vec_id", F.round(vx.l2_distance(F.col("embedding"), F.col("centre")), 6).alias("distance"))


def unit_sql(source: str, key: str, text: str, extra: str = "") -> str:
    """SELECT key, extra columns and the unit embedding of a text column."""
    clean = f"regexp_replace(lower({text}), '^\\s+|\\s+$', '', 'g')"
    return (
        f"SELECT * EXCLUDE (r), list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))) AS emb FROM (SELECT {key}{extra}, "
        "list_transform(range(0, 64), lambda i: CAST('0x' || substr(h, 2 * i::INT + 1, 2) AS INTEGER) / 255.0::DOUBLE * 2 - 1) AS r FROM "
        f"(SELECT *, sha256(concat({clean}, '::0')) || sha256(concat({clean}, '::1')) AS h FROM {source}))"
    )


_EMB_SHOW = "round(emb[1], 6) AS first, round(emb[64], 6) AS last, round(list_sum(emb), 6) AS total"


@register("f_sha_embedding", f"SELECT doc_id, {_EMB_SHOW} FROM ({unit_sql('documents', 'doc_id', 'text')})")
def _(t: Tables):
    return _show_embedding(t.wide("documents", "doc_id").select("doc_id", vx.hash_embedding(F.col("text")).alias("e")), "doc_id")


def _show_embedding(df, key):
    e = F.col("e")
    return df.select(key, F.round(e[0], 6).alias("first"), F.round(e[63], 6).alias("last"), F.round(vx.total(e), 6).alias("total"))


@register("embed_hash", f"SELECT conv_id, turn, {_EMB_SHOW} FROM ({unit_sql('conversations', 'conv_id', 'text', ', turn')})")
def _(t: Tables):
    from ..plans.retrieval import embed_text

    e = embed_text(t.conversations, "text")
    return e.select(
        "conv_id", "turn", F.round(F.col("embedding")[0], 6).alias("first"), F.round(F.col("embedding")[63], 6).alias("last"),
        F.round(vx.total(F.col("embedding")), 6).alias("total"),
    )
