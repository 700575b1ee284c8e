"""Vector queries. Query vectors are the mean vectors of the labels, or every vector in turn."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from ..functions import vectors as vx
from ..operators import knn
from ..operators.classify import OFFLINE_SEVERITY, classify
from ..operators.knn_blocks import TIE_DIGITS
from ..operators.scorer import score_with
from ..plans import retrieval as rt
from . import Tables, register
from .fixtures import RAW_EVENT_SQL, raw_events
from .monitoring import kw, _CLS_COLS, _MIXED, EXTRACTED_SQL, extracted, mon
from .scalars import _CENTRE, _V, centres, unit_sql


def _anchors(t: Tables):
    return centres(t).select(F.col("label").alias("query_id"), F.col("centre").alias("embedding"))


def _items(t: Tables):
    return t.embeddings.select(F.col("vec_id").alias("item_id"), "embedding")


_ANCHOR_HITS = (
    f"WITH {_CENTRE}, s AS (SELECT c.label AS query_id, vec_id AS item_id, round({{}}, 9) AS score FROM c, embeddings), "
    "h AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM s)"
)
_IP = f"list_dot_product(centre, {_V})"
_COS = f"list_cosine_similarity(centre, {_V})"


@register("vector_topk", _ANCHOR_HITS.format(_IP) + " SELECT query_id, item_id, rank, round(score, 6) AS score FROM h WHERE rank <= 5")
def _(t: Tables):
    hits = knn.top_k(_anchors(t), _items(t), 5)
    return hits.select("query_id", "item_id", "rank", F.round("score", 6).alias("score"))


@register("topk_rank", _ANCHOR_HITS.format(_COS) + " SELECT query_id, item_id, rank FROM h WHERE rank <= 10")
def _(t: Tables):
    return knn.top_k(_anchors(t), _items(t), 10, metric="cosine").select("query_id", "item_id", "rank")


def _matrix(t: Tables, metric: str):
    """Every vector against every anchor."""
    hits = knn.similarities(t.embeddings, _anchors(t).withColumnRenamed("query_id", "item_id"), query_id="vec_id", metric=metric)
    return hits.select(F.col("query_id").alias("vec_id"), F.col("item_id").alias("label"), F.round(F.round("score", TIE_DIGITS), 6).alias("score"))


@register("cross_similarity_join", _ANCHOR_HITS.format(_IP) + " SELECT item_id AS vec_id, query_id AS label, round(score, 6) AS score FROM h")
def _(t: Tables):
    return _matrix(t, "ip")


@register("similarity_matrix", _ANCHOR_HITS.format(_COS) + " SELECT item_id AS vec_id, query_id AS label, round(score, 6) AS score FROM h")
def _(t: Tables):
    return _matrix(t, "cosine")


def _neighbours_sql(name: str, vec: str, k: int, where: str = "") -> str:
    return (
        f"{name} AS (SELECT query_id, item_id, score, rank FROM (SELECT a.vec_id AS query_id, b.vec_id AS item_id, "
        f"round(list_cosine_similarity(a.{vec}, b.{vec}), 9) AS score, CAST(row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_cosine_similarity(a.{vec}, b.{vec}), 9) DESC, b.vec_id) AS INTEGER) AS rank "
        f"FROM e a JOIN e b ON a.vec_id <> b.vec_id) WHERE rank <= {k})"
    )


_E = (
    "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, "
    "list_transform(range(0, 8), lambda j: list_sum(list_transform(embedding::DOUBLE[], lambda x, i: CASE WHEN bit_count(i::INTEGER & (37 * j + 11)::INTEGER) % 2 = 0 THEN x ELSE -x END))) AS w FROM embeddings)"
)


def neighbours(t: Tables, k: int, vec=None, **options):
    rows = t.embeddings.select("vec_id", (vec if vec is not None else F.col("embedding")).alias("embedding"))
    return knn.top_k(rows, rows, k, query_id="vec_id", item_id="vec_id", metric="cosine", skip_self=True, settle=vec is not None, **options)


@register("argsort_neighbors", f"{_E}, {_neighbours_sql('n', 'v', 3)} SELECT query_id, item_id, rank FROM n")
def _(t: Tables):
    return neighbours(t, 3).select("query_id", "item_id", "rank")


@register("neighbors_by_index", f"{_E}, {_neighbours_sql('n', 'v', 5)} SELECT query_id, item_id, rank, round(score, 6) AS score FROM n")
def _(t: Tables):
    # As for tables of which no side fits a task: a bound of one byte, blocks of a few hundred rows.
    found = neighbours(t, 5, bound=1, block_rows=256)
    return found.select("query_id", "item_id", "rank", F.round("score", 6).alias("score"))


@register("neighbors_graph", f"{_E}, {_neighbours_sql('n', 'v', 5)} SELECT query_id AS source, item_id AS target, rank, round(score, 6) AS weight, a.label = b.label AS same_label FROM n JOIN e a ON a.vec_id = query_id JOIN e b ON b.vec_id = item_id")
def _(t: Tables):
    labels = t.embeddings.select("vec_id", "label")
    graph = neighbours(t, 5)
    a = labels.select(F.col("vec_id").alias("query_id"), F.col("label").alias("_a"))
    b = labels.select(F.col("vec_id").alias("item_id"), F.col("label").alias("_b"))
    return graph.join(a, "query_id").join(b, "item_id").select(
        F.col("query_id").alias("source"), F.col("item_id").alias("target"), "rank",
        F.round("score", 6).alias("weight"), (F.col("_a") == F.col("_b")).alias("same_label"),
    )


def projected():
    """Eight sums of the whole vector stand for it."""
    return vx.sign_projection(F.col("embedding"), 8)


_TWO = f"{_E}, {_neighbours_sql('n', 'v', 3)}, {_neighbours_sql('r', 'w', 3)}"


@register("mean_topk_overlap", f"{_TWO}, o AS (SELECT n.query_id, count(r.item_id) / 3.0::DOUBLE AS share FROM n LEFT JOIN r ON r.query_id = n.query_id AND r.item_id = n.item_id GROUP BY 1) SELECT round(avg(share), 4) AS overlap FROM o")
def _(t: Tables):
    return knn.mean_overlap(neighbours(t, 3), neighbours(t, 3, projected()), 3)


@register("array_set_intersection", f"{_TWO} SELECT n.query_id, CAST(count(r.item_id) AS INTEGER) AS common FROM n LEFT JOIN r ON r.query_id = n.query_id AND r.item_id = n.item_id GROUP BY 1")
def _(t: Tables):
    def lists(df, name):
        return df.groupBy("query_id").agg(F.collect_list("item_id").alias(name))  # three ids per query

    both = lists(neighbours(t, 3), "a").join(lists(neighbours(t, 3, projected()), "b"), "query_id")
    return both.select("query_id", F.size(F.array_intersect("a", "b")).alias("common"))


@register("pair_scores_sorted", f"{_E} SELECT a.vec_id AS id_a, b.vec_id AS id_b, round(list_cosine_similarity(a.v, b.v), 4) AS similarity FROM e a JOIN e b ON b.vec_id = a.vec_id + 1")
def _(t: Tables):
    pairs = t.embeddings.select(F.col("vec_id").alias("id_a"), (F.col("vec_id") + 1).alias("id_b"))
    return knn.pair_scores(pairs, t.embeddings, "vec_id")


@register(
    "vector_upsert",
    "WITH a AS (SELECT vec_id AS doc_id, embedding, 1 AS version FROM embeddings UNION ALL "
    "SELECT vec_id + 3 * label, list_reverse(embedding), 2 + label FROM embeddings WHERE label IN (2, 7)) "
    "SELECT doc_id, max(version) AS version, round(arg_max(embedding[1], version)::DOUBLE, 6) AS first, round(arg_max(list_sum(list_transform(embedding::DOUBLE[], lambda x, i: x * i)), version), 4) AS whole FROM (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY version DESC) = 1) GROUP BY doc_id",
)
def _(t: Tables):
    current = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding", F.lit(1).alias("version"))
    changes = t.embeddings.filter(F.col("label").isin(2, 7)).select(
        (F.col("vec_id") + 3 * F.col("label")).alias("doc_id"), F.reverse("embedding").alias("embedding"),
        (F.lit(2) + F.col("label")).alias("version"),
    )
    merged = knn.upsert(current, changes)
    weighted = vx.total(F.transform(vx.as_double(F.col("embedding")), lambda x, i: x * (i + 1)))
    return merged.select("doc_id", "version", F.round(F.col("embedding")[0].cast("double"), 6).alias("first"), F.round(weighted, 4).alias("whole"))


# ---- retrieval for events ---------------------------------------------------

_CTX = (
    f"{EXTRACTED_SQL}, asked AS (SELECT event_id AS query_id, concat(service, ' ', event_type, ' ', severity, ' ', extracted_summary) AS query FROM ext), "
    f"dq AS (SELECT DISTINCT query FROM asked), qe AS ({unit_sql('dq', 'query', 'query')}), de AS ({unit_sql('documents', 'doc_id', 'text', ', text, source, lang')}), "
    "s AS (SELECT query, doc_id, text, source, lang, round(list_dot_product(qe.emb, de.emb), 9) AS score FROM qe, de), "
    "h AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, doc_id) AS rank FROM s QUALIFY rank <= 3), "
    "b AS (SELECT query, string_agg(concat('[', rank, '] (', lang, ') ', doc_id, ' (score: ', printf('%.3f', score), ')', chr(10), 'Fonte: ', source, chr(10), "
    "substr(text, 1, 500), CASE WHEN length(text) > 500 THEN '...' ELSE '' END, chr(10)), chr(10) || '---' || chr(10) ORDER BY rank) AS context FROM h GROUP BY query)"
)


@register("retrieve_context", f"{_CTX} SELECT query_id, context FROM asked JOIN b USING (query)")
def _(t: Tables):
    asked = extracted(t).select(F.col("event_id").alias("query_id"), mon.retrieval_query().alias("query"))
    docs = t.wide("documents", "doc_id").select(F.col("doc_id").alias("item_id"), F.col("text").alias("content"), F.col("lang").alias("type"), "source")
    return rt.retrieve_context(asked, docs)


# ---- user functions ---------------------------------------------------------

def _toy_model():
    """A stand-in for a user model: text length and number of words."""
    return lambda texts: [[float(len(x)), float(len([w for w in x.replace("\n", " ").split(" ") if w]))] for x in texts]


def _letter_model():
    """Another one: how often each vowel stands in a text."""
    return lambda texts: [[float(x.count(v)) for v in "aeiou"] for x in texts]


@register(
    "embed_model",
    "SELECT conv_id, turn, length(text)::DOUBLE AS dim_0, len(list_filter(string_split(replace(text, chr(10), ' '), ' '), lambda w: w <> ''))::DOUBLE AS dim_1 FROM conversations",
)
def _(t: Tables):
    e = rt.embed_with(t.conversations, "text", _toy_model)
    return e.select("conv_id", "turn", *[F.col("embedding")[i].cast("double").alias(f"dim_{i}") for i in range(2)])


@register("udf_embedder", "SELECT item_id, " + ", ".join(f"(length(text) - length(replace(text, '{v}', '')))::DOUBLE AS {v}" for v in "aeiou") + " FROM benchmark")
def _(t: Tables):
    e = rt.embed_with(t.benchmark, "text", _letter_model)
    return e.select("item_id", *[F.col("embedding")[i].cast("double").alias(v) for i, v in enumerate("aeiou")])


@register("udf_vector_store", _ANCHOR_HITS.format(_IP) + " SELECT query_id, item_id, rank FROM h WHERE rank <= 3")
def _(t: Tables):
    # A store is a table: upsert into it, then search it.
    rows = t.embeddings.select(F.col("vec_id").alias("doc_id"), "embedding", F.lit(1).alias("version"))
    store = knn.upsert(rows, rows.withColumn("version", F.lit(2)))
    return knn.top_k(_anchors(t), store, 3, item_id="doc_id").select("query_id", "item_id", "rank")


def _strict_scorer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A stand-in for a user's scorer that refuses long payloads."""
    from ..operators.classify import OFFLINE_SEVERITY, OFFLINE_TYPE

    if (pdf["raw_payload"].str.len() * 2 + 1 > 500).any():
        raise ValueError("payload too long")

    def first(text, rules, default):
        return next((v for k, v in rules if k in text), default)

    low = pdf["raw_payload"].str.lower()
    return pd.DataFrame({
        "event_type": [first(x, OFFLINE_TYPE, "log") for x in low], "severity": [first(x, OFFLINE_SEVERITY, "low") for x in low],
        "confidence": 0.85, "reasoning": pdf["raw_payload"] + " " + pdf["raw_payload"],
    })


_ANSWER = "event_type string,severity string,confidence double,reasoning string"


@register("udf_scorer", f"{_MIXED} SELECT {', '.join(_CLS_COLS)} FROM cls")
def _(t: Tables):
    scored = score_with(raw_events(t), _strict_scorer, _ANSWER, attempts=1)
    return classify(scored, F.col("answer")).select(*_CLS_COLS)


def _flaky_scorer():
    """A stand-in for a service that refuses every batch the first time it is asked."""
    asked: set = set()

    def score(pdf: pd.DataFrame) -> pd.DataFrame:
        batch = (len(pdf), *pdf["event_id"].iloc[[0, -1]])
        if batch not in asked:
            asked.add(batch)
            raise ConnectionError("try again")
        return _strict_scorer(pdf.assign(raw_payload=pdf["raw_payload"].str.slice(0, 100)))

    return score


@register(
    "udf_retry",
    f"WITH raw AS ({RAW_EVENT_SQL}), short AS (SELECT event_id, substr(raw_payload, 1, 100) AS p FROM raw) SELECT event_id, 'llm' AS classification_method, "
    f"{kw('p', OFFLINE_SEVERITY, 'low')} AS severity FROM short",
)
def _(t: Tables):
    # Without a second attempt all answers would be lost, and the keyword lists would stand in.
    scored = score_with(raw_events(t), _flaky_scorer(), _ANSWER, attempts=2, wait=0.0)
    return classify(scored, F.col("answer")).select("event_id", "classification_method", "severity")
