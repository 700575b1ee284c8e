"""Chunking, search and reranking over the documents; queries are the benchmark passages."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import chunking, lexical
from ..operators.sizes import broadcast_if_small
from ..plans import retrieval as rt
from ..session import scratch_path
from ..sources import writers
from . import Tables, register
from .scalars import unit_sql

_FIXED = (
    "fx AS (SELECT doc_id, source, unnest(range(0, n))::INTEGER AS chunk_id, text, substr(text, 140 * chunk_id + 1, 160) AS chunk FROM "
    "(SELECT *, CASE WHEN length(text) = 0 THEN 0 ELSE greatest(1, CAST(ceil((length(text) - 160) / 140.0) AS BIGINT) + 1) END AS n FROM documents))"
)


def fixed(t: Tables):
    return chunking.fixed(t.wide("documents", "doc_id"), "doc_id")


@register("chunk_fixed", f"WITH {_FIXED} SELECT doc_id, chunk_id, chunk FROM fx")
def _(t: Tables):
    return fixed(t)


def _recursive_sql(size: int = 320, overlap: int = 50) -> str:
    """The same chunks by list functions: pieces refined break by break, then packed by a reduction that carries the open window."""
    quoted = ["'" + s.replace("\n", "' || chr(10) || '") + "'" for s in chunking.SEPARATORS]
    parts, pieces = [], "SELECT doc_id, [{'p': text, 'b': true}] AS a FROM documents WHERE length(text) > 0"
    for i, sep in enumerate(quoted):
        cut = f"list_filter(list_transform(string_split(x.p, {sep}), lambda t, i: CASE WHEN i = 1 THEN t ELSE {sep} || t END), lambda t: t <> '')"
        parts.append(f"a{i} AS ({pieces})")
        # A piece begins a new run if it or the one before it has to be cut finer.
        pieces = (
            f"SELECT doc_id, flatten(list_transform(a, lambda x: CASE WHEN length(x.p) >= {size} AND contains(x.p, {sep}) THEN list_transform({cut}, lambda t, i: "
            f"{{'p': t, 'b': i = 1 OR length(t) >= {size} OR length({cut}[i - 1]) >= {size}}}) ELSE [x] END)) AS a FROM a{i}"
        )
    state = "{'p': x.p, 'b': x.b, 'w': []::VARCHAR[], 'c': []::VARCHAR[]}"
    parts += [
        f"ax AS ({pieces})",
        f"s0 AS (SELECT doc_id, list_transform(a || [{{'p': '', 'b': true}}], lambda x: {state}) AS a FROM ax)",
        # What is left of the window when a piece does not fit: the longest end within the overlap that leaves room for the piece.
        "s1 AS (SELECT doc_id, list_reduce(a, lambda s, x: CASE "
        "WHEN x.b THEN {'p': '', 'b': false, 'w': [x.p], 'c': CASE WHEN len(s.w) = 0 THEN s.c ELSE s.c || [array_to_string(s.w, '')] END} "
        f"WHEN length(array_to_string(s.w, '')) + length(x.p) <= {size} THEN {{'p': '', 'b': false, 'w': s.w || [x.p], 'c': s.c}} "
        f"ELSE {{'p': '', 'b': false, 'c': s.c || [array_to_string(s.w, '')], 'w': s.w[list_filter(range(1, len(s.w) + 2), "
        f"lambda j: length(array_to_string(s.w[j:], '')) <= least({overlap}, {size} - length(x.p)))[1]:] || [x.p]}} END, "
        "{'p': '', 'b': false, 'w': []::VARCHAR[], 'c': []::VARCHAR[]}) AS s FROM s0)",
        "k AS (SELECT doc_id, list_filter(list_transform(s.c, lambda t: regexp_replace(t, '^\\s+|\\s+$', '', 'g')), lambda t: t <> '') AS c FROM s1)",
    ]
    return f"WITH {', '.join(parts)} SELECT doc_id, CAST(generate_subscripts(c, 1) - 1 AS INTEGER) AS chunk_id, unnest(c) AS chunk FROM k"


@register("chunk_recursive", _recursive_sql())
def recursive(t: Tables):
    return chunking.recursive(t.wide("documents", "doc_id"), "doc_id")


@register("chunk_stats", f"WITH {_FIXED} SELECT 'fixed' AS strategy, count(*) AS chunks, round(avg(length(chunk)), 1) AS mean_chars FROM fx")
def _(t: Tables):
    return chunking.stats(fixed(t).withColumn("strategy", F.lit("fixed")), "strategy")


@register("union_all_frames", f"WITH {_FIXED} SELECT doc_id, 'fixed' AS strategy, count(*) AS pieces FROM fx GROUP BY ALL UNION ALL SELECT doc_id, 'line' AS strategy, len(string_split(text, chr(10))) AS pieces FROM documents")
def _(t: Tables):
    counted = fixed(t).groupBy("doc_id").agg(F.count(F.lit(1)).alias("pieces")).withColumn("strategy", F.lit("fixed"))
    lines = t.documents.select("doc_id", F.size(F.split("text", "\n")).cast("long").alias("pieces"), F.lit("line").alias("strategy"))
    return counted.unionByName(lines)


@register("first_n_per_group", f"WITH {_FIXED} SELECT source, doc_id, chunk_id, replace(chunk, chr(10), ' ') AS passage FROM fx QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id, chunk_id) <= 3")
def _(t: Tables):
    from pyspark.sql import Window

    rows = chunking.fixed(t.wide("documents", "doc_id"), "doc_id", keep=("source",))
    order = Window.partitionBy("source").orderBy("doc_id", "chunk_id")
    # The limit on the rank is pushed below the shuffle: three rows per source leave each task.
    return rows.withColumn("rn", F.row_number().over(order)).filter("rn <= 3").select(
        "source", "doc_id", "chunk_id", F.replace("chunk", F.lit("\n"), F.lit(" ")).alias("passage")
    )


# ---- vector search over chunks ----------------------------------------------

def chunk_store(t: Tables):
    """Embedded fixed chunks, addressed by document and chunk number: built once, stored, then searched."""
    path = scratch_path(t.spark, "chunks")
    writers.overwrite_table(_embedded_chunks(t), path)
    return t.spark.read.parquet(path)


def _embedded_chunks(t: Tables):
    rows = rt.embed_text(fixed(t), "chunk")
    return rows.withColumn("item_id", F.concat_ws("#", F.lpad(F.col("doc_id").cast("string"), 12, "0"), F.lpad(F.col("chunk_id").cast("string"), 6, "0"))).withColumn("source", F.col("doc_id"))


def asked(t: Tables):
    return t.benchmark.select(F.col("item_id").alias("query_id"), F.col("text").alias("query"))


def hits(t: Tables, k: int):
    queries = rt.embed_text(asked(t), "query").select("query_id", "embedding")
    return rt.search_chunks(queries, chunk_store(t), "fixed", k, stored=True)


def _hits_sql(k: int) -> str:
    return (
        f"WITH {_FIXED}, fe AS ({unit_sql('fx', 'doc_id', 'chunk', ', chunk_id, chunk')}), qe AS ({unit_sql('benchmark', 'item_id', 'text', ', text')}), "
        "s AS (SELECT item_id AS query_id, qe.text AS query, doc_id, chunk_id, chunk, round(list_dot_product(qe.emb, fe.emb), 9) AS score FROM qe, fe), "
        f"h AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_id) AS INTEGER) AS rank FROM s QUALIFY rank <= {k})"
    )


@register("vector_search_cosine", _hits_sql(4) + " SELECT 'fixed' AS strategy, query_id, rank, doc_id AS source, chunk_id, round(1 - score, 4) AS distance, substr(replace(chunk, chr(10), ' '), 1, 220) AS passage FROM h")
def _(t: Tables):
    return hits(t, 4).select("strategy", "query_id", "rank", "source", "chunk_id", "distance", "passage")


_RATIO = (
    "list_filter(list_distinct(string_split_regex(lower(query), '\\s+')), lambda w: w <> '')"
)
_RERANK = (
    _hits_sql(6)
    + f", r AS (SELECT *, len(list_intersect({_RATIO}, string_split_regex(lower(chunk), '\\s+'))) / len({_RATIO})::DOUBLE AS rs FROM h), "
    "rr AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY rs DESC, doc_id, chunk_id) AS INTEGER) AS new_rank FROM r QUALIFY new_rank <= {})"
)


def reranked(t: Tables, keep: int):
    found = hits(t, rt.RERANK_FETCH).join(broadcast_if_small(asked(t), lexical.BLOCK_QUERIES), "query_id")
    return lexical.rerank(found, lexical.shared_word_ratio(F.col("query"), F.col("chunk")), keep)


@register("rerank", _RERANK.format(6) + " SELECT query_id, new_rank, rank, doc_id AS source, chunk_id, round(rs, 4) AS rerank_score FROM rr")
def _(t: Tables):
    return reranked(t, rt.RERANK_FETCH).select("query_id", "new_rank", "rank", "source", "chunk_id", F.round("rerank_score", 4).alias("rerank_score"))


@register("rerank_topn", _RERANK.format(3) + " SELECT query_id, new_rank, doc_id AS source, chunk_id FROM rr")
def _(t: Tables):
    return reranked(t, 3).select("query_id", "new_rank", "source", "chunk_id")


@register(
    "build_context",
    _RERANK.format(3) + " SELECT query_id, string_agg(concat('[Fonte: ', doc_id, ' | chunk ', chunk_id, ']', chr(10), substr(replace(chunk, chr(10), ' '), 1, 220)), chr(10) || chr(10) ORDER BY new_rank) AS context FROM rr GROUP BY query_id",
)
def _(t: Tables):
    return rt.build_context(reranked(t, 3))


@register("index_documents", f"WITH {_FIXED} SELECT count(*) AS indexed, CAST(sum(length(chunk)) AS BIGINT) AS chars, max(1) AS version FROM fx")
def _(t: Tables):
    store = rt.index_documents(t.wide("documents", "doc_id").select("doc_id", "text"), "doc_id")
    return store.agg(F.count(F.lit(1)).alias("indexed"), F.sum(F.length("content")).alias("chars"), F.max("version").alias("version"))


_W = "list_filter(string_split_regex(lower(text), '\\s+'), lambda w: w <> '')"
_BM25 = (
    f"WITH d AS MATERIALIZED (SELECT doc_id, {_W} AS ws FROM documents), "
    "st AS MATERIALIZED (SELECT count(*) AS n, avg(len(ws)) AS mean FROM d), "
    f"qt AS MATERIALIZED (SELECT item_id AS query_id, unnest(list_distinct({_W})) AS w FROM benchmark), "
    "tok AS (SELECT doc_id, len(ws) AS dl, unnest(ws) AS w FROM d), "
    "tf AS MATERIALIZED (SELECT doc_id, w, dl, count(*) AS tf FROM tok WHERE w IN (SELECT w FROM qt) GROUP BY ALL), "
    "df AS MATERIALIZED (SELECT w, count(*) AS df FROM tf GROUP BY w), "
    "wt AS MATERIALIZED (SELECT doc_id, tf.w, ln(1 + (n - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.5::DOUBLE / (tf + 1.5::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * dl / mean)) AS x "
    "FROM tf JOIN df USING (w), st), "
    "s AS (SELECT query_id, doc_id AS item_id, round(sum(x), 9) AS score FROM qt JOIN wt USING (w) GROUP BY query_id, doc_id), "
    "h AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, item_id) AS INTEGER) AS rank FROM s QUALIFY rank <= 5)"
)


@register("search_bm25", f"{_BM25} SELECT query_id, item_id, rank, round(score, 6) AS score FROM h")
def _(t: Tables):
    found = lexical.bm25(t.wide("documents", "doc_id"), t.benchmark, 5, query_id="item_id")
    return found.select("query_id", "item_id", "rank", F.round("score", 6).alias("score"))
