"""Indexing and search: chunk, embed, upsert, search, rerank, context."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import preview, strip_whitespace
from ..functions.vectors import hash_bytes, hash_embedding
from ..operators import chunking
from ..operators.knn import top_k, upsert
from ..operators.metric_index import settled
from ..operators.sizes import join_hot

# Search width, and the text shown when nothing is found.
SEARCH_K, RERANK_FETCH, RERANK_KEEP, CONTEXT_K, CONTEXT_CHARS = 4, 6, 3, 3, 500
NOTHING_FOUND = "Nenhum documento relevante encontrado."


def embed_text(df: DataFrame, text: str, dim: int = 64, packed: bool = False, lowered: bool = False) -> DataFrame:
    """Offline embedding, JVM only; ``packed`` vectors are the bytes they are made of, for operators that look at blocks of vectors (``lowered``: of a text in lower case)."""
    if packed:
        cleaned = df.withColumn("_clean", strip_whitespace(F.col(text) if lowered else F.lower(text)))
        return cleaned.withColumn("embedding", hash_bytes(F.col("_clean"), dim)).drop("_clean")
    return df.withColumn("embedding", hash_embedding(F.col(text), dim))


def embed_with(df: DataFrame, text: str, load_model: Callable[[], Callable[[list[str]], list]]) -> DataFrame:
    """Embedding by a user model: ``load_model`` runs once per task, its result embeds lists of texts."""
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = load_model()
        for texts in batches:
            yield pd.Series([list(map(float, v)) for v in model(texts.tolist())])

    udf = F.pandas_udf(run, "array<float>", F.PandasUDFType.SCALAR_ITER)
    return df.withColumn("embedding", udf(F.col(text)))


def index_documents(docs: DataFrame, key: str, store: DataFrame | None = None, version: int = 1) -> DataFrame:
    """Chunk, embed and upsert; returns the collection (doc_id, embedding, content, version)."""
    chunks = chunking.fixed(docs, key)
    rows = embed_text(chunks, "chunk").select(
        F.concat_ws("#", F.col(key).cast("string"), F.col("chunk_id").cast("string")).alias("doc_id"),
        "embedding", F.col("chunk").alias("content"), F.lit(version).alias("version"),
    )
    return rows if store is None else upsert(store, rows)


def search_chunks(queries: DataFrame, chunks: DataFrame, strategy: str, k: int = SEARCH_K, stored: bool = False, **options) -> DataFrame:
    """Nearest chunks by cosine distance with rank, distance (4 decimals) and preview.

    ``queries``: (query_id, embedding); ``chunks``: (item_id, source, chunk_id, chunk, embedding). Chunks that are a
    table (``stored``) are read from there and not written again.
    """
    if stored:
        hits = top_k(settled(queries.select("query_id", "embedding"), "queries"), chunks, k, metric="cosine", **options)
    else:
        hits = top_k(queries, chunks, k, metric="cosine", settle=True, **options)
    text = chunks.select("item_id", "source", "chunk_id", "chunk")
    # The hits are k rows per query, so this join reads the chunks once and keeps few rows.
    return hits.join(text, "item_id").select(
        F.lit(strategy).alias("strategy"), "query_id", "item_id", "rank", "source", "chunk_id",
        F.round(1 - F.col("score"), 4).alias("distance"), preview(F.col("chunk")).alias("passage"), "chunk",
    )


def ordered_text(parts: Column, rank: Column, separator: str) -> Column:
    """Texts of a group joined in rank order (for groups of a few rows)."""
    ordered = F.array_sort(F.collect_list(F.struct(rank.alias("rank"), parts.alias("text"))))
    return F.array_join(F.transform(ordered, lambda x: x["text"]), separator)


def build_context(passages: DataFrame, rank: str = "new_rank") -> DataFrame:
    """Passages of a query as one text with their sources."""
    block = F.concat(
        F.lit("[Fonte: "), F.col("source").cast("string"), F.lit(" | chunk "), F.col("chunk_id").cast("string"),
        F.lit("]\n"), F.col("passage"),
    )
    return passages.groupBy("query_id").agg(ordered_text(block, F.col(rank), "\n\n").alias("context"))


def retrieve_context(queries: DataFrame, docs: DataFrame, k: int = CONTEXT_K, chars: int = CONTEXT_CHARS, **options) -> DataFrame:
    """Formatted context per query; a fixed text where nothing is found.

    ``queries``: (query_id, query); ``docs``: (item_id, content, type, source). Equal
    query texts have equal answers, so each distinct text is searched once.
    """
    key = F.sha2(F.coalesce("query", F.lit("")), 256)
    # Queries are often computed from events: they are settled once, as are the embeddings of both sides.
    asked = settled(queries.select("query_id", "query", key.alias("_q")), "asked")
    distinct = embed_text(asked.groupBy("_q").agg(F.first("query").alias("query")), "query").select(F.col("_q").alias("query_id"), "embedding")
    hits = top_k(distinct, embed_text(docs, "content").select("item_id", "embedding"), k, settle=True, **options)
    cut = F.concat(F.substring("content", 1, chars), F.when(F.length("content") > chars, "...").otherwise(""))
    block = F.concat(
        F.lit("["), F.col("rank").cast("string"), F.lit("] ("), F.coalesce("type", F.lit("document")), F.lit(") "),
        F.col("item_id").cast("string"), F.lit(" (score: "), F.format_string("%.3f", "score"), F.lit(")\nFonte: "),
        F.coalesce("source", F.lit("unknown")), F.lit("\n"), cut, F.lit("\n"),
    )
    texts = hits.join(docs, "item_id").select(F.col("query_id").alias("_q"), "rank", block.alias("block"))
    context = texts.groupBy("_q").agg(ordered_text(F.col("block"), F.col("rank"), "\n---\n").alias("context"))
    return join_hot(asked, context, "_q").select(
        "query_id", F.coalesce("context", F.lit(NOTHING_FOUND)).alias("context")
    )
