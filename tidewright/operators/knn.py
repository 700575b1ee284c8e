"""Exact nearest neighbours without a cross join.

Scores are computed block against block inside tasks, and only the best k per
query leave a task. Which side travels depends on checked sizes:

* collection fits the bound: it is broadcast, queries are answered where they
  lie, nothing is shuffled;
* queries fit the bound: they are broadcast, every partition of the collection
  keeps its best k per query, and these are merged;
* neither fits: a metric index of the collection tells which of its blocks can
  hold a query's neighbours, and queries travel to those (``metric_index``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .knn_blocks import QUERY_ROWS, BestK, Points, compare, id_array, matrix, score_block
from .metric_index import MetricIndex, settled

BROADCAST_BYTES = 64 << 20
BLOCK_ROWS = 8192


def _columns(df: DataFrame, key: str, vec: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.col(vec).cast("array<double>").alias("vec"))


def _batch(best: BestK, types: tuple[pa.DataType, pa.DataType]) -> Iterator[pa.RecordBatch]:
    rows, ids, scores, ranks = best.result()
    if len(rows):
        yield pa.RecordBatch.from_arrays(
            [pa.array(best.query_ids[rows].tolist(), types[0]), pa.array(ids.tolist(), types[1]), pa.array(scores, pa.float64()),
             pa.array(ranks, pa.int32())], names=["query_id", "item_id", "score", "rank"],
        )


def _in_order(ids: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(ids, kind="stable")
    return ids[order], m[order]


def _steps(n: int, width: int) -> Iterator[tuple[int, int]]:
    """Cuts of n queries such that a matrix of scores has some million numbers."""
    step = max(1, (4 << 20) // max(1, width))
    return ((at, min(n, at + step)) for at in range(0, n, step))


def top_k(
    queries: DataFrame, items: DataFrame, k: int, *, query_id: str = "query_id", item_id: str = "item_id",
    vec: str = "embedding", metric: str = "ip", skip_self: bool = False, bound: int = BROADCAST_BYTES,
    block_rows: int = BLOCK_ROWS, settle: bool = False,
) -> DataFrame:
    """Best k items per query as (query_id, item_id, score, rank); fewer when the collection is smaller.

    Ids must be unique on both sides. Rows without a vector, or with a null in it, find nothing and are not
    found; vectors of different lengths are an error. Sizes are taken before rows: ``settle`` frames whose vectors
    are costly to compute, so that this happens once.
    """
    spark = queries.sparkSession
    q, c = _columns(queries, query_id, vec), _columns(items, item_id, vec)
    kinds = q.schema["key"].dataType.simpleString(), c.schema["key"].dataType.simpleString()
    schema = f"query_id {kinds[0]}, item_id {kinds[1]}, score double, rank int"
    types = tuple(pa.int32() if t == "int" else pa.int64() if t == "bigint" else pa.string() for t in kinds)
    if settle:
        q, c = settled(q, "queries"), settled(c, "items")
    q, c = (df.filter(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull())) for df in (q, c))
    n_q, n_c = (df.agg(F.count(F.lit(1)).alias("rows"), F.min(F.size("vec")).alias("least"), F.max(F.size("vec")).alias("most")).first() for df in (q, c))
    if not n_q.rows or not n_c.rows:
        return spark.createDataFrame([], schema)
    if len({n_q.least, n_q.most, n_c.least, n_c.most}) > 1:
        raise ValueError("vectors of different lengths can't be compared")
    max_rows = max(1, bound // (8 * max(1, n_c.most)))
    if n_c.rows <= max_rows:
        held = c.toArrow()
        shared = spark.sparkContext.broadcast(_in_order(id_array(held["key"]), matrix(held["vec"])))

        def per_query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ids, points = shared.value[0], Points(shared.value[1], metric)
            for b in batches:
                if not b.num_rows:
                    continue
                keys, m = id_array(b.column("key")), matrix(b.column("vec"))
                for at in range(0, len(m), QUERY_ROWS):
                    best = BestK(keys[at : at + QUERY_ROWS], k, skip_self)
                    compare(best, np.arange(len(best.query_ids)), Points(m[at : at + QUERY_ROWS], metric), ids, points)
                    yield from _batch(best, types)

        return q.mapInArrow(per_query, schema)  # every query is complete where it lies
    if n_q.rows <= max_rows:
        held = q.toArrow()
        shared = spark.sparkContext.broadcast((id_array(held["key"]), matrix(held["vec"])))

        def per_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, points = shared.value[0], Points(shared.value[1], metric)
            best = BestK(keys, k, skip_self)
            for b in batches:
                if not b.num_rows:
                    continue
                ids, m = _in_order(id_array(b.column("key")), matrix(b.column("vec")))
                compare(best, np.arange(len(keys)), points, ids, Points(m, metric))
            yield from _batch(best, types)

        found = c.mapInArrow(per_partition, schema)
    else:
        found = MetricIndex(c, metric, block_rows).search(q, k, skip_self)
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return found.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)


def similarities(queries: DataFrame, items: DataFrame, *, query_id: str = "query_id", item_id: str = "item_id", vec: str = "embedding", metric: str = "ip") -> DataFrame:
    """Every query with every item of a small collection, as (query_id, item_id, score): scored where the queries lie, nothing ranked.

    The collection must fit ``BROADCAST_BYTES``; this is checked.
    """
    q, c = _columns(queries, query_id, vec), settled(_columns(items, item_id, vec), "items")
    q, c = (df.filter(F.col("vec").isNotNull() & ~F.exists("vec", lambda x: x.isNull())) for df in (q, c))
    size = c.agg(F.count(F.lit(1)).alias("rows"), F.max(F.size("vec")).alias("most")).first()
    if size.rows * 8 * (size.most or 0) > BROADCAST_BYTES:
        raise ValueError("the collection is too large for a matrix of all scores; ask for the best k")
    held = c.toArrow()
    shared = queries.sparkSession.sparkContext.broadcast((held["key"].combine_chunks(), matrix(held["vec"])))
    kinds = q.schema["key"].dataType.simpleString(), c.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, mat = shared.value
        for b in batches:
            if not b.num_rows or not len(ids):
                continue
            m = matrix(b.column("vec"))
            for at, end in _steps(len(m), 64 * len(ids)):
                scores = score_block(m[at:end], mat, metric)
                rows, cols = np.divmod(np.arange(scores.size), len(ids))
                yield pa.RecordBatch.from_arrays(
                    [b.column("key").take(pa.array(rows + at)), ids.take(pa.array(cols)), pa.array(scores.ravel())], names=["query_id", "item_id", "score"]
                )

    return q.mapInArrow(run, f"query_id {kinds[0]}, item_id {kinds[1]}, score double")


def upsert(current: DataFrame, changes: DataFrame, key: str = "doc_id", version: str = "version") -> DataFrame:
    """Insert or replace by key, highest version wins. Partial aggregation keeps one row per key and partition."""
    rest = [c for c in current.columns if c != key]
    both = current.unionByName(changes)
    newest = both.groupBy(key).agg(F.max_by(F.struct(*rest), version).alias("_row"))
    return newest.select(key, "_row.*")


def mean_overlap(left: DataFrame, right: DataFrame, k: int) -> DataFrame:
    """Mean share of common neighbours between two (query_id, item_id) sets of size k."""
    def lists(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("query_id").agg(F.collect_list("item_id").alias(name))  # k items per query

    both = lists(left, "a").join(lists(right, "b"), "query_id")
    share = F.size(F.array_intersect("a", "b")) / F.lit(k)
    return both.agg(F.round(F.avg(share), 4).alias("overlap"))


def pair_scores(pairs: DataFrame, vectors: DataFrame, key: str, vec: str = "embedding") -> DataFrame:
    """Cosine of listed pairs (id_a, id_b), 4 decimals, best first."""
    from ..functions.vectors import cosine

    a = vectors.select(F.col(key).alias("id_a"), F.col(vec).alias("_a"))
    b = vectors.select(F.col(key).alias("id_b"), F.col(vec).alias("_b"))
    scored = pairs.join(a, "id_a").join(b, "id_b").withColumn("similarity", F.round(cosine(F.col("_a"), F.col("_b")), 4))
    return scored.drop("_a", "_b").orderBy(F.col("similarity").desc(), "id_a", "id_b")
