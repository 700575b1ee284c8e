"""Word-based ranking: a stored inverted index, BM25 search over it, and reranking of candidates."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..functions.text import words
from ..session import scratch_path, task_slots
from .knn_blocks import BestK, id_array

K1, B = 1.5, 0.75
SLICE_DOCS, BLOCK_QUERIES = 50_000, 4096
CELLS = 4 << 20  # scores a task holds at once
_BLANKS = re.compile(r"[ \t\n\x0b\f\r]+")


@dataclass(frozen=True)
class TextIndex:
    """Postings (slice, word, item_id, tf, length), document frequencies (word, df), and two numbers of the whole collection.

    Documents are dealt to slices by a hash of their id, so the postings of a frequent word lie in all slices, a share in each.
    Within a slice they are sorted by word: a search reads the parts of the files that hold its words.
    """

    path: str
    slices: int
    n_docs: int
    mean_length: float

    def postings(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/postings")

    def frequencies(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.path}/words")


def build_index(docs: DataFrame, path: str, *, doc_id: str = "doc_id", doc_text: str = "text", slices: int | None = None) -> TextIndex:
    """Write the index of ``docs`` below ``path``. Texts are read once; counting words needs no shuffle, only their slices do.

    A null text counts as a document without words. Ids must be unique.
    """
    spark = docs.sparkSession
    n = slices or 0
    if not n:
        n = max(task_slots(spark), -(-docs.count() // SLICE_DOCS))
    rows = docs.select(
        F.pmod(F.xxhash64(doc_id), F.lit(n)).cast("int").alias("slice"), F.col(doc_id).alias("item_id"), F.lower(doc_text).alias("text")
    )
    schema = StructType().add("slice", "integer").add("word", "string").add("item_id", rows.schema["item_id"].dataType).add("tf", "integer").add("length", "integer")
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):  # a batch of long texts becomes many postings
                part = b.slice(at, 256)
                word, tf, row, length = [], [], [], []
                for i, text in enumerate(part.column(2).to_pylist()):
                    counts = Counter(w for w in _BLANKS.split(text or "") if w)
                    word += counts.keys()
                    tf += counts.values()
                    row += [i] * len(counts)
                    length += [sum(counts.values())] * len(counts)
                    if text is not None and not counts:  # kept for the numbers of the collection, under no word
                        word.append(None), tf.append(0), row.append(i), length.append(0)
                take = pa.array(row, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), pa.array(word, pa.string()), part.column(1).take(take), pa.array(tf, pa.int32()), pa.array(length, pa.int32())],
                    schema=arrow,
                )

    counted = rows.mapInArrow(count, schema)
    counted.repartition(n, "slice").sortWithinPartitions("slice", "word", "item_id").write.parquet(f"{path}/postings")
    stored = spark.read.parquet(f"{path}/postings")
    stored.where("word IS NOT NULL").groupBy("word").agg(F.count(F.lit(1)).alias("df")).write.parquet(f"{path}/words")
    lengths = stored.groupBy("item_id").agg(F.max("length").alias("length")).agg(F.avg("length").alias("mean")).first()
    return TextIndex(path, n, docs.count(), lengths["mean"] or 0.0)


def search(
    spark: SparkSession, index: TextIndex, queries: DataFrame, k: int = 5, *, query_id: str = "query_id", query_text: str = "text",
    block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """Best k documents per query by BM25, as (query_id, item_id, score, rank); documents without a common word are no hits.

    Queries are dealt to blocks. A slice of the documents meets a block in one task, with the postings of the block's words
    alone, and k rows per query leave it. Documents are not read, however many queries there are.
    """
    terms = queries.select(F.col(query_id).alias("query_id"), F.explode(F.array_distinct(words(F.lower(query_text)))).alias("word"))
    blocks = max(1, -(-queries.count() // block_queries))
    block = F.pmod(F.xxhash64("query_id", F.lit(3)), F.lit(blocks)).cast("int")
    idf = F.log(1 + (F.lit(index.n_docs) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    asked = terms.withColumn("block", block).join(index.frequencies(spark), "word").select("block", "query_id", "word", idf.alias("idf"))
    wanted = asked.select(F.col("block").alias("part"), F.col("word").alias("asked")).distinct()
    postings = index.postings(spark).where("word IS NOT NULL")
    left = postings.join(wanted, F.col("word") == F.col("asked")).select("slice", "part", "word", "item_id", "tf", "length")
    every = F.explode(F.sequence(F.lit(0), F.lit(index.slices - 1))).alias("slice")
    right = asked.select(every, "block", "query_id", "word", "idf")
    kinds = left.schema["item_id"].dataType, right.schema["query_id"].dataType
    schema = StructType().add("query_id", kinds[1]).add("item_id", kinds[0]).add("score", "double")
    arrow, mean = to_arrow_schema(schema), index.mean_length or 1.0

    def run(found: pa.Table, asking: pa.Table) -> pa.Table:
        if not found.num_rows or not asking.num_rows:
            return arrow.empty_table()
        qids, q_at = np.unique(id_array(asking["query_id"]), return_inverse=True)
        items, d_at = np.unique(id_array(found["item_id"]), return_inverse=True)
        names, w_of_query = np.unique(id_array(asking["word"]), return_inverse=True)
        w_of_doc = np.searchsorted(names, id_array(found["word"]))
        idf_of = np.zeros(len(names))
        idf_of[w_of_query] = asking["idf"].to_numpy()
        tf, length = found["tf"].to_numpy().astype(float), found["length"].to_numpy().astype(float)
        gain = idf_of[w_of_doc] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))
        seats = np.split(q_at[np.argsort(w_of_query, kind="stable")], np.cumsum(np.bincount(w_of_query, minlength=len(names)))[:-1])
        best, step = BestK(qids, k), max(1, CELLS // len(qids))
        for at in range(0, len(items), step):
            here = np.flatnonzero((d_at >= at) & (d_at < at + step))
            here = here[np.argsort(w_of_doc[here], kind="stable")]
            scores = np.zeros((len(qids), min(step, len(items) - at)))
            cuts = np.flatnonzero(np.diff(w_of_doc[here])) + 1
            for rows in np.split(here, cuts):
                if len(rows):  # a word: its queries by its documents
                    scores[np.ix_(seats[w_of_doc[rows[0]]], d_at[rows] - at)] += gain[rows]
            scores[scores == 0] = -np.inf
            best.add(0, items[at : at + step], scores)
        rows, ids, scores, _ = best.result()
        return pa.table([pa.array(qids[rows].tolist(), arrow[0].type), pa.array(ids.tolist(), arrow[1].type), pa.array(scores)], schema=arrow)

    hits = left.groupBy("slice", "part").cogroup(right.groupBy("slice", "block")).applyInArrow(run, schema)
    by_query = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "item_id")
    return hits.withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)


def bm25(
    docs: DataFrame, queries: DataFrame, k: int = 5, *, doc_id: str = "doc_id", doc_text: str = "text",
    query_id: str = "query_id", query_text: str = "text", **options,
) -> DataFrame:
    """Best k documents per query over an index made for this one search."""
    spark = docs.sparkSession
    index = build_index(docs, scratch_path(spark, "text-index"), doc_id=doc_id, doc_text=doc_text)
    return search(spark, index, queries, k, query_id=query_id, query_text=query_text, **options)


def shared_word_ratio(query: Column, text: Column) -> Column:
    """Share of the query's distinct words that occur in the text."""
    q = F.array_distinct(words(F.lower(query)))
    hit = F.size(F.array_intersect(q, words(F.lower(text))))
    return F.coalesce(hit / F.nullif(F.size(q), F.lit(0)), F.lit(0.0))


def rerank(candidates: DataFrame, score: Column, keep: int = 3, tie: str = "item_id") -> DataFrame:
    """Order each query's candidates by a second score and keep the best."""
    scored = candidates.withColumn("rerank_score", score)
    order = Window.partitionBy("query_id").orderBy(F.col("rerank_score").desc(), tie)
    return scored.withColumn("new_rank", F.row_number().over(order)).filter(F.col("new_rank") <= keep)
