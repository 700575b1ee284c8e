"""From raw documents to token ids: each stage is one of the operators and works on what the one before has kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewright.llm import decontamination, jaccard_join, mixing, token_output, toxicity
from tidewright.llm.common import prepare, table
from tidewright.llm.queries import vocabulary
from tidewright.session import scratch_path


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go."""
    prepare(spark)
    return toxicity.remove_toxic(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the least id stays."""
    prepare(spark)
    return jaccard_join.keep_one_of_each(docs)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    prepare(spark)
    return decontamination.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled to the target weights of sources, languages and topics."""
    prepare(spark)
    return mixing.sample(docs)


def as_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, as read back from the id files."""
    prepare(spark)
    out = scratch_path(spark, "corpus-ids")
    token_output.write_ids(docs, vocabulary(), out)
    return token_output.read_ids(spark, out, digest=True)


STAGES = [
    ("toxicity", without_toxic),
    ("ngram_jaccard_join", one_of_each),
    ("decontamination", without_leaks),
    ("mixing", mixed),
    ("token_output", as_ids),
]

# Compression lengths and raking by rounds can't be said in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; what each keeps is written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
