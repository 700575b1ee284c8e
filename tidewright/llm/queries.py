"""The registered queries of this package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import scratch_path
from . import (
    chat_format, collocations, decontamination, embedding_dedup, jaccard_join, license_scan, mixing, quality_rules, resampling, sharding,
    token_counts, token_output, toxicity,
)
from .common import table

VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {
    "op9_chat_format": chat_format.DIGEST_SQL,
    "op11_importance_resampling": resampling.SQL,
    "op12_embedding_dedup": embedding_dedup.SQL,
    "op13_collocations": collocations.SQL,
}


def vocabulary() -> str:
    import public_tokenizers

    return str(public_tokenizers.path(VOCABULARY))


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_links(table(spark, sf_dir, "documents"))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


@query
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents")).drop("matches")


@query
def op6_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "token-ids")
    token_output.write_ids(table(spark, sf_dir, "documents"), vocabulary(), out)
    return token_output.read_ids(spark, out, digest=True)


@query
def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).drop("text_hash")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("counts")


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    every = turns.unionByName(chat_format.clash_rows(spark))
    return chat_format.digests(chat_format.write_and_read(every, scratch_path(spark, "chat")))


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"))


@query
def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))
