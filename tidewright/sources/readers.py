"""Readers with declared schemas; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.funnel import DEFAULT, FunnelSpec
from .csv_split import records

# Layout of a document folder: <base>/<category>/<stem>.md
DOCUMENT_PATH = r"([^/]+)/([^/]+)\.md$"


def csv_text(spark: SparkSession, path: str, schema: str | None = None, spec: FunnelSpec = DEFAULT) -> DataFrame:
    """Headed CSV with every column as text, blanks kept; typing is a later step."""
    reader = spark.read.schema(schema or spec.text_schema).option("header", True)
    return reader.option("escape", '"').option("multiLine", False).csv(path)


def csv_records(spark: SparkSession, path: str, columns: Sequence[str], split_bytes: int | None = None) -> DataFrame:
    """Headed CSV files as text columns, found by their header names; a quoted field may hold line breaks.

    Each file's own header says where its columns are, in any order; a column a file lacks is null. Files are split as plain text: a first pass counts the
    quotation marks of each split, whose running parity tells whether a split starts inside a quoted field. So records that cross
    a line or a split are put together whole, and a large file keeps many tasks busy. Quotation marks inside fields are doubled, and stand in quoted
    fields only; header names compare exactly. What tasks are told of a split is 17 bytes, and the names of the different headers.
    """
    return records(spark, path, columns, split_bytes)


def parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def ndjson(spark: SparkSession, path: str, schema: str, day: str | None = None) -> DataFrame:
    """JSON lines below ``dt=`` folders; with ``day`` only that folder is listed and read."""
    rows = spark.read.schema(f"{schema}, dt date").json(path)
    return rows if day is None else rows.filter(F.col("dt") == F.lit(day).cast("date"))


def text_documents(spark: SparkSession, base: str, pattern: str = DOCUMENT_PATH) -> DataFrame:
    """A folder of text files as (doc_id, type, source, content); the id is ``category/stem`` from the path."""
    files = spark.read.text(base, wholetext=True, recursiveFileLookup=True).withColumn("source", F.input_file_name())
    category, stem = (F.regexp_extract("source", pattern, i) for i in (1, 2))
    return files.select(
        F.concat_ws("/", category, stem).alias("doc_id"), category.alias("type"), "source",
        F.col("value").alias("content"),
    )


def unprocessed(events: DataFrame, ledger: DataFrame, n: int = 10) -> DataFrame:
    """The n oldest events whose id is not in the ledger (a top-n, not a full sort)."""
    return events.join(ledger.select("event_id"), "event_id", "left_anti").orderBy("ts", "event_id").limit(n)
