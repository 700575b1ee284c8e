"""Global order without a single sorting task: range partitions, sizes of at most ``MAX_PARTS`` of them, local row numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import store

ROWS_PER_PART, MAX_PARTS = 50_000, 20_000


def laid_out(df: DataFrame, order: list[Column], part: str, name: str, rows_per_part: int | None = None) -> DataFrame:
    """``df`` sorted over range partitions and stored, with the partition number as ``part``.

    ``df`` should be a stored table: range partitioning reads it twice. Bounds come from samples, so what needs
    partition numbers must read the stored rows.
    """
    parts = min(MAX_PARTS, max(1, -(-df.count() // (rows_per_part or ROWS_PER_PART))))
    return store(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(part, F.spark_partition_id()), name)


def numbered(df: DataFrame, order: list[Column], position: str, name: str, rows_per_part: int | None = None) -> DataFrame:
    """``df`` with ``position``, the row's place from 0 in the order over all rows; rows equal in all of it are numbered arbitrarily."""
    laid = laid_out(df, order, "_part", name, rows_per_part)
    # One row per partition: at most MAX_PARTS of 16 bytes are sequenced in one task and broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        laid.withColumn("_place", place).join(F.broadcast(starts), "_part")
        .withColumn(position, (F.col("_start") + F.col("_place")).cast("long")).drop("_part", "_place", "_start")
    )
