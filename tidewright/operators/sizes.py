"""Checked sizes: a side travels to all tasks only when it is known to be small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def rows_within(df: DataFrame, bound: int) -> bool:
    """Whether a frame has at most ``bound`` rows: each partition counts, one row per partition is added up."""
    return df.count() <= bound


def broadcast_if_small(df: DataFrame, rows: int = 10_000) -> DataFrame:
    """Broadcast hint when the row count allows it; otherwise the join is left to the optimizer."""
    return F.broadcast(df) if rows_within(df, rows) else df


HOT_SHARE, HOT_ROWS = 1000, 100_000


def join_hot(rows: DataFrame, unique: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of a table whose ``key`` is unique, when a few keys may hold a large part of the rows.

    Keys with more than a thousandth of the rows (and ``hot_rows`` of them) are fewer than ``HOT_SHARE``: their partners are
    broadcast, and their rows stay where they are. All others meet in a shuffle in which no key is hot. ``rows`` are read three times, so they
    should be a table; their keys are not null.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    hot = counts.where((F.col("_n") * HOT_SHARE > rows.count()) & (F.col("_n") >= hot_rows)).select(key)
    names = [tuple(r) for r in hot.collect()]  # fewer than HOT_SHARE keys
    if not names:
        return rows.join(unique, key, "left")
    known = F.broadcast(rows.sparkSession.createDataFrame(names, hot.schema))
    partners = F.broadcast(unique.join(known, key, "left_semi"))
    by_broadcast = rows.join(known, key, "left_semi").join(partners, key, "left")
    return by_broadcast.unionByName(rows.join(known, key, "left_anti").join(unique, key, "left"))
