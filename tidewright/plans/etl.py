"""Loading jobs: raw to trusted by partition, and trusted to refined."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators import quality as ql
from ..sources import writers


def reference_date(calendar: DataFrame, today: str | Column, day: str = "day", business: str = "is_business_day") -> DataFrame:
    """Second most recent business day before ``today`` (a parameter, not the clock), as one row (or none)."""
    today = F.lit(today).cast("date") if isinstance(today, str) else today
    last_two = calendar.filter((F.col(day) < today) & F.col(business)).select(day).distinct().orderBy(F.col(day).desc()).limit(2)
    return last_two.agg(F.min(day).alias("reference_date"), F.count(F.lit(1)).alias("_n")).filter("_n = 2").drop("_n")


def load_staging(frames: Sequence[DataFrame]) -> DataFrame:
    """Staging tables under one another; columns a table lacks become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def lookup(df: DataFrame, dimension: DataFrame, key: str, check_unique: bool = True) -> DataFrame:
    """Left join of a dimension, whose key must be unique. The optimizer broadcasts it only while it is small."""
    if check_unique and not dimension.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").isEmpty():
        raise ValueError(f"dimension key {key} is not unique")
    return df.join(dimension, key, "left")


def ingest(
    source: DataFrame, base: str, name: str, rules: Mapping[str, Column], schema: Mapping[str, str], dt: Column, fmt: str = "parquet",
    dates: Sequence[str] | None = None, load: str | None = None,
) -> dict[str, str]:
    """Raw copy, checks, typed rows with lineage per ``dt``, dead letters; returns the table paths.

    A run stands for its ``dates`` (those of the source, if not given): these are replaced in every
    layer, and emptied where nothing is left, such as the dead letters of a day whose rows were mended. Rows of
    other dates are not loaded. Rows without a date belong to the ``load`` (named by its dates, if not given): in every layer they replace those of the same
    load, and are neither read nor replaced by another.
    """
    dated = source.withColumn("dt", dt.cast("date"))
    if dates is None:
        dates = [str(r[0]) for r in dated.select("dt").distinct().collect() if r[0] is not None]  # one per partition written
    if load is None:
        load = hashlib.sha256(",".join(sorted(map(str, dates))).encode()).hexdigest()[:16]
    ours = F.col("dt").isin(*[F.lit(d).cast("date") for d in dates]) if dates else F.lit(False)
    raw = writers.save_raw(dated.filter(ours | F.col("dt").isNull()), base, name, fmt, values=dates, load=load)
    spark = source.sparkSession
    stored = _stored(spark, raw, dated.schema, fmt).filter(ours)
    own = writers.undated_folder(raw, load)
    if not dated.filter(F.col("dt").isNull()).isEmpty():
        columns = [c for c in dated.columns if c != "dt"]
        undated = spark.read.format(fmt).schema(dated.select(*columns).schema).load(own).withColumn("dt", F.lit(None).cast("date"))
        stored = stored.unionByName(undated)
    checked = ql.check(stored, rules)
    paths = {"raw": raw, "trusted": f"{base}/trusted/{name}", "dlq": f"{base}/trusted/{name}_dlq"}
    typed = ql.enforce_types(ql.valid(checked), {**schema, "dt": "date"})
    for rows, path in ((ql.add_lineage(typed, name, F.col("dt")), paths["trusted"]), (ql.dead_letters(checked), paths["dlq"])):
        writers.overwrite_partitions(rows.where("dt IS NOT NULL"), path, values=dates)
        writers.save_undated(rows, path, load)
    return paths


def _stored(spark: SparkSession, path: str, schema: StructType, fmt: str) -> DataFrame:
    """The dated rows of a layer; none if no partition has been written yet."""
    rows = spark.read.format(fmt).schema(schema)
    try:
        return rows.load(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def refine(frames: Sequence[DataFrame], dimensions: Sequence[tuple[DataFrame, str]], measures: Callable[[DataFrame], DataFrame], schema: Mapping[str, str]) -> DataFrame:
    """Staging, lookups, measures, final types."""
    looked = reduce(lambda df, d: lookup(df, d[0], d[1]), dimensions, load_staging(frames))
    return ql.enforce_types(measures(looked), schema)
