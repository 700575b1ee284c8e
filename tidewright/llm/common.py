"""What the operators of this package share: stored steps, exact ranks without hot partitions, Arrow row work."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import scratch_path, tune

# Texts in one Arrow batch: with documents of megabytes a batch still fits beside an executor's heap.
ROWS_PER_BATCH = 512


def prepare(spark: SparkSession) -> SparkSession:
    """Settings the operators rely on, for a session somebody else built."""
    tune(spark)
    for key, value in {
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(ROWS_PER_BATCH),
    }.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, and kept when executors go."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def map_rows(
    df: DataFrame, columns: list[str], fn: Callable[..., dict], schema: str
) -> DataFrame:
    """``fn(column lists...) -> {name: values}`` on each Arrow batch of the named columns."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType, _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(*(batch.column(i) for i in range(batch.num_columns)))
                yield pa.RecordBatch.from_arrays(
                    [v if isinstance(v := out[f.name], pa.Array) else pa.array(v, f.type) for f in arrow], schema=arrow
                )

    return df.select(*columns).mapInArrow(run, parsed)


def rank_in(df: DataFrame, keys: list[str], order: list[str], rows: int, n_keys: int, name: str) -> DataFrame:
    """Add ``name``: gapless ranks from 0 within ``keys``, exact, with no key's rows in one task.

    Rows are dealt to (key, bucket) by a hash of the order columns; a rank is the
    bucket's offset, a sum of counts, plus the rank inside the bucket. ``rows`` and
    ``n_keys`` size the buckets: about sqrt(rows) of them in all. Rows equal in
    all order columns fall into one bucket and are ranked arbitrarily.
    """
    buckets = max(1, int(rows**0.5) // max(1, n_keys))
    cut = df.withColumn("_bucket", F.pmod(F.xxhash64(*order, F.lit(11)), F.lit(buckets)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        cut.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .select(*keys, "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (
        cut.withColumn("_rank", F.row_number().over(inside))
        .join(offsets, [*keys, "_bucket"])
        .withColumn(name, (F.col("_offset") + F.col("_rank") - 1).cast("long"))
        .drop("_bucket", "_rank", "_offset")
    )


def free_name(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def lookup(values: list, index: Column, cast: str) -> Column:
    """Element of a short constant list by a column's number."""
    return F.element_at(F.array(*[F.lit(v).cast(cast) for v in values]), index.cast("int") + 1)


def unit(*cols: Column | str, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the columns and the seed only."""
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 40)).cast("double") / float(1 << 40)
