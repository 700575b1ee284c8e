"""Writers. A rerun of a job gives the same tables: the named dates or batches are replaced as a whole, all others stay."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import shared_folder


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def by_partition(df: DataFrame, column: str) -> DataFrame:
    """Rows of one partition value together, large values split and small ones merged by adaptive execution."""
    return df.hint("rebalance", column)


NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def overwrite_partitions(df: DataFrame, path: str, column: str = "dt", values: Iterable[object] | None = None, fmt: str = "parquet") -> None:
    """Replace the partitions that occur in ``df``, and empty those of ``values`` that do not.

    ``values`` are the dates or batches of this run. A partition that has become empty would
    keep its old rows otherwise, as a dynamic overwrite touches only partitions with new ones. These are emptied
    first: after a crash in between they lack rows until the run is repeated, but never hold old ones.
    """
    if values is not None:
        named = {str(v) for v in values}
        found = {str(r[0]) for r in df.filter(F.col(column).cast("string").isin(*named)).select(column).distinct().collect()}
        for value in named - found:
            drop_folder(df.sparkSession, f"{path.rstrip('/')}/{column}={value}")
    writer = by_partition(df, column).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.format(fmt).partitionBy(column).save(path)


def undated_folder(path: str, load: str, column: str = "dt") -> str:
    """Where a load keeps its rows without a partition value: a folder of its own inside the partition of none."""
    return f"{path.rstrip('/')}/{column}={NO_VALUE}/load-{load}"


def save_undated(df: DataFrame, path: str, load: str, column: str = "dt", fmt: str = "parquet") -> None:
    """Replace one load's rows without a partition value; those of other loads stay, and readers of the table see all."""
    folder = undated_folder(path, load, column)
    rows = df.where(F.col(column).isNull()).drop(column)
    if rows.isEmpty():
        drop_folder(df.sparkSession, folder)
    else:
        rows.write.mode("overwrite").format(fmt).save(folder)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder or file of any file system Spark reaches; nothing happens if there is none."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def save_raw(
    df: DataFrame, base: str, name: str, fmt: str = "json", column: str = "dt", values: Iterable[object] | None = None, load: str | None = None
) -> str:
    """Write the raw layer below ``<base>/raw/<name>/dt=...``: each date of ``df`` and of ``values`` is replaced, other dates stay.

    With a ``load`` rows without a date replace those of the same load only; without one, all such rows are replaced.
    """
    path = f"{base.rstrip('/')}/raw/{name}"
    overwrite_partitions(df if load is None else df.where(F.col(column).isNotNull()), path, column, values, fmt)
    if load is not None:
        save_undated(df, path, load, column, fmt)
    return path


def enriched_rows(enriched: DataFrame) -> DataFrame:
    """Columns of the stored enriched table; advice as JSON text, time, source and service kept."""
    return enriched.select(
        "event_id", "ts", "source", "service", "event_type", "severity", "classification_confidence",
        "classification_method", "extracted_summary", "is_anomaly", "z_score", "root_cause", "risk_score", "risk_level",
        F.to_json("recommendations").alias("recommendations"), "pipeline_run_id", "prompt_version",
    )


def mark_processed(ids: DataFrame, ledger: str) -> None:
    """Append ids to the ledger; readers take them as a set, so marking twice is harmless."""
    ids.select("event_id").write.mode("append").parquet(ledger)


def read_ledger(spark, ledger: str) -> DataFrame:
    return spark.read.parquet(ledger).dropDuplicates(["event_id"])


Sink = Callable[[DataFrame, int], None]


def emit(alerts: DataFrame, batch_id: int, sinks: Mapping[str, Sink]) -> dict[str, str | None]:
    """Give the alerts to every sink; one failing sink does not stop the others. Returns error or None per sink.

    The alerts are stored first, so that several sinks do not compute them several times.
    """
    shared_folder(alerts.sparkSession)
    alerts = alerts.checkpoint(eager=True)
    outcome: dict[str, str | None] = {}
    for name, send in sinks.items():
        try:
            send(alerts, batch_id)
            outcome[name] = None
        except Exception as e:  # noqa: BLE001 - recorded per sink
            outcome[name] = f"{type(e).__name__}: {e}"
    return outcome


def table_sink(path: str) -> Sink:
    """A sink that keeps one partition per batch, so a repeated batch replaces itself."""
    def send(alerts: DataFrame, batch_id: int) -> None:
        overwrite_partitions(alerts.withColumn("batch_id", F.lit(batch_id)), path, "batch_id", [batch_id])

    return send
