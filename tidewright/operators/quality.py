"""Record checks, dead letters and job logs."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.literals import literal_table

LOG_FIELDS = ("event", "job", "timestamp", "valid_records", "dlq_records", "duration_seconds", "success")
LOG_SCHEMA = (
    "event string, job string, timestamp string, valid_records long, dlq_records long, duration_seconds double, success boolean"
)


def enforce_types(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Exactly the columns and types of the schema; a value that does not fit becomes null."""
    return df.select(*[F.col(c).try_cast(kind).alias(c) for c, kind in schema.items()])


def check(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``errors``: names of the rules a row breaks (an unknown outcome breaks the rule)."""
    broken = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]
    return df.withColumn("errors", F.array_compact(F.array(*broken)))


def valid(checked: DataFrame) -> DataFrame:
    return checked.filter(F.size("errors") == 0).drop("errors")


def dead_letters(checked: DataFrame) -> DataFrame:
    """Broken rows, all columns as text, with their errors."""
    bad = checked.filter(F.size("errors") > 0)
    return bad.select(*[F.col(c).cast("string").alias(c) for c in bad.columns if c != "errors"], "errors")


def add_lineage(df: DataFrame, source: str, dt: Column) -> DataFrame:
    return df.withColumns({"_source": F.lit(source), "dt": dt.cast("date"), "_processed_at": F.current_timestamp()})


def job_log(checked: DataFrame, event: str, job: Column, *by: str, started: datetime | None = None, finished: datetime | None = None) -> DataFrame:
    """Counts of valid and rejected rows per job in one pass; success means nothing was rejected.

    With ``started`` an entry also has its time stamp and duration, up to ``finished`` or now.
    """
    is_bad = F.size("errors") > 0
    entries = checked.groupBy(job.alias("job"), *by).agg(
        F.count_if(~is_bad).alias("valid_records"), F.count_if(is_bad).alias("dlq_records")
    ).withColumns({"event": F.lit(event), "success": F.col("dlq_records") == 0})
    return entries if started is None else entries.withColumns(_times(started, finished))


def _times(started: datetime, finished: datetime | None) -> dict[str, Column]:
    finished = finished or datetime.now(timezone.utc)
    stamp = finished.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")
    return {"timestamp": F.lit(stamp), "duration_seconds": F.lit(round((finished - started).total_seconds(), 2))}


def log_line() -> Column:
    """A log entry as the JSON line that ``log_compliance`` accepts."""
    return F.to_json(F.struct(*LOG_FIELDS), {"ignoreNullFields": "false"})


def write_checked(checked: DataFrame, trusted: str, letters: str, event: str, job: str) -> DataFrame:
    """Store the valid rows and the dead letters; the job's log entry, one row, is counted while they are written."""
    started, good, bad = datetime.now(timezone.utc), Observation("valid"), Observation("dlq")
    n = F.count(F.lit(1)).alias("n")
    valid(checked).observe(good, n).write.mode("overwrite").parquet(trusted)
    dead_letters(checked).observe(bad, n).write.mode("overwrite").parquet(letters)
    row = literal_table(checked.sparkSession, [(event, job, good.get["n"], bad.get["n"])], "event string, job string, valid_records long, dlq_records long")
    return row.withColumns({"success": F.col("dlq_records") == 0} | _times(started, None))


def log_compliance(logs: DataFrame, line: str = "line") -> DataFrame:
    """Per log line: required fields that are missing, and whether ``success`` contradicts the rejects."""
    entry = logs.withColumn("_e", F.from_json(F.col(line), LOG_SCHEMA))
    e = F.col("_e")
    missing = F.array_compact(F.array(*[F.when(e[f].isNull(), F.lit(f)) for f in LOG_FIELDS]))
    wrong = F.coalesce(e["success"] != (e["dlq_records"] == 0), F.lit(False))
    stamp = F.coalesce(e["timestamp"].rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"), F.lit(False))
    return entry.withColumns({
        "job": e["job"], "missing": missing, "wrong_success": wrong,
        "compliant": (F.size(missing) == 0) & ~wrong & stamp,
    }).drop("_e")
