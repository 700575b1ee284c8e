"""Continuous monitoring: history is a table of bucket states, and a cycle holds at most a given number of events.

Each micro-batch runs the same steps as the batch job, so a hot bucket is
spread over tasks in the stream as well. A micro-batch may be cut into cycles of at most N events, in
the order of their times, however many files they came in. The states after batch ``n`` are
written below ``<states>/batch=n`` and the next batch starts from them. Results
and states of a batch are whole folders that a repeated batch replaces, so
a restart from the checkpoint neither loses nor doubles anything.

Events are ordered within a batch; an event that arrives in a later batch is
folded in where it arrives. Events without a time are kept, without a score, as in the batch job.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.anomaly import STATE_SCHEMA, THRESHOLD, detect_and_keep
from ..operators.contract import Model
from ..operators.layout import numbered
from ..operators.metric_index import settled
from ..operators.risk import ALERT_THRESHOLD, build_alerts
from ..plans.monitoring import PROMPT_VERSION, describe, explain, refused
from ..sources.literals import literal_table
from ..sources.writers import Sink, drop_folder, emit, enriched_rows


def state_folder(base: str, batch_id: int) -> str:
    return f"{base.rstrip('/')}/batch={batch_id}"


def empty_states(spark: SparkSession) -> DataFrame:
    return literal_table(spark, [], STATE_SCHEMA)


def read_states(spark: SparkSession, base: str, batch_id: int) -> DataFrame:
    """States after a batch; none before the first."""
    if batch_id < 0:
        return empty_states(spark)
    return spark.read.schema(STATE_SCHEMA).parquet(state_folder(base, batch_id))


def reset_states(spark: SparkSession, base: str, batch_id: int) -> None:
    """Forget all history: the batch after ``batch_id`` starts without states."""
    empty_states(spark).write.mode("overwrite").parquet(state_folder(base, batch_id))


def cycles(events: DataFrame, per_cycle: int | None) -> Iterator[tuple[int, DataFrame]]:
    """The events of a batch in cycles of at most ``per_cycle``, the oldest first, those without a time last.

    Places come from the order over all partitions, so a cycle may be far larger than what a task holds; it is read
    from the stored order by a range of places.
    """
    if per_cycle is None:
        yield 0, events
        return
    timeless = F.col("ts").isNull().alias("_timeless")
    placed = settled(numbered(events.select("*", timeless), ["_timeless", "ts", "event_id"], "_place").drop("_timeless"), "admitted")
    total = placed.count()
    for cycle in range(max(1, -(-total // per_cycle))):
        inside = (F.col("_place") >= cycle * per_cycle) & (F.col("_place") < (cycle + 1) * per_cycle)
        yield cycle, placed.where(inside).drop("_place")


def process_batch(
    events: DataFrame, batch_id: int, out: str, states: str, run_id: str,
    sinks: Mapping[str, Sink] | None = None, z_threshold: float = THRESHOLD, alert_threshold: int = ALERT_THRESHOLD,
    per_cycle: int | None = None, models: Mapping[str, Model] | None = None, documents: DataFrame | None = None, letters: str | None = None,
    version: str = PROMPT_VERSION,
) -> dict[str, str | None]:
    """Enrich a batch from the previous states, cycle by cycle, store results and new states, emit alerts.

    ``models`` and ``documents`` are those of the batch job; each model sees each event once. With ``letters``
    events without a usable answer are stored there as well, one row per refused call.
    """
    spark = events.sparkSession
    folder, known = f"{out.rstrip('/')}/batch_id={batch_id}", read_states(spark, states, batch_id - 1)
    drop_folder(spark, folder)  # a repeated batch may have been cut into more cycles
    if letters:
        drop_folder(spark, f"{letters.rstrip('/')}/batch_id={batch_id}")
    for cycle, part in cycles(events, per_cycle):
        scored, after = detect_and_keep(describe(part, models=models, version=version), states=known, threshold=z_threshold)
        rated = explain(scored, run_id, models, documents, version)
        if models:  # what a model answered is read from a table from here on
            rated = settled(rated, "answered")
        enriched_rows(rated).write.mode("overwrite").parquet(f"{folder}/cycle={cycle}")
        if letters and models:
            _refused_calls(rated).write.mode("overwrite").parquet(f"{letters.rstrip('/')}/batch_id={batch_id}/cycle={cycle}")
        known = settled(after, "states")
    known.write.mode("overwrite").parquet(state_folder(states, batch_id))
    if not sinks:
        return {}
    stored = spark.read.parquet(folder).drop("cycle")  # alerts come from what was stored, without scoring again
    listed = stored.withColumn("recommendations", F.from_json("recommendations", "array<string>"))
    return emit(build_alerts(listed, run_id, alert_threshold), batch_id, sinks)


def _refused_calls(rated: DataFrame) -> DataFrame:
    steps = [c.removesuffix("_call") for c in rated.columns if c.endswith("_call")]
    calls = F.array(*[F.struct(F.lit(s).alias("step"), F.col(f"{s}_call").alias("call")) for s in steps])
    rows = rated.where(refused(rated)).select("event_id", "ts", "source", "service", "raw_payload", F.explode(calls).alias("c"))
    return rows.where("NOT c.call.parse_success").select(
        "event_id", "ts", "source", "service", "raw_payload", "c.step", "c.call.asked_at", "c.call.error_type", "c.call.error", "c.call.raw"
    )


def monitor(events: DataFrame, out: str, states: str, checkpoint: str, run_id: str, interval: str | None = None, **options) -> StreamingQuery:
    """Start the stream: every ``interval`` (e.g. ``"300 seconds"``), or all available data once."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: process_batch(batch, batch_id, out, states, run_id, **options) and None
    )
    writer = writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)
    return writer.start()


def read_results(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(out)


# ---- counts per window -------------------------------------------------------

def window_start(ts: Column, seconds: int) -> Column:
    """Start of the window of a time; null for none, so such events are counted too."""
    at = F.unix_micros(ts.cast("timestamp"))
    return F.timestamp_micros(F.floor(at / F.lit(seconds * 1_000_000)).cast("long") * F.lit(seconds * 1_000_000))


def _read(spark: SparkSession, path: str, schema: str, before: int) -> DataFrame:
    """Rows of the batches before a number; folders of later ones may be left from a run that was repeated."""
    return spark.read.schema(f"{schema}, batch_id int").parquet(path).where(F.col("batch_id") < before)


MARKS, COUNTS = "latest timestamp", "start timestamp, {by} string, events long"


def count_batch(batch: DataFrame, batch_id: int, out: str, by: str = "service", seconds: int = 900, late_seconds: int = 3600) -> None:
    """Fold one micro-batch into the counts per window and key.

    A window is closed once the latest time seen in earlier batches is ``late_seconds`` past its end. Counts of a batch are stored as they are; sums over
    batches are the counts, so an event counts whenever it comes. What comes for a closed window is stored in ``late`` as well, and
    the windows that it hits are counted again: ``corrections`` holds each with its count before and after.
    """
    spark, out = batch.sparkSession, out.rstrip("/")
    if batch_id:
        latest = _read(spark, f"{out}/marks", MARKS, batch_id).agg(F.max("latest").alias("t")).first()["t"]
    else:
        latest = None
    here = f"batch_id={batch_id}"
    rows = batch.select("event_id", F.col("ts").cast("timestamp").alias("ts"), F.col(by).cast("string").alias(by), window_start(F.col("ts"), seconds).alias("start"))
    rows.write.mode("overwrite").parquet(f"{out}/arrived/{here}")
    rows = spark.read.schema(rows.schema).parquet(f"{out}/arrived/{here}")
    counts = rows.groupBy("start", by).agg(F.count(F.lit(1)).alias("events"))
    counts.write.mode("overwrite").parquet(f"{out}/counts/{here}")
    closed = F.lit(False) if latest is None else F.col("start") + F.make_interval(secs=F.lit(seconds + late_seconds)) <= F.lit(latest)
    rows.where(closed).write.mode("overwrite").parquet(f"{out}/late/{here}")
    rows.agg(F.max("ts").alias("latest")).write.mode("overwrite").parquet(f"{out}/marks/{here}")
    schema = COUNTS.format(by=by)
    hit = spark.read.schema(rows.schema).parquet(f"{out}/late/{here}").groupBy("start", by).agg(F.count(F.lit(1)).alias("late"))
    now = _read(spark, f"{out}/counts", schema, batch_id + 1).join(hit, ["start", by]).groupBy("start", by).agg(
        F.sum("events").alias("events"), F.max("late").alias("late")
    )
    now.select("start", by, (F.col("events") - F.col("late")).alias("before"), "events").write.mode("overwrite").parquet(f"{out}/corrections/{here}")


def count_windows(events: DataFrame, out: str, checkpoint: str, interval: str | None = None, **options) -> StreamingQuery:
    """Start the counting stream: every ``interval``, or all available data once."""
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda batch, batch_id: count_batch(batch, batch_id, out, **options)
    )
    return (writer.trigger(processingTime=interval) if interval else writer.trigger(availableNow=True)).start()


def window_counts(spark: SparkSession, out: str, by: str = "service") -> DataFrame:
    """Events per window and key, late ones included."""
    return spark.read.parquet(f"{out.rstrip('/')}/counts").groupBy("start", by).agg(F.sum("events").alias("events"))


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """Events that came after their window had closed, with the batch they came in."""
    return spark.read.parquet(f"{out.rstrip('/')}/late")


def corrections(spark: SparkSession, out: str) -> DataFrame:
    """Closed windows that were counted again: count before and after, per batch."""
    return spark.read.parquet(f"{out.rstrip('/')}/corrections")
