"""Streaming queries: the events arrive in time slices, results are compared with the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import anomaly
from ..session import scratch_path
from ..sources.writers import drop_folder
from ..streaming import monitor as mo
from . import Tables, register
from .fixtures import RAW_EVENT_SQL, raw_events
from .monitoring import ENRICHED_SQL, RUN, SCORED_SQL, _SHOWN_SQL, _LAST, _REFUSED, _shown_z, cause_model, enriched

SLICES = 2


def slices_of(t: Tables, slices: int = SLICES) -> list[DataFrame]:
    """The raw events in time slices; those without a time come with the last one."""
    ends = t.events.agg(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    width, rows, out = (ends.hi - ends.lo) // slices, raw_events(t), []
    for i in range(slices):
        low, high = ends.lo + i * width, ends.lo + (i + 1) * width
        last = F.col("ts").isNull() | (F.col("ts") >= F.lit(low))
        out.append(rows.filter(last if i == slices - 1 else (F.col("ts") >= F.lit(low)) & (F.col("ts") < F.lit(high))))
    return out


def source(t: Tables, path: str) -> DataFrame:
    """A stream over a folder of parquet files, as many at once as there are."""
    return t.spark.readStream.schema(raw_events(t).schema).parquet(path)


def _run(t: Tables, events: DataFrame, out: str, states: str, checkpoint: str, **options) -> None:
    mo.monitor(events, out, states, checkpoint, RUN, **options).awaitTermination()


def streamed(t: Tables, repeat: bool = False, **options) -> tuple[str, str]:
    """Slice after slice arrives in a folder, in several files each, and is processed as one micro-batch."""
    path, out, states, checkpoint = (scratch_path(t.spark, n) for n in ("arriving", "live", "states", "checkpoint"))
    for rows in slices_of(t):
        rows.write.mode("append").parquet(path)
        _run(t, source(t, path), out, states, checkpoint, **options)
    if repeat:  # as after a crash before the last batch was committed: it runs again
        drop_folder(t.spark, f"{checkpoint}/commits/{SLICES - 1}")
        _run(t, source(t, path), out, states, checkpoint, **options)
    return out, states


@register("stream_microbatch", f"{ENRICHED_SQL} SELECT event_id, service, event_type, severity, is_anomaly, risk_score, risk_level, {_SHOWN_SQL} FROM enr")
def _(t: Tables):
    out, _ = streamed(t, per_cycle=t.events.count() // 5)
    return mo.read_results(t.spark, out).select("event_id", "service", "event_type", "severity", "is_anomaly", "risk_score", "risk_level", _shown_z())


@register(
    "stream_cycles",
    f"{ENRICHED_SQL}, n AS (SELECT count(*) // 5 AS per FROM events), e AS (SELECT min(ts) AS lo, max(ts) AS hi FROM events), "
    f"b AS (SELECT enr.*, CASE WHEN epoch_us(ts) < epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) // {SLICES} THEN 0 ELSE 1 END AS batch_id FROM enr, e), "
    f"c AS (SELECT *, CAST((row_number() OVER (PARTITION BY batch_id ORDER BY ts, event_id) - 1) // per AS INTEGER) AS cycle FROM b, n) "
    f"SELECT batch_id, cycle, count(*) AS events, max(risk_score) AS top, count(*) FILTER (WHERE {_REFUSED}) AS refused FROM c GROUP BY ALL",
)
def _(t: Tables):
    """Cycles of a fifth of all events with a model in the batch: what each held, and how many of its events the model refused."""
    letters = scratch_path(t.spark, "letters")
    out, _ = streamed(t, per_cycle=t.events.count() // 5, models={"root_cause": cause_model()}, letters=letters)
    refused = t.spark.read.parquet(letters).groupBy("batch_id", "cycle").agg(F.count(F.lit(1)).alias("refused"))
    held = mo.read_results(t.spark, out).groupBy("batch_id", "cycle").agg(F.count(F.lit(1)).alias("events"), F.max("risk_score").alias("top"))
    return held.join(refused, ["batch_id", "cycle"], "left").select("batch_id", "cycle", "events", "top", F.coalesce("refused", F.lit(0)).alias("refused"))


@register("stream_ewma_state", SCORED_SQL + _LAST)
def _(t: Tables):
    _, states = streamed(t)
    return anomaly.snapshot(mo.read_states(t.spark, states, SLICES - 1))


@register("state_reset", SCORED_SQL + _LAST)
def _(t: Tables):
    out, states = scratch_path(t.spark, "live"), scratch_path(t.spark, "states")
    mo.process_batch(raw_events(t), 0, out, states, RUN)
    mo.reset_states(t.spark, states, 0)  # history is gone: the same events give fresh states
    mo.process_batch(raw_events(t), 1, out, states, RUN)
    return anomaly.snapshot(mo.read_states(t.spark, states, 1))


@register("stream_batch_parity", f"{ENRICHED_SQL} SELECT service, count(*) AS events, 0::BIGINT AS differing FROM enr GROUP BY service")
def _(t: Tables):
    out, _ = streamed(t)
    live = mo.read_results(t.spark, out).select("event_id", F.struct("z_score", "is_anomaly", "risk_score").alias("live"))
    batch = enriched(t).select("event_id", "service", F.struct("z_score", "is_anomaly", "risk_score").alias("batch"))
    both = batch.join(live, "event_id", "left")
    return both.groupBy("service").agg(F.count(F.lit(1)).alias("events"), F.count_if(~F.col("batch").eqNullSafe(F.col("live"))).alias("differing"))


@register("stream_exactly_once_append", f"{ENRICHED_SQL} SELECT service, risk_level, count(*) AS n, count(DISTINCT event_id) AS ids FROM enr GROUP BY ALL")
def _(t: Tables):
    out, _ = streamed(t, repeat=True)
    stored = mo.read_results(t.spark, out)
    return stored.groupBy("service", "risk_level").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("event_id").alias("ids"))


_WINDOW = f"WITH raw AS ({RAW_EVENT_SQL}) SELECT service, strftime(time_bucket(INTERVAL 15 MINUTE, ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS events FROM raw GROUP BY ALL"


def counted(t: Tables) -> str:
    """The later slice first: all of the earlier one comes after its windows have closed."""
    path, out, checkpoint = (scratch_path(t.spark, n) for n in ("arriving", "windows", "checkpoint"))
    for rows in reversed(slices_of(t)):
        rows.write.mode("append").parquet(path)
        mo.count_windows(source(t, path), out, checkpoint).awaitTermination()
    return out


@register("stream_windowed_counts", _WINDOW)
def _(t: Tables):
    counts = mo.window_counts(t.spark, counted(t))
    return counts.select("service", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "events")


@register(
    "stream_late_events",
    f"WITH raw AS ({RAW_EVENT_SQL}), e AS (SELECT min(ts) AS lo, max(ts) AS hi FROM raw), w AS (SELECT *, time_bucket(INTERVAL 15 MINUTE, ts) AS start, epoch_us(ts) < epoch_us(lo) + (epoch_us(hi) - epoch_us(lo)) // {SLICES} AS later FROM raw, e), "
    "l AS (SELECT *, later AND start + INTERVAL 75 MINUTE <= hi AS late FROM w) "
    "SELECT service, strftime(start, '%Y-%m-%d %H:%M:%S') AS start, count(*) FILTER (WHERE late) AS late, count(*) FILTER (WHERE NOT late) AS before, count(*) AS events FROM l GROUP BY service, l.start HAVING count(*) FILTER (WHERE late) > 0",
)
def _(t: Tables):
    """Windows that late events have hit: how many came late, and the count before and after."""
    out = counted(t)
    late = mo.late_events(t.spark, out).groupBy("service", "start").agg(F.count(F.lit(1)).alias("late"))
    both = mo.corrections(t.spark, out).join(late, ["service", "start"])
    return both.select("service", F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "late", "before", "events")
