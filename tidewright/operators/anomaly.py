"""Exponentially weighted z-scores per bucket, exact to the last bit and safe for hot buckets.

The recurrence is sequential, and rounding residue decides flags (a constant
run leaves a variance near 1e-31), so the state cannot be recombined
algebraically. What can be done exactly:

1. Lay the events out by (bucket, time) over all partitions. Only the first
   bucket of a partition can have started in an earlier one.
2. Summarise that stretch without knowing its start. Every rounded step is
   monotone, so running the lowest and the highest possible start state side by
   side brackets all starts. Mixed severities merge the two after a few hundred
   events: from there the state is the same for every start, hence exact. So
   the last few thousand events of a stretch mostly tell its end; where they do
   not, the whole stretch is read.
   Stretches that never merge are nearly constant and are kept as runs.
3. Put the summaries in sequence (at most two per partition) to get each start
   state. Stretches that neither merge nor compress (say, strictly alternating
   values) are replayed, all in parallel, from a guessed start. A replay counts
   only if its guess turns out to be the true start to the last bit; otherwise
   it runs again. Guesses come from the predecessors' replays and settle after
   a few rounds, and each round proves at least one more stretch per bucket.
4. Replay all partitions in parallel from their exact start states.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import severity_value
from ..sources.literals import literal_table
from ..session import scratch_path, shared_folder
from .layout import PART, ordered_layout

ALPHA = 0.3
THRESHOLD = 2.5
MIN_POINTS = 3
LOW, HIGH = 0.0, 5.0  # strictly outside the severity values, so they bracket every reachable mean
MAX_RUNS = 128
TAIL = 2048  # events at the end of a long stretch that mostly prove its state alone

STATE_SCHEMA = "bucket string, mean double, variance double, count long"


def bucket_of(service, event_type):
    """Name of a bucket; a missing part is empty, so that no two buckets meet."""
    return F.concat(F.coalesce(service, F.lit("")), F.lit(":"), F.coalesce(event_type, F.lit("")))


def step(mean: float, variance: float, count: int, value: float, alpha: float):
    """One observation; the order of operations is part of the result."""
    if count == 0:
        return value, 0.0, 1
    diff = value - mean
    return alpha * value + (1 - alpha) * mean, (1 - alpha) * (variance + alpha * diff * diff), count + 1


class _Bracket:
    """Lowest and highest state a stretch can be in, whatever its start was."""

    def __init__(self, alpha: float):
        self.alpha = alpha
        self.low, self.high = (LOW, 0.0), (HIGH, (HIGH - LOW) ** 2)
        self.merged = False

    def push(self, value: float) -> None:
        a, b = self.alpha, 1 - self.alpha
        (m0, v0), (m1, v1) = self.low, self.high
        if self.merged:
            d = value - m0
            self.low = self.high = (a * value + b * m0, b * (v0 + a * d * d))
            return
        d0, d1 = abs(value - m0), abs(value - m1)
        near = 0.0 if m0 <= value <= m1 and m0 != m1 else min(d0, d1)
        far = max(d0, d1)
        self.low = (a * value + b * m0, b * (v0 + a * near * near))
        self.high = (a * value + b * m1, b * (v1 + a * far * far))
        self.merged = self.low == self.high


def replay_runs(state, runs, alpha: float):
    """Fold run-length coded values; a run stops early once the state repeats itself."""
    mean, variance, count = state
    for value, length in runs:
        for i in range(length):
            new = step(mean, variance, count, value, alpha)
            if new[:2] == (mean, variance) and count > 0:
                count += length - i
                break
            mean, variance, count = new
    return mean, variance, count


_SUMMARY = (
    f"{PART} int, bucket string, rows long, merged boolean, opaque boolean, mean double, variance double, "
    "count long, run_value array<double>, run_length array<long>"
)


class _Stretch:
    """Summary of one bucket within one partition, built event by event."""

    def __init__(self, part: int, bucket: str, alpha: float):
        self.part, self.bucket, self.alpha = part, bucket, alpha
        self.rows, self.known, self.opaque = 0, None, False
        self.bracket, self.values, self.lengths = _Bracket(alpha), [], []

    def push(self, kind, value, state) -> None:
        if kind == 0:  # a saved state: whatever came before is irrelevant
            self.known = state
            return
        self.rows += 1
        if self.known is not None:
            self.known = step(*self.known, value, self.alpha)
            return
        self.bracket.push(value)
        if self.bracket.merged:
            self.values, self.lengths = [], []
        elif self.values and self.values[-1] == value:
            self.lengths[-1] += 1
        elif len(self.values) < MAX_RUNS:
            self.values.append(value)
            self.lengths.append(1)
        else:
            self.opaque = True

    def row(self) -> tuple:
        if self.known is not None:
            return (self.part, self.bucket, self.rows, True, False, *self.known, [], [])
        merged = self.bracket.merged
        # The state is exact when merged, a first guess otherwise. How many events came before is
        # not known here: counts are added up in sequence.
        values, lengths = ([], []) if self.opaque else (self.values, self.lengths)
        return (self.part, self.bucket, self.rows, merged, self.opaque and not merged, *self.bracket.low, None, values, lengths)


def _summary_of(part: int, bucket: str, known: tuple | None, values: np.ndarray, alpha: float) -> tuple:
    """A stretch: its saved state, if it has one, and all values behind it."""
    inside = known is None or (known[2] and LOW <= known[0] <= HIGH and 0.0 <= known[1] <= (HIGH - LOW) ** 2)
    if len(values) > TAIL and inside and LOW <= values.min() and values.max() <= HIGH:
        end = _Bracket(alpha)
        for v in values[-TAIL:].tolist():
            end.push(v)
        if end.merged:
            count = None if known is None else known[2] + len(values)
            return (part, bucket, len(values), True, False, *end.low, count, [], [])
    whole = _Stretch(part, bucket, alpha)
    if known is not None:
        whole.push(0, None, known)
    for v in values.tolist():
        whole.push(1, v, None)
    return whole.row()


def _segments(batch: pa.RecordBatch) -> Iterator[tuple[int, int]]:
    """First and last place of each run of rows of one bucket and kind."""
    n = batch.num_rows
    new = np.zeros(n, bool)
    new[0] = True
    for name in ("bucket", "kind"):
        at = batch.column(name).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        new[1:] |= at[1:] != at[:-1]
    cuts = [*np.flatnonzero(new).tolist(), n]
    yield from zip(cuts[:-1], cuts[1:], strict=True)


def _floats(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(float)


def _state_in(batch: pa.RecordBatch, names: tuple[str, str, str], at: int) -> tuple | None:
    mean, variance, count = (batch.column(n)[at].as_py() for n in names)
    return None if count is None else (mean, variance, int(count))


_SAVED, _START_NAMES = ("s_mean", "s_variance", "s_count"), ("i_mean", "i_variance", "i_count")


def _summarise(alpha: float):
    """The first and the last stretch of each partition: only they can share a bucket with a neighbour."""
    schema = _arrow(_SUMMARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, cur = None, None  # cur: part, bucket, saved state, values behind it
        for batch in batches:
            if not batch.num_rows:
                continue
            for i, j in _segments(batch):
                bucket = batch.column("bucket")[i].as_py()
                if cur is None or cur[1] != bucket:
                    if cur is not None and first is None:
                        first = _summary_of(*cur[:3], np.concatenate([np.zeros(0), *cur[3]]), alpha)
                    cur = [batch.column(PART)[i].as_py(), bucket, None, []]
                if batch.column("kind")[i].as_py() == 0:  # a saved state: whatever came before is irrelevant
                    cur[2:] = _state_in(batch, _SAVED, j - 1), []
                else:
                    cur[3].append(_floats(batch.column("value").slice(i, j - i)))
        last = None if cur is None else _summary_of(*cur[:3], np.concatenate([np.zeros(0), *cur[3]]), alpha)
        ends = [x for x in (first, last) if x is not None]
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*ends), schema)], schema=schema)

    return run


def _arrow(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(schema))


def _sequence(stretches: list[dict], alpha: float, replayed: dict) -> tuple[list[tuple], list[tuple]]:
    """Proven start states of stretches that continue a bucket, and replays still needed for the rest.

    ``stretches`` has at most two entries per partition. ``replayed`` maps
    (partition, bucket, start state) to the end state of an earlier replay.
    """
    starts, wanted = [], []
    by_bucket: dict[str, list[dict]] = {}
    for r in stretches:
        by_bucket.setdefault(r["bucket"], []).append(r)
    for bucket, chain in by_bucket.items():
        chain.sort(key=lambda r: r[PART])
        state, proven, asked = (0.0, 0.0, 0), True, []
        for r in chain:
            place = (r[PART], bucket)
            if proven and state[2]:
                starts.append((*place, *state))
            count = r["count"] if r["count"] is not None else state[2] + r["rows"]
            if r["merged"]:
                state, proven = (r["mean"], r["variance"], count), True
            elif not r["opaque"]:
                state = replay_runs(state, zip(r["run_value"], r["run_length"]), alpha)
            elif (*place, state) in replayed:
                state = replayed[(*place, state)]
            else:
                asked.append((r[PART], bucket, *state))
                state, proven = (r["mean"], r["variance"], count), False
        # What only the tail of the chain needs is left to the final replay.
        last = chain[-1][PART]
        wanted += [a for a in asked if a[0] < last]
    return starts, wanted


_START = f"{PART} int, bucket string, i_mean double, i_variance double, i_count long"


def _fold(values: list, state: tuple, alpha: float) -> tuple[list, tuple]:
    """z of each value and the state behind the last; every step as in ``step``."""
    mean, variance, count = state
    rest, scores = 1 - alpha, []
    for value in values:
        diff = value - mean
        if count >= MIN_POINTS:
            scores.append(diff / (variance**0.5 if variance > 0 else 1.0))
        else:
            scores.append(0.0)
        if count:
            mean, variance = alpha * value + rest * mean, rest * (variance + alpha * diff * diff)
        else:
            mean, variance = value, 0.0
        count += 1
    return scores, (mean, variance, count)


_ENDS = f"{PART} int, {STATE_SCHEMA}"


def _replay(alpha: float, threshold: float, scored: pa.Schema | None, ends: pa.Schema | None):
    """Scores, end states (kind 2) or both, each with nulls in the columns of the other."""
    names = [f.name for f in scored or []] + [f.name for f in ends or []]

    def told(found: dict, n: int) -> pa.RecordBatch:
        fields = [*(scored or []), *(ends or [])]
        return pa.RecordBatch.from_arrays([found.get(f.name, pa.nulls(n, f.type)) for f in fields], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cur, state, over = None, None, []
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            values, scores = _floats(batch.column("value")), np.zeros(n)
            for i, j in _segments(batch):
                place = (batch.column(PART)[i].as_py(), batch.column("bucket")[i].as_py())
                if cur != place:
                    if cur is not None:
                        over.append((*cur, *state))
                    cur, state = place, _state_in(batch, _START_NAMES, i) or (0.0, 0.0, 0)
                if batch.column("kind")[i].as_py() == 0:
                    state = _state_in(batch, _SAVED, j - 1)
                else:
                    scores[i:j], state = _fold(values[i:j].tolist(), state, alpha)
            if scored is not None:
                made = {"kind": batch.column("kind"), "z_raw": pa.array(scores), "is_anomaly": pa.array(np.abs(scores) > threshold)}
                kept = {f.name: batch.column(f.name).cast(f.type) for f in scored if f.name not in made}
                yield told({**kept, **made}, n)
        if cur is not None:
            over.append((*cur, *state))
        if ends is not None and over:
            found = {f.name: pa.array(c, f.type) for c, f in zip(zip(*over), ends)}
            yield told(found | {"kind": pa.array([2] * len(over), pa.int32())}, len(over))

    return run


class EwmaRun:
    """Scores and final states of one set of events; both read the same ordered layout."""

    def __init__(self, events: DataFrame, order=("ts", "event_id"), states: DataFrame | None = None,
                 alpha: float = ALPHA, threshold: float = THRESHOLD, partitions: int | None = None, settled: bool = False):
        self.alpha, self.threshold, self.order = alpha, threshold, list(order)
        keys = [F.col(c).alias(f"k_{c}") for c in self.order]
        rows = events.select(
            bucket_of(F.col("service"), F.col("event_type")).alias("bucket"), F.lit(1).alias("kind"), *keys,
            severity_value(F.col("severity")).alias("value"),
            F.lit(None).cast("double").alias("s_mean"), F.lit(None).cast("double").alias("s_variance"),
            F.lit(None).cast("long").alias("s_count"),
        )
        if states is not None:
            saved = states.select(
                "bucket", F.lit(0).alias("kind"),
                *[F.lit(None).cast(dict(rows.dtypes)[f"k_{c}"]).alias(f"k_{c}") for c in self.order],
                F.lit(None).cast("double").alias("value"),
                F.col("mean").alias("s_mean"), F.col("variance").alias("s_variance"), F.col("count").alias("s_count"),
            )
            rows = rows.unionByName(saved)
        self.layout = ordered_layout(rows, ["bucket", "kind"], [f"k_{c}" for c in self.order], partitions, settled=settled)
        self._starts = self._resolve()
        self._kept: DataFrame | None = None

    def _resolve(self) -> DataFrame:
        """Start states of the stretches that continue a bucket: at most one per partition."""
        spark = self.layout.sparkSession
        self.rounds = 0
        # Only buckets that lie in several partitions have starts to find, at most one per partition boundary; the others are not looked at.
        spans = self.layout.groupBy("bucket").agg(F.min(PART).alias("lo"), F.max(PART).alias("hi")).where("lo < hi").select("bucket").collect()
        if not spans:
            return F.broadcast(literal_table(spark, [], _START))
        shared = F.broadcast(literal_table(spark, [tuple(r) for r in spans], "bucket string"))
        found = self.layout.join(shared, "bucket", "left_semi").select(*self.layout.columns).mapInArrow(_summarise(self.alpha), _SUMMARY)
        stretches = [r.asDict() for r in found.collect()]  # two rows per partition
        replayed: dict = {}
        while True:
            starts, wanted = _sequence(stretches, self.alpha, replayed)
            if not wanted:
                return F.broadcast(literal_table(spark, starts, _START))
            self.rounds += 1
            asked = {(part, bucket): (mean, variance, count) for part, bucket, mean, variance, count in wanted}
            table = F.broadcast(literal_table(spark, wanted, _START))
            for e in self._states(table, sorted({w[0] for w in wanted})).collect():
                if (e[PART], e["bucket"]) in asked:
                    key = (e[PART], e["bucket"], asked[(e[PART], e["bucket"])])
                    replayed[key] = (e["mean"], e["variance"], e["count"])

    def _with_starts(self, starts: DataFrame) -> DataFrame:
        return self.layout.join(starts, [PART, "bucket"], "left")

    def _states(self, starts: DataFrame, parts: list[int] | None = None) -> DataFrame:
        rows = self._with_starts(starts)
        if parts is not None:  # replays of some stretches: at most two buckets per listed partition
            asked = F.broadcast(starts.select(PART, "bucket"))
            rows = rows.filter(F.col(PART).isin(parts)).join(asked, [PART, "bucket"], "left_semi")
        return rows.mapInArrow(_replay(self.alpha, self.threshold, None, _arrow(_ENDS)), _ENDS)

    def _scored(self, ends: bool) -> DataFrame:
        kinds = dict(self.layout.dtypes)
        schema = ", ".join(f"k_{c} {kinds[f'k_{c}']}" for c in self.order) + ", kind int, z_raw double, is_anomaly boolean"
        whole = f"{schema}, {_ENDS}" if ends else schema
        return self._with_starts(self._starts).mapInArrow(
            _replay(self.alpha, self.threshold, _arrow(schema), _arrow(_ENDS) if ends else None), whole
        )

    def keep(self) -> None:
        """Store scores and end states of one replay; both are read from there."""
        path, found = scratch_path(self.layout.sparkSession, "replayed"), self._scored(True)
        found.write.parquet(path)
        self._kept = self.layout.sparkSession.read.schema(found.schema).parquet(path)

    def scores(self) -> DataFrame:
        """Order columns with z (3 decimals) and flag; the flag uses the unrounded z."""
        out = self._scored(False) if self._kept is None else self._kept
        return out.filter("kind = 1").select(
            *[F.col(f"k_{c}").alias(c) for c in self.order], F.round("z_raw", 3).alias("z_score"), "is_anomaly"
        )

    def states(self) -> DataFrame:
        """Final state per bucket."""
        ends = self._states(self._starts) if self._kept is None else self._kept.filter("kind = 2")
        last = ends.groupBy("bucket").agg(F.max_by(F.struct("mean", "variance", "count"), PART).alias("s"))
        return last.select("bucket", "s.*")


def _run(events: DataFrame, states: DataFrame | None, options: dict) -> tuple[DataFrame, EwmaRun, list[str]]:
    """The events, stored, and their run: later steps read only the columns that they need."""
    spark = events.sparkSession
    shared_folder(spark)
    path = scratch_path(spark, "described")
    events.write.parquet(path)
    events = spark.read.schema(events.schema).parquet(path)
    order = list(options.get("order", ("ts", "event_id")))
    return events, EwmaRun(events.dropna(subset=order), states=states, settled=True, **options), order


def _with_scores(events: DataFrame, run: EwmaRun, order: list[str]) -> DataFrame:
    return events.join(run.scores(), order, "left").withColumn("is_anomaly", F.coalesce("is_anomaly", F.lit(False)))


def detect_and_keep(events: DataFrame, states: DataFrame | None = None, **options) -> tuple[DataFrame, DataFrame]:
    """``detect``, and the states of all buckets after these events."""
    events, run, order = _run(events, states, options)
    run.keep()
    return _with_scores(events, run, order), run.states()


def detect(events: DataFrame, states: DataFrame | None = None, **options) -> DataFrame:
    """Events (with service, event_type, severity) plus ``z_score`` and ``is_anomaly``.

    Only keys travel through the ordered layout; the other columns meet the
    scores in one join on the event key. The events are settled first, so a model
    that classified them is asked once. Events without a time or id have no place in the
    order: they are kept, with a null score and no anomaly.
    """
    return _with_scores(*_run(events, states, options))


def snapshot(states: DataFrame) -> DataFrame:
    """States for display: 3 decimals, and whether a bucket has enough points."""
    return states.select(
        "bucket", F.round("mean", 3).alias("mean"), F.round("variance", 3).alias("variance"),
        F.when(F.col("variance") > 0, F.round(F.sqrt("variance"), 3)).otherwise(0.0).alias("std"),
        "count", F.when(F.col("count") >= MIN_POINTS, "active").otherwise("training").alias("status"),
    )
