"""Ordered layout: the common ground of everything that depends on row order.

A window over one group puts that group into one task. When one group may hold
a third of all rows that task decides the run time, or fails. Here the rows are
range-partitioned on (group, order) instead: a hot group spreads over as many
partitions as its size asks for, every partition holds one contiguous stretch,
and only small per-partition summaries have to be put in sequence.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import shared_folder, task_slots
from .sizes import broadcast_if_small

PART = "part_no"
ROWS_PER_PARTITION = 20_000  # below this a further task costs more than it saves
SLOT_ROWS, SAMPLE_PER_SLOT = 250_000, 100  # rows a task ranks, and how many of them the bounds are made of
MAX_OFFSETS = 100_000  # counts of groups and slots that travel to all tasks
MAX_ROWS_PER_PARTITION = 2_000_000  # beyond this a partition is cut, however few shuffle partitions the session asks for


def ordered_layout(
    df: DataFrame, group: Sequence[str], order: Sequence[str], partitions: int | None = None, settled: bool = False
) -> DataFrame:
    """Rows sorted over all partitions by (group, order), with the partition number as a column.

    Partition bounds come from sampling, so a second evaluation could cut
    elsewhere: the layout is checkpointed to the shared folder, where it also
    survives the loss of executors. ``settled`` input is cheap to read again, such as columns of a table.
    """
    spark = df.sparkSession
    shared_folder(spark)
    keys = [*group, *order]
    # Range partitioning reads its input twice (to sample, then to move), so what leads here is settled first.
    df = df if settled else df.checkpoint(eager=True)
    if partitions is None:
        rows = df.count()
        partitions = max(1, min(task_slots(spark), rows // ROWS_PER_PARTITION), rows // MAX_ROWS_PER_PARTITION)
    cut = df.repartitionByRange(partitions, *keys).sortWithinPartitions(*keys)
    return cut.withColumn(PART, F.spark_partition_id()).checkpoint(eager=True)


def numbered(df: DataFrame, order: Sequence[str], name: str, partitions: int | None = None) -> DataFrame:
    """``df`` with its place in the order over the whole table, from 0, in column ``name``: one summary row per partition is sequenced."""
    laid = ordered_layout(df, [], order, partitions)
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    starts = laid.groupBy(PART).agg(F.count(F.lit(1)).alias("_n")).select(PART, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    nth = F.row_number().over(Window.partitionBy(PART).orderBy(*order)) - 1
    return laid.withColumn(name, nth).join(F.broadcast(starts), PART).withColumn(
        name, (F.col("_start") + F.col(name)).cast("long")
    ).drop(PART, "_start")


def running_totals(
    df: DataFrame, group: Sequence[str], order: Sequence[str], amounts: dict[str, str], partitions: int | None = None
) -> DataFrame:
    """Inclusive running sums per group; ``amounts`` maps new column to summed column.

    ``(group, order)`` must be unique. Local sums run per (group, partition);
    each gets the total of the group's earlier partitions, of which there are at
    most as many as partitions.
    """
    laid = ordered_layout(df, group, order, partitions)
    by_part = laid.groupBy(*group, PART).agg(*[F.sum(src).alias(f"_t_{new}") for new, src in amounts.items()])
    before = Window.partitionBy(*group).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select(
        *group, PART,
        *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in amounts],
    )
    local = Window.partitionBy(*group, PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    summed = laid.withColumns({f"_s_{new}": F.sum(src).over(local) for new, src in amounts.items()})
    joined = summed.join(offsets, [*group, PART])
    return joined.withColumns({new: F.col(f"_s_{new}") + F.col(f"_o_{new}") for new in amounts}).drop(
        PART, *[f"{p}{new}" for new in amounts for p in ("_s_", "_o_")]
    )


def percentile_rank(
    df: DataFrame, group: str, value: str, name: str, partitions: int | None = None, settled: bool = False
) -> DataFrame:
    """Average rank of a value within its group over the group's size (ties share their mean rank).

    Rows move once. Bounds from a sample cut the order of (group, value) into slots. Slots are counted from these two columns alone, and a row's rank is
    that in its slot plus the rows of the group's earlier slots. A bound is a slot of its own, whose rows share one rank and go to any task: so a value that many
    rows share makes no task larger. The rows are settled first, as they are read several times (``settled`` rows come from a table). Rows without group or
    value keep a null rank.
    """
    shared_folder(df.sparkSession)
    df = df if settled else df.checkpoint(eager=True)
    keyed = df.select(group, value).filter(F.col(group).isNotNull() & F.col(value).isNotNull())
    rows = keyed.count()
    if partitions is None:
        partitions = max(1, min(task_slots(df.sparkSession), rows // ROWS_PER_PARTITION), rows // SLOT_ROWS)
    bounds = _bounds(keyed, rows, partitions)
    within = Window.partitionBy(group).orderBy("_slot")
    counts = _slotted(keyed, group, value, bounds).groupBy(group, "_slot").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        group, "_slot", "_n", (F.sum("_n").over(within) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(group)).alias("_size")
    ).checkpoint(eager=True)
    ranked = ranked_rows(df, group, value, bounds, partitions)
    rank = F.col("_before") + F.when(F.col("_slot") % 2 == 1, (F.col("_n") + 1) / F.lit(2.0)).otherwise(F.col("_rank"))
    others = [c for c in df.columns if c not in (group, value)]
    return ranked.join(broadcast_if_small(offsets, MAX_OFFSETS), [group, "_slot"], "left").select(group, value, *others, (rank / F.col("_size")).alias(name))


def ranked_rows(df: DataFrame, group: str, value: str, bounds: pa.Table, partitions: int) -> DataFrame:
    """Rows with ``_slot`` and their ``_rank`` in it: a stretch between two bounds lies in one task, all other rows in any."""
    anywhere = F.monotonically_increasing_id() % partitions
    task = F.when(F.col("_slot").isNull() | (F.col("_slot") % 2 == 1), anywhere).otherwise((F.col("_slot") / 2).cast("long"))
    moved = _slotted(df, group, value, bounds).withColumn("_task", F.pmod(task, F.lit(partitions)).cast("int")).repartitionById(partitions, "_task")
    return moved.withColumn("_rank", F.arrow_udf(_mean_rank, "double")(group, value, "_slot"))


def _mean_rank(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Mean rank of a row's value among the rows of its group and slot, for all rows of a task: three columns are held and sorted, the rows themselves are not."""
    held = list(batches)
    if not held:
        return
    group, value, slot = (pa.chunked_array([h[i] for h in held]).combine_chunks() for i in range(3))
    full = np.asarray(slot.is_valid())
    some = pa.array(full)
    _, values = np.unique(np.asarray(value.filter(some)), return_inverse=True)
    codes = np.asarray(group.filter(some).dictionary_encode().indices)
    _, pair = np.unique(np.asarray(slot.filter(some)).astype(np.int64) * (int(codes.max(initial=0)) + 1) + codes, return_inverse=True)
    key = pair * (int(values.max(initial=0)) + 1) + values
    order = np.argsort(key)
    new = np.diff(key[order], prepend=-1) != 0
    starts, pairs = np.flatnonzero(new), pair[order]
    run = np.cumsum(new) - 1
    ends, before = np.append(starts[1:], len(order)), np.searchsorted(pairs, pairs[starts])
    mean = (starts + 1 - before + ends - before) / 2.0
    placed = np.empty(len(order))
    placed[order] = mean[run]
    out = np.full(len(full), np.nan)
    out[full] = placed
    done = 0
    for h in held:
        yield pa.array(out[done : done + len(h[0])], from_pandas=True)
        done += len(h[0])


def _bounds(keyed: DataFrame, rows: int, parts: int) -> pa.Table:
    """Different pairs that cut the sorted rows into about ``parts`` stretches of like length."""
    if parts < 2:
        return keyed.limit(0).toArrow()
    some = keyed.sample(min(1.0, SAMPLE_PER_SLOT * parts / max(1, rows)), seed=7) if rows > SAMPLE_PER_SLOT * parts else keyed
    laid = some.orderBy(*keyed.columns).toArrow()  # about SAMPLE_PER_SLOT rows per part, of two columns
    cuts = laid.take([len(laid) * i // parts for i in range(1, parts)] if len(laid) else [])
    return cuts.take(np.flatnonzero([i == 0 or cuts.slice(i, 1) != cuts.slice(i - 1, 1) for i in range(len(cuts))]))


def _slotted(df: DataFrame, group: str, value: str, bounds: pa.Table) -> DataFrame:
    """Column ``_slot``: twice the number of bounds below a row, and one more for a row that equals a bound; null without group or value."""
    groups, values = (np.asarray(bounds.column(i).combine_chunks()) for i in (0, 1))
    first = np.flatnonzero([i == 0 or groups[i] != groups[i - 1] for i in range(len(groups))])
    known, starts = groups[first], np.append(first, len(groups))

    def slot(group: pa.Array, value: pa.Array) -> pa.Array:
        full = np.asarray(pc.and_(group.is_valid(), value.is_valid()))
        g, v = (np.asarray(x.filter(pa.array(full))) for x in (group, value))
        place = np.zeros(len(g), int)
        if len(known):
            at = np.searchsorted(known, g)
            place = starts[at]
            met = known[np.minimum(at, len(known) - 1)] == g
            for j in np.unique(at[met]):
                own = met & (at == j)
                place[own] += np.searchsorted(values[starts[j] : starts[j + 1]], v[own])
            bound = np.minimum(place, len(groups) - 1)
            place = 2 * place + ((place < len(groups)) & (groups[bound] == g) & (values[bound] == v))
        out = np.zeros(len(full), int)
        out[full] = place
        return pa.array(out, pa.int64(), mask=~full)

    return df.withColumn("_slot", F.arrow_udf(slot, "long")(group, value))


def first_values(df: DataFrame, column: str, n: int) -> DataFrame:
    """The first ``n`` different texts of a column in their order (null before all): a task keeps ``n`` of them, and no row is moved for it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, null = [], False
        for b in batches:
            texts = b.column(0)
            null = null or texts.null_count > 0
            texts = texts.drop_null() if len(kept) < n else texts.filter(pc.less(texts, kept[-1]))
            if len(texts):
                kept = sorted({*kept, *texts.unique().to_pylist()})[:n]
        yield pa.RecordBatch.from_arrays([pa.array(([None] if null else []) + kept, pa.string())], names=[column])

    return df.select(F.col(column).cast("string").alias(column)).mapInArrow(run, f"`{column}` string").distinct().orderBy(column).limit(n)


def lag_over_all(df: DataFrame, key: str, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Value of the previous row in key order over the whole table, as ``prev_<column>``.

    Within a partition by a window; the first row of a partition takes the last
    row of the nearest earlier non-empty one (one row per partition).
    """
    laid = ordered_layout(df, [], [key], partitions)
    local = Window.partitionBy(PART).orderBy(key)
    inner = laid.withColumns(
        {f"prev_{c}": F.lag(c).over(local) for c in columns} | {"_first": F.row_number().over(local) == 1}
    )
    last = laid.groupBy(PART).agg(F.max_by(F.struct(*columns), key).alias("_last"))
    carry = last.select(PART, F.lag("_last").over(Window.orderBy(PART)).alias("_carry"))
    joined = inner.join(F.broadcast(carry), PART)
    return joined.withColumns(
        {
            f"prev_{c}": F.when(F.col("_first"), F.col(f"_carry.{c}")).otherwise(F.col(f"prev_{c}"))
            for c in columns
        }
    ).drop(PART, "_first", "_carry")
