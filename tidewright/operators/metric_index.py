"""Exact nearest neighbours of two large tables: centres with radii, pruned by the triangle inequality.

1. A bounded number of items, drawn by a hash of their ids, are centres. Every item belongs to its nearest centre; a centre's items are cut
   into rings by their distance from it. The index of a ring is two radii and a count, so it is small whatever the items are:
   at most ``CENTRES`` times ``RINGS`` rows. A ring of more than ``block_rows`` items consists of several blocks, dealt out by hash.
2. First round: every query meets the ring that most likely holds its neighbours, and with that has a k-th best score so far.
3. Second round: a ring whose radii rule out a score that good is not visited. All others are, so the answer is exact; on data without any
   structure nothing is ruled out, and the work is quadratic as in a plain comparison.
4. Blocks that lie together form regions of some megabytes. A query's row travels once to each region that holds a ring for it, and a region is
   copied to several tasks with a share of the queries each; which rings a query meets is decided there. So what travels grows with the number of
   regions and tasks, not with the number of blocks that queries visit, however little can be ruled out.

Distances are Euclidean. Inner products become distances in one more dimension, in which all items lie at the same distance
from the origin; cosines are inner products of unit vectors. A margin covers rounding in distances, and ties are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import scratch_path
from .knn_blocks import TIE_DIGITS, BestK, Points, compare, id_array, matrix, unit_rows

CENTRES, RINGS = 4096, 16
CENTRE_BYTES = 16 << 20
REGION_BYTES = 32 << 20  # vectors of a region, and of the queries it meets in one task
MARGIN = 1e-7  # of the lengths involved: what rounding can do to a distance


def settled(df: DataFrame, name: str) -> DataFrame:
    """``df`` computed once: written to the shared folder and read from there."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _places(m: np.ndarray, metric: str, radius: float, item: bool) -> np.ndarray:
    """Points whose Euclidean distances order items as the metric does."""
    if metric == "l2":
        return m
    if metric == "cosine":
        m = unit_rows(m)
    if not item:
        extra = np.zeros(len(m))
    elif metric == "cosine":  # unit vectors lie on the sphere already; a zero vector is put on it
        extra = (~m.any(axis=1)).astype(float)
    else:
        extra = np.sqrt(np.maximum(radius * radius - (m * m).sum(axis=1), 0.0))
    return np.column_stack((m, extra))


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    sq = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(sq, 0.0))


def _nth(sorted_values: np.ndarray) -> np.ndarray:
    """Number of each value among its equals, from 0."""
    return np.arange(len(sorted_values)) - np.searchsorted(sorted_values, sorted_values, side="left")


@dataclass
class Rings:
    """What tasks know of the index: centres, and per ring its centre, radii, items and blocks."""

    centres: np.ndarray
    cell: np.ndarray
    ring: np.ndarray
    inner: np.ndarray
    outer: np.ndarray
    items: np.ndarray
    blocks: np.ndarray
    metric: str
    radius: float

    def best_scores(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per query and ring: no item of the ring scores higher; and the distance of the ring's centre."""
        at = _places(queries, self.metric, self.radius, item=False)
        away = _distances(at, self.centres)[:, self.cell]
        length = np.sqrt((at * at).sum(1))[:, None]
        least = np.maximum(away - self.outer, self.inner - away) - MARGIN * (length + self.radius)
        least = np.maximum(least, 0.0)
        if self.metric == "l2":
            return -least, away
        return (length * length + self.radius * self.radius - least * least) / 2, away

    def some(self, places: np.ndarray) -> "Rings":
        """Some of the rings, with the centres of these alone."""
        cells, cell = np.unique(self.cell[places], return_inverse=True)
        parts = (a[places] for a in (self.ring, self.inner, self.outer, self.items, self.blocks))
        return Rings(self.centres[cells], cell, *parts, self.metric, self.radius)


def _wanted(bounds: np.ndarray, floors: np.ndarray) -> np.ndarray:
    """Per query and ring: whether the ring may hold one of the best."""
    slack = 2 * 10.0**-TIE_DIGITS + 1e-12 * np.abs(bounds).max(initial=0.0)
    return bounds >= (floors - slack)[:, None]


def _floors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    floors = np.array(column.to_numpy() if isinstance(column, pa.ChunkedArray) else column.to_numpy(zero_copy_only=False), dtype=float)
    return np.where(np.isnan(floors), -np.inf, floors)


def _rows(schema: StructType, columns: list) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    return pa.RecordBatch.from_arrays(
        [v if isinstance(v, pa.Array) else pa.array(v, f.type) for v, f in zip(columns, arrow, strict=True)], schema=arrow
    )


class MetricIndex:
    """An index over items (key, vec); vectors have one length and no nulls, keys are unique."""

    def __init__(self, items: DataFrame, metric: str = "cosine", block_rows: int = 8192, centres: int | None = None):
        self.spark, self.metric, self.block_rows = items.sparkSession, metric, block_rows
        self.n = items.count()
        size = F.size("vec")
        longest = F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda acc, x: acc + x * x)))
        facts = items.agg(F.max(size).alias("dim"), longest.alias("longest")).first()
        self.dim = facts["dim"] or 0
        self.radius = 1.0 if metric == "cosine" else facts["longest"] or 0.0
        wanted = centres or math.isqrt(self.n) + 1
        bound = max(1, min(CENTRES, CENTRE_BYTES // (8 * (self.dim + 1)), wanted))
        drawn = items.select("vec", F.xxhash64("key").alias("h"), "key").orderBy("h", "key").limit(bound).select("vec").toArrow()
        self.centres = _places(matrix(drawn["vec"]), metric, self.radius, item=True) if drawn.num_rows else np.zeros((0, 1))
        self._assign(items)

    def _assign(self, items: DataFrame) -> None:
        centres = self.spark.sparkContext.broadcast(self.centres)
        metric, radius = self.metric, self.radius
        schema = items.select("key", "vec", F.lit(0).alias("cell"), F.lit(0.0).alias("away")).schema

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                far = _distances(_places(matrix(b.column(1)), metric, radius, item=True), centres.value)
                cell = far.argmin(axis=1)
                yield _rows(schema, [b.column(0), b.column(1), cell, far[np.arange(len(cell)), cell]])

        near = settled(items.select("key", "vec").mapInArrow(run, schema), "index-cells")
        steps = [i / RINGS for i in range(1, RINGS)]
        cells = near.groupBy("cell").agg(F.count(F.lit(1)).alias("m"), F.percentile_approx("away", steps, 1000).alias("q"))  # at most CENTRES rows
        rings = F.least(F.lit(RINGS), F.ceil(F.col("m") / self.block_rows)).cast("int")
        # Of the sixteenths those next to the wanted shares; where rings are cut only decides what can be pruned.
        cuts = F.transform(F.sequence(F.lit(1), rings), lambda i: F.get("q", (F.floor(i * RINGS / rings) - 1).cast("int")))
        edges = cells.select("cell", F.slice(cuts, F.lit(1), rings - 1).alias("edges"))
        ring = F.size(F.filter("edges", lambda e: e < F.col("away")))
        ringed = settled(near.join(F.broadcast(edges), "cell").select("key", "vec", "cell", ring.alias("ring"), "away"), "index-rings")
        table = ringed.groupBy("cell", "ring").agg(
            F.count(F.lit(1)).alias("items"), F.min("away").alias("inner"), F.max("away").alias("outer")
        ).orderBy("cell", "ring").toPandas()  # at most CENTRES * RINGS rows
        blocks = np.maximum(1, -(-table["items"].to_numpy(np.int64) // self.block_rows))
        self.rings = Rings(
            self.centres, table["cell"].to_numpy(np.int64), table["ring"].to_numpy(np.int64), table["inner"].to_numpy(float),
            table["outer"].to_numpy(float), table["items"].to_numpy(np.int64), blocks, self.metric, self.radius,
        )
        numbers = self.spark.createDataFrame(
            [(int(c), int(r), i, int(b)) for i, (c, r, b) in enumerate(zip(self.rings.cell, self.rings.ring, blocks))],
            "cell int, ring int, place int, blocks int",
        )
        block = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int")
        self.items = ringed.join(F.broadcast(numbers), ["cell", "ring"]).select("place", block.alias("block"), "key", "vec")
        # Blocks in the order of their rings, cut into regions.
        self.region_rows = max(self.block_rows, REGION_BYTES // (8 * max(1, self.dim)))
        self.block_place = np.repeat(np.arange(len(blocks)), blocks)
        sizes = np.repeat(self.rings.items / blocks, blocks)
        self.region = ((np.cumsum(sizes) - sizes) // self.region_rows).astype(np.int64)

    def _visits(self, queries: DataFrame, need: int, bounded: bool) -> DataFrame:
        """(key, vec, place, block): where each query goes. ``bounded``: to all rings that may beat its ``floor``, without ``vec``; else to a first one."""
        shown = ["key"] if bounded else ["key", "vec"]
        schema = queries.select(*shown, F.lit(0).alias("place"), F.lit(0).alias("block")).schema
        rings = self.spark.sparkContext.broadcast(self.rings)
        one_block = self.block_rows >= 4 * need

        def first(bounds: np.ndarray, away: np.ndarray, r: Rings) -> tuple[np.ndarray, np.ndarray]:
            """(row, ring): of the rings of the best bound the one with the nearest centre, and as many more as hold enough items."""
            best = bounds == bounds.max(axis=1, keepdims=True)
            place = np.where(best, away, np.inf).argmin(axis=1)
            rows, short = np.arange(len(place)), np.flatnonzero(r.items[place] < need)
            if not len(short):
                return rows, place
            more = []
            for i in short:  # small rings: the next best ones as well
                order = np.lexsort((away[i], -bounds[i]))
                more.append(order[: int(np.searchsorted(np.cumsum(r.items[order]), need)) + 1])
            keep = np.setdiff1d(rows, short)
            return np.concatenate((keep, np.repeat(short, [len(m) for m in more]))), np.concatenate((place[keep], *more))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r = rings.value
            for b in batches:
                if not b.num_rows:
                    continue
                m, step = matrix(b.column(1)), max(1, (4 << 20) // max(1, len(r.items)))
                for at in range(0, len(m), step):
                    bounds, away = r.best_scores(m[at : at + step])
                    if bounded:
                        rows, places = np.nonzero(_wanted(bounds, _floors(b.column(2))[at : at + step]))
                    else:
                        rows, places = first(bounds, away, r)
                    times = r.blocks[places]
                    if not bounded and one_block:
                        block, times = (rows + at) % times, np.ones(len(times), np.int64)
                    else:
                        block = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                    rows, places = np.repeat(rows, times) + at, np.repeat(places, times)
                    for c in range(0, len(rows), 1 << 14):
                        part = b.take(pa.array(rows[c : c + (1 << 14)]))
                        yield _rows(schema, [*(part.column(i) for i in range(len(shown))), places[c : c + (1 << 14)], block[c : c + (1 << 14)]])

        columns = ["key", "vec", "floor"] if bounded else ["key", "vec"]
        return queries.select(*columns).mapInArrow(run, schema)

    def _meet(self, visits: DataFrame, k: int, skip_self: bool) -> DataFrame:
        """(query_id, item_id, score): the best k of every block a query visits."""
        metric = self.metric
        visits = settled(visits, "index-visits")
        load = visits.groupBy("place", "block").agg(F.ceil(F.count(F.lit(1)) / self.block_rows).cast("int").alias("slots"))
        left = visits.join(load, ["place", "block"]).withColumn("slot", F.pmod(F.xxhash64("key", F.lit(7)), F.col("slots")).cast("int"))
        right = self.items.join(load, ["place", "block"]).withColumn("slot", F.explode(F.sequence(F.lit(0), F.col("slots") - 1)))
        left, right = (d.select("place", "block", "slot", "key", "vec") for d in (left, right))
        schema = StructType().add("query_id", left.schema["key"].dataType).add("item_id", right.schema["key"].dataType).add("score", "double")
        arrow = to_arrow_schema(schema)

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                return arrow.empty_table()
            ids, m = id_array(b["key"]), matrix(b["vec"])
            order = np.argsort(ids, kind="stable")
            ids, m = ids[order], m[order]
            asking, q = id_array(a["key"]), matrix(a["vec"])
            best = BestK(asking, k, skip_self)
            compare(best, np.arange(len(asking)), Points(q, metric), ids, Points(m, metric))
            rows, found, scores, _ = best.result()
            return pa.table([pa.array(asking[rows].tolist(), arrow[0].type), pa.array(found.tolist(), arrow[1].type), pa.array(scores)], schema=arrow)

        by = ["place", "block", "slot"]
        return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(run, schema)

    def _known(self, queries: DataFrame, k: int, skip_self: bool) -> DataFrame:
        """The queries with their k-th best score of the first round, ``floor``."""
        need = k + (1 if skip_self else 0)
        tried = self._meet(self._visits(queries, need, bounded=False), k, skip_self)
        scores = F.sort_array(F.collect_list("score"), asc=False)  # k rows per visited block
        floors = settled(tried.groupBy("query_id").agg(F.get(scores, F.lit(k - 1)).alias("floor")), "index-floors")
        return queries.join(floors, queries["key"] == floors["query_id"], "left").select("key", "vec", "floor")

    def plan(self, queries: DataFrame, k: int, skip_self: bool = False) -> DataFrame:
        """(key, place, block) of the second round: every block that may hold one of a query's best k."""
        return self._visits(self._known(queries, k, skip_self), k + (1 if skip_self else 0), bounded=True)

    def _regions(self, known: DataFrame) -> DataFrame:
        """(key, vec, floor, region): one row per query and region with a ring that may beat the query's floor."""
        schema = known.select("key", "vec", "floor", F.lit(0).alias("region")).schema
        shared = self.spark.sparkContext.broadcast((self.rings, self.block_place, np.flatnonzero(np.diff(self.region, prepend=-1))))
        names = np.unique(self.region)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            r, block_place, starts = shared.value
            for b in batches:
                if not b.num_rows:
                    continue
                m, floors, step = matrix(b.column(1)), _floors(b.column(2)), max(1, (4 << 20) // max(1, len(block_place)))
                for at in range(0, len(m), step):
                    wanted = _wanted(r.best_scores(m[at : at + step])[0], floors[at : at + step])[:, block_place]
                    rows, regions = np.nonzero(np.logical_or.reduceat(wanted, starts, axis=1))
                    for c in range(0, len(rows), 1 << 14):
                        part = b.take(pa.array(rows[c : c + (1 << 14)] + at))
                        yield _rows(schema, [*part.columns, names[regions[c : c + (1 << 14)]]])

        return known.mapInArrow(run, schema)

    def search(self, queries: DataFrame, k: int, skip_self: bool = False) -> DataFrame:
        """(query_id, item_id, score): at least the best k of every query (key, vec), for the caller to rank."""
        if not self.n:
            schema = StructType().add("query_id", queries.schema["key"].dataType).add("item_id", self.items.schema["key"].dataType).add("score", "double")
            return self.spark.createDataFrame([], schema)
        metric, regions = self.metric, int(self.region[-1]) + 1
        known = self._known(queries, k, skip_self)
        slots = max(-(-queries.count() // self.region_rows), -(-2 * self.spark.sparkContext.defaultParallelism // regions))
        units = [(int(p), int(b), int(r)) for p, b, r in zip(self.block_place, _nth(self.block_place), self.region)]
        table = F.broadcast(self.spark.createDataFrame(units, "place int, block int, region int"))
        left = self._regions(known).withColumn("slot", F.pmod(F.xxhash64("key", F.lit(7)), F.lit(slots)).cast("int"))
        right = self.items.join(table, ["place", "block"]).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
        left, right = left.select("region", "slot", "key", "vec", "floor"), right.select("region", "slot", "place", "key", "vec")
        schema = StructType().add("query_id", left.schema["key"].dataType).add("item_id", right.schema["key"].dataType).add("score", "double")
        arrow, rings = to_arrow_schema(schema), self.spark.sparkContext.broadcast(self.rings)

        def run(a: pa.Table, b: pa.Table) -> pa.Table:
            if not a.num_rows or not b.num_rows:
                return arrow.empty_table()
            ids, place = id_array(b["key"]), b["place"].to_numpy()
            order = np.lexsort((ids, place))
            ids, place, items = ids[order], place[order], Points(matrix(b["vec"])[order], metric)
            starts = np.flatnonzero(np.diff(place, prepend=-1))
            ends, r = np.append(starts[1:], len(place)), rings.value.some(place[starts])
            asking, q = id_array(a["key"]), matrix(a["vec"])
            best, points = BestK(asking, k, skip_self, _floors(a["floor"])), Points(q, metric)
            step = max(64, min(2048, (1 << 20) // len(starts)))
            for at in range(0, len(q), step):
                rows = np.arange(at, min(len(q), at + step))
                bounds, _ = r.best_scores(q[rows])
                for i in np.argsort(-bounds.max(axis=0), kind="stable"):  # the most promising ring first: floors rise
                    here = np.flatnonzero(_wanted(bounds[:, i : i + 1], best.floors[rows]))
                    if len(here):
                        compare(best, rows[here], points, ids, items, starts[i], ends[i])
            rows, found, scores, _ = best.result()
            return pa.table([pa.array(asking[rows].tolist(), arrow[0].type), pa.array(found.tolist(), arrow[1].type), pa.array(scores)], schema=arrow)

        return left.groupBy("region", "slot").cogroup(right.groupBy("region", "slot")).applyInArrow(run, schema)

    def pairs(self, visits: DataFrame) -> int:
        """Pairs of rows that the visits compare."""
        seen = visits.groupBy("place", "block").agg(F.count(F.lit(1)).alias("q"))
        sizes = self.items.groupBy("place", "block").agg(F.count(F.lit(1)).alias("m"))
        return seen.join(sizes, ["place", "block"]).agg(F.sum(F.col("q") * F.col("m")).alias("p")).first()["p"] or 0
