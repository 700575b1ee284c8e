"""Near-duplicate embeddings by sorted projection passes, cosine 0.98 or more, within equal labels.

1. Equal vectors of a label are one node; nodes carry a count.
2. Every node gets a signature of ``BITS`` random hyperplane signs and, per pass, a key: the concatenated signs of ``KEY_BITS`` fresh hyperplanes.
   A pass orders the nodes of a label lexicographically by key. The order over all passes is cut into blocks by position; a
   block also holds the next ``WINDOW`` nodes. Each node is compared with the ``WINDOW`` nodes that follow it, by signature. The number of passes follows from
   the size of the largest label: so many that a pair of the lowest cosine meets in one window at least with probability ``RECALL``.
3. What windows find joins nodes to groups, over all passes. The bound on signature differences lies four standard deviations above what a linked
   pair has, so groups are somewhat larger than the classes sought and hold pairs that no window held.
4. Inside the groups all links are verified and counted by cosine in double precision, in pairs of chunks of at most ``CHUNK`` nodes. So a
   window bounds the search, never the number of partners: a group far larger than a window is counted whole. Tasks give one row per node, never pairs.
   This is quadratic in the number of different vectors of a group, as exact counts of their links demand.
5. Classes are the connected components of the verified links.

Recall was measured against all pairs; see the README. What is reported is exact in the other direction: no link is below the threshold.

Cases: vectors that are null, empty, zero, or hold a null or a non-finite number, and those without a label, link with nothing and are classes of their own.
Vectors of different lengths are not compared. Repeated rows are vectors of their own, linked to one another. component_id is the least
vec_id of the class, null if it has none. An empty table gives an empty result. Only vec_id, embedding and label are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free_name, store
from .jaccard_join import _join_labels as join_labels
from .jaccard_join import by_key
from .order import numbered

COSINE = 0.98
BITS, KEY_BITS, WINDOW, BLOCK = 256, 48, 128, 4096
RECALL = 0.9999
CHUNK, SMALL = 2048, 64  # nodes compared at once; groups of at most SMALL share a task
HOT_SHARE = 1000  # a vector with more than this fraction of all rows is joined by broadcast: fewer than HOT_SHARE of them exist


# --- in tasks ---------------------------------------------------------------------------------------------------------


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length; each row scaled so that squares neither overflow nor vanish."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        m = flat[starts[rows][:, None] + np.arange(n)[None, :]]
        yield rows, m / np.abs(m).max(axis=1, keepdims=True)


def _name_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        kinds, vecs = b.column(1).cast(pa.binary()).to_pylist(), b.column(2)
        offsets = vecs.offsets.to_numpy()
        flat = np.ascontiguousarray(vecs.values.to_numpy(zero_copy_only=False)) + 0.0  # -0.0 and 0.0 are the same number
        names = [
            blake2b(len(k).to_bytes(8) + k + flat[a:z].tobytes(), digest_size=16).digest() for k, a, z in zip(kinds, offsets[:-1], offsets[1:])
        ]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(names, pa.binary()), vecs], names=["vec_id", "kind", "node", "vec"])


def _planes(dim: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([20240601, seed, dim]).standard_normal((dim, bits))


def _sketch(passes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            n = b.num_rows
            marks, keys = np.zeros((n, BITS // 8), np.uint8), np.zeros((n, passes), np.int64)
            for rows, m in _by_length(b.column(2)):
                marks[rows] = np.packbits(m @ _planes(m.shape[1], BITS, 0) > 0, axis=1)
                for p in range(passes):
                    signs = m @ _planes(m.shape[1], KEY_BITS, p + 1) > 0
                    keys[rows, p] = signs @ (1 << np.arange(KEY_BITS - 1, -1, -1, dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([r.tobytes() for r in marks], pa.binary()),
                 pa.ListArray.from_arrays(np.arange(0, n * passes + 1, passes, dtype=np.int32), pa.array(keys.ravel()))],
                names=["kind", "node", "mark", "keys"],
            )

    return run


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least member of each row's component under the pairs (a, b)."""
    top = np.arange(n)
    while len(a):
        low, high = np.minimum(top[a], top[b]), np.maximum(top[a], top[b])
        np.minimum.at(top, high, low)
        while ((up := top[top]) != top).any():
            top = up
        open_ = top[a] != top[b]
        a, b = a[open_], b[open_]
    return top


def _max_difference() -> int:
    """Signs in which a pair of the threshold's cosine differs at most, four standard deviations above the mean."""
    p = math.acos(COSINE) / math.pi
    return math.ceil(BITS * p + 4 * math.sqrt(BITS * p * (1 - p)))


def _window_edges(rows: pa.Table) -> dict | None:
    """Edges of a spanning forest over the pairs of a block that lie in one window and look alike."""
    order = np.argsort(rows.column("position").to_numpy())
    nodes = rows.column("node").to_pylist()
    marks = np.frombuffer(b"".join(rows.column("mark").to_pylist()), np.uint64).reshape(len(nodes), -1)[order]
    row = rows.column("row").to_numpy()[order]  # pass and label
    most, left, right = _max_difference(), [], []
    for at in range(0, len(order), WINDOW):
        a, b = slice(at, at + WINDOW), slice(at, at + 2 * WINDOW)
        differ = np.zeros((len(marks[a]), len(marks[b])), np.uint16)
        for word in range(marks.shape[1]):
            differ += np.bitwise_count(marks[a, word][:, None] ^ marks[b, word][None, :])
        ahead = np.arange(differ.shape[1])[None, :] - np.arange(differ.shape[0])[:, None]
        i, j = np.nonzero((differ <= most) & (ahead > 0) & (ahead <= WINDOW) & (row[a][:, None] == row[b][None, :]))
        left.append(at + i)
        right.append(at + j)
    top = _roots(len(order), np.concatenate(left), np.concatenate(right))
    moved = np.flatnonzero(top != np.arange(len(order)))
    return {"a": [nodes[order[i]] for i in moved], "b": [nodes[order[top[i]]] for i in moved]} if len(moved) else None


def _units(rows: pa.Table) -> np.ndarray:
    ((_, m),) = _by_length(rows.column("vec").combine_chunks())
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def _links(rows: pa.Table) -> dict:
    """Per node of a pair of chunks: vectors of other nodes linked to it, and the node that stands for its part."""
    groups = rows.column("group").to_pylist()
    nodes, weight, side = rows.column("node").to_pylist(), rows.column("n").to_numpy(), rows.column("side").to_numpy()
    by_group: dict[bytes, list[int]] = {}
    for i, g in enumerate(groups):
        by_group.setdefault(g, []).append(i)
    links, other = np.zeros(len(nodes), np.int64), list(nodes)
    for mine in by_group.values():
        at = np.array(mine)
        unit = _units(rows.take(pa.array(at)))
        if side[at].any():
            x, y = np.flatnonzero(side[at] == 1), np.flatnonzero(side[at] == 2)
        else:
            x = y = np.arange(len(at))
        near = unit[x] @ unit[y].T >= COSINE
        if x is y:
            np.fill_diagonal(near, False)
            links[at] += near @ weight[at]
        else:
            links[at[x]] += near @ weight[at[y]]
            links[at[y]] += near.T @ weight[at[x]]
        i, j = np.nonzero(near)
        top = _roots(len(at), x[i], y[j])
        for k in np.flatnonzero(top != np.arange(len(at))):
            other[mine[k]] = nodes[mine[top[k]]]
    return {"node": nodes, "links": links, "other": other}


# --- whole tables -----------------------------------------------------------------------------------------------------


def n_passes(largest: int, recall: float = RECALL) -> int:
    """Passes until a pair of the threshold's cosine has met in a window with probability ``recall``, in a label of so many nodes."""
    alike = 1 - math.acos(COSINE) / math.pi
    hit = alike ** max(0.0, math.log2(max(1, largest) / WINDOW))
    return 2 if hit > 0.99 else max(2, math.ceil(math.log(1 - recall) / math.log(1 - hit)))


def _nodes(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(vec_id, node) of all rows, node null where nothing can be linked; (kind, node, n, first, vec) of all nodes."""
    inner = embeddings.schema["embedding"].dataType.elementType.simpleString()
    inner = inner if inner in ("float", "double") else "double"
    rows = embeddings.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
        F.col("embedding").cast(f"array<{inner}>").alias("vec"),
    )
    finite = F.forall("vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    fit = F.coalesce(F.col("label").isNotNull() & F.exists("vec", lambda x: x != 0) & finite, F.lit(False))
    kind = F.concat_ws(":", F.size("vec").cast("string"), F.col("label"))
    named = store(
        rows.where(fit).select("vec_id", kind.alias("kind"), "vec").mapInArrow(
            _name_nodes, f"vec_id long, kind string, node binary, vec array<{inner}>"
        ), "dedup-rows",
    )
    nodes = store(
        named.groupBy("kind", "node").agg(F.count(F.lit(1)).alias("n"), F.min("vec_id").alias("first"), F.first("vec").alias("vec")), "dedup-nodes"
    )
    every = named.select("vec_id", "node").unionByName(rows.where(~fit).select("vec_id", F.lit(None).cast("binary").alias("node")))
    return every, nodes


def window_edges(nodes: DataFrame, passes: int) -> DataFrame:
    """a, b: edges between nodes that look alike in a window of one of the passes."""
    sketched = nodes.select("kind", "node", "vec").mapInArrow(_sketch(passes), "kind string, node binary, mark binary, keys array<long>")
    turns = store(
        sketched.select("kind", "node", "mark", F.posexplode("keys").alias("pass", "key")).select(
            F.xxhash64("pass", "kind").alias("row"), "pass", "kind", "key", "node", "mark"
        ), "dedup-passes",
    )
    placed = numbered(turns, [F.col(c) for c in ("pass", "kind", "key", "node")], "position", "dedup-order")
    block = F.floor(F.col("position") / BLOCK).cast("long")
    # The first nodes of a block also end the windows of the block before.
    both = F.when(F.col("position") % BLOCK < WINDOW, F.array(block, block - 1)).otherwise(F.array(block))
    blocks = placed.select(F.explode(both).alias("block"), "position", "row", "node", "mark").where("block >= 0")
    return by_key(blocks, "block", _window_edges, "a binary, b binary").distinct()


def verified(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """node, links, other: counts and edges of the links inside groups (node, label), chunk against chunk."""
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    members = groups.join(sizes, "label").join(nodes.select("node", "n", "vec"), "node")
    k = F.ceil(F.col("m") / CHUNK).cast("int")
    cut = members.withColumn("k", k).withColumn("chunk", F.pmod(F.xxhash64("node", F.lit(3)), F.col("k")).cast("int"))
    side = lambda o: F.when(F.col("chunk") == o, 0).when(F.col("chunk") < o, 1).otherwise(2)
    turns = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(
        F.least("chunk", o).alias("i"), F.greatest("chunk", o).alias("j"), side(o).alias("side"))))
    # Small groups share a task, about CHUNK nodes in all; large ones have one per pair of chunks.
    shared = max(1, sizes.where(F.col("m") <= SMALL).agg(F.sum("m").alias("s")).first()["s"] or 0) // CHUNK + 1
    small = F.col("m") <= SMALL
    key = F.when(small, F.pmod(F.xxhash64("label"), F.lit(shared)).cast("long")).otherwise(F.xxhash64("label", "t.i", "t.j"))
    # A group's name holds the pair of chunks, so a key hit twice does no harm.
    name = F.concat(F.col("label"), F.encode(F.concat_ws("-", "t.i", "t.j"), "utf-8"))
    blocks = cut.select("label", "m", "node", "n", "vec", turns.alias("t")).select(
        key.alias("key"), name.alias("group"), "node", "n", "vec", F.col("t.side").cast("int").alias("side")
    )
    return store(by_key(blocks, "key", _links, "node binary, links long, other binary"), "dedup-links")


def near_duplicates(embeddings: DataFrame, recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row."""
    rows, nodes = _nodes(embeddings)
    largest = nodes.groupBy("kind").agg(F.count(F.lit(1)).alias("c")).agg(F.max("c").alias("c"), F.sum("c").alias("all")).first()
    own = nodes.select("node", F.col("node").alias("label"))
    counted = None
    classes = own
    if largest["all"]:
        edges = store(window_edges(nodes, n_passes(largest["c"], recall)), "dedup-edges")
        if edges.take(1):
            touched = edges.select(F.col("a").alias("node")).unionByName(edges.select(F.col("b").alias("node"))).distinct()
            groups = join_labels(touched.withColumn("label", F.col("node")), edges)
            counted = verified(nodes, groups)
            true = counted.where("other <> node").select(F.col("node").alias("a"), F.col("other").alias("b")).distinct()
            if true.take(1):
                classes = join_labels(own, true)
    told = nodes.select("node", "n", "first").join(classes, "node")
    least = told.groupBy("label").agg(F.min("first").alias("component_id"))
    told = told.join(least, "label").select("node", "n", "component_id")
    if counted is not None:
        told = told.join(counted.groupBy("node").agg(F.sum("links").alias("links")), "node", "left")
    else:
        told = told.withColumn("links", F.lit(0))
    told = store(told.select("node", "n", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links"), "component_id"), "dedup-told")
    return _per_row(rows, told)


def _per_row(rows: DataFrame, told: DataFrame) -> DataFrame:
    """What is told of nodes, for every row: few hot nodes by broadcast, the rest by a shuffle in which no key is hot."""
    all_rows = told.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = store(told.where(F.col("n") * HOT_SHARE > all_rows).select("node", "n_links", "component_id"), "dedup-hot")
    alone = rows.where("node IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    linked = rows.where("node IS NOT NULL")
    by_broadcast = linked.join(F.broadcast(hot), "node")
    names = hot.select("node")
    by_shuffle = linked.join(F.broadcast(names), "node", "left_anti").join(told.select("node", "n_links", "component_id"), "node")
    columns = ["vec_id", "n_links", "component_id"]
    every = by_broadcast.select(*columns).unionByName(by_shuffle.select(*columns)).unionByName(alone)
    return every.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def keep_one_of_each(embeddings: DataFrame, **how) -> DataFrame:
    """The rows whose vec_id stands for their class, with all columns."""
    key = free_name(embeddings, "kept_id")
    kept = near_duplicates(embeddings, **how).where("kept").select(F.col("vec_id").alias(key)).distinct()
    return embeddings.join(kept, embeddings["vec_id"].cast("long").eqNullSafe(F.col(key)), "left_semi")


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reached AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n_links, 0) AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN least USING (vec_id) LEFT JOIN counted USING (vec_id)
"""
