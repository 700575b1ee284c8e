"""Near-duplicate documents by a chosen-path join on five-word shingles, Jaccard 0.8 or more.

1. Texts of equal shingle sets are one node with a signature of minimum hashes.
2. Chosen path: all nodes start in one bucket per run. A bucket is split by the shingles that its nodes chose at positions
   drawn from the bucket's own path; each node follows ``FANOUT`` of them. Buckets of ``SMALL`` nodes and those at ``DEPTH`` are leaves.
   A pair of similarity 0.8 stays together in a leaf of one run with probability 0.94, so ``RUNS`` runs find 999 of 1,000 such pairs.
3. Leaves are compared by brute force on whole shingle sets. As only classes are sought, a leaf gives the edges of a spanning
   forest, never all pairs, and leaves whose nodes are in one class already are skipped. Leaves with more than fits into a task
   are compared in chunks, then the chunks' classes by a few of their members, then all nodes outside the largest class with every chunk;
   those that are mostly one class already begin with the last of these steps, which meets every pair of different classes.
4. Links are counted within classes, each pair once, in blocks that give one count per node. So pairs that no leaf held are
   found as well, if their class is connected.

Words are separated by ASCII white space. Texts of fewer than five words have one shingle, all their words. Null texts and texts without
words have no shingles and no links; each is a class of its own. Repeated rows are documents of their own and link to one
another. class_id is the least doc_id of the class, null if all are. An empty table gives an empty result. Only the named columns of the
input are used. Sets are told apart by 64-bit hashes of words and shingles. Copies are never paired row by row: what is quadratic is the comparison
of different texts inside a class, as counting their links exactly demands.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows, store

WORDS = 5
POSITIONS = 40  # minimum hashes of a signature
RUNS, FANOUT, DEPTH, SMALL = 3, 2, 3, 64
ALIKE = 22  # positions in which a pair of a leaf agrees at least; 1 pair in 10,000 of similarity 0.8 has fewer
CHUNK_SHINGLES, CHUNK_NODES = 1_000_000, 1024  # what a task compares at once
SHINGLE_BLOCK = 8192

_RNG = np.random.default_rng(20240501)
_MIX = _RNG.integers(1, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_HASH = _RNG.integers(1, 1 << 63, POSITIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


# --- one text ---------------------------------------------------------------------------------------------------------


def shingles(text: str | None) -> np.ndarray:
    """The sorted set of the hashes of all runs of five words."""
    from xxhash import xxh3_64_intdigest

    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
    if len(h) < WORDS:
        h = np.concatenate((h, np.full(WORDS - len(h), 0xABCDEF12345, np.uint64)))
    n = len(h) - WORDS + 1
    key = np.zeros(n, np.uint64)
    for k in range(WORDS):
        key += h[k : k + n] * _MIX[k]
    key ^= key >> np.uint64(31)
    key *= np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    return np.unique(key)


def signature(found: np.ndarray) -> np.ndarray:
    low = np.full(POSITIONS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(found), SHINGLE_BLOCK):
        low = np.minimum(low, (found[k : k + SHINGLE_BLOCK, None] * _HASH[None, :]).min(axis=0))
    return (low >> np.uint64(33)).astype(np.int32)


def node_of(found: np.ndarray) -> int:
    """A name for the whole set."""
    total = np.uint64(len(found)) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (found ^ (found >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    total += (mixed ^ (mixed >> np.uint64(32))).sum(dtype=np.uint64)
    return int(total.astype(np.int64))


def _describe(ids, hashes, texts) -> dict:
    nodes, sizes, marks = [], [], []
    for t in texts.to_pylist():
        found = shingles(t)
        nodes.append(node_of(found) if len(found) else None)
        sizes.append(len(found))
        marks.append(signature(found) if len(found) else [])
    return {"doc_id": ids, "text_hash": hashes, "node": nodes, "n": sizes, "mark": marks}


def _name_sets(texts) -> dict:
    sets = [shingles(t) for t in texts.to_pylist()]
    return {"node": [node_of(s) if len(s) else None for s in sets], "tokens": [s.view(np.int64) for s in sets]}


# --- groups in tasks --------------------------------------------------------------------------------------------------


def by_key(df: DataFrame, key: str, fn: Callable[[pa.Table], dict | None], schema: str) -> DataFrame:
    """``fn`` on the rows of each key; keys are dealt out over the shuffle partitions and held one at a time."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    parsed = _parse_datatype_string(schema)
    arrow = to_arrow_schema(parsed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def done() -> Iterator[pa.RecordBatch]:
            out = fn(pa.Table.from_batches(held))
            held.clear()
            if out is not None:
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in arrow], schema=arrow)

        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(at).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if held and held[0].column(at)[0].as_py() != keys[a]:
                    yield from done()
                held.append(batch.slice(a, b - a))
        if held:
            yield from done()

    at = df.columns.index(key)
    return df.repartition(key).sortWithinPartitions(key).mapInArrow(run, parsed)


def _sets(rows: pa.Table) -> list[np.ndarray]:
    return [t.values.to_numpy() for chunk in rows.column("tokens").chunks for t in chunk]


def similar(sets: list[np.ndarray], others: list[np.ndarray] | None = None) -> np.ndarray:
    """Which sets are 0.8 similar or more: 9 * common >= 4 * (sum of sizes). Exact, by blocks of shared tokens."""
    every = sets + (others or [])
    sizes = np.array([len(s) for s in every])
    if others is None and len(sets) == 2:
        common = np.zeros((2, 2))
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
        common[0, 0], common[1, 1] = sizes
    else:
        owner = np.repeat(np.arange(len(every)), sizes)
        _, column, seen = np.unique(np.concatenate(every), return_inverse=True, return_counts=True)
        shared = np.cumsum(seen > 1) - 1
        keep = seen[column] > 1
        owner, column = owner[keep], shared[column[keep]]
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        m, width = len(sets), 4096
        common = np.zeros((m, len(others) if others is not None else m), np.float32)
        for a in range(0, int(column[-1]) + 1 if len(column) else 0, width):
            i, j = np.searchsorted(column, (a, a + width))
            block = np.zeros((len(every), width), np.float32)
            block[owner[i:j], column[i:j] - a] = 1
            common += block[:m] @ (block[m:] if others is not None else block).T
        if others is None:
            common[np.arange(m), np.arange(m)] = sizes
    left, right = sizes[: len(sets)], sizes[len(sets) :] if others is not None else sizes
    return 9 * common >= 4 * (left[:, None] + right[None, :])


def _promising(rows: pa.Table) -> dict | None:
    """Nodes of a leaf that agree with some other in enough positions, and the chunks that their shingles need."""
    nodes, sizes = rows.column("node").to_numpy(), rows.column("n").to_numpy()
    marks = np.array(rows.column("mark").to_pylist(), np.int32)
    good = np.zeros(len(nodes), bool)
    for i in range(len(nodes)):
        near = ((marks == marks[i]).sum(axis=1) >= ALIKE) & (5 * np.minimum(sizes, sizes[i]) >= 4 * np.maximum(sizes, sizes[i]))
        near[i] = False
        good[i] = near.any()
    if not good.any():
        return None
    k = -(-int(sizes[good].sum()) // CHUNK_SHINGLES)
    return {
        "run": rows.column("run").to_numpy()[good], "leaf": rows.column("leaf").to_numpy()[good], "node": nodes[good], "n": sizes[good],
        "k": np.full(int(good.sum()), k),
    }


def _forest(rows: pa.Table) -> dict | None:
    """Edges between labels that join what is similar: at most one for each label."""
    labels = rows.column("label").to_numpy()
    names, group = np.unique(labels, return_inverse=True)
    if len(names) < 2:
        return None
    near = similar(_sets(rows))
    top = np.arange(len(names))
    edges = []
    for i in range(len(labels)):
        for g in np.unique(group[near[i]]):
            a, b = _top(top, group[i]), _top(top, g)
            if a != b:
                top[b] = a
                edges.append((names[group[i]], names[g]))
    return {"a": [a for a, _ in edges], "b": [b for _, b in edges]} if edges else None


def _top(top: np.ndarray, i: int) -> int:
    while top[i] != i:
        top[i] = top[top[i]]
        i = top[i]
    return int(i)


def _degrees(rows: pa.Table) -> dict:
    """Documents linked to each node: between the two sides of a block, or within its one side."""
    nodes, weight, side = (rows.column(c).to_numpy() for c in ("node", "n_docs", "side"))
    sets = _sets(rows)
    if not side.any():
        near = similar(sets)
        return {"node": nodes, "links": (near @ weight) - weight}
    left, right = np.flatnonzero(side == 1), np.flatnonzero(side == 2)
    if not len(left) or not len(right):
        return {"node": nodes, "links": np.zeros(len(nodes), np.int64)}
    near = similar([sets[i] for i in left], [sets[i] for i in right])
    return {
        "node": np.concatenate((nodes[left], nodes[right])),
        "links": np.concatenate((near @ weight[right], near.T @ weight[left])),
    }


# --- whole tables -----------------------------------------------------------------------------------------------------


def _leaves(nodes: DataFrame) -> DataFrame:
    """run, leaf, node, size: buckets of two nodes or more at which the chosen paths end."""
    spark = nodes.sparkSession
    runs = F.explode(F.array(*[F.struct(F.lit(r).alias("run"), F.xxhash64(F.lit(r)).alias("path")) for r in range(RUNS)])).alias("at")
    open_ = nodes.select("node", "mark", runs).select("node", "mark", "at.run", "at.path")
    leaves: DataFrame | None = None
    for level in range(1, DEPTH + 1):
        first = F.pmod(F.xxhash64("path", F.lit(0)), F.lit(POSITIONS))
        steps = [first] + [
            F.pmod(first + 1 + F.pmod(F.xxhash64("path", F.lit(j)), F.lit(POSITIONS - 1)), F.lit(POSITIONS)) for j in range(1, FANOUT)
        ]
        chosen = F.explode(F.array(*[F.xxhash64("path", s, F.get("mark", s.cast("int"))) for s in steps])).alias("path")
        open_ = open_.select("node", "mark", "run", chosen)
        rows = store(open_.select("node", "run", "path"), "paths")
        sizes = rows.groupBy("path").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
        kept = store(rows.join(sizes, "path"), "buckets")
        ends = kept.where((F.col("size") <= SMALL) | F.lit(level == DEPTH))
        found = ends.select("run", F.col("path").alias("leaf"), "node", "size")
        leaves = found if leaves is None else leaves.unionByName(found)
        if level < DEPTH:
            large = store(kept.where(F.col("size") > SMALL).select("path").distinct(), "large")
            if not large.take(1):
                break
            # Paths are made again from the marks: the few that stay open travel, not the nodes.
            open_ = open_.join(large, "path", "left_semi")
    return leaves


def _new_names(edges: DataFrame) -> DataFrame:
    """label, to: for all labels of edges the least that they are joined with: hook to the least neighbour, then jump."""
    both = store(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    names = both.select("a").distinct().withColumn("to", F.col("a"))
    while True:
        near = both.join(names.select(F.col("a").alias("b"), "to"), "b").groupBy("a").agg(F.min("to").alias("least"))
        hooked = names.join(near, "a").select("a", F.least("to", "least").alias("new"), F.col("to").alias("old"))
        after = hooked.alias("x").join(
            hooked.select(F.col("a").alias("_a"), F.col("new").alias("_new")), F.col("new") == F.col("_a")
        ).select("a", F.least("new", "_new").alias("to"), (F.least("new", "_new") != F.col("old")).alias("moved"))
        after = store(after, "labels")
        names = after.select("a", "to")
        if not after.where("moved").take(1):
            return names.withColumnRenamed("a", "label")


def _renamed(rows: DataFrame, names: DataFrame) -> DataFrame:
    kept = [c for c in rows.columns if c != "label"]
    return store(rows.join(names, "label", "left").select(*kept, F.coalesce("to", "label").alias("label")), "labels")


def _join_labels(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """node, label with the labels that edges join made one, the least."""
    return _renamed(labels, _new_names(edges))


def _n_chunks(m: str, total: str):
    return F.greatest(F.ceil(F.col(total) / CHUNK_SHINGLES), F.ceil(F.col(m) / CHUNK_NODES)).cast("int")


def _chunk(k: str):
    return F.pmod(F.xxhash64("node", F.lit(5)), F.col(k)).cast("int")


def _compared(leaves: DataFrame, nodes: DataFrame) -> DataFrame:
    """run, leaf, node, n, k: what is compared, and in how many chunks. Leaves too large for a task are taken whole, unseen."""
    rows = leaves.join(nodes.select("node", "n", "mark"), "node")
    small = by_key(
        rows.where(F.col("size") <= CHUNK_NODES).select("run", "leaf", "node", "n", "mark"), "leaf", _promising,
        "run int, leaf long, node long, n int, k int",
    )
    large = rows.where(F.col("size") > CHUNK_NODES)
    sums = large.groupBy("leaf").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total"))
    return small.unionByName(large.select("run", "leaf", "node", "n").join(sums.select("leaf", _n_chunks("m", "total").alias("k")), "leaf"))


def _edges(rows: DataFrame, sets: DataFrame, key) -> DataFrame:
    return store(
        by_key(rows.select(key.alias("key"), "node", "label").join(sets, "node"), "key", _forest, "a long, b long").distinct(), "edges"
    )


def _mixed(rows: DataFrame) -> DataFrame:
    """The rows of leaves with several classes, with the largest of them, main, and whether most nodes are in it."""
    parts = rows.groupBy("leaf", "label").agg(F.count(F.lit(1)).alias("c"))
    leaves = parts.groupBy("leaf").agg(
        F.max_by("label", F.struct("c", "label")).alias("main"), (2 * F.max("c") > F.sum("c")).alias("mostly"), F.count(F.lit(1)).alias("classes")
    )
    return rows.join(leaves.where("classes > 1").drop("classes"), "leaf")


def _outside(wide: DataFrame) -> DataFrame:
    """leaf, chunk, other, node, label: each pair of (part of the nodes outside the largest class, chunk of the leaf) is one task."""
    rest = wide.where("label <> main")
    sums = rest.groupBy("leaf").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).select("leaf", _n_chunks("m", "total").alias("parts"))
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    right = wide.withColumn("chunk", _chunk("k")).join(sums, "leaf").select("leaf", "chunk", others, "node", "label")
    chunks = F.explode(F.sequence(F.lit(0), F.col("k") - 1)).alias("chunk")
    left = rest.withColumn("own", _chunk("k")).join(sums, "leaf").select("leaf", "own", chunks, _chunk("parts").alias("other"), "node", "label")
    return right.unionByName(left.where("chunk <> own").drop("own"))


def _classes(leaves: DataFrame, sets: DataFrame) -> DataFrame:
    """node, label after all runs."""
    labels = store(leaves.select("node").distinct().withColumn("label", F.col("node")), "labels")
    for run in range(RUNS):
        part = leaves.where(F.col("run") == run).select("leaf", "node", "n", "k")
        rows = store(part.join(labels, "node") if run else part.withColumn("label", F.col("node")), "leaf-rows")

        def merge(edges: DataFrame) -> None:
            nonlocal labels, rows
            if edges.take(1):
                names = _new_names(edges)
                labels, rows = _renamed(labels, names), _renamed(rows, names)

        now = _mixed(rows).where("k = 1 OR NOT mostly").withColumn("chunk", _chunk("k"))
        merge(_edges(now, sets, F.xxhash64("leaf", "chunk")))
        if not rows.where("k > 1").take(1):
            continue
        # Leaves of several chunks: first some members of each class, then all outside the largest class with every chunk.
        few = _mixed(rows).where("k > 1").groupBy("leaf", "label").agg(
            F.min("node").alias("x"), F.max("node").alias("y"), F.min_by("node", F.xxhash64("node")).alias("z")
        )
        some = store(few.select("leaf", "label", F.explode(F.array_distinct(F.array("x", "y", "z"))).alias("node")), "some")
        fits = some.groupBy("leaf").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") <= CHUNK_NODES).select("leaf")
        merge(_edges(some.join(fits, "leaf", "left_semi"), sets, F.col("leaf")))
        wide = store(_mixed(rows).where("k > 1"), "wide")
        merge(_edges(_outside(wide), sets, F.xxhash64("leaf", "chunk", "other")))
    return labels


def _links(members: DataFrame, sets: DataFrame) -> DataFrame:
    """node, links: similar documents of other nodes, each pair of nodes compared once, in blocks of a class."""
    sums = members.groupBy("label").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("total")).where("m > 1")
    cut = members.join(sums.select("label", _n_chunks("m", "total").alias("k")), "label").withColumn("chunk", _chunk("k"))
    # side: 0 within a chunk, else which of two chunks
    side = lambda o: F.when(F.col("chunk") == o, 0).when(F.col("chunk") < o, 1).otherwise(2)
    turns = F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda o: F.struct(
        F.least("chunk", o).alias("i"), F.greatest("chunk", o).alias("j"), side(o).alias("side"))))
    blocks = cut.select("label", "node", "n_docs", turns.alias("t")).select(
        F.xxhash64("label", "t.i", "t.j").alias("key"), "node", "n_docs", "t.side"
    )
    return by_key(blocks.join(sets, "node"), "key", _degrees, "node long, links long").groupBy("node").agg(F.sum("links").alias("links"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, class_id, n_links (documents of similarity 0.8 or more), n_class (documents of the class), kept (one of its rows)."""
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    hashed = base.withColumn("text_hash", F.xxhash64("text"))
    rows = store(
        map_rows(hashed, ["doc_id", "text_hash", "text"], _describe, "doc_id long, text_hash long, node long, n int, mark array<int>"), "near-rows"
    )
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first")
    nodes = store(
        rows.where("node IS NOT NULL").groupBy("node").agg(
            first, F.count(F.lit(1)).alias("n_docs"), F.max("n").alias("n"), F.max("mark").alias("mark")
        ),
        "near-nodes",
    )
    leaves = store(_compared(_leaves(nodes), nodes), "near-leaves")
    candidates = leaves.select("node").distinct()
    wanted = candidates.join(nodes.select("node", "first"), "node").select(F.col("first.doc_id").alias("_id"), F.col("first.text_hash").alias("_hash")).distinct()
    picked = hashed.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("text_hash").eqNullSafe(F.col("_hash")), "left_semi")
    sets = store(map_rows(picked.select("text"), ["text"], _name_sets, "node long, tokens array<long>").dropDuplicates(["node"]), "near-sets")
    labels = _classes(leaves, sets)

    members = labels.join(nodes.select("node", "n", "n_docs"), "node")
    links = _links(members, sets)
    classed = nodes.select("node", "n_docs", "first").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    firsts = classed.groupBy("label").agg(F.min("first").alias("first"), F.sum("n_docs").alias("n_class"))
    told = store(
        classed.drop("first").join(firsts, "label").join(links, "node", "left")
        .select("node", "first", "n_class", (F.coalesce("links", F.lit(0)) + F.col("n_docs") - 1).alias("n_links")),
        "near-told",
    )
    alone = F.col("first").isNull()
    return rows.select("doc_id", "text_hash", "node").join(told, "node", "left").select(
        "doc_id", "text_hash", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_class", F.lit(1)).cast("long").alias("n_class"),
        (alone | (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & F.col("text_hash").eqNullSafe(F.col("first.text_hash")))).alias("kept"),
    )


def keep_one_of_each(docs: DataFrame) -> DataFrame:
    """One document of each class: the one of the least doc_id; of rows equal in id and text one. Documents without words stay."""
    going = near_duplicates(docs)
    stays = going.where("kept").groupBy("doc_id", "text_hash").agg(F.max("class_id").alias("_c"))
    keyed = docs.withColumn("_hash", F.xxhash64(F.col("text").cast("string")))
    same = keyed["doc_id"].cast("long").eqNullSafe(stays["doc_id"]) & keyed["_hash"].eqNullSafe(stays["text_hash"])
    wordless = F.coalesce(F.length(F.regexp_replace("text", r"[ \t\n\x0B\f\r]+", "")), F.lit(0)) == 0
    kept = keyed.join(stays, same, "left_semi")
    one = kept.where(~wordless).dropDuplicates(["doc_id", "_hash"])
    return one.unionByName(kept.where(wordless)).select(*docs.columns)
