"""Balanced label propagation: linked documents meet in shards of equal document counts.

Law ``rows``: shard sizes differ by one document at most. Links join documents of
equal text (a null text counts as empty). Groups that fill half a shard or more are placed
first, as no label could keep them together: whole empty shards, then the tightest room for the rest.
There are at most two such groups per shard. The labels of all others start from a hash of the id; in
each round documents move to the shard with room that holds most of their group,
as many as its free quota takes. Documents without links fill the shards up at the end,
so a group is cut only where its shard is full.

Quotas are met by chance, so a few documents too many may come; they are dealt to shards with room at the end.

Cases: repeated rows count one by one; ties fall by hash, then by shard number. Fewer
documents than shards leave shards empty. An empty table gives an empty result. Only
the named columns of the input are used. No group is ever gathered: all steps work on
narrow rows per document or on counts per (group, shard), and only per-shard numbers
(shards x shards at most) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lookup, rank_in, store, unit

GROUP = ["g1", "g2", "size"]


def _linked(docs: DataFrame) -> DataFrame:
    """Narrow rows with the size of their group of equal texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    bytes_ = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("long")
    rows = store(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), (bytes_ + 16).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("g1"),
        ).withColumn("g2", F.col("text_crc32")),
        "shard-rows",
    )
    groups = rows.groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n_group")).where("n_group > 1")
    return store(rows.join(groups, GROUP, "left"), "shard-linked")


def _quotas(asked: dict[tuple[int, int], int], room: list[int], n_shards: int) -> tuple[list[float], list[float]]:
    """Share of those who ask that each shard takes, and how many leave each: what leaves makes room, so shards can swap."""
    share = [1.0] * n_shards
    for _ in range(50):
        leaving, coming = [0.0] * n_shards, [0.0] * n_shards
        for (a, b), n in asked.items():
            leaving[a] += n * share[b]
            coming[b] += n
        share = [min(s, (room[k] + leaving[k]) / coming[k]) if coming[k] else s for k, s in enumerate(share)]
    return share, leaving


def _packed(sizes: list[int], base: int, n_shards: int) -> tuple[list[list[tuple[int, int, int]]], list[int]]:
    """For each large group, descending, the pieces (first rank, end rank, shard) that hold it, and the room left in each shard."""
    room, pieces = [base] * n_shards, []
    for n in sizes:
        at, own = 0, []
        while at < n:
            left = n - at
            fitting = [s for s in range(n_shards) if room[s] >= left]
            # The tightest shard that holds all that is left, else the emptiest one.
            s = min(fitting, key=lambda x: (room[x], x)) if fitting else max(range(n_shards), key=lambda x: (room[x], -x))
            take = min(left, room[s])
            if not take:
                break  # all shards are full: the few left over are dealt out at the end
            own.append((at, at + take, s))
            room[s] -= take
            at += take
        pieces.append(own)
    return pieces, room


def _place_large(linked: DataFrame, base: int, n_shards: int, total: int) -> tuple[DataFrame | None, list[int]]:
    """Rows of the groups that fill half a shard with their shard, and the room left in each."""
    large = linked.where(F.col("n_group") * 2 > max(base, 1)).groupBy(*GROUP).agg(F.count(F.lit(1)).alias("n"))
    found = sorted((r.asDict() for r in large.collect()), key=lambda r: (-r["n"], r["g1"], r["g2"])) if base else []  # at most 2 per shard
    if not found:
        return None, [base] * n_shards
    pieces, room = _packed([r["n"] for r in found], base, n_shards)
    cuts = [(r["g1"], r["g2"], r["size"], lo, hi, s) for r, own in zip(found, pieces, strict=True) for lo, hi, s in own]
    table = linked.sparkSession.createDataFrame(cuts, "g1 long, g2 long, size long, lo long, hi long, shard int")
    mine = linked.where(F.col("n_group") * 2 > base)
    ranked = store(rank_in(mine, GROUP, ["doc_id"], total, len(found), "at"), "shard-large")
    inside = [ranked[g] == table[g] for g in GROUP] + [ranked["at"] >= table["lo"], ranked["at"] < table["hi"]]
    return ranked.join(F.broadcast(table), inside, "left").select(*[ranked[c] for c in linked.columns], table["shard"]), room


def _propagate(state: DataFrame, n_shards: int, capacity: list[int], rounds: int) -> DataFrame:
    """Move the members of groups until nothing moves or ``rounds`` are over."""
    leaving = [1.0] * n_shards
    for turn in range(rounds):
        counts = store(state.groupBy(*GROUP, "shard").agg(F.count(F.lit(1)).alias("n")), "shard-counts")
        load = dict.fromkeys(range(n_shards), 0) | {  # one number per shard
            r["shard"]: r["n"] for r in counts.groupBy("shard").agg(F.sum("n").alias("n")).collect()
        }
        room = [max(0, capacity[s] - load[s]) for s in range(n_shards)]
        # A shard that is full and that nobody leaves takes no one; its group goes on to the next best.
        open_ = lookup([r > 0 or out >= 1 for r, out in zip(room, leaving, strict=True)], F.col("shard"), "boolean")
        wish = F.struct("n", F.xxhash64(*GROUP, "shard", F.lit(3)).alias("tie"), "shard")
        best = counts.groupBy(*GROUP).agg(F.max(F.when(open_, wish)).alias("best"))
        moves = store(
            counts.join(best, GROUP).where(F.col("best").isNotNull() & (F.col("best") > wish))
            .select(*GROUP, "shard", "n", F.col("best.shard").alias("to")),
            "shard-moves",
        )
        asked = {(r["shard"], r["to"]): r["n"] for r in moves.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}  # shards squared
        if not asked:
            break
        quota, leaving = _quotas(asked, room, n_shards)
        takes = unit("doc_id", *GROUP, seed=turn) < lookup(quota, F.col("to"), "double")
        state = store(
            state.join(moves.drop("n"), [*GROUP, "shard"], "left")
            .withColumn("shard", F.when(F.col("to").isNotNull() & takes, F.col("to")).otherwise(F.col("shard")))
            .drop("to"),
            "shard-state",
        )
    return state


def shard_by_links(docs: DataFrame, n_shards: int = 40, rounds: int = 10) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard (null: the law is ``rows``), n_group."""
    linked = _linked(docs)
    total = linked.count()
    base, extra = divmod(total, n_shards)
    large, capacity = _place_large(linked, base, n_shards, total)
    fixed = store(large, "shard-fixed") if large is not None else linked.limit(0).withColumn("shard", F.lit(0))
    small = linked.where(F.col("n_group").isNotNull() & ~((F.col("n_group") * 2 > base) & F.lit(large is not None)))
    starts, seen = [], 0  # a label starts in a shard with a chance in proportion to its room
    for c in capacity:
        seen += c
        starts.append(seen)
    at = unit("doc_id", seed=7) * float(max(1, seen))
    first = F.size(F.filter(F.array(*[F.lit(float(e)) for e in starts[:-1]]), lambda e: e <= at)) if n_shards > 1 else F.lit(0)
    state = _propagate(store(small.withColumn("shard", first.cast("int")), "shard-start"), n_shards, capacity, rounds)

    def per_shard(rows: DataFrame) -> dict[int, int]:  # one number per shard
        counts = rows.where("shard IS NOT NULL").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()
        return dict.fromkeys(range(n_shards), 0) | {r["shard"]: r["n"] for r in counts}

    held, moved = per_shard(fixed), per_shard(state)
    load = {s: held[s] + moved[s] for s in range(n_shards)}
    fullest = sorted(range(n_shards), key=lambda s: (-load[s], s))
    target = [base + (s in set(fullest[:extra])) for s in range(n_shards)]
    order = ["doc_id", "text_crc32", "size"]
    ranked = store(rank_in(state, ["shard"], order, total, n_shards, "at"), "shard-ranked")
    stays = F.col("at") < lookup([target[s] - held[s] for s in range(n_shards)], F.col("shard"), "long")
    cols = ["doc_id", "size", "text_crc32", "n_group"]
    pool = ranked.where(~stays).select(*cols).unionByName(linked.where("n_group IS NULL").select(*cols)).unionByName(
        fixed.where("shard IS NULL").select(*cols)
    )
    missing, ends, seen = [max(0, target[s] - load[s]) for s in range(n_shards)], [], 0
    for m in missing:
        seen += m
        ends.append(seen)
    filled = rank_in(pool.withColumn("all", F.lit(0)), ["all"], order, total, 1, "at").withColumn(
        "shard", F.size(F.filter(F.array(*[F.lit(e).cast("long") for e in ends]), lambda e: e <= F.col("at"))).cast("int")
    )
    placed = store(
        fixed.where("shard IS NOT NULL").select(*cols, "shard").unionByName(ranked.where(stays).select(*cols, "shard"))
        .unionByName(filled.select(*cols, "shard")), "shard-placed"
    )
    return rank_in(placed, ["shard"], order, total, n_shards, "slot").select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.coalesce("n_group", F.lit(1)).cast("long").alias("n_group"),
    )
