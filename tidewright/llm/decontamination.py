"""Benchmark leaks by spaced seeds: masks skip token positions, so a seed survives substituted words.

Words are maximal runs of letters and digits, lower-cased. A seed hashes the masked
positions of a window of words. Where a document's seed equals an item's seed, item
and document are aligned at that offset; the document leaks the item if some window of
``WINDOW`` aligned words (the whole item if shorter) agrees in ``10 of 13`` words or more.
The masks below hit every such window with three substituted words at any places.

Shorter items, up to ten words, have masks of their own, as the long ones would leave too few places to try: their words are cut into one
group more than two, or two more than two where two words may differ, and each mask leaves out as many groups as words may differ.

Cases: items of fewer than ``MIN_ITEM`` words can't be told from chance and are never
matched. Words of an item that stand outside the document count as substituted. Null
and empty texts hold no words. Items of equal words are matched once each. Rows of one
doc_id are one document; repeated rows change nothing. Ties between offsets go to the first
offset. Empty tables give an empty result. Only the named columns of the inputs are used.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

# Positions of the masks, found by trying all masks of five positions within nine words.
MASKS = ((0, 1, 2, 5, 6), (0, 3, 6, 7, 8), (0, 1, 5, 7, 8))
WINDOW, MATCHES = 13, 10
MIN_ITEM = 5
# Items of fewer words have their own masks; from here on the long ones hit every allowed set of changes.
LONG_ITEM = 11
# Seeds sent to every executor at once; a benchmark with more is worked off in blocks.
BLOCK_SEEDS = 1_000_000


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text.cast("string"), F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def allowed(n: int) -> int:
    """Words of a short item (fewer than ``WINDOW``) that may differ."""
    return n - -(-n * MATCHES // WINDOW)


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Masks over an item of n words that hit it whatever words, as many as are allowed, differ."""
    away = allowed(n)
    groups = 2 + away
    cuts = [round(n * g / groups) for g in range(groups + 1)]
    out = []
    for gone in combinations(range(groups), away):
        out.append(tuple(i for g in range(groups) if g not in gone for i in range(cuts[g], cuts[g + 1])))
    return out


def _masks(short: list[int]) -> list[tuple[int, tuple[int, ...]]]:
    """(number, mask) of all masks, each mask from 0 on."""
    own = [(1000 * n + k, tuple(i - m[0] for i in m)) for n in short for k, m in enumerate(short_masks(n))]
    return [*enumerate(MASKS), *own]


def _seeds(words: Column, at: Column, short: list[int]) -> Column:
    """The hashes of all masks that start at ``at``, null for those that overrun: a plain array, so that long texts are walked in generated code."""
    return F.array(*[
        F.when(at + m[-1] < F.size(words), F.xxhash64(F.lit(k), *[F.get(words, at + o) for o in m])) for k, m in _masks(short)
    ])


def _item_seeds(items: DataFrame, short: list[int]) -> DataFrame:
    """seed, item_id, at, n: items by the masks of their kind; short ones have one place per mask."""
    words, at = F.col("words"), F.col("at")
    long_ = items.where(F.col("n") >= LONG_ITEM).select("item_id", "words", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("at"))
    found = long_.select(F.explode(_seeds(words, at, [])).alias("seed"), "item_id", "at", "n").where("seed IS NOT NULL")
    for n in short:
        own = F.array(*[
            F.struct(F.xxhash64(F.lit(1000 * n + k), *[F.get(words, F.lit(i)) for i in m]).alias("seed"), F.lit(m[0]).alias("at"))
            for k, m in enumerate(short_masks(n))
        ])
        rows = items.where(F.col("n") == n).select("item_id", "n", F.explode(own).alias("s"))
        found = found.unionByName(rows.select("s.seed", "item_id", "s.at", "n"))
    return found


def _best_window() -> Column:
    """Most agreeing words in a window of the aligned item, from the array ``same`` of 0 and 1."""
    length = F.least(F.lit(WINDOW), F.col("n"))
    starts = F.sequence(F.lit(1), F.col("n") - length + 1)
    return F.array_max(F.transform(starts, lambda s: F.aggregate(F.slice("same", s, length), F.lit(0), lambda a, x: a + x)))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, first_word (of the item's alignment in the document), n_window, n_same, n_item."""
    items = store(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), words_of(F.col("text")).alias("words"))
        .withColumn("n", F.size("words")).where(F.col("n") >= MIN_ITEM).dropDuplicates(["item_id", "words"]),
        "leak-items",
    )
    lengths = items.where(F.col("n") < LONG_ITEM).agg(F.collect_set("n")).first()  # six numbers at most
    short = sorted(lengths[0])
    seeds = store(_item_seeds(items, short), "leak-seeds")
    n_seeds = seeds.count()
    blocks = -(-n_seeds // BLOCK_SEEDS)

    words = F.col("words")
    least = min(m[-1] for _, m in _masks(short)) + 1  # words of the narrowest mask
    places = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
        .where(F.size("words") >= least)
        .select("doc_id", "words", F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("i"))
        .select("doc_id", "words", "i", F.explode(_seeds(words, F.col("i"), short)).alias("seed"))
    )
    found: DataFrame | None = None
    for b in range(max(1, blocks)):
        block = seeds.where(F.pmod("seed", F.lit(max(1, blocks))) == b)
        hits = places.join(F.broadcast(block), "seed").select(  # a block holds BLOCK_SEEDS seeds, more or less
            "doc_id", "item_id", "n", (F.col("i") - F.col("at")).alias("offset"), "words"
        )
        found = hits if found is None else found.unionByName(hits)
    # One row per alignment with the stretch of the document it covers; map-side first, as hits of a document are together.
    stretch = F.slice("words", F.greatest("offset", F.lit(0)) + 1, F.col("n") + F.least("offset", F.lit(0)))
    aligned = (
        found.select("doc_id", "item_id", "n", "offset", stretch.alias("stretch"))
        .groupBy("doc_id", "item_id", "n", "offset").agg(F.max("stretch").alias("stretch"))
        .join(items.select("item_id", "words"), "item_id")
        .where(F.size("words") == F.col("n"))
    )
    skip = F.least("offset", F.lit(0))
    same = F.transform("words", lambda w, k: F.when(F.coalesce(F.get("stretch", k + skip) == w, F.lit(False)), 1).otherwise(0))
    length = F.least(F.lit(WINDOW), F.col("n"))
    judged = (
        aligned.withColumn("same", same)
        .withColumn("n_window", _best_window())
        .withColumn("n_same", F.aggregate("same", F.lit(0), lambda a, x: a + x))
        .where(F.col("n_window") * WINDOW >= length * MATCHES)
    )
    best = F.max(F.struct("n_window", "n_same", (-F.col("offset")).alias("back"), "n")).alias("best")
    return judged.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", (-F.col("best.back")).cast("long").alias("first_word"),
        F.col("best.n_window").cast("long").alias("n_window"), F.col("best.n_same").cast("long").alias("n_same"),
        F.col("best.n").cast("long").alias("n_item"),
    )


def remove_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that leak no item; documents without an id stay."""
    return docs.join(leaks(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)
