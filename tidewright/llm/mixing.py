"""Mixing sources to target weights: iterative proportional fitting of token weights, then calibrated sampling.

Cells are the combinations of source, language and topic that occur; a cell's size is its tokens (words of the texts). The
weights of the cells are raked: in turn, for each dimension, all cells of one value are scaled so that their sum meets the value's target,
and no cell may weigh more than it holds (a document is taken once at most). This goes on until all sums that can be met are met
to ``TOLERANCE`` or nothing changes any more. A document is taken with the probability weight / size of its cell, by a hash of its id and
text, so a repetition takes the same ones.

Targets come as tables (value, share); values without a target keep none, targets without cells are spread over the rest. ``smoothed``
makes targets from the table itself: shares of tokens to a power below 1, which lifts the rare.

Cases: null sources and languages are values of their own. Empty and null texts hold no tokens and are in cells of their own
if need be; cells without tokens are never sampled away: probability 1, as they weigh nothing. Rows equal in id and text are
taken or left together. An empty table gives an empty result. Only the named columns of the input are used, and columns of any other names may
be there. Targets that can't be met, as cells are too small for them, are told: ``rake`` gives ``gap``, the distance left.

Cells are counted first. Up to ``GATHERED`` of them, some tens of megabytes at most, one task rakes their sums in a single job. More of them are
raked as a table, a few rounds per job. Both do the same steps and stop by the same rule.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, store, unit

DIMENSIONS = ("source", "lang", "topic")
TOLERANCE, ROUNDS, PER_STEP = 1e-3, 60, 6
GATHERED = 200_000


def topic_of(text: Column) -> Column:
    """A coarse topic by form, as the tables name none: by what a text's lines and words are like."""
    text = F.coalesce(text.cast("string"), F.lit(""))
    size = F.char_length(text)
    lines = F.size(F.split(text, "\n"))
    bars = size - F.char_length(F.replace(text, F.lit("|"), F.lit("")))
    signs = size - F.char_length(F.regexp_replace(text, r"[{}<>=;#*$%&]", ""))
    return (
        F.when(size == 0, "empty").when(bars * 50 > size, "table").when(signs * 50 > size, "markup")
        .when(lines * 80 > size, "list").when(size < 1000, "note").when(size < 4000, "article").otherwise("long")
    )


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(r"\S+")).cast("long")


def describe(docs: DataFrame) -> DataFrame:
    """doc_id, text_hash, source, lang, topic, tokens: narrow rows, one pass."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
        F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
        topic_of(F.col("text")).alias("topic"), n_words(F.col("text")).alias("tokens"),
    )


def smoothed(cells: DataFrame, dimension: str, power: float) -> DataFrame:
    """value, share: the values' shares of tokens, to a power."""
    return cells.groupBy(F.col(dimension).alias("value")).agg(F.pow(F.sum("tokens").cast("double"), F.lit(power)).alias("share"))


def _goals(cells: DataFrame, targets: dict[str, DataFrame], budget: float) -> DataFrame:
    """The cells with one goal per dimension, in tokens: shares of the values that occur add up to the budget."""
    for d in DIMENSIONS:
        known = targets[d].groupBy("value").agg(F.sum("share").alias("share"))  # one row per value
        there = cells.where("tokens > 0").select(F.col(d).alias("value")).distinct()
        there = there.alias("t").join(known.alias("k"), F.col("t.value").eqNullSafe(F.col("k.value")), "left").select(
            F.col("t.value").alias("_value"), F.coalesce("k.share", F.lit(0.0)).alias("_share")
        )
        # The few values are stored, so that the plan of all dimensions stays small: the driver holds plans, code and broadcasts at once.
        there = store(there, "goals")
        total = there.agg(F.coalesce(F.sum("_share"), F.lit(0.0)).alias("s")).first()["s"]
        goal = F.col("_share") * F.lit(float(budget) / total) if total > 0 else F.lit(0.0)
        cells = cells.join(
            there.select("_value", goal.alias(f"goal_{d}")), F.col(d).eqNullSafe(F.col("_value")), "left"
        ).drop("_value")
    return cells


def _settled(before: float | None, off: float) -> bool:
    """Whether raking ends: the targets are met, or a step of rounds has hardly changed the distance."""
    return off <= TOLERANCE or (before is not None and abs(before - off) <= TOLERANCE * 0.1)


def _rake_gathered(cells: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All steps on the cells of one task."""
    parts = [c for c in cells if len(c)]
    if not parts:
        return
    rows = pd.concat(parts, ignore_index=True)
    tokens = rows["tokens"].to_numpy(float)
    value = [pd.factorize(rows[d], use_na_sentinel=False)[0] for d in DIMENSIONS]
    goals = [rows[f"goal_{d}"].to_numpy(float) for d in DIMENSIONS]  # null (no tokens): not a number, and so is the scaled weight
    weight, gap = tokens.copy(), None
    for _ in range(0, ROUNDS, PER_STEP):
        for _ in range(PER_STEP):
            for v, goal in zip(value, goals):
                sums = np.bincount(v, weight)[v]
                scaled = np.divide(weight * goal, sums, out=np.zeros_like(weight), where=sums > 0)
                weight = np.minimum(np.nan_to_num(scaled), tokens)
        before, gap, total, there = gap, 0.0, weight.sum(), tokens > 0
        for v, goal in zip(value, goals):
            sums = np.bincount(v[there], weight[there], minlength=v.max() + 1)[v[there]]
            gap = max(gap, float(np.abs(sums - goal[there]).max(initial=0.0)))
        gap = gap / total if total else 0.0
        if _settled(before, gap):
            break
    yield rows[[*DIMENSIONS, "tokens"]].assign(weight=weight, gap=gap)


def _rake_table(cells: DataFrame) -> DataFrame:
    """All steps as joins with the sums of each dimension; a round is one stored table, so plans stay short."""
    state, before, off = cells.withColumn("weight", F.col("tokens").cast("double")), None, 0.0
    for _ in range(0, ROUNDS, PER_STEP):
        for _ in range(PER_STEP):
            for d in DIMENSIONS:
                sums = state.groupBy(F.col(d).alias("_value")).agg(F.sum("weight").alias("_sum"))
                scaled = F.when(F.col("_sum") > 0, F.col("weight") * F.col(f"goal_{d}") / F.col("_sum")).otherwise(F.lit(0.0))
                state = state.join(sums, F.col(d).eqNullSafe(F.col("_value"))).withColumn(
                    "weight", F.least(F.coalesce(scaled, F.lit(0.0)), F.col("tokens").cast("double"))
                ).drop("_value", "_sum")
            state = store(state, "rake")
        off = worst_gap(state)
        if _settled(before, off):
            break
        before = off
    return state.select(*DIMENSIONS, "tokens", "weight", F.lit(off).alias("gap"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], budget: float, gathered: int = GATHERED) -> DataFrame:
    """The cells (source, lang, topic, tokens) with ``weight``, tokens to take of each, and ``gap``.

    ``gap`` is one number: the largest distance of a value's sum from its goal, as a share of all weights; above ``TOLERANCE`` the targets can't be met.
    """
    state = store(_goals(cells.select(*DIMENSIONS, F.col("tokens").cast("long").alias("tokens")), targets, budget), "rake")
    if state.count() > gathered:
        return _rake_table(state)
    schema = ", ".join(f"{d} string" for d in DIMENSIONS) + ", tokens long, weight double, gap double"
    return store(state.coalesce(1).mapInPandas(_rake_gathered, schema), "raked")


def worst_gap(state: DataFrame) -> float:
    """Largest distance of a value's sum from its goal, as a share of all: one job for all dimensions."""
    gaps = None
    for d in DIMENSIONS:
        by = state.where("tokens > 0").groupBy(d).agg(F.abs(F.sum("weight") - F.max(f"goal_{d}")).alias("gap")).select("gap")
        gaps = by if gaps is None else gaps.unionByName(by)
    total = state.select(F.sum("weight")).scalar()
    return gaps.agg((F.max("gap") / F.when(total > 0, total)).alias("g")).first()["g"] or 0.0  # one number


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, powers: dict[str, float] | None = None, share: float = 0.5, seed: int = 7) -> DataFrame:
    """doc_id, text_hash, source, lang, topic, tokens, weight (of its cell), gap (of the whole raking), probability, sampled.

    ``share`` of all tokens is aimed at; where cells are too small for their targets, less comes out.
    """
    rows = store(describe(docs), "mix-rows")
    cells = store(rows.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    powers = powers or {"source": 0.5, "lang": 0.7, "topic": 0.7}
    aims = targets or {d: smoothed(cells, d, powers[d]) for d in DIMENSIONS}
    total = cells.agg(F.sum("tokens").alias("t")).first()["t"] or 0
    weights = rake(cells, aims, total * share).select(*[F.col(d).alias(f"_{d}") for d in DIMENSIONS], F.col("tokens").alias("_tokens"), "weight", "gap")
    same = None
    for d in DIMENSIONS:
        one = F.col(d).eqNullSafe(F.col(f"_{d}"))
        same = one if same is None else same & one
    chance = F.when(F.col("_tokens") > 0, F.col("weight") / F.col("_tokens")).otherwise(1.0)
    return (
        rows.join(weights, same, "left").withColumn("probability", chance)
        .withColumn("sampled", unit("doc_id", "text_hash", seed=seed) < F.col("probability"))
        .select("doc_id", "text_hash", *DIMENSIONS, "tokens", "weight", "gap", "probability", "sampled")
    )


def sample(docs: DataFrame, **how) -> DataFrame:
    """The sampled documents, judged row by row from their cell: texts are not shuffled where the cells are few."""
    own = free_name(docs, "own_topic")
    names = {d: free_name(docs, f"cell_{d}") for d in DIMENSIONS} | {"chance": free_name(docs, "cell_chance")}
    by_cell = mix(docs, **how).groupBy(*DIMENSIONS).agg(F.max("probability").alias("chance"))
    chances = store(by_cell, "mix-chances").select(*[F.col(c).alias(n) for c, n in names.items()])
    keyed = docs.withColumn(own, topic_of(F.col("text")))
    same = (
        keyed["source"].cast("string").eqNullSafe(F.col(names["source"])) & keyed["lang"].cast("string").eqNullSafe(F.col(names["lang"]))
        & F.col(own).eqNullSafe(F.col(names["topic"]))
    )
    drawn = unit(keyed["doc_id"].cast("long"), F.xxhash64(keyed["text"].cast("string")), seed=how.get("seed", 7))
    return keyed.join(chances, same).where(drawn < F.col(names["chance"])).select(*docs.columns)
