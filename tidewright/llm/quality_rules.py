"""Quality rules whose thresholds follow the data: quantile sketches per language and source.

Cases: a null text counts as empty; an empty text has no words and fails the base
rules. Null languages and sources are groups of their own. Groups of fewer than
``min_group`` documents use the merged sketch of their language, languages as small
the merged sketch of all. Repeated rows are judged one by one, alike. An empty table
gives an empty result. Only the named columns of the input are used.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_rows, store

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\f\r"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PCT = 20

# Signal: (expression over the counts, slack). A document fails when it lies above (or, for a
# negative sign, below) median + REACH * (quantile HIGH - median) + slack of its group.
SIGNALS: dict[str, tuple[str, float]] = {
    "symbols_per_word": ("n_symbols / n_words", 0.10),
    "dup_line_share": ("n_dup_lines / (n_lines + 2)", 0.20),
    "repeat_share": ("n_repeat_words / n_words", 0.10),
    "chars_per_word": ("word_chars / n_words", 4.00),
}
HIGH, REACH, SKETCH_K = 0.9, 3.0, 1000


def _repeat_words(words: list[bytes]) -> int:
    """Words that lie in a window of five words found at least twice."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    h = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    key = h[:n].copy()
    for i in range(1, WINDOW):
        key = key * np.uint64(0x9E3779B97F4A7C15) + (h[i : i + n] ^ (key >> np.uint64(29)))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edges = np.zeros(len(words) + 1, np.int32)
    at = np.flatnonzero(twice)
    np.add.at(edges, at, 1)
    np.add.at(edges, at + WINDOW, -1)
    return int((np.cumsum(edges[:-1]) > 0).sum())


def _counts(text: str) -> tuple[int, int, int, int, int, int]:
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(text.count(c) for c in SPACES)
    symbols = sum(text.count(c) for c in SYMBOLS)
    seen: set[str] = set()
    lines = dups = 0
    for line in text.split("\n"):
        if line.strip(SPACES):
            lines += 1
            if line in seen:
                dups += 1
            else:
                seen.add(line)
    return len(words), chars, symbols, dups, _repeat_words(words), lines


def _batch(ids, langs, sources, texts) -> dict:
    rows = [_counts(t or "") for t in texts.to_pylist()]
    cols = list(zip(*rows, strict=True))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
    return {"doc_id": ids, "lang": langs, "source": sources, **dict(zip(names, cols, strict=True))}


def signals(docs: DataFrame) -> DataFrame:
    """Counts of every whole text: narrow rows, one pass, nothing shuffled."""
    cut = docs.select(
        F.col("doc_id").cast("long"), F.col("lang").cast("string"), F.col("source").cast("string"), F.col("text").cast("string")
    )
    return map_rows(
        cut, ["doc_id", "lang", "source", "text"], _batch,
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, n_lines long",
    )


def _fence(sketch: str, slack: float) -> Column:
    mid, high = (F.expr(f"kll_sketch_get_quantile_double({sketch}, {q}D)") for q in (0.5, HIGH))
    return F.when(F.col("n") > 0, mid + REACH * (high - mid) + slack)  # an empty sketch has no quantiles


def thresholds(measured: DataFrame, min_group: int = 100) -> DataFrame:
    """One row of upper limits per (lang, source), from sketches that merge to languages and to all."""
    usable = measured.where("n_words > 0")
    own = store(
        usable.groupBy("lang", "source").agg(
            F.count(F.lit(1)).alias("n"),
            *[F.expr(f"kll_sketch_agg_double(CAST({e} AS DOUBLE), {SKETCH_K})").alias(s) for s, (e, _) in SIGNALS.items()],
        ).withColumn("_one", F.lit(0)),  # stored, as a constant key would be folded and the join become a product
        "quality-sketches",
    )
    merged = lambda df: df.agg(
        F.sum("n").alias("n"), *[F.expr(f"kll_merge_agg_double({s}, {SKETCH_K})").alias(s) for s in SIGNALS]
    )
    limits = lambda df, tag: df.select(
        *[c for c in ("_one", "lang", "source") if c in df.columns], F.col("n").alias(f"n_{tag}"),
        *[_fence(s, slack).alias(f"{s}_{tag}") for s, (_, slack) in SIGNALS.items()],
    )
    groups = limits(own, "own")
    langs = limits(merged(own.groupBy("lang")), "lang").withColumnRenamed("lang", "_lang")
    every = limits(merged(own.groupBy("_one")), "all")  # one row at most
    joined = (
        groups.join(langs, F.col("lang").eqNullSafe(F.col("_lang")), "left")
        .join(every, "_one", "left")
    )
    pick = lambda s: (
        F.when(F.col("n_own") >= min_group, F.col(f"{s}_own"))
        .when(F.col("n_lang") >= min_group, F.col(f"{s}_lang")).otherwise(F.col(f"{s}_all"))
    )
    return joined.select("lang", "source", *[pick(s).alias(f"max_{s}") for s in SIGNALS])


def judge(docs: DataFrame, min_group: int = 100) -> DataFrame:
    """doc_id, counts, ``base_failed`` by the fixed rules and ``kept`` by both.

    Sketches are stored before they are used, so that a task that is run again
    judges by the same limits.
    """
    measured = store(signals(docs), "quality-signals")
    limits = store(thresholds(measured, min_group), "quality-limits").select(
        F.col("lang").alias("_lang"), F.col("source").alias("_source"), *[f"max_{s}" for s in SIGNALS]
    )
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    above = F.lit(False)
    for s, (e, _) in SIGNALS.items():
        above = above | F.coalesce(F.expr(f"CAST({e} AS DOUBLE)") > F.col(f"max_{s}"), F.lit(False))
    return (
        measured.withColumn("n_lines", F.greatest("n_lines", F.lit(1)))
        .join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
        .withColumn("base_failed", base)
        .withColumn("kept", ~(F.col("base_failed") | F.when(F.col("n_words") > 0, above).otherwise(F.lit(False))))
        .select(
            "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            *[f"max_{s}" for s in SIGNALS],
        )
    )
