"""License scans by a positional index of rare words.

Words are runs of ``[0-9a-z]`` and characters beyond ASCII, after lower-casing A-Z alone. The index holds, for
each template, its rarest words by document frequency over all documents, with their positions. A file
is looked up by these words only: each occurrence proposes the place where the template would start (its
position less the word's position in the template). Places proposed by enough rare words are kept and verified:
the template's key phrase must stand at its relative position, word by word.

Besides, the base phrases are counted at every place where their words stand consecutively.

Cases: null texts are empty; a text without words has no labels, null places and score 0. Equal rows
are judged alike. A template word that no document holds is as rare as can be and harmless. Ties in rarity go by
word. An empty table gives an empty result. Only the named columns of the input are used. Each file is judged
inside its row; only document frequencies of the templates' own words are gathered.
"""

from __future__ import annotations

from math import log
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Base phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Fixed values: (label, template, key phrase that has to stand in its place), from the licences' own notices.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "source and binary forms with or without modification"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain",
     "dedicated the work to the public domain"),
    ("gpl-2.0", "this work is licensed under the gnu general public license version 2", "general public license version 2"),
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted",
     "with or without fee is hereby granted"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
)
RARE = 4  # rare words per template
ANCHORS = 2  # distinct rare words that have to agree on a place


def words_of(text: Column) -> Column:
    low = F.translate(F.coalesce(text.cast("string"), F.lit("")), ascii_uppercase, ascii_lowercase)
    return F.regexp_extract_all(low, F.lit(WORD), F.lit(0))


def _strings(values) -> Column:
    return F.array(*[F.lit(v) for v in values])


def idf(docs: DataFrame, vocabulary: list[str]) -> dict[str, float]:
    """Inverse document frequency of the templates' words over all documents; as many numbers as words."""
    present = F.array_intersect(words_of(F.col("text")), _strings(vocabulary))
    rows = docs.select(F.explode(F.array_append(present, F.lit(""))).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
    found = {r["w"]: r["n"] for r in rows.collect()}  # one number per vocabulary word; "" counts the documents
    total = found.get("", 0)
    return {w: log((1 + total) / (1 + found.get(w, 0))) for w in vocabulary}


def _starts(hits: Column, word: str, at: int) -> Column:
    """Where a template would start by the occurrences of its word at position ``at``."""
    return F.transform(F.filter(hits, lambda h: h["w"] == word), lambda h: h["i"] - at)


def _stands(words: Column, phrase: list[str], start: Column) -> Column:
    """Do the phrase's words stand in a row from ``start``?"""
    same = F.lit(True)
    for k, w in enumerate(phrase):
        same = same & F.coalesce(F.get(words, start + k) == w, F.lit(False))
    return (start >= 0) & same


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches."""
    split = [(label, t.split(), key.split()) for label, t, key in TEMPLATES]
    vocabulary = sorted({w for _, t, _ in split for w in t})
    weight = idf(docs, vocabulary)
    index = []
    for label, t, key in split:
        rarest = sorted(set(t), key=lambda w: (-weight[w], w))[:RARE]
        index.append((label, t, key, [(w, k) for k, w in enumerate(t) if w in rarest]))
    heads = sorted({p.split()[0] for p in PHRASES})
    anchors = sorted({w for *_, postings in index for w, _ in postings} | set(heads))

    empty = F.array().cast("array<struct<w:string,i:int>>")
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), words_of(F.col("text")).alias("words"))
    # Only files that hold an anchor word are walked word by word.
    looked = base.withColumn(
        "hits",
        F.when(
            F.arrays_overlap("words", _strings(anchors)),
            F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda h: F.array_contains(_strings(anchors), h["w"])),
        ).otherwise(empty),
    )
    words, hits = F.col("words"), F.col("hits")

    def phrase_places(phrase: str, label: str) -> Column:
        parts = phrase.split()
        first = F.filter(hits, lambda h: h["w"] == parts[0])
        good = F.filter(first, lambda h: _stands(words, parts, h["i"]))
        return F.transform(good, lambda h: F.struct(h["i"].alias("i"), F.lit(label).alias("label")))

    def template_matches(label: str, t: list[str], key: list[str], postings: list[tuple[str, int]]) -> Column:
        needed = min(ANCHORS, len({w for w, _ in postings}))
        shift = next(k for k in range(len(t)) if t[k : k + len(key)] == key)
        lists = [_starts(hits, w, k) for w, k in postings]
        every = F.flatten(F.array(*lists))
        # A start proposed by several postings: intersect the lists by relative position.
        agreed = F.filter(F.array_distinct(every), lambda s: F.size(F.filter(every, lambda x: x == s)) >= needed)
        good = F.filter(agreed, lambda s: _stands(words, key, s + shift))

        def matched(s: Column) -> Column:
            same = sum((F.when(F.coalesce(F.get(words, F.greatest(s + k, F.lit(0))) == w, F.lit(False)) & (s + k >= 0), 1).otherwise(0) for k, w in enumerate(t)), F.lit(0))
            return F.struct(s.alias("i"), F.lit(label).alias("label"), (same.cast("double") / len(t)).alias("share"))

        return F.transform(good, matched)

    none_places = F.array().cast("array<struct<i:int,label:string>>")
    none_matches = F.array().cast("array<struct<i:int,label:string,share:double>>")
    any_hit = F.size(hits) > 0
    judged = looked.withColumn(
        "places", F.when(any_hit, F.concat(*[phrase_places(p, x) for p, x in PHRASES.items()])).otherwise(none_places)
    ).withColumn(
        "matches", F.when(any_hit, F.concat(*[template_matches(*entry) for entry in index])).otherwise(none_matches)
    )
    n_base = F.size("places").cast("long")
    best = F.coalesce(F.array_max(F.col("matches.share")), F.lit(0.0))
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    return judged.select(
        "doc_id", F.size("words").cast("long").alias("n_words"), n_base.alias("n_base"),
        F.array_min(F.col("places.i")).cast("long").alias("first_word"), F.array_max(F.col("places.i")).cast("long").alias("last_word"),
        joined(F.col("places.label")).alias("base_labels"),
        joined(F.concat(F.col("places.label"), F.col("matches.label"))).alias("labels"),
        F.greatest(best, F.when(n_base > 0, 0.5).otherwise(0.0)).alias("score"),
        "matches",
    )
