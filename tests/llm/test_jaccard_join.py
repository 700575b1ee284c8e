"""The join against all pairs."""

import random

import pytest

from tidewright.llm import jaccard_join

SCHEMA = "doc_id long, text string, node long, label string, leaf int"


def near_texts(seed, n_groups=14):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 7)))
    shared = [word() for _ in range(60)]
    rows = [None, "", " \n ", "one", "one", "two words", "three little words", "a b c d", "a b c d", "word " * 400]
    for g in range(n_groups):
        base = [word() for _ in range(rng.randrange(20, 200))] + (shared if g % 3 else [])
        for _ in range(rng.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
    return [(i, t, 1, "x", 2) for i, t in enumerate(rows)] + [(3, "one", None, None, None), (None, "two words", 0, "", 0)]


def brute(rows):
    sets = []
    for _, t, *_ in rows:
        w = (t or "").split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    links = [0] * len(rows)
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                links[i] += 1
                links[j] += 1
                top[find(i)] = find(j)
    classes = {}
    for i in range(len(rows)):
        classes.setdefault(find(i), []).append(i)
    ids = lambda c: min((rows[i][0] for i in c if rows[i][0] is not None), default=None)
    return sorted((str(rows[i][0]), rows[i][1] or "", str(ids(c)), links[i], len(c)) for c in classes.values() for i in c)


@pytest.mark.parametrize("seed,small,chunk", [(1, 64, 1024), (2, 4, 1024), (3, 4, 7)])
def test_against_all_pairs(spark, monkeypatch, seed, small, chunk):
    monkeypatch.setattr(jaccard_join, "SMALL", small)
    monkeypatch.setattr(jaccard_join, "CHUNK_NODES", chunk)
    rows = near_texts(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    got = jaccard_join.near_duplicates(df).collect()
    by_hash = {r.h: r.text for r in df.selectExpr("xxhash64(text) h", "text").collect()}
    made = sorted((str(r.doc_id), by_hash[r.text_hash] or "", str(r.class_id), r.n_links, r.n_class) for r in got)
    assert made == brute(rows)


def test_one_of_each_stays(spark):
    rows = near_texts(5, 6)
    kept = jaccard_join.keep_one_of_each(spark.createDataFrame(rows, SCHEMA))
    assert kept.columns == ["doc_id", "text", "node", "label", "leaf"]
    worded = {x[2] for x in brute(rows) if x[1].split()}
    got = [r.doc_id for r in kept.collect() if (r.text or "").split()]
    assert sorted(map(str, got)) == sorted(worded)


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert jaccard_join.near_duplicates(empty).count() == 0 and jaccard_join.keep_one_of_each(empty).count() == 0


def test_rows_that_are_compared_do_not_grow_with_the_rounds(spark, monkeypatch):
    # One large group of near copies and texts that share its leaves but are unlike it: later runs meet what is one class already.
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(3, 7)))
    base, rows = [word() for _ in range(120)], []
    for i in range(150):
        copy = list(base)
        copy[rng.randrange(len(copy))] = word()
        rows.append((i, " ".join(copy), 1, "x", 2))
    for i in range(150, 160):
        rows.append((i, " ".join(base[:80] + [word() for _ in range(60)]), 1, "x", 2))
    sent, leaf_rows = [], []
    by_key, compared = jaccard_join.by_key, jaccard_join._compared

    def counted(df, key, fn, schema):
        if fn is jaccard_join._forest:
            sent.append(df.count())
        return by_key(df, key, fn, schema)

    def kept(*args):
        out = compared(*args)
        leaf_rows.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "SMALL", 8)
    monkeypatch.setattr(jaccard_join, "CHUNK_NODES", 40)
    monkeypatch.setattr(jaccard_join, "by_key", counted)
    monkeypatch.setattr(jaccard_join, "_compared", kept)
    df = spark.createDataFrame(rows, SCHEMA)
    got = jaccard_join.near_duplicates(df).collect()
    by_hash = {r.h: r.text for r in df.selectExpr("xxhash64(text) h", "text").collect()}
    assert sorted((str(r.doc_id), by_hash[r.text_hash] or "", str(r.class_id), r.n_links, r.n_class) for r in got) == brute(rows)
    assert sum(sent) < 0.75 * sum(leaf_rows)
