"""Sharding, mixing and toxicity on small tables."""

import random
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewright.llm import mixing, sharding, toxicity
from tidewright.llm.common import rank_in

DOCS = "doc_id long, text string, lang string, source string, size int, shard int"


def test_ranks_are_gapless(spark):
    df = spark.range(5_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("x"))
    got = rank_in(df, ["k"], ["x"], 5_000, 3, "at").groupBy("k").agg(F.count("at"), F.countDistinct("at"), F.min("at"), F.max("at")).collect()
    assert all(tuple(r)[1:] in ((1667, 1667, 0, 1666), (1666, 1666, 0, 1665)) for r in got) and len(got) == 3


@pytest.mark.parametrize("n,shards", [(400, 7), (5, 9), (0, 3)])
def test_shards_are_even_and_keep_groups(spark, n, shards):
    rng = random.Random(n)
    texts = [f"text {rng.randrange(n // 2 + 1)}" if i % 3 else "the hot one" for i in range(n)]
    texts[:2] = [None, ""][: len(texts[:2])]
    rows = [(i, t, "e", "s", 1, 1) for i, t in enumerate(texts)]
    if n > 10:
        rows += [rows[4], rows[4]]
    got = sharding.shard_by_links(spark.createDataFrame(rows, DOCS), shards).collect()
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    sizes = Counter(r.shard for r in got)
    if rows:
        counts = [sizes[s] for s in range(shards)]
        assert max(counts) - min(counts) <= 1 and set(sizes) <= set(range(shards))
    for s in sizes:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    text = {r[0]: r[1] for r in rows}
    for r in got:
        raw = (text[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)
    if n > 100:  # the hot group of a third needs three shards of seven, the others stay together
        spread, members = {}, {}
        for r in got:
            spread.setdefault(r.text_crc32, set()).add(r.shard)
            members.setdefault(r.text_crc32, []).append(r.shard)
        assert len(spread[zlib.crc32(b"the hot one")]) <= 4
        cut = sum(len(v) - 1 for k, v in spread.items() if k != zlib.crc32(b"the hot one"))
        assert cut <= 6
        together = sum(c * (c - 1) for m in members.values() for c in Counter(m).values())
        every = sum(len(m) * (len(m) - 1) for m in members.values())
        assert together >= 2 * every / shards
        small = [m for k, m in members.items() if 1 < len(m) < 20]
        assert sum(len(set(m)) == 1 for m in small) >= 0.8 * len(small)
        assert together >= 0.9 * greedy([len(m) for m in members.values()], len(got), shards)


def greedy(sizes, total, shards):
    """Ordered pairs kept together when groups, the largest first, go into the emptiest shard, cut where it is full."""
    room, kept = [total // shards + (s < total % shards) for s in range(shards)], 0
    for n in sorted(sizes, reverse=True):
        while n:
            s = max(range(shards), key=room.__getitem__)
            take = min(n, room[s])
            room[s] -= take
            n -= take
            kept += take * (take - 1)
    return kept


@pytest.mark.parametrize("sizes,base,shards", [([133, 12], 57, 7), ([300], 40, 7), ([9, 9, 9], 10, 3), ([10] * 5, 10, 3)])
def test_large_groups_fill_whole_shards(sizes, base, shards):
    pieces, room = sharding._packed(sizes, base, shards)
    for n, own in zip(sizes, pieces, strict=True):
        at = 0
        for lo, hi, _ in own:
            assert lo == at < hi
            at = hi
        assert at <= n
    used = Counter()
    for own in pieces:
        for lo, hi, s in own:
            used[s] += hi - lo
    assert [base - used[s] for s in range(shards)] == room and min(room) >= 0
    assert sum(used.values()) == min(sum(sizes), base * shards)


def brute_rake(cells, goals, rounds):
    weights = {c: float(t) for c, t in cells.items()}
    for _ in range(rounds):
        for d in range(3):
            sums = Counter()
            for c, w in weights.items():
                sums[c[d]] += w
            weights = {c: min(float(cells[c]), w * goals[d].get(c[d], 0.0) / sums[c[d]] if sums[c[d]] else 0.0) for c, w in weights.items()}
    return weights


def test_raking(spark):
    rng = random.Random(3)
    cells = {(s, v, t): rng.randrange(1, 900) for s in ("a", "b", None) for v in ("en", None) for t in ("x", "y")}
    cells[("a", "en", "empty")] = 0
    table = spark.createDataFrame([(*c, n) for c, n in cells.items()], "source string, lang string, topic string, tokens long")
    total = sum(cells.values())
    shares = [{"a": 1.0, "b": 1.0, None: 2.0}, {"en": 3.0, None: 1.0}, {"x": 1.0, "y": 1.0, "absent": 5.0}]
    targets = {d: spark.createDataFrame(list(s.items()), "value string, share double") for d, s in zip(mixing.DIMENSIONS, shares, strict=True)}
    got = {(r.source, r.lang, r.topic): r.weight for r in mixing.rake(table, targets, total * 0.3).collect()}
    there = [{c[d] for c, n in cells.items() if n} for d in range(3)]
    goals = [{v: x * total * 0.3 / sum(s[w] for w in s if w in there[d]) for v, x in s.items() if v in there[d]} for d, s in enumerate(shares)]
    want = brute_rake(cells, goals, 60)
    assert set(got) == set(cells)
    assert all(abs(got[c] - want[c]) <= 0.01 * total for c in cells)
    for d in range(3):
        for v, goal in goals[d].items():
            assert abs(sum(w for c, w in got.items() if c[d] == v) - goal) <= 0.02 * total


def test_raking_a_table_equals_raking_in_a_task(spark):
    rng = random.Random(4)
    cells = [(f"s{i % 7}" if i % 7 else None, f"l{i % 3}", f"t{i % 5}", rng.randrange(0, 500)) for i in range(105)]
    table = spark.createDataFrame(cells, "source string, lang string, topic string, tokens long")
    targets = {d: mixing.smoothed(table, d, 0.5) for d in mixing.DIMENSIONS}
    one, two = (
        {(r.source, r.lang, r.topic): (r.weight, r.gap) for r in mixing.rake(table, targets, 9000.0, gathered=n).collect()} for n in (0, 1000)
    )
    assert set(one) == set(two) and len(one) == 105
    for c, (weight, gap) in one.items():
        assert abs(weight - two[c][0]) < 1e-6 and abs(gap - two[c][1]) < 1e-9


def test_targets_that_cannot_be_met_are_told(spark):
    cells = spark.createDataFrame([("a", "x", "t", 10), ("b", "y", "t", 1000)], "source string, lang string, topic string, tokens long")
    even = {d: mixing.smoothed(cells, d, 0.0) for d in mixing.DIMENSIONS}
    assert min(r.gap for r in mixing.rake(cells, even, 900.0).collect()) > 0.1


def test_columns_of_any_name_may_be_there(spark):
    names = ["_chance", "cell_chance", "cell_source", "_source", "own_topic", "_own", "OWN_TOPIC_"]
    rows = [(i, "a b c " * (i % 5), "en", f"s{i % 2}", *names) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} string" for n in names))
    got = mixing.sample(docs)
    assert got.columns == docs.columns and {tuple(r)[4:] for r in got.collect()} == {tuple(names)}


def test_sampling_follows_the_probabilities(spark):
    rng = random.Random(9)
    rows = [(i, "word " * rng.randrange(1, 60), "en" if i % 5 else None, f"s{i % 4 and 1}", 0, 0) for i in range(3_000)]
    rows += [(1, None, None, None, 0, 0), (2, "", "en", "s1", 0, 0), rows[7], rows[7]]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs, share=0.4).collect()
    assert len(got) == len(rows) and all(0 <= r.probability <= 1 for r in got)
    assert all(r.sampled for r in got if not r.tokens)
    taken, total = sum(r.tokens for r in got if r.sampled), sum(r.tokens for r in got)
    assert abs(taken / total - 0.4) < 0.04
    assert sorted(r.doc_id for r in mixing.sample(docs, share=0.4).collect()) == sorted(r.doc_id for r in got if r.sampled)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.sample(docs.limit(0)).count() == 0


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(6)
    part = lambda: "".join(rng.choice(["an", "er", "in", "ou", "re", "st", "th"]) for _ in range(rng.randrange(1, 5)))
    bad = ["scumbag", "wretch", "zlorqua", "zlorqui", "zlorquo", "zlorque"]
    docs, labels = [], []
    for i in range(900):
        toxic = i % 4 == 0
        words = [part() for _ in range(rng.randrange(20, 60))]
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(bad)
        docs.append((i, " ".join(words), "en", "s", 0, 0))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def test_toxicity_on_held_out_rows(spark, labelled):
    docs, labels = labelled
    rows = docs + [(900, None, None, None, 0, 0), (901, "", "en", "s", 0, 0), docs[3], docs[3]]
    more = labels + [(None, 1, 1), (5, 1, None), labels[3]]
    d, x = spark.createDataFrame(rows, DOCS), spark.createDataFrame(more, "doc_id long, quality int, toxic int")
    got = toxicity.score(d, x).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels}
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    right = sum(r.predicted == truth[r.doc_id] for r in held)
    assert right >= 0.95 * len(held) and len(held) > 100
    kept = {r.doc_id for r in toxicity.remove_toxic(d, x).collect()}
    assert kept == {r.doc_id for r in got if not r.predicted}


def test_held_out_labels_are_not_read(spark, labelled):
    docs, labels = labelled
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    d = spark.createDataFrame(docs, DOCS)
    one, two = (toxicity.train(d, spark.createDataFrame(x, "doc_id long, quality int, toxic int")) for x in (labels, turned))
    assert one == two


def test_nothing_to_learn(spark, labelled):
    docs, labels = labelled
    d = spark.createDataFrame(docs[:20], DOCS)
    none = spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int")
    assert {(r.score, r.predicted) for r in toxicity.score(d, none).collect()} == {(0.0, 0)}
    assert toxicity.score(d.limit(0), none.limit(0)).count() == 0 and toxicity.remove_toxic(d, none).count() == 20
