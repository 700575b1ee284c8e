"""Importance resampling against counting by hand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from tidewright.llm import resampling

DOCS = "doc_id long, text string, weight int, score string, _part int, drawn_id int"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return Counter(zlib.crc32(r.encode()) % 10000 for r in runs), len(words)


def brute(docs, target):
    counts = [features(t) for _, t in docs]
    s, t = Counter(), Counter()
    for c, _ in counts:
        s.update(c)
    for text in target:
        t.update(features(text)[0])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (s_all + 10000) / ((s[b] + 1) * (t_all + 10000)))) for b in s}
    rows = []
    for (doc_id, _), (c, n) in zip(docs, counts):
        h = int(hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()[:8], 16)
        w = sum(k * gain[b] for b, k in c.items())
        rows.append([doc_id, n, sum(c.values()), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), None])
    fit = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0]))
    for i, r in enumerate(fit[: len(fit) * 5 // 100], start=1):
        r[5] = i
    return sorted(map(tuple, rows))


def frames(spark, docs, target):
    return (
        spark.createDataFrame([(i, t, 1, "x", 2, 3) for i, t in docs], DOCS),
        spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string"),
    )


def test_equals_counting_by_hand(spark):
    rng = random.Random(3)
    words = [f"Word{i}" for i in range(50)] + ["ÉTÉ", "naïve", "9", "KK", "日本"]
    docs = [(i, rng.choice((" ", "-", "\n")).join(rng.choices(words, k=rng.randrange(60)))) for i in range(120)]
    docs += [(200, None), (201, ""), (202, " . "), (203, "x" * 5000), (204, " ".join(rng.choices(words, k=40_000)))]
    docs += [(205, docs[0][1]), (206, "the same hot text " * 10), (207, "the same hot text " * 10)]
    target = [docs[5][1], "Word1 Word2 Word3 naïve", None]
    got = resampling.resample(*frames(spark, docs, target)).collect()
    assert sorted(map(tuple, got), key=lambda r: r[0]) == brute(docs, target)


def test_repeated_rows_nulls_and_ties_are_rows_of_their_own(spark):
    docs = [(7, "a b c d " * 10)] * 50 + [(None, "a b c d " * 10)] * 10
    got = resampling.resample(*frames(spark, docs, []), percent=50).collect()
    assert len(got) == 60 and sorted(r.rank for r in got if r.rank) == list(range(1, 31))
    kept = resampling.select(*frames(spark, docs, []), percent=50)
    assert kept.columns == ["doc_id", "text", "weight", "score", "_part", "drawn_id"] and kept.count() in (50, 60)


@pytest.mark.parametrize("target", [[], ["a b"]])
def test_empty_table(spark, target):
    assert resampling.resample(*frames(spark, [], target)).collect() == []


def test_pieces_of_any_size_give_the_same_features():
    rng = random.Random(1)
    text = " ".join(rng.choices(["ab", "É", "c-d", "long" * 20], k=500)).encode()
    want, n = features(text.decode())
    for size in (1, 7, 64, 1 << 20):
        counts, total, words = resampling.bucket_counts(text, size)
        assert {i: int(c) for i, c in enumerate(counts) if c} == dict(want) and (total, words) == (sum(want.values()), n)


def test_planes_weigh_as_products_do():
    import numpy as np

    rng = np.random.default_rng(4)
    gains = rng.integers(-9000, 9000, resampling.BUCKETS)
    counts = np.zeros(resampling.LANES * 64, np.int64)
    counts[: resampling.BUCKETS] = rng.integers(0, 1 << rng.integers(1, 40), resampling.BUCKETS)
    assert resampling.GainPlanes(gains.tolist()).weigh(counts) == sum(int(a) * int(b) for a, b in zip(counts, gains))
