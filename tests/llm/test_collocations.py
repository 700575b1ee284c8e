"""Collocations against counting by hand."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidewright.llm import collocations as co

DOCS = "doc_id long, text string, lang string, phrase string, _part int, c int"


def brute(rows, min_count=30, covered=80, top=2000):
    f, n = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        longest = Counter()
        for p, a in cands.items():
            for i in range(len(p)):
                for j in range(i + 1, len(p) + 1):
                    if j - i < len(p):
                        longest[p[i:j]] = max(longest[p[i:j]], a)
        kept = []
        for p, a in cands.items():
            if longest[p] and 100 * longest[p] >= covered * a:
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(kept)[:top], start=1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return sorted(out)


def corpus(seed, n):
    rng = random.Random(seed)
    words = ["the", "The", "of", "new", "york", "city", "ÉTÉ", "été", "a\x01b", "a", "x" * 300, "日本", "KK"]
    weights = [len(words) - i for i in range(len(words))]
    return [
        (rng.choice((" ", "  ", "\t")).join(
            w + (rng.choice(".,;:!?\n\x0b\r") if rng.random() < 0.15 else "") for w in rng.choices(words, weights, k=rng.randrange(30))
        ), rng.choice(("en", "en", "fr", None, "und")))
        for _ in range(n)
    ]


def run(spark, rows, **how):
    df = spark.createDataFrame([(i, t, lang, "x", 1, 2) for i, (t, lang) in enumerate(rows)], DOCS).repartition(3)
    return sorted(map(tuple, co.collocations(df, **how).collect()))


@pytest.mark.parametrize("how", [{}, {"size": 40, "flush": 200}])
def test_equals_counting_by_hand(spark, how, monkeypatch):
    rows = corpus(5, 2000)
    rows += [(None, "en"), ("", "de"), (" . ", "it"), ("new york city " * 3000, "long"), ("same line here. " * 3, "rep")] + [("Same line here", "rep")] * 40
    monkeypatch.setattr("tidewright.llm.order.ROWS_PER_PART", 20)
    got = run(spark, rows, **how)
    assert got == brute(rows) and len(got) > 100


def test_parts_of_any_size_of_the_streams_agree(spark, monkeypatch):
    rows = corpus(8, 200)
    want = brute(rows, 5)
    for parts in (7, 100_000):
        original = co.laid_out
        monkeypatch.setattr(co, "laid_out", lambda df, order, part, name, p=parts: original(df, order, part, name, p))
        assert run(spark, rows, min_count=5) == want
        monkeypatch.setattr(co, "laid_out", original)


def test_a_bitmap_that_is_full_costs_work_only(spark, monkeypatch):
    rows = corpus(9, 150)
    full = co.Marked(np.full(4, ~np.uint64(0), np.uint64))
    monkeypatch.setattr(co, "marked", lambda frequent: full)
    assert run(spark, rows, min_count=10, top=7) == brute(rows, 10, top=7)


@pytest.mark.parametrize("rows", [[], [(None, None)], [("", "en")]])
def test_nothing_to_count(spark, rows):
    assert run(spark, rows) == []


def test_segments_hold_every_run_of_words_once():
    rng = random.Random(2)
    text = b"".join(rng.choice((b"a", b"bb", b"ccc" * 9)) + rng.choice((b" ", b" ", b"  ", b"\n")) for _ in range(300)) + b"z" * 90
    for size in (1, 5, 17, 64, 10_000):
        for k in (1, 2, 3, 4):
            def runs(parts):
                out = Counter()
                for part in parts:
                    for piece in part.split(b"\n"):
                        w = piece.split()
                        out.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
                return out

            assert runs(co.segments(text, k - 1, size)) == runs([text])


def test_marked_phrases_are_always_found():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    words = np.zeros(64, np.uint64)
    at, bit = co.Marked.place(keys, 64)
    np.bitwise_or.at(words, at, bit)
    assert co.Marked(words).has(keys).all()


def test_scores_are_exact_beyond_64_bits(spark):
    a, part = 9_000_000_000_007, 9_000_000_000_008
    rows = [("en", "x", part), ("en", "y", part + 5), ("en", "x y", a)]
    got = co.candidates(spark.createDataFrame(rows, "lang string, phrase string, c long")).collect()
    assert [r.score for r in got] == [2000000 * a // (2 * part + 5)]
