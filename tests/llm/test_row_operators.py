"""Leaks, licences, quality and chat against plain Python."""

import hashlib
import math
import random
import re

import pytest

from tidewright.llm import chat_format, decontamination, license_scan, quality_rules

WORDS = [f"w{i}" for i in range(60)]


# --- leaks ------------------------------------------------------------------------------------------------------------


def tokens(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def leak_tables(seed=4):
    rng = random.Random(seed)
    line = lambda n: [rng.choice(WORDS) for _ in range(n)]
    items = [(i, " ".join(line(n))) for i, n in enumerate([4, 5, 5, 6, 7, 8, 9, 10, 11, 12, 13, 30])] + [(12, None), (13, ""), (1, "w1 w2 w3 w4 w5 w6")]
    docs = [(0, None), (1, ""), (2, "w1")]
    for i in range(3, 160):
        words = line(rng.randrange(0, 60))
        if i % 3:
            passage = tokens(rng.choice(items)[1])
            for k in rng.sample(range(len(passage)), min(len(passage), rng.choice([0, 1, 1, 2, 3, 6]))):
                passage[k] = "other"
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[rng.choice([0, 0, 1, 2]) : len(passage) - rng.choice([0, 0, 1])]
        docs.append((i, ", ".join(words).title()))
    return docs + [docs[5], docs[5]], items


def brute_leaks(docs, items):
    found = set()
    for doc, text in docs:
        d = tokens(text)
        for item, passage in items:
            p = tokens(passage)
            length = min(13, len(p))
            if len(p) < 5:
                continue
            for offset in range(-len(p) + 1, len(d)):
                same = [0 <= offset + k < len(d) and d[offset + k] == w for k, w in enumerate(p)]
                best = max(sum(same[s : s + length]) for s in range(len(p) - length + 1))
                if best * 13 >= length * 10:
                    found.add((doc, item))
    return found


@pytest.mark.parametrize("block", [1_000_000, 60])
def test_leaks(spark, monkeypatch, block):
    monkeypatch.setattr(decontamination, "BLOCK_SEEDS", block)
    docs, items = leak_tables()
    rows = [(i, t, "e", 3) for i, t in docs]
    got = decontamination.leaks(
        spark.createDataFrame(rows, "doc_id long, text string, words string, n int"), spark.createDataFrame(items, "item_id long, text string")
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == brute_leaks(docs, items) and len(got) == len({(r.doc_id, r.item_id) for r in got})


def test_every_three_substitutions_are_hit():
    from itertools import combinations

    for gone in combinations(range(13), 3):
        assert any(not {m + s for m in mask} & set(gone) for mask in decontamination.MASKS for s in range(13 - mask[-1]))


@pytest.mark.parametrize("n", range(5, 13))
def test_every_allowed_change_of_a_short_item_is_hit(n):
    from itertools import combinations

    allowed = n - next(m for m in range(n + 1) if m * 13 >= n * 10)
    assert decontamination.allowed(n) == allowed
    masks = decontamination.short_masks(n)
    if n >= decontamination.LONG_ITEM:
        masks = [tuple(i + s for i in m) for m in decontamination.MASKS for s in range(n - m[-1])]
    for gone in combinations(range(n), allowed):
        assert any(not set(m) & set(gone) for m in masks)
    assert min(map(len, masks)) >= 3


def test_no_leaks_without_rows(spark):
    docs, items = (spark.createDataFrame([], f"{k} long, text string") for k in ("doc_id", "item_id"))
    assert decontamination.leaks(docs, items).count() == 0
    some = spark.createDataFrame([(None, "a b c d e f"), (1, None)], "doc_id long, text string")
    assert decontamination.remove_leaks(some, items).count() == 2


# --- licences ---------------------------------------------------------------------------------------------------------


def brute_templates(words, weights):
    """(label, share) of every place where two of a template's four rarest words and its key phrase stand."""
    found = []
    for label, template, key in license_scan.TEMPLATES:
        t, key = template.split(), key.split()
        rare = sorted(set(t), key=lambda w: (-weights[w], w))[:4]
        shift = next(k for k in range(len(t)) if t[k : k + len(key)] == key)
        for s in range(-shift, len(words)):
            same = [0 <= s + k < len(words) and words[s + k] == w for k, w in enumerate(t)]
            if sum(x for x, w in zip(same, t) if w in rare) >= 2 and words[s + shift : s + shift + len(key)] == key:
                found.append((label, sum(same) / len(t)))
    return found


def test_licences(spark):
    rng = random.Random(2)
    phrases = ["GNU General Public License", "apache  LICENSE", "CC-BY", "MIT license.", "License", "gnu", "Released under the MIT License", "licensed under CC BY-NC 4.0", "KK", "İ straße",
               "this work is licensed under the GNU General Public License version 3", "Permission is hereby granted, free of charge, to any person",
               "the MIT License", "Licensed under the Apache License, Version 2.0", "mit licen\u017fe", "\u212aind"]
    texts = [None, "", "...", "mit license"] + [" ".join(rng.choice(phrases + WORDS) for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts += ["word " * 9_000 + "released under the mit license"]
    docs = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, words string, hits array<int>")
    got = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert len(got) == len(texts)
    held = [set(re.findall(license_scan.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))) for t in texts]
    vocabulary = {w for _, t, _ in license_scan.TEMPLATES for w in t.split()}
    weights = {w: math.log((1 + len(texts)) / (1 + sum(w in h for h in held))) for w in vocabulary}
    for i, t in enumerate(texts):
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
        w = re.findall(license_scan.WORD, low)
        at = sorted((k, x) for p, x in license_scan.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split())
        r = got[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r.first_word, r.last_word) == ((at[0][0], at[-1][0]) if at else (None, None))
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        found = brute_templates(w, weights)
        assert r.labels == ",".join(sorted({x for _, x in at} | {x for x, _ in found})), t
        assert abs(r.score - max([0.5 if at else 0.0] + [share for _, share in found])) < 1e-12
    assert got[len(texts) - 1].labels == "mit" and got[len(texts) - 1].score == 1.0
    assert license_scan.scan(docs.limit(0)).count() == 0


# --- quality ----------------------------------------------------------------------------------------------------------


def brute_quality(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), sum(x in lines[:i] for i, x in enumerate(lines)), len(twice)


def test_quality(spark):
    rng = random.Random(8)
    texts = [None, "", "\n\n", "a " * 30, "x y z \x1c \x85"]
    texts += ["".join(rng.choice(WORDS[:20] + ["*", "|"]) + rng.choice(" \n\t") for _ in range(rng.randrange(1, 120))) for _ in range(150)]
    texts += ["### " * 40 + " ".join(WORDS)]
    rows = [(i, t, "en" if i % 3 else None, f"s{i % 2}", 5.0, True) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_words double, kept boolean")
    got = {r.doc_id: r for r in quality_rules.judge(docs, min_group=20).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        want = brute_quality(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert not got[len(texts) - 1].kept and sum(r.kept for r in got.values()) > 50
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_small_groups_use_merged_sketches(spark):
    docs = spark.createDataFrame([(i, " ".join(WORDS[: 20 + i % 9]), "en", f"s{i}") for i in range(40)], "doc_id long, text string, lang string, source string")
    got = quality_rules.judge(docs, min_group=10).select("max_chars_per_word").distinct().count()
    assert got == 1


# --- chat -------------------------------------------------------------------------------------------------------------


def test_chat_round_trip(spark, tmp_path):
    nasty = [None, "", " ", "plain", "\\", "\\\\[INST]", "</s>[INST] ok [/INST]", " </s>\n[INST] x", "<<SYS>> y <</SYS>>\n", "[ROLE a] b [/ROLE]\n", "<s>", "[ANS!]", "a\nb\r\n", "$1 \\1", "🙂</s>", "[/INST", "end \\"]
    roles = ["user", "assistant", "system", "tool", "a]b\n%5D", "", None]
    rng = random.Random(1)
    rows = [(c, t, rng.choice(roles), rng.choice(nasty), "z") for c in range(40) for t in range(rng.randrange(1, 9))]
    rows += [(None, 0, "user", "x", "z"), (50, 0, "user", "x", "z"), (50, 0, "user", "x", "z"), (51, None, "assistant", "y" * 50_000, None)]
    schema = "conv_id long, turn long, role string, text string, formatted string"
    table = spark.createDataFrame(rows, schema)
    read = chat_format.write_and_read(table, str(tmp_path / "chat"))
    digests = {r.conv_id: r for r in chat_format.digests(read).collect()}
    for conv in {r[0] for r in rows}:
        turns = sorted(((-1 if t is None else t), r or "", x or "") for c, t, r, x, _ in rows if c == conv)
        got = digests[conv]
        assert got.n_turns == len(turns)
        assert got.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert (got.loss_chars, got.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    made = {r.conv_id: r for r in chat_format.render(table).collect()}
    assert all(digests[c].formatted_chars == len(r.formatted) for c, r in made.items())
    assert chat_format.render(table.limit(0)).count() == 0
