"""Neighbours, chunks, lexical ranking, contexts."""

import math
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewright.operators import chunking, knn, lexical
from tidewright.operators.layout import percentile_rank, running_totals
from tidewright.plans import retrieval as rt


def vectors(n, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    return [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(n, dim)))]


def brute_top(queries, items, k, metric="ip", skip_self=False):
    out = {}
    for qid, q in queries:
        scored = []
        for i, v in items:
            if skip_self and i == qid:
                continue
            d = sum(a * b for a, b in zip(q, v))
            if metric == "cosine":
                d /= math.sqrt(sum(a * a for a in q)) * math.sqrt(sum(b * b for b in v))
            if metric == "l2":
                d = -math.dist(q, v)
            scored.append((-round(d, 9), i))
        out[qid] = [i for _, i in sorted(scored)[:k]]
    return out


@pytest.mark.parametrize("metric", ["ip", "cosine", "l2"])
@pytest.mark.parametrize("bound", [1 << 20, 64 * 40, 1], ids=["items travel", "queries travel", "blocks meet"])
def test_top_k_is_exact_on_every_path(frame, metric, bound):
    q, c = vectors(30), vectors(300, seed=2)
    schema = "id long, embedding array<double>"
    got = knn.top_k(frame(q, schema), frame(c, schema).repartition(5), 4, query_id="id", item_id="id", metric=metric, bound=bound, block_rows=20)
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.item_id)
    assert found == brute_top(q, c, 4, metric)


def test_all_neighbours_without_self_with_duplicates(frame):
    rows = vectors(50) + [(100 + i, v) for i, v in vectors(50)]  # every vector twice
    df = frame(rows, "id long, embedding array<double>")
    for bound in (1 << 20, 1):
        got = knn.top_k(df, df, 3, query_id="id", item_id="id", metric="cosine", skip_self=True, bound=bound, block_rows=16)
        found = {}
        for r in got.orderBy("query_id", "rank").collect():
            found.setdefault(r.query_id, []).append(r.item_id)
        assert found == brute_top(rows, rows, 3, "cosine", skip_self=True)


def test_fewer_items_than_k_and_none(frame):
    schema = "id long, embedding array<double>"
    q = frame(vectors(2), schema)
    assert knn.top_k(q, frame(vectors(3), schema), 5, query_id="id", item_id="id").count() == 6
    assert knn.top_k(q, frame([], schema), 5, query_id="id", item_id="id").count() == 0


def test_upsert_last_write_wins(frame):
    schema = "doc_id string, embedding array<double>, version int"
    got = knn.upsert(frame([("a", [1.0], 1), ("b", [1.0], 1)], schema), frame([("b", [2.0], 2), ("c", [3.0], 2)], schema))
    assert {r.doc_id: (r.embedding, r.version) for r in got.collect()} == {"a": ([1.0], 1), "b": ([2.0], 2), "c": ([3.0], 2)}


def test_hot_keys_meet_their_partners_by_broadcast(frame):
    from tidewright.operators.sizes import join_hot

    rows = frame([(i, "hot" if i % 3 else f"k{i}") for i in range(300)] + [(900, "absent")], "id long, key string")
    unique = frame([("hot", "h")] + [(f"k{i}", f"v{i}") for i in range(0, 300, 6)], "key string, v string")
    plain = sorted(map(tuple, rows.join(unique, "key", "left").select("id", "key", "v").collect()))
    got = join_hot(rows, unique, "key", hot_rows=10)
    assert "BroadcastHashJoin" in got._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, got.select("id", "key", "v").collect())) == plain
    assert sorted(map(tuple, join_hot(rows, unique, "key").select("id", "key", "v").collect())) == plain


def windows(text, size=160, overlap=20):
    out, start = [], 0
    while start < len(text):
        out.append(text[start:start + size])
        if start + size >= len(text):
            break
        start += size - overlap
    return out


def test_fixed_chunks_equal_the_loop(frame):
    texts = ["", "a", "b" * 160, "c" * 161, "d" * 300, "é" * 301, "".join(chr(97 + i % 26) for i in range(140 * 300 + 7)), None]
    got = {}
    for r in chunking.fixed(frame(list(enumerate(texts)), "k long, text string"), "k").orderBy("k", "chunk_id").collect():
        got.setdefault(r.k, []).append((r.chunk_id, r.chunk))
    for k, text in enumerate(texts):
        assert got.get(k, []) == list(enumerate(windows(text or "")))


WORD = st.text(alphabet="abcdefgé", min_size=1, max_size=30)
GLUE = st.sampled_from([" ", ". ", "\n", "\n- ", "\n## ", "\n### "])


def covers(text, chunks, overlap):
    """Whether the chunks can be placed in order so that they skip only white space and overlap at most so far.

    A short chunk can occur in several places ("##" inside "###"), so every
    placement is followed, not just the first one found.
    """
    ends = {0}
    for c in chunks:
        starts = [i for i in range(len(text)) if text.startswith(c, i)]
        ends = {s + len(c) for s in starts for e in ends if e - overlap - 4 <= s and not text[e:s].strip(" \n")}
    return any(not text[e:].strip(" \n") for e in ends)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(WORD, GLUE), max_size=120))
def test_recursive_chunks_cover_the_text_within_size(parts):
    words = [f"{a}{i}x" for i, (a, _) in enumerate(parts)]  # numbered, so a lost one cannot hide behind its copy
    for tokens in ([a for a, _ in parts], words):
        text = "".join(w + b for w, (_, b) in zip(tokens, parts))
        chunks = chunking.split_recursive(text, 120, 30)
        assert all(0 < len(c) <= 120 for c in chunks)
        assert covers(text, chunks, 30)
        assert all(any(w in c for c in chunks) for w in tokens)


def test_cover_check_notices_lost_text():
    text = "".join(f"word{i} " for i in range(100))
    chunks = chunking.split_recursive(text, 120, 30)
    assert covers(text, chunks, 30)
    assert not covers(text, chunks[:-1], 30) and not covers(text, chunks[1:], 30)
    assert not covers(text, chunks[:2] + chunks[4:], 30)


def test_recursive_prefers_headings(frame):
    text = "intro " * 30 + "\n## One\n" + "body " * 40 + "\n## Two\n" + "tail " * 40
    chunks = [r.chunk for r in chunking.recursive(frame([(1, text)], "k long, text string"), "k").orderBy("chunk_id").collect()]
    assert any(c.startswith("## One") for c in chunks) and any(c.startswith("## Two") for c in chunks)


@pytest.mark.parametrize("batch", [4096, 2])
def test_bm25_equals_brute_force(frame, batch):
    docs = [(i, t) for i, t in enumerate(["the disk is full", "disk disk error", "the cat", "a full moon is full", "", "error in the disk"])]
    queries = [(0, "full disk"), (1, "the error"), (2, "unknown words"), (3, "moon cat"), (4, "is")]
    got = {}
    found = lexical.bm25(frame(docs, "doc_id long, text string"), frame(queries, "query_id long, text string"), 3, block_queries=batch)
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.item_id, round(r.score, 6)))
    tokens = {i: t.split() for i, t in docs}
    mean = sum(map(len, tokens.values())) / len(docs)
    want = {}
    for q, text in queries:
        scores = {}
        for i, words in tokens.items():
            tf, s = Counter(words), 0.0
            for w in set(text.split()):
                df = sum(w in v for v in tokens.values())
                if tf[w]:
                    s += math.log(1 + (len(docs) - df + 0.5) / (df + 0.5)) * tf[w] * 2.5 / (tf[w] + 1.5 * (0.25 + 0.75 * len(words) / mean))
            if s:
                scores[i] = round(s, 6)
        if scores:
            want[q] = sorted(scores.items(), key=lambda x: (-x[1], x[0]))[:3]
    assert got == want


def test_rerank_and_context(frame):
    rows = [(1, "x", 1, "the red fox", "red fox"), (1, "y", 2, "blue", "red fox"), (1, "z", 3, "red", "red fox")]
    df = frame(rows, "query_id long, item_id string, chunk_id int, passage string, query string").withColumn("source", F.col("item_id"))
    best = lexical.rerank(df, lexical.shared_word_ratio(F.col("query"), F.col("passage")), keep=2)
    assert [(r.item_id, r.new_rank) for r in best.orderBy("new_rank").collect()] == [("x", 1), ("z", 2)]
    assert rt.build_context(best).first().context == "[Fonte: x | chunk 1]\nthe red fox\n\n[Fonte: z | chunk 3]\nred"


def test_context_of_empty_and_small_store(frame):
    asked = frame([(1, "disk full"), (2, "cpu high")], "query_id long, query string")
    schema = "item_id string, content string, type string, source string"
    empty = rt.retrieve_context(asked, frame([], schema)).collect()
    assert {r.context for r in empty} == {rt.NOTHING_FOUND}
    docs = frame([(f"runbooks/{i}", "text " * 200, "runbooks", "s") for i in range(3)], schema)
    got = rt.retrieve_context(asked, docs).collect()
    assert len(got) == 2 and all(r.context.count("Fonte:") == 3 and "..." in r.context for r in got)


def test_percentile_rank_equals_pandas_with_hot_group_and_ties(frame):
    import random

    import pandas as pd

    rng = random.Random(2)
    rows = [(i, 0 if rng.random() < 0.7 else rng.randrange(4), float(rng.randrange(40)) if rng.random() < 0.8 else 1.0) for i in range(2000)]
    got = {r.id: r.p for r in percentile_rank(frame(rows, "id long, g int, v double"), "g", "v", "p", partitions=7).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    pdf["p"] = pdf.groupby("g")["v"].rank(pct=True)
    assert all(abs(got[i] - p) < 1e-12 for i, p in zip(pdf["id"], pdf["p"]))


def test_running_totals_over_partitions(frame):
    rows = [(g, i, (i * 7) % 5) for g in (1, 2) for i in range(200)]
    got = running_totals(frame(rows, "g int, i int, v int").repartition(6), ["g"], ["i"], {"t": "v"}, partitions=9)
    sums = {}
    for r in got.orderBy("g", "i").collect():
        sums[r.g] = sums.get(r.g, 0) + r.v
        assert r.t == sums[r.g]


def test_recursive_chunks_leave_in_small_batches(frame, monkeypatch):
    text = "Some words of a sentence. " * 40
    df = frame([(i, text if i % 3 else None) for i in range(50)] + [(99, "")], "k long, text string").coalesce(1)
    seen = []

    class Rows:
        schema = df.schema

        def select(self, *columns):
            self.rows = df.select(*columns)
            return self

        def mapInArrow(self, run, schema):
            out = [b for b in run(iter(self.rows.toArrow().to_batches()))]
            seen.extend(b.num_rows for b in out)
            return out

    monkeypatch.setattr(chunking, "OUT_CHARS", 3000)
    out = chunking.recursive(Rows(), "k")
    want = [(i, n, c) for i in range(50) if i % 3 for n, c in enumerate(chunking.split_recursive(text))]
    assert [tuple(r.values()) for b in out for r in b.to_pylist()] == want
    assert max(seen) < 20 and len(want) > 100


def test_stored_chunks_are_not_written_again(spark, frame, tmp_path, monkeypatch):
    from tidewright.operators import knn

    names = []
    keep = knn.settled
    monkeypatch.setattr(knn, "settled", lambda df, name: names.append(name) or keep(df, name))
    chunks = [(f"c{i}", i, 0, f"text {i}", [float(i % 7), 1.0]) for i in range(30)]
    table = frame(chunks, "item_id string, source int, chunk_id int, chunk string, embedding array<double>")
    table.write.parquet(str(tmp_path / "chunks"))
    queries = frame([("q", [1.0, 0.1])], "query_id string, embedding array<double>")
    got = [rt.search_chunks(queries, spark.read.parquet(str(tmp_path / "chunks")), "fixed", 3, stored=s).orderBy("rank").collect() for s in (True, False)]
    assert got[0] == got[1] and len(got[0]) == 3 and names == ["queries", "items"]


def test_rank_takes_no_larger_task_for_a_hot_value(frame):
    import random

    import pandas as pd

    from tidewright.operators import layout

    rng = random.Random(5)
    rows = [(i, rng.choice(["a", "b", "c", None]), None if i % 97 == 0 else 3.0 if rng.random() < 0.6 else rng.random() * 6) for i in range(6000)]
    df = frame(rows, "id long, g string, v double")
    got = {r.id: r.p for r in percentile_rank(df, "g", "v", "p", partitions=12).collect()}
    pdf = pd.DataFrame(rows, columns=["id", "g", "v"])
    pdf["p"] = pdf.groupby("g")["v"].rank(pct=True)
    assert len(got) == 6000 and all(got[i] is None if pd.isna(p) else abs(got[i] - p) < 1e-12 for i, p in zip(pdf["id"], pdf["p"]))
    whole = df.filter("g IS NOT NULL AND v IS NOT NULL").select("g", "v")
    moved = layout.ranked_rows(df, "g", "v", layout._bounds(whole, whole.count(), 12), 12)
    sizes = [r["count"] for r in moved.groupBy(F.spark_partition_id().alias("t")).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 1000  # the hot value alone has 3,600 rows


def test_first_values_are_distinct_and_start_with_null(frame):
    from tidewright.operators.layout import first_values

    rows = [(t,) for t in ["b", "a", None, "ç", "a", "c", "b", "z"] * 30]
    df = frame(rows, "t string").repartition(6)
    assert [r.t for r in first_values(df, "t", 4).orderBy("t").collect()] == [None, "a", "b", "c"]
    assert [r.t for r in first_values(df.where("t > 'b'"), "t", 9).orderBy("t").collect()] == ["c", "z", "ç"]
