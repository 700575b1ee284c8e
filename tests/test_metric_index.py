"""The metric index against brute force, and how much it leaves out."""

import math
import random

import numpy as np
import pytest

from tidewright.operators import knn
from tidewright.operators.knn_blocks import BestK, Points, compare, score_block
from tidewright.operators.metric_index import MetricIndex

SCHEMA = "id long, embedding array<double>"


def clustered(n, clusters, dim=12, spread=0.05, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((clusters, dim))
    return [(i, (centres[i % clusters] + spread * rng.standard_normal(dim)).tolist()) for i in range(n)]


def brute(queries, items, k, metric, skip_self=False):
    out = {}
    m = np.array([v for _, v in items])
    for qid, q in queries:
        scores = score_block(np.array([q]), m, metric)[0]
        ranked = sorted((-round(float(s), 9), i) for s, (i, _) in zip(scores, items) if not (skip_self and i == qid))
        out[qid] = [i for _, i in ranked[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append(r.item_id)
    return out


@pytest.mark.parametrize("metric", ["ip", "cosine", "l2"])
def test_equals_brute_force_on_clustered_vectors(frame, metric):
    items = clustered(700, 9)
    items += [(1000 + i, v) for i, (_, v) in enumerate(items[:60])]  # the same again: ties
    items += [(2000, [0.0] * 12), (2001, [0.0] * 12)]
    queries = clustered(150, 14, seed=2) + [(5000, [0.0] * 12), items[3]]
    got = knn.top_k(
        frame(queries, SCHEMA), frame(items, SCHEMA).repartition(4), 6, query_id="id", item_id="id", metric=metric, bound=1, block_rows=32
    )
    assert found(got) == brute(queries, items, 6, metric)


def test_all_neighbours_of_a_hot_spot(frame):
    # A third of all rows in one place, so one cell is far larger than a block, and neighbours across its rings.
    rng = np.random.default_rng(7)
    items = clustered(400, 8) + [(500 + i, (np.ones(12) + 0.001 * rng.standard_normal(12)).tolist()) for i in range(200)]
    df = frame(items, SCHEMA)
    got = knn.top_k(df, df, 4, query_id="id", item_id="id", metric="cosine", skip_self=True, bound=1, block_rows=16)
    assert found(got) == brute(items, items, 4, "cosine", skip_self=True)


def test_fewer_pairs_on_clustered_vectors(frame):
    items = clustered(3000, 30, spread=0.02)
    df = frame(items, "key long, vec array<double>")
    index = MetricIndex(df, "cosine", block_rows=128)
    visited = index.pairs(index.plan(df, 5, skip_self=True))
    assert visited < 0.2 * len(items) ** 2


@pytest.mark.parametrize("n", [1, 3])
def test_fewer_items_than_asked_for(frame, n):
    items = clustered(n, 2)
    got = knn.top_k(frame(clustered(5, 2, seed=4), SCHEMA), frame(items, SCHEMA), 7, query_id="id", item_id="id", bound=1, block_rows=2)
    assert {len(v) for v in found(got).values()} == {n}


def test_text_ids(frame):
    items = [(f"item {i:03d}", v) for i, v in clustered(80, 4)]
    queries = [(f"q{i}", v) for i, v in clustered(10, 4, seed=3)]
    schema = "id string, embedding array<double>"
    got = knn.top_k(frame(queries, schema), frame(items, schema), 3, query_id="id", item_id="id", metric="l2", bound=1, block_rows=8)
    assert found(got) == brute(queries, items, 3, "l2")


def test_best_k_keeps_ties_by_id_over_blocks():
    rng = random.Random(5)
    scores = np.array([[float(rng.randrange(4)) for _ in range(60)] for _ in range(7)])
    ids = np.arange(60) * 3
    best = BestK(np.arange(7), 5)
    for at in range(0, 60, 11):
        best.add(0, ids[at : at + 11], scores[:, at : at + 11])
    rows, items, _, ranks = best.result()
    for q in range(7):
        want = [i for _, i in sorted((-s, i) for s, i in zip(scores[q], ids))[:5]]
        assert items[rows == q].tolist() == want and ranks[rows == q].tolist() == [1, 2, 3, 4, 5]


def test_matrix_of_scores(frame):
    items, queries = clustered(5, 2), clustered(9, 3, seed=8)
    got = knn.similarities(frame(queries, SCHEMA), frame(items, SCHEMA), query_id="id", item_id="id", metric="cosine").collect()
    assert len(got) == 45
    known = {(q, i): s for (q, x) in queries for (i, _), s in zip(items, score_block(np.array([x]), np.array([v for _, v in items]), "cosine")[0])}
    assert all(math.isclose(r.score, known[(r.query_id, r.item_id)], abs_tol=1e-12) for r in got)


def test_rows_that_travel_do_not_grow_with_the_blocks(frame, monkeypatch):
    # Vectors without any structure: nothing is ruled out, every query meets every block.
    from tidewright.operators import metric_index

    rng, stored = np.random.default_rng(3), {}
    items = [(i, rng.standard_normal(12).tolist()) for i in range(400)]
    keep = metric_index.settled

    def settled(df, name):
        out = keep(df, name)
        stored[name] = stored.get(name, 0) + out.count()
        return out

    monkeypatch.setattr(metric_index, "settled", settled)
    monkeypatch.setattr(metric_index, "REGION_BYTES", 150 * 12 * 8)  # three regions
    df = frame(items, SCHEMA)
    got = knn.top_k(df, df, 4, query_id="id", item_id="id", metric="cosine", skip_self=True, bound=1, block_rows=8)
    assert found(got) == brute(items, items, 4, "cosine", skip_self=True)
    assert stored["index-visits"] <= 3 * len(items)


@pytest.mark.parametrize("skip_self", [False, True])
def test_blocks_in_single_precision_first(skip_self):
    # Differences far below single precision decide, and ties are many.
    rng = np.random.default_rng(11)
    m = np.repeat(rng.standard_normal((300, 16)), 2, axis=0)
    m[::2] += 2e-8 * rng.standard_normal((300, 16))
    m = np.concatenate((m, np.ones((9000, 16)), np.zeros((3, 16))))
    ids, queries = np.arange(len(m)), np.concatenate((np.arange(600), [700, 9602]))
    best = BestK(queries, 5, skip_self)
    compare(best, np.arange(len(queries)), Points(m[queries], "cosine"), ids, Points(m, "cosine"))
    rows, items, _, _ = best.result()
    scores = np.round(np.einsum("id,jd->ij", Points(m[queries], "cosine").m, Points(m, "cosine").m), 9)
    if skip_self:
        scores[np.arange(len(queries)), queries] = -np.inf
    for i in range(len(queries)):
        assert items[rows == i].tolist() == np.lexsort((ids, -scores[i]))[:5].tolist()
