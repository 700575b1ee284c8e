"""Near-duplicate embeddings against all pairs."""

import math

import numpy as np
import pytest

from tidewright.llm import embedding_dedup as ed

ROWS = "vec_id long, embedding array<double>, label int, node int, n int, kept_id int"


def brute(rows):
    """vec_id -> (n_links, component_id), over rows."""
    def fit(vec, label):
        return label is not None and vec and all(x is not None and math.isfinite(x) for x in vec) and any(vec)

    n = len(rows)
    links, top = [0] * n, list(range(n))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(n):
        for j in range(i):
            (_, x, a), (_, y, b) = rows[i], rows[j]
            if a == b and fit(x, a) and fit(y, b) and len(x) == len(y):
                x, y = np.array(x), np.array(y)
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                if x @ y / math.sqrt((x @ x) * (y @ y)) >= 0.98:
                    links[i] += 1
                    links[j] += 1
                    top[max(find(i), find(j))] = min(find(i), find(j))
    least = {}
    for i in range(n):
        vec_id = rows[i][0]
        old = least.get(find(i), vec_id)
        least[find(i)] = vec_id if old is None else old if vec_id is None else min(old, vec_id)
    return sorted(((rows[i][0], links[i], least[find(i)], rows[i][0] == least[find(i)]) for i in range(n)), key=str)


def run(spark, rows, **how):
    df = spark.createDataFrame([(*r, 1, 2, 3) for r in rows], ROWS).repartition(3)
    return sorted(map(tuple, ed.near_duplicates(df, **how).collect()), key=str)


def clouds(seed, dim=32):
    """Lone vectors, pairs, a cloud whose cosines lie about the threshold, exact copies."""
    rng = np.random.default_rng(seed)
    out = []

    def near(center, spread):
        step = rng.standard_normal(dim)
        return center + spread * step / np.linalg.norm(step)

    for i in range(150):
        center = rng.standard_normal(dim)
        center /= np.linalg.norm(center)
        out.append((center, i % 3))
        if i % 3 == 0:
            out.append((near(center, 0.1 + 0.001 * i) * 7, i % 3))
            out.append((near(center, 0.1), (i + 1) % 3))  # another label: no link
    hub = rng.standard_normal(dim)
    hub /= np.linalg.norm(hub)
    out += [(near(hub, 0.145), 1) for _ in range(300)]
    out += [(hub, 1)] * 40
    order = rng.permutation(len(out))
    return [(int(i), out[k][0].tolist(), out[k][1]) for i, k in enumerate(order)]


def test_equals_all_pairs(spark):
    rows = clouds(1)
    assert run(spark, rows) == brute(rows)


def test_small_blocks_and_chunks_give_the_same(spark, monkeypatch):
    rows = clouds(2)
    for name, value in {"WINDOW": 8, "BLOCK": 64, "CHUNK": 50, "SMALL": 2}.items():
        monkeypatch.setattr(ed, name, value)
    monkeypatch.setattr("tidewright.llm.order.ROWS_PER_PART", 300)
    assert run(spark, rows) == brute(rows)


def test_what_cannot_be_compared_stands_alone(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [1.0, 0.0], None), (4, None, 1), (5, [0.0, 0.0], 1), (6, [1.0, None], 1),
        (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [], 1), (10, [1.0, 0.0, 0.0], 1), (11, [1e300, 0.0], 1), (12, [1e-300, -0.0], 1), (13, [1.0, 0.0], 2),
        (None, [1.0, 0.0], 1),
    ]
    got = run(spark, rows)
    # Rows 1, 2, 2, 11, 12 and the one without an id are one class.
    assert [r for r in got if r[0] not in (1, 2, 11, 12, None)] == sorted(((i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 13)), key=str)
    assert sorted((str(r[0]), r[1], r[2]) for r in got if r[0] in (1, 2, 11, 12, None)) == sorted((str(i), 5, 1) for i in (1, 2, 2, 11, 12, None))
    kept = ed.keep_one_of_each(spark.createDataFrame([(*r, 1, 2, 3) for r in rows], ROWS))
    assert sorted(r.vec_id for r in kept.collect()) == [1, 3, 4, 5, 6, 7, 8, 9, 10, 13] and kept.columns[-1] == "kept_id"


@pytest.mark.parametrize("rows", [[], [(1, [1.0], None)], [(1, [1.0, 2.0], 1)]])
def test_nothing_to_link(spark, rows):
    assert run(spark, rows) == brute(rows)


def test_passes_grow_with_the_logarithm_of_a_label():
    assert [ed.n_passes(n) for n in (1, 128, 5_000, 10**9)] == sorted(ed.n_passes(n) for n in (1, 128, 5_000, 10**9))
    assert ed.n_passes(1) == 2 and ed.n_passes(10**9) < 50


def test_roots_are_least_members():
    rng = np.random.default_rng(5)
    for n, m in ((50, 20), (200, 300), (10, 0)):
        a, b = rng.integers(0, n, m), rng.integers(0, n, m)
        top = list(range(n))
        for _ in range(n):
            for i, j in zip(a, b):
                top[i] = top[j] = min(top[i], top[j])
        assert ed._roots(n, a, b).tolist() == top
