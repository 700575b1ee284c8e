"""k-means by passes over a table of vectors: candidates, sums and counts leave a task, and no copy of the vectors is made."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from .knn_blocks import columns, joined

# What Spark's own k-means does by default.
DRAWS, ITERATIONS, MOVED, LOCAL_ITERATIONS = 2, 20, 1e-4, 30
BLOCK_ROWS = 4096


def fit(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """Centres of the one column of ``rows``, bytes of hashes: k-means|| for the first ones, then Lloyd's steps until none moves by more than ``MOVED``.

    The rows are read at most 24 times, so they should be a table.
    """
    centres = drawn(rows, None, 1, seed, 0)
    if not len(centres):
        raise ValueError("no vectors to fit")
    for step in range(1, DRAWS + 1):
        centres = np.unique(np.concatenate([centres, drawn(rows, centres, 2 * k, seed, step)]), axis=0)
    if len(centres) > k:
        centres = chosen(centres, totals(rows, centres)[1], k, seed)
    for _ in range(ITERATIONS):
        sums, counts = totals(rows, centres)
        moved = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
        far = np.sqrt(((moved - centres) ** 2).sum(axis=1)).max()
        centres = moved
        if far <= MOVED:
            break
    return centres


def _vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Blocks of the vectors that are not null, side by side."""
    for b in batches:
        known = joined(b.column(0)).drop_null()
        for i in range(0, len(known), BLOCK_ROWS):
            yield columns(known[i : i + BLOCK_ROWS], len(known[0].as_py()))


def _costs(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of unit vectors (columns) to the centres (rows)."""
    return np.maximum((x * x).sum(axis=0) + (centres * centres).sum(axis=1)[:, None] - 2 * (centres @ x), 0)


def drawn(rows: DataFrame, centres: np.ndarray | None, n: int, seed: int, step: int) -> np.ndarray:
    """``n`` rows drawn by chance, each in proportion to its squared distance from the nearest centre (all alike without centres).

    A row's waiting time is exponential at the rate of its weight, and the first ones are drawn, so one pass does without the sum of the weights.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng([seed, step, TaskContext.get().partitionId()])
        times, found = np.empty(0), None
        for x in _vectors(batches):
            weight = np.ones(x.shape[1]) if centres is None else _costs(x, centres).min(axis=0)
            wait = rng.exponential(size=x.shape[1]) / np.maximum(weight, 1e-300)
            first = np.flatnonzero(weight > 1e-12)
            first = first[np.argsort(wait[first])[:n]]
            times, found = np.concatenate([times, wait[first]]), x[:, first] if found is None else np.concatenate([found, x[:, first]], axis=1)
            keep = np.argsort(times)[:n]
            times, found = times[keep], found[:, keep]
        yield pa.RecordBatch.from_arrays([pa.array(times), pa.array([v.tobytes() for v in found.T] if found is not None else [], pa.binary())], names=["wait", "v"])

    # At most n rows per task.
    first = sorted(rows.mapInArrow(run, "wait double, v binary").collect(), key=lambda r: r["wait"])[:n]
    size = len(first[0]["v"]) // 8 if first else 0 if centres is None else centres.shape[1]
    return np.frombuffer(b"".join(r["v"] for r in first)).reshape(len(first), size)


def totals(rows: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum of the vectors nearest to each centre, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros(centres.shape), np.zeros(len(centres))
        offset = (centres * centres).sum(axis=1)[:, None]
        for x in _vectors(batches):
            member = ((offset - 2 * (centres @ x)).argmin(axis=0) == np.arange(len(centres))[:, None]).astype(float)
            sums, counts = sums + member @ x.T, counts + member.sum(axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()]), pa.array([counts.tobytes()])], names=["sums", "counts"])

    parts = rows.mapInArrow(run, "sums binary, counts binary").collect()  # a number per centre and place of each task
    return (
        sum((np.frombuffer(p["sums"]).reshape(centres.shape) for p in parts), np.zeros(centres.shape)),
        sum((np.frombuffer(p["counts"]) for p in parts), np.zeros(len(centres))),
    )


def chosen(points: np.ndarray, weights: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k of a few weighted points by k-means++, moved by Lloyd's steps among them."""
    rng = np.random.default_rng(seed)
    weights = np.maximum(weights, 1e-9)
    centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
    while len(centres) < k:
        share = weights * _costs(points.T, centres).min(axis=0)
        share = share if share.sum() > 0 else weights
        centres = np.concatenate([centres, points[[rng.choice(len(points), p=share / share.sum())]]])
    for _ in range(LOCAL_ITERATIONS):
        member = (_costs(points.T, centres).argmin(axis=0) == np.arange(k)[:, None]) * weights
        full = member.sum(axis=1, keepdims=True)
        moved = np.where(full > 0, member @ points / np.where(full > 0, full, 1), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres
