"""Comparing blocks of vectors inside a task: scores as matrices, the best k per query without a loop over queries."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

TIE_DIGITS = 9  # scores closer than this count as equal; the smaller id wins
TIE = 10.0**-TIE_DIGITS
QUERY_ROWS, ITEM_ROWS, SOME = 512, 4096, 1 << 16  # what a matrix of scores holds, and candidates looked at at once


BYTE_VALUES = np.arange(256) / 255.0 * 2 - 1  # the number a byte of a hash stands for


def joined(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    return column


def matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """List column as a matrix, without touching single rows."""
    column = joined(column)
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def columns(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    """Vectors side by side, a row per number; NaN for those that are null. Bytes (``hash_bytes``) become what ``hash_embedding`` makes of them, to the last bit."""
    column = joined(column)
    known = column.drop_null() if column.null_count else column
    if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type):
        ends = np.frombuffer(known.buffers()[1], np.int64 if pa.types.is_large_binary(column.type) else np.int32)[known.offset : known.offset + len(known) + 1] if len(known) else [0, 0]
        flat = np.frombuffer(known.buffers()[2], np.uint8)[ends[0] : ends[-1]] if len(known) else np.empty(0, np.uint8)
        found = BYTE_VALUES[np.ascontiguousarray(flat.reshape(len(known), dim).T)]
        length = np.sqrt(squares(found))
        found /= np.where(length == 0, 1.0, length)
    else:
        found = matrix(known).T.reshape(dim, len(known))
    if len(known) == len(column):
        return found
    out = np.full((dim, len(column)), np.nan)
    out[:, np.asarray(column.is_valid())] = found
    return out


def squares(found: np.ndarray) -> np.ndarray:
    """Sum of squares of each column, added number by number as the JVM does."""
    out = np.zeros(found.shape[1])
    for numbers in found:
        out += numbers * numbers
    return out


def id_array(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    return np.array(column.to_pylist())


def unit_rows(m: np.ndarray) -> np.ndarray:
    length = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return m / np.where(length == 0, 1.0, length)


def score_block(queries: np.ndarray, items: np.ndarray, metric: str) -> np.ndarray:
    """Higher is better: inner product, cosine, or negative Euclidean distance."""
    if metric == "l2":
        sq = (queries * queries).sum(1)[:, None] + (items * items).sum(1)[None, :] - 2 * queries @ items.T
        return -np.sqrt(np.maximum(sq, 0))
    if metric == "cosine":
        queries, items = unit_rows(queries), unit_rows(items)
    return queries @ items.T


class Points:
    """Vectors of one side, ready to be compared: cosines are found on unit vectors, first in single precision."""

    def __init__(self, m: np.ndarray, metric: str):
        self.metric, self.m = metric, unit_rows(m) if metric == "cosine" else m
        self.low = self.m.astype(np.float32) if metric == "cosine" else None


class BestK:
    """The best k items of each query over any number of blocks; a score of minus infinity is no hit.

    ``floors`` are scores that a query's k-th best reaches for sure; what lies below them is left out before it is sorted.
    """

    def __init__(self, query_ids: np.ndarray, k: int, skip_self: bool = False, floors: np.ndarray | None = None):
        self.query_ids, self.k, self.skip_self = query_ids, k, skip_self
        self.floors = np.full(len(query_ids), -np.inf) if floors is None else floors
        self.held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.n = 0

    def add(self, start: int, item_ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` of the queries from number ``start`` on (rows) with the items (columns, in ascending order of ids)."""
        rows = np.arange(start, start + len(scores))
        self.take(rows, item_ids, scores, self.own(rows, item_ids))

    def own(self, rows: np.ndarray, item_ids: np.ndarray) -> np.ndarray | None:
        """Per query the place of its own id among the items, -1 for none."""
        if not self.skip_self or not len(item_ids):
            return None
        ids = self.query_ids[rows]
        at = np.minimum(np.searchsorted(item_ids, ids), len(item_ids) - 1)
        return np.where(item_ids[at] == ids, at, -1)

    def take(self, rows: np.ndarray, item_ids: np.ndarray, scores: np.ndarray, own: np.ndarray | None = None, exact=None, margin: float = 0.0) -> None:
        """Scores of some queries with some items. With ``exact`` (query and item numbers to scores) the given ones are up to ``margin`` off."""
        n, m = scores.shape
        if not n or not m:
            return
        if own is not None:
            hit = np.flatnonzero((own >= 0) & (own < m))
            scores[hit, own[hit]] = -np.inf
        slack = margin + TIE
        unknown = np.flatnonzero(np.isneginf(self.floors[rows]))
        if len(unknown) and m > self.k:
            some = scores[unknown, : max(1024, 4 * self.k)]
            last = np.partition(some, some.shape[1] - self.k, axis=1)[:, some.shape[1] - self.k].astype(float)
            self.floors[rows[unknown]] = np.where(np.isnan(last), -np.inf, last - slack)
        least = np.maximum(self.floors[rows] - slack, np.finfo(scores.dtype).min).astype(scores.dtype)
        every = np.flatnonzero((scores >= least[:, None]).ravel())
        for at in range(0, len(every), SOME):
            r, c = np.divmod(every[at : at + SOME], m)
            found = np.round(scores[r, c] if exact is None else exact(r, c), TIE_DIGITS)
            good = np.flatnonzero(found >= self.floors[rows[r]] - TIE / 2)
            self.held.append((rows[r[good]], item_ids[c[good]], found[good]))
            self.n += len(good)
            if self.n > 4 * self.k * len(self.query_ids) + SOME:
                self._cut()

    @staticmethod
    def _place(rows: np.ndarray) -> np.ndarray:
        """Place of each entry among those of its row, for sorted rows."""
        first = np.searchsorted(rows, rows, side="left")
        return np.arange(len(rows)) - first

    def _cut(self) -> np.ndarray:
        rows, ids, scores = (np.concatenate(parts) for parts in zip(*self.held))
        order = np.lexsort((ids, -scores, rows))
        place = self._place(rows[order])
        order, place = order[place < self.k], place[place < self.k]
        self.held, self.n = [(rows[order], ids[order], scores[order])], len(order)
        last = order[place == self.k - 1]
        self.floors[rows[last]] = np.maximum(self.floors[rows[last]], scores[last])
        return place

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Query numbers, item ids, scores, ranks from 1."""
        if not self.held:
            return np.zeros(0, np.int64), np.zeros(0), np.zeros(0), np.zeros(0, np.int64)
        place = self._cut()
        return *self.held[0], place + 1


def compare(best: BestK, rows: np.ndarray, queries: Points, ids: np.ndarray, items: Points, start: int = 0, end: int | None = None) -> None:
    """Offer the items from ``start`` to ``end`` (their ids ascending) to the queries of the given numbers, in blocks that fit a processor's cache.

    Cosines are bounded in single precision; only what may be among the best k is then computed in double precision.
    """
    end = len(ids) if end is None else end
    margin = (items.m.shape[1] + 8) * 2.0**-23
    for at in range(0, len(rows), QUERY_ROWS):
        some = rows[at : at + QUERY_ROWS]
        own = best.own(some, ids[start:end])
        for a in range(start, end, ITEM_ROWS):
            b = min(end, a + ITEM_ROWS)
            here = None if own is None else np.where(own < 0, -1, own + start - a)
            if items.low is None:
                best.take(some, ids[a:b], score_block(queries.m[some], items.m[a:b], items.metric), here)
            else:
                def exact(r: np.ndarray, c: np.ndarray, some=some, a=a) -> np.ndarray:
                    return np.einsum("ij,ij->i", queries.m[some[r]], items.m[a + c])

                best.take(some, ids[a:b], queries.low[some] @ items.low[a:b].T, here, exact, margin)
