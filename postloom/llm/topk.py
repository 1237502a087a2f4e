"""Exact top-k inner products by the threshold algorithm.

In a block every dimension has a list of the vectors sorted by that component. A query
reads all lists together, from the top where its weight is positive and from the bottom
where it is negative, and scores each vector that it meets. No vector still unseen can
score more than the sum of weight times component at the lists' current depth. Once the
k-th best score is above that bound, the block is done.

The bounds of a query at depths `FIRST_DEPTH` * 2 ** i are known before its lists are read.
So two rounds do: the first depth gives a k-th score; the second reads down to the first
depth whose bound is below that score, where the search must end, as the k-th score can
only rise. With weights of equal size on many dimensions that depth is often that of the
whole block; such queries are scored together.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from . import grid

FIRST_DEPTH = 16
#: Beyond this share of a block's depth nearly all of its vectors have been met.
DEEP = 1 / 8
#: Scores made at once.
SCORES = 4_000_000


def quantized(vectors: np.ndarray, factor: float = 256.0) -> np.ndarray:
    return np.floor(factor * vectors)


class Lists:
    """Sorted lists of a block, and their values at the depths that searches look at."""

    def __init__(self, x: np.ndarray, ids: np.ndarray):
        self.x, self.ids = x, ids
        n = len(x)
        self.rows = np.ascontiguousarray(np.argsort(x, axis=0, kind="stable").T)
        depths = [FIRST_DEPTH]
        while depths[-1] < n:
            depths.append(2 * depths[-1])
        self.depths = np.minimum(depths, n)
        ordered = np.take_along_axis(x, self.rows.T, axis=0)
        self.high, self.low = ordered[n - self.depths], ordered[self.depths - 1]

    def met(self, w: np.ndarray, depth: int) -> np.ndarray:
        """Vectors that the query of weights `w` meets down to that depth."""
        n = len(self.x)
        top, bottom = np.flatnonzero(w > 0), np.flatnonzero(w < 0)
        return np.unique(np.concatenate([self.rows[top, n - depth :].ravel(), self.rows[bottom, :depth].ravel()]))

    def stop(self, q: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The first of the depths whose bound is below each query's k-th score."""
        bound = np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T
        below = bound < least[:, None]
        below[:, -1] = True
        return self.depths[below.argmax(1)]


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    if len(scores) > k:
        some = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
        ids, scores = ids[some], scores[some]
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def search(lists: Lists, query_ids: np.ndarray, q: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each query its position, and ids and scores of its k best. A bound equal to the
    k-th score may hide a smaller id, so only a lower one ends a search."""
    x, ids, n = lists.x, lists.ids, len(lists.x)
    lowest = -np.inf if q.dtype.kind == "f" else np.iinfo(np.int64).min
    least = np.full(len(q), lowest, q.dtype)
    for i, w in enumerate(q):
        met = lists.met(w, int(lists.depths[0]))
        met = met[ids[met] != query_ids[i]]
        if len(met) >= k:
            least[i] = np.partition(x[met] @ w, len(met) - k)[len(met) - k]
    stop = lists.stop(q, least)
    stop[(q == 0).all(1)] = n
    deep = stop >= DEEP * n
    for i in np.flatnonzero(~deep):
        met = lists.met(q[i], int(stop[i]))
        met = met[ids[met] != query_ids[i]]
        yield int(i), *_best(ids[met], x[met] @ q[i], k)
    rest = np.flatnonzero(deep)
    for lo in range(0, len(rest), max(1, SCORES // n)):
        part = rest[lo : lo + max(1, SCORES // n)]
        for i, scores in zip(part.tolist(), q[part] @ x.T):
            other = ids != query_ids[i]
            yield i, *_best(ids[other], scores[other], k)


def cell(k: int):
    def run(ids, vectors, query_ids, query_vectors) -> Iterator:
        x, q = quantized(vectors), quantized(query_vectors)
        top = float(np.abs(x).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(1, x.shape[1])
        if top >= 2**63:
            raise OverflowError("a score may need more than 63 bits")
        if top >= 2**53:  # beyond what doubles hold exactly
            x, q = x.astype(np.int64), q.astype(np.int64)
        return search(Lists(x, ids), query_ids, q, k)

    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k vectors of largest integer inner product for every query.

    Both sides have vec_id and embedding; components count as floor(256 * x) in doubles.
    Returns query_id, rank (from 1), vec_id and score (long). Left out on both sides: null
    vectors, vectors with null or non-finite components, null ids. Vectors of another
    length than the query's, and those of its own id, are no candidates. Ties go to the
    smaller id; repeated rows are candidates each, equal query rows are one query, different
    vectors under one query id are queries each. Other columns are dropped; empty tables give no
    rows; an empty vector scores 0. Components whose scores may need more than 63 bits are an error.
    """
    return grid.best(grid.usable(vectors), grid.usable(queries), k, cell(k), "LONG")
