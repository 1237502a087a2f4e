"""Approximate nearest neighbours by stable projections and a chi-square stopping test.

Vectors of length one are projected on a few random Gaussian directions. For a vector at
distance d the squared projected distance over d squared is chi-square distributed with as
many degrees of freedom as directions. A kd-tree over the projections gives projected
neighbours nearest first; each is verified by its true distance. When the next one is so
far away that a vector nearer than the k-th best found would, with probability `SURE`,
have been met before, the search ends.

The tree's leaves are visited whole. What is not visited is at least as far away, in the
projection, as the nearest leaf still to come, which is the distance that the test takes.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import factorial

import numpy as np
from pyspark.sql import DataFrame

from . import grid

#: Directions (even), points of a leaf, probability that ends a search, leaves of the first
#: round (each further round reads twice as many).
DIRECTIONS = 8
LEAF = 32
SURE = 0.95
ROUND = 4
SEED = 20240229
#: Squared distances below this are those of copies.
TINY = 1e-18


def directions(dims: int) -> np.ndarray:
    return np.random.default_rng([SEED, dims]).standard_normal((dims, DIRECTIONS))


def chi_square(x: np.ndarray, freedom: int) -> np.ndarray:
    """Distribution function for an even number of degrees of freedom."""
    half = np.minimum(np.asarray(x, float) / 2, 700.0)
    return 1 - np.exp(-half) * sum(half**i / factorial(i) for i in range(freedom // 2))


def tree(points: np.ndarray, leaf: int = LEAF) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Leaves of a kd-tree (rows, lowest and highest corner), split at the median of the
    widest dimension."""
    leaves, todo = [], [np.arange(len(points))]
    while todo:
        rows = todo.pop()
        if len(rows) <= leaf:
            leaves.append(rows)
            continue
        part = points[rows]
        axis = int((part.max(0) - part.min(0)).argmax())
        half = len(rows) // 2
        order = np.argpartition(part[:, axis], half)
        todo += [rows[order[:half]], rows[order[half:]]]
    low = np.array([points[r].min(0) for r in leaves])
    high = np.array([points[r].max(0) for r in leaves])
    return leaves, low, high


def cosines(x: np.ndarray, norms: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Row by row in one order of summation, so that copies score the same."""
    return (x * q).sum(1) / (norms * np.sqrt((q * q).sum()))


def scaled(x: np.ndarray) -> np.ndarray:
    """The vectors by a power of two that brings their largest components near one, so that no
    square is lost; cosines stay as they are, to the last bit where squares were whole."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(1))[1][:, None])


def cell(k: int):
    def run(ids, x, query_ids, q) -> Iterator:
        x, q = scaled(x), scaled(q)
        norms, q_norms = np.sqrt((x * x).sum(1)), np.sqrt((q * q).sum(1))
        unit, q_unit = x / norms[:, None], q / q_norms[:, None]
        by = directions(x.shape[1])
        leaves, low, high = tree(unit @ by)
        sizes = np.array([len(r) for r in leaves])
        starts = np.concatenate([[0], np.cumsum(sizes)])
        places = [np.arange(a, b) for a, b in zip(starts[:-1], starts[1:])]
        rows = np.concatenate(leaves)
        ids, x, norms, unit = ids[rows], x[rows], norms[rows], unit[rows]  # leaf after leaf
        for i, y in enumerate(q_unit @ by):
            away = np.maximum(np.maximum(low - y, y - high), 0)
            bound = (away * away).sum(1)
            order = np.argsort(bound, kind="stable")
            bound = np.append(bound[order], np.inf)
            at, step, worst = 0, ROUND, np.inf
            rows_met, far = np.zeros(0, np.int64), np.zeros(0)
            while at < len(order):
                part = order[at : at + step]
                at, step = at + len(part), 2 * step
                met = np.concatenate([places[j] for j in part.tolist()])
                met = met[ids[met] != query_ids[i]]
                rows_met = np.concatenate([rows_met, met])
                far = np.concatenate([far, 2 - 2 * (unit[met] @ q_unit[i])])
                if len(far) >= k:
                    worst = float(np.partition(far, k - 1)[k - 1])
                    if bound[at] > TINY and chi_square(bound[at] / max(worst, TINY), DIRECTIONS) >= SURE:
                        break
            near = rows_met[far <= worst + 1e-9]
            scores = cosines(x[near], norms[near], q[i])
            order = np.lexsort((ids[near], -scores))[:k]
            yield i, ids[near][order], scores[order]

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The k vectors of largest cosine that the search finds for every query.

    Both sides have vec_id and embedding. Returns query_id, rank (from 1), vec_id and score
    (cosine of the vectors as given). Left out on both sides: null and zero vectors,
    vectors with null or non-finite components, null ids. Vectors of another length than
    the query's, and those of its own id, are no candidates. Ties go to the smaller id;
    repeated rows are candidates each, equal query rows are one query, different vectors under
    one query id are queries each; other columns are dropped; empty tables give no rows. Every row is indexed, in the block it is dealt to.
    """
    some = lambda df: df.where("exists(embedding, x -> x != 0)")
    return grid.best(some(grid.usable(vectors)), some(grid.usable(queries)), k, cell(k), "DOUBLE")
