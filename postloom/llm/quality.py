"""Quality scores by Bradley-Terry ranking.

A document is a few shares of its words, lines and letters, and its words and word pairs,
hashed with a sign into `BUCKETS` numbers of common length 1. All labelled documents are dealt
into groups by a hash, and in a group every good one meets every bad one; the chance that
the good one wins is the logistic function of the difference of their scores, which are
linear in the features, so fitting is a logistic regression without constant on feature
differences. Each step of it is one pass over the groups, whose sums the driver gets. A score
is then set against the scores of all labelled documents: the exact quantile at the share of bad
ones is the threshold, and becomes `THRESHOLD` on the scale of 0 to 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import durable
from .common import GramHasher, batch, chunks, text_bytes, word_hashes, words
from .learning import labelled, sigmoid

#: Pairs held at once, and the value that the threshold gets.
PAIRS = 100_000
THRESHOLD = 0.3
RIDGE = 1e-3
#: Largest change of a weight of standardized features at which the fit ends.
CLOSE = 1e-6

#: Labelled documents of a group on average, those of each label in it at least (all there are,
#: if fewer), and groups of a file.
GROUP, SIDE, FILE_GROUPS = 1_000, 100, 16
#: Cells that a quantile is looked for in at once, and values that are few enough to sort.
CELLS, FEW = 4_096, 10_000

#: Numbers that words and word pairs are hashed into.
BUCKETS = 128

FEATURES = (
    "marked", "shouted", "barred", "single", "again", "repeated", "few_words", "same_lines", "capitals", "digits",
    "marks", "letters", "word_length", "long_words", "tiny",
)

_IS = {
    "upper": np.array([65 <= b <= 90 for b in range(256)]),
    "digit": np.array([48 <= b <= 57 for b in range(256)]),
    "alpha": np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]),
}
_IS["mark"] = ~_IS["alpha"] & ~_IS["digit"] & (np.arange(256) > 32)


def _sums(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[at[1:]] - total[at[:-1]]


def _repeats(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each text's hashes, how many are not the first of their kind, and the most of a kind."""
    n = len(at) - 1
    text = np.repeat(np.arange(n), np.diff(at))
    order = np.lexsort((hashes, text))
    h, t = hashes[order], text[order]
    first = np.ones(len(h), bool)
    first[1:] = (h[1:] != h[:-1]) | (t[1:] != t[:-1])
    kinds = np.bincount(t[first], minlength=n)
    runs = np.diff(np.append(np.flatnonzero(first), len(h)))
    most = np.zeros(n, np.int64)
    np.maximum.at(most, t[first], runs)
    return np.diff(at) - kinds, most


def _grams(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Words and word pairs of each text in `BUCKETS` signed counts, as vectors of length 1."""
    n = len(at) - 1
    text = np.repeat(np.arange(n), np.diff(at))
    pairs = np.flatnonzero(text[1:] == text[:-1])
    both = np.concatenate([hashes, GramHasher(hashes).at(pairs, 2)])
    place = np.concatenate([text, text[pairs]]) * BUCKETS + (both % np.uint64(BUCKETS)).astype(np.int64)
    sign = np.where(both >> np.uint64(63), 1.0, -1.0)
    counts = np.bincount(place, sign, minlength=n * BUCKETS).reshape(n, BUCKETS)
    length = np.sqrt((counts * counts).sum(1, keepdims=True))
    return counts / np.where(length > 0, length, 1)


def features(texts: pa.Array) -> np.ndarray:
    """A row of `FEATURES` and `BUCKETS` hashed words for every text; null counts as empty."""
    data, bounds = text_bytes(texts)
    starts, ends, at = words(data, bounds)
    n = np.diff(at)
    per_word = np.maximum(n, 1)
    size = np.maximum(np.diff(bounds), 1)
    length = ends - starts
    hashes = word_hashes(data, starts, ends)
    last = data[ends - 1] if len(ends) else data[:0]
    before = data[np.maximum(ends - 2, starts)] if len(ends) else data[:0]
    third = data[np.maximum(ends - 3, starts)] if len(ends) else data[:0]
    mark = _IS["mark"][last]
    double = mark & (before == last) & (length > 2)
    again = np.zeros(len(hashes))
    again[1:] = hashes[1:] == hashes[:-1]
    again[at[:-1][n > 0]] = 0
    more, most = _repeats(hashes, at)
    # Lines: the bytes between line breaks, by their hash.
    line_break = data == 10
    cut = np.union1d(bounds[:-1], np.flatnonzero(line_break) + 1)
    cut = cut[cut < len(data)]
    stop = np.append(cut[1:], len(data))[: len(cut)]
    stop = stop - (line_break[stop - 1] if len(stop) else 0)
    some = stop > cut
    cut, stop = cut[some], stop[some]
    line_at = np.searchsorted(cut, bounds)
    same, _ = _repeats(word_hashes(data, cut, stop), line_at)
    count = lambda kind: _sums(_IS[kind][data], bounds)
    letters = np.maximum(count("alpha"), 1)
    ready = n >= 5
    return np.column_stack(
        [
            np.sqrt(_sums(double & (third == last), at) / per_word),
            np.sqrt(_sums(double & (last == ord("!")), at) / per_word),
            np.sqrt(_sums((length == 1) & (last == ord("|")), at) / per_word),
            _sums(length == 1, at) / per_word,
            np.sqrt(_sums(again, at) / per_word),
            ready * most / per_word,
            ready * more / per_word,
            np.sqrt(same / np.maximum(np.diff(line_at), 1)),
            np.sqrt(count("upper") / letters),
            count("digit") / size,
            np.sqrt(count("mark") / size),
            count("alpha") / size,
            np.minimum(_sums(length, at) / per_word, 30) / 10,
            _sums(length > 20, at) / per_word,
            1 / (1 + n),
            _grams(hashes, at),
        ]
    ).astype(float)


@dataclass
class Model:
    weights: np.ndarray | None
    cut: float = 0.0
    scale: float = 1.0
    prior: float = 0.0


def pair_sums(win: np.ndarray, lose: np.ndarray, w: np.ndarray, pairs: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Slope and curvature of the loss, summed over every pair of a row of `win` and one of `lose`.

    Sums over pairs are products of matrices with the chances of the wrong order, of which
    at most about `pairs` are held at once.
    """
    slope, curve = np.zeros(len(w)), np.zeros((len(w), len(w)))
    low = lose @ w
    at_once = max(1, pairs // max(1, len(lose)))
    for lo in range(0, len(win), at_once):
        part = win[lo : lo + at_once]
        p = sigmoid(low[None] - (part @ w)[:, None])  # chance of the wrong order
        slope += lose.T @ p.sum(0) - part.T @ p.sum(1)
        p *= 1 - p
        cross = part.T @ p @ lose
        curve += (part * p.sum(1)[:, None]).T @ part + (lose * p.sum(0)[:, None]).T @ lose - cross - cross.T
    return slope, curve


def newton(sums: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray, float]], size: int) -> np.ndarray:
    """Weights by Newton's method; `sums` gives slope and curvature of the loss and the number of pairs."""
    w = np.zeros(size)
    for _ in range(60):
        slope, curve, n = sums(w)
        step = np.linalg.solve(curve / n + RIDGE * np.eye(size), slope / n + RIDGE * w)
        w -= step * min(1.0, 3.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < CLOSE:
            break
    return w


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS) -> Model:
    """Scores from preferences, of rows at hand: every good row over every bad one."""
    win, lose = x[good], x[~good]
    if not len(win) or not len(lose):
        return Model(None, prior=float(len(win) > 0))
    spread = x.std(0, dtype=float) + 1e-6
    w = newton(lambda w: (*pair_sums(win / spread, lose / spread, w, pairs), len(win) * len(lose)), x.shape[1]) / spread
    scores = x @ w
    return Model(w, float(np.quantile(scores, len(lose) / len(x))), max(1e-6, float(np.std(scores))))


_FEATURES = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("features", pa.list_(pa.float32()))])
_SUMS = pa.schema([("sums", pa.list_(pa.float64()))])
_RANKS = pa.schema([("rank", pa.float64())])


def labelled_features(docs: DataFrame, labels: DataFrame, learn: Column) -> DataFrame:
    """doc_id, label and features of every labelled document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                x = list(features(part.column(1)).astype(np.float32))
                yield batch(_FEATURES, doc_id=part.column(0), label=part.column(2), features=x)

    return labelled(docs, labels, "quality", learn).mapInArrow(run, "doc_id LONG, label INT, features ARRAY<FLOAT>")


def dealt(rows: DataFrame, n1: int, n0: int) -> DataFrame:
    """The rows in groups (grp, first, label, features), written group by group.

    Every row is in a group, `first` there, and of a rare label in as many as give each
    group `SIDE` rows of it.
    """
    groups = max(1, -(-(n1 + n0) // GROUP))
    copies = lambda n: min(groups, -(-groups * SIDE // n))
    shift = F.explode(F.sequence(F.lit(0), F.when(F.col("label") == 1, copies(n1)).otherwise(copies(n0)) - 1))
    placed = rows.withColumn("i", shift).select(
        F.pmod(F.pmod(F.xxhash64("doc_id"), F.lit(groups)) + F.col("i"), F.lit(groups)).alias("grp"),
        (F.col("i") == 0).alias("first"),
        "label",
        "features",
    )
    return durable(placed.repartition(-(-groups // FILE_GROUPS), "grp").sortWithinPartitions("grp"), "dealt")


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), len(FEATURES) + BUCKETS)


def _total(rows: DataFrame, run: Callable) -> np.ndarray:
    """Sum of the vectors that the tasks yield."""
    each = rows.mapInArrow(run, "sums ARRAY<DOUBLE>").select(F.posexplode("sums").alias("pos", "v"))
    sums = each.groupBy("pos").agg(F.sum("v").alias("v")).collect()
    return np.array([r.v for r in sorted(sums, key=lambda r: r.pos)])


def _spread(rows: DataFrame) -> np.ndarray:
    """Standard deviations of the features."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column(0))
            yield batch(_SUMS, sums=[np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])])

    total = _total(rows.where("first").select("features"), run)
    mean, square = np.split(total[1:] / total[0], 2)
    return np.sqrt(np.maximum(square - mean * mean, 0)) + 1e-6


def _group_sums(groups: DataFrame, spread: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """`pair_sums` over the pairs of each group, and the number of pairs."""
    size = len(w)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slope, curve, n = np.zeros(size), np.zeros((size, size)), 0
        held, group = [], None

        def close() -> None:
            nonlocal slope, curve, n
            if held:
                good = np.concatenate([g for g, _ in held])
                x = np.concatenate([x for _, x in held]) / spread
                more = pair_sums(x[good], x[~good], w)
                slope, curve, n = slope + more[0], curve + more[1], n + int(good.sum()) * int((~good).sum())
                held.clear()

        for b in batches:
            grp, good = b.column(0).to_numpy(), b.column(1).to_numpy() == 1
            x = _matrix(b.column(2))
            ends = np.append(np.flatnonzero(np.diff(grp)) + 1, len(grp))
            lo = 0
            for hi in ends:
                if lo < hi:
                    if grp[lo] != group:
                        close()
                        group = grp[lo]
                    held.append((good[lo:hi], x[lo:hi]))
                lo = hi
        close()
        yield batch(_SUMS, sums=[np.concatenate([slope, curve.ravel(), [n]])])

    total = _total(groups.select("grp", "label", "features"), run)
    return total[:size], total[size:-1].reshape(size, size), total[-1]


def quantile(ranks: DataFrame, column: str, share: float) -> float:
    """The exact quantile of a written column, between neighbours in proportion, as numpy has it.

    Counts in even cells narrow down the cell that holds it until its values are few or one.
    """
    low, high, n = ranks.agg(F.min(column), F.max(column), F.count(column)).head()
    total, k, before, v = n, int((n - 1) * share), 0, F.col(column)
    inside = ranks
    while n > FEW and low < high:
        cell = F.least(F.floor((v - low) / ((high - low) / CELLS)), F.lit(CELLS - 1))
        cells = inside.groupBy(cell.alias("c")).agg(F.count("*").alias("n"), F.min(v).alias("lo"), F.max(v).alias("hi")).collect()
        for c in sorted(cells, key=lambda c: c.c):
            if before + c.n > k:
                break
            before += c.n
        low, high, n = c.lo, c.hi, c.n
        inside = ranks.where((v >= low) & (v <= high))
    at = [low] * n if low == high else sorted(r[0] for r in inside.select(column).collect())
    here = at[k - before]
    if k - before + 1 < n:
        after = at[k - before + 1]
    else:
        after = ranks.agg(F.min(F.when(v > high, v))).head()[0]
    part = (total - 1) * share - k
    return here if after is None else here + (after - here) * part


def fit(docs: DataFrame, labels: DataFrame, learn: Column) -> Model:
    """Weights and threshold from all labelled documents; only sums come to the driver."""
    rows = durable(labelled_features(docs, labels, learn), "labelled")
    n1, n0 = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") != 1)).head()
    if not n1 or not n0:
        return Model(None, prior=float(n1 > 0))
    groups = dealt(rows, n1, n0)
    spread = _spread(groups)
    w = newton(lambda w: _group_sums(groups, spread, w), len(spread)) / spread

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield batch(_RANKS, rank=_matrix(b.column(0)) @ w)

    ranks = durable(rows.select("features").mapInArrow(run, "rank DOUBLE"), "ranks")
    scale = ranks.agg(F.stddev_pop("rank")).head()[0]
    return Model(w, quantile(ranks, "rank", n0 / (n1 + n0)), max(1e-6, scale))


def line(model: Model, texts: pa.Array) -> np.ndarray:
    """Scores of texts."""
    if model.weights is None:
        return np.full(len(texts), model.prior)
    rank = (features(texts) * model.weights).sum(1) - model.cut
    return sigmoid(4 * rank / model.scale + np.log(THRESHOLD / (1 - THRESHOLD)))


def judge(model: Model, least: float = THRESHOLD):
    """For `common.keep_where`: keeps texts that score `least` or more."""
    return lambda: lambda texts: line(model, texts) >= least


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score (0 to 1; from `THRESHOLD` on a document is good) of every row of
    `docs` (doc_id, text).

    Null text counts as empty; an empty text is scored like any other. Null ids are kept,
    repeated rows are scored each, other columns are dropped, an empty table gives an empty
    table. With labels of one kind only, every score is 1 or 0, with none 0.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                yield batch(_SCORES, doc_id=part.column(0), score=line(model, part.column(1)))

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return own.mapInArrow(run, "doc_id LONG, score DOUBLE")
