"""Best-fit packing of token pieces into sequences by exact-complement hashing.

How many pieces there are of each length is all that the plan needs: at most `size`
numbers, whatever the size of the corpus. The sums of one, two and three lengths are
indexed under the counts that are left. The plan takes the longest length, asks the index
for lengths whose sum fills its gap exactly, and takes as many of that combination as there
are; the index follows when a length runs short (see `Sums`). What
is left is packed best fit, longest first. The plan is a list of patterns (lengths of a
sequence, how many such sequences), in which every step uses up a length or a group of
open sequences, so it is bounded by `size` too.

Pieces then find their place by number: the k-th piece of a length takes the k-th slot of
that length. Numbers come from windows over (length, salt); a length with many pieces gets
as many salts as its count asks for, so no task holds more than about `WINDOW_ROWS` of them.
"""

from __future__ import annotations

import gc
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..runtime import durable
from . import bpe
from .common import batch, chunks

#: Pieces numbered by one window.
WINDOW_ROWS = 100_000

#: Lengths that an exact complement may have.
DEPTH = 3

_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


def pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    """Token pieces of every row of `docs` (doc_id, text): its ids and `end_id`, cut where
    longer than `size`. Null text counts as empty (a piece of one token)."""
    source = bpe.vocabulary(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()
        enc = bpe.encoder(source)
        end = np.array([end_id], np.int32)
        for b in batches:
            texts = b.column(1)
            for lo, hi in chunks(texts):
                out: list[tuple] = []
                doc_ids = b.column(0).slice(lo, hi - lo).to_pylist()
                for doc_id, ids in zip(doc_ids, enc.encode_texts(texts.slice(lo, hi - lo).to_pylist())):
                    ids = np.concatenate([ids, end]).astype("<u4")
                    for k, start in enumerate(range(0, len(ids), size)):
                        part = ids[start : start + size]
                        out.append((doc_id, k, start, len(part), zlib.crc32(part.tobytes())))
                yield batch(_PIECES, **dict(zip(_PIECES.names, map(list, zip(*out)))))

    kind = "doc_id LONG, piece INT, start LONG, length LONG, ids_crc32 LONG"
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"]).mapInArrow(run, kind)


# -- the plan


class Sums:
    """Available pieces by length, with an index of the sums of one, two and three of them.

    `ways[k][s]` is how many selections of k pieces have the sum s, pieces of one length
    counting as alike and none being used more often than it is there. It is the factor z^k
    t^s of the product over all lengths x of 1 + z t^x + ... + z^m t^mx, where m is how many
    of x are there, three at most. So when m changes, the factor of x is divided out and the
    new one multiplied in, which are shifts of rows of `size` numbers.
    """

    def __init__(self, counts: dict[int, int], size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.ways = np.zeros((DEPTH + 1, size + 1), np.int64)
        self.ways[0, 0] = 1
        for length, n in counts.items():
            self.add(length, n)

    def _without(self, x: int, m: int) -> np.ndarray:
        """The index of all lengths but `x`, of which up to `m` are in `ways`."""
        out = self.ways.copy()
        for k in range(1, DEPTH + 1):
            for j in range(1, min(m, k) + 1):
                if j * x <= self.size:
                    out[k, j * x :] -= out[k - j, : self.size + 1 - j * x]
        return out

    def add(self, x: int, n: int) -> None:
        """`n` more pieces of length `x` (fewer, if negative)."""
        old, new = min(int(self.count[x]), DEPTH), min(int(self.count[x]) + n, DEPTH)
        self.count[x] += n
        if old == new:
            return
        rest = self._without(x, old)
        self.ways = rest.copy()
        for k in range(1, DEPTH + 1):
            for j in range(1, min(new, k) + 1):
                if j * x <= self.size:
                    self.ways[k, j * x :] += rest[k - j, : self.size + 1 - j * x]

    def most(self, lengths: tuple[int, ...]) -> int:
        """How many times the combination can be taken."""
        return min(int(self.count[x]) // k for x, k in Counter(lengths).items())

    def take(self, lengths: tuple[int, ...], times: int) -> None:
        for x, k in Counter(lengths).items():
            self.add(x, -k * times)

    def _pair(self, total: int) -> tuple[int, int]:
        """The two lengths of an indexed sum, the larger as large as can be."""
        low = np.arange(1, total // 2 + 1)
        there = (self.count[low] > 0) & (self.count[total - low] > (low == total - low))
        b = int(low[there][0])
        return total - b, b

    def _triple(self, total: int) -> tuple[int, int, int]:
        """The three lengths of an indexed sum, the largest as large as can be."""
        c = np.flatnonzero(self.count[:total])[::-1]
        rest = total - c
        # Pairs of the remaining sum, less those that need the very piece that is c.
        other, n = rest - c, self.count[c]
        needs = (n == 1) & (other > 0) & (other != c) & (self.count[other] > 0) | (n == 2) & (other == c)
        pairs = self.ways[2, rest] - needs
        largest = int(c[pairs > 0][0])
        self.add(largest, -1)
        two = self._pair(total - largest)
        self.add(largest, 1)
        return largest, *two

    def filling(self, length: int) -> tuple[int, ...] | None:
        """`length` with one, two or three others that fill a sequence exactly, if any do."""
        gap = self.size - length
        if gap == 0:
            return (length,)
        self.add(length, -1)
        if self.ways[1, gap]:
            found = (length, gap)
        elif self.ways[2, gap]:
            found = (length, *self._pair(gap))
        elif self.ways[3, gap]:
            found = (length, *self._triple(gap))
        else:
            found = None
        self.add(length, 1)
        return found


def plan(counts: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences have each. Every piece is in one."""
    stock, out = Sums(counts, size), []
    for length in range(size, 0, -1):
        while stock.count[length]:
            lengths = stock.filling(length)
            if lengths is None:
                break
            times = stock.most(lengths)
            stock.take(lengths, times)
            out.append((lengths, times))
    # Best fit for what is left: open sequences are grouped by their gap.
    groups: dict[int, list[list]] = {}
    held = np.zeros(size + 1, bool)

    def put(lengths: tuple[int, ...], gap: int, times: int) -> None:
        if times:
            groups.setdefault(gap, []).append([lengths, times])
            held[gap] = True

    for length in range(size, 0, -1):
        left = int(stock.count[length])
        while left:
            fits = np.flatnonzero(held[length:])
            if not len(fits):
                per = size // length
                put((length,) * per, size - per * length, left // per)
                put((length,) * (left % per), size - (left % per) * length, 1 if left % per else 0)
                break
            gap = length + int(fits[0])
            lengths, times = groups[gap].pop()
            held[gap] = bool(groups[gap])
            per = min(gap // length, left)
            used = min(times, left // per)
            put(lengths, gap, times - used)
            put(lengths + (length,) * per, gap - per * length, used)
            left -= used * per
    return out + [(lengths, times) for group in groups.values() for lengths, times in group]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> dict[int, np.ndarray]:
    """For each length the rows (first number, first sequence, offset) of its slots."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    used: Counter = Counter()
    sequence = 0
    for lengths, times in patterns:
        offset = 0
        for x in lengths:
            found.setdefault(x, []).append((used[x], sequence, offset))
            used[x] += times
            offset += x
        sequence += times
    return {x: np.array(rows, np.int64) for x, rows in found.items()}


# -- on Spark


def pack(items: DataFrame, size: int) -> DataFrame:
    """Add sequence_id and offset to `items` (doc_id, piece, length and any others).

    Lengths are 1 to `size`. Sequences have gapless offsets from 0 and at most `size`
    tokens. Repeated rows are placed each. An empty table gives an empty table. `items` is
    read twice and must give the same rows both times.
    """
    counts = {r[0]: r[1] for r in items.groupBy("length").count().collect()}  # at most `size` rows
    if any(not x or x < 1 or x > size for x in counts):
        raise ValueError(f"lengths must be 1 to {size}")
    place = slots(plan(counts, size))
    salts = {x: -(-n // WINDOW_ROWS) for x, n in counts.items() if n > WINDOW_ROWS}
    by = F.lit(1)
    if salts:
        known = F.create_map(*[F.lit(v) for pair in salts.items() for v in pair])
        by = F.coalesce(F.element_at(known, F.col("length")), F.lit(1))
    salted = items.withColumn("_salt", F.pmod(F.xxhash64(*items.columns), by).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    order = [F.col(c) for c in items.columns if c != "length"]
    within = Window.partitionBy("length", "_salt").orderBy(*order)
    ranked = (
        salted.withColumn("_rank", F.row_number().over(within))
        .join(firsts, ["length", "_salt"])
        .select(*items.columns, (F.col("_rank") - 1 + F.col("_first")).alias("_number"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length = b.column(b.schema.get_field_index("length")).to_numpy()
            number = b.column(b.num_columns - 1).to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                at = np.flatnonzero(length == x)
                rows = place[x]
                k = np.searchsorted(rows[:, 0], number[at], "right") - 1
                sequence[at] = rows[k, 1] + number[at] - rows[k, 0]
                offset[at] = rows[k, 2]
            columns = b.columns[:-1] + [pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, [*b.schema.names[:-1], "sequence_id", "offset"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id LONG, offset LONG")


def pack_documents(docs: DataFrame, path: str, size: int = 4096, end_id: int = 1) -> DataFrame:
    """Pack every row of `docs` (doc_id, text) into sequences of at most `size` tokens.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id and offset, a row per
    piece. Null text counts as empty; a null doc_id is kept; repeated rows are packed each;
    other columns are dropped; an empty table gives an empty table. The pieces' lengths and
    checksums are written to the shared folder once (no text, no ids), so that the counts
    and the numbers see the same rows when an executor is lost.
    """
    return pack(durable(pieces(docs, path, size, end_id), "pieces"), size)
