"""Near-duplicates by SimHash fingerprints, joined over anchor points.

A fingerprint has 64 bits; two link at `THRESHOLD` = 3 or fewer differing bits. Of the two
halves of a linked pair one differs in at most one bit, so each half is joined within one bit.
The anchors of a half are a perfect covering code: the Hamming code of 31 bits, with the 32nd
bit free. Every half lies within one bit (the covering radius) of exactly one anchor of its
own 32nd bit, its home. A fingerprint is replicated to all anchors within radius plus
threshold, two bits: 33 copies on average over both halves, dealt over 2 ** 28 anchors. Of a
pair within one bit, the other one is within two bits of the first one's home, so every linked
pair meets at a home and is compared there, on all 64 bits.

Copies of a fingerprint count once. Anchors where nothing can link are left out before
any comparison. Crowded anchors are cut into cells of two blocks, so no task holds more than
two blocks; a cell gives a spanning forest of its links, never its pairs. Components
of the forests are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ..operators.skew import spread_join
from ..runtime import durable
from .common import CHUNK_BYTES, _SPACE, chunks, text_bytes, words
from .graph import components

SHINGLE = 3
SEED = 42
THRESHOLD = 3
#: Fingerprints of a block; a cell compares two.
BLOCK = 2048
#: Rows of an anchor up to which whole batches of anchors are compared at once.
FEW = 32
#: Rows of cells handled at once.
ROWS = 50_000

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANES = np.uint64(0x0101010101010101)


def _spaced(data: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """The words in lower case with one space after each; their starts and ends; and the
    places where each text's words begin."""
    starts, ends, at = words(data, bounds)
    length = ends - starts
    begin = np.cumsum(length + 1) - length - 1
    out = np.full(int((length + 1).sum()), 0x20, np.uint8)
    solid = np.flatnonzero(~_SPACE[data])
    out[solid + np.repeat(begin - starts, length)] = _LOWER[data[solid]]
    return out.tobytes(), begin, begin + length, at


def _hashes(text: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(text[a:b], SEED) for a, b in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts))


def votes(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """For each of the groups that begin at `at` (none empty), how often each bit is set."""
    n = np.diff(np.append(at, len(hashes)))
    # Eight bits at once: a byte of a lane counts up to 255 hashes.
    runs = -(-n // 255)
    first = np.cumsum(runs) - runs
    cut = np.repeat(at, runs) + 255 * (np.arange(runs.sum()) - np.repeat(first, runs))
    out = np.empty((len(at), 8, 8), np.int64)
    for k in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(k)) & _LANES, cut)
        out[:, :, k] = np.add.reduceat(lanes.view(np.uint8).reshape(-1, 8).astype(np.int64), first, axis=0)
    return out.reshape(len(at), 64)


def _majority(count: np.ndarray, n: np.ndarray) -> np.ndarray:
    bits = (2 * count > n[:, None]).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8").ravel()


def _long(text: np.ndarray) -> int:
    """The fingerprint of one text, read in pieces; the last words of a piece begin the next."""
    count, total, carry, lo = np.zeros(64, np.int64), 0, b"", 0
    while lo < len(text):
        hi = lo + CHUNK_BYTES
        while hi < len(text) and not _SPACE[text[hi]]:
            gap = np.flatnonzero(_SPACE[text[hi : hi + CHUNK_BYTES]])
            hi += int(gap[0]) if len(gap) else CHUNK_BYTES
        piece = np.concatenate([np.frombuffer(carry, np.uint8), text[lo:hi]])
        spaced, starts, ends, _ = _spaced(piece, np.array([0, len(piece)]))
        lo, carry = hi, spaced
        if len(starts) >= SHINGLE:
            made = _hashes(spaced, starts[: 1 - SHINGLE], ends[SHINGLE - 1 :])
            count += votes(made, np.array([0]))[0]
            total += len(made)
            carry = spaced[starts[1 - SHINGLE] :]
    if not total and carry:
        count, total = votes(_hashes(carry, np.array([0]), np.array([len(carry) - 1])), np.array([0]))[0], 1
    return int(_majority(count[None], np.array([total]))[0])


def fingerprints(texts: pa.Array) -> np.ndarray:
    """The fingerprint of every text of a batch, as unsigned numbers."""
    data, bounds = text_bytes(texts)
    if len(texts) == 1 and len(data) > CHUNK_BYTES:
        return np.array([_long(data)], np.uint64)
    spaced, starts, ends, at = _spaced(data, bounds)
    n = np.diff(at)
    count = np.where(n >= SHINGLE, n - SHINGLE + 1, np.minimum(n, 1))
    text = np.repeat(np.arange(len(n)), count)
    first = np.cumsum(count) - count
    begin = at[:-1][text] + np.arange(len(text)) - first[text]
    made = _hashes(spaced, starts[begin], ends[begin + np.minimum(SHINGLE, n[text]) - 1])
    out, some = np.zeros(len(n), np.uint64), np.flatnonzero(count)
    if len(some):
        out[some] = _majority(votes(made, first[some]), count[some])
    return out


def with_fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed number) of every row of `docs` (doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                made = pa.array(fingerprints(part.column(1)).view(np.int64))
                yield pa.RecordBatch.from_arrays([part.column(0), made], ["doc_id", "fp"])

    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.coalesce(docs["text"], F.lit("")).alias("text"))
    return own.mapInArrow(run, "doc_id LONG, fp LONG")


def _syndrome(word: str) -> str:
    """SQL of the syndrome of the low 31 bits: zero for an anchor, else the place of the bit
    to turn to get to the nearest one. Places count from one."""
    checks = []
    for k in range(5):
        mask = sum(1 << (place - 1) for place in range(1, 32) if place >> k & 1)
        checks.append(f"(cast(bit_count({word} & {mask}L) AS INT) & 1) << {k}")
    return " | ".join(checks)


def replicas(nodes: DataFrame) -> DataFrame:
    """anchor, fp and home of every anchor within two bits of either half of each fp."""
    halves = nodes.select("fp", F.explode(F.array(F.lit(0), F.lit(1))).alias("half"))
    word = halves.withColumn("word", F.expr("shiftrightunsigned(fp, 32 * half) & 4294967295L"))
    near = word.withColumn("s", F.expr(_syndrome("word"))).select("*", F.explode(F.expr("sequence(0, 32)")).alias("i"))
    # 0: the home. 1 to 31: two bits turned whose places have the syndrome as their difference.
    # 32: the anchor nearest to the half with the 32nd bit turned.
    near = near.where("i = 0 OR i = 32 OR (s <> 0 AND i <> s AND i < (i ^ s))")
    bit = lambda place: f"shiftleft(1L, {place} - 1)"
    nearest = f"if(s = 0, 0L, {bit('s')})"
    turned = f"CASE i WHEN 0 THEN {nearest} WHEN 32 THEN {nearest} | {1 << 31}L ELSE {bit('i')} | {bit('(i ^ s)')} END"
    return near.selectExpr(f"shiftleft(cast(half AS BIGINT), 32) | (word ^ ({turned})) AS anchor", "fp", "i = 0 AS home")


def _cells(rows: DataFrame) -> DataFrame:
    """`rows` (anchor, fp, home) dealt into cells of two blocks, in their order."""
    count = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.max("home").alias("some"))
    met = count.where("n > 1 AND some").select("anchor", F.ceil(F.col("n") / F.lit(BLOCK)).cast("int").alias("blocks"))
    mine = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # Both sides are made by an explode, whose rows Spark does not count: from a small file of fingerprints it
    # would send them all through the driver.
    dealt = rows.hint("merge").join(met, "anchor").withColumn("blk", mine)
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("anchor", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"), "blk", "home", "fp")
    return dealt.repartition("anchor", "i", "j").sortWithinPartitions("anchor", "i", "j", "fp")


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count((a ^ b).view(np.uint64))  # of signed numbers it counts the absolute value's


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest row that each row is joined with by the links (a, b)."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        last = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == last).all():
            return root


def _small(fp: np.ndarray, home: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Roots of rows in cells of few rows (all from one block), by row distance inside the cell."""
    left = np.repeat(start + size, size) - np.arange(len(fp))  # rows of the cell from here on
    a, b = [], []
    for step in range(1, int(size.max(initial=1))):
        i = np.flatnonzero(left > step)
        near = i[(home[i] | home[i + step]) & (_apart(fp[i], fp[i + step]) <= THRESHOLD)]
        a.append(near)
        b.append(near + step)
    none = np.zeros(0, np.int64)
    return _roots(len(fp), np.concatenate([none, *a]), np.concatenate([none, *b]))


def _large(fp: np.ndarray, home: np.ndarray, side: np.ndarray | None) -> np.ndarray:
    """Roots of the rows of one cell. A row is compared only with rows that nothing joins it
    with yet; `side` limits pairs to those across two blocks."""
    root = np.arange(len(fp))
    for a in np.flatnonzero(home):
        rest = np.flatnonzero(root != root[a])
        if side is not None:
            rest = rest[side[rest] != side[a]]
        near = rest[_apart(fp[rest], fp[a]) <= THRESHOLD]
        if len(near):
            met = np.unique(np.append(root[near], root[a]))
            root[np.isin(root, met)] = met[0]
    return root


def _linked(cell: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Forest edges of links in whole cells."""
    anchor, i, j, side, home, fp = (c.to_numpy() for c in cell.columns)
    new = np.ones(len(fp), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(fp)))
    root = np.arange(len(fp))
    few = (size <= FEW) & (i[start] == j[start])
    rows = np.flatnonzero(np.repeat(few, size))
    if len(rows):
        n = size[few]
        root[rows] = rows[_small(fp[rows], home[rows], np.cumsum(n) - n, n)]
    for lo, n in zip(start[~few].tolist(), size[~few].tolist()):
        part = slice(lo, lo + n)
        across = side[part] if i[lo] != j[lo] else None
        root[part] = lo + _large(fp[part], home[part], across)
    at = np.flatnonzero(root != np.arange(len(root)))
    return fp[at], fp[root[at]]


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Tables of about `ROWS` rows that end where a cell ends."""
    held, rows = [], 0
    for b in batches:
        held.append(b)
        rows += b.num_rows
        if rows < ROWS:
            continue
        t = pa.Table.from_batches(held)
        keys = [t[c].to_numpy() for c in ("anchor", "i", "j")]
        last = np.flatnonzero(np.logical_or.reduce([k != k[-1] for k in keys]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if cut:
            yield t.slice(0, cut)
        held, rows = t.slice(cut).to_batches(), t.num_rows - cut
    if rows:
        yield pa.Table.from_batches(held)


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) between fps of `nodes` (distinct fp) whose components are those of all links."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cells in _whole(batches):
            a, b = _linked(cells)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return _cells(replicas(nodes)).mapInArrow(run, "a LONG, b LONG")


def hexadecimal(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


def clusters(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hexadecimal digits) and component_id (the smallest doc_id that
    links of `THRESHOLD` or fewer differing bits lead to) of every row of `docs` (doc_id, text).

    Words are runs without blanks, A to Z in lower case; shingles are three words, each as often as
    it occurs; shorter texts are one shingle; texts without words, and null ones, have
    fingerprint zero and link like any other. A bit is set if more than half of the shingles'
    hashes have it. Repeated rows are documents each. Rows without doc_id link too but name
    no component: it is null where no row has an id. Other columns are dropped; an empty table
    gives an empty one.
    """
    known = durable(with_fingerprints(docs), "fingerprints")
    nodes = durable(known.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct")
    joined = nodes.join(components(links(nodes)).withColumnRenamed("node", "fp"), "fp", "left")
    joined = joined.select("fp", "least", F.coalesce("label", "fp").alias("label"))
    named = joined.groupBy("label").agg(F.min("least").alias("component_id"))
    of_fp = joined.select("fp", "label").join(named, "label").select("fp", "component_id")
    out = spread_join(known, of_fp, ["fp"], ["doc_id"])
    return out.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")
