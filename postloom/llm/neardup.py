"""Near-duplicate join: 5-word shingles, Jaccard of 0.8 or more.

1. Every text becomes a sketch: an id of its shingle set and MinHash values. Texts with the
   same set are one node from here on, however many copies there are.
2. Bands of MinHash values deal the nodes into buckets. Buckets with the same members count
   once. Inside a bucket MinHash values are compared step by step; a pair is dropped when
   the posterior probability (uniform prior) that its Jaccard reaches the threshold falls
   below `TOLERANCE`. What is left is handed on as a spanning forest, not as pairs.
3. Components of those forests are the candidate groups. In a group every pair is verified
   exactly on the shingle sets. A node gets its number of links and a forest of links.
4. Components of links are the classes; the smallest doc_id names them.

Buckets and groups of any size are cut into blocks, and each task compares two blocks, so no
task holds more than two blocks and no pair is ever a row.

Shingles are compared by 64-bit hashes. Two sets of Jaccard J share no band with
probability (1 - J ** ROWS) ** BANDS, 6.6e-6 at 0.8.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..runtime import durable
from .common import GramHasher, batch, chunks, mix, text_bytes, word_hashes, words
from .graph import components

SHINGLE = 5
#: Jaccard threshold as a fraction, so that it is compared in whole numbers.
NUMERATOR, DENOMINATOR = 4, 5
BANDS, ROWS = 30, 5
HASHES = BANDS * ROWS
TOLERANCE = 1e-6
STEP = 30
#: Nodes of a block where MinHash values, and where shingle sets are compared.
SKETCH_BLOCK, SET_BLOCK = 1024, 256
SEED = 20240305


def shingles(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of every text, sorted within it, and n + 1 bounds. A
    text of one to four words has one shingle, its words."""
    data, bounds = text_bytes(texts)
    starts, ends, at = words(data, bounds)
    hashes = word_hashes(data, starts, ends)
    n = np.diff(at)
    grams = GramHasher(hashes)
    count = np.where(n > 0, np.maximum(n - SHINGLE + 1, 1), 0)
    text = np.repeat(np.arange(len(n)), count)
    first = at[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    made = grams.at(first, np.minimum(SHINGLE, n[text]))
    order = np.lexsort((made, text))
    made, text = made[order], text[order]
    keep = np.ones(len(made), bool)
    keep[1:] = (made[1:] != made[:-1]) | (text[1:] != text[:-1])
    return made[keep], np.searchsorted(text[keep], np.arange(len(n) + 1))


@cache
def _seeds() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    draw = lambda: rng.integers(0, 2**32, HASHES, dtype=np.uint32)
    return draw(), draw() | np.uint32(1)


def minhashes(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """A row of `HASHES` values for every set; empty sets get zeros."""
    some = np.flatnonzero(np.diff(at))
    out = np.zeros((len(at) - 1, HASHES), np.uint32)
    if len(some):
        low = (sets >> np.uint64(32)).astype(np.uint32)
        starts = at[some]
        for k, (turn, by) in enumerate(zip(*_seeds())):
            out[some, k] = np.minimum.reduceat((low ^ turn) * by, starts)
    return out


def set_ids(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """One number for each set, of the sums of two mixtures of its members."""
    total = np.zeros((2, len(sets) + 1), np.uint64)
    np.cumsum(mix(sets), out=total[0, 1:])
    np.cumsum(mix(sets ^ np.uint64(0x5851F42D4C957F2D)), out=total[1, 1:])
    one, two = total[:, at[1:]] - total[:, at[:-1]]
    return mix(one + mix(two + np.diff(at).astype(np.uint64))).view(np.int64)


@cache
def least_matches() -> list[int]:
    """For each number of values compared, the fewest equal ones that keep a pair."""
    t = NUMERATOR / DENOMINATOR
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        # Beta(m + 1, n - m + 1) lies above t with the probability of m successes or fewer in n + 1 trials.
        below, m = 0.0, -1
        while below < TOLERANCE:
            m += 1
            below += comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        out.append(m)
    return out


_SKETCH = pa.schema([("doc_id", pa.int64()), ("set_id", pa.int64()), ("values", pa.binary())])


def sketches(docs: DataFrame, text_ids: bool = False) -> DataFrame:
    """doc_id, set_id and values of every row, and text_id (a hash of the text) if asked for."""
    schema = _SKETCH.append(pa.field("text_id", pa.int64())) if text_ids else _SKETCH

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(1)):
                part = b.slice(lo, hi - lo)
                sets, at = shingles(part.column(1))
                ids = pa.array(set_ids(sets, at), mask=np.diff(at) == 0)
                made = {"doc_id": part.column(0), "set_id": ids, "values": [v.tobytes() for v in minhashes(sets, at)]}
                if text_ids:
                    made["text_id"] = part.column(2)
                yield batch(schema, **made)

    hashed = [F.xxhash64(docs["text"]).alias("text_id")] if text_ids else []
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], *hashed)
    return own.mapInArrow(run, "doc_id LONG, set_id LONG, values BINARY" + ", text_id LONG" * text_ids)


def _bands(nodes: DataFrame) -> DataFrame:
    """band and set_id of every node (set_id, values)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            values = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
            key = np.zeros(values.shape[:2], np.uint64) + np.arange(BANDS, dtype=np.uint64)
            for k in range(ROWS):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + values[:, :, k])
            ids = np.repeat(b.column(0).to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(key.ravel().view(np.int64)), pa.array(ids)], ["band", "set_id"])

    return nodes.select("set_id", "values").mapInArrow(run, "band LONG, set_id LONG")


def _cells(members: DataFrame, payload: str, block: int) -> DataFrame:
    """Deal `members` (grp, size, set_id, payload and any others) into cells of two blocks,
    sorted by cell: grp, i, j, blk and the other columns."""
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    dealt = members.withColumn("blocks", blocks).withColumn("blk", F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(
        "grp", F.least("blk", "other").alias("i"), F.greatest("blk", "other").alias("j"),
        *[c for c in dealt.columns if c not in ("grp", "size", "blocks", "other")],
    )
    key = ["grp", "i", "j"]
    return dealt.repartition(*key).sortWithinPartitions(*key, "set_id")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one cell after another."""
    left: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        keys = [t[c].to_numpy() for c in ("grp", "i", "j")]
        new = np.zeros(t.num_rows, bool)
        for k in keys:
            new[1:] |= k[1:] != k[:-1]
        if left and any(int(left[0][c][0].as_py()) != int(k[0]) for c, k in zip(("grp", "i", "j"), keys)):
            yield pa.concat_tables(left).combine_chunks()
            left = []
        cuts = [0, *np.flatnonzero(new).tolist(), t.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            left.append(t.slice(lo, hi - lo))
            if hi < t.num_rows:
                yield pa.concat_tables(left).combine_chunks()
                left = []
    if left:
        yield pa.concat_tables(left).combine_chunks()


class _Forest:
    def __init__(self, n: int):
        self.up = np.arange(n)

    def roots(self) -> np.ndarray:
        while True:
            jumped = self.up[self.up]
            if (jumped == self.up).all():
                return self.up
            self.up = jumped

    def join(self, a: int, others: np.ndarray) -> None:
        """Link a with all others."""
        roots = self.roots()
        met = np.unique(np.append(roots[others], roots[a]))
        self.up[met] = met[0]


def _alike(cell: pa.Table) -> np.ndarray:
    """Root row of every row, over pairs of the cell whose MinHash values keep them."""
    values = np.frombuffer(b"".join(cell["values"].to_pylist()), np.uint32).reshape(-1, HASHES)
    forest, side = _Forest(len(values)), cell["blk"].to_numpy()
    two = cell["i"][0].as_py() != cell["j"][0].as_py()
    for a in range(len(values) - 1):
        rest = a + 1 + np.flatnonzero(forest.roots()[a + 1 :] != forest.up[a])
        if two:
            rest = rest[side[rest] != side[a]]
        same = np.zeros(len(rest), np.int64)
        for k, least in enumerate(least_matches()):
            if not len(rest):
                break
            part = slice(k * STEP, (k + 1) * STEP)
            same += (values[rest, part] == values[a, part]).sum(1)
            keep = same >= least
            rest, same = rest[keep], same[keep]
        if len(rest):
            forest.join(a, rest)
    return forest.roots()


def _likely(buckets: DataFrame) -> DataFrame:
    """Forest edges (a, b) of pairs that MinHash values leave in, per cell of buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches):
            root, ids = _alike(cell), cell["set_id"].to_numpy()
            at = np.flatnonzero(root != np.arange(len(root)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[at]), pa.array(ids[root[at]])], ["a", "b"])

    return buckets.mapInArrow(run, "a LONG, b LONG")


def links(sets: list[np.ndarray], side: np.ndarray | None) -> np.ndarray:
    """Which pairs reach the threshold, as a matrix; `side` limits them to pairs across."""
    size = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    kinds, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(sets)), size)
    shared = count[place] > 1
    column = (np.cumsum(count > 1) - 1)[place[shared]]
    row, width = row[shared], int((count > 1).sum())
    common = np.zeros((len(sets), len(sets)), np.float32)
    step = 8192
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for lo in range(0, width, step):
        a, b = np.searchsorted(column, [lo, lo + step])
        m = np.zeros((len(sets), min(step, width - lo)), np.float32)
        m[row[a:b], column[a:b] - lo] = 1
        common += m @ m.T  # whole numbers below 2 ** 24: exact
    common = common.astype(np.int64)
    out = common * (NUMERATOR + DENOMINATOR) >= NUMERATOR * (size[:, None] + size)
    np.fill_diagonal(out, False)
    if side is not None:
        out &= side[:, None] != side
    return out


def _verified(cells: DataFrame) -> DataFrame:
    """set_id, n_links (documents linked in this cell) and root (a set it is linked with)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell in _groups(batches):
            ids, first = np.unique(cell["set_id"].to_numpy(), return_index=True)
            cell = cell.take(pa.array(first))
            sets = [np.frombuffer(s, np.uint64) for s in cell["shingles"].to_pylist()]
            side = cell["blk"].to_numpy() if cell["i"][0].as_py() != cell["j"][0].as_py() else None
            linked = links(sets, side)
            forest = _Forest(len(ids))
            for a in np.flatnonzero(linked.any(1)):
                forest.join(int(a), np.flatnonzero(linked[a]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), pa.array(linked @ cell["copies"].to_numpy()), pa.array(ids[forest.roots()])],
                ["set_id", "n_links", "root"],
            )

    return cells.mapInArrow(run, "set_id LONG, n_links LONG, root LONG")


def _with_shingles(docs: DataFrame, members: DataFrame) -> DataFrame:
    """`members` (doc_id, set_id and others) with the shingles of their documents."""

    names = [c for c in members.columns if c not in ("doc_id", "text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi in chunks(b.column(0)):
                part = b.slice(lo, hi - lo)
                sets, at = shingles(part.column(0))
                # A repeated doc_id may stand for other texts too.
                keep = set_ids(sets, at) == part.column(1 + names.index("set_id")).to_numpy()
                packed = [sets[x:y].tobytes() for x, y in zip(at[:-1], at[1:])]
                made = pa.RecordBatch.from_arrays([*part.columns[1:], pa.array(packed, pa.binary())], [*names, "shingles"])
                yield made.filter(pa.array(keep))

    kinds = ", ".join(f"{c} {members.schema[c].dataType.simpleString()}" for c in names)
    own = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"])
    return own.join(members, "doc_id").select("text", *names).mapInArrow(run, f"{kinds}, shingles BINARY")


def classes(docs: DataFrame, firsts: bool = False) -> DataFrame:
    """doc_id, class_id (smallest doc_id of the class) and n_links (other documents of
    Jaccard 0.8 or more) of every row of `docs` (doc_id, text).

    Words are runs without blanks, case counts. A text of one to four words is one shingle;
    null, empty and blank texts have none, so they link with nothing and are classes of
    their own. Rows without doc_id count as copies of the same set only: they are linked
    with them, and have the class of the set. Repeated rows are documents each. Other
    columns are dropped; an empty table gives an empty table.

    With `firsts` also text_id (`xxhash64` of the text) and first, the smallest (doc_id,
    text_id) of the class among rows with doc_id.
    """
    known = durable(sketches(docs, firsts), "sketches")
    own = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_id")) if firsts else F.lit(None)
    nodes = known.where("set_id is not null").groupBy("set_id").agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"), F.min(own).alias("first")
    )
    bands = _bands(known.where("set_id is not null").select("set_id", "values").dropDuplicates(["set_id"]))
    mixed = F.xxhash64("set_id")
    full = bands.groupBy("band").agg(
        F.count("*").alias("size"), F.bit_xor(mixed).alias("x"), F.sum(F.shiftright(mixed, 34)).alias("s")
    )
    once = full.where("size > 1").groupBy("size", "x", "s").agg(F.min("band").alias("band")).select("band", "size")
    in_bucket = bands.join(once, "band").select(F.col("band").alias("grp"), "size", "set_id")
    values = known.where("set_id is not null").select("set_id", "values").dropDuplicates(["set_id"])
    likely = _likely(_cells(in_bucket.join(values, "set_id"), "values", SKETCH_BLOCK))
    groups = components(likely)
    sizes = groups.groupBy("label").agg(F.count("*").alias("size"))
    members = (
        groups.join(sizes, "label")
        .withColumnsRenamed({"node": "set_id", "label": "grp"})
        .join(nodes, "set_id")
        .select("doc_id", "set_id", "grp", "size", "copies")
    )
    found = durable(_verified(_cells(_with_shingles(docs, members), "shingles", SET_BLOCK)), "links")
    label = components(found.select(F.col("set_id").alias("a"), F.col("root").alias("b")))
    linked = found.groupBy("set_id").agg(F.sum("n_links").alias("others"))
    per_set = (
        nodes.join(linked, "set_id", "left")
        .join(label.withColumnRenamed("node", "set_id"), "set_id", "left")
        .select("set_id", "doc_id", "copies", "first", "others", F.coalesce("label", "set_id").alias("label"))
    )
    named = per_set.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.min("first").alias("class_first"))
    of_set = per_set.join(named, "label").select(
        "set_id", "class_id", "class_first", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")
    )
    out = known.drop("values").join(of_set, "set_id", "left")
    alone = F.col("set_id").isNull()
    more = ["text_id", F.when(alone, own).otherwise(F.col("class_first")).alias("first")] if firsts else []
    return out.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
        *more,
    )
