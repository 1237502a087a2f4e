"""Filter interaction audit: what each filter removes, in every order of the filters.

1. Every document gets a mask of the filters it fails by its own text, in JVM expressions.
2. Exact copies are found in radix tries. Texts are dealt by adaptive prefixes: a prefix
   that begins more than `RANGE_BYTES` of different texts is split by a longer one, so a
   range of texts stays small however many texts begin alike. A text with very many copies
   is salted by doc_id, and its smallest id, aggregated beforehand, goes to each salt.
   Each task reads its texts in order and inserts them whole into compressed tries that hold
   the smallest id at each terminal; a trie of `TRIE_BYTES` is closed at the next new text,
   so memory is bounded at any range size. Texts are compared byte by byte, never by a hash.
3. Masks are counted per part; all orders and steps follow from those few counts.

The plan of ranges needs a hash and a length of each text, not the texts: one slim
aggregate, and one more pass for each longer prefix, over the texts under heavy prefixes only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..runtime import durable
from .common import own_columns

#: Code points of the first prefix, and how many times longer each next one is.
FIRST_PREFIX, LONGER = 4, 4
#: Bytes of different texts under one prefix (with ROW_BYTES more for each), and copies of one
#: text in one task. Where 1/PARTS of all bytes or rows is more, that holds, so lists of heavy
#: prefixes and hot texts have fewer than PARTS entries.
RANGE_BYTES = 1024 * 1024
ROW_BYTES = 64
HOT_ROWS = 500
PARTS = 16384
#: Text bytes that a task takes, where the session's number of shuffle partitions is too small.
TASK_BYTES = 64 * 1024 * 1024
#: Text bytes that one trie takes in before the next is begun.
TRIE_BYTES = 32 * 1024 * 1024


def surface_fails(text: Column) -> dict[str, Column]:
    """Conditions on a text alone: too few words, too few distinct words, too many capital
    letters, a sign of markup."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return {
        "A": F.size(words) < 50,
        "B": 100 * F.size(F.array_distinct(words)) < 65 * F.size(words),
        "C": 100 * capitals > 5 * F.length(text),
        "D": text.rlike("[#$%&*|]"),
    }


class Trie:
    """A compressed radix trie over bytes; terminals are numbered and hold a smallest id."""

    NONE = np.iinfo(np.int64).max

    class Node:
        __slots__ = ("label", "below", "terminal")

        def __init__(self, label: bytes):
            self.label, self.below, self.terminal = label, {}, -1

    def __init__(self):
        self.root, self.least = self.Node(b""), []

    def insert(self, text: bytes) -> int:
        """The number of the terminal of `text`."""
        node, at = self.root, 0
        while at < len(text):
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = self.Node(text[at:])
            elif not text.startswith(child.label, at):
                child = self._split(node, child, common(child.label, text, at))
            at += len(child.label)
            node = child
        if node.terminal < 0:
            node.terminal = len(self.least)
            self.least.append(self.NONE)
        return node.terminal

    def _split(self, node: Node, child: Node, length: int) -> Node:
        upper = node.below[child.label[0]] = self.Node(child.label[:length])
        child.label = child.label[length:]
        upper.below[child.label[0]] = child
        return upper


def common(label: bytes, text: bytes, at: int) -> int:
    """How many first bytes of `label` stand in `text` from `at` on; not all of them do."""
    low, high = 0, len(label)  # the first `low` do, the first `high` don't
    while high - low > 1:
        middle = (low + high) // 2
        if text.startswith(label[low:middle], at + low):
            low = middle
        else:
            high = middle
    return low


def flagged(rows: DataFrame, bit: int) -> DataFrame:
    """doc_id, part and mask of the counted rows of `rows` (text, doc_id, part, mask, counted),
    which come in the order of texts; `bit` is added where the trie of a text holds a
    smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, held, size, last, place = Trie(), [], 0, None, -1

        def close() -> Iterator[pa.RecordBatch]:
            least = np.array(trie.least, np.int64)
            for part, places in held:
                ids = part.column(1).fill_null(Trie.NONE).to_numpy()
                copy = part.column(1).is_valid().to_numpy(zero_copy_only=False) & (ids > least[places])
                mask = part.column(3).to_numpy() | np.where(copy, bit, 0).astype(np.int32)
                made = [part.column(1), part.column(2), pa.array(mask, pa.int32())]
                yield pa.RecordBatch.from_arrays(made, ["doc_id", "part", "mask"]).filter(part.column(4))

        for b in batches:
            ids = b.column(1).to_pylist()
            first, places = 0, []
            for i in range(b.num_rows):
                text = b.column(0)[i].as_py()
                if text != last:
                    if size >= TRIE_BYTES:
                        held.append((b.slice(first, i - first), places))
                        yield from close()
                        trie, held, size, first, places = Trie(), [], 0, i, []
                    last, place = text, trie.insert(text)
                    size += len(text)
                places.append(place)
                if ids[i] is not None and ids[i] < trie.least[place]:
                    trie.least[place] = ids[i]
            # Texts are not needed again: they are in the trie.
            slim = pa.RecordBatch.from_arrays([pa.nulls(b.num_rows), *b.columns[1:]], b.schema.names)
            held.append((slim.slice(first), places))
        yield from close()

    return rows.mapInArrow(run, "doc_id LONG, part STRING, mask INT")


def _head(length: int) -> str:
    return f"xxhash64(substring(text, 1, {length}))"


def _under(length: int, heavy: list[int]) -> Column:
    """Whether the text begins with one of the heavy prefixes of that length."""
    return F.expr(f"{_head(length)} IN ({', '.join(f'{h}L' for h in heavy)})")


def ranges(rows: DataFrame) -> tuple[Column, DataFrame, int]:
    """How to deal `rows` (text): a column that is equal for texts of one range, the texts
    with too many copies for a task (their hash, and salts to deal them by), and text bytes."""
    length, levels = FIRST_PREFIX, []

    def slim(df: DataFrame) -> DataFrame:
        size = (F.octet_length("text") + ROW_BYTES).cast("long")
        by = df.groupBy(F.expr(_head(length)).alias("head"), F.xxhash64("text").alias("hash"))
        return by.agg(F.count("*").alias("n"), F.max(size).alias("bytes"))

    seen = durable(slim(rows), "texts")
    total = seen.agg(F.sum("n"), F.sum("bytes"), F.sum(F.col("n") * F.col("bytes"))).first()
    number, distinct, every = (x or 0 for x in total)
    most = max(HOT_ROWS, -(-number // PARTS))
    limit = max(RANGE_BYTES, -(-distinct // PARTS))
    hot = seen.groupBy("hash").agg(F.sum("n").alias("n")).where(F.col("n") > most)
    hot = hot.select("hash", F.ceil(F.col("n") / F.lit(most)).cast("int").alias("salts"))
    while True:
        by_head = seen.groupBy("head").agg(F.sum("bytes").alias("bytes"), F.count("*").alias("texts"))
        # Copies of one text need no longer prefix: they meet in one terminal, and are salted.
        heavy = by_head.where((F.col("bytes") > limit) & (F.col("texts") > 1)).select("head").collect()
        if not heavy:
            break
        levels.append((length, [r["head"] for r in heavy]))
        rows = rows.where(_under(*levels[-1]))
        length *= LONGER
        seen = slim(rows)
    key = F.expr(_head(length))
    for shorter, heavy in reversed(levels):
        key = F.when(_under(shorter, heavy), key).otherwise(F.expr(_head(shorter)))
    return key, hot, every


def masks(docs: DataFrame, fails: dict[str, Column], part: str) -> DataFrame:
    """doc_id, part and mask of every row: bit i is set where it fails the i-th of `fails`
    (conditions on a column `text`), and the next bit where its text is that of a smaller doc_id."""
    base = docs.select(
        F.coalesce(docs["text"], F.lit("")).alias("text"),
        docs["doc_id"].cast("long").alias("doc_id"),
        F.coalesce(docs[part].cast("string"), F.lit("")).alias("part"),
    )
    key, hot, size = ranges(base)
    # Fewer than PARTS rows of two numbers.
    salted = base.join(F.broadcast(hot), F.xxhash64("text") == hot["hash"], "left").drop("hash")
    of_text = [F.when(c, 1 << i).otherwise(0) for i, c in enumerate(fails.values())]
    rows = salted.select(
        "text", "doc_id", "part", sum(of_text, F.lit(0)).cast("int").alias("mask"), F.lit(True).alias("counted"),
        F.pmod(F.xxhash64("doc_id"), F.coalesce("salts", F.lit(1))).cast("int").alias("salt"),
    )
    firsts = salted.where("salts is not null").groupBy("text", "salts").agg(F.min("doc_id").alias("doc_id"))
    firsts = firsts.select(
        "text", "doc_id", F.lit("").alias("part"), F.lit(0).alias("mask"), F.lit(False).alias("counted"),
        F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
    )
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    dealt = rows.union(firsts).repartition(tasks, key, F.col("salt")).sortWithinPartitions("text")
    dealt = dealt.select(F.col("text").cast("binary").alias("text"), "doc_id", "part", "mask", "counted")
    return flagged(dealt, 1 << len(fails))


def orders(letters: str) -> Column:
    """One struct (filter_order, step, bit, before) for each step of each order: the step's
    filter and those before it as bits."""
    steps = []
    for order in permutations(letters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << letters.index(letter)
            steps.append(
                f"named_struct('filter_order', '{''.join(order)}', 'step', {step}, 'bit', {bit}, 'before', {before})"
            )
            before |= bit
    return F.expr(f"array({', '.join(steps)})")


def audit(docs: DataFrame, labels: DataFrame, fails: dict[str, Column], copies: str, part: str = "source") -> DataFrame:
    """What every filter does at every step of every order, for each value of `part`.

    `fails` names conditions on the column `text` by single letters; `copies` is the letter of
    the last filter, which a document fails whose text is exactly that of a smaller doc_id.
    Returns part, filter_order, step, kept (after the step), removed (at it), redundant (fail
    its filter but were removed before), unique_fails (fail its filter only), good_lost and
    toxic_lost (removed here, with quality or toxic label 1), and shapley (documents that
    its filter removes, summed over all orders), as numbers of documents.

    A null text is empty, a null part too. Rows are documents each: repeated rows of one id have
    no smaller id, so they are no copies of each other. Without doc_id a row is no copy, makes
    none and has no labels. Of several labels of one id the larger counts. A part that no
    row has gives no row, so an empty table gives an empty one. Other columns are dropped.
    """
    labelled = own_columns(labels, "doc_id", "quality", "toxic").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    one = labelled.agg(F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    known = masks(docs, fails, part).join(one, "doc_id", "left")
    of_label = lambda name: F.sum(F.when(F.col(name) == 1, 1).otherwise(0))
    counts = known.groupBy("part", "mask").agg(
        F.count("*").alias("n"), of_label("quality").alias("good"), of_label("toxic").alias("bad")
    )
    letters = "".join(fails) + copies
    steps = counts.select("*", F.explode(orders(letters)).alias("s")).select("*", "s.*")
    fail, passed = F.expr("mask & bit <> 0"), F.expr("mask & before = 0")
    total = lambda condition, n: F.sum(F.when(condition, n).otherwise(0)).cast("long")
    # A filter removes a document in those orders where it comes before the others it fails.
    share = F.expr(f"n * ({factorial(len(letters))} div greatest(bit_count(mask), 1))")
    return steps.groupBy("part", "filter_order", "step").agg(
        total(~fail & passed, F.col("n")).alias("kept"),
        total(fail & passed, F.col("n")).alias("removed"),
        total(fail & ~passed, F.col("n")).alias("redundant"),
        total(F.expr("mask = bit"), F.col("n")).alias("unique_fails"),
        total(fail & passed, F.col("good")).alias("good_lost"),
        total(fail & passed, F.col("bad")).alias("toxic_lost"),
        total(fail, share).alias("shapley"),
    )
