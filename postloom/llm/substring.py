"""Substring deduplication with difference-cover anchors.

A window is `WINDOW` consecutive words. Residues of a difference cover modulo `PERIOD` are
chosen so that for any two places of a repeated passage there is an offset below `PERIOD`
at which both places have a chosen residue. So of a window that occurs twice, some stretch
of `ANCHOR` = `WINDOW` - `PERIOD` + 1 words starts at a chosen place in both occurrences:
hashing stretches only there (six of 31 places) misses no repeat.

1. Anchors are dealt by hash; those that occur in two documents are kept.
2. Only around kept anchors are whole windows hashed and dealt by hash; a window that
   starts in a document of smaller id too covers its words.
3. Documents get their covered places back and are cut.

Hot passages: what a task sees twice it settles itself. Of several documents with one hash
in a task, one item goes by the hash for the others' sake; the rest is known already (step
1: to repeat, which that item says; step 2: all but the smallest document to be covered), is
packed as runs of places and travels by document. So no place gets more than one document per
task and hash.

Items travel as packed columns, by text and place. What is found comes back in about as many
rows as there are finds, so rows are packed, read and marked together, for all texts of a
chunk or all items of a place, with no call per row. Texts are packed too and cross the
network once: both joins with what was found read the same exchange.

Words and windows are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import CHUNK_BYTES, _SPACE, GramHasher, chunks, mix, text_bytes, word_hashes, words

WINDOW = 50
PERIOD = 31
#: A perfect difference set modulo 31 (fixed values).
COVER = (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1

#: Packed rows that a task gathers before it deals them out, rows aimed at per place, and
#: places of a task. With many places a document's finds come back in about as many rows as
#: it has finds, whatever the size of the corpus; with few places, in as many as there are.
BUFFER = 2_000_000
PLACE_ROWS = 25_000
TASK_PLACES = 16

_ITEM = np.dtype([("hash", "<u8"), ("doc", "<i8"), ("key", "<i8"), ("at", "<i4")])
_RUN = np.dtype([("doc", "<i8"), ("key", "<i8"), ("at", "<i4"), ("end", "<i4")])
_PAIR = np.dtype([("at", "<i4"), ("end", "<i4")])


class Texts:
    """Words of a chunk of texts, with the hashes of their stretches."""

    def __init__(self, texts: pa.Array):
        self.data, self.bounds = text_bytes(texts)
        self.starts, self.ends, self.first = words(self.data, self.bounds)
        self.count = np.diff(self.first)

    @cached_property
    def grams(self) -> GramHasher:
        return GramHasher(word_hashes(self.data, self.starts, self.ends))

    def text_of(self, words: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, words, "right") - 1

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and hash of every stretch at a place of the cover."""
        text = np.repeat(np.arange(len(self.count)), self.count)
        at = np.arange(len(text)) - self.first[:-1][text]
        cover = np.zeros(PERIOD, bool)
        cover[list(COVER)] = True
        keep = np.flatnonzero(cover[at % PERIOD] & (at + ANCHOR <= self.count[text]) & (self.count[text] >= WINDOW))
        return text[keep], at[keep], self.grams.at(keep, ANCHOR)

    def marked(self, found: pa.Array, more: int) -> np.ndarray:
        """Which words lie in the runs found for their texts, each run lengthened by `more`."""
        pairs, text = _pairs(found)
        n, end = len(self.starts), self.first[text + 1]
        mark = np.bincount(np.minimum(self.first[text] + pairs["at"], end), minlength=n + 1)
        mark -= np.bincount(np.minimum(self.first[text] + pairs["end"] + more, end), minlength=n + 1)
        return np.cumsum(mark)[:n] > 0

    def windows(self, near: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place and hash of the windows that hold an anchor at a place in `near`."""
        total = np.concatenate([[0], np.cumsum(self.marked(near, 0))])
        at = np.flatnonzero(total[PERIOD:] > total[:-PERIOD])
        text = self.text_of(at)
        inside = at + WINDOW <= self.first[text + 1]
        at, text = at[inside], text[inside]
        return text, at - self.first[text], self.grams.at(at, WINDOW)

    def left(self, away: np.ndarray, whole: np.ndarray) -> pa.Array:
        """Of each text the words that are not `away`, joined by one blank, or the text itself if `whole`."""
        at = np.flatnonzero(~away)
        # The byte behind a word goes with it as the blank, but for the last word of a text.
        to = self.ends[at] + 1
        to[np.append(np.diff(self.text_of(at)), 1)[: len(at)] > 0] -= 1
        step = np.zeros(len(self.data) + 1, np.int8)
        step[self.starts[at]] += 1
        step[to] -= 1
        as_is = np.repeat(whole, np.diff(self.bounds))
        keep = (np.cumsum(step[:-1], dtype=np.int8) > 0) | as_is
        data = np.where(_SPACE[self.data] & ~as_is, np.uint8(0x20), self.data)[keep]
        bounds = np.concatenate([[0], np.cumsum(keep)])[self.bounds]
        return pa.Array.from_buffers(pa.large_string(), len(whole), [None, pa.py_buffer(bounds), pa.py_buffer(data)])


def _pairs(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All runs of lists of packed runs (a list per text, or null), and each one's text."""
    raw = found.flatten()
    lists = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(found), 0).to_numpy(zero_copy_only=False))])
    data, at = text_bytes(raw)
    return data.view(_PAIR), np.repeat(np.arange(len(found)), np.diff(at[lists]) // _PAIR.itemsize)


Rows = dict[str, np.ndarray]


def _cells(kind: np.dtype, counts: np.ndarray) -> Iterator[tuple[str, np.ndarray]]:
    """For each column the cells of four bytes that its values take, where groups of `counts`
    rows lie one after another, and in each group column after column."""
    start = np.repeat(np.cumsum(counts) - counts, counts)
    within, size = np.arange(len(start)) - start, np.repeat(counts, counts)
    before = 0
    for c in kind.names:
        width = kind[c].itemsize // 4
        yield c, (start * (kind.itemsize // 4) + size * before + within * width)[:, None] + np.arange(width)
        before += width


def pack(rows: Rows, kind: np.dtype, counts: np.ndarray) -> pa.Array:
    """Groups of `counts` rows, one packed value each."""
    out = np.empty(int(counts.sum()) * kind.itemsize // 4, np.uint32)
    for c, cells in _cells(kind, counts):
        out[cells] = rows[c].view(np.uint32).reshape(cells.shape)
    bounds = np.concatenate([[0], np.cumsum(counts)]) * kind.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(bounds), pa.py_buffer(out)])


def unpack(raw: list[bytes], kind: np.dtype) -> Rows:
    counts = np.array([len(r) for r in raw], np.int64) // kind.itemsize
    data = np.frombuffer(b"".join(raw), np.uint32)
    return {c: data[cells].reshape(-1).view(kind[c]) for c, cells in _cells(kind, counts)}


def take(rows: Rows, at: np.ndarray) -> Rows:
    return {c: v[at] for c, v in rows.items()}


def stack(tables: list[Rows]) -> Rows:
    return {c: np.concatenate([t[c] for t in tables]) for c in tables[0]}


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of values starts in columns."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def runs(items: Rows) -> Rows:
    """Runs of neighbouring places in items that lie by text and place."""
    n = len(items["at"])
    starts = _starts(items["doc"], items["key"], items["at"] - np.arange(n))
    last = np.append(starts[1:], n)[: len(starts)] - 1
    return {**{c: items[c][starts] for c in ("doc", "key", "at")}, "end": items["at"][last] + np.int32(1)}


def _by_hash(items: Rows) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the items by hash, where each hash starts there, and how many items it has."""
    order = np.argsort(items["hash"])
    starts = _starts(items["hash"][order])
    return order, starts, np.diff(np.append(starts, len(order)))


def shared(items: Rows) -> tuple[np.ndarray, Rows]:
    """Whether two documents have an item's hash, and one item for each such hash, at -1.

    An item at -1 says of its hash that two documents have it.
    """
    order, starts, count = _by_hash(items)
    doc, at = items["doc"][order], items["at"][order]
    two = np.minimum.reduceat(doc, starts) != np.maximum.reduceat(doc, starts)
    two |= np.minimum.reduceat(at, starts) < 0
    hit = np.empty(len(order), bool)
    hit[order] = np.repeat(two, count) & (at >= 0)
    one = {c: items[c][order[starts[two]]] for c in items}
    one["at"] = np.full(len(one["at"]), -1, np.int32)
    return hit, one


def covered(items: Rows) -> np.ndarray:
    """Whether a smaller document has an item's hash."""
    order, starts, count = _by_hash(items)
    doc = items["doc"][order]
    hit = np.empty(len(order), bool)
    hit[order] = doc > np.repeat(np.minimum.reduceat(doc, starts), count)
    return hit


_PACKED = "place INT, open BINARY, known BINARY"


class _Sender:
    """Gathers items of a task and deals them out, settling what it sees twice."""

    def __init__(self, places: int, kind: str):
        self.places, self.kind = places, kind
        self.parts: list[Rows] = []
        self.held = 0

    def add(self, hashes: np.ndarray, docs: np.ndarray, keys: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append({c: v.astype(_ITEM[c], copy=False) for c, v in zip(_ITEM.names, (hashes, docs, keys, at))})
        self.held += len(hashes)
        if self.held >= BUFFER:
            yield from self.send()

    def send(self) -> Iterator[pa.RecordBatch]:
        if not self.held:
            return
        items = stack(self.parts)
        self.parts, self.held = [], 0
        if self.kind == "anchors":
            known, one = shared(items)
            opened = stack([take(items, ~known), one])
        else:
            known = covered(items)
            opened = take(items, ~known)
        settled = runs(take(items, known))
        dealt = []
        for rows, kind, by in ((opened, _ITEM, opened["hash"]), (settled, _RUN, mix(settled["doc"].astype(np.uint64)))):
            to = (by % np.uint64(self.places)).astype(np.int64)
            dealt.append((take(rows, np.argsort(to, kind="stable")), kind, np.bincount(to, minlength=self.places)))
        place = np.flatnonzero(dealt[0][2] + dealt[1][2])
        o, k = (pack(rows, kind, count[place]) for rows, kind, count in dealt)
        for lo, hi in chunks(o):
            columns = [pa.array(place[lo:hi], pa.int32()), o.slice(lo, hi - lo), k.slice(lo, hi - lo)]
            yield pa.RecordBatch.from_arrays(columns, ["place", "open", "known"])


_SPOTS = "key LONG, runs BINARY"


def _settle(packed: DataFrame, kind: str, places: int) -> DataFrame:
    """Runs of places (packed pairs of start and end) of each document's items that repeat
    (anchors) or are covered (windows), a row per place that the items were dealt to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, opened, known = None, [], []

        def done() -> Iterator[pa.RecordBatch]:
            items = unpack(opened, _ITEM)
            hit = shared(items)[0] if kind == "anchors" else covered(items)
            found = stack([runs(take(items, hit)), unpack(known, _RUN)])
            found = take(found, np.argsort(found["key"], kind="stable"))
            starts = _starts(found["key"])
            ends = np.append(starts[1:], len(found["key"]))
            pairs = np.stack([found["at"], found["end"]], axis=1)
            for lo in range(0, len(starts), 20_000):
                at, to = starts[lo : lo + 20_000], ends[lo : lo + 20_000]
                bounds = (np.append(at, to[-1]) - at[0]).astype(np.int32) * np.int32(_PAIR.itemsize)
                buffers = [None, pa.py_buffer(bounds), pa.py_buffer(pairs[at[0] : to[-1]])]
                packed_runs = pa.Array.from_buffers(pa.binary(), len(at), buffers)
                yield pa.RecordBatch.from_arrays([pa.array(found["key"][at]), packed_runs], ["key", "runs"])

        for b in batches:
            for p, o, k in zip(*(c.to_pylist() for c in b.columns)):
                if place is not None and p != place:
                    yield from done()
                    opened, known = [], []
                place = p
                opened.append(o)
                known.append(k)
        if place is not None:
            yield from done()

    dealt = packed.repartition(max(8, places // TASK_PLACES), "place").sortWithinPartitions("place")
    return dealt.mapInArrow(run, _SPOTS).groupBy("key").agg(F.collect_list("runs").alias("runs"))


def _texts(docs: DataFrame, rest: list[str]) -> DataFrame:
    """doc_id, key (of id and text), packed (the text, compressed) and rest (other columns).

    The key is declared as never null: no join adds a filter, so both share one exchange.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            for lo, hi in chunks(b.column(2)):
                part = b.slice(lo, hi - lo)
                raw = [None if t is None else squeeze(t) for t in part.column(2).cast(pa.binary()).to_pylist()]
                columns = [part.column(0), part.column(1), pa.array(raw, pa.binary()), part.column(3)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "packed", "rest"])

    others = F.struct(F.lit(0).alias("none"), *[docs[c] for c in rest]).alias("rest")
    own = docs.select(*_keyed(docs), others)
    return own.mapInArrow(run, T.StructType().add("doc_id", "long").add("key", "long", False).add("packed", "binary").add(own.schema["rest"]))


def _keyed(docs: DataFrame) -> list[Column]:
    doc_id = docs["doc_id"].cast("long")
    return [doc_id.alias("doc_id"), F.xxhash64(doc_id, docs["text"]).alias("key"), docs["text"]]


def _unpacked(packed: pa.Array) -> Iterator[tuple[int, int, pa.Array]]:
    """Row ranges and their texts."""
    expand = zstandard.ZstdDecompressor().decompress
    for lo, hi in chunks(packed, CHUNK_BYTES // 3):
        yield lo, hi, pa.array([None if p is None else expand(p) for p in packed.slice(lo, hi - lo).to_pylist()], pa.binary())


def dedup(docs: DataFrame, rest: list[str] | None = None, verbatim: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept (the words left, joined by one blank) of every row
    of `docs` (doc_id, text), and rest (the other columns named, in a struct).

    With `verbatim`, kept is the text itself where no word goes.

    A word goes when it lies in a window of 50 consecutive words that also starts in a
    document of smaller doc_id; windows are judged on the input. Null text has no words;
    texts of fewer than 50 words lose none. Rows without doc_id lose nothing and take
    nothing from others. Rows of equal doc_id are texts each; they take nothing from one
    another. Other columns are dropped; an empty table gives an empty table.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    places = int(max(8, size // 6 * len(COVER) // PERIOD // PLACE_ROWS))

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sender(places, "anchors")
        for b in batches:
            ids, keys = b.column(0).to_numpy(), b.column(1).to_numpy()
            for lo, hi in chunks(b.column(2)):
                text, at, hashes = Texts(b.column(2).slice(lo, hi - lo)).anchors()
                yield from out.add(hashes, ids[lo:hi][text], keys[lo:hi][text], at)
        yield from out.send()

    known = docs.select(*_keyed(docs)).where("doc_id is not null and text is not null")
    repeated = _settle(known.mapInArrow(anchors, _PACKED), "anchors", places)
    texts = _texts(docs, rest or [])

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Sender(places, "windows")
        for b in batches:
            ids, keys, near = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(3)
            for lo, hi, part in _unpacked(b.column(2)):
                text, at, hashes = Texts(part).windows(near.slice(lo, hi - lo))
                yield from out.add(hashes, ids[lo:hi][text], keys[lo:hi][text], at)
        yield from out.send()

    join = lambda found, how: texts.join(found, "key", how).select("doc_id", "key", "packed", "runs", "rest")
    gone = _settle(join(repeated, "inner").mapInArrow(windows, _PACKED), "windows", places)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo, hi, part in _unpacked(b.column(2)):
                t = Texts(part)
                away = t.marked(b.column(3).slice(lo, hi - lo), WINDOW - 1)
                removed = np.diff(np.concatenate([[0], np.cumsum(away)])[t.first])
                kept = t.left(away, (removed == 0) & verbatim)
                if verbatim and part.null_count:
                    kept = pc.if_else(part.is_null(), pa.scalar(None, kept.type), kept)
                columns = [
                    b.column(0).slice(lo, hi - lo),
                    pa.array(t.count, pa.int64()),
                    pa.array(removed, pa.int64()),
                    kept,
                    b.column(4).slice(lo, hi - lo),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_removed", "kept", "rest"])

    kind = T.StructType().add("doc_id", "long").add("n_words", "long").add("n_removed", "long").add("kept", "string")
    return join(gone, "left").mapInArrow(cut, kind.add(texts.schema["rest"]))
