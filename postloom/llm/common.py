"""Helpers shared by the operators: Arrow batches, word spans and word hashes.

All hashes are 64 bits wide. A word's hash is a polynomial over random values of its
UTF-8 bytes, mixed at the end; n-gram hashes are polynomials over word hashes. Both come
from running sums, so the cost per word does not depend on the length of the n-gram.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Text bytes handled at once inside a task; a longer single text is handled alone.
CHUNK_BYTES = 1_000_000

#: Rows of an Arrow batch; texts of thousands of bytes make batches of a few megabytes.
BATCH_ROWS = 2000

#: Bytes that separate words: `[^\x20\x09-\x0D]+` is a word.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True

_WORD_BASE = 0x9E3779B97F4A7C15
_GRAM_BASE = 0xD6E8FEB86659FD93


def ship(spark: SparkSession) -> SparkSession:
    """Let the session's Python workers import this package, in batches of `BATCH_ROWS`.

    Where the driver's PYTHONPATH doesn't name it already, it goes to the executors as a
    zip file over Spark's own file server, once per application.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    top = Path(__file__).resolve().parents[2]
    context = spark.sparkContext
    known = {Path(p).resolve() for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p}
    if top not in known and context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        file = Path(tempfile.mkdtemp(prefix="postloom-code-")) / "postloom.zip"
        with zipfile.ZipFile(file, "w") as z:
            for path in sorted((top / "postloom").rglob("*.py")):
                z.write(path, path.relative_to(top))
        context.addPyFile(str(file))
    return spark


_shipped: set[str] = set()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def own_columns(df: DataFrame, *names: str) -> DataFrame:
    """The named columns only, so that other columns never clash with those made here."""
    return df.select(*[df[name] for name in names])


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most `limit` text bytes (one row at least)."""
    n = len(texts)
    offsets = _offsets(texts)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi
        lo = hi


def _offsets(texts: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    at = np.frombuffer(texts.buffers()[1], kind) if texts.buffers()[1] is not None else np.zeros(1, kind)
    return at[texts.offset : texts.offset + len(texts) + 1]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (nulls are empty) and the n + 1 bounds between them."""
    if texts.null_count:
        texts = texts.fill_null("")
    at = _offsets(texts).astype(np.int64)
    if len(at) == 0 or texts.buffers()[2] is None:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(texts.buffers()[2], np.uint8)[at[0] : at[-1]], at - at[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers whose bits all depend on all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@cache
def _byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_WORD_BASE))


_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2 ** 64 for i < n, at least."""
    known = _powers.get(base)
    if known is None or len(known) < n:
        size = 1 << max(12, (n - 1).bit_length())
        out = np.ones(size, np.uint64)
        k = 1
        while k < size:  # by doubling: out[k + i] = out[i] * base ** k
            out[k : 2 * k] = out[:k] * np.uint64(pow(base, k, 1 << 64))
            k *= 2
        known = _powers[base] = out
    return known


def _inverse(base: int) -> int:
    return pow(base, -1, 1 << 64)


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the n + 1 places where each text's words begin."""
    solid = ~_SPACE[data]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] = solid[inner]
    last[inner - 1] = solid[inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, bounds)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_byte_values()[data] * powers(_WORD_BASE, len(data))[: len(data)], out=total[1:])
    back = powers(_inverse(_WORD_BASE), len(data))
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


class GramHasher:
    """Hashes of n consecutive words, for any n, from one running sum."""

    def __init__(self, hashes: np.ndarray):
        n = len(hashes)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * powers(_GRAM_BASE, n + 1)[:n], out=self.total[1:])
        self.back = powers(_inverse(_GRAM_BASE), n + 1)

    def at(self, starts: np.ndarray, n: int | np.ndarray) -> np.ndarray:
        length = np.asarray(n).astype(np.uint64)
        return mix((self.total[starts + n] - self.total[starts]) * self.back[starts] + length)


def batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            columns[f.name] if isinstance(columns[f.name], pa.Array) else pa.array(columns[f.name], f.type)
            for f in schema
        ],
        schema=schema,
    )


def keep_where(docs: DataFrame, judge: Callable[[], Callable[[pa.Array], np.ndarray]]) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text `judge()` keeps.

    `judge` is called once per task; what it returns gets texts and gives booleans.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keeps = judge()
        for b in batches:
            for lo, hi in chunks(b.column(at)):
                part = b.slice(lo, hi - lo)
                yield part.filter(pa.array(keeps(part.column(at)), pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
