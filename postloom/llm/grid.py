"""A stated query set against all vectors, in blocks.

Vectors are dealt into blocks by a hash of their id, queries likewise. Each task gets one
block of each and returns its best few per query; those are merged by a window that Spark
limits before the shuffle. Block sizes are fixed, so tasks stay small at any table size and
copies of one vector, whose ids differ, are spread over all blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

VECTOR_BLOCK = 8192
QUERY_BLOCK = 1024

#: ids, vectors, query ids, query vectors -> rows of queries, vector ids, scores
Cell = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Iterator[tuple[int, np.ndarray, np.ndarray]]]


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (doubles) and dim, without vectors that are null or hold null or
    non-finite components, and without null ids."""
    v = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"), vectors["embedding"].cast("array<double>").alias("embedding")
    )
    whole = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).withColumn(
        "dim", F.size("embedding")
    )


def best(vectors: DataFrame, queries: DataFrame, k: int, cell: Cell, score: str) -> DataFrame:
    """query_id, rank, vec_id and score of each query's k best, as `cell` finds them in a
    block: larger scores first, ties to the smaller id. A vector is compared with queries
    of its own length only, never with its own id.

    Equal query rows are one query. Different vectors under one id are queries each, and
    each has its own ranks.
    """
    queries = queries.dropDuplicates(["vec_id", "embedding"]).withColumn("vector", F.xxhash64("embedding"))
    v_blocks = max(1, -(-vectors.count() // VECTOR_BLOCK))
    q_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    block = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = vectors.select("dim", block(v_blocks).alias("v"), every(q_blocks).alias("q"), "vec_id", "embedding")
    right = queries.select("dim", every(v_blocks).alias("v"), block(q_blocks).alias("q"), "vec_id", "embedding", "vector")
    number = pa.int64() if score == "LONG" else pa.float64()

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        q, h, i, s = [], [], [], []
        if a.num_rows and b.num_rows:
            query_ids, kinds = b["vec_id"].to_numpy(), b["vector"].to_numpy()
            for at, ids, scores in cell(a["vec_id"].to_numpy(), _matrix(a), query_ids, _matrix(b)):
                q.append(np.full(len(ids), query_ids[at]))
                h.append(np.full(len(ids), kinds[at]))
                i.append(ids)
                s.append(scores)
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        return pa.table(
            {
                "query_id": pa.array(join(q), pa.int64()),
                "vector": pa.array(join(h), pa.int64()),
                "vec_id": pa.array(join(i), pa.int64()),
                "score": pa.array(join(s).astype(np.int64 if score == "LONG" else np.float64), number),
            }
        )

    found = (
        left.groupBy("dim", "v", "q")
        .cogroup(right.groupBy("dim", "v", "q"))
        .applyInArrow(run, f"query_id LONG, vector LONG, vec_id LONG, score {score}")
    )
    order = Window.partitionBy("query_id", "vector").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _matrix(t: pa.Table) -> np.ndarray:
    flat = t["embedding"].combine_chunks()
    flat = flat.chunk(0) if isinstance(flat, pa.ChunkedArray) else flat
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(t), -1)
