"""Connected components by alternating large and small stars.

Each round every node hands the smallest node it knows to its neighbours (large star to
the larger ones, small star to the smaller ones), until each component is a star around its
smallest node. Minima are partial aggregates, so a node with many neighbours costs one row
per task. Each round is written to the shared folder, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import durable

ROUNDS = 60


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """node and label (the smallest node of its component) of every node in `edges` (a, b).

    Edges with a null or equal ends are ignored.
    """
    e = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(e)
    for _ in range(ROUNDS):
        both = e.union(e.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        e = durable(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "stars")
        last, state = state, _state(e)
        if state == last:
            break
    else:
        raise RuntimeError(f"no star after {ROUNDS} rounds")
    nodes = e.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return nodes.union(e.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct()
