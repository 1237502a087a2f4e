"""Centroid clustering of integer vectors, in JVM expressions only.

Components count as floor(factor * x). A round reads the vectors once: `zip_with` and
`aggregate` give the squared distance to each centroid, which stands in the plan as a literal
array, `array_min` of (distance, number) structs picks the cluster, and one aggregate with a
sum per component adds up the clusters. The driver gets one row per cluster and round, however
many vectors there are; nothing but those sums is shuffled. All arithmetic is in whole
numbers, so the result doesn't depend on the order in which rows arrive, and a lost task
is run again with the same result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..runtime import durable
from .common import own_columns

#: Largest |x| * factor: 64 squares of differences of such numbers fit into 63 bits.
LARGEST = 2**27


def quantized(vectors: DataFrame, dim: int, factor: int = 256) -> DataFrame:
    """vec_id and z, the vector in whole numbers, of every usable row (see `cluster`)."""
    v = own_columns(vectors, "vec_id", "embedding").selectExpr(
        "cast(vec_id AS BIGINT) AS vec_id", "cast(embedding AS ARRAY<DOUBLE>) AS x"
    )
    kept = v.where(f"vec_id IS NOT NULL AND size(x) = {dim} AND forall(x, e -> e IS NOT NULL AND abs(e) < double('inf'))")
    whole = (
        f"transform(x, e -> if(abs({factor} * e) < {LARGEST}, floor({factor} * e), "
        "cast(raise_error('a component is too large to be clustered in whole numbers') AS BIGINT)))"
    )
    return kept.selectExpr("vec_id", f"{whole} AS z")


def first_centroids(z: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The vectors whose `seed:vec_id` has the k smallest hashes, in their order."""
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    return [r.z for r in z.select("z", hashed.alias("h")).orderBy("h", "z").limit(k).collect()]


def nearest(centroids: list[list[int]]) -> str:
    """SQL of the struct (distance, cluster) of the centroid nearest to `z`."""

    def choice(number: int, centroid: list[int]) -> str:
        literal = ", ".join(f"{c}L" for c in centroid)
        squares = f"zip_with(z, array({literal}), (a, b) -> (a - b) * (a - b))"
        return f"named_struct('distance', aggregate({squares}, 0L, (s, d) -> s + d), 'cluster', {number})"

    return f"array_min(array({', '.join(choice(i, c) for i, c in enumerate(centroids))}))"


def moved(z: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """The centroids after one round: floor of the mean of their vectors, or where they were."""
    sums = [F.expr(f"sum(z[{i}])").alias(f"s{i}") for i in range(len(centroids[0]))]
    found = z.groupBy(F.expr(nearest(centroids)).getField("cluster").alias("cluster")).agg(F.count("*").alias("n"), *sums)
    out = list(centroids)
    for r in found.collect():
        out[r.cluster] = [r[f"s{i}"] // r.n for i in range(len(out[0]))]
    return out


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, dim: int = 64, factor: int = 256, seed: int = 2) -> DataFrame:
    """vec_id, cluster, distance (squared), cluster_inertia, inertia and centroid of every
    usable vector (vec_id, embedding) after `rounds` rounds and a last assignment.

    The first centroids are the vectors of the k smallest sha256 of `seed:vec_id`; ties of
    distance go to the smaller number; a cluster that got no vector keeps its centroid.
    Usable are vectors of exactly `dim` components, none null or non-finite, with a vec_id.
    Repeated rows are vectors each, and count as such as first centroids too; of rows of
    one id the smaller vector comes first. Fewer than k vectors make as many centroids. Other
    columns are dropped; an empty table gives an empty table. A component of
    `LARGEST` / factor or more is an error, as sums would not be exact.
    """
    z = quantized(vectors, dim, factor)
    shape = "vec_id LONG, cluster INT, distance LONG, cluster_inertia LONG, inertia LONG, centroid ARRAY<LONG>"
    centroids = first_centroids(z, k, seed)
    if not centroids:
        return vectors.sparkSession.createDataFrame([], shape)
    for _ in range(rounds):
        centroids = moved(z, centroids)
    near = z.select("vec_id", F.expr(nearest(centroids)).alias("near")).select("vec_id", "near.cluster", "near.distance")
    near = durable(near, "assigned")
    inertia = {r.cluster: r.inertia for r in near.groupBy("cluster").agg(F.sum("distance").alias("inertia")).collect()}
    total = sum(inertia.values())
    rows = [(i, inertia[i], total, c) for i, c in enumerate(centroids) if i in inertia]
    named = vectors.sparkSession.createDataFrame(rows, "cluster INT, cluster_inertia LONG, inertia LONG, centroid ARRAY<LONG>")
    # One row per centroid, k at most.
    return near.join(F.broadcast(named), "cluster").select(*[f.split()[0] for f in shape.split(", ")])
