import hashlib
import math
import random

import pytest

from postloom.llm import kmeans

VECTORS = "vec_id LONG, embedding ARRAY<DOUBLE>"


def plain(rows, k, rounds):
    """{position: (cluster, distance)}, centroids."""
    z = [(i, [math.floor(256 * x) for x in v]) for i, v in rows]
    first = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in z)[:k]
    c = [v for _, v in first]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: min((apart(v, m), j) for j, m in enumerate(c))
    for _ in range(rounds):
        of = [near(v)[1] for _, v in z]
        groups = [[v for (_, v), j in zip(z, of) if j == n] for n in range(len(c))]
        c = [[sum(x) // len(g) for x in zip(*g)] if g else m for g, m in zip(groups, c)]
    return [(i, *near(v)[::-1]) for i, v in z], c


def vectors(n, dim, seed=1):
    rng = random.Random(seed)
    rows = [(i, [rng.choice([rng.uniform(-1, 1), -0.5, 0.0]) for _ in range(dim)]) for i in range(n)]
    return rows + [(n + i, rows[0][1]) for i in range(n // 2)]  # a large group of copies


@pytest.mark.parametrize(("n", "k", "dim"), [(60, 7, 4), (3, 5, 2), (40, 40, 3)])
def test_rounds_equal_plain_ones(spark, n, k, dim):
    rows = vectors(n, dim) + [(5, [0.25] * dim), (5, [0.25] * dim)]
    odd = [(900, None), (901, [None] * dim), (902, [float("nan")] * dim), (903, [-float("inf")] * dim), (904, [1.0]), (905, []), (None, [0.5] * dim)]
    df = spark.createDataFrame(rows + odd, VECTORS).selectExpr("*", "1 AS cluster", "2 AS z", "3 AS distance", "4 AS x")
    got = kmeans.cluster(df, k, 5, dim).collect()
    near, centroids = plain(rows, k, 5)
    assert sorted((r.vec_id, r.cluster, r.distance) for r in got) == sorted(near)
    sums = {j: sum(d for _, c, d in near if c == j) for j in range(k)}
    assert all(r.centroid == centroids[r.cluster] and r.cluster_inertia == sums[r.cluster] and r.inertia == sum(sums.values()) for r in got)


def test_ties_and_empty_clusters(spark):
    # All vectors alike: the first centroid gets them all, the others stay where they are.
    got = kmeans.cluster(spark.createDataFrame([(i, [1.0, -1.0]) for i in range(9)], VECTORS), 4, 5, 2).collect()
    assert {(r.cluster, r.distance, tuple(r.centroid)) for r in got} == {(0, 0, (256, -256))}


def test_empty_and_too_large(spark):
    df = spark.createDataFrame([(1, [1e9, 0.0])], VECTORS)
    assert kmeans.cluster(df.limit(0), 4, 5, 2).collect() == [] == kmeans.cluster(df, 4, 5, 3).collect()
    with pytest.raises(Exception, match="too large"):
        kmeans.cluster(df, 4, 5, 2).collect()


def test_no_python_worker_in_the_plan(spark):
    z = kmeans.quantized(spark.createDataFrame([(1, [1.0, 2.0])], VECTORS), 2)
    plan = z.selectExpr(kmeans.nearest([[1, 2], [3, -4]]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan.replace("Arrow Columnar", "")
