import numpy as np
import pytest

from postloom.llm import ann, grid, topk

VECTORS = "vec_id LONG, embedding ARRAY<DOUBLE>"


def best(ids, scores, k, own):
    order = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return [(int(ids[i]), scores[i]) for i in order]


def table(spark, rows):
    return spark.createDataFrame(rows, VECTORS).selectExpr("vec_id", "embedding", "1 AS label", "2 AS rank", "3 AS q", "4 AS v", "5 AS dim", "6 AS score")


def test_threshold_search_is_exact():
    rng = np.random.default_rng(3)
    for n, d, kind in [(1, 3, "normal"), (40, 1, "few"), (900, 4, "heavy"), (1500, 12, "few"), (700, 6, "normal")]:
        x = {"normal": rng.normal(size=(n, d)), "few": rng.integers(-1, 2, (n, d)) / 4, "heavy": rng.exponential(1, (n, d)) ** 4}[kind]
        q = np.concatenate([rng.normal(size=(20, d)) * (rng.random((20, d)) < 0.6), np.zeros((1, d)), x[:3]])
        ids = rng.permutation(n).astype(np.int64)
        own = np.append(np.full(21, -1), ids[:3])[: len(q)]
        got = {i: list(zip(f.tolist(), s.tolist())) for i, f, s in topk.cell(5)(ids, x, own, q)}
        scores = topk.quantized(q) @ topk.quantized(x).T
        assert all(got[i] == best(ids, scores[i], 5, own[i]) for i in range(len(q)))


def test_a_skewed_query_stops_early():
    x = np.random.default_rng(1).exponential(1, (8000, 3)) ** 3
    lists = topk.Lists(topk.quantized(x), np.arange(8000))
    q = topk.quantized(np.array([[1.0, 0, 0]]))
    assert lists.stop(q, np.sort(q @ lists.x.T)[:, -5])[0] < 100


def test_top_k_rows(spark, monkeypatch):
    monkeypatch.setattr(grid, "VECTOR_BLOCK", 40)
    monkeypatch.setattr(grid, "QUERY_BLOCK", 7)
    rng = np.random.default_rng(2)
    x = np.round(rng.normal(size=(150, 5)), 1)
    x[::3] = x[0]  # a large group of copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0, 1.0]), (902, [float("nan")] * 5), (903, [float("inf")] * 5), (None, x[0].tolist()), (904, [1.0, 2.0]), (905, [])]
    df = table(spark, rows + odd)
    got = {}
    for r in topk.top_k(df, df.where("vec_id % 10 = 0 or vec_id = 904 or vec_id = 905"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    z = np.floor(256 * x)
    assert set(got) == set(range(0, 150, 10))
    for q, found in got.items():
        assert [f[1:] for f in sorted(found)] == best(np.arange(150), z @ z[q], 5, q)
    assert topk.top_k(df.limit(0), df, 5).count() == topk.top_k(df, df.limit(0), 5).count() == 0


def test_large_values_stay_whole(spark):
    df = table(spark, [(0, [2.0**20, 1.0]), (50, [2.0**19, 3.0]), (1, [1.0, 2.0**20])])
    got = {(r.query_id, r.vec_id): r.score for r in topk.top_k(df, df, 5).collect()}
    assert got[0, 50] == 2**16 * 2**39 + 2**16 * 3


def test_neighbours_recall_and_scores(spark, monkeypatch):
    monkeypatch.setattr(grid, "VECTOR_BLOCK", 500)
    rng = np.random.default_rng(4)
    x = rng.normal(size=(20, 24))[rng.integers(0, 20, 1500)] + rng.normal(size=(1500, 24)) / 2
    x[700:900] = x[700]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2050, [0.0] * 24), (2001, [float("nan")] * 24), (2002, [1.0])]
    df = table(spark, rows)
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 50 = 0"), 5).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    assert set(got) == set(range(0, 1500, 50))
    hits = 0
    for q, found in got.items():
        cos = (unit @ unit[q]).round(12)
        hits += len({f[1] for f in found} & {i for i, _ in best(np.arange(1500), cos, 5, q)})
        assert [f[0] for f in sorted(found)] == [1, 2, 3, 4, 5]
        assert all(abs(s - unit[i] @ unit[q]) < 1e-12 for _, i, s in found)
    assert hits >= 0.9 * 5 * len(got)
    assert [f[1] for f in sorted(got[800])] == [700, 701, 702, 703, 704]


def test_chi_square():
    assert abs(ann.chi_square(np.array([15.507]), 8)[0] - 0.95) < 1e-4
    assert ann.chi_square(np.array([0.0, np.inf]), 8).tolist() == [0.0, 1.0]


def test_tree_holds_every_point():
    points = np.repeat(np.random.default_rng(0).normal(size=(50, 4)), 7, axis=0)
    leaves, low, high = ann.tree(points, 16)
    assert sorted(np.concatenate(leaves).tolist()) == list(range(350))
    assert all((points[r] >= low[i]).all() and (points[r] <= high[i]).all() for i, r in enumerate(leaves))


def ranked(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(float(r.score), 9)))
    return {q: sorted(rows) for q, rows in out.items()}


def test_repeated_and_conflicting_query_rows(spark, monkeypatch):
    monkeypatch.setattr(grid, "VECTOR_BLOCK", 30)
    monkeypatch.setattr(grid, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(7)
    x = rng.normal(size=(120, 6))
    vectors = table(spark, [(i, v.tolist()) for i, v in enumerate(x)])
    one = [(0, x[0].tolist()), (50, x[50].tolist())]
    other = (50, x[3].tolist())
    for search, score in [(topk.top_k, lambda q: np.floor(256 * x) @ np.floor(256 * q)), (ann.nearest, lambda q: x @ q / np.linalg.norm(x, axis=1) / np.linalg.norm(q))]:
        once = ranked(search(vectors, table(spark, one), 5))
        assert ranked(search(vectors, table(spark, one + one[:1] * 3), 5)) == once
        assert [i for _, i, _ in once[0]] == [i for i, _ in best(np.arange(120), score(x[0]), 5, 0)]
        both = ranked(search(vectors, table(spark, [*one, other]), 5))[50]
        want = [i for q in (x[50], x[3]) for i, _ in best(np.arange(120), score(q), 5, 50)]
        assert sorted(i for _, i, _ in both) == sorted(want) and [k for k, _, _ in both] == sorted([1, 2, 3, 4, 5] * 2)


def test_tiny_components_and_large_scores(spark):
    df = table(spark, [(0, [1e-170, 2e-170]), (1, [1e-170, 2.1e-170]), (2, [1e170, -1e170])])
    got = {(r.query_id, r.vec_id): r.score for r in ann.nearest(df, df, 5).collect()}
    assert abs(got[0, 1] - 5.2 / (5 * (1 + 2.1**2)) ** 0.5) < 1e-12 and abs(got[0, 2] + 1 / 10**0.5) < 1e-12
    with pytest.raises(Exception, match="63 bits"):
        topk.top_k(df, df, 5).collect()
