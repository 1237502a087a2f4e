import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from postloom.llm import learning, quality, toxicity


def swapped_distance(a, b):
    """Edits between a and b, swaps of neighbours among them, each place edited once."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


def test_near_terms_equal_brute_force():
    rng = random.Random(1)
    terms = {"".join(rng.choice("abc") for _ in range(rng.randint(3, 11))): 1.0 for _ in range(40)}
    trie = toxicity.Trie(terms)
    for k in range(1500):
        w = "".join(rng.choice("aabbcc1" if k % 2 else "abc") for _ in range(rng.randint(0, 13)))
        want = [t for t in terms if 0 < swapped_distance(t, w) <= (len(t) >= 4) + ("1" in w and len(t) >= 8)]
        assert sorted(trie.near(w)) == sorted(want)


def test_long_terms_and_words_of_one_letter():
    trie = toxicity.Trie({"aaaaaaaa": 1.0, "abababab": 1.0, "bbbb": 1.0, "a-b-c-d-e": 1.0, "ab": 1.0})
    terms = ["aaaaaaaa", "abababab", "bbbb", "a-b-c-d-e", "ab"]
    words = ["a" * k for k in range(12)] + ["b" * k for k in range(7)] + ["aaaa1aaa", "ababab1", "ba1babab", "abababab", "a-b-c-d", "abcde", "1", ""]
    for w in words:
        want = [t for t in terms if 0 < swapped_distance(t, w) <= toxicity.reach(t, not w.isalpha())]
        assert sorted(trie.near(w)) == sorted(want), w


def test_swapped_and_twice_changed_terms():
    s = toxicity.Scorer(toxicity.Model({"idiot": 2.0, "disgusting": 2.0, "scum": 2.0, "ass": 2.0}, {"sum"}, None))
    for w in ["idoit", "d1sgust1ng", "dizgustin9", "sc*m", "csum!", "scumm"]:
        assert 0 < s.measure(f"a {w} x")[0] < 2, w
    for w in ["idito1", "d1sgust1n9", "sum", "scim5", "as", "asz"]:
        assert s.measure(f"a {w} x")[0] == 0, w


def test_context():
    s = toxicity.Scorer(toxicity.Model({"moron": 2.0}, {"maron"}, None))
    plain, thrown, quoted, said, wrong, harmless = (
        s.measure(t)[0] for t in ["a moron x", "you moron x", 'the "moron x" it', "he said moron x", "a m0ron! x", "a maron x"]
    )
    assert quoted < plain < thrown and said < plain and 0 < wrong < plain and harmless == 0
    assert s.measure('"no" moron "no"')[3] == 0
    assert s.measure(None) == s.measure("") == (0.0, 0, 0, 0, 0)


def labelled(prose, n=240):
    docs, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = prose(i, 80, 3000)
        if bad:
            text = " ".join(f"{w} vilewort" if k % 20 == 3 else w for k, w in enumerate(text.split()))
        docs.append((i, text))
        labels.append((i, int(bad)))
    return docs, labels


def frame(spark, labels, name):
    return spark.createDataFrame(labels, "doc_id LONG, label INT").selectExpr("doc_id", f"label AS {name}", "7 AS text")


def test_toxicity_on_held_out_rows(spark, documents, prose):
    docs, labels = labelled(prose)
    held_out = learning.crc(F.col("doc_id")) % 4 == 2
    model = toxicity.fit(documents(docs), frame(spark, labels, "toxic"), ~held_out)
    assert "vilewort" in model.terms
    extra = [(900, None), (901, ""), (None, "vilewort vilewort vilewrt you"), (902, "x " * 300_000)]
    got = toxicity.score(documents(docs + extra), model).collect()
    truth = dict(labels)
    right = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth]
    assert len(got) == len(docs) + 4 and np.mean(right) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(documents(docs).limit(0), model).count() == 0


def test_quoted_misspellings_stay_misspellings(spark, documents, prose):
    docs, labels = labelled(prose)
    more = {"vilewart": [0, 4, 8, 12, 1, 2], "vilewirt": [1, 2, 3, 5, 6, 7, 0]}
    docs = [(d, " ".join([t, *(w for w, of in more.items() if d in of)])) for d, t in docs]
    model = toxicity.fit(documents(docs), frame(spark, labels, "toxic"), F.lit(True))
    assert "vilewart" not in model.terms and "vilewart" not in model.harmless and "vilewirt" in model.harmless


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, None), (None, 0)]])
def test_labels_of_one_kind(spark, documents, labels):
    docs = documents([(1, "a"), (2, None)])
    model = toxicity.fit(docs, frame(spark, labels, "toxic"), F.lit(True))
    assert {r.score for r in toxicity.score(docs, model).collect()} == {1.0 if labels == [(1, 1)] else 0.0}
    model = quality.fit(docs, frame(spark, labels, "quality"), F.lit(True))
    assert {r.score for r in quality.score(docs, model).collect()} == {1.0 if labels == [(1, 1)] else 0.0}


def test_quality_on_held_out_rows(spark, documents, prose):
    docs, labels = [], []
    for i in range(300):
        text = prose(i, 90, 3000)
        junk = [None, " ".join(w + "***" for w in text.split()), text.upper().replace(" ", "!! "), "for " * 80, text.replace(" ", " | ")]
        kind = i % 10 if i % 10 < 5 else 0
        docs.append((i, junk[kind] or text))
        labels.append((i, int(kind == 0)))
    held_out = learning.crc(F.col("doc_id")) % 5 == 0
    model = quality.fit(documents(docs), frame(spark, labels, "quality"), ~held_out)
    extra = [(900, None), (901, ""), (None, docs[0][1]), (902, "x " * 300_000)]
    got = quality.score(documents(docs + extra), model).collect()
    truth = dict(labels)
    right = [(r.score >= 0.3) == bool(truth[r.doc_id]) for r in got if r.doc_id in truth]
    assert len(got) == len(docs) + 4 and np.mean(right) > 0.97 and all(0 <= r.score <= 1 for r in got)
    assert quality.score(documents(docs).limit(0), model).count() == 0


def test_ranking_equals_a_plain_one():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 4))
    good = x @ [2.0, -1.0, 0.5, 0.0] + rng.normal(size=60) > 0.3
    model = quality.fit_pairs(x, good, pairs=25_000)
    # Plain: gradient descent on the mean logistic loss of every pair of a good and a bad row.
    spread = x.std(0) + 1e-6
    d = ((x[good][:, None] - x[~good][None]) / spread).reshape(-1, 4)
    w = np.zeros(4)
    for _ in range(20_000):
        w -= 0.3 * (quality.RIDGE * w - (d / (1 + np.exp(d @ w))[:, None]).mean(0))
    assert np.allclose(model.weights * spread, w, atol=0.2)
    scores = x @ model.weights
    assert model.cut == np.quantile(scores, (~good).mean())


def test_words_alone_tell_quality(spark, documents, prose):
    """Texts alike in shape, some with words that only bad ones have."""
    docs = [(i, prose(i, 60, 3000)) for i in range(300)]
    docs = [(i, " ".join("lorem" if i % 3 == 0 and k % 9 == 4 else w for k, w in enumerate(t.split()))) for i, t in docs]
    labels = [(i, int(i % 3 > 0)) for i, _ in docs]
    held_out = learning.crc(F.col("doc_id")) % 5 == 0
    model = quality.fit(documents(docs), frame(spark, labels, "quality"), ~held_out)
    got = {r.doc_id: r.score for r in quality.score(documents(docs), model).where(held_out).collect()}
    assert np.mean([(got[i] >= 0.3) == (i % 3 > 0) for i in got]) > 0.9


def test_features_do_not_depend_on_neighbours():
    texts = ["a a b\nc | d", "", "X!! Y!! z***", "one\ntwo\none\n", "é ü 123"]
    together = quality.features(pa.array([*texts, None], pa.string()))
    alone = np.concatenate([quality.features(pa.array([t], pa.string())) for t in [*texts, None]])
    assert np.allclose(together, alone)
    assert together[0][quality.FEATURES.index("again")] > 0 and together[3][quality.FEATURES.index("same_lines")] > 0


def test_quality_learns_from_every_label(spark, documents, prose, monkeypatch):
    """Small groups hold every labelled document, the rarer label several times."""
    docs = documents([(i, prose(i, 12, 3000) + " x" * (i % 7)) for i in range(150)])
    labels = frame(spark, [(i, int(i % 15 > 0)) for i in range(150)], "quality")
    rows = quality.labelled_features(docs, labels, F.lit(True))
    made = rows.toPandas()
    x, good = np.stack(made["features"]).astype(float), (made["label"] == 1).to_numpy()
    whole, plain = quality.fit(docs, labels, F.lit(True)), quality.fit_pairs(x, good)
    assert np.allclose(whole.weights, plain.weights, rtol=1e-3, atol=1e-3)
    assert np.isclose(whole.cut, plain.cut, rtol=1e-3) and np.isclose(whole.scale, plain.scale, rtol=1e-3)
    monkeypatch.setattr(quality, "GROUP", 20)
    monkeypatch.setattr(quality, "SIDE", 4)
    groups = quality.dealt(rows, 140, 10)
    firsts = groups.where("first")
    assert firsts.count() == 150 and firsts.select("features").exceptAll(rows.select("features")).count() == 0
    assert {r.copies for r in groups.where("label = 0").groupBy("features").agg(F.count("*").alias("copies")).collect()} == {4}
    spread, w = quality._spread(groups), np.linspace(-1, 1, x.shape[1])
    slope, curve, n = quality._group_sums(groups, spread, w)
    parts = [g for _, g in groups.toPandas().groupby("grp")]
    want = [quality.pair_sums(*(np.stack(g[g["label"] == k]["features"]).astype(float) / spread for k in (1, 0)), w) for g in parts if g["label"].nunique() == 2]
    assert np.allclose(slope, sum(s for s, _ in want)) and np.allclose(curve, sum(c for _, c in want)) and n > 0


def test_quantiles_are_exact(spark, monkeypatch):
    monkeypatch.setattr(quality, "FEW", 3)
    monkeypatch.setattr(quality, "CELLS", 4)
    rng = np.random.default_rng(3)
    for values in (rng.normal(size=200), np.repeat([1.0, 2.0, 5.0], 30), np.array([4.0]), np.r_[rng.normal(size=50), 1e9]):
        ranks = spark.createDataFrame([(float(v),) for v in values], "rank DOUBLE")
        for share in (0.0, 0.31, 0.9):
            assert np.isclose(quality.quantile(ranks, "rank", share), np.quantile(values, share))
