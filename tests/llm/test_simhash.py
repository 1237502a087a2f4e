import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from postloom.llm import common, simhash
from postloom.llm.common import table

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_fingerprint(text):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def plain_components(fps):
    """The smallest position that each position's links lead to."""
    fps = np.array(fps, np.uint64)
    label = np.arange(len(fps))
    while True:
        last = label.copy()
        for i, x in enumerate(fps):
            near = np.flatnonzero(np.bitwise_count(fps ^ x) <= 3)
            label[near] = np.minimum(label[near], label[i])
            label[i] = label[near].min()
        if (label == last).all():
            return label


def check(df, rows):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in df.collect()}
    fps = [plain_fingerprint(t) for _, t in rows]
    ids = [d for d, _ in rows]
    labels = plain_components(fps)
    least = {}
    for d, x in zip(ids, labels):
        least[x] = min(d, least.get(x, d))
    assert got == {d: (f"{f:016x}", least[x]) for d, f, x in zip(ids, fps, labels)}


def test_query_equals_brute_force(spark):
    docs = table(common.ship(spark), "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(simhash.clusters(docs), rows)


@pytest.mark.parametrize(("block", "few"), [(2048, 32), (4, 2)])
def test_links_equal_brute_force(spark, monkeypatch, block, few):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "FEW", few)
    monkeypatch.setattr(simhash, "ROWS", 50)
    rng = random.Random(5)
    fps = {0, 2**64 - 1}
    for base in [0, 2**64 - 1, *[rng.getrandbits(64) for _ in range(12)]]:
        for _ in range(25):  # chains and balls around a base, some of them just too far
            fps.add(base)
            base ^= sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 6)))
    fps = sorted(fps)
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp LONG")).collect()
    at, up = {f: i for i, f in enumerate(signed)}, list(range(len(fps)))
    for e in edges:
        assert bin(fps[at[e.a]] ^ fps[at[e.b]]).count("1") >= 1
        a, b = up[at[e.a]], up[at[e.b]]
        up = [min(a, b) if x in (a, b) else x for x in up]
    assert up == plain_components(fps).tolist()


def test_nulls_repeats_and_empty(documents):
    rows = [(7, None), (3, ""), (9, " \t\v"), (5, "One TWO"), (6, "one\ntwo"), (6, "one two"), (8, "ÄÖ x"), (None, "one two"), (None, "lone words here")]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.clusters(documents(rows)).collect()), key=str)
    two, other = f"{plain_fingerprint('one two'):016x}", f"{plain_fingerprint('lone words here'):016x}"
    zero = "0" * 16
    expected = [(7, zero, 3), (3, zero, 3), (9, zero, 3), (5, two, 5), (6, two, 5), (6, two, 5), (8, f"{plain_fingerprint('ÄÖ x'):016x}", 8)]
    assert got == sorted([*expected, (None, two, 5), (None, other, None)], key=str)
    assert simhash.clusters(documents(rows).limit(0)).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch, prose):
    monkeypatch.setattr(simhash, "CHUNK_BYTES", 64)
    for text in [prose(1, 900), "x" * 500, "x" * 500 + " yy", " " * 300 + "a b", "a " + "z" * 200 + "\tb " + "q" * 300, " " * 99]:
        assert simhash.fingerprints(pa.array([text]))[0] == plain_fingerprint(text)


def test_many_repeats_of_a_shingle():
    text = "a b c " * 700
    assert simhash.fingerprints(pa.array(["x", text, None, text + "d"]))[1] == plain_fingerprint(text)


def test_anchors_cover(spark):
    """One home per half; every anchor within two bits and no other."""
    rng = random.Random(1)
    fps = [0, -1, *[rng.getrandbits(63) for _ in range(20)]]
    rows = simhash.replicas(spark.createDataFrame([(f,) for f in fps], "fp LONG")).collect()
    for f in fps:
        for half in (0, 1):
            word = (f >> 32 * half) & 0xFFFFFFFF
            mine = [(r.anchor & 0xFFFFFFFF, r.home) for r in rows if r.fp == f and r.anchor >> 32 == half]
            apart = [bin(a ^ word).count("1") for a, _ in mine]
            assert len({a for a, _ in mine}) == len(mine) and max(apart) <= 2
            assert sum(h for _, h in mine) == 1 and all(d <= 1 for d, (_, h) in zip(apart, mine) if h)
            assert len(mine) in (2, 17)


def test_anchors_are_never_broadcast(spark, tmp_path):
    # 33 rows come of each fingerprint, which Spark's estimate from the small file leaves out.
    spark.sql("SELECT xxhash64(id) AS fp FROM range(1000)").write.parquet(str(tmp_path / "nodes"))
    plan = simhash.links(spark.read.parquet(str(tmp_path / "nodes")))._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
