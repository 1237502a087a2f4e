import random
import re
from collections import Counter
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from postloom.llm import common, tries

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id LONG, text STRING, source STRING"


def plain_mask(text, copy):
    w = WORD.findall(text)
    return {
        "A": len(w) < 50,
        "B": 100 * len(set(w)) < 65 * len(w),
        "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        "D": bool(re.search("[#$%&*|]", text)),
        "E": copy,
    }


def plain_audit(rows, labels):
    """{(part, order, step): numbers} by running every order over every part."""
    good = {d for d, q, _ in labels if q == 1} - {None}
    toxic = {d for d, _, t in labels if t == 1} - {None}
    rows = [(d, t or "", s or "") for d, t, s in rows]
    failed = [plain_mask(t, d is not None and any(e is not None and e < d and u == t for e, u, _ in rows)) for d, t, _ in rows]
    out, share = {}, Counter()
    for part in {s for _, _, s in rows}:
        mine = [(d, f) for (d, _, s), f in zip(rows, failed) if s == part]
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d, x in left if x[f]]
                left = [(d, x) for d, x in left if not x[f]]
                share[part, f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(x[f] for _, x in mine) - len(gone),
                    sum(x[f] and sum(x.values()) == 1 for _, x in mine), sum(d in good for d in gone), sum(d in toxic for d in gone),
                ]
    return {k: (*v, share[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def audited(spark, rows, labels):
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "1 AS mask", "'p' AS part", "2 AS salt", "3 AS bit", "4 AS hash", "5 AS quality")
    marks = spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").selectExpr("*", "1 AS n", "'x' AS source")
    found = tries.audit(docs, marks, tries.surface_fails(F.col("text")), "E")
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in found.collect()}


def mixed(prose):
    rng, rows = random.Random(3), []
    texts = [prose(i, rng.choice([10, 60, 200]), rng.choice([20, 4000])) for i in range(30)]
    texts += [t + " Z#" for t in texts[:8]] + ["", None, " \t", "ABC " * 60, "été " * 5, prose(1, 3000) + " |"]
    for i in range(150):
        rows.append((i, rng.choice(texts), rng.choice(["a", "a", "b", None, ""])))
    same = prose(77, 90, 5000)
    rows += [(1000 + i, same, "hot") for i in range(120)] + [(20, texts[3], "a"), (20, texts[3], "a"), (None, texts[3], "a"), (None, same, "hot")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 1100, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    return rows, labels


@pytest.mark.parametrize("small", [False, True])
def test_equals_every_order_run(spark, prose, monkeypatch, small):
    if small:  # long prefixes, salts and many tries
        for name, value in [("RANGE_BYTES", 300), ("HOT_ROWS", 7), ("TRIE_BYTES", 500), ("FIRST_PREFIX", 1)]:
            monkeypatch.setattr(tries, name, value)
    common.ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13" if small else "2000")
    rows, labels = mixed(prose)
    assert audited(spark, rows, labels) == plain_audit(rows, labels)


def test_empty_tables(spark):
    assert audited(spark, [], []) == {}
    got = audited(spark, [(1, None, None)], [])
    assert len(got) == 600 and got["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120) and got["", "BACDE", 1] == (1, 0, 0, 0, 0, 0, 0)


def test_ranges_follow_what_texts_share(spark, monkeypatch):
    monkeypatch.setattr(tries, "RANGE_BYTES", 1000)
    begin = "the same long beginning " * 20
    texts = [begin + str(i) for i in range(50)] + ["one text " * 40] * 900 + [f"{i} other" for i in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "text STRING")
    key, hot, size = tries.ranges(rows)
    got = rows.select("text", key.alias("key")).distinct().groupBy("key").agg(F.sum(F.length("text")).alias("n"), F.count("*").alias("texts"))
    assert all(r.n <= 1000 or r.texts == 1 for r in got.collect())
    assert [r.salts for r in hot.collect()] == [2] and size > 900 * 360


def test_trie():
    rng = random.Random(2)
    texts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 12))) for _ in range(400)] + [b"a" * 5000, b"a" * 4999 + b"b"]
    trie, seen = tries.Trie(), {}
    for t in texts:
        assert seen.setdefault(t, trie.insert(t)) == trie.insert(t)
    assert len(set(seen.values())) == len(seen) == len(trie.least)

    def labels(node):
        return sum(len(c.label) + labels(c) for c in node.below.values())

    assert labels(trie.root) < sum(map(len, seen))
