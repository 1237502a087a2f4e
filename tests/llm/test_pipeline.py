from pathlib import Path

import corpus_pipeline
from plain import cut
from postloom.llm import queries
from postloom.runtime import shared_dir

COLUMNS = "doc_id LONG, text STRING, lang STRING, source STRING, n_chars LONG, label INT, rank STRING"


def test_stages_follow_each_other(spark, tmp_path, prose):
    names = ["toxicity", "quality classifier", "n-gram Jaccard join", "substring dedup", "best-fit packing"]
    assert [n for n, _ in corpus_pipeline.STAGES] == names
    docs, labels = [], []
    for i in range(200):
        text = prose(i, 70, 3000)
        if i % 5 == 0:
            text = " ".join(f"{w} vilewort" if k % 15 == 3 else w for k, w in enumerate(text.split()))
        if i % 5 == 1:
            text = " ".join(w + "***" for w in text.split())
        docs.append((i, text, "en", "s", len(text), 1, "r"))
        labels.append((i, int(i % 5 != 1), int(i % 5 == 0)))
    shared = prose(900, 55, 3000)
    docs += [(300, docs[2][1], "en", "s", 1, 1, "r"), (301, docs[3][1] + " x", "en", "s", 1, 1, "r")]
    docs += [(310 + k, prose(910 + k, 80, 3000) + " " + shared, "en", "s", 1, 1, "r") for k in range(3)]
    docs += [(400, None, None, None, None, None, None), (401, "", "en", "s", 0, 1, "r"), (402, docs[2][1], "en", "s", 1, 1, "r")]
    spark.createDataFrame(docs, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    df, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, df, str(tmp_path))
        if k < 4:
            assert out.schema.simpleString() == df.schema.simpleString()
        out.write.parquet(f"{tmp_path}/{k}")
        df = spark.read.parquet(f"{tmp_path}/{k}")
        seen.append({r.doc_id: r for r in df.collect()})
    toxic, bad = {i for i in range(0, 200, 5)}, {i for i in range(1, 200, 5)}
    assert not toxic & set(seen[0]) and bad <= set(seen[0])
    assert not bad & set(seen[1]) and set(range(200)) - toxic - bad <= set(seen[1])
    assert set(seen[1]) - set(seen[2]) == {300, 301, 402}
    want = {d: (removed, kept) for d, _, removed, kept in cut([(r.doc_id, r.text) for r in seen[2].values()])}
    assert sum(r > 0 for r, _ in want.values()) == 2
    for d, r in seen[3].items():
        removed, kept = want[d]
        assert r.text == (kept if removed else seen[2][d].text)
    assert set(seen[4]) == set(seen[3])
    scratch = lambda: {p.name for p in Path(shared_dir(spark)).glob("postloom/*/*")}
    before = scratch()
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == df.count()
    # Only what the last stage reads and writes is left.
    assert not (scratch() - before) & {"toxicity", "quality_classifier", "n-gram_Jaccard_join", "sample", "words", "sketches"}


def test_near_copies_go_by_id_and_text(spark, documents, prose):
    copied, own, twice = (prose(k, 120, 3000) for k in range(3))
    rows = [(1, copied), (5, own), (5, copied + " x"), (7, own + " y"), (9, twice), (9, twice + " z"), (9, None), (9, ""), (None, own)]
    docs = documents(rows + rows[:2])
    got = sorted(((r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()), key=str)
    nine = [t for d, t in got if d == 9 and t]
    assert len(nine) == 1 and nine[0] in (twice, twice + " z")
    assert got == sorted([(1, copied), (5, own), (9, nine[0]), (9, None), (9, ""), (None, own)], key=str)


def test_which_of_equal_documents_stays(spark, prose):
    rows = [(1, prose(1, 60), "en", s, n, 1, None) for s, n in [("b", 2), ("a", 7), ("a", 3), (None, 1)]]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = [r.n_chars for order in (docs, docs.orderBy("n_chars")) for r in corpus_pipeline.near_duplicates(spark, order, "").collect()]
    assert len(got) == 2 and len(set(got)) == 1


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
