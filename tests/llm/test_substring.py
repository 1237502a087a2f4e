import random
import sys

import numpy as np
import pyarrow as pa
import pytest

from plain import WORD, cut
from postloom.llm import substring


def test_cover():
    for shift in range(substring.PERIOD):
        assert any((c + shift) % substring.PERIOD in substring.COVER for c in substring.COVER)


def rows_of(prose):
    rng, rows = random.Random(2), []
    passages = [prose(7000 + i, n, 40) for i, n in enumerate([50, 51, 49, 80, 200])]
    for i in range(60):
        parts = [prose(i, rng.randrange(0, 90))]
        for _ in range(rng.randrange(0, 3)):
            parts += [rng.choice(passages), prose(1000 + i, rng.randrange(0, 40))]
        rows.append((rng.randrange(10**6), " ".join(parts)))
    rows += [(10**6 + i, rows[0][1]) for i in range(5)]
    rows += [(7, "the " * 300), (8, "the " * 120), (9, "the " * 49), (10, ""), (11, None), (12, passages[0] + "\n" + passages[0])]
    return rows


@pytest.mark.parametrize("buffer", [2_000_000, 300])
def test_equals_brute_force(documents, prose, monkeypatch, buffer):
    monkeypatch.setattr(substring, "BUFFER", buffer)
    rows = rows_of(prose)
    got = substring.dedup(documents(rows)).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(cut(rows))


def test_nulls_repeats_and_other_columns(documents, prose):
    long = prose(1, 60)
    rows = [(None, long), (3, long), (3, long), (3, long + " x"), (5, long), (1, "short  text")]
    docs = documents(rows)
    got = substring.dedup(docs, ["lang", "key", "runs", "place"], verbatim=True)
    assert sorted(((r.doc_id, r.n_removed, r.kept, r.rest.key) for r in got.collect()), key=str) == sorted(
        [(None, 0, long, "k"), (3, 0, long, "k"), (3, 0, long, "k"), (3, 0, long + " x", "k"), (5, 60, "", "k"), (1, 0, "short  text", "k")], key=str
    )
    assert substring.dedup(docs.limit(0)).count() == 0


def test_rows_of_finds_cost_no_calls():
    texts = substring.Texts(pa.array(["a b\tc " * 100, None, "", "d " * 200]))

    def marked(pieces):
        found = [[np.array([[i % 90, i % 90 + 1]], np.int32).tobytes() for i in range(pieces)], None, None, [np.array([[7, 190]], np.int32).tobytes()]]
        lists, calls = pa.array(found, pa.list_(pa.binary())), 0

        def count(frame, event, arg):
            nonlocal calls
            calls += event in ("call", "c_call")

        sys.setprofile(count)
        try:
            marks = texts.marked(lists, 20)
        finally:
            sys.setprofile(None)
        return calls, np.flatnonzero(marks).tolist()

    few, many = marked(2), marked(2000)
    assert few[1] == [*range(22), *range(307, 500)]
    assert many[1] == [*range(110), *range(307, 500)]
    assert many[0] < few[0] + 20


def test_words_left():
    rng = random.Random(5)
    rows = ["".join(rng.choice(["ä", "日本", "x", " ", "\t", "\r\n", "\u00a0"]) for _ in range(rng.randrange(40))) for _ in range(200)] + [None, "", " \n"]
    texts = substring.Texts(pa.array(rows))
    away = np.array([rng.random() < 0.4 for _ in texts.starts], bool)
    whole = np.array([rng.random() < 0.3 for _ in rows])
    marks, expected = iter(away.tolist()), []
    for row, as_is in zip(rows, whole):
        kept = [w for w in WORD.findall(row or "") if not next(marks)]
        expected.append((row or "") if as_is else " ".join(kept))
    assert texts.left(away, whole).to_pylist() == expected


def test_packed_rows_come_back():
    rng = np.random.default_rng(1)
    counts = np.array([3, 0, 1, 500])
    rows = {c: rng.integers(-(2**31), 2**31, 504).astype(substring._ITEM[c]) for c in substring._ITEM.names}
    packed = substring.pack(rows, substring._ITEM, counts)
    assert [len(v) for v in packed.to_pylist()] == [28 * n for n in counts]
    back = substring.unpack(packed.to_pylist(), substring._ITEM)
    assert all((back[c] == rows[c]).all() and back[c].dtype == rows[c].dtype for c in rows)


def test_one_id_on_two_texts_in_two_tasks(documents, prose):
    long = prose(3, 50)
    rows = [(5, long.rsplit(" ", 1)[0] + " other"), (9, long), (5, long)]
    docs = documents(rows[:2]).coalesce(1).union(documents(rows[2:]))
    got = substring.dedup(docs).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, got)) == sorted(cut(rows))
