import random

import pytest

from plain import jaccard_classes
from postloom.llm import neardup
from postloom.llm.graph import components


def mixed(prose, n=60):
    rng, rows = random.Random(9), []
    for i in range(n):
        words = prose(i // 6, 120).split()
        for _ in range(rng.randrange(0, 7) if i % 6 else 0):
            words[rng.randrange(len(words))] = f"z{rng.randrange(1000)}"
        rows.append((i, "  ".join(words) if i % 2 else "\n".join(words)))
    passage = prose(999, 60)
    rows += [(200 + i, f"{passage} {prose(500 + i, 90)}") for i in range(10)]
    rows += [(300, "one two"), (301, "one two"), (302, "Two one"), (303, "a b c d e"), (304, "a b c d e"), (305, prose(3, 4000)), (306, prose(3, 4000) + " x")]
    return rows


@pytest.mark.parametrize("block", [256, 4])
def test_classes_equal_brute_force(documents, prose, monkeypatch, block):
    monkeypatch.setattr(neardup, "SKETCH_BLOCK", block)
    monkeypatch.setattr(neardup, "SET_BLOCK", block)
    rows = mixed(prose)
    got = [tuple(r) for r in neardup.classes(documents(rows)).collect()]
    assert sorted(got) == sorted(jaccard_classes(rows))


def test_nulls_repeats_and_empty(documents, prose):
    rows = [(1, None), (2, ""), (3, " \t"), (None, None), (4, prose(1, 30)), (4, prose(1, 30)), (None, prose(1, 30)), (5, prose(1, 30))]
    got = sorted((tuple(r) for r in neardup.classes(documents(rows)).collect()), key=str)
    assert got == sorted([(1, 1, 0), (2, 2, 0), (3, 3, 0), (None, None, 0), (4, 4, 3), (4, 4, 3), (None, 4, 3), (5, 4, 3)], key=str)
    assert neardup.classes(documents(rows).limit(0)).count() == 0


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 5), (200, 201), (300, 300), (None, 3)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    assert got == {**{i: 0 for i in [*range(41), 100]}, 200: 200, 201: 200}


def test_pruning_keeps_what_can_reach_the_threshold():
    least = neardup.least_matches()
    assert len(least) == neardup.HASHES // neardup.STEP and least == sorted(least)
    assert least[-1] < 0.8 * neardup.HASHES
