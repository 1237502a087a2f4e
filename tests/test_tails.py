import itertools

import pytest

from postloom.operators.tails import TailError, tail_filter

COLUMNS = (
    "n INT, text STRING, lang STRING, is_retweet BOOLEAN, is_reply BOOLEAN, is_quote BOOLEAN, author_username STRING,"
    " hashtags STRING, mention_usernames STRING, media_keys STRING, media_types STRING, urls STRING, expanded_urls STRING"
)
ROWS = [
    (0, "cats and dogs", "ja", False, False, False, "Ann", "One;two", "bob", "", "", "", ""),
    (1, "cats", "ja", False, True, False, "bob", None, "ann;cy", "m1", "photo", "t.co/x", "https://Example.org/a"),
    (2, "Dogs run", "en", True, False, True, None, "two", None, "m2;m3", "video;photo", None, None),
    (3, None, None, None, None, None, "cy", "", "", None, None, "u", "https://other.net"),
    (4, "catsand dogs", "EN", False, True, True, "ann", "twofold", "x", "", "", "", ""),
]


@pytest.mark.parametrize(
    ("tail", "want"),
    [
        (None, {0, 1, 2, 3, 4}),
        ("  ", {0, 1, 2, 3, 4}),
        ("lang:ja -is:reply", {0}),
        ("-lang:ja", {2, 3, 4}),
        ("lang:en OR lang:ja is:reply", {1, 2, 4}),
        ("(lang:en OR lang:ja) is:reply", {1, 4}),
        ("-(lang:en OR is:reply)", {0, 3}),
        ("--lang:en", {2, 4}),
        ("cats", {0, 1}),
        ('"cats and dogs" OR run', {0, 2}),
        ("dogs -cats", {2, 4}),
        ("#two", {0, 2}),
        ("@ANN OR from:@ann", {0, 1, 4}),
        ("to:ann", {1}),
        ("has:media -has:videos", {1}),
        ("has:images", {1, 2}),
        ("has:links has:mentions", {1}),
        ('url:"example.org"', {1}),
        ("is:quote is:retweet", {2}),
    ],
)
def test_tails(spark, tail, want):
    rows = spark.createDataFrame(ROWS, COLUMNS)
    assert {r.n for r in rows.where(tail_filter(tail)).collect()} == want


@pytest.mark.parametrize(
    "tail", ["is:nice", "has:hope", "near:here", "lang:", "(a", "a)", "a OR", "OR a", "-", "- OR a", "()", 'a "open', "a OR OR b"]
)
def test_faults(spark, tail):
    with pytest.raises(TailError):
        tail_filter(tail)


def test_only_named_columns_are_needed(spark):
    rows = spark.createDataFrame([(1, "a b"), (2, "b")], "n INT, text STRING")
    assert [r.n for r in rows.where(tail_filter("b -a")).collect()] == [2]


def test_every_order_of_and_means_the_same(spark):
    rows = spark.createDataFrame(ROWS, COLUMNS)
    for parts in itertools.permutations(["lang:ja", "-is:reply", '"cats and"']):
        assert {r.n for r in rows.where(tail_filter(" ".join(parts))).collect()} == {0}
