import random

import pytest

DOC = "doc_id LONG, text STRING"


@pytest.fixture
def documents(spark):
    """Rows (doc_id, text) as a table with further columns that clash with inner names."""

    def make(rows):
        df = spark.createDataFrame(rows, DOC)
        return df.selectExpr(
            "doc_id", "text", "'x' AS lang", "1 AS label", "2 AS rank", "'k' AS key", "3 AS set_id", "4 AS doc", "5 AS _text",
            "'r' AS runs", "6 AS place", "7 AS length", "8 AS words",
        )

    return make


@pytest.fixture
def prose():
    """Made-up texts from a seed."""

    def make(seed, words, vocabulary=400):
        rng = random.Random(seed)
        return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))

    return make
