import datetime as dt
import random

from pyspark.sql import functions as F

from postloom.operators import intervals
from postloom.operators.intervals import gap_backfill, unit_after, unit_of, window_join, with_nodes

BEGIN = dt.datetime(2020, 1, 1)


def at(us):
    return BEGIN + dt.timedelta(microseconds=us)


def frame(spark, rows, ddl):
    return spark.createDataFrame(rows, ddl)


def cases(seed):
    """Times around the borders of units and far apart ones."""
    rng = random.Random(seed)
    unit = intervals.UNIT
    near = lambda: rng.randrange(40) * unit + rng.choice([0, 1, -1, rng.randrange(unit)])
    return rng, near


def test_windows_equal_a_nested_loop(spark):
    rng, near = cases(1)
    posts = [(i, at(near())) for i in range(120)] + [(500, None), (501, dt.datetime(1971, 1, 1)), (502, at(10**15))]
    windows = [(i, at(a), at(b)) for i, (a, b) in enumerate((near(), near()) for _ in range(25))]
    windows += [(100, None, at(5 * intervals.UNIT)), (101, at(3), at(3)), (102, dt.datetime(1970, 5, 1), at(10**15 + 1)), (103, at(9), None)]
    got = window_join(frame(spark, posts, "id INT, ts TIMESTAMP_NTZ"), frame(spark, windows, "w INT, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ"), ["id"])
    want = sorted((i, w) for i, t in posts for w, a, b in windows if t and b and (a is None or t >= a) and t < b)
    assert sorted((r.id, r.w) for r in got.collect()) == want and len(want) > 100
    none = window_join(frame(spark, posts, "id INT, ts TIMESTAMP_NTZ"), frame(spark, [], "w INT, start_time TIMESTAMP_NTZ, end_time TIMESTAMP_NTZ"), ["id"])
    assert none.count() == 0


def test_ten_years_are_few_nodes(spark):
    rng = random.Random(2)
    spans = [(i, at(rng.randrange(10**14)), dt.datetime(2031, 1, 1) + dt.timedelta(seconds=rng.randrange(10**6))) for i in range(50)]
    spans = frame(spark, spans, "w INT, a TIMESTAMP_NTZ, b TIMESTAMP_NTZ")
    nodes = with_nodes(spans, unit_of(F.col("a")), unit_after(F.col("b")))
    assert max(r["count"] for r in nodes.groupBy("w").count().collect()) < 50
    # The nodes of a window are its units, each once.
    width = F.expr("shiftleft(1L, level)")
    sums = nodes.groupBy("w").agg(F.sum(width).alias("n"), F.min(F.col("node") * width).alias("first"))
    want = spans.select("w", unit_of(F.col("a")).alias("first"), (unit_after(F.col("b")) - unit_of(F.col("a"))).alias("n"))
    assert sorted(sums.select("w", "first", "n").collect()) == sorted(want.select("w", "first", "n").collect())


def test_backfill_equals_a_nested_loop(spark):
    rng, near = cases(3)
    archive = [(str(i % 150), i, at(near())) for i in range(200)] + [("x", 900, None)]
    gaps = [(at(a), at(b)) for a, b in ((near(), near()) for _ in range(12))]
    gaps += [(at(5), at(9)), (at(5), at(intervals.UNIT)), (at(7), None), (at(4 * intervals.UNIT), at(6 * intervals.UNIT))]
    gaps = [(a, b) for a, b in gaps if b is None or b - a < dt.timedelta(seconds=500)]
    seen = {str(i) for i in range(0, 150, 7)}
    got = gap_backfill(
        frame(spark, archive, "id STRING, n INT, ts TIMESTAMP_NTZ"),
        frame(spark, gaps, "start_time_utc TIMESTAMP_NTZ, end_time_utc TIMESTAMP_NTZ"),
        frame(spark, [(s,) for s in seen], "id STRING"),
        ["n"],
    )
    want = {}
    for i, n, t in archive:
        if t and i not in seen and any(b and a <= t < b for a, b in gaps):
            want.setdefault(i, n)
    assert {r.id: r.n for r in got.collect()} == want and len(want) > 20


def test_backfill_asks_for_nodes_per_unit_and_not_per_post(spark, monkeypatch):
    asked, real = [], intervals.at_ancestors
    monkeypatch.setattr(intervals, "at_ancestors", lambda rows, *rest: asked.append(rows.count()) or real(rows, *rest))
    start = 3 * intervals.UNIT
    archive = frame(spark, [(str(i), i, at(start + i)) for i in range(300)], "id STRING, n INT, ts TIMESTAMP_NTZ")
    gaps = [(at(0), at(k * intervals.UNIT)) for k in (4, 5, 9, 40)]
    gaps = frame(spark, gaps, "start_time_utc TIMESTAMP_NTZ, end_time_utc TIMESTAMP_NTZ")
    got = gap_backfill(archive, gaps, frame(spark, [("7",)], "id STRING"), ["n"])
    assert got.count() == 299 and asked == [1]
