"""Hot keys: same rows as a plain join, and no task that holds the hot key alone."""

import random

from pyspark.sql import functions as F

from postloom.operators.dedup import already_seen, first_seen, unseen
from postloom.operators.gaps import connection_gaps, failure_runs
from postloom.operators.intervals import gap_backfill
from postloom.operators.skew import hot_keys, spread_join


def posts(spark, n=6000):
    # A third of all rows has one id.
    key = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 500)
    return spark.range(n).select(key.cast("string").alias("k"), F.col("id").alias("n"))


def test_spread_join_equals_plain_join(spark):
    rows = posts(spark)
    lookup = spark.range(0, 400).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("left", "inner", "left_semi", "left_anti"):
        got = sorted(map(tuple, spread_join(rows, lookup, ["k"], ["n"], how, task_rows=100).select("n").collect()))
        want = sorted(map(tuple, rows.join(lookup, "k", how).select("n").collect()))
        assert got == want, how
    # The key with a third of all rows gets the tasks that its count asks for.
    hot = {r.k: r._salts for r in hot_keys(rows, ["k"], 100).collect()}
    assert hot == {"7": -(-rows.where("k = '7'").count() // 100)}
    salted = rows.withColumn("s", F.pmod(F.xxhash64("n"), F.lit(hot["7"])))
    biggest = salted.groupBy("k", "s").count().agg(F.max("count")).head()[0]
    assert biggest < 200


def test_dedup_with_a_hot_id(spark):
    rows = posts(spark).withColumnRenamed("k", "id")
    seen = spark.createDataFrame([("7",), ("8",)], "id STRING")
    firsts = {r.id: r.n for r in first_seen(rows, ["n"]).collect()}
    assert firsts["7"] == 0 and len(firsts) == rows.select("id").distinct().count()
    assert unseen(rows, seen, ["n"]).where("id in ('7', '8')").count() == 0
    assert already_seen(rows, seen, ["n"]).count() == rows.where("id in ('7', '8')").count()


def sequential(log):
    gaps, runs, open_gap, fails = [], [], {}, {}
    for task, ts, event, reason in log:
        if event == "failed":
            open_gap.setdefault(task, (ts, reason))
            fails[task] = fails.get(task, 0) + 1
            runs.append((task, ts, fails[task]))
        elif event in ("connected", "stopped"):
            if task in open_gap:
                start, why = open_gap.pop(task)
                why = (reason if event == "stopped" else "") or why or "disconnected"
                gaps.append((task, start, ts, why))
        else:
            fails[task] = 0
    return sorted(gaps), sorted(runs)


def test_gaps_and_runs_match_a_sequential_model(spark):
    rng = random.Random(3)
    log = []
    for i in range(3000):
        task = "busy" if rng.random() < 0.4 else f"t{rng.randint(0, 9)}"
        event = rng.choice(["failed", "failed", "connected", "stopped", "activity", "other"])
        reason = rng.choice(["", "server_error", "rate_limited"]) if event in ("failed", "stopped") else ""
        log.append((task, i, event, reason))
    gaps, runs = sequential([(t, i, e if e != "other" else "connected_not", r) for t, i, e, r in log if e != "other"])
    df = spark.createDataFrame(log, "task_name STRING, i LONG, event STRING, reason STRING").withColumn(
        "ts", F.timestamp_add("SECOND", F.col("i"), F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    base = df.select("ts", "i").collect()
    index = {r.ts: r.i for r in base}
    got = [(r.task_name, index[r.start_time_utc], index[r.end_time_utc], r.reason) for r in connection_gaps(df).collect()]
    assert sorted(got) == gaps
    got = [(r.task_name, index[r.ts], r.consecutive_failures) for r in failure_runs(df).collect()]
    assert sorted(got) == runs


def test_backfill_against_brute_force(spark):
    at = lambda c: F.timestamp_add("SECOND", c, F.lit("2024-01-01").cast("timestamp_ntz"))
    rng = random.Random(5)
    spans = [(s, s + rng.randint(0, 9000)) for s in (rng.randint(0, 40000) for _ in range(25))]
    gaps = spark.createDataFrame(spans, "s LONG, e LONG").select(
        at(F.col("s")).alias("start_time_utc"), at(F.col("e")).alias("end_time_utc")
    )
    archive = spark.range(0, 45000, 7).select((F.col("id") % 3001).alias("id"), F.col("id").alias("n"), at(F.col("id")).alias("ts"))
    seen = spark.range(0, 3001, 5).toDF("id")
    got = {(r.id, r.n) for r in gap_backfill(archive, gaps, seen, ["n"]).collect()}
    want = {}
    for n in range(0, 45000, 7):
        if any(s <= n < e for s, e in spans) and (n % 3001) % 5:
            want.setdefault(n % 3001, n)
    assert got == set(want.items())
