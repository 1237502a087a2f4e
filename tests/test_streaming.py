import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from postloom.operators import seen as seen_table
from postloom.operators.gaps import connection_gaps
from postloom.operators.seen import SeenTable
from postloom.operators.stats import progress_writes

from postloom.streaming.jobs import (
    collect_stream,
    convert_stream,
    dedup_stream_within,
    end_stream,
    flush_gaps,
    flush_held,
    gap_stream,
    heartbeats,
    idle_sessions,
    line_stream,
    open_ends,
    progress_stream,
    read_events,
    run_for,
    with_ends,
)

from helpers import include, page, tweet


def event(id, **extra):
    return json.dumps({"data": {"id": id, "text": "x"}, "includes": {"users": [{"id": "u" + id}]}, **extra})


def put(folder, name, lines, mtime):
    path = folder / name
    path.write_text("\n".join(lines))
    os.utime(path, (mtime, mtime))


def test_collect_in_batches_and_after_restart(spark, tmp_path):
    src, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    put(src, "a.jsonl", ["", event("1"), "data: " + event("1"), "not-json", event("2", errors=[])], 1_700_000_000)
    put(src, "b.jsonl", [event("2"), event("3"), event("2", errors=[{"title": "e"}])], 1_700_000_100)
    lines = line_stream(spark, str(src), "*.jsonl", max_files=1)
    collect_stream(lines, target, check).awaitTermination()
    put(src, "c.jsonl", [event("3"), event("4")], 1_700_000_200)
    collect_stream(line_stream(spark, str(src), "*.jsonl", max_files=1), target, check).awaitTermination()
    records = spark.read.parquet(f"{target}/records")
    assert sorted(r.id for r in spark.read.parquet(f"{target}/posts").collect()) == ["1", "2", "3", "4"]
    pages = records.where("kind = 'page'").select(F.get_json_object("data", "$.page").cast("int").alias("p")).collect()
    assert sorted(r.p for r in pages) == [1, 2, 3, 4]
    assert records.where("kind = 'include:users'").count() == 4
    outcomes = spark.read.parquet(f"{target}/outcomes").groupBy("outcome").agg(F.sum("lines").alias("n")).collect()
    assert {r.outcome: r.n for r in outcomes} == {"keepalive": 1, "tweet": 4, "ignored": 3, "invalid": 1, "errors": 1}


def test_gap_stays_open_over_batches(spark, tmp_path):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    ddl = "task_name STRING, ts TIMESTAMP_NTZ, event STRING, reason STRING"

    def feed(rows):
        df = spark.createDataFrame(rows, "task_name STRING, t STRING, event STRING, reason STRING")
        df.select("task_name", F.col("t").cast("timestamp_ntz").alias("ts"), "event", "reason").write.mode("append").parquet(src)
        gap_stream(spark.readStream.schema(ddl).parquet(src), target, check).awaitTermination()

    feed([("a", "2024-01-01 00:00:00", "failed", "server_error"), ("b", "2024-01-01 00:00:00", "connected", "")])
    feed([("a", "2024-01-01 00:01:00", "failed", "rate_limited")])
    feed([("a", "2024-01-01 00:02:00", "connected", ""), ("a", "2024-01-01 00:03:00", "failed", "")])
    gaps = spark.read.parquet(f"{target}/gaps").collect()
    assert [(g.task_name, g.start_time_utc.minute, g.end_time_utc.minute, g.reason) for g in gaps] == [
        ("a", 0, 2, "server_error")
    ]


def test_limit_stops_and_resumes_without_loss(spark, tmp_path):
    src, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    for k in range(3):
        put(src, f"{k}.jsonl", [event(str(3 * k + i)) for i in range(3)], 1_700_000_000 + k)
    lines = lambda: line_stream(spark, str(src), "*.jsonl", max_files=1)
    ids = lambda: sorted(r.id for r in spark.read.parquet(f"{target}/posts").collect())
    assert run_for(collect_stream(lines(), target, check, max_posts=4)) == "max_posts"
    assert ids() == list("0123")
    assert run_for(collect_stream(lines(), target, check, max_posts=4)) == "max_posts"
    assert ids() == list("0123")
    assert run_for(collect_stream(lines(), target, check)) == "completed"
    assert ids() == list("012345678")


def test_conversion_waits_for_markers_and_keeps_bad_lines(spark, tmp_path):
    src, target, check = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "check")
    src.mkdir()
    put(src, "b.jsonl", [tweet("1", author_id="7"), page(), tweet("2", author_id="8"), "no json"], 1_700_000_000)
    put(src, "a.jsonl", [include(id="8", username="eight"), page(), "{broken", tweet("3", author_id="8")], 1_700_000_100)
    convert_stream(line_stream(spark, str(src), "*.jsonl", max_files=1), target, check).awaitTermination()
    flat = spark.read.parquet(f"{target}/flat").select("tweet_id", "author_username").collect()
    assert sorted(map(tuple, flat), key=str) == [("1", None), ("2", "eight")]
    assert sorted(r.value for r in spark.read.parquet(f"{target}/quarantine").collect()) == ["no json", "{broken"]
    assert [r.tweet_id for r in flush_held(spark, target).collect()] == ["3"]


def feed_times(spark, src, rows):
    df = spark.createDataFrame(rows, "id STRING, t STRING").select("id", F.col("t").cast("timestamp").alias("ts"))
    df.coalesce(1).write.mode("append").parquet(src)


def run_append(stream, target, check):
    stream.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(target).awaitTermination()


def test_bounded_dedup_forgets_after_its_delay(spark, tmp_path):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    for rows in ([("a", "2024-01-01 00:00:00")], [("a", "2024-01-01 00:05:00"), ("b", "2024-01-01 03:00:00")], [("a", "2024-01-01 04:00:00")]):
        feed_times(spark, src, rows)
        stream = spark.readStream.schema("id STRING, ts TIMESTAMP").parquet(src)
        run_append(dedup_stream_within(stream, "ts", "1 hour"), target, check)
    got = spark.read.parquet(target).select("id", F.hour("ts").alias("h")).collect()
    assert sorted(map(tuple, got)) == [("a", 0), ("a", 4), ("b", 3)]


def test_session_state_expires(spark, tmp_path):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    left = []
    for h in range(4):
        feed_times(spark, src, [(f"u{h}{i}", f"2024-01-01 {2 * h:02}:00:0{i}") for i in range(3)])
        sessions = idle_sessions(spark.readStream.schema("id STRING, ts TIMESTAMP").parquet(src), "id", seconds=600)
        query = sessions.writeStream.format("parquet").option("checkpointLocation", check).trigger(availableNow=True).start(target)
        query.awaitTermination()
        left.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert spark.read.parquet(target).count() == 9 and max(left) <= 3


def test_gap_diagnostics_survive_batches(spark, tmp_path):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    ddl = "task_name STRING, ts TIMESTAMP_NTZ, event STRING, reason STRING, status INT"
    for t, kind, status in (("00:00:00", "failed", 503), ("00:01:00", "failed", 429), ("00:02:00", "connected", None)):
        df = spark.createDataFrame([("a", f"2024-01-01 {t}", kind, "", status)], "task_name STRING, t STRING, event STRING, reason STRING, status INT")
        df.select("task_name", F.col("t").cast("timestamp_ntz").alias("ts"), "event", "reason", "status").write.mode("append").parquet(src)
        gap_stream(spark.readStream.schema(ddl).parquet(src), target, check).awaitTermination()
    assert [r.status for r in spark.read.parquet(f"{target}/gaps").collect()] == [503]


def id_frame(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id STRING")


def test_seen_table_equals_a_set(spark, tmp_path, monkeypatch):
    for name, value in [("PARTS", 4), ("FAN", 2), ("BLOCK_IDS", 20)]:
        monkeypatch.setattr(seen_table, name, value)
    table, rng, held = SeenTable(spark, str(tmp_path / "seen")), random.Random(3), set()
    for batch in range(7):
        asked = {str(rng.randrange(300)) for _ in range(60)}
        hits = {r.id for r in table.hits(id_frame(spark, asked), batch).collect()}
        assert hits == asked & held and table.total(batch) == len(held)
        new = asked - held if batch != 3 else set()  # a batch may bring nothing
        table.add(id_frame(spark, new), batch)
        if batch == 4:  # the same batch once more
            table.add(id_frame(spark, new), batch)
        held |= new
    assert table.runs(7) == [(4, 0), (2, 4), (1, 6)] and table.total(7) == len(held)


def test_a_probe_opens_only_what_may_hold_its_ids(spark, tmp_path):
    table = SeenTable(spark, str(tmp_path / "seen"))
    for batch in range(3):
        table.add(id_frame(spark, [f"b{batch}-{i}" for i in range(3000)]), batch)
    found = table.hits(id_frame(spark, ["b1-7"]), 3)
    paths = {p.split("/ids/")[1].rsplit("/", 1)[0] for p in found.inputFiles() if "/ids/" in p}
    assert [r.id for r in found.collect()] == ["b1-7"] and len(paths) == 1 and paths.pop().startswith("level=1/start=1/part=")
    # Ids that nobody added are answered by the filters alone, but for a few.
    fresh = id_frame(spark, [f"new{i}" for i in range(20)])
    assert len(table.candidates(fresh, 3)) <= 3 and table.hits(fresh, 3).count() == 0


def test_bloom_filters_let_few_others_pass(spark, tmp_path):
    table = SeenTable(spark, str(tmp_path / "seen"))
    table.add(id_frame(spark, [f"a{i}" for i in range(64 * 3500)]), 0)  # more than one bitmap per part
    passed = sum(bool(table.candidates(id_frame(spark, [f"x{i}"]), 1)) for i in range(5))
    assert passed <= 2
    assert {r.id for r in table.hits(id_frame(spark, ["a0", "a223999", "a224000"]), 1).collect()} == {"a0", "a223999"}


def test_a_run_has_as_many_parts_as_its_ids_ask_for(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(seen_table, "PART_IDS", 100)
    table, held = SeenTable(spark, str(tmp_path / "seen")), set()
    for batch, n in enumerate((90, 350, 1)):
        fresh = {f"{batch}-{i}" for i in range(n)}
        table.add(id_frame(spark, fresh), batch)
        held |= fresh
    assert [len(table._parts((1, b))) for b in range(3)] == [1, 4, 1]  # not one folder per hash value
    assert {r.id for r in table.hits(id_frame(spark, held | {"x"}), 3).collect()} == held


def test_a_batch_of_one_file_is_parsed_by_all_cores(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    put(src, "a.jsonl", ["", "no json", '{"errors":[1]}', "{}"] + [event(str(i)) for i in range(20)], 1_700_000_000)
    batch = spark.read.text(str(src)).select("value", F.lit("a").alias("file"), F.lit(0).alias("start"), F.lit("t").alias("received_at"))
    rows = read_events(batch, 0).withColumn("task", F.spark_partition_id()).collect()
    assert len({r.task for r in rows}) > 1 and len({r.block for r in rows}) == 24
    told = [r.told for r in sorted(rows, key=lambda r: r.block)]
    assert told[:4] == ["keepalive", "invalid", "errors", "ignored"] and {r.value for r in rows} == {None, "no json"}


LOG_DDL = "task_name STRING, ts TIMESTAMP_NTZ, event_id BIGINT, event STRING, reason STRING"


def shuffled_log(seed, n=240, delay=300):
    """Rows of three tasks, and their order of arrival up to `delay` seconds late."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=20 * i + rng.randrange(20))
        rows.append((rng.choice("abc"), at, i, rng.choice(["failed", "failed", "connected", "stopped", "keepalive"]), rng.choice(["x", "y", ""])))
    arrival = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rng.randrange(delay)))
    return rows, arrival


@pytest.mark.parametrize("seed", [1, 2])
def test_gaps_of_late_rows(spark, tmp_path, seed):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    rows, arrival = shuffled_log(seed)
    assert arrival != rows
    for k in range(0, len(arrival), 80):
        spark.createDataFrame(arrival[k : k + 80], LOG_DDL).coalesce(1).write.mode("append").parquet(src)
        log = spark.readStream.schema(LOG_DDL).parquet(src)
        gap_stream(log, target, check, 300, ("event_id",)).awaitTermination()
    got = spark.read.parquet(f"{target}/gaps").drop("batch_id")
    assert got.count() > 0 and spark.read.parquet(f"{target}/late").count() == 0
    got = got.unionByName(flush_gaps(spark, target, log, ("event_id",)))
    batch = connection_gaps(spark.createDataFrame(rows, LOG_DDL), ("event_id",))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.select(*got.columns).collect()))


def test_a_row_behind_the_watermark_is_kept_apart(spark, tmp_path):
    src, target, check = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "check")
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    feeds = [[("a", at(0), 0, "failed", "r"), ("a", at(30), 1, "connected", "")], [("a", at(5), 2, "connected", ""), ("a", None, 3, "failed", "")], []]
    for rows in feeds:
        spark.createDataFrame(rows, LOG_DDL).coalesce(1).write.mode("append").parquet(src)
        log = spark.readStream.schema(LOG_DDL).parquet(src)
        gap_stream(log, target, check, 600, ("event_id",)).awaitTermination()
    assert [r.event_id for r in spark.read.parquet(f"{target}/late").collect()] == [2]
    assert [(r.start_time_utc, r.end_time_utc) for r in flush_gaps(spark, target, log, ("event_id",)).collect()] == [(at(0), at(30))]


def test_an_end_marker_closes_what_is_open(spark, tmp_path):
    src, ends, target, check = (str(tmp_path / n) for n in ("in", "ends", "out", "check"))
    feed_times(spark, src, [("u", "2024-01-01 00:00:00"), ("u", "2024-01-01 00:05:00"), ("v", "2024-01-01 00:06:00")])
    open_ends(spark, ends)

    def run():
        lines = with_ends(spark.readStream.schema("id STRING, ts TIMESTAMP").parquet(src), ends)
        run_append(idle_sessions(lines, "id", seconds=600), target, check)
        return sorted((r.id, r.lines) for r in spark.read.schema("id STRING, lines BIGINT").parquet(target).collect())

    assert run() == []
    end_stream(spark, ends, dt.datetime(2024, 1, 1, 0, 30))
    assert run() == [("u", 2), ("v", 1)]
    # The stream goes on behind its end.
    feed_times(spark, src, [("u", "2024-01-01 01:00:00")])
    end_stream(spark, ends, dt.datetime(2024, 1, 1, 2, 0))
    assert run() == [("u", 1), ("u", 2), ("v", 1)]


def test_an_end_marker_is_no_heartbeat(spark, tmp_path):
    src, ends, target, check = (str(tmp_path / n) for n in ("in", "ends", "out", "check"))
    feed_times(spark, src, [("u", "2024-01-01 00:00:10"), ("u", "2024-01-01 00:00:50"), (None, "2024-01-01 00:01:00")])
    open_ends(spark, ends)
    end_stream(spark, ends, dt.datetime(2024, 1, 1, 1, 0))
    lines = with_ends(spark.readStream.schema("id STRING, ts TIMESTAMP").parquet(src), ends)
    run_append(heartbeats(lines, event="id"), target, check)
    got = spark.read.parquet(target).select("id", F.minute("slot_start").alias("m"), "lines").collect()
    assert sorted(map(tuple, got), key=str) == [("u", 0, 2), (None, 1, 1)] or sorted(map(tuple, got), key=str) == [(None, 1, 1), ("u", 0, 2)]


LINES = "task_name STRING, ts TIMESTAMP_NTZ, event STRING, n INT"


def plain_writes(rows, seconds):
    """One line after another."""
    out, seen = {}, {}
    for task, ts, event, _ in sorted((r for r in rows if r[1]), key=lambda r: (r[1], r[3])):
        slot = int((ts - dt.datetime(1970, 1, 1)).total_seconds() // max(seconds, 1))
        forced, timed, _, wrote = out.get(task, (0, 0, None, None))
        if event in ("post", "failed", "stopped"):
            forced, wrote = forced + 1, ts
        elif seconds and seen.get(task) != slot:
            timed, wrote = timed + 1, ts
        seen[task] = slot
        out[task] = (forced, timed, ts, wrote)
    return out


def some_lines(seed, n):
    rng = random.Random(seed)
    start, kinds = dt.datetime(2024, 1, 1), ["keepalive"] * 6 + ["connected", "post", "failed", "stopped", None]
    rows = [(rng.choice(["a", "a", "b", None]), start + dt.timedelta(seconds=rng.randrange(900)), rng.choice(kinds), i) for i in range(n)]
    return sorted(rows, key=lambda r: (r[1], r[3]))


def writes_of(df):
    return {r.task_name: (r.forced, r.timed, r.last_line_at, r.last_write_at) for r in df.collect()}


@pytest.mark.parametrize("seconds", [0, 1, 30, 400])
def test_progress_is_written_when_forced_or_due(spark, seconds):
    rows = some_lines(seconds, 150) + [("c", None, "post", 1)]
    got = writes_of(progress_writes(spark.createDataFrame(rows, LINES), seconds, tie=("n",)))
    assert got == plain_writes(rows, seconds)
    assert progress_writes(spark.createDataFrame([], LINES), seconds).count() == 0


def test_published_progress_in_batches(spark, tmp_path):
    src, target, check, published = (str(tmp_path / n) for n in ("in", "out", "check", "published"))
    rows = some_lines(7, 90) + [("quiet", dt.datetime(2024, 1, 1, 0, 15, 1), "keepalive", 90), ("quiet", dt.datetime(2024, 1, 1, 0, 15, 2), "keepalive", 91)]
    cuts = [0, 40, 85, 91, 92]
    for n, (lo, hi) in enumerate(zip(cuts, cuts[1:])):
        spark.createDataFrame(rows[lo:hi], LINES).coalesce(1).write.mode("append").parquet(src)
        lines = spark.readStream.schema(LINES).parquet(src)
        progress_stream(lines, target, check, published, 60, ("n",)).awaitTermination()
        now = spark.read.parquet(f"{published}/writes").where(F.col("batch_id") == n)
        assert writes_of(now) == plain_writes(rows[:hi], 60)
        told = {r.task_name for r in spark.read.parquet(f"{published}/progress").where(F.col("batch_id") == n).collect()}
        was, is_ = plain_writes(rows[:lo], 60), plain_writes(rows[:hi], 60)
        assert told == {t for t in is_ if is_[t][:2] != was.get(t, (0, 0))[:2]}
    # The second line of a slot that began in the batch before writes nothing.
    assert told == set()


def test_conversion_writes_each_line_once(spark, tmp_path, monkeypatch):
    """The parsed lines are the only copy that a batch makes of its payloads."""
    from postloom.streaming import jobs

    made, write = {}, jobs.durable
    monkeypatch.setattr(jobs, "durable", lambda df, name: made.setdefault(name, write(df, name)))
    kept = []
    monkeypatch.setattr(jobs, "put", lambda df, path, batch_id: kept.append([r.asDict() for r in made["parsed"].collect()]))
    src = tmp_path / "in"
    src.mkdir()
    put(src, "a.jsonl", [tweet("1"), "not json", page()], 1_700_000_000)
    convert_stream(line_stream(spark, str(src), "*.jsonl"), str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
    assert list(made) == ["parsed"]
    assert [(r["value"], r["data"] is None) for r in kept[0] if r["is_bad"]] == [("not json", True)]
    assert all(r["value"] is None for r in kept[0] if not r["is_bad"])
