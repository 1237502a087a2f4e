"""Outages, failures, progress and streaming jobs over the event log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.clock import plus_seconds
from ..operators.gaps import (
    connection_gaps,
    failure_rollup,
    failure_runs,
    gap_lines,
    idle_gaps,
    read_timeout,
    reconnect_decision,
)
from ..operators.intervals import gap_backfill
from ..operators.stats import latest_progress, progress_writes
from ..runtime import delete, scratch_path
from ..sources.envelope import write_envelope
from ..streaming.jobs import (
    collect_stream,
    convert_stream,
    dedup_stream,
    dedup_stream_within,
    end_stream,
    flush_gaps,
    gap_stream,
    heartbeats,
    idle_sessions,
    line_stream,
    open_ends,
    progress_stream,
    run_for,
    with_ends,
)
from .catalog_flat import FLAT_SQL
from .catalog_log import LINES_SQL
from .registry import query
from .views import EVENT_POST_SQL, connection_log, event_lines, event_post, order_log, table, text

TIE = ("event_id",)


@query(
    "idle_gaps",
    """
SELECT * FROM (
  SELECT 'all' AS stream, lag(ts) OVER (ORDER BY ts) AS start_time_utc, ts AS end_time_utc, 'idle_timeout' AS reason FROM events)
WHERE epoch_us(end_time_utc) - epoch_us(start_time_utc) > 120000000
""",
)
def silent_stream(spark: SparkSession, sf: str) -> DataFrame:
    """W6 with all events as one busy stream."""
    return idle_gaps(table(spark, sf, "events").withColumn("stream", F.lit("all")), "stream", "ts", read_timeout(0))


@query(
    "idle_gaps_per_user",
    """
SELECT * FROM (
  SELECT user_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts) AS start_time_utc, ts AS end_time_utc,
         'idle_timeout' AS reason FROM events)
WHERE epoch_us(end_time_utc) - epoch_us(start_time_utc) > 3600000000
""",
)
def silent_users(spark: SparkSession, sf: str) -> DataFrame:
    """W6 per user with an explicit read timeout."""
    return idle_gaps(table(spark, sf, "events"), "user_id", "ts", read_timeout(3600))


LOG_SQL = """
WITH log AS (
  SELECT CAST(user_id AS VARCHAR) AS task_name, ts, event_id,
    CASE WHEN event_type = 'error' THEN 'failed' WHEN event_type = 'signup' THEN 'connected'
         WHEN event_type = 'purchase' AND event_id % 10 = 0 THEN 'stopped' WHEN event_type = 'view' THEN 'keepalive'
         ELSE 'post' END AS event,
    CASE event_type WHEN 'error' THEN CASE event_id % 3 WHEN 0 THEN 'server_error' WHEN 1 THEN 'rate_limited' ELSE '' END
         WHEN 'purchase' THEN CASE WHEN event_id % 20 = 0 THEN 'max_posts' ELSE '' END END AS reason
  FROM events)
"""
GAP_SQL = LOG_SQL + """
, c AS (
  SELECT *, coalesce(sum(CASE WHEN event <> 'failed' THEN 1 ELSE 0 END) OVER (PARTITION BY task_name ORDER BY ts, event_id
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS island
  FROM log WHERE event IN ('failed', 'connected', 'stopped')),
g AS (
  SELECT task_name, island, min(CASE WHEN event = 'failed' THEN ts END) AS start_time_utc,
    arg_min(reason, ts) FILTER (event = 'failed') AS own,
    min(CASE WHEN event <> 'failed' THEN ts END) AS end_time_utc,
    min(CASE WHEN event = 'stopped' THEN reason END) AS stop
  FROM c GROUP BY ALL),
gaps AS (
  SELECT task_name, start_time_utc, end_time_utc, coalesce(nullif(stop, ''), nullif(own, ''), 'disconnected') AS reason
  FROM g WHERE start_time_utc IS NOT NULL AND end_time_utc IS NOT NULL)
"""


@query("conn_gaps", GAP_SQL + "SELECT * FROM gaps")
def outage_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """W7"""
    return connection_gaps(connection_log(spark, sf), TIE)


@query(
    "gap_rollup",
    GAP_SQL
    + """
SELECT task_name, reason, count(*) AS gaps,
  CAST(sum((epoch_us(end_time_utc) - epoch_us(start_time_utc)) // 1000000) AS BIGINT) AS gap_seconds, max(end_time_utc) AS last_end
FROM gaps GROUP BY ALL
""",
)
def gap_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """A8"""
    return failure_rollup(connection_gaps(connection_log(spark, sf), TIE))


@query(
    "gap_records",
    GAP_SQL
    + """
SELECT '{"task_name":"' || task_name || '","start_time_utc":"' || strftime(start_time_utc, '%Y-%m-%dT%H:%M:%SZ') ||
  '","end_time_utc":"' || strftime(end_time_utc, '%Y-%m-%dT%H:%M:%SZ') || '","reason":"' || reason ||
  '","recorded_at":"2024-02-01T00:00:00Z"' ||
  CASE WHEN length(task_name) > 1 THEN ',"error_detail":"d' || task_name || '"' ELSE '' END ||
  CASE WHEN reason = 'rate_limited' THEN ',"status":429,"rate_limit_remaining":0' ELSE '' END || '}' AS value
FROM gaps
""",
)
def gap_records(spark: SparkSession, sf: str) -> DataFrame:
    """S9"""
    gaps = connection_gaps(connection_log(spark, sf), TIE).withColumns(
        {
            "error_type": F.lit(""),
            "error_detail": F.when(F.length("task_name") > 1, F.concat(F.lit("d"), "task_name")).otherwise(""),
            "status": F.when(F.col("reason") == "rate_limited", 429).otherwise(0),
            **{c: F.lit(0) for c in ("rate_limit_limit", "rate_limit_remaining", "rate_limit_reset", "retry_after")},
        }
    )
    return gap_lines(gaps, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))


@query(
    "gap_backfill",
    GAP_SQL.replace("CAST(user_id AS VARCHAR) AS task_name", "CAST(user_id // 50 AS VARCHAR) AS task_name")
    + f"""
, hit AS (
  SELECT {EVENT_POST_SQL} AS id, event_id, ts FROM events e WHERE EXISTS (
    SELECT 1 FROM gaps WHERE e.ts >= start_time_utc AND e.ts < end_time_utc)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY event_id) AS rn FROM hit)
SELECT id, event_id, ts FROM ranked WHERE rn = 1 AND id NOT IN (SELECT event_id FROM events WHERE event_type = 'click')
""",
)
def backfill(spark: SparkSession, sf: str) -> DataFrame:
    """The archive is the event table, the seen set holds the clicks."""
    log = connection_log(spark, sf).withColumn(
        "task_name", text(F.floor(F.col("task_name").cast("bigint") / 50))
    )
    gaps = connection_gaps(log, TIE)
    events = table(spark, sf, "events")
    archive = events.select(event_post(F.col("event_id")).alias("id"), "event_id", "ts")
    seen = events.where("event_type = 'click'").select(F.col("event_id").alias("id"))
    return gap_backfill(archive, gaps, seen, ["event_id"])


RUN_SQL = LOG_SQL + """
, r AS (
  SELECT task_name, ts, event_id, coalesce(reason, '') AS reason, CASE WHEN event = 'failed' THEN 1 ELSE 0 END AS fail
  FROM log WHERE event IN ('failed', 'connected', 'post')),
i AS (SELECT *, sum(1 - fail) OVER (PARTITION BY task_name ORDER BY ts, event_id) AS island FROM r),
runs AS (
  SELECT task_name, ts, event_id, reason, fail,
    CAST(sum(fail) OVER (PARTITION BY task_name, island ORDER BY ts, event_id) AS BIGINT) AS consecutive_failures FROM i)
"""


def failures(spark: SparkSession, sf: str) -> DataFrame:
    log = connection_log(spark, sf).withColumn(
        "event", F.when(F.col("event").isin("connected", "post"), "activity").otherwise(F.col("event"))
    )
    return failure_runs(log, TIE)


@query("failures", RUN_SQL + "SELECT task_name, ts, event_id, reason, consecutive_failures FROM runs WHERE fail = 1")
def failure_counts(spark: SparkSession, sf: str) -> DataFrame:
    """W8"""
    return failures(spark, sf)


@query(
    "reconnect_budget",
    RUN_SQL
    + """
SELECT task_name, event_id, consecutive_failures <= 2 AS should_reconnect,
  CASE WHEN consecutive_failures <= 2 THEN '' ELSE 'max_reconnects_exceeded' END AS stop_reason
FROM runs WHERE fail = 1
""",
)
def reconnect_budget(spark: SparkSession, sf: str) -> DataFrame:
    """W9"""
    return reconnect_decision(failures(spark, sf), max_reconnects=2).select(
        "task_name", "event_id", "should_reconnect", "stop_reason"
    )


PROGRESS_SQL = LOG_SQL + """
SELECT task_name, max(CASE WHEN event = 'keepalive' THEN ts END) AS last_heartbeat_at,
  max(CASE WHEN event = 'post' THEN ts END) AS last_event_at,
  max(CASE WHEN event = 'connected' THEN ts END) AS last_connected_at,
  max(CASE WHEN event = 'failed' THEN ts END) AS last_disconnect_at,
  count(*) FILTER (event = 'keepalive') AS keepalive_count, count(*) FILTER (event = 'connected') AS connection_count
  {more} FROM log GROUP BY task_name
"""


@query("progress_latest", PROGRESS_SQL.replace("{more}", ", arg_max(event, event_id) AS last_event"))
def progress(spark: SparkSession, sf: str) -> DataFrame:
    """A6"""
    return latest_progress(connection_log(spark, sf), tie=TIE)


WRITE_SECONDS = 3600
WRITES_SQL = LOG_SQL + f"""
, slots AS (
  SELECT task_name, count(*) FILTER (event IN ('post', 'failed', 'stopped')) AS forced,
    max(CASE WHEN event IN ('post', 'failed', 'stopped') THEN ts END) AS forced_at, min(ts) AS first_at, max(ts) AS last_at,
    first(event ORDER BY ts, event_id) NOT IN ('post', 'failed', 'stopped') AS due
  FROM log GROUP BY task_name, floor(epoch_us(ts) / {WRITE_SECONDS * 1_000_000}))
SELECT task_name, CAST(sum(forced) AS BIGINT) AS forced, count(*) FILTER (due) AS timed, max(last_at) AS last_line_at,
  max(greatest(forced_at, CASE WHEN due THEN first_at END)) AS last_write_at
FROM slots GROUP BY task_name
"""


@query("progress_writes", WRITES_SQL)
def writes(spark: SparkSession, sf: str) -> DataFrame:
    """T10 over a whole log."""
    return progress_writes(connection_log(spark, sf), WRITE_SECONDS, tie=TIE).drop("written")


# Streaming. Each query runs its job until the source is read and returns what it wrote.

EVENT_DDL = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    return spark.readStream.schema(EVENT_DDL).option("pathGlobFilter", "events.parquet").parquet(sf)


def folders(spark: SparkSession, name: str) -> tuple[str, str]:
    return scratch_path(spark, name), scratch_path(spark, f"{name}_checkpoint")


def append_all(stream: DataFrame, target: str, checkpoint: str) -> None:
    writer = stream.writeStream.format("parquet").option("checkpointLocation", checkpoint).option("path", target)
    writer.trigger(availableNow=True).start().awaitTermination()


def to_the_end(
    spark: SparkSession, sf: str, lines: DataFrame, job: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> None:
    """Run a job over the events, then once more after an end marker behind the last of them."""
    ends = scratch_path(spark, "ends")
    open_ends(spark, ends)
    stream = job(with_ends(lines, ends))
    append_all(stream, target, checkpoint)
    last = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts")).head()[0]
    if last is not None:
        end_stream(spark, ends, last + dt.timedelta(days=1))
        append_all(stream, target, checkpoint)


@query("stream_dedup", f"SELECT DISTINCT CAST({EVENT_POST_SQL} AS VARCHAR) AS id FROM events")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """T3 on the state store."""
    target, checkpoint = folders(spark, "stream_dedup")
    ids = event_stream(spark, sf).select(text(event_post(F.col("event_id"))).alias("id"))
    append_all(dedup_stream(ids), target, checkpoint)
    return spark.read.schema("id STRING").parquet(target)


@query("stream_dedup_bounded", f"SELECT DISTINCT CAST({EVENT_POST_SQL} AS VARCHAR) AS id FROM events")
def stream_dedup_bounded(spark: SparkSession, sf: str) -> DataFrame:
    """T4: a delay longer than the data keeps the exact result."""
    target, checkpoint = folders(spark, "stream_dedup_bounded")
    ids = event_stream(spark, sf).select(text(event_post(F.col("event_id"))).alias("id"), F.col("ts").cast("timestamp").alias("ts"))
    append_all(dedup_stream_within(ids, "ts", "60 days").select("id"), target, checkpoint)
    return spark.read.schema("id STRING").parquet(target)


@query(
    "stream_sessions",
    """
WITH m AS (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) < 3600000000
                     THEN 0 ELSE 1 END AS opens FROM events),
s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts) AS n FROM m)
SELECT user_id, min(ts) AS first_ts, max(ts) AS last_ts, count(*) AS lines FROM s GROUP BY user_id, n
""",
)
def stream_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """All sessions; those open when the events end are closed by an end marker."""
    target, checkpoint = folders(spark, "stream_sessions")
    events = event_stream(spark, sf).select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    to_the_end(spark, sf, events, lambda lines: idle_sessions(lines, "user_id", seconds=3600), target, checkpoint)
    ntz = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_ts", "last_ts")]
    return spark.read.schema("user_id BIGINT, first_ts TIMESTAMP, last_ts TIMESTAMP, lines BIGINT").parquet(target).select(
        "user_id", *ntz, "lines"
    )


@query(
    "stream_heartbeat",
    """
SELECT date_trunc('minute', ts) AS slot_start, event_type AS event, count(*) AS lines FROM events GROUP BY 1, 2
""",
)
def stream_heartbeat(spark: SparkSession, sf: str) -> DataFrame:
    """All slots; those open when the events end are closed by an end marker."""
    target, checkpoint = folders(spark, "stream_heartbeat")
    events = event_stream(spark, sf).select(F.col("ts").cast("timestamp").alias("ts"), F.col("event_type").alias("event"))
    to_the_end(spark, sf, events, heartbeats, target, checkpoint)
    read = spark.read.schema("slot_start TIMESTAMP, event STRING, lines BIGINT").parquet(target)
    return read.withColumn("slot_start", F.col("slot_start").cast("timestamp_ntz"))


def slices(rows: DataFrame) -> int:
    """Files that a stream reads: four, and more for large tables."""
    return max(4, rows.count() // 50_000)


def connection_files(spark: SparkSession, sf: str) -> str:
    """The connection log in time slices, one file each, as it would arrive."""
    path = scratch_path(spark, "connection_files")
    log = connection_log(spark, sf)
    log.repartitionByRange(slices(log), "ts").write.parquet(path)
    return path


def connection_stream(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    ddl = "task_name STRING, ts TIMESTAMP_NTZ, event_id BIGINT, event STRING, reason STRING"
    return spark.readStream.schema(ddl).option("maxFilesPerTrigger", max_files).parquet(path)


def arrive_in_order(spark: SparkSession, path: str) -> None:
    """Give the files of a folder times that follow their names, as a stream takes files by time."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    names = sorted(s.getPath().toString() for s in files.listStatus(at) if s.getPath().getName().startswith("part-"))
    for n, name in enumerate(names):
        files.setTimes(spark._jvm.org.apache.hadoop.fs.Path(name), 1_700_000_000_000 + 1000 * n, -1)


ARRIVAL_SECONDS = 600


@query("stream_gaps", GAP_SQL + "SELECT * FROM gaps")
def stream_gaps(spark: SparkSession, sf: str) -> DataFrame:
    """Rows that come up to ten minutes late, in four batches or more."""
    target, checkpoint = folders(spark, "stream_gaps")
    path = scratch_path(spark, "late_files")
    log = connection_log(spark, sf)
    arrival = plus_seconds(F.col("ts"), F.pmod(F.xxhash64("event_id"), F.lit(ARRIVAL_SECONDS)))
    log.repartitionByRange(slices(log), arrival).write.parquet(path)
    arrive_in_order(spark, path)
    stream = connection_stream(spark, path, max_files=max(1, slices(log) // 4))
    gap_stream(stream, target, checkpoint, ARRIVAL_SECONDS, TIE).awaitTermination()
    written = spark.read.parquet(f"{target}/gaps").drop("batch_id")
    return written.unionByName(flush_gaps(spark, target, stream, TIE))


@query("stream_progress", PROGRESS_SQL.replace("{more}", ""))
def stream_progress(spark: SparkSession, sf: str) -> DataFrame:
    """T10"""
    target, checkpoint = folders(spark, "stream_progress")
    progress_stream(connection_stream(spark, connection_files(spark, sf)), target, checkpoint).awaitTermination()
    written = spark.read.parquet(target)
    last = written.agg(F.max("batch_id")).scalar()
    return written.where(F.col("batch_id") == last).drop("batch_id")


@query("stream_progress_writes", WRITES_SQL)
def stream_progress_writes(spark: SparkSession, sf: str) -> DataFrame:
    """The same writes by a stream in several batches."""
    target, checkpoint = folders(spark, "stream_progress_writes")
    published = scratch_path(spark, "published")
    path = connection_files(spark, sf)
    arrive_in_order(spark, path)
    stream = connection_stream(spark, path, max_files=max(1, slices(connection_log(spark, sf)) // 4))
    progress_stream(stream, target, checkpoint, published, WRITE_SECONDS, TIE).awaitTermination()
    written = spark.read.parquet(f"{published}/writes")
    last = written.agg(F.max("batch_id")).scalar()
    return written.where(F.col("batch_id") == last).drop("batch_id", "written")


def line_files(spark: SparkSession, sf: str) -> str:
    """The event lines as text files in event order."""
    path = scratch_path(spark, "line_files")
    lines = event_lines(spark, sf)
    lines = lines.repartitionByRange(slices(lines), "block").sortWithinPartitions("block")
    lines.select("value").write.text(path)
    return path


@query(
    "stream_collect",
    LINES_SQL
    + """
SELECT 'tweet' AS kind, '{"id":"' || id || '","text":"' || t || '","author_id":"' || u || '"}' AS data FROM fresh
UNION ALL SELECT 'include:users', '{"id":"' || u || '"}' FROM fresh
UNION ALL SELECT 'page', CAST(total AS VARCHAR) FROM fresh
""",
)
def stream_collect(spark: SparkSession, sf: str) -> DataFrame:
    """Text lines to envelope records; the page record shows its running total."""
    target, checkpoint = folders(spark, "stream_collect")
    lines = line_stream(spark, line_files(spark, sf), "part-*")
    collect_stream(lines, target, checkpoint).awaitTermination()
    records = spark.read.parquet(f"{target}/records")
    shown = F.when(F.col("kind") == "page", F.get_json_object("data", "$.page")).otherwise(F.col("data"))
    return records.select("kind", shown.alias("data"))


@query(
    "stream_stop",
    LINES_SQL + "SELECT id FROM fresh WHERE total <= 700",
)
def stream_stop(spark: SparkSession, sf: str) -> DataFrame:
    """A stream run that stops at a number of posts."""
    target, checkpoint = folders(spark, "stream_stop")
    lines = line_stream(spark, line_files(spark, sf), "part-*")
    run_for(collect_stream(lines, target, checkpoint, max_posts=700))
    return spark.read.parquet(f"{target}/posts").select("id")


@query("stream_resume", LINES_SQL + "SELECT id FROM fresh")
def stream_resume(spark: SparkSession, sf: str) -> DataFrame:
    """A run that stops at a number of posts, then one without a limit: no post is lost."""
    target, checkpoint = folders(spark, "stream_resume")
    path = line_files(spark, sf)
    run_for(collect_stream(line_stream(spark, path, "part-*", max_files=1), target, checkpoint, max_posts=100))
    run_for(collect_stream(line_stream(spark, path, "part-*", max_files=1), target, checkpoint))
    return spark.read.parquet(f"{target}/posts").select("id")


@query("stream_convert", FLAT_SQL)
def stream_convert(spark: SparkSession, sf: str) -> DataFrame:
    """Closed log files to flat rows as a stream."""
    target, checkpoint = folders(spark, "stream_convert")
    path = scratch_path(spark, "closed_log")
    write_envelope(order_log(spark, sf), path, compress=True)
    convert_stream(line_stream(spark, path, "part-*"), target, checkpoint).awaitTermination()
    delete(spark, path)  # the result is read from the flat rows
    return spark.read.parquet(f"{target}/flat").drop("batch_id")
