"""Task planning: normalization, windows, resume decisions, states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clock import choose_endpoint
from ..operators.intervals import window_join
from ..operators.stats import cap_reached
from ..runtime import durable, scratch_path
from ..sources.state_table import StateTable
from ..sources.states import collector_states, stream_states
from .registry import query
from .tasks import normalize_search_tasks, normalize_stream_tasks, page_size
from .views import table, text
from .windows import resolve_windows, resume_decisions, reuse_stream_state, roll_forward, rolled_rows

AS_OF = "2024-02-01 00:00:00.5"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def search_tasks(spark: SparkSession, sf: str) -> DataFrame:
    """Customers as search tasks with varied settings."""
    c = F.col("c_custkey")
    day = F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (c % 40).cast("int")), "yyyy-MM-dd'T'06:00:00")
    return table(spark, sf, "customer").select(
        text(c).alias("task_name"),
        F.when(c % 29 == 0, F.array(F.lit(" "))).otherwise(F.array(F.col("c_mktsegment"))).alias("keywords"),
        F.lit("").alias("extra_query_tail"),
        (c % 2 == 0).alias("exclude_reposts"),
        F.when(c % 7 == 0, F.lit("2024-01-29T00:00:00")).otherwise("").alias("start_time"),
        F.when(c % 3 == 0, day).otherwise("").alias("end_time"),
        F.when(c % 2 == 0, "Asia/Tokyo").otherwise("UTC").alias("local_tz_name"),
        F.element_at(F.array(F.lit("auto"), F.lit("recent"), F.lit("all")), (c % 3 + 1).cast("int")).alias("search_mode"),
        (c % 5 > 0).alias("use_state_highwater_start"),
        F.lit(30).cast("bigint").alias("highwater_overlap_seconds"),
        F.when(c % 11 > 0, c % 300).alias("window_hours"),
        F.lit(45).cast("bigint").alias("now_lag_seconds"),
        (c % 4 * 10).alias("target_posts"),
        (c % 9 == 0).alias("force_resume_on_mismatch"),
        (c % 8 > 0).alias("skip_if_completed_same_window"),
    )


def search_states(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers and customers as saved states; only some tasks have one."""
    c = F.col("c_custkey")
    prev = F.date_format(F.date_add(F.lit("2024-01-05").cast("date"), (c % 26).cast("int")), "yyyy-MM-dd'T'12:00:00'Z'")
    # Every state whose account is in credit.
    return table(spark, sf, "customer").where("c_acctbal > 0").select(
        text(c).alias("task_name"),
        F.concat(
            F.lit("("), "c_mktsegment", F.lit(")"), F.when(c % 2 == 0, " -is:retweet").otherwise(""),
            F.when(c % 13 == 0, " old").otherwise(""),
        ).alias("query"),
        F.lit(None).cast("string").alias("start_time_utc"),
        F.when(c % 17 > 0, prev).alias("end_time_utc"),
        (c % 4 > 0).alias("completed"),
    )


TASK_SQL = f"""
WITH t AS (
  SELECT c_custkey AS c, CAST(c_custkey AS VARCHAR) AS task_name,
    CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE '(' || c_mktsegment || ')' ||
      CASE WHEN c_custkey % 2 = 0 THEN ' -is:retweet' ELSE '' END END AS query,
    CASE c_custkey % 3 WHEN 0 THEN 'auto' WHEN 1 THEN 'recent' ELSE 'all' END AS mode,
    CASE WHEN c_custkey % 2 = 0 THEN 9 ELSE 0 END AS shift,
    c_mktsegment, c_acctbal FROM customer),
s AS (
  SELECT c AS sc, '(' || c_mktsegment || ')' || CASE WHEN c % 2 = 0 THEN ' -is:retweet' ELSE '' END ||
      CASE WHEN c % 13 = 0 THEN ' old' ELSE '' END AS sq,
    CASE WHEN c % 17 > 0 THEN TIMESTAMP '2024-01-05 12:00:00' + to_days(CAST(c % 26 AS INTEGER)) END AS prev_end,
    c % 4 > 0 AS done FROM t WHERE c_acctbal > 0),
n AS (SELECT TIMESTAMP '{AS_OF}' AS now, TIMESTAMP '{AS_OF}' - to_seconds(45) AS lim, TIMESTAMP '{AS_OF}' - to_days(7) AS oldest),
a AS (
  SELECT t.*, s.*, n.*,
    CASE WHEN c % 3 = 0 THEN TIMESTAMP '2024-01-01 06:00:00' + to_days(CAST(c % 40 AS INTEGER)) - to_hours(shift) END AS asked,
    CASE WHEN c % 7 = 0 THEN TIMESTAMP '2024-01-29 00:00:00' - to_hours(shift) END AS st
  FROM t LEFT JOIN s ON sc = c CROSS JOIN n),
b AS (
  SELECT *, CASE WHEN asked IS NULL THEN date_trunc('second', lim) WHEN asked > lim THEN lim ELSE asked END AS e,
    CASE WHEN mode IN ('recent', 'all') THEN mode
         WHEN least(coalesce(asked, lim), lim) < oldest THEN 'all' ELSE 'recent' END AS endpoint FROM a),
d AS (
  SELECT *, coalesce(st,
      CASE WHEN c % 5 > 0 AND done AND sq = query AND prev_end - to_seconds(30) < e THEN prev_end - to_seconds(30) END,
      CASE WHEN c % 11 > 0 THEN date_trunc('second', e - to_hours(c % 300)) END) AS f0 FROM b),
w AS (SELECT *, CASE WHEN endpoint = 'recent' AND f0 < oldest THEN oldest ELSE f0 END AS f FROM d),
x AS (
  SELECT *, CASE WHEN query IS NULL THEN 'no valid keyword'
    WHEN endpoint = 'recent' AND e < oldest THEN 'end_time is older than the recent look-back'
    WHEN f >= e THEN 'start_time >= end_time' END AS error FROM w),
planned AS (
  SELECT *, CASE WHEN error IS NULL THEN strftime(date_trunc('second', f), '%Y-%m-%dT%H:%M:%SZ') END AS start_time_utc,
    CASE WHEN error IS NULL THEN strftime(date_trunc('second', e), '%Y-%m-%dT%H:%M:%SZ') END AS end_time_utc FROM x)
"""


def planned_tasks(spark: SparkSession, sf: str) -> DataFrame:
    return resolve_windows(search_tasks(spark, sf), search_states(spark, sf), as_of())


@query("time_windows", TASK_SQL + "SELECT task_name, query, endpoint, start_time_utc, end_time_utc, error FROM planned")
def time_windows(spark: SparkSession, sf: str) -> DataFrame:
    """X1, F12, F14, F23"""
    return planned_tasks(spark, sf).select("task_name", "query", "endpoint", "start_time_utc", "end_time_utc", "error")


def saved_runs(planned: DataFrame) -> DataFrame:
    """Saved states that often fit the planned windows."""
    c = F.col("task_name").cast("bigint")
    return planned.where("error is null").select(
        "task_name",
        F.when(c % 13 == 0, F.concat("query", F.lit(" old"))).otherwise(F.col("query")).alias("query"),
        F.when(c % 19 > 0, F.col("start_time_utc")).alias("start_time_utc"),
        "end_time_utc",
        F.when(c % 3 == 0, F.concat(F.lit("n"), "task_name")).alias("next_token"),
        (c % 5).alias("page_count"),
        (c % 50).alias("total_tweets"),
        (c % 60).alias("total_includes"),
        (c % 2 == 0).alias("completed"),
        F.when(c % 6 == 0, "target_posts").otherwise("").alias("stop_reason"),
        (c * 10).alias("converted_jsonl_offset"),
        F.lit("2024-01-01T00:00:00Z").alias("converted_at"),
    )


RESUME_SQL = (
    TASK_SQL
    + """
, saved AS (
  SELECT c AS rc, CASE WHEN c % 13 = 0 THEN query || ' old' ELSE query END AS q,
    CASE WHEN c % 19 > 0 THEN start_time_utc END AS s, end_time_utc AS e2,
    CASE WHEN c % 3 = 0 THEN 'n' || task_name END AS token, c % 5 AS pages, c % 50 AS total, c % 60 AS incl,
    c % 2 = 0 AS finished, CASE WHEN c % 6 = 0 THEN 'target_posts' ELSE '' END AS why
  FROM planned WHERE error IS NULL),
j AS (
  SELECT *, rc IS NOT NULL AND q IS NOT DISTINCT FROM query AND s IS NOT DISTINCT FROM start_time_utc
      AND e2 IS NOT DISTINCT FROM end_time_utc AS same FROM planned LEFT JOIN saved ON rc = c),
decided AS (
  SELECT *, CASE WHEN rc IS NULL THEN 'fresh'
    WHEN c % 8 > 0 AND same AND finished AND token IS NULL THEN 'skip_completed'
    WHEN same AND why = 'target_posts' AND c % 4 * 10 > 0 AND total >= c % 4 * 10 THEN 'skip_target'
    WHEN same AND NOT finished AND token IS NOT NULL THEN 'resume'
    WHEN same AND NOT finished AND token IS NULL THEN 'fresh'
    WHEN NOT same AND c % 9 <> 0 THEN 'fresh' ELSE 'continue' END AS action FROM j)
"""
)


@query(
    "resume_decision",
    RESUME_SQL + "SELECT task_name, action, CASE WHEN action = 'resume' THEN token END AS resume_token FROM decided",
)
def resume_decision(spark: SparkSession, sf: str) -> DataFrame:
    """X2"""
    planned = durable(planned_tasks(spark, sf), "planned")
    return resume_decisions(planned, saved_runs(planned)).select("task_name", "action", "resume_token")


ROLLED_SQL = (
    RESUME_SQL
    + """
SELECT task_name, CASE WHEN action IN ('resume', 'continue') THEN pages ELSE 0 END + 2 AS page_count,
  CASE WHEN action IN ('resume', 'continue') THEN total ELSE 0 END + c % 7 AS total_tweets,
  CASE WHEN c % 4 = 1 THEN 'tok' END AS next_token,
  c % 4 <> 1 AS completed,
  CASE WHEN c % 4 = 1 THEN '' WHEN c % 4 = 2 THEN 'usage_cap_reached' ELSE 'completed' END AS stop_reason,
  CASE WHEN rc IS NULL THEN 0 ELSE c * 10 END AS converted_jsonl_offset, c % 4 = 2 AS truncated
FROM decided WHERE error IS NULL AND action IN ('fresh', 'resume', 'continue')
UNION ALL
SELECT task_name, pages, total, token, finished, why, c * 10, false
FROM decided WHERE error IS NULL AND rc IS NOT NULL AND action LIKE 'skip%'
"""
)


def run_results(decided: DataFrame) -> DataFrame:
    """What the tasks that ran brought."""
    c = F.col("task_name").cast("bigint")
    return decided.where("not startswith(action, 'skip')").select(
        "task_name",
        F.lit(2).alias("pages"),
        (c % 7).alias("posts"),
        F.lit(0).alias("includes"),
        F.when(c % 4 == 1, "tok").alias("next_token"),
        F.when(c % 4 == 2, "usage_cap_reached").otherwise("").alias("stop_reason"),
        F.lit(AS_OF).alias("finished_at"),
    )


@query("state_roll_forward", ROLLED_SQL)
def state_roll(spark: SparkSession, sf: str) -> DataFrame:
    """X3"""
    planned = durable(planned_tasks(spark, sf), "planned")
    saved = durable(saved_runs(planned), "saved")
    decided = durable(resume_decisions(planned, saved), "decided")  # read for the tasks that ran and for the rest
    return roll_forward(decided, saved, run_results(decided)).select(
        "task_name", "page_count", "total_tweets", "next_token", "completed", "stop_reason",
        "converted_jsonl_offset", "truncated",
    )


@query("state_upsert", ROLLED_SQL)
def state_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """The same by merging the tasks that ran into a table with versions."""
    columns = ("page_count", "total_tweets", "next_token", "completed", "stop_reason", "converted_jsonl_offset", "truncated")
    planned = durable(planned_tasks(spark, sf), "planned")
    saved = saved_runs(planned).withColumn("truncated", F.lit(False))
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in saved.schema)
    table_ = StateTable(spark, scratch_path(spark, "states"), ddl)
    table_.merge(saved, 0)
    states, version = table_.read()
    decided = durable(resume_decisions(planned, states), "decided")
    rolled = durable(rolled_rows(decided, states, run_results(decided)).select(*states.columns), "rolled")
    table_.merge(rolled, version)
    return table_.read()[0].select("task_name", *columns)


@query(
    "stream_state_reuse",
    """
SELECT CAST(c_custkey AS VARCHAR) AS task_name, c_acctbal > 0 AND c_custkey % 4 > 0 AS reused,
  CASE WHEN c_acctbal > 0 AND c_custkey % 4 > 0 THEN c_custkey % 50 ELSE 0 END AS total_tweets,
  CASE WHEN c_acctbal > 0 AND c_custkey % 4 > 0 THEN 'h' || c_custkey ELSE '' END AS last_heartbeat_at,
  CAST(c_nationkey AS BIGINT) AS seen_count, CAST(0 AS BIGINT) AS consecutive_failures
FROM customer
""",
)
def stream_reuse(spark: SparkSession, sf: str) -> DataFrame:
    """X4"""
    c = F.col("c_custkey")
    customers = table(spark, sf, "customer")
    tasks = customers.select(
        text(c).alias("task_name"), F.col("c_mktsegment").alias("query"), text(c).alias("rule_tag"),
        F.lit("r").alias("rule_id"),
    )
    states = customers.where("c_acctbal > 0").select(
        text(c).alias("task_name"),
        F.when(c % 4 > 0, F.col("c_mktsegment")).otherwise("other").alias("query"),
        text(c).alias("rule_tag"),
        F.lit(1).alias("connection_count"),
        (c % 50).alias("total_tweets"),
        F.lit(0).alias("total_includes"),
        F.lit(0).alias("keepalive_count"),
        F.concat(F.lit("h"), text(c)).alias("last_heartbeat_at"),
        F.lit("").alias("last_event_at"),
        F.lit("").alias("last_connected_at"),
        F.lit("").alias("last_disconnect_at"),
    )
    seen = customers.select(text(c).alias("task_name"), F.col("c_nationkey").alias("seen_count"))
    return reuse_stream_state(tasks, states, seen).select(
        "task_name", "reused", "total_tweets", "last_heartbeat_at", "seen_count", "consecutive_failures"
    )


@query(
    "config_normalize",
    """
SELECT c_custkey, greatest(c_custkey % 200 - 50, 0) AS now_lag_seconds,
  least(greatest(c_custkey % 700, 10), 500) AS max_results,
  least(greatest(least(greatest(c_custkey % 700, 10), 500), 10), CASE WHEN c_custkey % 2 = 0 THEN 500 ELSE 100 END) AS page_size,
  least(greatest(c_custkey % 120, 1), 90) AS usage_days,
  greatest(c_custkey % 5 - 2, 0) AS target_posts,
  concat_ws(';', CASE WHEN c_custkey % 10 = 0 THEN 'task_name is empty' END,
    CASE WHEN c_custkey % 15 = 0 THEN 'keywords are empty' END,
    CASE WHEN c_custkey % 6 = 0 THEN 'invalid search_mode' END,
    CASE WHEN c_custkey % 4 < 2 THEN 'window_hours must be positive or null' END,
    CASE WHEN c_custkey % 21 = 0 THEN 'unknown time zone' END) AS errors
FROM customer
""",
)
def config_normalize(spark: SparkSession, sf: str) -> DataFrame:
    """P12 for search tasks."""
    c = F.col("c_custkey")
    tasks = table(spark, sf, "customer").select(
        "c_custkey",
        F.when(c % 10 == 0, "").otherwise(F.col("c_name")).alias("task_name"),
        F.when(c % 15 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("x"))).alias("keywords"),
        F.when(c % 6 == 0, "both").otherwise("auto").alias("search_mode"),
        F.when(c % 4 < 3, c % 4 - 1).alias("window_hours"),
        F.when(c % 21 == 0, "Mars/Base").otherwise("Asia/Tokyo").alias("local_tz_name"),
        (c % 3 - 1).alias("highwater_overlap_seconds"),
        (c % 200 - 50).alias("now_lag_seconds"),
        (c % 9 - 1).alias("convert_batch_size"),
        (c % 5 - 2).alias("target_posts"),
        (c % 5 - 2).alias("usage_check_every_pages"),
        (c % 120).alias("usage_days"),
        (c % 700).alias("max_results"),
    )
    endpoint = F.when(c % 2 == 0, "all").otherwise("recent")
    return normalize_search_tasks(tasks).select(
        "c_custkey", "now_lag_seconds", "max_results", page_size(F.col("max_results"), endpoint).alias("page_size"),
        "usage_days", "target_posts", F.array_join("errors", ";").alias("errors"),
    )


@query(
    "stream_config_normalize",
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name ELSE 'tag' END AS rule_tag,
  greatest(c_custkey % 9 - 4, 0) AS max_posts, greatest(c_custkey % 200, 1) AS idle_timeout_seconds,
  greatest(c_custkey % 90 - 1, 0.1)::DOUBLE AS reconnect_initial_delay_seconds,
  greatest(c_custkey % 50, greatest(c_custkey % 90 - 1, 0.1))::DOUBLE AS reconnect_max_delay_seconds,
  CASE WHEN c_custkey % 8 = 0 THEN 'invalid field_profile' ELSE '' END AS errors
FROM customer
""",
)
def stream_config(spark: SparkSession, sf: str) -> DataFrame:
    """P12 for stream tasks."""
    c = F.col("c_custkey")
    zero = F.lit(0).cast("bigint")
    tasks = table(spark, sf, "customer").select(
        "c_custkey",
        F.col("c_name").alias("task_name"),
        F.array(F.lit("x")).alias("keywords"),
        F.when(c % 8 == 0, "rich").otherwise("lean").alias("field_profile"),
        F.when(c % 3 == 0, "  ").otherwise(" tag ").alias("rule_tag"),
        (c % 9 - 4).alias("max_posts"),
        zero.alias("http_readtimeout_seconds"),
        zero.alias("max_reconnects"),
        zero.alias("rotate_records"),
        F.lit(-1.0).alias("max_seconds"),
        F.lit(-1.0).alias("rotate_seconds"),
        F.lit(30.0).alias("state_flush_interval_seconds"),
        (c % 200).alias("idle_timeout_seconds"),
        (c % 9).alias("convert_batch_size"),
        (c % 90 - 1).cast("double").alias("reconnect_initial_delay_seconds"),
        (c % 50).cast("double").alias("reconnect_max_delay_seconds"),
    )
    return normalize_stream_tasks(tasks).select(
        "c_custkey", "rule_tag", "max_posts", "idle_timeout_seconds", "reconnect_initial_delay_seconds",
        "reconnect_max_delay_seconds", F.array_join("errors", ";").alias("errors"),
    )


@query(
    "endpoint_choice",
    f"""
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 'recent' WHEN 1 THEN 'all'
  ELSE CASE WHEN o_orderdate < TIMESTAMP '2001-07-20 00:00:00' - INTERVAL 7 DAY THEN 'all' ELSE 'recent' END END AS endpoint
FROM orders
""",
)
def endpoint_choice(spark: SparkSession, sf: str) -> DataFrame:
    """F23"""
    k = F.col("o_orderkey")
    mode = F.when(k % 3 == 0, "recent").when(k % 3 == 1, "all").otherwise("auto")
    now = F.lit("2001-07-20 00:00:00").cast("timestamp_ntz")
    return table(spark, sf, "orders").select("o_orderkey", choose_endpoint(mode, F.col("o_orderdate"), now).alias("endpoint"))


@query(
    "cap_stop",
    """
SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 AND c_custkey % 7 - 3 <= 0 THEN 'usage_cap_reached' END AS stop FROM customer
""",
)
def cap_stop(spark: SparkSession, sf: str) -> DataFrame:
    """A5: stop of a run that drains its cap."""
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select("c_custkey", cap_reached(c % 7 - 3, c % 2 == 0).alias("stop"))


@query(
    "window_join",
    """
SELECT event_id, n_nationkey FROM events JOIN nation
  ON ts >= CASE WHEN n_nationkey % 6 = 0 THEN TIMESTAMP '1970-01-01' ELSE TIMESTAMP '2024-01-01 03:00:00' + to_days(n_nationkey) END
 AND ts < TIMESTAMP '2024-01-03 09:30:00' + to_days(n_nationkey)
""",
)
def windows_of_posts(spark: SparkSession, sf: str) -> DataFrame:
    """J11"""
    n = F.col("n_nationkey")
    start = F.timestamp_add("DAY", n, F.lit("2024-01-01 03:00:00").cast("timestamp_ntz"))
    windows = table(spark, sf, "nation").select(
        "n_nationkey",
        F.when(n % 6 != 0, start).alias("start_time"),
        F.timestamp_add("DAY", n, F.lit("2024-01-03 09:30:00").cast("timestamp_ntz")).alias("end_time"),
    )
    posts = table(spark, sf, "events").select("event_id", "ts")
    return window_join(posts, windows, ["event_id"]).select("event_id", "n_nationkey")


@query(
    "collector_states",
    """
SELECT CAST(c_custkey AS VARCHAR) AS task_name, '' AS query,
  CASE WHEN c_custkey % 2 = 0 THEN 'e' || c_custkey END AS end_time_utc, c_custkey AS total_tweets,
  CASE WHEN c_custkey % 3 = 0 THEN true ELSE false END AS completed,
  CASE WHEN c_custkey % 4 = 0 THEN 'target_posts' ELSE '' END AS stop_reason, CAST(0 AS BIGINT) AS converted_jsonl_offset
FROM customer WHERE c_mktsegment <> 'MACHINERY'
""",
)
def search_state_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Search states; unreadable documents give no state."""
    c = F.col("c_custkey")
    doc = F.to_json(
        F.struct(
            text(c).alias("task_name"),
            F.when(c % 2 == 0, F.concat(F.lit("e"), text(c))).alias("end_time_utc"),
            c.alias("total_tweets"),
            F.when(c % 3 == 0, True).alias("completed"),
            F.when(c % 4 == 0, "target_posts").alias("stop_reason"),
        )
    )
    docs = table(spark, sf, "customer").select(
        F.when(F.col("c_mktsegment") == "MACHINERY", "{broken").otherwise(doc).alias("doc")
    )
    return collector_states(docs).select(
        "task_name", "query", "end_time_utc", "total_tweets", "completed", "stop_reason", "converted_jsonl_offset"
    )


@query(
    "state_migration",
    """
SELECT CAST(c_custkey AS VARCHAR) AS task_name, CASE WHEN c_custkey % 5 = 0 THEN 'r1' END AS rule_id,
  c_custkey % 40 AS keepalive_count, CASE WHEN c_custkey % 2 = 0 THEN 'err' || c_custkey ELSE 'old' || c_custkey END AS error,
  CASE WHEN c_custkey % 2 = 0 THEN CAST(429 AS BIGINT) ELSE CAST(503 AS BIGINT) END AS status,
  CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 9 ELSE 0 END AS retry_after
FROM customer
""",
)
def state_migration(spark: SparkSession, sf: str) -> DataFrame:
    """Nested and older flat diagnostics."""
    c = F.col("c_custkey")
    nested = c % 2 == 0
    doc = F.to_json(
        F.struct(
            text(c).alias("task_name"),
            F.when(c % 5 == 0, "r1").alias("rule_id"),
            (c % 40).alias("keepalive_count"),
            F.when(
                nested,
                F.struct(
                    F.concat(F.lit("err"), text(c)).alias("error"), F.lit("429").alias("status"), (c % 9).alias("retry_after")
                ),
            ).alias("diagnostics"),
            # Ignored when nested diagnostics are there.
            F.concat(F.lit("old"), text(c)).alias("last_error"),
            F.lit(503).alias("last_status"),
        )
    )
    states = stream_states(table(spark, sf, "customer").select(doc.alias("doc")))
    return states.select(
        "task_name", "rule_id", "keepalive_count", "diagnostics.error", "diagnostics.status", "diagnostics.retry_after"
    )
