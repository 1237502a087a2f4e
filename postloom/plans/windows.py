"""Incremental planning over tables of tasks and states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import (
    RECENT_DAYS,
    choose_endpoint,
    local_time_error,
    local_to_utc,
    ntz,
    plus_seconds,
    utc_text,
    utc_time,
)
from ..operators.filters import query_text


def second(ts: Column) -> Column:
    return ntz(F.date_trunc("second", ts))


def resolve_windows(tasks: DataFrame, states: DataFrame, as_of: Column) -> DataFrame:
    """Query, endpoint and time window of every task.

    `tasks` are normalized search tasks; `states` has one row per task with
    `task_name, query, end_time_utc, completed`. `as_of` is the clock. Adds `query`,
    `endpoint`, `start_time_utc`, `end_time_utc` (texts) and `error`.
    """
    prior = states.select(
        "task_name",
        F.col("query").alias("_prev_query"),
        F.col("end_time_utc").alias("_prev_end"),
        F.col("completed").alias("_prev_completed"),
    )
    zone = F.col("local_tz_name")
    now = ntz(as_of)
    base = tasks.join(prior, "task_name", "left").withColumns(
        {
            "query": query_text(F.col("keywords"), F.col("extra_query_tail"), F.col("exclude_reposts")),
            "_limit_end": plus_seconds(now, -F.col("now_lag_seconds")),
            "_oldest": plus_seconds(now, F.lit(-RECENT_DAYS * 86_400)),
            "_start": local_to_utc(F.col("start_time"), zone),
            "_asked_end": local_to_utc(F.col("end_time"), zone),
            "_time_error": F.coalesce(
                local_time_error(F.col("end_time"), zone), local_time_error(F.col("start_time"), zone)
            ),
        }
    )
    clipped = F.col("_asked_end") > F.col("_limit_end")
    ended = base.withColumn(
        "_end",
        F.when(F.col("_asked_end").isNull(), second(F.col("_limit_end")))
        .when(clipped, F.col("_limit_end"))
        .otherwise(F.col("_asked_end")),
    ).withColumn(
        "endpoint",
        choose_endpoint(
            F.col("search_mode"), F.least(F.coalesce("_asked_end", "_limit_end"), F.col("_limit_end")), now
        ),
    )
    high = plus_seconds(utc_time(F.col("_prev_end")), -F.greatest("highwater_overlap_seconds", F.lit(0)))
    usable = (
        F.col("use_state_highwater_start")
        & F.col("_prev_completed")
        & (F.col("_prev_query") == F.col("query"))
        & (high < F.col("_end"))
    )
    by_window = F.timestamp_add("HOUR", -F.col("window_hours"), F.col("_end"))
    recent = F.col("endpoint") == "recent"
    started = ended.withColumn(
        "_from", F.coalesce("_start", F.when(usable, high), second(by_window))
    ).withColumn(
        "_from", F.when(recent & (F.col("_from") < F.col("_oldest")), F.col("_oldest")).otherwise(F.col("_from"))
    )
    error = (
        F.when(F.col("query").isNull(), "no valid keyword")
        .when(F.col("_time_error").isNotNull(), F.col("_time_error"))
        .when(recent & (F.col("_end") < F.col("_oldest")), "end_time is older than the recent look-back")
        .when(F.col("_from") >= F.col("_end"), "start_time >= end_time")
    )
    return (
        started.withColumn("error", error)
        .withColumn("start_time_utc", F.when(F.col("error").isNull(), utc_text(F.col("_from"))))
        .withColumn("end_time_utc", F.when(F.col("error").isNull(), utc_text(F.col("_end"))))
        .drop(
            "_prev_query", "_prev_end", "_prev_completed", "_limit_end", "_oldest", "_start", "_asked_end",
            "_time_error", "_end", "_from",
        )
    )


def resume_decisions(planned: DataFrame, states: DataFrame) -> DataFrame:
    """What each planned task does with its saved state; the first match wins."""
    saved = states.select("task_name", F.struct(*[c for c in states.columns if c != "task_name"]).alias("s"))
    both = planned.join(saved, "task_name", "left")
    same = (
        F.col("s.query").eqNullSafe(F.col("query"))
        & F.col("s.start_time_utc").eqNullSafe(F.col("start_time_utc"))
        & F.col("s.end_time_utc").eqNullSafe(F.col("end_time_utc"))
    )
    done = F.coalesce(F.col("s.completed"), F.lit(False))
    token = F.col("s.next_token").isNotNull()
    at_target = (
        (F.col("s.stop_reason") == "target_posts")
        & (F.col("target_posts") > 0)
        & (F.col("s.total_tweets") >= F.col("target_posts"))
    )
    action = (
        F.when(F.col("s").isNull(), "fresh")
        .when(F.col("skip_if_completed_same_window") & same & done & ~token, "skip_completed")
        .when(same & at_target, "skip_target")
        .when(same & ~done & token, "resume")
        .when(same & ~done & ~token, "fresh")
        .when(~same & ~F.col("force_resume_on_mismatch"), "fresh")
        .otherwise("continue")
    )
    return (
        both.withColumn("action", action)
        .withColumn("resume_token", F.when(F.col("action") == "resume", F.col("s.next_token")))
        .drop("s")
    )


def rolled_rows(decisions: DataFrame, states: DataFrame, results: DataFrame) -> DataFrame:
    """The new state rows of the tasks that ran.

    `results` has one row per task that ran: `task_name, pages, posts, includes,
    next_token, stop_reason, finished_at`. A fresh run starts its counters anew but keeps
    the conversion offset. `truncated` marks runs that completed without seeing every page.
    """
    ran = decisions.where("error is null").join(results, "task_name")
    old = states.select("task_name", F.struct(*states.columns).alias("s"))
    kept = F.col("action").isin("resume", "continue")

    def total(name: str, new: str) -> Column:
        before = F.when(kept, F.coalesce(F.col(f"s.{name}"), F.lit(0))).otherwise(0)
        return (before + F.col(new)).cast("bigint").alias(name)

    cut = F.col("r_reason").isin("invalid_pagination_token", "usage_cap_reached")
    return (
        ran.withColumnsRenamed({"stop_reason": "r_reason", "next_token": "r_token"})
        .join(old, "task_name", "left")
        .select(
            F.col("finished_at").alias("timestamp"),
            "task_name",
            "query",
            "start_time_utc",
            "end_time_utc",
            F.when(~cut, F.col("r_token")).alias("next_token"),
            total("page_count", "pages"),
            total("total_tweets", "posts"),
            total("total_includes", "includes"),
            (cut | F.col("r_token").isNull()).alias("completed"),
            F.when(cut | (F.col("r_reason") == "target_posts"), F.col("r_reason"))
            .when(F.col("r_token").isNull(), "completed")
            .otherwise("")
            .alias("stop_reason"),
            F.coalesce(F.col("s.converted_jsonl_offset"), F.lit(0)).alias("converted_jsonl_offset"),
            F.coalesce(F.col("s.converted_at"), F.lit("")).alias("converted_at"),
            cut.alias("truncated"),
        )
    )


def roll_forward(decisions: DataFrame, states: DataFrame, results: DataFrame) -> DataFrame:
    """The state table after a run. Tasks that did not run keep their row."""
    fresh = rolled_rows(decisions, states, results)
    idle = states.join(fresh.select("task_name"), "task_name", "left_anti")
    return fresh.unionByName(idle, allowMissingColumns=True).na.fill({"truncated": False})


def reuse_stream_state(tasks: DataFrame, states: DataFrame, seen_counts: DataFrame) -> DataFrame:
    """Starting state of every stream task.

    `tasks` has `task_name, query, rule_tag, rule_id`; `states` the saved rows;
    `seen_counts` has `task_name, seen_count`. Totals survive when query and rule tag are
    unchanged; failures and diagnostics never do.
    """
    saved = states.select("task_name", F.struct(*[c for c in states.columns if c != "task_name"]).alias("s"))
    both = tasks.select("task_name", "query", "rule_tag", "rule_id").join(saved, "task_name", "left").join(
        seen_counts, "task_name", "left"
    )
    same = F.col("s.query").eqNullSafe(F.col("query")) & F.col("s.rule_tag").eqNullSafe(F.col("rule_tag"))
    counters = ("connection_count", "total_tweets", "total_includes", "keepalive_count")
    times = ("last_heartbeat_at", "last_event_at", "last_connected_at", "last_disconnect_at")
    return both.select(
        "task_name",
        "query",
        "rule_tag",
        "rule_id",
        same.alias("reused"),
        *[F.when(same, F.coalesce(F.col(f"s.{c}"), F.lit(0))).otherwise(0).cast("bigint").alias(c) for c in counters],
        *[F.when(same, F.coalesce(F.col(f"s.{c}"), F.lit(""))).otherwise("").alias(c) for c in times],
        F.lit(0).cast("bigint").alias("consecutive_failures"),
        F.coalesce("seen_count", F.lit(0)).cast("bigint").alias("seen_count"),
        F.lit(False).alias("completed"),
        F.lit("").alias("stop_reason"),
    )
