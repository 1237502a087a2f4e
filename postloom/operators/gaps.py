"""Idle gaps, outage gaps, failure runs and their reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clock import micros, utc_text
from .order import carry, range_splits

# Fixed value: silence that counts as a lost stream, in seconds.
IDLE_SECONDS = 120
# Diagnostics kept with a gap.
DIAGNOSTICS = (
    "error_type",
    "error_detail",
    "status",
    "rate_limit_limit",
    "rate_limit_remaining",
    "rate_limit_reset",
    "retry_after",
)


def read_timeout(http_readtimeout_seconds: int, idle_timeout_seconds: int = IDLE_SECONDS) -> int:
    return http_readtimeout_seconds if http_readtimeout_seconds > 0 else idle_timeout_seconds


def idle_gaps(lines: DataFrame, stream: str, ts: str = "ts", timeout_seconds: int = IDLE_SECONDS) -> DataFrame:
    """Silences longer than the timeout, over all lines of a stream.

    Two lines in the same timeout-wide bucket are never that far apart, so each bucket
    is first reduced to its first and last time. The window then holds one row per
    stream and bucket, whatever the number of lines.
    """
    width = timeout_seconds * 1_000_000
    edges = (
        lines.select(F.col(stream), F.col(ts).alias("_ts"))
        .withColumn("_bucket", F.floor(micros(F.col("_ts")) / width))
        .groupBy(stream, "_bucket")
        .agg(F.min("_ts").alias("first_ts"), F.max("_ts").alias("last_ts"))
    )
    before = F.lag("last_ts").over(Window.partitionBy(stream).orderBy("_bucket"))
    silent = micros(F.col("end_time_utc")) - micros(F.col("start_time_utc"))
    return (
        edges.select(stream, before.alias("start_time_utc"), F.col("first_ts").alias("end_time_utc"))
        .where(silent > width)
        .withColumn("reason", F.lit("idle_timeout"))
    )


def connection_gaps(
    log: DataFrame,
    tie: tuple[str, ...] = (),
    keys: tuple[str, ...] = ("task_name",),
    include_open: bool = False,
) -> DataFrame:
    """Outage intervals of a connection log.

    `log` has the keys, `ts`, `event` (`failed`, `connected` or `stopped`; others are
    ignored), `reason`, optionally diagnostics, and `tie` columns that settle equal
    times. The first failure opens a gap, the next connect or stop closes it. A gap is
    numbered by the closings before it, counted in ordered splits, so one busy task is
    shared by many Spark tasks; the rest is one aggregate.
    """
    extra = [c for c in DIAGNOSTICS if c in log.columns]
    order = ["ts", *tie]
    rows = log.where(F.col("event").isin("failed", "connected", "stopped")).select(
        *dict.fromkeys([*keys, *order, "event", "reason", *extra])
    )
    cut = range_splits(rows, [*keys, *order], "connection_log")
    closes = (F.col("event") != "failed").cast("int")
    local = Window.partitionBy(*keys, "split").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    counts = cut.groupBy(*keys, "split").agg(F.sum(closes).alias("n"))
    before = carry(counts, list(keys), ["split"], sums=("n",)).select(*keys, "split", "n_before")
    numbered = (
        cut.withColumn("_in", F.coalesce(F.sum(closes).over(local), F.lit(0)))
        .join(before, [*keys, "split"])
        .withColumn("island", F.col("_in") + F.col("n_before"))
    )
    failed = F.col("event") == "failed"
    gaps = numbered.groupBy(*keys, "island").agg(
        F.min(F.when(failed, F.struct(*dict.fromkeys([*order, "reason", *extra])))).alias("o"),
        F.min(F.when(~failed, F.struct(*dict.fromkeys([*order, "event", "reason"])))).alias("c"),
    )
    found = gaps.where("o is not null" if include_open else "o is not null and c is not null")
    own = F.nullif(F.col("o.reason"), F.lit(""))
    stop = F.when(F.col("c.event") == "stopped", F.nullif(F.col("c.reason"), F.lit("")))
    return found.select(
        *keys,
        F.col("o.ts").alias("start_time_utc"),
        F.col("c.ts").alias("end_time_utc"),
        F.coalesce(stop, own, F.lit("disconnected")).alias("reason"),
        *[F.col(f"o.{c}").alias(c) for c in extra],
    )


def failure_runs(log: DataFrame, tie: tuple[str, ...] = (), keys: tuple[str, ...] = ("task_name",)) -> DataFrame:
    """Failures with their place in the run since the last activity.

    `event` is `failed` or `activity`; others are ignored.
    """
    order = ["ts", *tie]
    rows = log.where(F.col("event").isin("failed", "activity")).select(*keys, *order, "event", "reason")
    cut = range_splits(rows, [*keys, *order], "failure_log")
    fail = (F.col("event") == "failed").cast("int")
    running = Window.partitionBy(*keys, "split").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inside = cut.withColumn("_fails", F.sum(fail).over(running)).withColumn(
        "_reset", F.max(F.when(F.col("event") == "activity", F.col("_fails"))).over(running)
    )
    ends = inside.groupBy(*keys, "split").agg(
        F.max("_fails").alias("fails"), F.max("_reset").alias("reset")
    )
    totals = carry(ends, list(keys), ["split"], sums=("fails",))
    totals = totals.withColumn("reset", F.col("reset") + F.col("fails_before"))
    before = carry(totals.drop("fails_before"), list(keys), ["split"], sums=("fails",), prev=("reset",)).select(
        *keys, "split", (F.col("fails_before") - F.coalesce("reset_prev", F.lit(0))).alias("_open")
    )
    # Without activity earlier in the split the run goes on from the splits before it.
    run = F.when(F.col("_reset").isNull(), F.col("_fails") + F.col("_open")).otherwise(
        F.col("_fails") - F.col("_reset")
    )
    return (
        inside.join(before, [*keys, "split"])
        .where("event = 'failed'")
        .select(*keys, *order, "reason", run.cast("bigint").alias("consecutive_failures"))
    )


def reconnect_decision(failures: DataFrame, max_reconnects: int = 0, reconnect: bool = True) -> DataFrame:
    """Whether a run reconnects after each failure; 0 allows any number."""
    over = F.lit(max_reconnects > 0) & (F.col("consecutive_failures") > max_reconnects)
    go = F.lit(reconnect) & ~over
    return failures.withColumns(
        {
            "should_reconnect": go,
            "stop_reason": F.when(go, "")
            .when(F.lit(reconnect) & over, "max_reconnects_exceeded")
            .otherwise(F.coalesce("reason", F.lit(""))),
        }
    )


def failure_rollup(gaps: DataFrame, keys: tuple[str, ...] = ("task_name",)) -> DataFrame:
    """Gaps by task and reason."""
    silent = micros(F.col("end_time_utc")) - micros(F.col("start_time_utc"))
    return gaps.groupBy(*keys, "reason").agg(
        F.count(F.lit(1)).alias("gaps"),
        F.sum(F.floor(silent / 1_000_000)).cast("bigint").alias("gap_seconds"),
        F.max("end_time_utc").alias("last_end"),
    )


def gap_record_fields() -> dict[str, Column]:
    """Diagnostics of a gap record, null where the record leaves them out."""

    def positive(name: str) -> Column:
        return F.when(F.col(name) > 0, F.col(name))

    limited = (
        (F.col("status") == 429)
        | (F.col("rate_limit_limit") > 0)
        | (F.col("rate_limit_reset") > 0)
        | (F.col("retry_after") > 0)
    )
    return {
        "error_type": F.nullif("error_type", F.lit("")),
        "error_detail": F.nullif("error_detail", F.lit("")),
        "status": positive("status"),
        "rate_limit_limit": positive("rate_limit_limit"),
        "rate_limit_remaining": F.when(limited, F.col("rate_limit_remaining")),
        "rate_limit_reset": positive("rate_limit_reset"),
        "retry_after": positive("retry_after"),
    }


def gap_lines(gaps: DataFrame, recorded_at: Column) -> DataFrame:
    """One JSON text per gap; null fields are left out."""
    head = ["task_name", "query", "rule_id", "rule_tag"]
    fields = [F.col(c) for c in head if c in gaps.columns] + [
        utc_text(F.col("start_time_utc")).alias("start_time_utc"),
        utc_text(F.col("end_time_utc")).alias("end_time_utc"),
        F.col("reason"),
        utc_text(recorded_at).alias("recorded_at"),
    ]
    if all(c in gaps.columns for c in DIAGNOSTICS):
        fields += [value.alias(name) for name, value in gap_record_fields().items()]
    return gaps.select(F.to_json(F.struct(*fields)).alias("value"))


def write_gaps(gaps: DataFrame, path: str, recorded_at: Column) -> None:
    """S9"""
    gap_lines(gaps, recorded_at).write.mode("append").text(path)
