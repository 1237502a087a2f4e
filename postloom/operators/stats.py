"""Counters and summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.clock import micros
from ..functions.coerce import int_sql, json_field, json_has_key, json_int, json_items
from ..sources.pages import delivered_posts


def run_counters(records: DataFrame, keys: tuple[str, ...] = ("log",)) -> DataFrame:
    """A2: pages, posts and includes per log."""
    kind = F.col("kind")
    return records.groupBy(*keys).agg(
        F.count_if(kind == "page").alias("pages"),
        F.count_if(kind == "tweet").alias("posts"),
        F.count_if(kind.startswith("include:")).alias("includes"),
    )


def outcome_counters(lines: DataFrame, keys: tuple[str, ...] = ("log",)) -> DataFrame:
    """Lines per outcome."""
    names = ("keepalive", "invalid", "tweet", "errors", "ignored")
    return lines.groupBy(*keys).agg(*[F.count_if(F.col("outcome") == n).alias(n) for n in names])


def page_stats(pages: DataFrame, new_posts: DataFrame) -> DataFrame:
    """A3: delivered and new posts per page, and the count the page itself claims."""
    told = json_int("meta", "result_count")
    heads = pages.select("log", "block", json_field(F.col("body"), "meta").alias("meta")).select(
        "log", "block", told.alias("result_count")
    )
    delivered = delivered_posts(pages).groupBy("log", "block").agg(F.count(F.lit(1)).alias("delivered"))
    fresh = new_posts.groupBy("log", "block").agg(F.count(F.lit(1)).alias("new_posts"))
    return (
        heads.join(delivered, ["log", "block"], "left")
        .join(fresh, ["log", "block"], "left")
        .na.fill(0, ["delivered", "new_posts"])
    )


def usage_summary(bodies: DataFrame, body: str = "body") -> DataFrame:
    """A5: adds cap, usage, reset day and what is left; null when either is unknown."""
    names = ("project_cap", "project_usage", "cap_reset_day")
    ddl = ", ".join(f"{n} VARIANT" for n in names)
    read = bodies.withColumn("_d", F.from_json(json_field(F.col(body), "data"), ddl)).selectExpr(
        *bodies.columns, *[f"{int_sql(f'_d.{n}')} AS {n}" for n in names]
    )
    # `greatest` skips nulls, so an unknown side is tested first.
    known = F.col("project_cap").isNotNull() & F.col("project_usage").isNotNull()
    left = F.greatest(F.col("project_cap") - F.col("project_usage"), F.lit(0))
    return read.withColumn("remaining", F.when(known, left))


def cap_reached(remaining: Column, drain_to_cap: Column) -> Column:
    """A5: stop reason of a run that uses up its cap."""
    return F.when(drain_to_cap & (remaining <= 0), "usage_cap_reached")


def latest_progress(lines: DataFrame, keys: tuple[str, ...] = ("task_name",), tie: tuple[str, ...] = ()) -> DataFrame:
    """Last times and counts per task.

    `event` is one of `keepalive, post, connected, failed`.
    """
    event = F.col("event")

    def last(name: str) -> Column:
        return F.max(F.when(event == name, F.col("ts")))

    return lines.groupBy(*keys).agg(
        last("keepalive").alias("last_heartbeat_at"),
        last("post").alias("last_event_at"),
        last("connected").alias("last_connected_at"),
        last("failed").alias("last_disconnect_at"),
        F.count_if(event == "keepalive").alias("keepalive_count"),
        F.count_if(event == "connected").alias("connection_count"),
        F.max_by("event", F.struct("ts", *tie)).alias("last_event"),
    )


# Fixed value: seconds between writes of a task's progress that nothing forces.
FLUSH_SECONDS = 30
# Events that force a write.
FORCING = ("post", "failed", "stopped")


def progress_writes(
    lines: DataFrame,
    seconds: int = FLUSH_SECONDS,
    keys: tuple[str, ...] = ("task_name",),
    tie: tuple[str, ...] = (),
    before: DataFrame | None = None,
) -> DataFrame:
    """How often, and when last, the progress of each task is written.

    Every post, failure and stop writes it. Beside them the first line of each slot of
    `seconds` does (none if that is 0), so what is written of a quiet task lags by less than two
    slots. Equal times are settled by `tie`.

    Returns the keys, `forced` and `timed` (writes of each kind), `last_line_at`, `last_write_at`
    and `written` (whether a line given here wrote). `before` is the result for all
    lines before these; its counts go on, and its last slot is not opened twice. Lines
    without time are left out. Each slot is reduced to one row first, so a busy task costs one
    row per task and slot.
    """
    ts, width = F.col("ts"), max(seconds, 1) * 1_000_000
    slot = lambda at: F.floor(micros(at) / width)
    forces = F.coalesce(F.col("event").isin(*FORCING), F.lit(False))
    slots = (
        lines.where(ts.isNotNull())
        .groupBy(*keys, slot(ts).alias("slot"))
        .agg(
            F.count_if(forces).alias("forced"),
            F.max(F.when(forces, ts)).alias("forced_at"),
            F.min(F.struct("ts", *tie, forces.alias("forces"))).alias("first"),
            F.max(ts).alias("last_line_at"),
        )
    )
    due = F.lit(seconds > 0) & ~F.col("first.forces")
    if before is not None:
        seen = before.select(*[F.col(k).alias(f"_{k}") for k in keys], slot(F.col("last_line_at")).alias("_slot"))
        same = [slots[k].eqNullSafe(seen[f"_{k}"]) for k in keys]
        slots = slots.join(seen, same, "left")
        due = due & (F.col("_slot").isNull() | (F.col("slot") > F.col("_slot")))
    now = slots.select(
        *keys,
        "forced",
        due.cast("bigint").alias("timed"),
        "last_line_at",
        F.greatest("forced_at", F.when(due, F.col("first.ts"))).alias("last_write_at"),
        ((F.col("forced") > 0) | due).alias("written"),
    )
    if before is not None:
        now = now.unionByName(before.withColumn("written", F.lit(False)))
    return now.groupBy(*keys).agg(
        F.sum("forced").alias("forced"),
        F.sum("timed").alias("timed"),
        F.max("last_line_at").alias("last_line_at"),
        F.max("last_write_at").alias("last_write_at"),
        F.max("written").alias("written"),
    )


def rules_response(log: DataFrame) -> DataFrame:
    """Outcome of rule requests.

    `log` has `action` (`add` or `delete`), `body`, and for adds the `value` and `tag`
    asked for.
    """
    body = F.col("body")
    summary = F.get_json_object(body, "$.meta.summary")
    errors = F.when(json_has_key(body, "errors"), F.coalesce(F.get_json_object(body, "$.errors"), F.lit("null")))
    read = log.withColumns(
        {
            "_errors": errors,
            "_summary": summary,
            "_rules": F.transform(
                json_items(json_field(body, "data")), lambda r: F.from_json(r, "id STRING, value STRING, tag STRING")
            ),
        }
    )
    read = read.withColumns(
        {
            f"_{n}": F.coalesce(json_int("_summary", n), F.lit(0))
            for n in ("invalid", "not_created", "not_deleted")
        }
    )
    wanted = F.get(
        F.filter("_rules", lambda r: (r["tag"] == F.col("tag")) & (r["value"] == F.col("value"))), 0
    )
    adding = F.col("action") == "add"
    refused = (
        F.col("_errors").isNotNull()
        | (adding & ((F.col("_invalid") > 0) | (F.col("_not_created") > 0)))
        | ((F.col("action") == "delete") & (F.col("_not_deleted") > 0))
    )
    parts = F.concat_ws(
        "; ", F.concat(F.lit("errors="), F.col("_errors")), F.concat(F.lit("summary="), F.col("_summary"))
    )
    blank_id = F.coalesce(wanted["id"], F.lit("")) == ""
    detail = (
        F.when(refused, F.coalesce(F.nullif(parts, F.lit("")), F.lit("unknown stream rules API failure")))
        .when(adding & wanted.isNull(), "expected rule was not returned")
        .when(adding & blank_id, "created rule id was not returned")
        .otherwise("")
    )
    return (
        read.withColumns({"detail": detail, "rule_id": F.when(adding, F.nullif(wanted["id"], F.lit("")))})
        .withColumn("outcome", F.when(F.col("detail") == "", "ok").otherwise("failed"))
        .drop("_errors", "_summary", "_invalid", "_not_created", "_not_deleted", "_rules")
    )


# Rows of a sketch are 2 ** SKETCH_BITS; its relative standard error is about 1.04 / sqrt(of that).
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def id_sketches(rows: DataFrame, keys: list[str], id_col: str = "id") -> DataFrame:
    """A1/A2: one sketch of the distinct ids per group, a few kilobytes whatever their number."""
    return rows.groupBy(*keys).agg(F.hll_sketch_agg(id_col, F.lit(SKETCH_BITS)).alias("sketch"))


def merged_sketches(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """A1: the sketch of several batches' ids together, from their sketches alone."""
    return sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))


def estimated_ids(sketches: DataFrame) -> DataFrame:
    """A1: `ids`, the estimated number of distinct ids of each sketch. It is off by more than
    three times `SKETCH_ERROR` (under 5 %) in fewer than one case of a hundred."""
    return sketches.withColumn("ids", F.hll_sketch_estimate("sketch")).drop("sketch")
