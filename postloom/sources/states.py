"""State documents as tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.coerce import bool_of, int_of, text_or

# Fields of a search state.
COLLECTOR_TEXTS = ("timestamp", "task_name", "query")
COLLECTOR_OPTIONAL = ("start_time_utc", "end_time_utc", "next_token")
COLLECTOR_COUNTS = ("page_count", "total_tweets", "total_includes")
# Fields of a stream state.
STREAM_COUNTS = (
    "connection_count",
    "total_tweets",
    "total_includes",
    "keepalive_count",
    "consecutive_failures",
    "seen_count",
    "db_size_bytes",
)
STREAM_TEXTS = (
    "timestamp",
    "task_name",
    "query",
    "rule_tag",
    "last_heartbeat_at",
    "last_event_at",
    "last_connected_at",
    "last_disconnect_at",
    "db_path",
    "stop_reason",
)
# Diagnostics; older documents hold them flat as `last_<name>`.
DIAGNOSTIC_TEXTS = ("error", "error_type", "error_detail")
DIAGNOSTIC_COUNTS = (
    "status",
    "rate_limit_limit",
    "rate_limit_remaining",
    "rate_limit_reset",
    "retry_after",
)


def read_documents(spark: SparkSession, path: str, pattern: str = "*.state.json") -> DataFrame:
    """One row per state document: `path`, `doc`. Documents are small single objects."""
    docs = spark.read.option("pathGlobFilter", pattern).text(path, wholetext=True)
    return docs.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("doc"))


def _ddl(texts: tuple[str, ...], typed: tuple[str, ...]) -> str:
    return ", ".join([f"{n} STRING" for n in texts] + [f"{n} VARIANT" for n in typed])


def _count(path: str) -> Column:
    return F.coalesce(int_of(path), F.lit(0))


def readable(docs: DataFrame) -> DataFrame:
    """Documents that are JSON objects; the rest count as no state."""
    return docs.where(F.json_object_keys("doc").isNotNull())


def collector_states(docs: DataFrame) -> DataFrame:
    """Search states; missing fields take their defaults."""
    ddl = _ddl(
        (*COLLECTOR_TEXTS, *COLLECTOR_OPTIONAL, "stop_reason", "converted_at"),
        (*COLLECTOR_COUNTS, "completed", "converted_jsonl_offset"),
    )
    s = readable(docs).withColumn("s", F.from_json("doc", ddl))
    return s.select(
        *[text_or(F.col(f"s.{n}")).alias(n) for n in COLLECTOR_TEXTS],
        *[F.col(f"s.{n}").alias(n) for n in COLLECTOR_OPTIONAL],
        *[_count(f"s.{n}").alias(n) for n in COLLECTOR_COUNTS],
        F.coalesce(bool_of("s.completed"), F.lit(False)).alias("completed"),
        text_or(F.col("s.stop_reason")).alias("stop_reason"),
        _count("s.converted_jsonl_offset").alias("converted_jsonl_offset"),
        text_or(F.col("s.converted_at")).alias("converted_at"),
    )


def stream_states(docs: DataFrame) -> DataFrame:
    """Stream states; flat `last_*` diagnostics of older documents are moved in."""
    legacy_texts = tuple(f"last_{n}" for n in DIAGNOSTIC_TEXTS)
    legacy_counts = tuple(f"last_{n}" for n in DIAGNOSTIC_COUNTS)
    ddl = _ddl(
        (*STREAM_TEXTS, "rule_id", "diagnostics", *legacy_texts),
        (*STREAM_COUNTS, "completed", *legacy_counts),
    )
    parsed = (
        readable(docs)
        .withColumn("s", F.from_json("doc", ddl))
        .withColumn("d", F.from_json("s.diagnostics", _ddl(DIAGNOSTIC_TEXTS, DIAGNOSTIC_COUNTS)))
    )
    nested = F.col("s.diagnostics").isNotNull()
    diagnostics = F.struct(
        *[
            F.when(nested, text_or(F.col(f"d.{n}"))).otherwise(text_or(F.col(f"s.last_{n}"))).alias(n)
            for n in DIAGNOSTIC_TEXTS
        ],
        *[
            F.when(nested, _count(f"d.{n}")).otherwise(_count(f"s.last_{n}")).alias(n)
            for n in DIAGNOSTIC_COUNTS
        ],
    )
    return parsed.select(
        *[text_or(F.col(f"s.{n}")).alias(n) for n in STREAM_TEXTS],
        F.col("s.rule_id").alias("rule_id"),
        *[_count(f"s.{n}").alias(n) for n in STREAM_COUNTS],
        F.coalesce(bool_of("s.completed"), F.lit(False)).alias("completed"),
        diagnostics.alias("diagnostics"),
    )
