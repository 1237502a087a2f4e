"""Task settings: dataclasses, tables of tasks and their normalization."""

from __future__ import annotations

from dataclasses import asdict, dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions.coerce import strip

# Posts per page.
MAX_RESULTS_RECENT = 100
MAX_RESULTS_ALL = 500
MIN_RESULTS = 10


@dataclass(frozen=True)
class SearchTask:
    """Settings of a search task; times are local to `local_tz_name`."""

    task_name: str
    keywords: tuple[str, ...]
    extra_query_tail: str = ""
    exclude_reposts: bool = True
    start_time: str = ""
    end_time: str = ""
    local_tz_name: str = "Asia/Tokyo"
    search_mode: str = "auto"
    use_state_highwater_start: bool = True
    highwater_overlap_seconds: int = 30
    window_hours: int | None = 24
    now_lag_seconds: int = 45
    target_posts: int = 0
    drain_to_cap: bool = False
    usage_check_every_pages: int = 5
    usage_days: int = 7
    max_results: int = 100
    write_includes: bool = True
    force_resume_on_mismatch: bool = False
    skip_if_completed_same_window: bool = True
    convert_incremental: bool = True
    convert_batch_size: int = 50_000
    emit_csv: bool = True
    emit_columnar: bool = False
    columnar_append: bool = True


@dataclass(frozen=True)
class StreamTask:
    """Settings of a stream task."""

    task_name: str
    keywords: tuple[str, ...]
    extra_query_tail: str = ""
    exclude_reposts: bool = True
    rule_tag: str = ""
    manage_rules: bool = True
    replace_rule_by_tag: bool = False
    max_posts: int = 0
    max_seconds: float = 0.0
    idle_timeout_seconds: int = 120
    http_readtimeout_seconds: int = 0
    reconnect: bool = True
    max_reconnects: int = 0
    reconnect_initial_delay_seconds: float = 60.0
    reconnect_max_delay_seconds: float = 320.0
    write_includes: bool = True
    field_profile: str = "full"
    rotate_records: int = 0
    rotate_seconds: float = 0.0
    state_flush_interval_seconds: float = 30.0
    convert_incremental: bool = True
    convert_batch_size: int = 50_000
    emit_csv: bool = True
    emit_columnar: bool = False
    columnar_append: bool = True


_SPARK_TYPES = {
    "str": T.StringType(),
    "bool": T.BooleanType(),
    "int": T.LongType(),
    "int | None": T.LongType(),
    "float": T.DoubleType(),
    "tuple[str, ...]": T.ArrayType(T.StringType()),
}


def task_table(spark: SparkSession, tasks: list[SearchTask] | list[StreamTask]) -> DataFrame:
    """A table with one row per configured task."""
    kind = type(tasks[0])
    schema = T.StructType([T.StructField(f.name, _SPARK_TYPES[f.type]) for f in fields(kind)])
    rows = [{**asdict(t), "keywords": list(t.keywords)} for t in tasks]
    return spark.createDataFrame(rows, schema)


def _clamp(col: str, low, high=None) -> Column:
    kept = F.greatest(F.col(col), F.lit(low))
    if high is not None:
        kept = F.least(kept, F.lit(high))
    # `greatest` would turn a null into the bound.
    return F.when(F.col(col).isNotNull(), kept)


def _errors(checks: dict[str, Column]) -> Column:
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for text, bad in checks.items()]))


def _blank(col: str) -> Column:
    return F.coalesce(F.col(col), F.lit("")) == ""


def _no_keywords() -> Column:
    return F.coalesce(F.size("keywords"), F.lit(0)) <= 0


def normalize_search_tasks(tasks: DataFrame, zones: list[str] | None = None) -> DataFrame:
    """Clamped settings and `errors`, empty when the task may run."""
    checks = {
        "task_name is empty": _blank("task_name"),
        "keywords are empty": _no_keywords(),
        "invalid search_mode": ~F.coalesce(F.col("search_mode").isin("auto", "recent", "all"), F.lit(False)),
        "window_hours must be positive or null": F.coalesce(F.col("window_hours") <= 0, F.lit(False)),
        "unknown time zone": ~F.coalesce(F.col("local_tz_name").isin(*(zones or known_zones())), F.lit(False)),
    }
    return tasks.withColumn("errors", _errors(checks)).withColumns(
        {
            "highwater_overlap_seconds": _clamp("highwater_overlap_seconds", 0),
            "now_lag_seconds": _clamp("now_lag_seconds", 0),
            "convert_batch_size": _clamp("convert_batch_size", 1),
            "target_posts": _clamp("target_posts", 0),
            "usage_check_every_pages": _clamp("usage_check_every_pages", 0),
            "usage_days": _clamp("usage_days", 1, 90),
            "max_results": _clamp("max_results", MIN_RESULTS, MAX_RESULTS_ALL),
        }
    )


def page_size(max_results: Column, endpoint: Column) -> Column:
    """Posts per page once the endpoint is known."""
    top = F.when(endpoint == "all", MAX_RESULTS_ALL).otherwise(MAX_RESULTS_RECENT)
    return F.least(F.greatest(max_results, F.lit(MIN_RESULTS)), top)


def normalize_stream_tasks(tasks: DataFrame) -> DataFrame:
    """P12 for stream tasks; a blank rule tag becomes the task name."""
    checks = {
        "task_name is empty": _blank("task_name"),
        "keywords are empty": _no_keywords(),
        "invalid field_profile": ~F.coalesce(
            F.col("field_profile").isin("full", "lean", "minimal"), F.lit(False)
        ),
    }
    tag = strip(F.coalesce("rule_tag", F.lit("")))
    first_delay = F.greatest(F.col("reconnect_initial_delay_seconds"), F.lit(0.1))
    zero = ("max_posts", "http_readtimeout_seconds", "max_reconnects", "rotate_records")
    return tasks.withColumn("errors", _errors(checks)).withColumns(
        {
            "rule_tag": F.when(tag == "", F.col("task_name")).otherwise(tag),
            **{c: _clamp(c, 0) for c in zero},
            **{c: _clamp(c, 0.0) for c in ("max_seconds", "rotate_seconds", "state_flush_interval_seconds")},
            "idle_timeout_seconds": _clamp("idle_timeout_seconds", 1),
            "convert_batch_size": _clamp("convert_batch_size", 1),
            "reconnect_initial_delay_seconds": first_delay,
            "reconnect_max_delay_seconds": F.greatest(F.col("reconnect_max_delay_seconds"), first_delay),
        }
    )


def known_zones() -> list[str]:
    from zoneinfo import available_timezones

    return sorted(available_timezones())
