"""Collected social-post data on Spark: logs, dedup, flat rows, planning, gaps, streams."""

from .operators.flatten import flatten
from .operators.order import page_scope, segment_records
from .operators.rules import reconcile_rules
from .plans.collect import collect_events, collect_pages
from .plans.convert import convert, convert_wide
from .plans.tasks import (
    SearchTask,
    StreamTask,
    normalize_search_tasks,
    normalize_stream_tasks,
    task_table,
)
from .plans.windows import resolve_windows, resume_decisions, reuse_stream_state, roll_forward
from .runtime import configure
from .schema import FLAT_SCHEMA
from .sources.states import collector_states, stream_states
from .streaming.jobs import collect_stream, convert_stream, gap_stream, progress_stream

__all__ = [
    "FLAT_SCHEMA",
    "SearchTask",
    "StreamTask",
    "collect_events",
    "collect_pages",
    "collect_stream",
    "collector_states",
    "configure",
    "convert",
    "convert_stream",
    "convert_wide",
    "flatten",
    "gap_stream",
    "normalize_search_tasks",
    "normalize_stream_tasks",
    "page_scope",
    "progress_stream",
    "reconcile_rules",
    "resolve_windows",
    "resume_decisions",
    "reuse_stream_state",
    "roll_forward",
    "segment_records",
    "stream_states",
    "task_table",
]
