from pyspark.sql import functions as F

import postloom
from postloom import SearchTask, StreamTask, normalize_search_tasks, normalize_stream_tasks, task_table
from postloom.runtime import shared_dir

STATE = "task_name STRING, query STRING, end_time_utc STRING, completed BOOLEAN"


def plan(spark, tasks, states=(), as_of="2026-01-10 00:00:00"):
    table = normalize_search_tasks(task_table(spark, tasks))
    saved = spark.createDataFrame(list(states), STATE)
    rows = postloom.resolve_windows(table, saved, F.lit(as_of).cast("timestamp_ntz")).collect()
    return {r.task_name: r for r in rows}


def test_windows(spark):
    base = dict(keywords=("foo",), local_tz_name="UTC", now_lag_seconds=0)
    got = plan(
        spark,
        [
            SearchTask("window", **base),
            SearchTask("explicit", start_time="2026-01-08T00:00:00", end_time="2026-01-09T00:00:00", **base),
            SearchTask("high", **base),
            SearchTask("other_query", **base),
            SearchTask("future", end_time="2027-01-01T00:00:00", **base),
            SearchTask("old_recent", end_time="2025-12-01T00:00:00", search_mode="recent", **base),
            SearchTask("old_auto", end_time="2025-12-01T00:00:00", **base),
            SearchTask("clipped", start_time="2025-01-01T00:00:00", search_mode="recent", **base),
            SearchTask("turned", start_time="2026-01-09T00:00:00", end_time="2026-01-08T00:00:00", **base),
            SearchTask("open", window_hours=None, **base),
            SearchTask("tokyo", keywords=("a b",), end_time="2026-01-09T09:00:00", now_lag_seconds=0),
        ],
        [
            ("high", "(foo) -is:retweet", "2026-01-09T12:00:00Z", True),
            ("other_query", "(bar) -is:retweet", "2026-01-09T12:00:00Z", True),
        ],
    )
    spans = {n: (r.start_time_utc, r.end_time_utc) for n, r in got.items()}
    assert spans["window"] == ("2026-01-09T00:00:00Z", "2026-01-10T00:00:00Z")
    assert spans["explicit"] == ("2026-01-08T00:00:00Z", "2026-01-09T00:00:00Z")
    assert spans["high"] == ("2026-01-09T11:59:30Z", "2026-01-10T00:00:00Z")
    assert spans["other_query"] == spans["window"]
    assert spans["future"] == spans["window"]
    assert got["old_recent"].error == "end_time is older than the recent look-back"
    assert (got["old_auto"].endpoint, spans["old_auto"][0]) == ("all", "2025-11-30T00:00:00Z")
    assert spans["clipped"][0] == "2026-01-03T00:00:00Z"
    assert got["turned"].error == "start_time >= end_time"
    assert spans["open"] == (None, "2026-01-10T00:00:00Z")
    assert spans["tokyo"] == ("2026-01-08T00:00:00Z", "2026-01-09T00:00:00Z")
    assert got["tokyo"].query == '("a b") -is:retweet'


def test_stream_task_defaults(spark):
    r = normalize_stream_tasks(task_table(spark, [StreamTask("s", ("x",), max_posts=-1, idle_timeout_seconds=0)])).head()
    assert (r.rule_tag, r.max_posts, r.idle_timeout_seconds, r.errors) == ("s", 0, 1, [])


def test_shared_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_public_names(spark):
    assert all(hasattr(postloom, name) for name in postloom.__all__)


def test_windows_are_planned_once(spark):
    """The steps behind the planned tasks read them from a table."""
    from postloom.plans import catalog_plan

    for roll in (catalog_plan.state_roll, catalog_plan.resume_decision):
        plan = roll(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
        assert "convert_timezone" not in plan
