from pyspark.sql import functions as F

from postloom.functions.clock import local_time_error, local_to_utc, utc_text
from postloom.functions.coerce import json_bool, json_int
from postloom.functions.responses import classify_responses
from postloom.functions.texts import error_detail, error_metadata, read_errors, safe_text, stream_payload
from postloom.operators.filters import keyword_match, query_text
from postloom.plans.catalog_filter import local_times
from postloom.operators.rules import reconcile_rules
from postloom.operators.stats import rules_response


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, v STRING")
    return [r.out for r in df.select("i", expr.alias("out")).orderBy("i").collect()]


def test_typed_values(spark):
    docs = [f'{{"v":{v}}}' for v in ("null", "3", "3.0", "3.14", '"123"', '"x"', "true", '"3.0"')]
    assert column(spark, docs, json_int("v", "v")) == [None, 3, 3, None, 123, None, 1, None]
    docs = [f'{{"v":{v}}}' for v in ("null", "true", "1", "0", '"TRUE"', '" no "', '"maybe"', "1.0")]
    assert column(spark, docs, json_bool("v", "v")) == [None, True, True, False, True, False, None, None]


def test_local_times(spark):
    texts = ["2026-01-01T00:00:00", " ", "nonsense"]
    assert column(spark, texts, utc_text(local_to_utc(F.col("v"), F.lit("Asia/Tokyo")))) == [
        "2025-12-31T15:00:00Z", None, None,
    ]
    texts = ["2026-03-08T02:30:00", "2026-11-01T01:30:00", "2026-07-01T00:00:00", "bad", ""]
    assert column(spark, texts, local_time_error(F.col("v"), F.lit("America/New_York"))) == [
        "nonexistent_time", "ambiguous_time", None, "unreadable_time", None,
    ]


def test_a_local_time_is_read_once(spark, tmp_path):
    spark.range(20).selectExpr("id AS event_id", "timestamp_ntz'2024-01-01' AS ts").write.parquet(str(tmp_path / "events.parquet"))
    rows = local_times(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == 1
    assert {(r.utc, r.error) for r in rows.collect()} == {
        (None, None), ("2023-12-31T15:00:00Z", None), ("2024-01-01T00:00:00Z", None), ("2024-01-01T05:00:00Z", None),
    }


def test_stream_payload(spark):
    lines = ["", " \r", "data:", "[DONE]", "data: {}", '{"a":1}\r']
    assert column(spark, lines, stream_payload(F.col("v"))) == [None, None, None, None, "{}", '{"a":1}']


def test_safe_text(spark):
    df = spark.createDataFrame([(bytearray(b"ok \xc3\xa9"),), (bytearray(b"\x8b\xff" * 30),)], "b BINARY")
    good, bad = [r[0] for r in df.select(safe_text(F.col("b"))).collect()]
    assert good == "ok é"
    assert bad == "<non-UTF-8 response body: 60 bytes; hex=" + "8bff" * 24 + "...>"


def test_query_text_and_keywords(spark):
    df = spark.createDataFrame([(["foo", "bar baz", '"done it"', 'a "b"', " "],)], "k ARRAY<STRING>")
    text = df.select(query_text(F.col("k"), F.lit(" lang:en "), F.lit(True))).head()[0]
    assert text == '(foo OR "bar baz" OR "done it" OR "a \\"b\\"") lang:en -is:retweet'
    hits = column(spark, ["a Foo.", "food", "bar\n baz!", "ÊTRE"], keyword_match(F.col("v"), ["foo", "bar baz", "être"]))
    assert hits == [True, False, True, True]


def test_error_bodies(spark):
    bodies = ['{"title":"T","detail":"D"}', '{"errors":[{"title":"E","status":4},{"detail":"x"}]}', "oops", "  "]
    df = read_errors(spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i INT, body STRING"))
    rows = df.orderBy("i").select(error_metadata().alias("m"), error_detail().alias("d")).collect()
    assert [tuple(r.m) for r in rows] == [("", "T", "D"), ("", "E", ""), ("", "", "oops"), ("", "", "")]
    assert [r.d for r in rows] == ["T | D", "E / 4 | x", "oops", ""]


def test_response_outcomes(spark):
    rows = [
        (1, 200, "", None, None),
        (2, 429, '{"detail":"Usage cap exceeded"}', None, None),
        (3, 429, '{"title":"Too many"}', None, "1005"),
        (4, 429, "", "300", None),
        (5, 503, "", None, None),
        (6, 403, '{"title":"no"}', None, None),
    ]
    log = spark.createDataFrame(rows, "i INT, status INT, body STRING, retry_after STRING, rate_limit_reset STRING")
    log = log.withColumns(
        {
            "rate_limit_limit": F.lit(None).cast("string"),
            "rate_limit_remaining": F.lit("x"),
            "now_epoch": F.lit(1000),
        }
    )
    got = classify_responses(log).orderBy("i").select("kind", "stop_reason", "wait_seconds").collect()
    assert [tuple(r) for r in got] == [
        ("ok", "", 0),
        ("terminal", "usage_capped", 0),
        ("retryable", "rate_limited", 60),
        ("retryable", "rate_limited", 300),
        ("retryable", "server_error", 0),
        ("error", "api_error", 0),
    ]


def test_rules(spark):
    desired = spark.createDataFrame(
        [("a", "1", False), ("b", "1", False), ("c", "1", False), ("d", "1", True), ("e", "1", True)],
        "tag STRING, value STRING, replace BOOLEAN",
    )
    current = spark.createDataFrame(
        [("i1", "1", "a"), ("i2", "0", "c"), ("i3", "0", "d"), ("i4", "2", "d"), ("", "0", "e"), ("i9", "0", "z")],
        "id STRING, value STRING, tag STRING",
    )
    got = reconcile_rules(desired, current).orderBy("tag", "step", "rule_id").collect()
    assert [(r.tag, r.step, r.action, r.rule_id) for r in got] == [
        ("a", 1, "reuse", "i1"),
        ("b", 1, "create", None),
        ("c", 1, "conflict", None),
        ("d", 1, "create", None),
        ("d", 2, "delete", "i3"),
        ("d", 2, "delete", "i4"),
        ("e", 1, "error", None),
    ]
    log = spark.createDataFrame(
        [(1, "add", '{"data":[{"id":"9","value":"v","tag":"t"}]}'), (2, "add", '{"data":[{"id":"","value":"v","tag":"t"}]}'),
         (3, "add", "{}"), (4, "delete", '{"errors":[]}')],
        "i INT, action STRING, body STRING",
    ).withColumns({"value": F.lit("v"), "tag": F.lit("t")})
    got = rules_response(log).orderBy("i").collect()
    assert [(r.outcome, r.rule_id) for r in got] == [("ok", "9"), ("failed", None), ("failed", None), ("failed", None)]
