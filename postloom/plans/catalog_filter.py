"""Predicates, rules and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clock import local_time, local_time_error, utc_text
from ..functions.coerce import (
    blank_to_null,
    json_bool,
    json_has_key,
    json_int,
    json_items,
    json_pairs,
    json_text,
    text_or,
)
from ..functions.responses import classify_responses, wait_seconds
from ..functions.texts import (
    ascii_lower,
    error_detail,
    error_metadata,
    is_archive_denied,
    is_invalid_page_token,
    is_timeout,
    read_errors,
    safe_text,
    stream_payload,
)
from ..operators.filters import (
    Rule,
    keyword_match,
    match_rule_table,
    match_rules,
    post_filter,
    query_text,
    time_range,
)
from ..operators.rules import reconcile_rules
from ..operators.stats import rules_response, usage_summary
from ..operators.tails import tail_filter
from .registry import query
from .views import document_posts, table, text

B = r"(^|[^\p{L}\p{N}_])"
E = r"([^\p{L}\p{N}_]|$)"
TERMS = ["of the", "Heed", '"and on"', "  "]


@query(
    "keyword_match",
    rf"SELECT doc_id AS id, regexp_matches(text, '(?i){B}(of\s+the|heed|and\s+on){E}') AS hit FROM documents",
)
def keywords(spark: SparkSession, sf: str) -> DataFrame:
    """P3 over whole texts."""
    return document_posts(spark, sf).select("id", keyword_match(F.col("text"), TERMS).alias("hit"))


@query(
    "post_filters",
    """
SELECT doc_id AS id FROM documents WHERE lang = 'en' AND doc_id % 5 NOT IN (0, 2)
""",
)
def post_filters(spark: SparkSession, sf: str) -> DataFrame:
    """P4, P5"""
    return document_posts(spark, sf).where(post_filter("en", exclude_replies=True)).select("id")


TAIL = 'lang:en -is:reply ("of the" OR heed -(is:retweet and))'


@query(
    "tail_filter",
    rf"""
SELECT doc_id AS id FROM documents WHERE lang = 'en' AND doc_id % 5 <> 2 AND (regexp_matches(text, '(?i){B}of\s+the{E}')
  OR regexp_matches(text, '(?i){B}heed{E}') AND NOT (doc_id % 5 = 0 AND regexp_matches(text, '(?i){B}and{E}')))
""",
)
def tail_filters(spark: SparkSession, sf: str) -> DataFrame:
    """P5: a tail as free text."""
    return document_posts(spark, sf).where(tail_filter(TAIL)).select("id")


@query(
    "time_range",
    """
SELECT event_id FROM events
WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND ts < TIMESTAMP '2024-01-09 12:00:00'
""",
)
def in_time_range(spark: SparkSession, sf: str) -> DataFrame:
    """P6"""
    start, end = (F.lit(t).cast("timestamp_ntz") for t in ("2024-01-05 00:00:00", "2024-01-09 12:00:00"))
    return table(spark, sf, "events").where(time_range(F.col("ts"), start, end)).select("event_id")


RULES = [
    Rule("r1", "articles", ("the", "le", "der")),
    Rule("r2", "phrase", ("of the",), lang="en"),
    Rule("r3", "fresh", ("and", "que"), exclude_reposts=True),
]


@query(
    "rule_match",
    rf"""
SELECT id, string_agg(rule, ';' ORDER BY rule) AS rules FROM (
  SELECT doc_id AS id, 'r1/articles' AS rule FROM documents WHERE regexp_matches(text, '(?i){B}(the|le|der){E}')
  UNION ALL SELECT doc_id, 'r2/phrase' FROM documents WHERE lang = 'en' AND regexp_matches(text, '(?i){B}(of\s+the){E}')
  UNION ALL SELECT doc_id, 'r3/fresh' FROM documents WHERE doc_id % 5 <> 0 AND regexp_matches(text, '(?i){B}(and|que){E}'))
GROUP BY id
""",
)
def rule_match(spark: SparkSession, sf: str) -> DataFrame:
    """J10 for configured rules."""
    hits = match_rules(document_posts(spark, sf), RULES).where(F.size("matching_rules") > 0)
    names = F.transform("matching_rules", lambda r: F.concat(r["id"], F.lit("/"), r["tag"]))
    return hits.select("id", F.array_join(names, ";").alias("rules"))


@query(
    "rule_match_table",
    rf"""
WITH words AS (
  SELECT item_id, regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+') AS w,
         regexp_replace(lower(trim(text)), '\s+', ' ', 'g') AS whole FROM benchmark),
docs AS (
  SELECT doc_id, text, regexp_replace(lower(text), '\s+', ' ', 'g') AS flat,
         list_distinct(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}_]+')) AS w FROM documents),
hits AS (
  SELECT doc_id AS id, item_id || '/word' AS rule FROM docs, words WHERE list_contains(docs.w, words.w[1])
  UNION ALL
  SELECT doc_id, 'p' || item_id || '/phrase' FROM docs, words
  WHERE CASE WHEN contains(flat, whole) THEN regexp_matches(text, '(?i){B}(' || regexp_replace(
    regexp_replace(whole, '([^\p{{L}}\p{{N}}_\s])', '\\\1', 'g'), '\s+', '\\s+', 'g') || '){E}') ELSE false END)
SELECT id, string_agg(rule, ';' ORDER BY rule) AS rules FROM hits GROUP BY id
""",
)
def rule_match_by_table(spark: SparkSession, sf: str) -> DataFrame:
    """J10 for a table of rules: the first word and the whole text of each benchmark item."""
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))
    w = table(spark, sf, "benchmark").select(text(F.col("item_id")).alias("item"), words.alias("w"), "text")
    single = w.select(F.col("item").alias("rule_id"), F.lit("word").alias("tag"), F.col("w")[0].alias("term"))
    phrase = w.select(F.concat(F.lit("p"), "item").alias("rule_id"), F.lit("phrase").alias("tag"), F.col("text").alias("term"))
    hits = match_rule_table(document_posts(spark, sf), single.unionByName(phrase))
    names = F.transform("matching_rules", lambda r: F.concat(r["id"], F.lit("/"), r["tag"]))
    return hits.select("id", F.array_join(F.array_sort(names), ";").alias("rules"))


@query(
    "query_text",
    r"""
SELECT p_partkey, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE
  '(' || p_brand || CASE WHEN p_partkey % 2 = 0 THEN ' OR "' || p_name || '"' ELSE '' END ||
  CASE WHEN p_partkey % 3 = 0 THEN ' OR "say \"' || p_type || '\""' ELSE '' END || ')' ||
  CASE WHEN p_partkey % 5 = 0 THEN ' lang:en' ELSE '' END ||
  CASE WHEN p_size % 2 = 0 THEN ' -is:retweet' ELSE '' END END AS query
FROM part
""",
)
def query_texts(spark: SparkSession, sf: str) -> DataFrame:
    """Query text of keyword lists."""
    k = F.col("p_partkey")
    terms = F.array(
        F.when(k % 7 == 0, " ").otherwise(F.concat(F.lit(" "), "p_brand")),
        F.when((k % 2 == 0) & (k % 7 != 0), F.when(k % 4 == 0, F.concat(F.lit('"'), "p_name", F.lit('"'))).otherwise(F.col("p_name"))).otherwise(""),
        F.when((k % 3 == 0) & (k % 7 != 0), F.concat(F.lit('say "'), "p_type", F.lit('"'))).otherwise("  "),
    )
    tail = F.when(k % 5 == 0, " lang:en ").otherwise("")
    return table(spark, sf, "part").select(
        "p_partkey", query_text(terms, tail, F.col("p_size") % 2 == 0).alias("query")
    )


# JSON values of every type, chosen by the part key.
def any_value() -> Column:
    """A JSON value of a type chosen by the part key."""
    kind, size = F.col("p_partkey") % 9, text(F.col("p_size"))
    return (
        F.when(kind == 0, "null")
        .when(kind == 1, text(F.col("p_partkey")))
        .when(kind == 2, F.concat(size, F.lit(".0")))
        .when(kind == 3, F.concat(size, F.lit(".25")))
        .when(kind == 4, F.concat(F.lit('" '), size, F.lit(' "')))
        .when(kind == 5, "true")
        .when(kind == 6, '" No "')
        .when(kind == 7, '"3.0"')
        .otherwise('{"a":1}')
    )


@query(
    "coerce_values",
    """
SELECT p_partkey,
  CASE p_partkey % 9 WHEN 1 THEN p_partkey WHEN 2 THEN CAST(p_size AS BIGINT) WHEN 4 THEN CAST(p_size AS BIGINT)
       WHEN 5 THEN CAST(1 AS BIGINT) END AS as_int,
  CASE p_partkey % 9 WHEN 1 THEN p_partkey <> 0 WHEN 4 THEN CASE p_size WHEN 1 THEN true WHEN 0 THEN false END
       WHEN 5 THEN true WHEN 6 THEN false END AS as_bool,
  CASE p_partkey % 9 WHEN 0 THEN '' WHEN 1 THEN CAST(p_partkey AS VARCHAR) WHEN 2 THEN p_size || '.0'
       WHEN 3 THEN p_size || '.25' WHEN 4 THEN ' ' || p_size || ' ' WHEN 5 THEN 'true' WHEN 6 THEN ' No '
       WHEN 7 THEN '3.0' ELSE '{"a":1}' END AS as_text,
  true AS has_v, false AS has_w,
  CASE WHEN p_size % 2 = 0 THEN p_type END AS maybe
FROM part
""",
)
def coerce_values(spark: SparkSession, sf: str) -> DataFrame:
    """F1-F6, F9"""
    doc = F.concat(F.lit('{"v":'), any_value(), F.lit("}"))
    return table(spark, sf, "part").withColumn("doc", doc).select(
        "p_partkey",
        json_int("doc", "v").alias("as_int"),
        json_bool("doc", "v").alias("as_bool"),
        text_or(F.from_json("doc", "v STRING")["v"]).alias("as_text"),
        json_has_key(F.col("doc"), "v").alias("has_v"),
        json_has_key(F.col("doc"), "w").alias("has_w"),
        blank_to_null(F.when(F.col("p_size") % 2 == 0, F.col("p_type")).otherwise("")).alias("maybe"),
    )


@query(
    "json_parts",
    """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE '{"x":' || o_orderkey || '}|5|' || o_orderstatus END AS items,
  'b=' || o_orderkey || '|a=[1,2]' AS pairs,
  '{"b":' || o_orderkey || ',"a":[1,2]}' AS compact
FROM orders
""",
)
def json_parts(spark: SparkSession, sf: str) -> DataFrame:
    """F7, F8, F10"""
    k = text(F.col("o_orderkey"))
    items = F.when(F.col("o_orderkey") % 3 == 0, '{"no":"array"}').otherwise(
        F.concat(F.lit('[ {"x": '), k, F.lit('}, 5, "'), "o_orderstatus", F.lit('"]'))
    )
    obj = F.concat(F.lit('{"b": '), k, F.lit(', "a": [1, 2]}'))
    pairs = F.transform(json_pairs(obj), lambda p: F.concat(p["key"], F.lit("="), p["value"]))
    return table(spark, sf, "orders").select(
        "o_orderkey",
        F.array_join(json_items(items), "|").alias("items"),
        F.array_join(pairs, "|").alias("pairs"),
        json_text(obj).alias("compact"),
    )


@query(
    "local_to_utc",
    """
WITH t AS (
  SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS local, date_trunc('second', ts) AS l,
         CASE event_id % 3 WHEN 0 THEN 'Asia/Tokyo' WHEN 1 THEN 'UTC' ELSE 'America/New_York' END AS zone FROM events)
SELECT event_id, CASE WHEN event_id % 10 = 9 THEN NULL ELSE
  strftime(timezone('UTC', timezone(zone, l)), '%Y-%m-%dT%H:%M:%SZ') END AS utc, CAST(NULL AS VARCHAR) AS error FROM t
""",
)
def local_times(spark: SparkSession, sf: str) -> DataFrame:
    """F12, F13"""
    e = F.col("event_id")
    zone = F.when(e % 3 == 0, "Asia/Tokyo").when(e % 3 == 1, "UTC").otherwise("America/New_York")
    local = F.when(e % 10 == 9, "  ").otherwise(F.date_format("ts", " yyyy-MM-dd'T'HH:mm:ss "))
    texts = table(spark, sf, "events").select("event_id", local.alias("text"), zone.alias("zone"))
    times = texts.withColumn("local", local_time(F.col("text"))).withColumn(
        "utc", F.convert_timezone(F.col("zone"), F.lit("UTC"), F.col("local"))
    )
    error = local_time_error(F.col("text"), F.col("zone"), F.col("local"), F.col("utc"))
    return times.select("event_id", utc_text(F.col("utc")).alias("utc"), error.alias("error"))


@query(
    "stream_payload",
    """
SELECT event_id, CASE event_type WHEN 'view' THEN NULL WHEN 'error' THEN NULL WHEN 'signup' THEN NULL
  WHEN 'purchase' THEN props ELSE 'data' || event_id END AS payload FROM events
""",
)
def payloads(spark: SparkSession, sf: str) -> DataFrame:
    """F15"""
    t = F.col("event_type")
    line = (
        F.when(t == "view", "\t \r")
        .when(t == "error", " [DONE] ")
        .when(t == "signup", "data:  ")
        .when(t == "purchase", F.concat(F.lit("data:  "), "props", F.lit("\r")))
        .otherwise(F.concat(F.lit(" data"), text(F.col("event_id"))))
    )
    return table(spark, sf, "events").select("event_id", stream_payload(line).alias("payload"))


@query(
    "text_classes",
    r"""
WITH d AS (SELECT doc_id, text, lower(regexp_replace(text, '[^\x00-\x7F]', ' ', 'g')) AS t FROM documents)
SELECT doc_id, t AS ascii_text,
  (contains(t, 'next_token') OR contains(t, 'pagination')) AND contains(t, 'token') AND contains(t, 'invalid')
    OR doc_id % 4 = 0 AS bad_token,
  doc_id % 3 = 0 AND (contains(t, 'access') OR contains(t, 'upgrade') OR contains(t, 'enterprise') OR
    contains(t, 'self-serve') OR contains(t, 'full-archive') OR contains(t, 'full archive') OR doc_id % 5 = 0) AS denied,
  contains(t, 'timeout') OR contains(t, 'timed out') OR doc_id % 6 = 0 AS timeout,
  text AS safe
FROM d
""",
)
def text_classes(spark: SparkSession, sf: str) -> DataFrame:
    """F16, F17, F22 over whole texts."""
    d, body = F.col("doc_id"), F.col("text")
    status = F.when(d % 3 == 0, 403).otherwise(400)
    url = F.lit("https://api.example/2/tweets/search/all?x=1")
    plus = lambda cond, word: F.concat(body, F.when(cond, word).otherwise(""))
    return table(spark, sf, "documents").select(
        "doc_id",
        ascii_lower(body).alias("ascii_text"),
        is_invalid_page_token(plus(d % 4 == 0, " Invalid Next_Token")).alias("bad_token"),
        is_archive_denied(status, url, plus(d % 5 == 0, " UPGRADE")).alias("denied"),
        is_timeout(plus(d % 6 == 0, " Timed out")).alias("timeout"),
        safe_text(body.cast("binary")).alias("safe"),
    )


@query(
    "binary_bodies",
    """
SELECT o_orderkey, '<non-UTF-8 response body: ' || (3 + length(o_orderpriority)) || ' bytes; hex=8bff20' ||
  lower(hex(o_orderpriority::BLOB)) || '>' AS safe FROM orders
""",
)
def binary_bodies(spark: SparkSession, sf: str) -> DataFrame:
    """bodies that are not UTF-8."""
    body = F.concat(F.lit(bytearray(b"\x8b\xff\x20")), F.col("o_orderpriority").cast("binary"))
    return table(spark, sf, "orders").select("o_orderkey", safe_text(body).alias("safe"))


@query(
    "error_texts",
    """
SELECT event_id,
  CASE event_id % 4 WHEN 0 THEN 'about:blank' ELSE '' END AS type,
  CASE event_id % 4 WHEN 0 THEN event_type WHEN 1 THEN 'T' || user_id ELSE '' END AS title,
  CASE event_id % 4 WHEN 0 THEN 'd' || user_id WHEN 2 THEN 'plain ' || event_type ELSE '' END AS detail,
  CASE event_id % 4 WHEN 0 THEN event_type || ' | d' || user_id
    WHEN 1 THEN 'T' || user_id || ' / 403 | x' WHEN 2 THEN 'plain ' || event_type ELSE '' END AS text
FROM events
""",
)
def error_texts(spark: SparkSession, sf: str) -> DataFrame:
    """F18, F19, U4"""
    e, u = F.col("event_id"), text(F.col("user_id"))
    full = F.to_json(
        F.struct(F.lit("about:blank").alias("type"), F.col("event_type").alias("title"), F.concat(F.lit("d"), u).alias("detail"))
    )
    listed = F.concat(
        F.lit('{"errors":[{"title":"T'), u, F.lit('","status":403},{"detail":" x "},{"detail":"x"}]}')
    )
    body = F.when(e % 4 == 0, full).when(e % 4 == 1, listed).when(
        e % 4 == 2, F.concat(F.lit(" plain "), "event_type")
    ).otherwise("  ")
    read = read_errors(table(spark, sf, "events").withColumn("body", body)).withColumn("m", error_metadata())
    return read.select("event_id", "m.type", "m.title", "m.detail", error_detail().alias("text"))


@query(
    "classify_responses",
    """
WITH r AS (
  SELECT event_id, CASE event_type WHEN 'view' THEN 200 WHEN 'error' THEN 429 WHEN 'signup' THEN 429
                        WHEN 'click' THEN 503 ELSE 403 END AS status, event_type AS t, user_id AS u FROM events)
SELECT event_id, status,
  CASE t WHEN 'view' THEN '' WHEN 'error' THEN 'usage_capped' WHEN 'signup' THEN 'rate_limited'
         WHEN 'click' THEN 'server_error' ELSE 'api_error' END AS stop_reason,
  CASE t WHEN 'view' THEN 'ok' WHEN 'error' THEN 'terminal' WHEN 'signup' THEN 'retryable'
         WHEN 'click' THEN 'retryable' ELSE 'error' END AS kind,
  CASE WHEN t = 'signup' THEN greatest(60, u, CASE WHEN u % 2 = 0 THEN 81 ELSE 0 END) ELSE 0 END AS wait_seconds,
  CASE t WHEN 'view' THEN '' WHEN 'error' THEN 'usage cap exceeded' WHEN 'signup' THEN 'rate limited'
         WHEN 'click' THEN 'server error' ELSE 'api error' END AS error,
  CASE t WHEN 'view' THEN '' WHEN 'purchase' THEN 'api_error' WHEN 'click' THEN '' ELSE 'about:blank' END AS error_type,
  CASE t WHEN 'view' THEN '' WHEN 'error' THEN 'Usage-Capped now' WHEN 'click' THEN 'plain ' || u
         WHEN 'signup' THEN 'slow down' ELSE 'No | slow down' END AS error_detail,
  CASE WHEN t IN ('view', 'purchase') THEN CAST(0 AS BIGINT) ELSE u END AS retry_after
FROM r
""",
)
def classified(spark: SparkSession, sf: str) -> DataFrame:
    """F20, F21"""
    t, u = F.col("event_type"), F.col("user_id")
    status = F.when(t == "view", 200).when(t.isin("error", "signup"), 429).when(t == "click", 503).otherwise(403)
    body = (
        F.when(t == "error", '{"type":"about:blank","detail":"Usage-Capped now"}')
        .when(t == "signup", '{"type":"about:blank","detail":"slow down"}')
        .when(t == "click", F.concat(F.lit("plain "), text(u)))
        .otherwise('{"title":"No","detail":"slow down"}')
    )
    log = table(spark, sf, "events").select(
        "event_id",
        status.alias("status"),
        body.alias("body"),
        F.lit(1000).alias("now_epoch"),
        F.lit(None).cast("string").alias("rate_limit_limit"),
        F.lit("many").alias("rate_limit_remaining"),
        F.when(u % 2 == 0, "1080").alias("rate_limit_reset"),
        text(u).alias("retry_after"),
    )
    return classify_responses(log).select(
        "event_id", "status", "stop_reason", "kind", "wait_seconds", "error", "error_type", "error_detail", "retry_after"
    )


@query(
    "wait_seconds",
    "SELECT o_orderkey, greatest(30, o_custkey % 50, CASE WHEN o_orderkey % 2 = 0 THEN greatest(o_orderkey % 90 - 19, 0) ELSE 0 END) AS wait FROM orders",
)
def waits(spark: SparkSession, sf: str) -> DataFrame:
    """F21"""
    k = F.col("o_orderkey")
    reset = F.when(k % 2 == 0, k % 90 + 1000).otherwise(0)
    return table(spark, sf, "orders").select(
        "o_orderkey", wait_seconds(F.col("o_custkey") % 50, reset, F.lit(1020)).alias("wait")
    )


@query(
    "usage_remaining",
    """
SELECT c_custkey, CASE WHEN c_custkey % 3 > 0 THEN c_custkey END AS project_cap,
  CASE WHEN c_custkey % 4 > 0 THEN CAST(c_nationkey * 50 AS BIGINT) END AS project_usage,
  CAST(17 AS BIGINT) AS cap_reset_day,
  CASE WHEN c_custkey % 3 > 0 AND c_custkey % 4 > 0 THEN greatest(c_custkey - c_nationkey * 50, 0) END AS remaining
FROM customer
""",
)
def usage(spark: SparkSession, sf: str) -> DataFrame:
    """A5"""
    c = F.col("c_custkey")
    body = F.to_json(
        F.struct(
            F.struct(
                F.when(c % 3 > 0, c).alias("project_cap"),
                F.when(c % 4 > 0, text(F.col("c_nationkey") * 50)).alias("project_usage"),
                F.lit(17.0).alias("cap_reset_day"),
            ).alias("data")
        )
    )
    return usage_summary(table(spark, sf, "customer").select("c_custkey", body.alias("body"))).drop("body")


@query(
    "rules_response",
    """
SELECT s_suppkey, CASE s_suppkey % 5 WHEN 0 THEN 'ok' WHEN 4 THEN 'ok' ELSE 'failed' END AS outcome,
  CASE s_suppkey % 5 WHEN 1 THEN 'errors=[{"title":"bad"}]; summary={"invalid":1}'
    WHEN 2 THEN 'summary={"not_deleted":2}' WHEN 3 THEN 'expected rule was not returned' ELSE '' END AS detail,
  CASE WHEN s_suppkey % 5 = 0 THEN CAST(s_suppkey AS VARCHAR) END AS rule_id
FROM supplier
""",
)
def rule_responses(spark: SparkSession, sf: str) -> DataFrame:
    """A7"""
    s = F.col("s_suppkey")
    tag = F.concat(F.lit("t"), text(s))
    returned = F.concat(
        F.lit('{"data":[{"id":"'), text(s), F.lit('","value":"v","tag":"'), tag, F.lit('"}],"meta":{"summary":{"created":1}}}')
    )
    body = (
        F.when(s % 5 == 0, returned)
        .when(s % 5 == 1, '{"errors":[{"title":"bad"}],"meta":{"summary":{"invalid":1}}}')
        .when(s % 5 == 2, '{"meta":{"summary":{"not_deleted":2}}}')
        .when(s % 5 == 3, '{"data":[{"id":"1","value":"other","tag":"x"}]}')
        .otherwise('{"meta":{"summary":{"not_deleted":0}}}')
    )
    log = table(spark, sf, "supplier").select(
        "s_suppkey",
        F.when((s % 5 == 2) | (s % 5 == 4), "delete").otherwise("add").alias("action"),
        body.alias("body"),
        F.lit("v").alias("value"),
        tag.alias("tag"),
    )
    return rules_response(log).select("s_suppkey", "outcome", "detail", "rule_id")


@query(
    "rule_reconcile",
    """
WITH want AS (SELECT c_custkey AS k, 't' || c_custkey AS tag, 'q' || c_mktsegment AS value, c_custkey % 2 = 0 AS rep FROM customer),
cur AS (
  SELECT 't' || (o_custkey + 1) AS tag, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE CAST(o_orderkey AS VARCHAR) END AS id,
         'qMACHINERY' AS value FROM orders),
agg AS (
  SELECT w.tag, w.value AS want, rep, count(c.value) AS n, count(*) FILTER (c.value = w.value) AS same,
         min(CASE WHEN c.value = w.value THEN nullif(c.id, '') END) AS same_id, count(*) FILTER (c.id = '') AS no_id
  FROM want w LEFT JOIN cur c ON c.tag = w.tag GROUP BY ALL),
act AS (
  SELECT *, CASE WHEN same > 0 THEN 'reuse' WHEN n = 0 THEN 'create' WHEN NOT rep THEN 'conflict'
                 WHEN no_id > 0 THEN 'error' ELSE 'replace' END AS a FROM agg)
SELECT tag, CAST(1 AS INTEGER) AS step, CASE WHEN a = 'replace' THEN 'create' ELSE a END AS action, want AS value,
  CASE WHEN a = 'reuse' THEN same_id END AS rule_id,
  CASE a WHEN 'conflict' THEN 'tag already exists with a different value'
         WHEN 'error' THEN 'a conflicting rule has no id' END AS error FROM act
UNION ALL
SELECT c.tag, CAST(2 AS INTEGER), 'delete', c.value, c.id, NULL FROM cur c JOIN act ON act.tag = c.tag AND a = 'replace'
""",
)
def rule_reconcile(spark: SparkSession, sf: str) -> DataFrame:
    """J13"""
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    desired = table(spark, sf, "customer").select(
        F.concat(F.lit("t"), text(c)).alias("tag"),
        F.concat(F.lit("q"), "c_mktsegment").alias("value"),
        (c % 2 == 0).alias("replace"),
    )
    current = table(spark, sf, "orders").select(
        F.when(o % 7 == 0, "").otherwise(text(o)).alias("id"),
        F.lit("qMACHINERY").alias("value"),
        F.concat(F.lit("t"), text(F.col("o_custkey") + 1)).alias("tag"),
    )
    return reconcile_rules(desired, current)
