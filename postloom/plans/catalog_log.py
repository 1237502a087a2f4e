"""Normalizers, log order, dedup and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..operators.dedup import already_seen, dedup_logs, first_seen, merge_logs, new_seen, seen_count, unseen
from ..operators.limits import cutoff_pages, page_limit
from ..operators.order import ORDER, last_known_kind, segment_records
from ..operators.stats import (
    SKETCH_ERROR,
    estimated_ids,
    id_sketches,
    merged_sketches,
    outcome_counters,
    page_stats,
    run_counters,
)
from ..runtime import durable, empty, scratch_path
from ..sources.envelope import (
    line_positions,
    next_ledger,
    next_offset,
    read_lines,
    read_log,
    scan_files,
    write_envelope,
    write_log,
    written_files,
)
from ..sources.pages import delivered_posts, line_outcome, number_events
from .collect import collect_events, collect_pages
from .convert import closed_records, convert
from .registry import query
from .views import EVENT_POST_SQL, event_lines, event_pages, event_records, line_items, table, text

SEEN_AT = "2024-02-01T00:00:00Z"


def no_seen(spark: SparkSession) -> DataFrame:
    return empty(spark, "id STRING, seen_at STRING")


# Delivered posts of the event pages and which of them are new.
PAGES_SQL = f"""
WITH raw AS (
  SELECT event_id AS block, 0 AS pos, CAST({EVENT_POST_SQL} AS VARCHAR) AS id, event_type AS txt FROM events
  UNION ALL SELECT event_id, 1, 'u' || user_id, 'profile' FROM events),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY block, pos) AS rn FROM raw),
fresh AS (SELECT block, pos, id, txt FROM ranked WHERE rn = 1),
brought AS (SELECT block, count(*) AS n FROM fresh GROUP BY block)
"""


@query(
    "envelope_kinds",
    PAGES_SQL
    + """
SELECT 'events' AS log, (SELECT count(*) FROM events) AS pages, (SELECT count(*) FROM fresh) AS posts,
       (SELECT count(*) FROM brought) AS includes
""",
)
def envelope_kinds(spark: SparkSession, sf: str) -> DataFrame:
    """S3, A2"""
    return run_counters(collect_pages(event_pages(spark, sf), no_seen(spark), F.lit(SEEN_AT)).records)


@query(
    "search_envelope",
    PAGES_SQL
    + """
SELECT block, 'tweet' AS kind, '{"id":"' || id || '","text":"' || txt || '"}' AS data FROM fresh
UNION ALL
SELECT event_id, 'include:users', '{"id":"' || user_id || '"}' FROM events JOIN brought ON block = event_id
UNION ALL
SELECT event_id, 'page', '{"page":' || event_id || ',"endpoint":"recent","meta":{"result_count":3}}' FROM events
""",
)
def search_envelope(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a search run."""
    run = collect_pages(event_pages(spark, sf), no_seen(spark), F.lit(SEEN_AT))
    return run.records.select("block", "kind", "data")


LINES_SQL = f"""
WITH ev AS (
  SELECT event_id AS block, CAST({EVENT_POST_SQL} AS VARCHAR) AS id, event_type AS t, user_id AS u,
         strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS heard
  FROM events WHERE event_type IN ('click', 'purchase')),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY block) AS rn FROM ev),
fresh AS (SELECT *, row_number() OVER (ORDER BY block) AS total FROM ranked WHERE rn = 1)
"""


@query(
    "stream_envelope",
    LINES_SQL
    + """
SELECT block, 'tweet' AS kind, '{"id":"' || id || '","text":"' || t || '","author_id":"' || u || '"}' AS data FROM fresh
UNION ALL SELECT block, 'include:users', '{"id":"' || u || '"}' FROM fresh
UNION ALL SELECT block, 'page', '{"page":' || total || ',"endpoint":"stream","meta":{"received_at":"' || heard ||
  '","result_count":1,"matching_rules":[{"id":"r1","tag":"' || t || '"}]}}' FROM fresh
""",
)
def stream_envelope_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Records of a stream run; events without a new post leave none."""
    return collect_events(event_lines(spark, sf), no_seen(spark), F.lit(SEEN_AT)).records.select("block", "kind", "data")


@query(
    "stream_outcomes",
    LINES_SQL
    + """
SELECT 'stream' AS log, count(*) FILTER (event_type = 'view') AS keepalive,
       count(*) FILTER (event_type = 'error') AS invalid, (SELECT count(*) FROM fresh) AS tweet,
       count(*) FILTER (event_type = 'signup') AS errors,
       count(*) FILTER (event_type IN ('click', 'purchase')) - (SELECT count(*) FROM fresh) AS ignored
FROM events
""",
)
def stream_outcomes(spark: SparkSession, sf: str) -> DataFrame:
    """Outcome of every line."""
    lines = event_lines(spark, sf)
    new = collect_events(lines, no_seen(spark), F.lit(SEEN_AT)).new_posts
    counts = new.groupBy("log", "block").agg(F.count(F.lit(1)).alias("n"))
    told = number_events(lines).join(counts, ["log", "block"], "left")
    return outcome_counters(told.withColumn("outcome", line_outcome(F.col("body"), F.coalesce("n", F.lit(0)))))


@query(
    "page_stats",
    PAGES_SQL
    + """
SELECT event_id AS block, CAST(3 AS BIGINT) AS result_count, CAST(2 AS BIGINT) AS delivered,
       coalesce(n, 0) AS new_posts
FROM events LEFT JOIN brought ON block = event_id
""",
)
def page_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """A3"""
    pages = event_pages(spark, sf)
    new = unseen(delivered_posts(pages), no_seen(spark), list(ORDER))
    return page_stats(pages, new).drop("log")


SEGMENT_SQL = """
WITH known AS (
  SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 't' WHEN event_type = 'view' THEN 'i' ELSE 'p' END AS cls
  FROM events WHERE event_type IN ('click', 'purchase', 'view', 'signup')),
marked AS (
  SELECT *, CASE WHEN cls = 'p' OR (cls = 't' AND lag(cls) OVER (ORDER BY event_id) IN ('i', 'p')) THEN 1 ELSE 0 END AS m
  FROM known),
raws AS (SELECT *, sum(m) OVER (ORDER BY event_id) AS raw FROM marked),
effective AS (
  SELECT raw, min(CASE WHEN has THEN raw END) OVER (ORDER BY raw ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS seg
  FROM (SELECT raw, bool_or(cls = 't') AS has FROM raws GROUP BY raw)),
ranked AS (
  SELECT r.*, seg, sum(CASE WHEN cls = 't' THEN 1 ELSE 0 END) OVER (PARTITION BY r.raw ORDER BY event_id) AS n
  FROM raws r JOIN effective e ON r.raw = e.raw)
SELECT event_id, CAST(seg AS BIGINT) AS segment,
       CAST(CASE WHEN seg = raw THEN greatest((n - 1) // {valve}, 0) ELSE 0 END AS BIGINT) AS part
FROM ranked WHERE seg IS NOT NULL
"""


@query("segments", SEGMENT_SQL.format(valve=2**60))
def segments(spark: SparkSession, sf: str) -> DataFrame:
    """W1, W2"""
    return segment_records(event_records(spark, sf)).select(F.col("seq").alias("event_id"), "segment", "part")


@query("safety_valve", SEGMENT_SQL.format(valve=2))
def safety_valve(spark: SparkSession, sf: str) -> DataFrame:
    """W3 with a valve of two posts."""
    return segment_records(event_records(spark, sf), valve=2).select(F.col("seq").alias("event_id"), "segment", "part")


@query(
    "last_kind",
    """
SELECT event_id, coalesce(lag(cls) OVER (ORDER BY event_id), 'none') AS last_kind FROM (
  SELECT event_id, CASE WHEN event_type IN ('click', 'purchase') THEN 't' WHEN event_type = 'view' THEN 'i' ELSE 'p' END AS cls
  FROM events WHERE event_type IN ('click', 'purchase', 'view', 'signup'))
""",
)
def last_kind(spark: SparkSession, sf: str) -> DataFrame:
    """W10"""
    return last_known_kind(event_records(spark, sf)).select(F.col("seq").alias("event_id"), "last_kind")


@query(
    "closed_records",
    """
SELECT event_id FROM events WHERE event_id <= (SELECT max(event_id) FROM events WHERE event_type = 'signup')
""",
)
def closed(spark: SparkSession, sf: str) -> DataFrame:
    """The part of a log up to its last page marker."""
    return closed_records(event_records(spark, sf)).select(F.col("seq").alias("event_id"))


ITEM = "l_orderkey || '-' || l_linenumber"
ITEMS_SQL = f"""
WITH items AS (
  SELECT {ITEM} AS id, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, l_shipdate AS ts,
         l_returnflag AS flag FROM lineitem),
seen AS (SELECT DISTINCT id FROM items WHERE flag = 'N')
"""
ITEM_ORDER = ["ts", "l_partkey", "l_suppkey", "quantity"]
ORDER_SQL = "ts, l_partkey, l_suppkey, quantity"


def seen_items(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of returned-flag N line items as the seen set."""
    ids = table(spark, sf, "lineitem").where("l_returnflag = 'N'").select(
        F.concat(text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))).alias("id")
    )
    return new_seen(ids, no_seen(spark), F.lit(SEEN_AT))


@query(
    "dedup_first_seen",
    ITEMS_SQL
    + f"""
SELECT id, l_partkey, l_suppkey, quantity, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {ORDER_SQL}) AS rn FROM items) WHERE rn = 1
""",
)
def dedup_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """W4"""
    return first_seen(line_items(spark, sf), ITEM_ORDER)


@query(
    "seen_anti",
    ITEMS_SQL
    + f"""
SELECT id, l_partkey, l_suppkey, quantity, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY {ORDER_SQL}) AS rn FROM items) t
WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM seen WHERE seen.id = t.id)
""",
)
def seen_anti(spark: SparkSession, sf: str) -> DataFrame:
    """J8"""
    return unseen(line_items(spark, sf), seen_items(spark, sf), ITEM_ORDER)


@query(
    "seen_semi",
    ITEMS_SQL
    + """
SELECT id, l_partkey, l_suppkey, quantity, ts FROM items t WHERE EXISTS (SELECT 1 FROM seen WHERE seen.id = t.id)
""",
)
def seen_semi(spark: SparkSession, sf: str) -> DataFrame:
    """J9, O3"""
    return already_seen(line_items(spark, sf), seen_items(spark, sf), ITEM_ORDER)


@query("seen_count", ITEMS_SQL + "SELECT count(*) AS seen_count FROM seen")
def count_seen(spark: SparkSession, sf: str) -> DataFrame:
    """A1"""
    return seen_count(seen_items(spark, sf))


@query(
    "seen_estimate",
    ITEMS_SQL
    + """
SELECT flag, count(DISTINCT id) AS ids, true AS within_bound FROM items GROUP BY flag
UNION ALL SELECT 'all', count(DISTINCT id), true FROM items
""",
)
def estimate_seen(spark: SparkSession, sf: str) -> DataFrame:
    """A1, A2: sketches per flag, merged for the whole, beside the exact numbers."""
    items = table(spark, sf, "lineitem").select(
        F.concat(text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))).alias("id"), F.col("l_returnflag").alias("flag")
    )
    sketches = durable(id_sketches(items, ["flag"]), "sketches")
    merged = merged_sketches(sketches, []).select(F.lit("all").alias("flag"), "sketch")
    told = estimated_ids(sketches.unionByName(merged)).withColumnRenamed("ids", "told")
    counted = items.unionByName(items.withColumn("flag", F.lit("all"))).groupBy("flag").agg(F.count_distinct("id").alias("ids"))
    close = F.abs(F.col("told") - F.col("ids")) <= F.greatest(3 * SKETCH_ERROR * F.col("ids"), F.lit(1.0))
    return counted.join(told, "flag").select("flag", "ids", close.alias("within_bound"))


@query(
    "seen_insert",
    ITEMS_SQL
    + f"SELECT DISTINCT id, '{SEEN_AT}' AS seen_at FROM items WHERE id NOT IN (SELECT id FROM seen)",
)
def seen_insert(spark: SparkSession, sf: str) -> DataFrame:
    """U3"""
    return new_seen(line_items(spark, sf), seen_items(spark, sf), F.lit(SEEN_AT))


@query(
    "dedup_cross_log",
    ITEMS_SQL
    + f"""
SELECT id, l_partkey, l_suppkey, quantity, ts, CAST(source_rank AS INTEGER) AS source_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY source_rank, {ORDER_SQL}) AS rn
  FROM (SELECT *, CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE 1 END AS source_rank FROM items)) WHERE rn = 1
""",
)
def dedup_cross_log(spark: SparkSession, sf: str) -> DataFrame:
    """A search log and a stream log that share one seen set."""
    items = line_items(spark, sf)
    return dedup_logs([items.where("l_suppkey % 2 = 0"), items.where("l_suppkey % 2 = 1")], ITEM_ORDER)


@query(
    "union_logs",
    ITEMS_SQL
    + """
SELECT CAST(CASE WHEN l_suppkey % 2 = 0 THEN 0 ELSE 1 END AS INTEGER) AS source_rank, count(*) AS posts,
       count(DISTINCT id) AS ids FROM items GROUP BY 1
""",
)
def union_logs(spark: SparkSession, sf: str) -> DataFrame:
    """U1"""
    items = line_items(spark, sf)
    merged = merge_logs([items.where("l_suppkey % 2 = 0"), items.where("l_suppkey % 2 = 1")])
    return merged.groupBy("source_rank").agg(
        F.count(F.lit(1)).alias("posts"), F.count_distinct("id").alias("ids")
    )


TARGET = 1000
LIMIT_SQL = PAGES_SQL + f"""
, totals AS (SELECT block, n, sum(n) OVER (ORDER BY block) AS total FROM brought),
kept AS (SELECT * FROM totals WHERE total - n < {TARGET})
"""


@query("page_limit", LIMIT_SQL + "SELECT block, id FROM fresh WHERE block IN (SELECT block FROM kept)")
def limited_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Whole pages until the target is reached."""
    new = durable(unseen(delivered_posts(event_pages(spark, sf)), no_seen(spark), list(ORDER)), "new_posts")
    return page_limit(new, new, TARGET, ["id"]).select("block", "id")


@query(
    "page_cutoff",
    LIMIT_SQL + "SELECT 'events' AS log, max(block) AS last_block, CAST(max(total) AS BIGINT) AS total_posts FROM kept",
)
def page_cutoff(spark: SparkSession, sf: str) -> DataFrame:
    """Where a run with a target stops."""
    return cutoff_pages(unseen(delivered_posts(event_pages(spark, sf)), no_seen(spark), list(ORDER)), TARGET)


def event_log_files(spark: SparkSession, sf: str) -> str:
    """Event records as text files, with a broken line for every error event."""
    path = scratch_path(spark, "event_log")
    records = event_records(spark, sf).withColumn(
        "data",
        # A cut payload makes the whole line unreadable.
        F.when(F.col("kind") == "other", F.col("data").substr(F.lit(1), F.length("data") - 1)).otherwise(F.col("data")),
    )
    write_envelope(records, path)
    return path


@query(
    "quarantine",
    """
SELECT '{"kind":"other","data":{"id":"' || event_id || '","author_id":"' || user_id || '"}' AS value
FROM events WHERE event_type = 'error'
""",
)
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """Unreadable lines are kept apart."""
    return scan_files(spark, written_files(spark, event_log_files(spark, sf))).quarantine.select("value")


DELTA_OFFSET = 40_000


@query(
    "delta_scan",
    f"""
WITH lines AS (
  SELECT event_id, event_type,
         length(CASE WHEN event_type IN ('click', 'purchase') THEN 'tweet' WHEN event_type = 'view' THEN 'include:users'
              WHEN event_type = 'signup' THEN 'page' ELSE 'other' END) +
         length('{{"kind":"","data":{{"id":"' || event_id || '","author_id":"' || user_id || '"}}}}') + 1 AS len
  FROM events),
placed AS (SELECT *, sum(len) OVER (ORDER BY event_id) - len AS start FROM lines)
SELECT CAST(event_id AS VARCHAR) AS id FROM placed WHERE start >= {DELTA_OFFSET}
""",
)
def delta_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Only lines behind a byte offset over all files."""
    path = scratch_path(spark, "delta_log")
    write_envelope(event_records(spark, sf), path)
    scan = scan_files(spark, written_files(spark, path), offset=DELTA_OFFSET)
    return scan.records.select(F.get_json_object("data", "$.id").alias("id"))


@query(
    "line_positions",
    """
WITH lines AS (
  SELECT event_id,
         length(CASE WHEN event_type IN ('click', 'purchase') THEN 'tweet' WHEN event_type = 'view' THEN 'include:users'
              WHEN event_type = 'signup' THEN 'page' ELSE 'other' END) +
         length('{"kind":"","data":{"id":"' || event_id || '","author_id":"' || user_id || '"}}') + 1 AS len
  FROM events)
SELECT count(*) AS lines, CAST(sum(len) AS BIGINT) AS bytes FROM lines
""",
)
def positions(spark: SparkSession, sf: str) -> DataFrame:
    """Lines and bytes found by position agree with the files."""
    path = scratch_path(spark, "position_log")
    write_envelope(event_records(spark, sf), path)
    files = written_files(spark, path)
    lines = line_positions(read_lines(spark, list(files.inputFiles()), []))
    ends = lines.groupBy("log").agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.col("line_start") + F.octet_length("value") + 1).cast("bigint").alias("end"),
    )
    return ends.agg(F.sum("n").alias("lines"), F.sum("end").alias("bytes"))


@query(
    "log_to_table",
    PAGES_SQL + """
SELECT sink, id AS tweet_id, txt AS text FROM fresh, (SELECT 'csv' AS sink UNION ALL SELECT 'columnar')
""",
)
def log_to_table(spark: SparkSession, sf: str) -> DataFrame:
    """Pages to a log of named files, two conversions, both sinks."""
    folder, csv, columnar = (scratch_path(spark, n) for n in ("task_log", "csv", "columnar"))
    records = durable(collect_pages(event_pages(spark, sf), no_seen(spark), F.lit(SEEN_AT)).records, "collected")
    half = F.col("block") < records.agg(F.max("block") / 2).scalar()
    write_log(records.where(half), folder, "task", "20240101T000000", compress=True)
    write_log(records.where(half), folder, "other", "20240101T000000")
    first = convert(spark, folder, "task", csv, columnar)
    write_log(records.where(~half), folder, "task", "20240102T000000")
    convert(spark, folder, "task", csv, columnar, offset=first.offset)
    table_ = spark.read.parquet(columnar)
    text_ = spark.read.schema(table_.schema).option("header", True).option("multiLine", True).option("escape", '"').csv(csv)
    named = lambda df, sink: df.select(F.lit(sink).alias("sink"), "tweet_id", "text")
    return named(text_, "csv").unionByName(named(table_, "columnar"))


@query("ordered_output", PAGES_SQL + "SELECT id AS tweet_id, row_number() OVER (ORDER BY block, pos) AS n FROM fresh")
def ordered_output(spark: SparkSession, sf: str) -> DataFrame:
    """O1: the number of each row in the columnar output, files by name."""
    folder, columnar = scratch_path(spark, "task_log"), scratch_path(spark, "columnar")
    records = durable(collect_pages(event_pages(spark, sf), no_seen(spark), F.lit(SEEN_AT)).records, "collected")
    write_log(records, folder, "task", "20240101T000000")
    convert(spark, folder, "task", columnar_path=columnar)
    rows = spark.read.parquet(columnar).select(
        "tweet_id", F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")
    )
    sizes = rows.groupBy("file").agg(F.count("*").alias("n"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    return rows.join(starts, "file").select("tweet_id", (F.col("start") + F.col("row") + 1).alias("n"))


LOG_BYTES = 200_000


@query("log_increments", PAGES_SQL + "SELECT id FROM fresh")
def log_increments(spark: SparkSession, sf: str) -> DataFrame:
    """Two successive scans, the second with the first one's ledger, of a log that
    grows and is compressed between them."""
    folder = scratch_path(spark, "task_log")
    records = durable(collect_pages(event_pages(spark, sf), no_seen(spark), F.lit(SEEN_AT)).records, "collected")
    half = F.col("block") < records.agg(F.max("block") / 2).scalar()
    write_log(records.where(half), folder, "task", "20240101T000000", rotate_bytes=LOG_BYTES)
    first = read_log(spark, folder, "task")
    taken = durable(first.records, "first")
    offset, ledger = next_offset(first), next_ledger(first)
    compressed = scratch_path(spark, "task_log")
    # Cut by size, the files hold the same lines as before.
    write_log(records.where(half), compressed, "task", "20240101T000000", compress=True, rotate_bytes=LOG_BYTES)
    write_log(records.where(~half), compressed, "task", "20240102T000000")
    both = taken.unionByName(read_log(spark, compressed, "task", offset, ledger=ledger).records)
    return both.where("kind = 'tweet'").select(F.get_json_object("data", "$.id").alias("id"))


ROTATE_BYTES, ROTATE_SECONDS = 20_000, 86_400


@query(
    "log_rotation",
    f"""
WITH lines AS (
  SELECT event_id, epoch_us(ts) AS us,
         length(CASE WHEN event_type IN ('click', 'purchase') THEN 'tweet' WHEN event_type = 'view' THEN 'include:users'
              WHEN event_type = 'signup' THEN 'page' ELSE 'other' END) +
         length('{{"kind":"","data":{{"id":"' || event_id || '","author_id":"' || user_id || '"}}}}') + 1 AS len
  FROM events),
placed AS (
  SELECT *, sum(len) OVER (ORDER BY event_id) - len AS start,
    (max(us) OVER (ORDER BY event_id) - first_value(us) OVER (ORDER BY event_id)) // {ROTATE_SECONDS * 1_000_000} AS slot
  FROM lines),
cut AS (SELECT *, (start - min(start) OVER (PARTITION BY slot)) // {ROTATE_BYTES} AS piece FROM placed)
SELECT CAST(row_number() OVER (ORDER BY slot, piece) - 1 AS BIGINT) AS file, count(*) AS lines, CAST(sum(len) AS BIGINT) AS bytes,
  min(event_id) AS first_id, max(event_id) AS last_id FROM cut GROUP BY slot, piece
""",
)
def log_rotation(spark: SparkSession, sf: str) -> DataFrame:
    """The files of a log that is rotated by size and by age."""
    folder = scratch_path(spark, "rotated_log")
    records = event_records(spark, sf, also=("ts",))
    write_log(records, folder, "task", "20240101T000000", rotate_bytes=ROTATE_BYTES, rotate_seconds=ROTATE_SECONDS, at="ts")
    lines = spark.read.option("lineSep", "\n").text(folder).select(
        F.regexp_extract("_metadata.file_name", r"-(\d+)\.jsonl$", 1).cast("bigint").alias("file"),
        F.octet_length("value").alias("n"),
        F.get_json_object("value", "$.data.id").cast("bigint").alias("id"),
    )
    return lines.groupBy("file").agg(
        F.count("*").alias("lines"),
        F.sum(F.col("n") + 1).cast("bigint").alias("bytes"),
        F.min("id").alias("first_id"),
        F.max("id").alias("last_id"),
    )
