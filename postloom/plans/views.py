"""The given tables read as posts, pages, lines and logs.

Every view derives its rows from a table row by row, so it grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.clock import utc_text
from ..operators.order import ORDER
from ..sources.envelope import write_envelope
from ..runtime import scratch_path

PAGE_SIZE = 100
PLACE_IDS = 30


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A given table. One that is a single file is spread over the cores, since all later
    row work would run in the one task that reads it; many files are left as they are."""
    rows = spark.read.parquet(f"{sf}/{name}.parquet")
    if len(rows.inputFiles()) > 1:
        return rows
    return rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))


def text(col: Column) -> Column:
    return col.cast("string")


EVENT_POST_SQL = "CASE WHEN event_id >= 80 THEN event_id - event_id % 3 * 40 ELSE event_id END"


def event_post(e: Column) -> Column:
    """Post id of an event: two thirds of the events repeat the post of one 40 or 80 before.

    Like the other keys here, its range is a share of the table, so that work grows with it.
    """
    return F.when(e >= 80, e - e % 3 * 40).otherwise(e)


def media_keys(k: Column, c: Column) -> tuple[Column, Column]:
    """Two parts of an order; of the first a few don't exist."""
    return text(F.floor(k / 7)), text(c + F.floor(c / 3))


def mentioned(k: Column) -> Column:
    return text(F.floor(k / 10))


def order_post(k: Column, c: Column, row: dict[str, Column]) -> Column:
    """Payload of an order read as a post."""
    kind = (
        F.when(k % 5 == 0, "retweeted").when(k % 5 == 1, "quoted").when(k % 5 == 2, "replied_to")
    )
    metrics = F.struct(
        (k % 11).alias("retweet_count"),
        (k % 13).alias("reply_count"),
        (k % 101).alias("like_count"),
        (k % 3).alias("quote_count"),
        F.when(k % 2 == 1, k % 17).alias("bookmark_count"),
    )
    mentions = F.when(
        k % 3 == 0,
        F.array(
            F.struct(text(c + 1).alias("id"), F.concat(F.lit("u"), text(c + 1)).alias("username")),
            F.struct(mentioned(k).alias("id"), F.concat(F.lit("u"), mentioned(k)).alias("username")),
        ),
    )
    entities = F.struct(
        mentions.alias("mentions"),
        F.array(F.struct(row["status"].alias("tag")), F.struct(F.lit("").alias("tag"))).alias("hashtags"),
        F.array(
            F.struct(
                F.concat(F.lit("u"), text(k)).alias("url"),
                F.when(k % 2 == 0, F.concat(F.lit("e"), text(k))).alias("expanded_url"),
            )
        ).alias("urls"),
    )
    keys = F.array(*media_keys(k, c))
    return F.to_json(
        F.struct(
            text(k).alias("id"),
            row["priority"].alias("text"),
            utc_text(row["date"]).alias("created_at"),
            text(c).alias("author_id"),
            row["status"].alias("lang"),
            F.when(k % 7 > 0, k % 7 == 1).alias("possibly_sensitive"),
            text(F.floor(k / 10)).alias("conversation_id"),
            F.when(kind.isNotNull(), F.array(F.struct(kind.alias("type"), text(k - 1).alias("id")))).alias(
                "referenced_tweets"
            ),
            metrics.alias("public_metrics"),
            entities.alias("entities"),
            F.when(k % 4 > 0, F.struct(keys.alias("media_keys"))).alias("attachments"),
            F.struct(text(k % PLACE_IDS).alias("place_id")).alias("geo"),
            F.when(
                k % 6 == 0,
                F.array(
                    F.struct(
                        F.struct(row["priority"].alias("name")).alias("domain"),
                        F.struct(row["status"].alias("name")).alias("entity"),
                    )
                ),
            ).alias("context_annotations"),
            F.array(text(k)).alias("edit_history_tweet_ids"),
            F.struct((k % 2 == 0).alias("is_edit_eligible"), (k % 6).alias("edits_remaining")).alias("edit_controls"),
        )
    )


def order_payloads(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as post records: `log, block, seq, id, data`."""
    row = {"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus"), "date": F.col("o_orderdate")}
    k = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        F.lit("orders").alias("log"),
        F.floor(k / PAGE_SIZE).cast("bigint").alias("block"),
        (k % PAGE_SIZE).alias("seq"),
        text(k).alias("id"),
        order_post(k, F.col("o_custkey"), row).alias("data"),
    )


def lookup_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Customers, parts and nations as included objects: `kind, key, data`.

    Customers of one market segment are left out, so some lookups miss.
    """
    c = F.col("c_custkey")
    user = F.to_json(
        F.struct(
            text(c).alias("id"),
            F.col("c_name").alias("name"),
            F.concat(F.lit("u"), text(c)).alias("username"),
            F.col("c_mktsegment").alias("location"),
            (c % 2 == 0).alias("verified"),
            F.struct(
                (c % 1000).alias("followers_count"),
                F.col("c_nationkey").alias("following_count"),
                (c % 7).alias("tweet_count"),
            ).alias("public_metrics"),
        )
    )
    users = table(spark, sf, "customer").select(
        F.lit("include:users").alias("kind"), text(c).alias("key"), user.alias("data")
    )
    p, size = F.col("p_partkey"), F.col("p_size")
    item = F.to_json(
        F.struct(
            text(p).alias("media_key"),
            F.col("p_type").alias("type"),
            F.when(size % 5 != 0, F.concat(F.lit("m/"), text(p))).alias("url"),
            size.alias("width"),
            F.when(size % 2 == 0, size * 2).alias("height"),
            F.struct((p % 100).alias("view_count")).alias("public_metrics"),
        )
    )
    media = table(spark, sf, "part").select(
        F.lit("include:media").alias("kind"), text(p).alias("key"), item.alias("data")
    )
    place = F.to_json(
        F.struct(
            text(F.col("n_nationkey")).alias("id"),
            F.col("n_name").alias("full_name"),
            F.concat(F.lit("C"), text(F.col("n_regionkey"))).alias("country_code"),
        )
    )
    places = table(spark, sf, "nation").select(
        F.lit("include:places").alias("kind"), text(F.col("n_nationkey")).alias("key"), place.alias("data")
    )
    return users.unionByName(media).unionByName(places)


def order_log(spark: SparkSession, sf: str) -> DataFrame:
    """Envelope of order pages: posts, the objects they name, and a page marker."""
    posts = order_payloads(spark, sf)
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    named = F.array(
        F.struct(F.lit("include:users").alias("kind"), text(c).alias("key")),
        F.struct(F.lit("include:places").alias("kind"), text(k % PLACE_IDS).alias("key")),
        F.when(k % 4 > 0, F.struct(F.lit("include:media").alias("kind"), media_keys(k, c)[0].alias("key"))),
        F.when(k % 4 > 0, F.struct(F.lit("include:media").alias("kind"), media_keys(k, c)[1].alias("key"))),
        F.when(k % 3 == 0, F.struct(F.lit("include:users").alias("kind"), text(c + 1).alias("key"))),
        F.when(k % 3 == 0, F.struct(F.lit("include:users").alias("kind"), mentioned(k).alias("key"))),
    )
    block = F.floor(k / PAGE_SIZE).cast("bigint")
    wanted = (
        table(spark, sf, "orders")
        .select(block.alias("block"), F.explode(F.array_compact(named)).alias("n"))
        .select("block", "n.kind", "n.key")
        .distinct()
    )
    originals = posts.select(
        # The order after this one may be its repost, also on the next page.
        F.floor((F.col("id").cast("bigint") + 1) / PAGE_SIZE).cast("bigint").alias("block"),
        F.lit("include:tweets").alias("kind"),
        F.col("id").alias("key"),
        "data",
    ).where((F.col("key").cast("bigint") + 1) % 5 == 0)
    pages = table(spark, sf, "orders").select(block.alias("block")).distinct()
    originals = originals.join(pages, "block", "left_semi")
    objects = wanted.join(lookup_objects(spark, sf), ["kind", "key"]).select("block", "kind", "key", "data")
    place = F.pmod(F.xxhash64("kind", "key"), F.lit(1 << 31)) + (1 << 32)
    includes = objects.unionByName(originals).select(
        F.lit("orders").alias("log"), "block", place.alias("seq"), "kind", "data"
    )
    marker = F.concat(F.lit('{"page":'), text(F.col("block")), F.lit(',"endpoint":"recent","meta":{}}'))
    markers = pages.select(
        F.lit("orders").alias("log"),
        "block",
        F.lit(1 << 62).alias("seq"),
        F.lit("page").alias("kind"),
        marker.alias("data"),
    )
    tweets = posts.select(*ORDER, F.lit("tweet").alias("kind"), "data")
    return tweets.unionByName(includes).unionByName(markers)


def order_log_files(spark: SparkSession, sf: str) -> str:
    """The order log as envelope text files in a fresh folder, compressed to a tenth."""
    path = scratch_path(spark, "order_log")
    write_envelope(order_log(spark, sf), path, compress=True)
    return path


def event_records(spark: SparkSession, sf: str, also: tuple[str, ...] = ()) -> DataFrame:
    """Events as a record sequence: posts, includes, page markers and unknown kinds; `also` names
    further columns of the events to keep."""
    e = F.col("event_type")
    kind = (
        F.when(e.isin("click", "purchase"), "tweet")
        .when(e == "view", "include:users")
        .when(e == "signup", "page")
        .otherwise("other")
    )
    return table(spark, sf, "events").select(
        F.concat(F.lit("f"), F.lpad(text(F.floor(F.col("event_id") / 1000)), 12, "0")).alias("log"),
        F.floor(F.col("event_id") / 100).cast("bigint").alias("block"),
        F.col("event_id").alias("seq"),
        kind.alias("kind"),
        F.to_json(F.struct(text(F.col("event_id")).alias("id"), text(F.col("user_id")).alias("author_id"))).alias(
            "data"
        ),
        *also,
    )


def event_pages(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as one response page: three posts (one without id) and a user."""
    e, u = F.col("event_id"), F.col("user_id")
    body = F.to_json(
        F.struct(
            F.array(
                F.struct(text(event_post(e)).alias("id"), F.col("event_type").alias("text")),
                F.struct(F.concat(F.lit("u"), text(u)).alias("id"), F.lit("profile").alias("text")),
                F.struct(F.lit("").alias("id"), F.lit("no id").alias("text")),
            ).alias("data"),
            F.struct(F.array(F.struct(text(u).alias("id"))).alias("users")).alias("includes"),
            F.struct(F.lit(3).alias("result_count")).alias("meta"),
        )
    )
    return table(spark, sf, "events").select(F.lit("events").alias("log"), e.alias("block"), body.alias("body"))


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Each event as one stream line: keepalives, broken lines, errors and posts."""
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    event = F.to_json(
        F.struct(
            F.struct(text(event_post(e)).alias("id"), t.alias("text"), text(u).alias("author_id")).alias("data"),
            F.struct(F.array(F.struct(text(u).alias("id"))).alias("users")).alias("includes"),
            F.array(F.struct(F.lit("r1").alias("id"), t.alias("tag"))).alias("matching_rules"),
        )
    )
    value = (
        F.when(t == "view", "  ")
        .when(t == "error", "not-json")
        .when(t == "signup", F.lit('{"errors":[{"title":"x"}]}'))
        .when(t == "purchase", F.concat(F.lit("data: "), event))
        .otherwise(event)
    )
    return table(spark, sf, "events").select(
        F.lit("stream").alias("log"),
        e.alias("block"),
        F.lit(0).cast("bigint").alias("seq"),
        value.alias("value"),
        utc_text(F.col("ts")).alias("received_at"),
    )


def connection_log(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a connection log per user."""
    t = F.col("event_type")
    event = (
        F.when(t == "error", "failed")
        .when(t == "signup", "connected")
        .when((t == "purchase") & (F.col("event_id") % 10 == 0), "stopped")
        .when(t == "view", "keepalive")
        .otherwise("post")
    )
    reason = F.when(
        t == "error", F.when(F.col("event_id") % 3 == 0, "server_error").when(F.col("event_id") % 3 == 1, "rate_limited").otherwise("")
    ).when(t == "purchase", F.when(F.col("event_id") % 20 == 0, "max_posts").otherwise(""))
    return table(spark, sf, "events").select(
        text(F.col("user_id")).alias("task_name"), "ts", "event_id", event.alias("event"), reason.alias("reason")
    )


def document_posts(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as posts with flat flags."""
    d = F.col("doc_id")
    return table(spark, sf, "documents").select(
        d.alias("id"),
        "text",
        "lang",
        (d % 5 == 0).alias("is_retweet"),
        (d % 5 == 1).alias("is_quote"),
        (d % 5 == 2).alias("is_reply"),
    )


def line_items(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as delivered posts; the id repeats, the order key is every column."""
    return table(spark, sf, "lineitem").select(
        F.concat(text(F.col("l_orderkey")), F.lit("-"), text(F.col("l_linenumber"))).alias("id"),
        "l_partkey",
        "l_suppkey",
        F.col("l_quantity").cast("bigint").alias("quantity"),
        F.col("l_shipdate").alias("ts"),
    )
