"""Captured responses and events to envelope records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.coerce import (
    json_field,
    json_has_key,
    json_items,
    json_object,
    json_pairs,
    json_string,
)
from ..functions.texts import stream_payload
from ..operators.order import carry

# Places of the record groups of one page in its `seq`.
INCLUDES_AT = 1 << 32
PAGE_AT = 1 << 62


def data_items(data: Column) -> Column:
    """Posts of a payload's `data`, an array or one object; it is read several times, so it should
    be a column."""
    one = F.when(data.isNotNull() & ~F.ltrim(data).startswith("["), F.array(data))
    return F.coalesce(one, json_items(data))


def delivered_posts(pages: DataFrame, items: Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """One row per delivered post with a non-blank id.

    `pages` has `log`, `block` (page or event number) and `body` (JSON text); `also` names
    further columns of it to keep.
    """
    if items is None:
        pages = pages.withColumn("_data", json_field(F.col("body"), "data"))
        items = data_items(F.col("_data"))
    return (
        pages.select("log", "block", F.posexplode(items).alias("pos", "data"), *also)
        .withColumn("id", F.coalesce(json_field(F.col("data"), "id"), F.lit("")))
        .where("id <> ''")
        .withColumn("seq", F.col("pos").cast("bigint"))
        .select("log", "block", "seq", "id", "data", *also)
    )


def included_objects(pages: DataFrame) -> DataFrame:
    """One row per included object, kind `include:<name>`."""
    groups = pages.select(
        "log", "block", F.posexplode(json_pairs(json_field(F.col("body"), "includes"))).alias("g", "entry")
    )
    return groups.select(
        "log",
        "block",
        F.concat(F.lit("include:"), "entry.key").alias("kind"),
        "g",
        F.posexplode(json_items(F.col("entry.value"))).alias("pos", "data"),
    ).select(
        "log",
        "block",
        (F.col("g").cast("bigint") * (1 << 32) + F.col("pos") + INCLUDES_AT).alias("seq"),
        "kind",
        "data",
    )


def _if_present(body: Column, key: str) -> Column:
    """JSON text under a key, `null` when the key is there with a null."""
    return F.when(json_has_key(body, key), F.coalesce(F.get_json_object(body, f"$.{key}"), F.lit("null")))


def _assemble(posts: DataFrame, pages: DataFrame | None, markers: DataFrame) -> DataFrame:
    columns = ["log", "block", "seq", "kind", "data"]
    out = posts.withColumn("kind", F.lit("tweet")).select(*columns)
    if pages is not None:
        # Pages that brought no new post bring no includes either, so theirs are not read.
        fresh = posts.groupBy("log", "block").agg(F.count(F.lit(1)).alias("_n")).drop("_n")
        kept = pages.select("log", "block", "body").join(fresh, ["log", "block"], "left_semi")
        out = out.unionByName(included_objects(kept).select(*columns))
    return out.unionByName(markers.select(*columns))


def search_envelope(
    pages: DataFrame, new_posts: DataFrame, endpoint: str = "recent", write_includes: bool = True
) -> DataFrame:
    """S3: records of search pages, given the posts that were new.

    The page record is written for every page.
    """
    meta = F.coalesce(F.get_json_object("body", "$.meta"), F.lit("{}"))
    markers = pages.select(
        "log",
        "block",
        F.lit(PAGE_AT).cast("bigint").alias("seq"),
        F.lit("page").alias("kind"),
        json_object(
            [
                ("page", F.col("block").cast("string")),
                ("endpoint", json_string(F.lit(endpoint))),
                ("meta", meta),
            ]
        ).alias("data"),
    )
    return _assemble(new_posts, pages if write_includes else None, markers)


def stream_envelope(
    events: DataFrame,
    new_posts: DataFrame,
    write_includes: bool = True,
    posts_before: Column | None = None,
    across_logs: bool = False,
) -> DataFrame:
    """Records of stream events, given the posts that were new.

    `events` has `log`, `block` (event number), `body` and `received_at` (text).
    Events without a new post leave no record. `page` in the marker is the running
    total of posts, per log or over all logs in order, on top of `posts_before`.
    """
    counts = new_posts.groupBy("log", "block").agg(F.count(F.lit(1)).alias("result_count"))
    totals = running_total(counts, "result_count", "page", across_logs)
    if posts_before is not None:
        totals = totals.withColumn("page", F.col("page") + posts_before)
    marked = events.join(totals, ["log", "block"])
    body = F.col("body")
    meta = json_object(
        [
            ("received_at", json_string(F.col("received_at"))),
            ("result_count", F.col("result_count").cast("string")),
            ("matching_rules", _if_present(body, "matching_rules")),
            ("errors", _if_present(body, "errors")),
            ("stream_meta", _if_present(body, "meta")),
        ]
    )
    markers = marked.select(
        "log",
        "block",
        F.lit(PAGE_AT).cast("bigint").alias("seq"),
        F.lit("page").alias("kind"),
        json_object(
            [("page", F.col("page").cast("string")), ("endpoint", F.lit('"stream"')), ("meta", meta)]
        ).alias("data"),
    )
    return _assemble(new_posts, events if write_includes else None, markers)


def running_total(
    counts: DataFrame, value: str, name: str, across_logs: bool = False, width: int = 1 << 18
) -> DataFrame:
    """Inclusive running sum of `value` over `block`, per log or over all logs in order.

    Block numbers are cut into runs of `width`; sums of runs are scanned per log, or over all
    logs, so no window holds more than one run, or one row per run.
    """
    run = counts.withColumn("_run", F.floor(F.col("block") / width))
    sums = run.groupBy("log", "_run").agg(F.sum(value).alias("_sum"))
    scanned = carry(sums, [], ["log", "_run"], sums=("_sum",)) if across_logs else carry(sums, ["log"], ["_run"], sums=("_sum",))
    before = scanned.drop("_sum")
    inside = Window.partitionBy("log", "_run").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    return (
        run.withColumn("_in", F.sum(value).over(inside))
        .join(before, ["log", "_run"])
        .withColumn(name, F.col("_in") + F.col("_sum_before"))
        .drop("_run", "_in", "_sum_before")
    )


def number_events(lines: DataFrame) -> DataFrame:
    """lines of a captured stream as events; keepalive lines have a null body.

    `lines` has the order key and `value`. The event number is taken from the line's
    place, so it rises with the log and needs no count.
    """
    return lines.withColumn("body", stream_payload(F.col("value")))


def line_outcome(body: Column, new_posts: Column) -> Column:
    """Outcome of a line from its payload and the number of posts it added."""
    return (
        F.when(body.isNull(), "keepalive")
        .when(F.try_parse_json(body).isNull(), "invalid")
        .when(new_posts > 0, "tweet")
        .when(json_has_key(body, "errors"), "errors")
        .otherwise("ignored")
    )


# S12, fixed values: fields asked for per profile.
PROFILE_FIELDS = {
    "full": {
        "post": "id,text,created_at,lang,source,possibly_sensitive,author_id,conversation_id,"
        "in_reply_to_user_id,referenced_tweets,reply_settings,attachments,entities,"
        "context_annotations,withheld,public_metrics,geo,edit_history_tweet_ids,edit_controls",
        "users": "id,name,username,created_at,description,location,verified,protected,url,entities,"
        "profile_image_url,public_metrics",
        "media": "media_key,type,url,preview_image_url,alt_text,width,height,public_metrics,"
        "duration_ms,variants",
        "places": "id,full_name,name,country,country_code,place_type,contained_within,geo",
    },
    "lean": {
        "post": "id,text,created_at,lang,author_id,public_metrics",
        "users": "id,name,username,verified,protected,public_metrics",
    },
    "minimal": {"post": "id,text,created_at,lang,author_id,public_metrics"},
}


def apply_profile(records: DataFrame, profile: str = "full", write_includes: bool = True) -> DataFrame:
    """Prune payload fields and include kinds to a field profile."""
    if profile not in PROFILE_FIELDS:
        raise ValueError(f"invalid field profile: {profile}")
    fields = dict(PROFILE_FIELDS[profile])
    if not write_includes:
        fields = {"post": fields["post"]}
    fields_of = {"tweet": fields["post"]}
    for name in ("users", "media", "places"):
        if name in fields:
            fields_of[f"include:{name}"] = fields[name]
    if "users" in fields and profile == "full":
        fields_of["include:tweets"] = fields["post"]
    pruned, parsed = F.when(F.col("kind") == "page", F.col("data")), {}
    for n, (kind, names) in enumerate(fields_of.items()):
        # As columns of their own, so that an object is read twice and not twice per field.
        texts, typed = read_fields(F.when(F.col("kind") == kind, F.col("data")), names)
        parsed |= {f"_texts{n}": texts, f"_typed{n}": typed}
        pruned = pruned.when(F.col("kind") == kind, pruned_object(F.col(f"_texts{n}"), F.col(f"_typed{n}"), names))
    kept = records.where(F.col("kind").isin("page", *fields_of)).withColumns(parsed)
    return kept.withColumn("data", pruned).drop(*parsed)


def read_fields(data: Column, names: str) -> tuple[Column, Column]:
    """The named top-level fields of an object, as texts and with their JSON types."""
    fields = names.split(",")
    return tuple(F.from_json(data, ", ".join(f"`{n}` {kind}" for n in fields)) for kind in ("STRING", "VARIANT"))


def pruned_object(texts: Column, typed: Column, names: str) -> Column:
    """Object text with only the named top-level fields (`read_fields`), in profile order.

    Values keep their own text; the JSON type tells which of them need quotes.
    """
    pairs = []
    for n in names.split(","):
        text = texts.getField(n)
        is_text = F.schema_of_variant(typed.getField(n)) == "STRING"
        pairs.append((n, F.when(is_text, json_string(text)).otherwise(text)))
    return json_object(pairs)
