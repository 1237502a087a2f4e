"""Total order, ordered scans in pieces, and lookup segments.

A plain window over a whole log, or over one busy stream, runs in a single task.
Here rows are first cut into *splits* that follow each other in order. Windows
run inside a split; a summary with one row per split is scanned for what a split
must know about the splits before and after it, and is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..runtime import durable

# Order key of every envelope record: log file or task, block in it, record in the block.
ORDER = ("log", "block", "seq")
SPLIT = ("log", "block")
# Rows of one ordered range.
RANGE_ROWS = 1_000_000


def range_splits(rows: DataFrame, order: list[str], name: str = "splits") -> DataFrame:
    """Cut rows into even, ordered ranges; adds `split`.

    Range bounds come from sampling, so the result is written once: every later
    pass must see the same split for a row.
    """
    cut = rows.repartitionByRange(range_count(rows), *order).withColumn("split", F.spark_partition_id())
    return durable(cut, name)


def range_count(rows: DataFrame) -> int:
    """How many ranges keep each under about `RANGE_ROWS` rows."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-rows.count() // RANGE_ROWS))


def carry(
    summary: DataFrame,
    keys: list[str],
    order: list[str],
    sums: tuple[str, ...] = (),
    prev: tuple[str, ...] = (),
    following: tuple[str, ...] = (),
) -> DataFrame:
    """Per split: sum before it, last non-null before it, first non-null after it.

    Adds `<c>_before`, `<c>_prev` and `<c>_next`.
    """
    ordered = Window.partitionBy(*keys).orderBy(*order)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # Frames that reach to the end are read again for every row; running backwards is one pass.
    backwards = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    added: dict[str, Column] = {}
    for c in sums:
        added[f"{c}_before"] = F.coalesce(F.sum(c).over(earlier), F.lit(0))
    for c in prev:
        added[f"{c}_prev"] = F.last(c, ignorenulls=True).over(earlier)
    for c in following:
        added[f"{c}_next"] = F.last(c, ignorenulls=True).over(later)
    return summary.withColumns(added)


def carry_in_log(
    summary: DataFrame,
    sums: tuple[str, ...] = (),
    prev: tuple[str, ...] = (),
    following: tuple[str, ...] = (),
) -> DataFrame:
    """`carry` over all splits of all files in two steps: inside a file, then over files.

    The widest window then holds the splits of one file or one row per file.
    """
    inside = carry(summary, ["log"], ["block"], sums, prev, following)
    per_file = summary.groupBy("log").agg(
        *[F.sum(c).alias(c) for c in sums],
        *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("block"))).alias(f"{c}_l") for c in prev],
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("block"))).alias(f"{c}_f") for c in following],
    )
    files = carry(
        per_file, [], ["log"], sums, tuple(f"{c}_l" for c in prev), tuple(f"{c}_f" for c in following)
    ).select(
        "log",
        *[F.col(f"{c}_before").alias(f"_{c}_before") for c in sums],
        *[F.col(f"{c}_l_prev").alias(f"_{c}_prev") for c in prev],
        *[F.col(f"{c}_f_next").alias(f"_{c}_next") for c in following],
    )
    merged: dict[str, Column] = {}
    for c in sums:
        merged[f"{c}_before"] = F.col(f"{c}_before") + F.col(f"_{c}_before")
    for c in prev:
        merged[f"{c}_prev"] = F.coalesce(f"{c}_prev", f"_{c}_prev")
    for c in following:
        merged[f"{c}_next"] = F.coalesce(f"{c}_next", f"_{c}_next")
    return inside.join(files, "log").withColumns(merged).drop(*[f"_{m}" for m in merged])


def kind_class(kind: Column) -> Column:
    """`t`, `i` or `p` for known kinds, null for the others."""
    return (
        F.when(kind == "tweet", "t").when(kind.startswith("include:"), "i").when(kind == "page", "p")
    )


def segment_records(records: DataFrame, valve: int | None = None) -> DataFrame:
    """Add `segment` and `part`, the scope of a record's lookups.

    `records` has the order key, `kind` and `data`. Unknown kinds are dropped, as
    are includes behind the last post (no post can use them).
    """
    return records.join(segments_of(records, valve), list(ORDER))


def segments_of(records: DataFrame, valve: int | None = None) -> DataFrame:
    """Order key, `segment` and `part` of every record that has a scope; no payloads.

    Only the order key, the kind and whether there is a payload are shuffled, once, by
    split; everything else runs on one row per split. Records that were written with a column
    `has_data` are read without their payloads. `valve` (W3) starts a new part
    after so many posts of a segment; those then don't see what follows. Off by default.
    """
    has_data = F.col("has_data") if "has_data" in records.columns else F.col("data").isNotNull()
    records = records.select(*ORDER, "kind", has_data.alias("has_data"))
    local = Window.partitionBy(*SPLIT).orderBy("seq")
    running = local.rowsBetween(Window.unboundedPreceding, 0)
    backwards = Window.partitionBy(*SPLIT).orderBy(F.col("seq").desc())
    ahead = backwards.rowsBetween(Window.unboundedPreceding, 0)
    is_post = (F.col("cls") == "t") & F.col("has_data")

    marked = (
        records.withColumn("cls", kind_class(F.col("kind")))
        .where("cls is not null")
        .withColumn("_post", is_post.cast("int"))
        .withColumn("_last", F.lag("cls").over(local))
        # The first record of a split learns its predecessor from the carry.
        .withColumn(
            "_mark",
            ((F.col("cls") == "p") | ((F.col("cls") == "t") & F.col("_last").isin("i", "p"))).cast("int"),
        )
        .withColumn("_mark", F.coalesce("_mark", F.lit(0)))
        .withColumn("_marks", F.sum("_mark").over(running))
        .withColumn("_posts", F.sum("_post").over(running))
        .withColumn("_seg_post", F.when(F.col("_post") == 1, F.col("_marks")))
        .withColumn("_base", F.when(F.col("_mark") == 1, F.col("_posts") - F.col("_post")))
    )
    at = F.col("seq")
    summary = marked.groupBy(*SPLIT).agg(
        F.min_by("cls", at).alias("first_cls"),
        F.max_by("cls", at).alias("last_cls"),
        F.sum("_mark").alias("marks"),
        F.sum("_post").alias("posts"),
        F.max("_base").alias("base"),
        F.min("_seg_post").alias("first_seg"),
        F.max("_seg_post").alias("last_seg"),
    )
    opening = (F.col("first_cls") == "t") & F.coalesce(F.col("last_cls_prev").isin("i", "p"), F.lit(False))
    opened = carry_in_log(summary, prev=("last_cls",)).withColumn("opens", opening.cast("int"))
    opened = opened.withColumn("marks", F.col("marks") + F.col("opens"))
    counted = carry_in_log(opened, sums=("marks", "posts"))
    first_mark = F.col("marks_before") + F.col("opens")
    placed = counted.withColumns(
        {
            "base": F.coalesce("base", F.when(F.col("opens") == 1, 0)) + F.col("posts_before"),
            "first_seg": F.col("first_seg") + first_mark,
            "last_seg": F.col("last_seg") + first_mark,
        }
    )
    carried = carry_in_log(placed, prev=("base", "last_seg"), following=("first_seg",)).select(
        *SPLIT,
        first_mark.alias("_first_mark"),
        F.col("posts_before").alias("_posts_before"),
        F.coalesce(
            F.when(F.col("opens") == 1, F.col("posts_before")), F.col("base_prev"), F.lit(0)
        ).alias("_base_in"),
        F.col("last_seg_prev").alias("_seg_in"),
        F.col("first_seg_next").alias("_seg_out"),
    )

    here = F.col("_marks") + F.col("_first_mark")
    seen = F.col("_seg_seen") == F.col("_raw")
    rank = F.col("_posts") + F.col("_posts_before") - F.col("_base_here")
    return (
        marked.withColumn("_seg_seen", F.last("_seg_post", ignorenulls=True).over(running))
        .withColumn("_seg_ahead", F.last("_seg_post", ignorenulls=True).over(ahead))
        .withColumn("_base_here", F.last("_base", ignorenulls=True).over(running))
        .join(carried, list(SPLIT))
        .withColumns(
            {
                "_raw": here,
                "_seg_seen": F.coalesce(F.col("_seg_seen") + F.col("_first_mark"), F.col("_seg_in")),
                "_seg_ahead": F.coalesce(F.col("_seg_ahead") + F.col("_first_mark"), F.col("_seg_out")),
                "_base_here": F.coalesce(F.col("_base_here") + F.col("_posts_before"), F.col("_base_in")),
            }
        )
        .withColumns(
            {
                "_in_seg": F.coalesce(seen, F.lit(False)),
            }
        )
        .withColumns(
            {
                "segment": F.when(F.col("_in_seg"), F.col("_raw")).otherwise(F.col("_seg_ahead")),
                "part": F.lit(0).cast("bigint")
                if valve is None
                else F.when(F.col("_in_seg"), F.greatest(F.floor((rank - 1) / valve), F.lit(0))).otherwise(0).cast("bigint"),
            }
        )
        .where("segment is not null")
        .select(*ORDER, "segment", "part")
    )


def page_scope(records: DataFrame) -> DataFrame:
    """Scope of records from our own normalizers, where a block is one page or event."""
    return records.where(kind_class(F.col("kind")).isNotNull()).withColumns(
        {"segment": F.struct("log", "block"), "part": F.lit(0).cast("bigint")}
    )


def last_known_kind(records: DataFrame) -> DataFrame:
    """Known records with the kind class of the record before them."""
    known = records.withColumn("cls", kind_class(F.col("kind"))).where("cls is not null")
    local = Window.partitionBy(*SPLIT).orderBy("seq")
    inside = known.withColumn("_lag", F.lag("cls").over(local))
    ends = known.groupBy(*SPLIT).agg(F.max_by("cls", "seq").alias("last_cls"))
    before = carry_in_log(ends, prev=("last_cls",)).select(*SPLIT, "last_cls_prev")
    return (
        inside.join(before, list(SPLIT), "left")
        .withColumn("last_kind", F.coalesce("_lag", "last_cls_prev", F.lit("none")))
        .drop("_lag", "last_cls_prev", "cls")
    )
