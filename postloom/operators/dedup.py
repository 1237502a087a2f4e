"""First-seen dedup and the seen set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .skew import spread_join


def keyed(posts: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows with a non-blank id."""
    return posts.where(F.coalesce(F.col(id_col).cast("string"), F.lit("")) != "")


def first_seen(posts: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """The first row per id in order.

    An aggregate, not a window: each task keeps one row per id before the shuffle, so
    an id repeated by a third of all rows costs one row per task.
    """
    rest = [c for c in posts.columns if c != id_col]
    kept = keyed(posts, id_col).groupBy(id_col).agg(
        F.min_by(F.struct(*rest), F.struct(*order)).alias("_row")
    )
    return kept.select(*[F.col(c) if c == id_col else F.col("_row").getField(c).alias(c) for c in posts.columns])


def unseen(posts: DataFrame, seen: DataFrame, order: list[str], id_col: str = "id") -> DataFrame:
    """First rows whose id is not in the seen set. Ids are single by then, so no key is hot."""
    return first_seen(posts, order, id_col).join(seen.select(id_col), id_col, "left_anti")


def already_seen(posts: DataFrame, seen: DataFrame, spread: list[str], id_col: str = "id") -> DataFrame:
    """Every row whose id is in the seen set; repeated ids are spread over tasks."""
    return spread_join(keyed(posts, id_col), seen.select(id_col), [id_col], spread, "left_semi")


def new_seen(posts: DataFrame, seen: DataFrame, seen_at: Column, id_col: str = "id") -> DataFrame:
    """Rows to append to the seen set, one per id that it lacks."""
    ids = keyed(posts, id_col).select(id_col).distinct()
    return ids.join(seen.select(id_col), id_col, "left_anti").withColumn("seen_at", seen_at)


def seen_count(seen: DataFrame) -> DataFrame:
    """A1"""
    return seen.agg(F.count(F.lit(1)).alias("seen_count"))


def merge_logs(logs: list[DataFrame]) -> DataFrame:
    """One frame from several logs; `source_rank` keeps the order they were taken in."""
    ranked = [log.withColumn("source_rank", F.lit(i)) for i, log in enumerate(logs)]
    return reduce(DataFrame.unionByName, ranked)


def dedup_logs(logs: list[DataFrame], order: list[str], seen: DataFrame | None = None, id_col: str = "id") -> DataFrame:
    """Logs that share one seen set; the earlier log wins."""
    merged = merge_logs(logs)
    ranked = ["source_rank", *order]
    return first_seen(merged, ranked, id_col) if seen is None else unseen(merged, seen, ranked, id_col)
