"""Page-aligned limit."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.pages import running_total
from .skew import lookup_join


def cutoff_pages(new_posts: DataFrame, target: int) -> DataFrame:
    """Last page kept per log: the first one at which the running total reaches the target.

    `new_posts` has `log` and `block` (page number). The running sum runs over pages, in
    runs of page numbers, never over posts.
    """
    counts = new_posts.groupBy("log", "block").agg(F.count(F.lit(1)).alias("n"))
    totals = running_total(counts, "n", "total")
    return (
        totals.where(F.col("total") - F.col("n") < target)
        .groupBy("log")
        .agg(F.max("block").alias("last_block"), F.max("total").alias("total_posts"))
    )


def page_limit(rows: DataFrame, new_posts: DataFrame, target: int, spread: list[str]) -> DataFrame:
    """Rows of the pages up to the one that reaches the target, that page in full."""
    if target <= 0:
        return rows
    kept = cutoff_pages(new_posts, target).drop("total_posts")
    joined = lookup_join(rows, kept, ["log"], spread, "inner")
    return joined.where(F.col("block") <= F.col("last_block")).select(*rows.columns)
