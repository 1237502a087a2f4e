"""Collection: captured pages or events to envelope records and a seen set."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.dedup import unseen
from ..operators.limits import page_limit
from ..operators.order import ORDER
from ..runtime import durable
from ..sources.pages import delivered_posts, number_events, search_envelope, stream_envelope


@dataclass(frozen=True)
class Collected:
    """What one run adds: envelope records and seen ids."""

    records: DataFrame
    new_posts: DataFrame
    seen: DataFrame


def _seen_rows(new_posts: DataFrame, seen_at: Column) -> DataFrame:
    return new_posts.select("id", seen_at.alias("seen_at"))


def collect_pages(
    pages: DataFrame,
    seen: DataFrame,
    seen_at: Column,
    endpoint: str = "recent",
    target_posts: int = 0,
    write_includes: bool = True,
) -> Collected:
    """A search run over captured pages (`log`, `block`, `body`).

    Pages behind the one that reaches `target_posts` are left out, as they would not have
    been asked for. Records are written before ids count as seen: the seen rows come from
    the same new posts and are appended after them.
    """
    # Written first: everything below is derived from the written posts.
    new_posts = durable(unseen(delivered_posts(pages), seen, list(ORDER)), "new_posts")
    if target_posts > 0:
        pages = page_limit(pages, new_posts, target_posts, ["block"])
        new_posts = page_limit(new_posts, new_posts, target_posts, ["id"])
    records = search_envelope(pages, new_posts, endpoint, write_includes)
    return Collected(records, new_posts, _seen_rows(new_posts, seen_at))


def collect_events(
    lines: DataFrame,
    seen: DataFrame,
    seen_at: Column,
    max_posts: int = 0,
    write_includes: bool = True,
) -> Collected:
    """A stream run over captured lines (`log`, `block` = event number, `value`, `received_at`)."""
    events = number_events(lines).where("body is not null")
    new_posts = durable(unseen(delivered_posts(events), seen, list(ORDER)), "new_posts")
    if max_posts > 0:
        events = page_limit(events, new_posts, max_posts, ["block"])
        new_posts = page_limit(new_posts, new_posts, max_posts, ["id"])
    records = stream_envelope(events, new_posts, write_includes)
    return Collected(records, new_posts, _seen_rows(new_posts, seen_at))
