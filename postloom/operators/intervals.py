"""Range joins of posts with time windows and gaps.

Time is a binary tree: a node of level 0 is a unit of about a minute, a node of level k two nodes
of level k - 1. A window is the O(log n) nodes that make it up, so ten years are under fifty
rows; a post is asked for at its ancestors, one per level that any window uses. The range
condition becomes an equality of nodes, and a post meets a window in one node only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.clock import from_micros, micros
from ..runtime import durable
from .dedup import unseen
from .skew import lookup_join, spread_join

# Microseconds of a unit, a power of two so that shifts find it exactly, and the unit that is
# numbered zero: far before any time.
SHIFT = 26
UNIT = 1 << SHIFT
ORIGIN = 1 << 33
LEVELS = 35


def unit_of(ts: Column) -> Column:
    """Number of the unit that holds a time."""
    return F.shiftright(micros(ts), SHIFT) + ORIGIN


def unit_after(ts: Column) -> Column:
    """Number of the first unit that begins at a time or later."""
    return F.shiftright(micros(ts) + (UNIT - 1), SHIFT) + ORIGIN


def unit_start(unit: Column) -> Column:
    return from_micros((unit - ORIGIN) * UNIT)


def with_nodes(rows: DataFrame, first: Column, behind: Column) -> DataFrame:
    """A row per tree node of the units from `first` up to, not including, `behind`: adds `level` and
    `node`. At most two nodes per level; none where there are no units."""
    low = F.expr("shiftright(_first + shiftleft(1L, level) - 1, level)")
    high = F.expr("shiftright(_behind, level)")
    # What a level can't hand to the next one: an odd first node, and an odd number of nodes behind it.
    odd_low = F.when(low.bitwiseAND(F.lit(1)) == 1, low)
    odd_high = F.when(high.bitwiseAND(F.lit(1)) == 1, high - 1)
    return (
        rows.withColumns({"_first": first, "_behind": behind})
        .where("_first < _behind")
        .withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
        .where(low < high)
        .withColumn("node", F.explode(F.array_compact(F.array(odd_low, odd_high))))
        .drop("_first", "_behind")
    )


def used_levels(pieces: DataFrame) -> list[int]:
    """The levels that any piece is at; at most `LEVELS`."""
    return sorted(r.level for r in pieces.select("level").distinct().collect())


def at_ancestors(posts: DataFrame, ts: str, levels: list[int]) -> DataFrame:
    """A row per post and level: adds `level` and `node`. Posts without a time have none."""
    unit = unit_of(F.col(ts))
    nodes = [
        F.struct(F.lit(k).alias("level"), F.shiftright(unit, k).alias("node")) for k in levels
    ]
    if not nodes:
        return posts.where(F.lit(False)).withColumns({"level": F.lit(0), "node": F.lit(0).cast("bigint")})
    asked = posts.where(F.col(ts).isNotNull()).withColumn("_n", F.explode(F.array(*nodes)))
    return asked.withColumns({"level": F.col("_n.level"), "node": F.col("_n.node")}).drop("_n")


def window_join(
    posts: DataFrame,
    windows: DataFrame,
    spread: list[str],
    ts: str = "ts",
    start: str = "start_time",
    end: str = "end_time",
) -> DataFrame:
    """Each post with each window it falls into.

    The nodes of a window cover it and, at its ends, up to a unit more, so the bounds are
    checked behind the join. Few windows are broadcast after a check of their size; for many,
    busy nodes are spread. A null start reaches back without limit, at no cost.
    """
    first = F.coalesce(unit_of(F.col(start)), F.lit(0).cast("bigint"))
    real = windows.where(F.col(start).isNull() | (F.col(start) < F.col(end)))
    pieces = with_nodes(real, first, unit_after(F.col(end)))
    placed = at_ancestors(posts, ts, used_levels(pieces))
    inside = (F.col(start).isNull() | (F.col(ts) >= F.col(start))) & (F.col(ts) < F.col(end))
    joined = lookup_join(placed, pieces, ["level", "node"], spread, "inner")
    return joined.where(inside).drop("level", "node", start, end)


def ragged_ends(spans: DataFrame, start: str, end: str) -> DataFrame:
    """What is left of intervals beside whole units: `node` (the unit) and clipped bounds."""
    first, behind = unit_after(F.col(start)), unit_of(F.col(end))
    piece = lambda unit, low, high: F.struct(unit.alias("node"), low.alias(start), high.alias(end))
    within = F.when(first > behind, piece(behind, F.col(start), F.col(end)))
    left = F.when(first <= behind, piece(first - 1, F.col(start), unit_start(first)))
    right = F.when(first <= behind, piece(behind, unit_start(behind), F.col(end)))
    ends = spans.select(F.explode(F.array_compact(F.array(within, left, right))).alias("p")).select("p.*")
    return ends.where(F.col(start) < F.col(end))


def merged_intervals(cut: DataFrame, start: str, end: str, keys: list[str]) -> DataFrame:
    """Disjoint union of the intervals of each group of keys.

    Equal starts are folded before the shuffle; what remains in a group is bounded by
    the distinct starts in it.
    """
    group = list(keys)
    folded = cut.groupBy(*group, start).agg(F.max(end).alias(end))
    ordered = Window.partitionBy(*group).orderBy(start)
    reach = F.max(end).over(ordered.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce((F.col(start) > reach).cast("int"), F.lit(1))
    return (
        folded.withColumn("_opens", opens)
        .withColumn("_island", F.sum("_opens").over(ordered))
        .groupBy(*group, "_island")
        .agg(F.min(start).alias(start), F.max(end).alias(end))
        .drop("_island")
    )


def gap_backfill(
    archive: DataFrame,
    gaps: DataFrame,
    seen: DataFrame,
    order: list[str],
    id_col: str = "id",
    ts: str = "ts",
) -> DataFrame:
    """Archive posts inside any gap that were not collected yet.

    The whole units of a gap are tree nodes, each once however many gaps share it. Which units
    they cover is found once per unit that holds a post, not per post. The ends of less than a
    unit are merged per unit, so a post meets its unit as a whole or at most one of them. No
    pairs are built, and a post stays one row.
    """
    spans = gaps.select(F.col("start_time_utc").alias("_start"), F.col("end_time_utc").alias("_end")).where("_start < _end")
    spans = durable(spans.distinct(), "spans")  # read for the nodes and for the ends
    nodes = with_nodes(spans, unit_after(F.col("_start")), unit_of(F.col("_end"))).select("level", "node").distinct()
    ends = merged_intervals(ragged_ends(spans, "_start", "_end"), "_start", "_end", ["node"])
    timed = archive.where(F.col(ts).isNotNull()).withColumn("_unit", unit_of(F.col(ts)))
    bare = F.lit(None).cast(spans.schema["_start"].dataType)
    whole = covered_units(timed.select("_unit").distinct(), nodes).select("_unit", bare.alias("_start"), bare.alias("_end"))
    pieces = durable(whole.unionByName(ends.withColumnRenamed("node", "_unit")), "pieces")
    inside = F.col("_start").isNull() | ((F.col(ts) >= F.col("_start")) & (F.col(ts) < F.col("_end")))
    hit = spread_join(timed, pieces, ["_unit"], order, "left_semi", residual=inside)
    return unseen(hit.drop("_unit"), seen, order, id_col)


def covered_units(units: DataFrame, nodes: DataFrame) -> DataFrame:
    """The units (`_unit`) that any tree node covers, each once."""
    nodes = durable(nodes, "nodes")
    asked = at_ancestors(units.withColumn("_at", unit_start(F.col("_unit"))), "_at", used_levels(nodes))
    return spread_join(asked, nodes, ["level", "node"], ["_unit"], "left_semi").select("_unit").distinct()
