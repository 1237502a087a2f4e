"""Joins that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Rows of one key that one task takes. Over HOT_KEYS times as many rows in all, a task takes
# 1/HOT_KEYS of them, so that fewer than HOT_KEYS keys are hot however large the data is.
TASK_ROWS = 100_000
HOT_KEYS = 100_000
# Most rows and bytes of a lookup side that is sent to every task.
SMALL_ROWS = 100_000
SMALL_BYTES = 32 * 1024 * 1024


def is_small(lookup: DataFrame) -> bool:
    """Whether a lookup side stays under both bounds; reads at most SMALL_ROWS + 1 rows of it."""
    size = (
        lookup.limit(SMALL_ROWS + 1)
        .select(F.octet_length(F.to_json(F.struct("*"))).alias("n"))
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("n"), F.lit(0)).alias("bytes"))
        .head()
    )
    return size.rows <= SMALL_ROWS and size.bytes <= SMALL_BYTES


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: list[str], spread: list[str], how: str = "left"
) -> DataFrame:
    """Join with a side that is small as a rule, such as rules or tasks.

    The size is checked first: a small side is broadcast, any other goes through
    `spread_join`. Both give the same rows.
    """
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), keys, how)
    return spread_join(rows, lookup, keys, spread, how)


def hot_keys(rows: DataFrame, keys: list[str], task_rows: int = TASK_ROWS) -> DataFrame:
    """Keys with more rows than one task takes, and `_salts`, the tasks that their count asks
    for: fewer than HOT_KEYS rows by the pigeonhole principle."""
    counted = rows.select(*keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    # Summed from the counts, so the exchange of the counting pass is reused.
    total = counted.agg(F.sum("_n")).scalar()
    most = F.greatest(F.lit(task_rows), F.ceil(total / F.lit(HOT_KEYS)))
    return counted.where(F.col("_n") > most).select(*keys, F.ceil(F.col("_n") / most).cast("int").alias("_salts"))


def spread_join(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    spread: list[str],
    how: str = "left",
    task_rows: int = TASK_ROWS,
    residual: Column | None = None,
) -> DataFrame:
    """Equi-join of a big side with a lookup side, hot keys spread over as many tasks as
    their counts ask for.

    `spread` names columns that tell apart the rows of one key; the salt is a
    hash of them, so a re-run task gives every row the same salt. Only lookup
    rows of hot keys are repeated, once per salt. `how` is left, inner,
    left_semi or left_anti; `residual` is a further join condition over columns whose
    names differ between the sides. The list of hot keys is broadcast: it has fewer than
    HOT_KEYS rows of key columns.
    """
    hot = F.broadcast(hot_keys(rows, keys, task_rows))
    salts = F.coalesce("_salts", F.lit(1))
    left = rows.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
    copies = F.explode(F.sequence(F.lit(0), salts - 1))
    right = lookup.join(hot, keys, "left").withColumn("_salt", copies).drop("_salts")
    if residual is None:
        return left.drop("_salts").join(right, [*keys, "_salt"], how).drop("_salt")
    matched = residual
    for key in (*keys, "_salt"):
        right = right.withColumnRenamed(key, f"_r{key}")
        matched = matched & (F.col(key) == F.col(f"_r{key}"))
    joined = left.drop("_salts").join(right, matched, how)
    return joined.drop("_salt", *[f"_r{key}" for key in (*keys, "_salt")])
