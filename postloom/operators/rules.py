"""Rule reconciliation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def reconcile_rules(desired: DataFrame, current: DataFrame) -> DataFrame:
    """Steps that bring the standing rules to the desired ones, by tag.

    `desired` has `tag, value, replace`; `current` has `id, value, tag`. Creation (step 1)
    comes before deletion (step 2), so a failed creation deletes nothing. Rules of other
    tags are left alone. Works on one row per desired tag; old ids of a replaced tag stay
    rows, they are not collected.
    """
    want = desired.select("tag", F.col("value").alias("_want"), "replace")
    both = want.join(current.select("tag", "id", "value"), "tag", "left")
    same = F.col("value") == F.col("_want")
    blank = F.coalesce(F.col("id"), F.lit("")) == ""
    by_tag = both.groupBy("tag", "_want", "replace").agg(
        F.count("value").alias("_rules"),
        F.count_if(same).alias("_same"),
        F.min(F.when(same, F.nullif("id", F.lit("")))).alias("_same_id"),
        F.count_if(F.col("value").isNotNull() & blank).alias("_no_id"),
    )
    action = (
        F.when(F.col("_same") > 0, "reuse")
        .when(F.col("_rules") == 0, "create")
        .when(~F.col("replace"), "conflict")
        .when(F.col("_no_id") > 0, "error")
        .otherwise("replace")
    )
    planned = by_tag.withColumn("_action", action)
    heads = planned.select(
        "tag",
        F.lit(1).alias("step"),
        F.when(F.col("_action") == "replace", "create").otherwise(F.col("_action")).alias("action"),
        F.col("_want").alias("value"),
        F.when(F.col("_action") == "reuse", F.col("_same_id")).alias("rule_id"),
        F.when(F.col("_action") == "conflict", "tag already exists with a different value")
        .when(F.col("_action") == "error", "a conflicting rule has no id")
        .alias("error"),
    )
    drops = current.join(planned.where("_action = 'replace'").select("tag"), "tag").select(
        "tag",
        F.lit(2).alias("step"),
        F.lit("delete").alias("action"),
        "value",
        F.col("id").alias("rule_id"),
        F.lit(None).cast("string").alias("error"),
    )
    return heads.unionByName(drops)
