"""Rotation of a log by size and by age."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.clock import micros
from ..operators.order import ORDER, carry, range_splits
from ..operators.skew import lookup_join
from ..runtime import durable


def cut_log(lines: DataFrame, rotate_bytes: int = 0, rotate_seconds: int = 0, at: str | None = None) -> DataFrame:
    """Add `slot` and `piece`, which together number the file of each line, rising in order.

    `lines` has the order key, `value` and, for an age limit, the time `at`. A slot is
    `rotate_seconds` of the log's own time, which never runs backwards: an earlier time counts
    as the latest before it. Inside a slot a new piece begins with each `rotate_bytes`. A line
    belongs to the piece that its first byte falls into, so a file is longer than the limit by
    less than its last line, and numbers without a line leave no file.

    The running numbers are sums and maxima inside ordered splits, and a summary with a row
    per split carries them on, so no task reads the whole log.
    """
    timed = rotate_seconds > 0
    sized = lines.withColumn("_len", (F.octet_length("value") + 1).cast("bigint")).withColumn(
        "_at", micros(F.col(at)) if timed else F.lit(0).cast("bigint")
    )
    cut = range_splits(sized, list(ORDER), "rotation")
    ends = cut.groupBy("split").agg(F.sum("_len").alias("len"), F.max("_at").alias("latest"))
    summary = carry(ends, [], ["split"], sums=("len",))
    earlier = Window.orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    before = summary.select("split", "len_before", F.max("latest").over(earlier).alias("_latest"))
    local = Window.partitionBy("split").orderBy(*ORDER)
    start = F.coalesce(F.sum("_len").over(local.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    now = F.max("_at").over(local.rowsBetween(Window.unboundedPreceding, 0))
    # Rows of a split meet the one row of its summary.
    placed = cut.withColumns({"_start": start, "_now": now}).join(before, "split")
    placed = placed.withColumns({"_start": F.col("_start") + F.col("len_before"), "_now": F.greatest("_now", "_latest")})
    first = cut.agg(F.min_by("_at", F.struct(*ORDER))).scalar()
    slot = F.floor((F.col("_now") - first) / (rotate_seconds * 1_000_000)) if timed else F.lit(0)
    placed = placed.withColumn("slot", slot.cast("bigint")).drop("split", "len_before", "_latest", "_at", "_now", "_len")
    if rotate_bytes <= 0:
        return placed.withColumn("piece", F.lit(0).cast("bigint")).drop("_start")
    if timed:
        # Written, as its size is checked before it is joined.
        opens = durable(placed.groupBy("slot").agg(F.min("_start").alias("_open")), "opens")
        placed = lookup_join(placed, opens, ["slot"], list(ORDER), "inner")
    else:
        placed = placed.withColumn("_open", F.lit(0))
    piece = F.floor((F.col("_start") - F.col("_open")) / rotate_bytes).cast("bigint")
    return placed.withColumn("piece", piece).drop("_start", "_open")


def write_cut(cut: DataFrame, path: str, compress: bool = False) -> None:
    """One text file under `path/slot=*/piece=*` for each file of `cut_log`, in order."""
    key = ["slot", "piece"]
    lines = cut.repartition(*key).sortWithinPartitions(*key, *ORDER).select("value", *key)
    writer = lines.write.partitionBy(*key)
    (writer.option("compression", "gzip") if compress else writer).text(path)


def numbered(path: str) -> tuple[int, int]:
    """Slot and piece of a file that `write_cut` wrote."""
    slot, piece = path.rsplit("/", 3)[1:3]
    return int(slot.removeprefix("slot=")), int(piece.removeprefix("piece="))
