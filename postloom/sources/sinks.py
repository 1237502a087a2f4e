"""Flat table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_csv(flat: DataFrame, path: str, fresh: bool = False) -> None:
    """Append rows; a fresh run replaces the output. Each file has its header."""
    (
        flat.write.mode("overwrite" if fresh else "append")
        .option("header", True)
        # Quotes are doubled and line breaks kept inside quotes.
        .option("escape", '"')
        .option("emptyValue", "")
        .csv(path)
    )


def write_columnar(flat: DataFrame, path: str, append: bool = True, fresh: bool = False) -> None:
    """Append rows, or keep only this run's rows when `append` is off."""
    flat.write.mode("append" if append and not fresh else "overwrite").parquet(path)
