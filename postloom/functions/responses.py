"""Response classification and wait times over a response log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .texts import ERROR_COLUMNS, ascii_lower, error_detail, error_metadata, read_errors

# Fixed value: least wait after a rate limit on a stream.
STREAM_MIN_WAIT = 60
# Wordings of an exhausted usage cap.
USAGE_CAP_TEXTS = ("usage-capped", "usage capped", "usage cap")


def header_int(text: Column) -> Column:
    """Header integer; 0 when absent or unreadable."""
    return F.coalesce(text.try_cast("bigint"), F.lit(0))


def wait_seconds(retry_after: Column, reset: Column, now_epoch: Column, least: int = 30) -> Column:
    """F21"""
    by_reset = F.when(reset > 0, F.greatest(reset - now_epoch + 1, F.lit(0))).otherwise(0)
    return F.greatest(F.lit(least), retry_after, by_reset).cast("bigint")


def classify_responses(log: DataFrame) -> DataFrame:
    """outcome of every logged response.

    Reads `status, body, now_epoch` and the header texts `rate_limit_limit,
    rate_limit_remaining, rate_limit_reset, retry_after`.
    """
    headers = ("rate_limit_limit", "rate_limit_remaining", "rate_limit_reset", "retry_after")
    ok = F.col("status") == 200
    limited = F.col("status") == 429
    server = (F.col("status") >= 500) & (F.col("status") < 600)
    # One pass over the body first, so every later column reads a plain struct.
    read = read_errors(log).withColumns(
        {
            "_meta": F.when(~ok, error_metadata()),
            **{
                name: F.when(limited | server, header_int(F.col(name))).otherwise(0).cast("bigint")
                for name in headers
            },
        }
    )
    words = ascii_lower(F.concat_ws(" ", "_meta.type", "_meta.title", "_meta.detail"))
    capped = words.contains(USAGE_CAP_TEXTS[0])
    for text in USAGE_CAP_TEXTS[1:]:
        capped = capped | words.contains(text)
    reason = (
        F.when(ok, "")
        .when(limited & capped, "usage_capped")
        .when(limited, "rate_limited")
        .when(server, "server_error")
        .otherwise("api_error")
    )
    named = read.withColumn("stop_reason", reason)
    why = F.col("stop_reason")
    wait = wait_seconds(F.col("retry_after"), F.col("rate_limit_reset"), F.col("now_epoch"), STREAM_MIN_WAIT)
    return named.withColumns(
        {
            "kind": F.when(ok, "ok")
            .when(why == "usage_capped", "terminal")
            .when(why.isin("rate_limited", "server_error"), "retryable")
            .otherwise("error"),
            "wait_seconds": F.when(why == "rate_limited", wait).otherwise(0).cast("bigint"),
            "error": F.when(ok, "")
            .when(why == "usage_capped", "usage cap exceeded")
            .when(why == "rate_limited", "rate limited")
            .when(why == "server_error", "server error")
            .otherwise("api error"),
            "error_type": F.when(ok, "").when(why == "api_error", "api_error").otherwise(F.col("_meta.type")),
            "error_detail": F.when(ok, "")
            .when(why == "api_error", error_detail())
            .otherwise(F.col("_meta.detail")),
        }
    ).drop("_meta", *ERROR_COLUMNS)
