"""Stream lines, bodies and error texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .coerce import json_items, strip, text_or

# Fixed value: bytes shown of a body that is not UTF-8.
HEX_BYTES = 48
# Fixed value: path of the archive endpoint.
ARCHIVE_PATH = "/2/tweets/search/all"
# Words that mark a denied archive request.
ARCHIVE_WORDS = ("full-archive", "full archive", "enterprise", "self-serve", "upgrade", "access")


def stream_payload(line: Column) -> Column:
    """payload of a stream line; null for a keepalive."""
    text = strip(line)
    payload = F.when(text.startswith("data:"), strip(F.substr(text, F.lit(6)))).otherwise(text)
    return F.when((payload != "") & (payload != "[DONE]"), payload)


def ascii_lower(text: Column) -> Column:
    """F16: lower-case text, other characters become blanks."""
    return F.lower(F.regexp_replace(text, r"[^\x00-\x7F]", " "))


def safe_text(body: Column, label: str = "response body") -> Column:
    """readable text of a binary column."""
    size = F.octet_length(body)
    shown = F.lower(F.hex(F.substring(body, 1, HEX_BYTES)))
    marker = F.concat(
        F.lit(f"<non-UTF-8 {label}: "),
        size.cast("string"),
        F.lit(" bytes; hex="),
        shown,
        F.when(size > HEX_BYTES, "...").otherwise(""),
        F.lit(">"),
    )
    text = body.cast("string")
    return F.when(F.is_valid_utf8(text), text).otherwise(marker)


def read_errors(log: DataFrame, body: str = "body") -> DataFrame:
    """Parse an error body once: adds `_text`, `_is_json`, `_body` and the `_errors` list.

    `error_metadata` and `error_detail` are columns over these.
    """
    fields = "type STRING, title STRING, detail STRING"
    ddl = f"{fields}, errors STRING, _bad STRING"
    return (
        log.withColumn("_text", strip(F.coalesce(F.col(body), F.lit(""))))
        .withColumn("_body", F.from_json("_text", ddl, {"columnNameOfCorruptRecord": "_bad"}))
        .withColumns(
            {
                "_is_json": (F.col("_text") != "")
                & (F.col("_body._bad").isNull() | F.try_parse_json("_text").isNotNull()),
                "_errors": F.transform(
                    json_items(F.col("_body.errors")), lambda e: F.from_json(e, f"{fields}, status STRING")
                ),
            }
        )
    )


ERROR_COLUMNS = ("_text", "_is_json", "_body", "_errors")


def error_metadata() -> Column:
    """struct (type, title, detail) of an error body, over `read_errors`."""
    names = ("type", "title", "detail")
    first = F.get("_errors", 0)
    all_blank = F.lit(True)
    for name in names:
        all_blank = all_blank & (text_or(F.col(f"_body.{name}")) == "")
    parts = []
    for name in names:
        own = F.when(all_blank, text_or(first[name])).otherwise(text_or(F.col(f"_body.{name}")))
        plain = F.col("_text") if name == "detail" else F.lit("")
        parts.append(F.when(F.col("_is_json"), own).otherwise(plain).alias(name))
    return F.struct(*parts)


def error_detail() -> Column:
    """Distinct non-blank message parts joined by ` | `, over `read_errors`.

    The body itself when there are none.
    """

    def piece(err: Column) -> Column:
        # Nulls and blanks leave no separator behind.
        return F.concat_ws(" / ", *[F.nullif(err[n], F.lit("")) for n in ("title", "detail", "status")])

    parts = F.concat(F.array("_body.title", "_body.detail"), F.transform("_errors", piece))
    parts = F.array_distinct(F.filter(F.transform(parts, strip), lambda p: p != ""))
    return F.when(F.col("_is_json") & (F.size(parts) > 0), F.array_join(parts, " | ")).otherwise(F.col("_text"))


def is_invalid_page_token(body: Column) -> Column:
    """F22"""
    text = ascii_lower(body)
    # "next_token" already holds "token", so only "pagination" needs the extra word.
    named = text.contains("next_token") | text.contains("pagination")
    return named & text.contains("token") & text.contains("invalid")


def is_archive_denied(status: Column, url: Column, body: Column) -> Column:
    """F22"""
    text = ascii_lower(body)
    named = text.contains(ARCHIVE_WORDS[0])
    for word in ARCHIVE_WORDS[1:]:
        named = named | text.contains(word)
    return (status == 403) & url.contains(ARCHIVE_PATH) & named


def is_timeout(message: Column) -> Column:
    """F22"""
    text = ascii_lower(message)
    return text.contains("timeout") | text.contains("timed out")
