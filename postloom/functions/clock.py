"""Time texts, zones and endpoint choice."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, functions as F

from .coerce import strip

# Fixed value: second-precision UTC text.
UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# Fixed value: how far back the recent endpoint reaches.
RECENT_DAYS = 7


def ntz(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def micros(ts: Column) -> Column:
    """Microseconds since 1970 of a zone-less time."""
    return F.timestamp_diff("MICROSECOND", ntz(F.lit(dt.datetime(1970, 1, 1))), ntz(ts))


def from_micros(us: Column) -> Column:
    return F.timestamp_add("MICROSECOND", us, ntz(F.lit(dt.datetime(1970, 1, 1))))


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, ts)


def utc_text(ts: Column) -> Column:
    """F13"""
    return F.date_format(ts, UTC_FORMAT)


def utc_time(text: Column) -> Column:
    """zone-less UTC time of a `...Z` text."""
    return F.rtrim(text, F.lit("Z")).try_cast("timestamp_ntz")


def as_of_with_lag(as_of: Column, lag_seconds: Column) -> Column:
    """the given clock value minus a lag, cut to whole seconds."""
    return F.date_trunc("second", plus_seconds(as_of, -lag_seconds)).cast("timestamp_ntz")


def local_time(text: Column) -> Column:
    stripped = F.nullif(strip(text), F.lit(""))
    pattern = r"^\d{4}-\d{1,2}-\d{1,2}(T\d{1,2}(:\d{1,2}(:\d{1,2})?)?)?$"
    return F.when(stripped.rlike(pattern), stripped.try_cast("timestamp_ntz"))


def local_to_utc(text: Column, zone: Column) -> Column:
    """zone-less UTC time of a local time text; null when blank."""
    return F.convert_timezone(zone, F.lit("UTC"), local_time(text))


def local_time_error(text: Column, zone: Column, local: Column | None = None, utc: Column | None = None) -> Column:
    """Why a non-blank local time has no single UTC value, else null.

    Both are asked for many times here, so over many rows they should be columns: `local` with
    `local_time(text)` and `utc` with `local_to_utc(text, zone)`.
    """
    local = local_time(text) if local is None else local
    utc = F.convert_timezone(zone, F.lit("UTC"), local) if utc is None else utc

    def same_local(minutes: int) -> Column:
        moved = F.timestamp_add("MINUTE", F.lit(minutes), utc)
        return F.convert_timezone(F.lit("UTC"), zone, moved) == local

    shifts = [same_local(m) for m in (-120, -60, -30, 30, 60, 120)]
    twice = shifts[0]
    for shift in shifts[1:]:
        twice = twice | shift
    return F.when(
        strip(text) != "",
        F.when(local.isNull(), "unreadable_time")
        .when(F.convert_timezone(F.lit("UTC"), zone, utc) != local, "nonexistent_time")
        .when(twice, "ambiguous_time"),
    )


def choose_endpoint(mode: Column, end: Column, as_of: Column) -> Column:
    """a named mode wins; `auto` goes to the archive for ends before the look-back."""
    oldest = plus_seconds(as_of, F.lit(-RECENT_DAYS * 86400))
    return F.when(mode.isin("recent", "all"), mode).when(end < oldest, "all").otherwise("recent")
