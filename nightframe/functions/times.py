"""Times. Results are instants; parsing never depends on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_OFFSET = "-1000"  # fixed value: weather files are in Hawaiian standard time, UTC-10


def milliseconds(t: Column) -> Column:
    return F.date_trunc("MILLISECOND", t)


def header_time(vtype: Column, number: Column, text: Column) -> Column:
    """Integer cards are epoch seconds, text cards are ISO seconds in UTC."""
    parsed = F.try_to_timestamp(F.concat(text, F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ssX"))
    return milliseconds(
        F.when(vtype == "int", F.timestamp_seconds(number)).when(vtype == "str", parsed)
    )


def local_minute(text: Column) -> Column:
    """Instant of a local wall clock ``year month day hour minute``; null if impossible.

    One reference to the text, so a filter on the time stays small when it is pushed down.
    """
    zoned = F.concat(text, F.lit(f" {LOCAL_OFFSET}"))
    return F.try_to_timestamp(zoned, F.lit("y M d H m xx"))


# Fixed value: "Tue Jan  2 03:04:05 UTC 2024" with blanks squeezed.
LOG_TIME_PATTERN = r"^[A-Za-z]{3} ([A-Za-z]{3}) (\d{1,2}) (\d{2}:\d{2}:\d{2}) (\S+) (\d{4})$"


def log_time(text: Column) -> Column:
    """Struct of ``time`` and ``zone``: the wall clock is read as UTC, the zone only kept."""
    t = F.trim(F.regexp_replace(text, r"\s+", " "))

    def part(i: int) -> Column:
        return F.regexp_extract(t, LOG_TIME_PATTERN, i)

    wall = F.concat_ws(" ", part(1), part(2), part(3), part(5), F.lit("+0000"))
    return F.struct(
        milliseconds(F.try_to_timestamp(wall, F.lit("MMM d HH:mm:ss yyyy xx"))).alias("time"),
        F.nullif(part(4), F.lit("")).alias("zone"),
    )


def utc_wall_clock(t: Column) -> Column:
    """Instant to its UTC wall clock without zone, whatever the session zone is."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), t.cast("timestamp_ntz"))
