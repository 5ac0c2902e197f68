"""Detector-on events in run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.functions import times

# The marker and the form of an event line; blanks at the end are required.
EVENT_MARKER = "SNIFS_on"
EVENT_PATTERN = r"SNIFS_on \d \d (.) ==>(.*)\s+$"


def events(lines: DataFrame, marker: str = EVENT_MARKER, pattern: str = EVENT_PATTERN) -> DataFrame:
    """``(channel, time, zone)`` of the lines that match; a time that cannot be read is null."""
    value = F.col("value")
    hits = lines.filter(F.contains(value, F.lit(marker)) & value.rlike(pattern))
    parsed = hits.select(
        F.regexp_extract(value, pattern, 1).alias("channel"),
        times.log_time(F.regexp_extract(value, pattern, 2)).alias("_t"),
    )
    return parsed.select("channel", F.col("_t.time").alias("time"), F.col("_t.zone").alias("zone"))


def stored(rows: DataFrame) -> DataFrame:
    return rows.select(*schemas.EVENT_ROWS.names)
