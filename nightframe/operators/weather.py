"""Weather series."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.functions import times
from nightframe.operators.catalog import latest

# Order and types of the fields of a weather line; more fields are ignored.
FIELDS = {
    "year": "int", "month": "int", "day": "int", "hour": "int", "minute": "int",
    "wind_speed": "int", "wind_direction": "int", "temperature": "double",
    "relative_humidity": "int", "pressure": "double",
}
TIME_FIELDS = 5
FRESH_MINUTES = 5
REPORT_DAYS = 30
LOOKBACK_DAYS = 7


def parse(lines: DataFrame) -> DataFrame:
    """Text lines to the weather schema; other columns of the lines are kept behind it."""
    tokens = F.split("value", " ")
    part = {name: F.get(tokens, F.lit(i)).try_cast(kind) for i, (name, kind) in enumerate(FIELDS.items())}
    time = times.local_minute(F.substring_index("value", " ", TIME_FIELDS))
    rest = [c for c in lines.columns if c != "value"]
    return lines.select(
        time.alias("time"), *[part[f.name].alias(f.name) for f in schemas.WEATHER_ROWS if f.name != "time"], *rest
    )


def newest_per_time(rows: DataFrame, order: tuple[str, ...] = ("source_rank", "line_no")) -> DataFrame:
    """Last row per time; a higher source rank is a later fetch."""
    return latest(rows, "time", order)


def merge(existing: DataFrame | None, fetched: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Existing rows, overridden by fetched ones of the same time, sorted columns as stored.

    ``order`` ranks fetched rows among themselves, e.g. by file and position.
    """
    new = fetched.withColumn("source_rank", F.lit(1))
    if existing is not None:
        new = new.unionByName(existing.withColumn("source_rank", F.lit(0)), allowMissingColumns=True)
    return newest_per_time(new, ("source_rank", *order)).select(*schemas.WEATHER_ROWS.names)


def freshness(rows: DataFrame, now: datetime | Column, minutes: int = FRESH_MINUTES) -> DataFrame:
    """One row ``(fresh)``: whether any row is younger than the limit."""
    now = now if isinstance(now, Column) else F.lit(now)
    recent = F.col("time") > now - F.make_dt_interval(mins=F.lit(minutes))
    return rows.agg(F.coalesce(F.bool_or(recent), F.lit(False)).alias("fresh"))


def is_fresh(rows: DataFrame, now: datetime, minutes: int = FRESH_MINUTES) -> bool:
    """Stops at the first fresh row."""
    return not rows.filter(F.col("time") > F.lit(now - timedelta(minutes=minutes))).isEmpty()


def lookback(rows: DataFrame, now: datetime | Column, days: int = REPORT_DAYS) -> DataFrame:
    """Rows of the last days, both ends included."""
    now = now if isinstance(now, Column) else F.lit(now)
    return rows.filter(F.col("time").between(now - F.make_dt_interval(days=F.lit(days)), now))


def report(rows: DataFrame) -> DataFrame:
    """One series per metric: ``(time, metric, value)`` without nulls."""
    metrics = [F.col(m).cast("double").alias(m) for m in schemas.WEATHER_METRICS]
    long = rows.select("time", *metrics).unpivot("time", list(schemas.WEATHER_METRICS), "metric", "value")
    return long.dropna(subset=["value"])


def years_to_read(now: datetime, days: int = LOOKBACK_DAYS) -> list[int]:
    """Years the look-back touches, those in between included."""
    return list(range((now - timedelta(days=days)).year, now.year + 1))


def of_years(lines: DataFrame, years: list[int], path: str = "file_path") -> DataFrame:
    """Lines of the yearly files of those years; the year is the last four digits of the name."""
    year = F.regexp_extract(path, r"(\d{4})[^0-9/]*$", 1)
    return lines.filter(year.isin(*[str(y) for y in years]))
