"""Refresh the weather series from a landing directory of yearly text files."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from nightframe import schemas
from nightframe.operators import quality as DQ
from nightframe.operators import weather as W
from nightframe.sources import files, sinks

STATION = "CFHT"  # fixed value: station folder of the stored series


def current_weather(spark: SparkSession, weather_root: str) -> DataFrame | None:
    path = sinks.latest_snapshot(spark, weather_root)
    return None if path is None else files.read_table(spark, path, schemas.WEATHER_ROWS)


def refresh_weather(
    spark: SparkSession,
    landing: str,
    weather_root: str,
    lookback_days: int = W.LOOKBACK_DAYS,
    refresh: bool = False,
    now: datetime | None = None,
    station: str = STATION,
) -> str | None:
    """Merge the files of the look-back years into the series, unless it is fresh.

    Newly read rows win over stored ones of the same minute, later lines over earlier ones.
    Returns the new snapshot's folder, or None if nothing was to do.
    """
    now = now or datetime.now(timezone.utc)

    def attempt(base: sinks.Head) -> str | None:
        stored = None if base.path is None else files.read_table(spark, base.path, schemas.WEATHER_ROWS)
        if stored is not None and W.is_fresh(stored, now):
            return None
        wanted = W.of_years(files.list_any(spark, landing), W.years_to_read(now, lookback_days))
        lines = files.read_selected_lines(spark, landing, wanted)
        merged = W.merge(None if refresh else stored, W.parse(lines), files.LINE_ORDER)
        return sinks.write_weather(merged, weather_root, station, DQ.check_weather, base)

    return sinks.committed(spark, weather_root, attempt)


def report(spark: SparkSession, weather_root: str, now: datetime, days: int = W.REPORT_DAYS) -> DataFrame:
    """One series per metric over the last days."""
    stored = current_weather(spark, weather_root)
    if stored is None:
        raise FileNotFoundError(f"no weather series in {weather_root}")
    return W.report(W.lookback(stored, now, days))
