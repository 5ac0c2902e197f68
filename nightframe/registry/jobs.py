"""Queries that run whole jobs: files written from the given tables, the job over them, the table it has written."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.functions import times
from nightframe.plans import build_catalog as B
from nightframe.plans import runlogs, weather
from nightframe.registry import series
from nightframe.registry import views as V
from nightframe.registry.detector import _q
from nightframe.sources import files, storage
from nightframe.streaming import refresh

NOW = datetime(2024, 12, 31, tzinfo=timezone.utc)
LINES_PER_FILE = 5000


def _text_files(lines: DataFrame, year: int = 2024) -> DataFrame:
    """Numbered lines as files ``(file_path, content)`` of ``LINES_PER_FILE`` numbers each, in their order."""
    name = F.format_string(f"wx.%08d.{year}.dat", F.expr(f"line_no div {LINES_PER_FILE}"))
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("line_no", "value"))), lambda x: x["value"])
    text = F.concat(F.array_join(ordered, "\n"), F.lit("\n"))
    return lines.groupBy(name.alias("file_path")).agg(text.cast("binary").alias("content"))


def weather_job(spark, sf):
    """The stored series after two runs of the job: over the earlier fetch, then over the later one beside it."""
    landing, root = storage.work_folder(spark, "landing"), storage.work_folder(spark, "weather")
    lines = V.weather_lines(spark, sf)
    for rank, folder in ((0, "fetch0"), (1, "fetch1")):
        storage.write_files(_text_files(lines.filter(F.col("source_rank") == rank)), f"{landing}/{folder}")
        weather.refresh_weather(spark, landing, root, lookback_days=400, now=NOW)
    return series._shown(weather.current_weather(spark, root).select(*schemas.WEATHER_ROWS.names))


def weather_stream(spark, sf):
    """The newest row of every minute, from a stream of the same files that keeps each minute's row in its state."""
    landing, out = storage.work_folder(spark, "landing"), storage.work_folder(spark, "minutes")
    lines = V.weather_lines(spark, sf)
    for rank in (0, 1):
        storage.write_files(_text_files(lines.filter(F.col("source_rank") == rank)), f"{landing}/fetch{rank}")
        refresh.stream_weather_updates(spark, landing, out, f"{out}-marks").awaitTermination()
    return series._shown(refresh.current_minutes(spark, out).select(*schemas.WEATHER_ROWS.names))


def runlog_job(spark, sf):
    """The events that the job extracts from the gzipped run logs of a catalogue, read back from the table it has written."""
    root, store = storage.work_folder(spark, "logs"), storage.work_folder(spark, "catalog")
    V.log_lines(spark, sf).write.option("compression", "gzip").text(f"{root}/raw/type={schemas.RAW_LOGS}")
    B.refresh_catalog(spark, root, store)
    path = runlogs.extract_run_logs(spark, root, store, B.current_catalog(spark, store))
    rows = files.read_table(spark, path, schemas.EVENT_ROWS).select(*schemas.EVENT_ROWS.names)
    return rows.withColumn("time", times.utc_wall_clock(F.col("time")))


QUERIES = {f.__name__: f for f in (weather_job, weather_stream, runlog_job)}

_STORED = _q(
    V.WEATHER_SQL,
    select="""SELECT time, wind_speed, wind_direction, temperature, relative_humidity, pressure FROM newest""",
)
ORACLE = {"weather_job": _STORED, "weather_stream": _STORED, "runlog_job": series.ORACLE["runlog_events"]}
