"""Extract detector-on events from the catalogue's run logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.operators import match as M
from nightframe.operators import quality as DQ
from nightframe.operators import runlog as R
from nightframe.plans.build_catalog import upsert_files
from nightframe.sources import files, sinks


def log_events(spark: SparkSession, data_root: str, catalog: DataFrame) -> DataFrame:
    """Events of all run logs the catalogue knows; times that cannot be read are null. No other file is opened."""
    known = M.members(schemas.RAW_LOGS, catalog).withColumnRenamed("match_path", "file_path")
    return R.stored(R.events(files.read_selected_lines(spark, data_root, known)))


def extract_run_logs(
    spark: SparkSession,
    data_root: str,
    catalog_root: str,
    catalog: DataFrame,
    folder: str = "processed",
    strict: bool = False,
) -> str:
    """Write the events sorted by time and register the table in the catalogue, in place of its former entry.

    Events with an unreadable time are kept without one; ``quality.event_violations`` lists them. With
    ``strict`` they fail the job and the former table stays in force.
    """
    events = log_events(spark, data_root, catalog)
    path = sinks.write_events(events, f"{data_root.rstrip('/')}/{folder}", DQ.check_events_strictly if strict else None)
    found = files.read_files(spark, f"{data_root.rstrip('/')}/{folder}").drop("content")
    found = found.withColumn("file_path", F.concat(F.lit(f"{folder}/"), F.col("file_path")))
    table = files.published_tables(spark, data_root, found.filter(F.contains("file_path", F.lit("/snapshot-"))))
    upsert_files(spark, table.withColumn("content", F.lit(None).cast("binary")), catalog_root, replaces=f"{folder}/snapshot-")
    return path
