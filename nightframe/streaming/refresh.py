"""Refresh jobs driven by new files.

Each is a file stream with ``trigger(availableNow=True)`` and a ``foreachBatch`` upsert: the
stream's checkpoint remembers which files were read, the batch merges into the newest snapshot
and writes the next one. A file stream reads a path once, so length and time of every file read are kept
beside the checkpoint, and files that have grown or were replaced are merged anew before the stream starts. Keep-last is an update, so stream deduplication (keep-first) would
give another result. :func:`stream_weather_updates` keeps the last row of every minute in the stream's state instead, and writes only what has
changed. A batch that is run again after a failure merges the same rows once more,
which changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from nightframe import schemas
from nightframe.functions import paths
from nightframe.operators import catalog as C
from nightframe.operators import quality as DQ
from nightframe.operators import weather as W
from nightframe.plans.build_catalog import entries_of
from nightframe.plans.weather import STATION
from nightframe.sources import files, sinks

# Schema of the binary file source; streams must declare it.
BINARY_FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


STATE = "file_path STRING, length BIGINT, modificationTime TIMESTAMP"


def _remember(read: DataFrame, checkpoint: str) -> None:
    read.select("file_path", "length", "modificationTime").distinct().write.mode("append").parquet(_state(checkpoint))


def _state(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-files"


def _changed(spark: SparkSession, listing: DataFrame, checkpoint: str) -> DataFrame:
    """Files read before whose length or time isn't as it was when they were last read."""
    if not sinks.exists(spark, _state(checkpoint)):
        return listing.limit(0)
    known = spark.read.schema(STATE).parquet(_state(checkpoint)).groupBy("file_path").agg(
        F.max(F.struct("modificationTime", "length")).alias("was")
    )
    now = F.struct("modificationTime", "length")
    return listing.join(known, "file_path").filter(now != F.col("was")).drop("was")


def stream_catalog(
    spark: SparkSession, data_root: str, catalog_root: str, checkpoint: str, files_per_batch: int = 10_000
) -> StreamingQuery:
    """Add new and changed files of the tree to the catalogue. Deletions are left to the batch refresh."""
    found = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILES)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(data_root)
    )
    found = C.visible_files(
        found.select(
            paths.relative_to(F.col("path"), data_root).alias("file_path"), "length", "modificationTime", "content"
        )
    )

    def merge(batch: DataFrame, _: int) -> None:
        fresh = C.conform(entries_of(batch, datetime.now(timezone.utc)))

        def attempt(base: sinks.Head) -> str:
            old = None if base.path is None else files.read_catalog(batch.sparkSession, base.path)
            merged = C.merge(old, fresh).dropna(subset=["type"])
            return sinks.write_catalog(C.conform(merged), catalog_root, DQ.check_catalog, base)

        sinks.committed(batch.sparkSession, catalog_root, attempt)
        _remember(batch, checkpoint)

    changed = _changed(spark, files.list_files(spark, data_root), checkpoint)
    if not changed.isEmpty():
        merge(files.read_selected(spark, data_root, changed), -1)

    return (
        found.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_weather(
    spark: SparkSession, landing: str, weather_root: str, checkpoint: str, station: str = STATION
) -> StreamingQuery:
    """Merge new and grown weather files into the series."""

    def with_file(lines: DataFrame) -> DataFrame:
        return lines.select(
            "value",
            paths.relative_to(F.col("_metadata.file_path"), landing).alias("file_path"),
            F.col("_metadata.file_block_start").alias("block"),
            F.col("_metadata.file_size").alias("length"),
            F.col("_metadata.file_modification_time").alias("modificationTime"),
        )

    text = (
        spark.readStream.format("text")
        .schema("value STRING")
        .option("recursiveFileLookup", True)
        .load(landing)
    )

    def merge(batch: DataFrame, _: int) -> None:
        placed = batch.drop("length", "modificationTime").withColumn("seq", F.monotonically_increasing_id())

        def attempt(base: sinks.Head) -> str:
            stored = None if base.path is None else files.read_table(batch.sparkSession, base.path, schemas.WEATHER_ROWS)
            merged = W.merge(stored, W.parse(placed), files.LINE_ORDER)
            return sinks.write_weather(merged, weather_root, station, DQ.check_weather, base)

        sinks.committed(batch.sparkSession, weather_root, attempt)
        _remember(batch, checkpoint)

    for found in files.batches_of(landing, _changed(spark, files.list_any(spark, landing), checkpoint)):
        merge(with_file(spark.read.option("recursiveFileLookup", True).text(found)), -1)

    return (
        with_file(text).writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


# ------------------------------------------------------------------ keep-last in the stream's state

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_UPDATES = "key STRING, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.WEATHER_ROWS)


class KeepLast(StatefulProcessor):
    """The last row of a key by ``order``; only a row that changes what is held is given out.

    ``told`` are columns that follow from the key, so they aren't compared.
    """

    def __init__(self, columns: str, order: tuple[str, ...], told: tuple[str, ...] = ()) -> None:
        self.columns, self.order, self.told = columns, order, told
        self.names = [c.split()[0] for c in columns.split(", ")]

    def init(self, handle) -> None:
        self.last = handle.getValueState("last", self.columns)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        newest = max(rows, key=lambda r: tuple(r[c] for c in self.order))
        now = tuple(newest[n] for n in self.names)
        compared = lambda row: [v for n, v in zip(self.names, row, strict=True) if n not in self.told]
        if not self.last.exists() or compared(self.last.get()) != compared(now):
            self.last.update(now)
            yield Row(**{"key": key[0], **dict(zip(self.names, now, strict=True))})

    def close(self) -> None:
        pass


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's lines with numbers as it reads them, so that the order of a file's lines is known. Streams have no function for it."""
    at = 0
    for batch in batches:
        numbers = pa.array(range(at, at + batch.num_rows), pa.int64())
        at += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, numbers], names=[*batch.schema.names, "seq"])


def stream_weather_updates(spark: SparkSession, landing: str, out: str, checkpoint: str) -> StreamingQuery:
    """New files of the landing folder, merged minute by minute in the stream's state; changed minutes alone are appended to ``out``.

    Later batches win over earlier ones and, in a batch, later lines over earlier ones, by file, place and line. A refresh of k minutes touches the state of
    k minutes, however long the series is. Lines without a readable time are kept under none. :func:`current_minutes` reads the series.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    text = spark.readStream.format("text").schema("value STRING").option("recursiveFileLookup", True).load(landing)
    placed = text.select(
        "value",
        paths.relative_to(F.col("_metadata.file_path"), landing).alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
    )
    numbered = placed.mapInArrow(_numbered, "value STRING, file_path STRING, block BIGINT, seq BIGINT")
    parsed = W.parse(numbered)
    key = F.coalesce(F.col("time").cast("string"), F.lit("")).alias("key")
    rows = parsed.select(key, *files.LINE_ORDER, *schemas.WEATHER_ROWS.names)
    columns = _UPDATES.split(", ", 1)[1]
    changed = rows.groupBy("key").transformWithState(KeepLast(columns, files.LINE_ORDER, ("time",)), _UPDATES, outputMode="Update", timeMode="None")

    def append(batch: DataFrame, number: int) -> None:
        # a batch that runs again replaces what it has written
        batch.write.mode("overwrite").parquet(f"{out.rstrip('/')}/batch={number:010d}")

    query = changed.writeStream.foreachBatch(append).outputMode("update")
    return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current_minutes(spark: SparkSession, out: str) -> DataFrame:
    """The series: of every minute the row of the latest batch that has changed it."""
    rows = spark.read.option("basePath", out).schema(f"{_UPDATES}, batch BIGINT").parquet(f"{out.rstrip('/')}/batch=*")
    newest = Window.partitionBy("key").orderBy(F.desc("batch"))
    return rows.withColumn("_n", F.row_number().over(newest)).filter("_n = 1").select(*schemas.WEATHER_ROWS.names)
