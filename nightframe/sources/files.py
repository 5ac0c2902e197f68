"""Listing files and reading tables."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from nightframe import schemas
from nightframe.functions import paths
from nightframe.operators.catalog import visible_files
from nightframe.sources import sinks


def read_files(spark: SparkSession, root: str) -> DataFrame:
    """Files below ``root`` at any depth: ``(file_path, length, modificationTime, content)``.

    Partition discovery is off because mixed depths and ``key=value`` folders confuse it; the
    keys are taken from the path. Unless ``content`` is selected no file is opened.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return visible_files(
        files.select(
            paths.relative_to(F.col("path"), root).alias("file_path"), "length", "modificationTime", "content"
        )
    )


def read_selected(spark: SparkSession, root: str, wanted: DataFrame, batch: int = 100_000) -> DataFrame:
    """Content of the ``wanted`` paths only.

    A join with the binary scan would read every file first. Spark's file index keeps all paths
    of a scan on the driver anyway, so the wanted ones are handed to it as the scan's paths, in
    batches; no content passes the driver.
    """

    def scan(found: list[str]) -> DataFrame:
        loaded = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(found)
        path = paths.relative_to(F.col("path"), root).alias("file_path")
        return loaded.select(path, "length", "modificationTime", "content")

    parts = [scan(found) for found in batches_of(root, wanted, batch)]
    return reduce(DataFrame.unionByName, parts or [read_files(spark, root).limit(0)])


def batches_of(root: str, wanted: DataFrame, size: int = 100_000) -> Iterator[list[str]]:
    """Full paths of ``wanted`` files in batches, with the characters escaped that a path pattern knows."""
    base, names = root.rstrip("/"), []
    for row in wanted.select("file_path").toLocalIterator():
        names.append(f"{base}/" + re.sub(r"([\[\]{}*?\\])", r"\\\1", row["file_path"]))
        if len(names) == size:
            yield names
            names = []
    if names:
        yield names


def read_selected_lines(spark: SparkSession, root: str, wanted: DataFrame, batch: int = 100_000) -> DataFrame:
    """Text lines of the ``wanted`` paths only, as :func:`read_text_lines` gives them."""
    parts = [_lines(spark.read.option("recursiveFileLookup", True).text(found)) for found in batches_of(root, wanted, batch)]
    return reduce(DataFrame.unionByName, parts or [_lines(spark.read.option("recursiveFileLookup", True).text(root)).limit(0)])


SNAPSHOT = r"^(.*?)/?(snapshot-[0-9]+[^/]*)/(.*)$"


def published_tables(spark: SparkSession, root: str, listing: DataFrame) -> DataFrame:
    """A listing in which each table kept in snapshots is one entry.

    Of the files below a ``snapshot-…`` folder only those of the newest published one of their table count, and
    they become one row with their partition folder as path, their length in all and the latest time. Unpublished
    and older snapshots aren't listed. Tables are few: their roots, not their files, reach the driver.
    """
    path = F.col("file_path")
    part = listing.withColumns(
        {
            "_root": F.regexp_extract(path, SNAPSHOT, 1),
            "_snapshot": F.regexp_extract(path, SNAPSHOT, 2),
            "_folder": F.regexp_extract(path, r"^(.*)/[^/]*$", 1),
        }
    )
    inside = F.col("_snapshot") != ""
    roots = [r["_root"] for r in part.filter(inside).select("_root").distinct().collect()]
    newest = [sinks.latest_snapshot(spark, f"{root.rstrip('/')}/{r}".rstrip("/")) for r in roots]
    current = {r: n.rsplit("/", 1)[-1] for r, n in zip(roots, newest, strict=True) if n}
    own = reduce(
        lambda a, b: a | b,
        [(F.col("_root") == r) & (F.col("_snapshot") == n) for r, n in current.items()],
        F.lit(False),
    )
    tables = part.filter(inside & own & F.endswith(path, F.lit(".parquet"))).groupBy(F.col("_folder").alias("file_path")).agg(
        F.sum("length").alias("length"), F.max("modificationTime").alias("modificationTime")
    )
    plain = part.filter(~inside).select("file_path", "length", "modificationTime")
    return plain.unionByName(tables)


def changed_files(listing: DataFrame, known: DataFrame | None) -> DataFrame:
    """Files that are new, or whose length or time isn't the known one."""
    if known is None:
        return listing
    return listing.join(known.select("file_path", "length", "modificationTime"), ["file_path", "length", "modificationTime"], "left_anti")


def list_files(spark: SparkSession, root: str) -> DataFrame:
    return read_files(spark, root).drop("content")


def list_any(spark: SparkSession, root: str) -> DataFrame:
    """All files below ``root``, those directly in it too; none is opened."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    return files.select(paths.relative_to(F.col("path"), root).alias("file_path"), "length", "modificationTime")


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Parquet with a declared schema: no footer is read to infer it, missing columns are null."""
    return spark.read.schema(schema).parquet(path)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.CATALOG)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with their place: ``(value, file_path, block, seq)``.

    ``(file_path, block, seq)`` orders the lines of a file even if it was split: ``block`` is
    the offset of the split and ``seq`` grows within a task. Gzip files are read whole by one
    task each; invalid UTF-8 shows as replacement characters.
    """
    return _lines(spark.read.option("recursiveFileLookup", True).text(path))


def _lines(text: DataFrame) -> DataFrame:
    return text.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )


LINE_ORDER = ("file_path", "block", "seq")
