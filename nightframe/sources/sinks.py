"""Writers.

Every table is a folder of numbered snapshots and a log of commits. A snapshot is written in full, read back and
checked, and only then put in force by the commit with the next number, a small file that names it and that only one writer can create.
Readers see the snapshot of the highest commit. A lost job or a failed check leaves the snapshot before it in force.

A writer that builds on a snapshot names it as its base. If another has committed meanwhile, its own commit is refused with
:class:`Conflict`, and :func:`committed` builds again on what is in force now; so two writers at once lose nothing.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.operators.catalog import fingerprint
from nightframe.sources.storage import store_of

#: Marks snapshots of tables without a log.
PUBLISHED = "_PUBLISHED"
COMMITS = "_commits"


class Conflict(Exception):
    """Another writer has committed since the base was read."""


@dataclass(frozen=True)
class Head:
    """What is in force: the number of its commit (-1: none), its folder, and what its writer has noted."""

    number: int = -1
    path: str | None = None
    notes: dict | None = None


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def _names(spark: SparkSession, path: str) -> list[str]:
    fs, place = _place(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def _create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with its content in one step; False if there is one already."""
    fs, place = _place(spark, path)
    fs.mkdirs(place.getParent())
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    if fs.getScheme() == "file":
        draft, own = store_of(draft)[1], store_of(path)[1]
        with open(draft, "w") as out:
            out.write(text)
        try:
            os.link(draft, own)
        except FileExistsError:
            return False
        finally:
            os.unlink(draft)
        return True
    out = fs.create(_place(spark, draft)[1], False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    never = spark._sc._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_place(spark, draft)[1], place, never)  # fails where there is a file
    except Exception:
        if not fs.exists(place):
            raise
        fs.delete(_place(spark, draft)[1], False)
        return False
    return True


def _commit(spark: SparkSession, root: str, number: int) -> dict:
    fs, place = _place(spark, f"{root.rstrip('/')}/{COMMITS}/{number:010d}")
    stream = fs.open(place)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _numbers(spark: SparkSession, root: str) -> list[int]:
    return [int(n) for n in _names(spark, f"{root.rstrip('/')}/{COMMITS}") if n.isdigit()]


def head(spark: SparkSession, root: str) -> Head:
    """What is in force."""
    numbers = _numbers(spark, root)
    if numbers:
        told = _commit(spark, root, numbers[-1])
        return Head(numbers[-1], f"{root.rstrip('/')}/{told['snapshot']}", told.get("notes"))
    marked = _marked(spark, root)
    return Head(-1, marked[-1] if marked else None)


def _snapshots(spark: SparkSession, root: str) -> list[str]:
    return [n for n in _names(spark, root) if n.startswith("snapshot-")]


def _marked(spark: SparkSession, root: str) -> list[str]:
    found = [f"{root.rstrip('/')}/{n}" for n in _snapshots(spark, root)]
    return [p for p in found if exists(spark, f"{p}/{PUBLISHED}")]


def published_snapshots(spark: SparkSession, root: str) -> list[str]:
    """Folders of all published snapshots that are left, oldest first."""
    numbers = _numbers(spark, root)
    if not numbers:
        return _marked(spark, root)
    return [f"{root.rstrip('/')}/{_commit(spark, root, n)['snapshot']}" for n in numbers]


def latest_snapshot(spark: SparkSession, root: str) -> str | None:
    """Folder of the snapshot in force."""
    return head(spark, root).path


def next_snapshot(spark: SparkSession, root: str) -> str:
    """Folder for the next snapshot, no other writer's: the number is followed by a random part."""
    found = _snapshots(spark, root)
    number = int(found[-1].split("-")[1]) + 1 if found else 0
    return f"{root.rstrip('/')}/snapshot-{number:010d}-{uuid.uuid4().hex[:8]}"


def drop_old_snapshots(spark: SparkSession, root: str, keep: int = 2) -> list[str]:
    """Deletes all but the newest ``keep`` published snapshots, and unpublished ones older than these, with their commits."""
    kept = [p.rsplit("/", 1)[-1] for p in published_snapshots(spark, root)[-max(keep, 1) :]]
    old = [n for n in _snapshots(spark, root) if kept and n not in kept and n < min(kept)]
    for number in _numbers(spark, root)[: -max(keep, 1)]:
        fs, place = _place(spark, f"{root.rstrip('/')}/{COMMITS}/{number:010d}")
        fs.delete(place, False)
    for name in old:
        fs, place = _place(spark, f"{root.rstrip('/')}/{name}")
        fs.delete(place, True)
    return old


def publish(
    spark: SparkSession,
    path: str,
    check: Callable[[DataFrame], None] | None = None,
    base: Head | None = None,
    notes: dict | None = None,
) -> str:
    """Checks a written snapshot and puts it in force: after ``base``, if given, else after whatever is in force."""
    if check is not None:
        check(spark.read.parquet(path))
    root, name = path.rsplit("/", 1)
    text = json.dumps({"snapshot": name, "notes": notes})
    while True:
        number = (head(spark, root) if base is None else base).number + 1
        if _create_once(spark, f"{root}/{COMMITS}/{number:010d}", text):
            return path
        if base is not None:
            raise Conflict(f"{root} has a commit {number} already")


def committed(spark: SparkSession, root: str, attempt: Callable[[Head], str | None], attempts: int = 20) -> str | None:
    """``attempt(head)`` writes a snapshot on what is in force and publishes it on that base; after a conflict it is called again."""
    for left in range(attempts, 0, -1):
        try:
            return attempt(head(spark, root))
        except Conflict:
            if left == 1:
                raise
    return None


def fingerprint_notes(rows: DataFrame) -> dict:
    return {k: str(v) for k, v in rows.transform(fingerprint).first().asDict().items()}


def write_catalog(
    catalog: DataFrame,
    root: str,
    check: Callable[[DataFrame], None] | None = None,
    base: Head | None = None,
    notes: dict | None = None,
) -> str:
    """Write a catalogue sorted by path as a new snapshot; the one being read stays intact.

    Range partitions give a global order and let readers skip row groups by path. The commit notes the content's fingerprint, ``notes`` if it is known.
    """
    spark = catalog.sparkSession
    path = next_snapshot(spark, root)
    ordered = catalog.repartitionByRange("file_path").sortWithinPartitions("file_path")
    ordered.write.mode("overwrite").parquet(path)
    return publish(spark, path, check, base, notes or fingerprint_notes(spark.read.schema(catalog.schema).parquet(path)))


def write_weather(
    rows: DataFrame, root: str, station: str, check: Callable[[DataFrame], None] | None = None, base: Head | None = None
) -> str:
    """Write a weather series under ``type=WEATHER/station=…`` as a new snapshot."""
    path = next_snapshot(rows.sparkSession, root)
    ordered = rows.repartitionByRange("time").sortWithinPartitions("time")
    tagged = ordered.withColumns({"type": F.lit("WEATHER"), "station": F.lit(station)})
    tagged.write.mode("overwrite").partitionBy("type", "station").parquet(path)
    return publish(rows.sparkSession, path, check, base)


def write_events(rows: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None) -> str:
    """Write detector-on events, sorted by time and gzip-compressed, under ``type=CCD_ON_TIMES``."""
    path = next_snapshot(rows.sparkSession, root)
    ordered = rows.repartitionByRange("time").sortWithinPartitions("time")
    tagged = ordered.withColumn("type", F.lit("CCD_ON_TIMES"))
    tagged.write.mode("overwrite").option("compression", "gzip").partitionBy("type").parquet(path)
    return publish(rows.sparkSession, path, check)


def write_lines(lines: DataFrame, root: str, check: Callable[[DataFrame], None] | None = None) -> str:
    """Write images as lines, as a new snapshot; rows of an exposure stay together for row-group skipping."""
    path = next_snapshot(lines.sparkSession, root)
    keys = [c for c in ("exposure_id", "amp", "x") if c in lines.columns]
    lines.sortWithinPartitions(*keys).write.mode("overwrite").parquet(path)
    return publish(lines.sparkSession, path, check)
