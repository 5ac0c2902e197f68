"""The tree of files below a folder, listed by executors and kept with a digest for every folder.

A level of folders is listed by as many tasks as there are, so neither their names nor those of files reach the
driver. A folder whose time hasn't changed since the last walk isn't listed again; its entries are those of the tree that
was stored. A folder's digest follows from its files' names, lengths and times and its folders' digests, so
two trees are compared from the top and only folders that differ are looked into.

A folder's time tells that something was added, renamed or removed in it. A file that grows in place doesn't change it: pass
``trust_times=False`` to list everything. A folder changed shortly before it was listed is listed again the next time, as a later change
could have the same time. Stores without folder times are listed in full.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.sources import sinks
from nightframe.sources.storage import folder_entries, joined, milliseconds, store_of, work_folder

ENTRIES = "folder STRING, name STRING, is_folder BOOLEAN, length BIGINT, modificationTime TIMESTAMP"
FOLDERS = "folder STRING, time_ms BIGINT, listed BOOLEAN"
DIGESTS = "folder STRING, digest STRING"
_VISITED = f"{FOLDERS}, name STRING, is_folder BOOLEAN, length BIGINT, entry_ms BIGINT"
#: Milliseconds within which a folder's time may hide a later change.
SETTLED_MS = 2000
#: Deeper trees are taken for a link that leads back to itself.
MAX_DEPTH = 64
_BATCH = 8192


@dataclass
class Tree:
    """``entries`` of all folders, and the ``folders`` with whether this walk has listed them; a stored one has its ``digests`` too."""

    entries: DataFrame
    folders: DataFrame
    digests: DataFrame | None = None

    @property
    def files(self) -> DataFrame:
        """``file_path, length, modificationTime``."""
        return self.entries.filter(~F.col("is_folder")).select(_path().alias("file_path"), "length", "modificationTime")


def _path() -> Column:
    return F.when(F.col("folder") == "", F.col("name")).otherwise(F.concat_ws("/", "folder", "name"))


def _visit(root: str):
    names = [f.split()[0] for f in _VISITED.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.bool_(), pa.string(), pa.bool_(), pa.int64(), pa.int64()]

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        rows: list[tuple] = []
        for folder, known in ((f, k) for b in batches for f, k in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
            path = joined(base, folder)
            now = time.time_ns() // 1_000_000
            changed = milliseconds(store.get_file_info(path))
            same = bool(changed) and changed == known
            rows.append((folder, changed if now - changed > SETTLED_MS else 0, not same, None, None, None, None))
            if not same:
                for entry in folder_entries(store, path):
                    rows.append((folder, None, None, *entry))
                    if len(rows) >= _BATCH:
                        yield batch(rows)
                        rows = []
        if rows:
            yield batch(rows)

    return run


def walk(spark: SparkSession, root: str, known: Tree | None = None, trust_times: bool = True) -> Tree:
    """The tree below ``root``; ``known`` is that of an earlier walk, read from where it is stored.

    One job for each level of folders. What it finds is written to a folder that executors share, so no level is listed twice, not even
    after an executor is lost.
    """
    tasks = 2 * spark.sparkContext.defaultParallelism
    out = work_folder(spark, "walk")
    reuse = known is not None and trust_times
    frontier = spark.createDataFrame([("",)], "folder STRING")
    levels = []
    for depth in range(MAX_DEPTH):
        if reuse:
            frontier = frontier.join(known.folders.select("folder", "time_ms"), "folder", "left")
        else:
            frontier = frontier.withColumn("time_ms", F.lit(None).cast("long"))
        levels.append(f"{out}/{depth:02d}")
        frontier.select("folder", "time_ms").repartition(tasks).mapInArrow(_visit(root), _VISITED).write.parquet(levels[-1])
        here = _tree_of(spark.read.schema(_VISITED).parquet(levels[-1]), known if reuse else None)
        frontier = here.entries.filter("is_folder").select(_path().alias("folder"))
        if frontier.isEmpty():
            return _tree_of(spark.read.schema(_VISITED).parquet(*levels), known if reuse else None)
    raise ValueError(f"folders below {root} are more than {MAX_DEPTH} deep")


def _tree_of(visited: DataFrame, known: Tree | None) -> Tree:
    """The tree that a visit has found; what it hasn't listed is that of the ``known`` one."""
    entries = visited.filter(F.col("name").isNotNull()).select(
        "folder", "name", "is_folder", "length", F.timestamp_millis("entry_ms").alias("modificationTime")
    )
    folders = visited.filter(F.col("name").isNull()).select("folder", "time_ms", "listed")
    if known is not None:
        same = folders.filter(~F.col("listed")).select("folder")
        entries = entries.unionByName(known.entries.join(same, "folder", "left_semi"))
    return Tree(entries, folders)


# ---- digests


def _depth(folder: Column) -> Column:
    return F.when(folder == "", F.lit(0)).otherwise(F.size(F.split(folder, "/")))


_NOTHING = "nothing"


def digests(tree: Tree) -> DataFrame:
    """``folder, digest``: equal if and only if all that lies below is (but for colliding hashes).

    A folder's entries are added up in partial aggregations, so that one with very many never meets in a row.
    """
    e = tree.entries.withColumn("_depth", _depth(F.col("folder"))).withColumn("_path", _path())
    deepest = e.agg(F.max("_depth")).first()[0]
    found = tree.entries.sparkSession.createDataFrame([], DIGESTS)
    below = found
    for depth in range(deepest if deepest is not None else -1, -1, -1):
        level = e.filter(F.col("_depth") == depth).join(
            below.select(F.col("folder").alias("_path"), F.col("digest").alias("_below")), "_path", "left"
        )
        told = [F.col("name"), F.col("is_folder")]
        told += [F.when(F.col("is_folder"), F.coalesce("_below", F.lit(_NOTHING))).otherwise(F.col("length").cast("string"))]
        told += [F.when(~F.col("is_folder"), F.col("modificationTime"))]
        h = F.sha2(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(told)])), 256)
        part = lambda i: F.conv(F.substr(h, F.lit(1 + 15 * i), F.lit(15)), 16, 10).cast("decimal(38,0)")  # noqa: E731, B023
        sums = [F.sum(part(i)).cast("string") for i in range(4)]
        digest = F.sha2(F.concat_ws(":", F.count("*").cast("string"), *sums), 256)
        below = level.groupBy("folder").agg(digest.alias("digest")).persist()
        found = found.unionByName(below)
    return found


def changes(old: Tree, new: Tree) -> DataFrame:
    """``file_path, change``: files ``added``, ``removed`` or ``changed``.

    A folder differs wherever something below it does, so the folders whose digests differ are all that is looked into.
    """
    was, now = (t.digests if t.digests is not None else digests(t) for t in (old, new))
    differing = (
        was.withColumnRenamed("digest", "_was").join(now.withColumnRenamed("digest", "_now"), "folder", "full")
        .filter(~F.col("_was").eqNullSafe(F.col("_now"))).select("folder")
    )
    sides = []
    for tree, side in ((old, "_was"), (new, "_now")):
        facts = F.struct("length", "modificationTime").alias(side)
        files = tree.entries.filter(~F.col("is_folder")).join(differing, "folder", "left_semi")
        sides.append(files.select("folder", "name", facts))
    both = sides[0].join(sides[1], ["folder", "name"], "full")
    change = (
        F.when(F.col("_was").isNull(), "added").when(F.col("_now").isNull(), "removed").when(F.col("_was") != F.col("_now"), "changed")
    )
    return both.select(_path().alias("file_path"), change.alias("change")).filter("change IS NOT NULL")


# ---- stored trees


def write_tree(tree: Tree, root: str) -> str:
    """The tree with its digests as a new published snapshot below ``root``."""
    spark = tree.entries.sparkSession
    path = sinks.next_snapshot(spark, root)
    for name, rows in (("entries", tree.entries), ("folders", tree.folders)):
        rows.repartitionByRange("folder").sortWithinPartitions("folder").write.parquet(f"{path}/{name}")
    digests(read_tree(spark, path)).write.parquet(f"{path}/digests")
    return sinks.publish(spark, path)


def read_tree(spark: SparkSession, path: str) -> Tree:
    read = {n: spark.read.schema(s).parquet(f"{path}/{n}") for n, s in (("entries", ENTRIES), ("folders", FOLDERS))}
    known = spark.read.schema(DIGESTS).parquet(f"{path}/digests") if sinks.exists(spark, f"{path}/digests") else None
    return Tree(**read, digests=known)


def latest_tree(spark: SparkSession, root: str) -> Tree | None:
    path = sinks.latest_snapshot(spark, root)
    return None if path is None else read_tree(spark, path)
