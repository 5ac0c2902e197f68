"""Files of any store, opened on executors by byte ranges, and folders listed there.

Spark's own readers open whole files and keep their names on the driver. These helpers run inside tasks.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import DataFrame, SparkSession

#: Schemes that mean a store which the file library knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3"}


def store_of(path: str) -> tuple[pfs.FileSystem, str]:
    """The store of a path or address and the path inside it."""
    scheme, _, rest = path.partition(":")
    if not rest.startswith("/") or len(scheme) < 2:
        return pfs.LocalFileSystem(), path
    if scheme == "file":
        return pfs.LocalFileSystem(), "/" + rest.lstrip("/")
    return pfs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")


def reachable(path: str) -> bool:
    """Whether tasks can open the path's store by themselves."""
    try:
        store_of(path)
    except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
        return False
    return True


def joined(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}" if name else root


def hidden(name: str) -> bool:
    """Names that Spark's readers leave out too."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name)


def folder_entries(store: pfs.FileSystem, path: str) -> Iterator[tuple[str, bool, int | None, int]]:
    """``name, is_folder, length, time`` in milliseconds of what lies directly in a folder."""
    for info in store.get_file_info(pfs.FileSelector(path, allow_not_found=True)):
        if not hidden(info.base_name):
            folder = info.type == pfs.FileType.Directory
            yield info.base_name, folder, None if folder else info.size, milliseconds(info)


def milliseconds(info: pfs.FileInfo) -> int:
    """A store without times for folders has 0."""
    return (info.mtime_ns or 0) // 1_000_000


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that all executors share: below ``spark.checkpoint.dir``, or a local one where Spark runs in one process."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="nightframe-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_files(files: DataFrame, root: str) -> int:
    """Writes ``content`` of every row to ``file_path`` below ``root``, where the rows are; returns how many.

    A task that runs again writes the same files again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = store_of(root)
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                path = joined(base, name.as_py())
                store.create_dir(path.rsplit("/", 1)[0], recursive=True)
                with store.open_output_stream(path) as out:
                    out.write(content.as_buffer())
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], names=["n"])

    written = files.select("file_path", "content").mapInArrow(run, "n long")
    return written.selectExpr("coalesce(sum(n), 0) AS n").first()["n"]
