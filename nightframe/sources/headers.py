"""``spark.read.format("image_headers")``: header cards of all image files below a folder.

Register it once with ``spark.dataSource.register(ImageHeaders)``. A partition is a few folders, whose files its task
lists and opens; only header records are read. The driver lists folders level by level until there are enough of them. For
folders of very many files each, list with :func:`tree.walk` and read with :func:`fits.header_rows_at`.

Options: ``path``; ``last_hdu``, after which no HDU is read; ``keys``, the wanted cards, comma-joined; ``prefix``, with which paths begin, so
that folders elsewhere aren't listed; ``strict`` (true: a broken file is an error, else it has no rows); ``partitions`` (64). These are options
and not conditions that Spark hands down, because what is handed down to a Python source stays with a data frame that is used again:
its rows would be missing from a second query on it.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

from nightframe import schemas
from nightframe.sources import fits
from nightframe.sources.storage import folder_entries, joined, store_of

SUFFIX = ".fits"


@dataclass
class Folders(InputPartition):
    """Folders to be searched to the bottom, and folders of which only the files count."""

    whole: list[str]
    shallow: list[str]


class ImageHeaders(DataSource):
    @classmethod
    def name(cls) -> str:
        return "image_headers"

    def schema(self) -> StructType:
        return schemas.HEADER_ROWS

    def reader(self, schema: StructType) -> ImageHeaderReader:
        return ImageHeaderReader(self.options)


class ImageHeaderReader(DataSourceReader):
    def __init__(self, options) -> None:
        self.root = options["path"]
        self.strict = str(options.get("strict", "true")).lower() == "true"
        self.wanted = int(options.get("partitions", 64))
        self.last = int(options["last_hdu"]) if "last_hdu" in options else None
        self.keys = frozenset(options["keys"].upper().split(",")) if "keys" in options else None
        self.prefix = options.get("prefix", "")

    def _apart(self, folder: str) -> bool:
        """Whether no path below the folder can start as wanted."""
        below = f"{folder}/" if folder else ""
        return not (below.startswith(self.prefix) or self.prefix.startswith(below))

    def partitions(self) -> Sequence[InputPartition]:
        store, base = store_of(self.root)
        shallow, level = [], [""]
        while level and len(level) < self.wanted:
            shallow += level
            level = [
                joined(f, name) if f else name
                for f in level
                for name, is_folder, *_ in folder_entries(store, joined(base, f))
                if is_folder and not self._apart(joined(f, name) if f else name)
            ]
        parts = [Folders(level[i :: self.wanted], shallow[i :: self.wanted]) for i in range(self.wanted)]
        return [p for p in parts if p.whole or p.shallow] or [Folders([], [])]

    def read(self, partition: Folders) -> Iterator[pa.RecordBatch]:
        store, base = store_of(self.root)
        waiting = [(f, False) for f in partition.shallow] + [(f, True) for f in partition.whole]
        while waiting:
            folder, deep = waiting.pop()
            for name, is_folder, length, _ in folder_entries(store, joined(base, folder)):
                path = joined(folder, name) if folder else name
                if is_folder:
                    if deep and not self._apart(path):
                        waiting.append((path, True))
                elif name.endswith(SUFFIX) and path.startswith(self.prefix):
                    yield fits.stored_header(store, joined(base, path), path, length, self.strict, self.last, self.keys)
