"""Metadata carried in file paths."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def suffix(path: Column) -> Column:
    """Suffix with its dot, empty without one; a leading dot alone is not a suffix."""
    return F.regexp_extract(file_name(path), r"^.+(\.[^.]+)$", 1)


def partition_values(path: Column) -> Column:
    """Map of the ``key=value`` segments; the split is at the first ``=``, the last key wins."""
    marked = F.filter(F.split(path, "/"), lambda s: F.contains(s, F.lit("=")))
    pairs = F.transform(
        marked,
        lambda s: F.struct(
            F.substring_index(s, "=", 1).alias("key"),
            F.substr(s, F.instr(s, "=") + 1).alias("value"),
        ),
    )
    # Keep a pair only if its key does not occur again further right.
    last = F.filter(
        pairs,
        lambda p, i: ~F.exists(
            F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0))), lambda q: q["key"] == p["key"]
        ),
    )
    return F.map_from_entries(last)


def segments(path: Column) -> Column:
    return F.size(F.split(path, "/"))


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``, whatever scheme prefix the file system adds to either."""
    bare = F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    clean = re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", root).rstrip("/")
    return F.when(
        F.startswith(bare, F.lit(clean + "/")), F.substr(bare, F.lit(len(clean) + 2))
    ).otherwise(bare)
