"""URL filters: allow and block rules, and a blocklist as a sorted array of digests.

The index of a list is one file: the 64-bit xxhash keys of its entries in ascending order, the place of each
entry's text, and the texts. Executors get the file through Spark, map it into memory and probe it with vectorised
binary search; a hit counts only if the stored text is equal, so a collision of digests blocks nothing.
"""

from __future__ import annotations

import mmap
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nightframe.llm.common import new_path

_MAPPED: dict[str, Index] = {}
_CHUNK = 4 << 20


class Index:
    """A mapped index file: count, digests, offsets of the texts, texts."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            self._map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        n = int(np.frombuffer(self._map, "<u8", 1)[0])
        self.digests = np.frombuffer(self._map, "<u8", n, 8)
        self.offsets = np.frombuffer(self._map, "<u8", n + 1, 8 + 8 * n)
        self._texts = 8 + 8 * n + 8 * (n + 1)
        #: No longer key can be an entry.
        self.longest = int(np.diff(self.offsets).max(initial=0))

    def text(self, i: int) -> bytes:
        return self._map[self._texts + int(self.offsets[i]) : self._texts + int(self.offsets[i + 1])]

    def contains(self, keys: list[bytes]) -> np.ndarray:
        """Whether each key is an entry."""
        found = np.zeros(len(keys), bool)
        if not keys or not len(self.digests):
            return found
        wanted = np.array([xxhash.xxh64_intdigest(k) for k in keys], np.uint64)
        first = np.searchsorted(self.digests, wanted, "left")
        last = np.searchsorted(self.digests, wanted, "right")
        for i in np.flatnonzero(first < last):
            found[i] = any(self.text(j) == keys[i] for j in range(first[i], last[i]))
        return found


def _index_bytes(entries: list[tuple[int, bytes]]) -> Iterator[bytes]:
    """The file's parts for entries sorted by digest and text."""
    yield np.array([len(entries)], "<u8").tobytes()
    yield np.array([d for d, _ in entries], "<u8").tobytes()
    yield np.cumsum([0, *(len(t) for _, t in entries)], dtype="<u8").tobytes()
    yield b"".join(t for _, t in entries)


def _write(spark: SparkSession, path: str, parts: Iterable[bytes]) -> None:
    """Bytes to a file of any Hadoop file system, as the shared folder may be on one."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop)
    for part in parts:
        for at in range(0, len(part), _CHUNK):
            out.write(bytearray(part[at : at + _CHUNK]))
    out.close()


def build_index(entries: DataFrame, entry: str = "entry", max_bytes: int = 1 << 30) -> str:
    """Writes the index of the distinct non-null entries to the shared folder and gives its name to all executors.

    A blocklist is reference data and doesn't grow with the pages. Its size is checked first: beyond ``max_bytes`` of
    digests, offsets and texts the call fails, and the list must be split into several indexes. Returns
    the name to probe.
    """
    spark = entries.sparkSession
    texts = entries.select(F.col(entry).cast("binary").alias("e")).where("e IS NOT NULL").distinct()
    size = texts.agg(F.coalesce(F.sum(F.octet_length("e") + 16), F.lit(0))).first()[0]
    if size > max_bytes:
        raise ValueError(f"the list takes {size} bytes; split it into lists of at most {max_bytes}")
    found = sorted((xxhash.xxh64_intdigest(e), e) for e in (bytes(r["e"]) for r in texts.toLocalIterator()))
    path = new_path(spark, "urls") + ".index"
    _write(spark, path, _index_bytes(found))
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _mapped(name: str) -> Index:
    if name not in _MAPPED:
        _MAPPED[name] = Index(SparkFiles.get(name))
    return _MAPPED[name]


def _keys(host: bytes, path: bytes, longest: int) -> Iterator[bytes]:
    """The host and the domains above it, each alone, with the path and with the folders of it, of at most ``longest`` bytes.

    Only the ends of a long host and the start of a long path are cut up.
    """
    head = path[:longest]
    folders = [b"", *(head[: m.end()] for m in re.finditer(b"/", head))]
    if path and len(path) <= longest and not path.endswith(b"/"):
        folders.append(path)
    tail = host[-longest - 1 :] if longest else b""  # with the dot before the longest domain
    domains = [tail[m.end() :] for m in re.finditer(rb"\.", tail)]
    if len(host) <= longest:
        domains.append(host)
    for domain in domains:
        yield from (domain + f for f in folders if len(domain) + len(f) <= longest)


def listed(host: Column, path: Column, index: str) -> Column:
    """Whether the list has the host, one of the domains above it, or one of these with the path or a folder of it.

    An entry is ``host`` or ``host/path``; ``host/a/`` covers all below it. Null or empty hosts are never listed.
    """

    @F.pandas_udf(T.BooleanType())
    def probe(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        found = _mapped(index)
        keys, owner = [], []
        for i, (h, p) in enumerate(zip(hosts, paths, strict=True)):
            if h:
                own = list(_keys(h.encode(), (p or "").encode(), found.longest))
                keys += own
                owner += [i] * len(own)
        hits = found.contains(keys)
        out = np.zeros(len(hosts), bool)
        out[np.array(owner, np.int64)[hits]] = True
        return pd.Series(out)

    return probe(host, path)


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lower-cased; empty without ``://``."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), upper, lower)


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """``rule, verdict`` of the longest rule that fits, null without one.

    A rule is a verdict and ``host/path``. It fits its host and all subdomains if the path starts with its own.
    """
    rule = verdict = F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # a longer one that fits overrides
        domain, slash, start = text.partition("/")
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(slash + start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def judge(pages: DataFrame, index: str, rules: list[tuple[str, str]], id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of ``pages``: ``id, host, path, rule, verdict``.

    The longest rule that fits decides; without one a listed url is blocked and any other allowed. A null url or one
    without ``://`` has an empty host and path, fits no rule and is allowed. Null ids and repeated rows stay. Extra
    columns are ignored, whatever their names. Urls of any length are judged whole; an empty table has no rows. No row is shuffled.
    """
    rows = pages.select(F.col(id), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumns({"rule": rule, "__ruled": verdict, "__listed": listed(F.col("host"), F.col("path"), index)})
    by_list = F.when(F.col("__listed"), F.lit("block")).otherwise(F.lit("allow"))
    return rows.select(id, "host", "path", "rule", F.coalesce("__ruled", by_list).alias("verdict"))
