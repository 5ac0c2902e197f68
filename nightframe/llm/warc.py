"""WARC archives: written by Spark, read back, and assembled into captures.

Writing needs no library: the text writer ends every row with the blank lines that end a record. Reading
follows the Content-Length of each record, so payloads may hold anything. A capture's request, response or
revisit, and metadata records are joined through their concurrent-to identifiers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.llm.common import checkpoint, stored

_CRLF = "\r\n"
#: Base 32 of RFC 4648.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of binary data in upper-case base 32: four letters for each five hexadecimal digits."""

    def letters(digest: Column, i: Column) -> Column:
        number = F.conv(F.substr(digest, i * 5 + 1, F.lit(5)), 16, 10).cast("int")
        return F.concat(
            *[F.substr(F.lit(_BASE32), F.shiftright(number, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        )

    # the digest is named by a lambda, so that it is taken once and not for each of its letters
    whole = lambda d: F.array_join(F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: letters(d, i)), "")
    return F.transform(F.array(F.sha1(payload)), whole)[0]


def _uuid(kind: str, key: Column) -> Column:
    """A record id that follows from the row's key, so that a task run again writes the same."""
    h = F.md5(F.concat(F.lit(kind + ":"), key))
    cut = [F.substr(h, F.lit(a), F.lit(n)) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def _record(fields: list[tuple[str, Column]], body: Column) -> Column:
    """A record without the blank lines at its end; a null field is left out."""
    lines = [F.lit("WARC/1.1")]
    lines += [F.concat(F.lit(name + ": "), value) for name, value in fields]
    lines += [F.concat(F.lit("Content-Length: "), F.octet_length(body).cast("string"))]
    return F.concat(F.concat_ws(_CRLF, *lines), F.lit(_CRLF * 2), body)


def write(
    pages: DataFrame,
    folder: str,
    id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 0,
    date: str = "2024-01-01T00:00:00Z",
    records_per_file: int = 3000,
) -> None:
    """Writes a request, a response or revisit, and a metadata record for each row.

    Of rows with equal payloads of at least ``min_revisit_bytes``, the one with the largest id is the response and the others
    revisit it. A null payload is empty, a null url an empty target. A row with a null id can't be named and is a
    response. Id, url and payload name a capture, so rows that repeat an id are captures of their own. Equal rows meet
    in one capture, which has a request and a metadata record for each of them. Extra columns are ignored; an empty table makes no record. Payloads are text; files are gzipped
    and hold few enough records to be read at once.
    """
    text = F.coalesce(F.col(payload), F.lit(""))
    place = F.md5(F.coalesce(F.concat(F.lit("url "), F.col(url)), F.lit("")))
    facts = [
        F.col(id).alias("id"), base32_sha1(text.cast("binary")).alias("digest"), F.octet_length(text).alias("bytes"),
        place.alias("place"),
    ]
    narrow = checkpoint(pages.select(*facts))
    chosen = (
        narrow.where((F.col("bytes") >= min_revisit_bytes) & F.col("id").isNotNull())
        .groupBy("digest", "bytes").agg(F.max(F.struct("id", "place")).alias("first"), F.count("*").alias("n"))
        .where("n > 1").drop("n")
    )
    roles = narrow.join(chosen, ["digest", "bytes"]).where("id != first.id").select("id", "digest", "bytes", "first").distinct()
    roles = stored(roles, "warc-roles")  # of a known size: where there are few, the payloads aren't shuffled for them
    rows = (
        pages.select(*facts, F.col(url).alias("url"), text.alias("payload"))
        .join(roles, ["id", "digest", "bytes"], "left")
    )

    def capture(id: Column, place: Column) -> Column:
        named = F.coalesce(F.concat(F.lit("id "), id.cast("string")), F.lit("null"))
        return F.concat_ws(" ", named, F.col("digest"), F.col("bytes").cast("string"), place)

    key = capture(F.col("id"), F.col("place"))
    digest = F.concat(F.lit("sha1:"), F.col("digest"))
    response, first = _uuid("response", key), _uuid("response", capture(F.col("first.id"), F.col("first.place")))
    target = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\r\n]", "")
    common = [("WARC-Date", F.lit(date)), ("WARC-Target-URI", target)]
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF * 2}"))
    revisit = F.col("first").isNotNull()
    body = F.when(revisit, http).otherwise(F.concat(http, F.col("payload")))
    rules = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    answer = _record(
        [
            ("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
            ("WARC-Record-ID", response),
            *common,
            ("WARC-Payload-Digest", digest),
            ("WARC-Refers-To", F.when(revisit, first)),
            ("WARC-Profile", F.when(revisit, F.lit(rules))),
            ("Content-Type", F.lit("application/http; msgtype=response")),
        ],
        body,
    )
    request = _record(
        [
            ("WARC-Type", F.lit("request")),
            ("WARC-Record-ID", _uuid("request", key)),
            *common,
            ("WARC-Concurrent-To", response),
            ("Content-Type", F.lit("application/http; msgtype=request")),
        ],
        F.concat(F.lit("GET "), target, F.lit(f" HTTP/1.1{_CRLF * 2}")),
    )
    note = F.concat(
        F.lit("id: "), F.coalesce(F.col("id").cast("string"), F.lit("")),
        F.lit(f"{_CRLF}payload-bytes: "), F.col("bytes").cast("string"), F.lit(_CRLF),
    )
    metadata = _record(
        [
            ("WARC-Type", F.lit("metadata")),
            ("WARC-Record-ID", _uuid("metadata", key)),
            *common,
            ("WARC-Concurrent-To", response),
            ("Content-Type", F.lit("application/warc-fields")),
        ],
        note,
    )
    records = rows.select(F.explode(F.array(request, answer, metadata)).alias("value"))
    records.write.option("lineSep", _CRLF * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(folder)


# ---- reading


def _inflated(data: bytes, step: int = 1 << 14) -> Iterator[bytes]:
    """The content in chunks: gzip members one after the other, or plain. What follows a member is not copied."""
    if data[:2] != b"\x1f\x8b":
        yield data
        return
    view, at = memoryview(data), 0
    while view[at : at + 2] == b"\x1f\x8b":
        member = zlib.decompressobj(31)
        while at < len(view) and not member.eof:
            part = view[at : at + step]
            yield member.decompress(part)
            at += len(part)
        yield member.flush()
        at -= len(member.unused_data)


def parse_records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, named in lower case, and the block of each record; a cut record at the end is left out."""
    chunks = _inflated(data)
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while True:
        while (end := held.find(b"\r\n\r\n")) <= 0:
            if end == 0 or held[:2] == b"\r\n":
                del held[: 4 if end == 0 else 2]
            elif not fill(len(held) + 1):
                return
        lines = held[:end].decode("utf-8", "replace").lstrip("\r\n").split("\r\n")
        fields = {}
        for line in lines[1:]:
            name, _, value = line.partition(":")
            fields.setdefault(name.strip().lower(), value.strip())
        length = int(fields.get("content-length", "0"))
        if not fill(end + 4 + length):
            return
        block = bytes(held[end + 4 : end + 4 + length])
        del held[: end + 4 + length]
        yield fields, block


_FIELDS = {
    "type": "warc-type", "record_id": "warc-record-id", "target": "warc-target-uri", "date": "warc-date",
    "concurrent_to": "warc-concurrent-to", "refers_to": "warc-refers-to", "digest": "warc-payload-digest",
}


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """A row per record of all archives below ``folder``, plain or gzipped: its fields, ``http_head`` and ``payload``.

    A record that holds no HTTP message has a null head and its whole block as payload. A file is read at once.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("content")
    schema = ", ".join(f"{n} string" for n in _FIELDS) + ", http_head binary, payload binary"

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string()] * len(_FIELDS) + [pa.binary()] * 2
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, names=[*_FIELDS, "http_head", "payload"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for data in (x for b in batches for x in b.column(0)):
            for fields, block in parse_records(data.as_py()):
                head, found, rest = block.partition(b"\r\n\r\n")
                http = bool(found) and fields.get("content-type", "").startswith("application/http")
                rows.append((*[fields.get(f) for f in _FIELDS.values()], head if http else None, rest if http else block))
                size += len(block)
                if size > 8 << 20 or len(rows) >= 4096:
                    yield batch(rows)
                    rows, size = [], 0
        if rows:
            yield batch(rows)

    return files.mapInArrow(run, schema)


def captures(records: DataFrame) -> DataFrame:
    """One nested row per capture: the response or revisit with the records that name it as concurrent.

    ``record_id, type, target, date, digest, refers_to, http_head, payload`` and the arrays ``requests`` and ``metadata`` of
    ``record_id, http_head, payload``, in order of their ids. A capture without such records has empty arrays; a record
    that names no capture is left out. Every record is shuffled once, by the id of its capture.
    """
    answer = F.col("type").isin("response", "revisit", "resource")
    keyed = records.select(
        F.when(answer, F.col("record_id")).otherwise(F.col("concurrent_to")).alias("capture"),
        F.when(answer, F.struct("type", "target", "date", "digest", "refers_to", "http_head", "payload")).alias("answer"),
        *[
            F.when(F.col("type") == kind, F.struct("record_id", "http_head", "payload")).alias(kind)
            for kind in ("request", "metadata")
        ],
    ).where("capture IS NOT NULL")
    joined = keyed.groupBy("capture").agg(
        F.first("answer", ignorenulls=True).alias("answer"),
        F.array_sort(F.collect_list("request")).alias("requests"),
        F.array_sort(F.collect_list("metadata")).alias("metadata"),
    )
    return joined.where("answer IS NOT NULL").select(F.col("capture").alias("record_id"), "answer.*", "requests", "metadata")
