"""Archives: round trips, revisits and assembly, odd rows and foreign files."""

import base64
import gzip
import hashlib

import duckdb
import pytest
from pyspark.sql import functions as F

from nightframe.llm import registry as R
from nightframe.llm import warc as W

PAGES = "page_id long, url string, html string, payload string, digest string"


@pytest.fixture
def round_trip(spark, tmp_path):
    def go(rows, **options):
        folder = str(tmp_path / "warc")
        W.write(spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES), folder, **options)
        return folder, W.captures(W.read_records(spark, folder)).collect()

    return go


def test_payloads_come_back(round_trip):
    tricky = "<p>\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n</p>"
    texts = [tricky, "é日🎉" * 50, "", None, "a" * 200_000, "plain", "plain", "", None, "x\r\n"]
    rows = [(i, f"http://h/{i}\r\nX: y" if i == 0 else f"http://h/{i}", t) for i, t in enumerate(texts)]
    _, found = round_trip(rows, records_per_file=7)
    assert len(found) == len(rows)
    for r in found:
        note = bytes(r["metadata"][0]["payload"]).decode()
        i = int(note.split("\r\n")[0].removeprefix("id: "))
        text = (texts[i] or "").encode()
        assert r["digest"] == "sha1:" + base64.b32encode(hashlib.sha1(text).digest()).decode()
        assert len(r["requests"]) == 1 and len(r["metadata"]) == 1
        same = [j for j, t in enumerate(texts) if (t or "") == (texts[i] or "")]
        assert r["type"] == ("response" if i == max(same) else "revisit")
        assert bytes(r["payload"]) == (text if r["type"] == "response" else b"")
        assert f"payload-bytes: {len(text)}\r\n" in note


def test_small_payloads_are_all_responses(round_trip):
    _, found = round_trip([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")], min_revisit_bytes=3)
    assert sorted(r["type"] for r in found) == ["response", "response", "response", "revisit"]


def test_null_and_repeated_ids_and_empty_table(round_trip, spark, tmp_path):
    _, found = round_trip([(None, "u", "a"), (None, "v", "a"), (5, None, "a"), (5, None, "a"), (6, "u", "b")])
    assert sorted(len(r["requests"]) for r in found) == [1, 1, 1, 2]
    assert all(r["type"] == "response" for r in found)
    W.write(spark.createDataFrame([], PAGES), str(tmp_path / "none"))
    assert W.captures(W.read_records(spark, str(tmp_path / "none"))).count() == 0


def test_rows_that_repeat_an_id_keep_their_payloads(round_trip):
    _, found = round_trip([(5, "u", "a"), (5, "u", "b"), (9, "u", "a"), (5, "v", "b"), (None, "u", "a")])
    got = sorted((r["target"], r["type"], bytes(r["payload"])) for r in found)
    assert got == [("u", "response", b"a")] * 2 + [("u", "response", b"b"), ("u", "revisit", b""), ("v", "response", b"b")]
    (revisit,) = [r for r in found if r["type"] == "revisit"]
    (first,) = [r for r in found if r["record_id"] == revisit["refers_to"]]
    assert bytes(first["payload"]) == b"a" and bytes(first["metadata"][0]["payload"]).startswith(b"id: 9\r\n")


def test_query_on_repeated_and_null_ids_is_its_sql(spark, tmp_path):
    rows = [(5, "u", "a"), (5, "u", "b"), (9, "u", "a"), (9, "v", "a"), (9, "v", "a"), (5, "u", "b"), (7, "u", None), (7, "u", "")]
    rows += [(None, "u", "a"), (None, "u", "a"), (None, "v", "c"), (8, None, "c"), (3, "u", "c"), (3, "u", "c")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    pages.coalesce(1).write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    want = con.execute(R.ORACLE["op8_warc"]).fetchall()
    got = [tuple(r) for r in R.op8_warc(spark, str(tmp_path)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len(got) == len(rows)


def test_foreign_archives(spark, tmp_path):
    def record(kind, id, block, *fields):
        head = [b"WARC/1.0", b"WARC-Type: " + kind, b"WARC-Record-ID: " + id, *fields, b"Content-Length: %d" % len(block)]
        return b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n"

    http = b"Content-Type: application/http"
    parts = [
        record(b"warcinfo", b"<i>", b"software: x\r\n"),
        record(b"response", b"<a>", b"HTTP/1.1 200 OK\r\n\r\n\xff\xfe\x00\r\n\r\nrest", http),
        record(b"request", b"<b>", b"GET / HTTP/1.1\r\n\r\n", http, b"WARC-Concurrent-To: <a>"),
        record(b"metadata", b"<m1>", b"k: v", b"WARC-Concurrent-To: <a>"),
        record(b"metadata", b"<m2>", b"k: w", b"WARC-Concurrent-To: <a>"),
        record(b"metadata", b"<lost>", b"k: w", b"WARC-Concurrent-To: <nowhere>"),
    ]
    for name, data in (("plain", b"".join(parts)), ("members", b"".join(map(gzip.compress, parts))), ("whole", gzip.compress(b"".join(parts)))):
        folder = tmp_path / name
        folder.mkdir()
        (folder / "x.warc").write_bytes(data + b"WARC/1.0\r\nContent-Length: 999\r\n\r\ncut" * (name == "plain"))
        assert W.read_records(spark, str(folder)).count() == 6
        (r,) = W.captures(W.read_records(spark, str(folder))).collect()
        assert (r["record_id"], bytes(r["payload"])) == ("<a>", b"\xff\xfe\x00\r\n\r\nrest")
        assert [m["record_id"] for m in r["metadata"]] == ["<m1>", "<m2>"] and len(r["requests"]) == 1


def test_base32(spark):
    for data in (b"", b"abc", bytes(range(256))):
        got = spark.createDataFrame([(data,)], "b binary").select(W.base32_sha1(F.col("b"))).first()[0]
        assert got == base64.b32encode(hashlib.sha1(data).digest()).decode()


def test_query_is_every_page(spark, sf):
    rows = R.op8_warc(spark, sf).collect()
    assert len(rows) == spark.read.parquet(f"{sf}/pages.parquet").count()
    assert all(r["refers_to"] > r["page_id"] for r in rows if r["record_type"] == "revisit")


def test_reading_takes_time_as_the_members_do():
    import time

    record = b"WARC/1.0\r\nWARC-Type: resource\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    took = []
    for n in (5_000, 50_000):
        data = gzip.compress(record) * n
        began = time.time()
        assert sum(1 for _ in W.parse_records(data)) == n
        took.append(time.time() - began)
    assert took[1] < 20 * took[0] + 1


def test_negative_ids_and_columns_of_any_name(spark, tmp_path):
    pages = spark.createDataFrame([(-5, "u", "a", "x"), (3, "u", "b" * 3_000_000, "x")], "page_id long, url string, html string, id string")
    pages = pages.select("*", *[F.lit("z").alias(c) for c in "digest bytes place first payload value record_id".split()])
    pages.write.parquet(str(tmp_path / "pages.parquet"))
    assert sorted((r["page_id"], r["payload_bytes"]) for r in R.op8_warc(spark, str(tmp_path)).collect()) == [(-5, 1), (3, 3_000_000)]
