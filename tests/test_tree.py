"""Listing by executors, ranged header reads, the data source, commits of several writers."""

import os
import time
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
import pytest
from fixtures import fits_file, image
from pyspark.sql import functions as F

from nightframe.operators import catalog as C
from nightframe.plans import build_catalog as B
from nightframe.sources import files, fits, sinks, storage, tree
from nightframe.sources.headers import ImageHeaders
from nightframe.streaming import refresh as S

BIG = image(np.random.default_rng(1).integers(1000, 3000, size=(400, 1000)), DATASEC="[1:390,1:1000]")


def put(root, path, data=b"x"):
    place = Path(root) / path
    place.parent.mkdir(parents=True, exist_ok=True)
    place.write_bytes(data)
    return place


def touched(*folders, age=50):
    for folder in folders:
        os.utime(folder, (time.time() - age, time.time() - age))


def aged(root, age=100):
    """Folders changed a while ago, as they mostly are."""
    then = time.time() - age
    for folder, _, _ in os.walk(root):
        os.utime(folder, (then, then))


def fill(root):
    for path in ("raw/a/1.fits", "raw/a/2.fits", "raw/b/c/3.fits", "raw/b/.hidden", "_tmp/4.fits", "top.txt", "raw/k=_1/5.fits", "raw/_k=1/6.fits"):
        put(root, path, path.encode())
    (Path(root) / "raw/none").mkdir()
    aged(root)


def paths(t):
    return sorted(r.file_path for r in t.files.collect())


def test_walk_lists_what_spark_lists(spark, tmp_path):
    root = str(tmp_path / "t")
    fill(root)
    found = {r.file_path: (r.length, r.modificationTime) for r in tree.walk(spark, root).files.collect()}
    assert found == {r.file_path: (r.length, r.modificationTime) for r in files.list_any(spark, root).collect()}
    assert tree.walk(spark, str(tmp_path / "missing")).files.count() == 0
    assert storage.store_of("file:///a/b")[1] == storage.store_of("file:/a/b")[1] == storage.store_of("/a/b")[1] == "/a/b"
    assert not storage.reachable("nosuch://host/a")


def test_unchanged_folders_are_not_listed_again(spark, tmp_path, monkeypatch):
    root, store = str(tmp_path / "t"), str(tmp_path / "trees")
    fill(root)
    first = tree.read_tree(spark, tree.write_tree(tree.walk(spark, root), store))
    assert first.folders.filter("listed").count() == first.folders.count() == 8
    again = tree.walk(spark, root, tree.latest_tree(spark, store))
    assert again.folders.filter("listed").count() == 0 and paths(again) == paths(first)

    Path(root, "raw/a/2.fits").unlink()
    put(root, "raw/b/c/d/7.fits")
    touched(Path(root, "raw/b/c/d"), Path(root, "raw/b/c"), Path(root, "raw/a"))
    later = tree.walk(spark, root, first)
    assert sorted(r.folder for r in later.folders.filter("listed").collect()) == ["raw/a", "raw/b/c", "raw/b/c/d"]
    changed = {(r.file_path, r.change) for r in tree.changes(first, later).collect()}
    assert changed == {("raw/a/2.fits", "removed"), ("raw/b/c/d/7.fits", "added")}
    assert tree.changes(first, again).count() == 0
    # a file that grows in place shows when folder times aren't trusted
    with open(Path(root, "raw/a/1.fits"), "ab") as f:
        f.write(b"more")
    whole = tree.walk(spark, root, later, trust_times=False)
    assert [tuple(r) for r in tree.changes(later, whole).collect()] == [("raw/a/1.fits", "changed")]


def test_a_folder_changed_just_now_is_listed_again(spark, tmp_path):
    root = str(tmp_path / "t")
    put(root, "a/1.txt")
    first = tree.read_tree(spark, tree.write_tree(tree.walk(spark, root), str(tmp_path / "trees")))
    assert tree.walk(spark, root, first).folders.filter("listed").count() == 2


def test_digests_follow_from_content_alone(spark, tmp_path):
    for name in ("one", "two"):
        fill(tmp_path / name)
        for folder, _, names in os.walk(tmp_path / name):
            for n in names:
                os.utime(os.path.join(folder, n), (1e9, 1e9))
    a, b = ({r.folder: r.digest for r in tree.digests(tree.walk(spark, str(tmp_path / n))).collect()} for n in ("one", "two"))
    assert a == b and set(a) == {"", "raw", "raw/a", "raw/b", "raw/b/c", "raw/k=_1", "raw/_k=1"}
    put(tmp_path / "two", "raw/b/c/8.fits")
    b = {r.folder: r.digest for r in tree.digests(tree.walk(spark, str(tmp_path / "two"))).collect()}
    assert {k for k in a if a[k] != b[k]} == {"", "raw", "raw/b", "raw/b/c"}


def test_headers_are_all_that_is_read(spark, tmp_path):
    data = fits_file([BIG, BIG], OBSTYPE="FLAT", RUNID="r")
    asked = []

    def read(at, n):
        asked.append((at, n))
        return data[at : at + n]

    parts = list(fits.ranged_hdus(read, len(data)))
    assert parts == list(fits.hdus(data)) and len(parts) == 3
    assert sum(n for _, n in asked) <= 3 * fits.RECORDS_PER_READ * fits.BLOCK < len(data) / 40
    starts = [0] + [at - 2 * fits.BLOCK for _, _, at, _ in parts]
    assert all(any(abs(at - s) <= 4 * fits.BLOCK for s in starts) for at, _ in asked)
    asked.clear()
    assert len(list(fits.ranged_hdus(read, len(data), last=0))) == 1 and sum(n for _, n in asked) <= 4 * fits.BLOCK

    for i in range(5):
        put(tmp_path, f"raw/f{i}.fits", data)
    put(tmp_path, "raw/cut.fits", data[:-5000])
    root = str(tmp_path)
    found = tree.walk(spark, root).files
    with pytest.raises(Exception, match="cut off"):
        fits.header_rows_at(found, root).count()
    rows = fits.header_rows_at(found, root, strict=False)
    whole = fits.header_rows(files.read_files(spark, root), strict=False)
    assert sorted(map(str, rows.collect())) == sorted(map(str, whole.collect()))


def test_data_source(spark, tmp_path):
    spark.dataSource.register(ImageHeaders)
    root = str(tmp_path)
    data = fits_file([BIG], OBSTYPE="FLAT", RUNID="r")
    for i in range(12):
        put(tmp_path, f"raw/run={i % 3}/f{i}.fits", data)
    put(tmp_path, "raw/run=1/notes.txt")
    put(tmp_path, "above.fits", data)
    want = fits.header_rows_at(tree.walk(spark, root).files, root)
    for n in (1, 2, 64):
        read = spark.read.format("image_headers").option("partitions", n).load(root)
        assert sorted(map(str, read.collect())) == sorted(map(str, want.collect()))
    condition = (F.col("hdu") == 0) & F.col("key").isin("RUNID", "OBSTYPE") & F.startswith("file_path", F.lit("raw/run=1/"))
    assert sorted(map(str, read.filter(condition).collect())) == sorted(map(str, want.filter(condition).collect()))
    # the other runs' files needn't even be readable
    put(tmp_path, "raw/run=2/broken.fits", data[:-4000])
    narrow = spark.read.format("image_headers").options(last_hdu=0, keys="RUNID,obstype", prefix="raw/run=1/").load(root)
    assert sorted(map(str, narrow.collect())) == sorted(map(str, want.filter(condition).collect())) and narrow.count() == 8
    with pytest.raises(Exception, match="cut off"):
        read.count()
    assert spark.read.format("image_headers").option("strict", "false").load(root).count() == want.filter("file_path NOT LIKE '%broken%'").count()


ADDED = datetime(2024, 6, 1, tzinfo=timezone.utc)


def found(spark, *names, run="r1"):
    data = fits_file([image(np.ones((4, 4)))], OBSTYPE="OBJECT", RUNID=run)
    return spark.createDataFrame([(f"raw/{n}.fits", len(data), data) for n in names], "file_path string, length long, content binary")


def known(spark, store):
    return {r.file_path: r.run_id for r in B.current_catalog(spark, store).collect()}


def test_two_upserts_on_one_base_are_both_kept(spark, tmp_path, monkeypatch):
    store = str(tmp_path / "c")
    B.upsert_files(spark, found(spark, "a"), store, ADDED)
    write, others = sinks.write_catalog, ["b"]

    def interleaved(*args, **kwargs):
        # before this writer commits, another one does
        if others:
            B.upsert_files(spark, found(spark, others.pop()), store, ADDED)
        return write(*args, **kwargs)

    monkeypatch.setattr(sinks, "write_catalog", interleaved)
    B.upsert_files(spark, found(spark, "c"), store, ADDED)
    assert set(known(spark, store)) == {"raw/a.fits", "raw/b.fits", "raw/c.fits"}
    assert sinks.head(spark, store).number == 2


def test_conflicts_and_checks(spark, tmp_path):
    store = str(tmp_path / "c")
    rows = C.conform(B.entries_of(found(spark, "a"), ADDED))
    base = sinks.head(spark, store)
    assert base.number == -1 and base.path is None
    first = sinks.write_catalog(rows, store, base=base)
    with pytest.raises(sinks.Conflict):
        sinks.write_catalog(rows, store, base=base)
    assert sinks.latest_snapshot(spark, store) == first
    with pytest.raises(sinks.Conflict):
        sinks.committed(spark, store, lambda _: sinks.write_catalog(rows, store, base=base), attempts=2)

    def wrong(_):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        sinks.write_catalog(rows, store, wrong)
    assert sinks.latest_snapshot(spark, store) == first
    assert not sinks._create_once(spark, f"{store}/{sinks.COMMITS}/0000000000", "{}")


def test_snapshots_without_a_log_are_still_read(spark, tmp_path):
    store = str(tmp_path / "c")
    rows = C.conform(B.entries_of(found(spark, "a"), ADDED))
    path = f"{store}/snapshot-0000000003-abc"
    rows.write.parquet(path)
    assert sinks.latest_snapshot(spark, store) is None
    (Path(path) / sinks.PUBLISHED).touch()
    assert sinks.latest_snapshot(spark, store) == path
    B.upsert_files(spark, found(spark, "b"), store, ADDED)
    assert set(known(spark, store)) == {"raw/a.fits", "raw/b.fits"}


def test_moved_fingerprint_is_the_full_one(spark, tmp_path):
    store = str(tmp_path / "c")
    names = [f"n{i}" for i in range(20)]
    B.upsert_files(spark, found(spark, *names), store, ADDED)
    rng = np.random.default_rng(3)
    for step in range(4):
        some = [str(n) for n in rng.choice(names + [f"m{step}"], 5, replace=False)]
        B.upsert_files(spark, found(spark, *some, run=f"r{step}"), store, datetime(2024, 6, 2 + step, tzinfo=timezone.utc), replaces="raw/n1." if step == 2 else None)
        head = sinks.head(spark, store)
        assert head.notes == sinks.fingerprint_notes(B.current_catalog(spark, store))
    number = head.number
    assert B.upsert_files(spark, found(spark, *some, run="r3"), store, datetime(2024, 7, 1, tzinfo=timezone.utc)) is None
    assert sinks.head(spark, store).number == number


def test_refresh_lists_and_opens_only_what_is_new(spark, tmp_path):
    root, store = tmp_path / "data", str(tmp_path / "catalog")
    data = fits_file([image(np.ones((4, 4)))], OBSTYPE="OBJECT", RUNID="r1")
    for run in ("a", "b"):
        put(root, f"raw/{run}/1.fits", data)
    aged(root)
    B.refresh_catalog(spark, str(root), store, added=ADDED)
    put(root, "raw/b/2.fits", data)
    touched(root / "raw/b")
    B.refresh_catalog(spark, str(root), store, added=ADDED)
    walked = tree.latest_tree(spark, f"{store}/_tree")
    assert [r.folder for r in walked.folders.filter("listed").collect()] == ["raw/b"]
    assert set(known(spark, store)) == {"raw/a/1.fits", "raw/b/1.fits", "raw/b/2.fits"}
    (root / "raw/a/1.fits").unlink()
    touched(root / "raw/a", age=40)
    B.refresh_catalog(spark, str(root), store, added=ADDED)
    assert set(known(spark, store)) == {"raw/b/1.fits", "raw/b/2.fits"}


def test_a_stream_writes_changed_minutes_only(spark, tmp_path):
    landing, out, marks = str(tmp_path / "landing"), str(tmp_path / "out"), str(tmp_path / "marks")
    line = "2024 1 1 0 {} {} 10 1.5 20 600\n"
    put(landing, "wx.a.2024.dat", "".join(line.format(m, 7) for m in range(40)).encode() + b"no time\n")
    S.stream_weather_updates(spark, landing, out, marks).awaitTermination()
    put(landing, "wx.b.2024.dat", (line.format(3, 7) + line.format(4, 8) + line.format(4, 9) + line.format(50, 1)).encode())
    S.stream_weather_updates(spark, landing, out, marks).awaitTermination()
    S.stream_weather_updates(spark, landing, out, marks).awaitTermination()
    batches = spark.read.parquet(out).groupBy("batch").count().collect()
    assert {r["batch"]: r["count"] for r in batches} == {0: 41, 1: 2}
    speeds = {r.time.minute: r.wind_speed for r in S.current_minutes(spark, out).filter("time IS NOT NULL").collect()}
    assert speeds == {**dict.fromkeys(range(40), 7), 4: 9, 50: 1}
