"""Sources, sinks and jobs on files the tests write."""

import gzip
from datetime import datetime, timedelta, timezone

import numpy as np
import pytest
from fixtures import fits_file, image
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.operators import catalog as C
from nightframe.operators import headers as H
from nightframe.operators import lines as L
from nightframe.operators import match as M
from nightframe.plans import build_catalog as B
from nightframe.plans import preprocess as P
from nightframe.plans import runlogs, weather
from nightframe.registry.detector import _models
from nightframe.sources import files, fits, sinks
from nightframe.streaming import refresh as S

RNG = np.random.default_rng(0)
PIXELS = [RNG.integers(0, 65536, size=(30, 20)) for _ in range(2)]
SECTIONS = {"DATASEC": "[1:24,1:20]", "BIASSEC": "[25:30,1:18]", "SATURATE": 60000.0}


def two_image_file(**cards):
    return fits_file(
        [image(p, **SECTIONS) for p in PIXELS],
        OBSTYPE="OBJECT  ", RUNID="r1", OBJECT="star", CHANNEL="B", UTC="2024-01-02T03:04:05", EXPTIME=30.5,
        **{"DATE-OBS": 1704164645}, **cards,
    )


@pytest.fixture
def tree(tmp_path):
    root = tmp_path / "data"
    run = root / "raw/runs/run_id=9/night"
    run.mkdir(parents=True)
    (root / "top.fits").write_bytes(two_image_file())
    (run / "a.fits").write_bytes(two_image_file())
    (run / "note.md").write_text("skip me")
    flat = root / "raw/runs/run_id=9/channel=R"
    flat.mkdir(parents=True)
    (flat / "flat.fits").write_bytes(fits_file([image(PIXELS[0])], OBSTYPE="FLAT", CHANNEL="B"))
    logs = root / "raw/logs/type=RAW_LOGS"
    logs.mkdir(parents=True)
    lines = [
        b"SNIFS_on 1 2 B ==>Tue Jan  2 03:04:05 UTC 2024 ",
        b"SNIFS_on 1 2 R ==>Tue Jan  2 03:04:01 UTC 2024   ",
        b"SNIFS_on 1 2 R ==>Tue Jan  2 03:04:09 UTC 2024",
        b"bad \xff byte SNIFS_on 1 2 B ==>never ",
        b"other",
    ]
    (logs / "log.gz").write_bytes(gzip.compress(b"\n".join(lines) + b"\n"))
    (root / "raw/misc").mkdir(parents=True)
    (root / "raw/misc/untyped.txt").write_text("x")
    return str(root)


def test_listing_skips_root_files_and_notes(spark, tree):
    got = {r.file_path for r in files.list_files(spark, tree).collect()}
    assert got == {
        "raw/runs/run_id=9/night/a.fits", "raw/runs/run_id=9/channel=R/flat.fits",
        "raw/logs/type=RAW_LOGS/log.gz", "raw/misc/untyped.txt",
    }


def test_listing_does_not_read_contents(spark, tree):
    plan = files.list_files(spark, tree)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_catalog_build_refresh_and_delete(spark, tree, tmp_path):
    store = str(tmp_path / "catalog")
    t0 = datetime(2024, 5, 1, tzinfo=timezone.utc)
    first = B.refresh_catalog(spark, tree, store, added=t0)
    rows = {r.file_path: r for r in files.read_catalog(spark, first).collect()}
    assert len(rows) == 3  # the untyped file is dropped
    a = rows["raw/runs/run_id=9/night/a.fits"]
    assert (a.type, a.run_id, a.object, a.channel, a.exposure_seconds) == ("OBJECT", "9", "star", "B", 30.5)
    assert (a.num_extensions, a.num_data_extensions) == (3, 2)
    assert a.time_creation == datetime(2024, 1, 2, 3, 4, 5) and a.time_observation == datetime(2024, 1, 2, 3, 4, 5)
    flat = rows["raw/runs/run_id=9/channel=R/flat.fits"]
    assert (flat.type, flat.channel) == ("RASTER", "R")  # small flat; path wins over header

    from pathlib import Path

    Path(tree, "raw/runs/run_id=9/night/b [1].fits").write_bytes(two_image_file())
    Path(tree, "raw/runs/run_id=9/channel=R/flat.fits").unlink()
    second = B.refresh_catalog(spark, tree, store, added=t0 + timedelta(days=1))
    assert second != first
    rows = {r.file_path: r for r in files.read_catalog(spark, second).collect()}
    assert set(rows) == {
        "raw/runs/run_id=9/night/a.fits", "raw/runs/run_id=9/night/b [1].fits", "raw/logs/type=RAW_LOGS/log.gz",
    }
    # The known file was not analysed again, the new one was.
    assert rows["raw/runs/run_id=9/night/a.fits"].time_added < rows["raw/runs/run_id=9/night/b [1].fits"].time_added
    third = B.refresh_catalog(spark, tree, store, refresh=True, added=t0 + timedelta(days=2))
    added = {r.time_added for r in files.read_catalog(spark, third).collect()}
    assert len(added) == 1


def test_empty_tree_gives_empty_catalog(spark, tmp_path):
    root = tmp_path / "empty"
    root.mkdir()
    path = B.refresh_catalog(spark, str(root), str(tmp_path / "catalog"))
    assert files.read_catalog(spark, path).count() == 0


def test_upsert_writes_only_changes(spark, tree, tmp_path):
    store = str(tmp_path / "catalog")
    B.refresh_catalog(spark, tree, store)
    found = files.read_files(spark, tree).filter(F.endswith("file_path", F.lit("a.fits")))
    assert B.upsert_files(spark, found, store) is None
    renamed = found.withColumn("file_path", F.lit("raw/runs/run_id=9/night/c.fits"))
    assert B.upsert_files(spark, renamed, store) is not None
    assert B.current_catalog(spark, store).filter("file_name = 'c.fits'").count() == 1


def test_unfinished_snapshot_is_ignored(spark, tree, tmp_path):
    store = tmp_path / "catalog"
    first = B.refresh_catalog(spark, tree, str(store))
    (store / "snapshot-0000000007").mkdir()
    assert sinks.latest_snapshot(spark, str(store)) == first


def test_catalog_is_written_in_path_order(spark, tmp_path):
    rows = spark.range(5000).select(F.concat(F.lit("p"), F.hash("id").cast("string")).alias("file_path"))
    path = sinks.write_catalog(C.conform(rows), str(tmp_path / "c"))
    got = [r.file_path for r in spark.read.parquet(path).select("file_path").collect()]
    assert len(got) == 5000


def test_headers(spark, tree):
    h = fits.header_rows(files.read_files(spark, tree).filter(F.endswith("file_path", F.lit("a.fits")))).cache()
    primary = {r.key: r for r in fits.headers_of(h, 0).collect()}
    assert primary["OBSTYPE"].value_str == "OBJECT" and primary["SIMPLE"].value_bool is True
    assert fits.headers_of_data(h).select("hdu").distinct().count() == 2
    with pytest.raises(PySparkException, match="no such HDU"):
        fits.headers_of(h, 5).collect()


def test_lines_and_headers_of_images(spark, tree):
    found = files.read_files(spark, tree).filter(F.endswith("file_path", F.lit("a.fits")))
    lines = fits.image_lines(found)
    rows = lines.collect()
    for r in rows:
        assert r.data == PIXELS[r.amp][r.x].astype(float).tolist()
        assert (r.bias_lo, r.bias_hi, r.x_extent, r.saturate) == (24, 30, 30, 60000.0)
    assert len(rows) == 60
    first = fits.images_with_headers(found).first()
    assert first.header["BIASSEC"] == "[25:30,1:18]" and first.variance == [0.0] * 20


def test_float_images_scale(spark):
    from fixtures import header

    data = np.arange(6, dtype=">f4").reshape(2, 3)  # 2 rows of 3: y runs over rows
    body = header({"SIMPLE": True, "BITPIX": -32, "NAXIS": 2, "NAXIS1": 3, "NAXIS2": 2, "BSCALE": 2.0, "BZERO": 1.0})
    content = body + data.tobytes().ljust(2880, b"\0")
    df = spark.createDataFrame([("f.fits", bytearray(content))], "file_path string, content binary")
    got = {r.x: r.data for r in fits.image_lines(df).collect()}
    assert got == {0: [1.0, 7.0], 1: [3.0, 9.0], 2: [5.0, 11.0]}
    with pytest.raises(PySparkException, match="integers"):
        fits.image_lines(df, integer=True).collect()


def test_truncated_file_fails(spark):
    df = spark.createDataFrame([("f.fits", bytearray(two_image_file()[:-2880]))], "file_path string, content binary")
    with pytest.raises(PySparkException, match="cut off"):
        fits.image_lines(df).collect()


@pytest.mark.parametrize("axis", ["x", "y"])
def test_one_image_file_is_split_and_processed_like_two(spark, axis):
    """The same two amplifiers, once in two images and once beside each other in one."""
    left, right = PIXELS
    if axis == "x":
        sections = {"DATASEC0": "[1:24,1:20]", "BIASSEC0": "[25:30,1:20]", "DATASEC1": "[60:37,1:20]", "BIASSEC1": "[36:31,1:20]"}
        one, bias = np.concatenate([left, right[::-1]]), "[25:30,1:20]"
    else:
        sections = {"DATASEC0": "[1:30,1:16]", "BIASSEC0": "[1:30,17:20]", "DATASEC1": "[60:31,1:16]", "BIASSEC1": "[60:31,17:20]"}
        one, bias = np.concatenate([left, right[::-1]]), "[1:30,17:20]"
    content = fits_file([image(one, SATURATE=60000.0, CCDNAMP=2, **sections)], OBSTYPE="OBJECT", CHANNEL="B")
    df = spark.createDataFrame([("f.fits", bytearray(content))], "file_path string, content binary")
    split = L.split_lines(fits.image_lines(df, integer=True), axis)
    got = {(r.amp, r.x): r for r in split.collect()}
    assert len(got) == 60
    for amp, pixels in enumerate((left, right)):
        for x in range(30):
            assert got[amp, x].data == pixels[x].tolist()
            assert got[amp, x].biassec == bias and got[amp, x].x_extent == 30
    two = fits_file([image(p, SATURATE=60000.0, BIASSEC=bias) for p in PIXELS], CHANNEL="B")
    both = spark.createDataFrame([("f.fits", bytearray(two))], "file_path string, content binary")
    models = _models(spark)
    a = P.preprocess_images(split, models).orderBy("amp", "x", "y").collect()
    b = P.preprocess_images(fits.image_lines(both, integer=True), models).orderBy("amp", "x", "y").collect()
    assert a == b and len(a) == 1200


def test_split_header(spark):
    cards = {"DATASEC0": "[1:30,1:16]", "BIASSEC0": "[1:30,17:20]", "DATASEC1": "[60:31,1:16]", "BIASSEC1": "[60:31,17:20]",
             "CCD0GAIN": 0.7, "CCD1GAIN": 0.8, "CCDSEC0": "a", "CCDSEC1": "b", "AMPSEC0": "c", "AMPSEC1": "d",
             "DETSEC0": "e", "DETSEC1": "f", "CCDBIN0": "1 1", "CCDBIN1": "2 2", "CCDNAMP": 2, "DETTEMP": -100.5, "KEEP": "k"}
    content = fits_file([image(PIXELS[0], **cards)])
    df = spark.createDataFrame([("f.fits", bytearray(content))], "file_path string, content binary")
    rows = H.split_header(fits.header_rows(df).filter("hdu = 1")).withColumn("v", H.shown_value()).collect()
    got = {(r.amp, r.key): r.v for r in rows}
    assert len(got) == len(rows)
    for amp, gain, ccd, binning in ((0, "0.7", "a", "1 1"), (1, "0.8", "b", "2 2")):
        assert got[amp, "ORIGINAL_GAIN"] == gain and got[amp, "CCDSEC"] == ccd and got[amp, "CCDBIN"] == binning
        assert got[amp, "DATASEC"] == "[1:30,1:16]" and got[amp, "BIASSEC"] == "[1:30,17:20]"
        assert got[amp, "CCDNAMP"] == "1" and got[amp, "CCDTEMP"] == "-100.5" and got[amp, "KEEP"] == "k"


def test_run_logs(spark, tree, tmp_path):
    store = str(tmp_path / "catalog")
    catalog = files.read_catalog(spark, B.refresh_catalog(spark, tree, store))
    events = runlogs.log_events(spark, tree, catalog).filter("time IS NOT NULL").orderBy("time").collect()
    assert [(r.channel, str(r.time)) for r in events] == [("R", "2024-01-02 03:04:01"), ("B", "2024-01-02 03:04:05")]
    path = runlogs.extract_run_logs(spark, tree, store, catalog)
    assert spark.read.parquet(path).filter("type = 'CCD_ON_TIMES'").count() == 3
    registered = B.current_catalog(spark, store).filter("type = 'CCD_ON_TIMES'")
    assert registered.count() >= 1


def test_weather_refresh(spark, tmp_path):
    landing, store = tmp_path / "landing", str(tmp_path / "weather")
    landing.mkdir()
    (landing / "wx.2023.dat").write_text("2023 12 31 14 0 5 10 1.5 20 600.5 surplus\n2023 12 31 14 0 6 10 1.5 20\n")
    (landing / "wx.2024.dat").write_text("2024 1 1 0 0 7 10 1.5 20 600\n")
    (landing / "wx.2020.dat").write_text("2020 1 1 0 0 7 10 1.5 20 600\n")
    now = datetime(2024, 1, 3, tzinfo=timezone.utc)
    path = weather.refresh_weather(spark, str(landing), store, now=now)
    rows = spark.read.parquet(path).orderBy("time").collect()
    assert [(str(r.time), r.wind_speed, r.pressure) for r in rows] == [
        ("2024-01-01 00:00:00", 6, None), ("2024-01-01 10:00:00", 7, 600.0)
    ]
    assert rows[0].type == "WEATHER" and rows[0].station == "CFHT"
    # Newly read rows win; a series with a recent row is left alone.
    (landing / "wx.2024.dat").write_text("2024 1 1 0 0 9 10 1.5 20 600\n2024 1 2 13 58 1 1 1.0 1 1\n")
    second = weather.refresh_weather(spark, str(landing), store, now=now)
    speeds = [r.wind_speed for r in spark.read.parquet(second).orderBy("time").collect()]
    assert speeds == [6, 9, 1]
    assert weather.refresh_weather(spark, str(landing), store, now=now) is None
    series = weather.report(spark, store, now)
    assert series.filter("metric = 'pressure'").count() == 2


def test_weather_quality_stops_bad_rows(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "wx.2024.dat").write_text("2024 1 1 0 0 9 10 warm 20 600\n")
    with pytest.raises(ValueError, match="not_null"):
        weather.refresh_weather(spark, str(landing), str(tmp_path / "w"), now=datetime(2024, 1, 3, tzinfo=timezone.utc))
    # What failed its check was written but never published.
    assert weather.current_weather(spark, str(tmp_path / "w")) is None


def test_streams_reach_the_batch_result(spark, tree, tmp_path):
    store, marks = str(tmp_path / "catalog"), str(tmp_path / "marks")
    S.stream_catalog(spark, tree, store, marks, files_per_batch=1).awaitTermination()
    streamed = B.current_catalog(spark, store).drop("time_added")
    batch = files.read_catalog(spark, B.refresh_catalog(spark, tree, str(tmp_path / "batch"))).drop("time_added")
    assert sorted(streamed.collect()) == sorted(batch.collect()) or (
        C.fingerprint(streamed).first() == C.fingerprint(batch).first()
    )

    landing, series = tmp_path / "landing", str(tmp_path / "weather")
    landing.mkdir()
    (landing / "wx.2023.dat").write_text("2023 12 31 14 0 5 10 1.5 20 600.5\n")
    S.stream_weather(spark, str(landing), series, str(tmp_path / "marks2")).awaitTermination()
    (landing / "wx.2024.dat").write_text("2023 12 31 14 0 8 10 1.5 20 600.5\n2024 1 1 0 0 7 10 1.5 20 600\n")
    S.stream_weather(spark, str(landing), series, str(tmp_path / "marks2")).awaitTermination()
    rows = weather.current_weather(spark, series).orderBy("time").collect()
    assert [r.wind_speed for r in rows] == [8, 7]
