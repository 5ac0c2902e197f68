"""Jobs on changing, broken and mixed files."""

import json
from datetime import datetime, timezone
from pathlib import Path

import numpy as np
import pytest
from fixtures import fits_file, image
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.operators import catalog as C
from nightframe.operators import detector as D
from nightframe.operators import headers as H
from nightframe.operators import lines as L
from nightframe.operators import match as M
from nightframe.operators import percentiles
from nightframe.operators import quality as DQ
from nightframe.plans import build_catalog as B
from nightframe.plans import exposures, runlogs, weather
from nightframe.plans import preprocess as P
from nightframe.sources import files, fits, sinks
from nightframe.streaming import refresh as S

RNG = np.random.default_rng(4)
PIXELS = [RNG.integers(1000, 3000, size=(30, 20)) for _ in range(2)]
SECTIONS = {"DATASEC": "[1:24,1:20]", "BIASSEC": "[25:30,1:18]", "SATURATE": 60000.0}
NOW = datetime(2024, 1, 3, tzinfo=timezone.utc)


def exposure(n_images=2, channel="B", obstype="OBJECT", **cards):
    images = [image(PIXELS[i % 2], **SECTIONS) for i in range(n_images)]
    return fits_file(images, OBSTYPE=obstype, RUNID="r1", OBJECT="star", CHANNEL=channel, UTC="2024-01-02T03:04:05", **cards)


def put(root, path, data):
    place = Path(root) / path
    place.parent.mkdir(parents=True, exist_ok=True)
    place.write_bytes(data if isinstance(data, bytes) else data.encode())


def test_grown_and_replaced_files_are_read_again(spark, tmp_path):
    landing, series, marks = tmp_path / "landing", str(tmp_path / "weather"), str(tmp_path / "marks")
    put(landing, "wx.2024.dat", "2024 1 1 0 0 7 10 1.5 20 600\n")
    S.stream_weather(spark, str(landing), series, marks).awaitTermination()
    with open(landing / "wx.2024.dat", "a") as f:
        f.write("2024 1 1 0 1 8 10 1.5 20 600\n")
    S.stream_weather(spark, str(landing), series, marks).awaitTermination()
    S.stream_weather(spark, str(landing), series, marks).awaitTermination()
    assert [r.wind_speed for r in weather.current_weather(spark, series).orderBy("time").collect()] == [7, 8]

    tree, store, marks = tmp_path / "tree", str(tmp_path / "catalog"), str(tmp_path / "marks2")
    put(tree, "raw/a.fits", exposure())
    S.stream_catalog(spark, str(tree), store, marks).awaitTermination()
    put(tree, "raw/a.fits", exposure(channel="R", EXPTIME=2.5))
    S.stream_catalog(spark, str(tree), store, marks).awaitTermination()
    (row,) = B.current_catalog(spark, store).collect()
    assert (row.channel, row.exposure_seconds) == ("R", 2.5)


def test_lost_data_are_named(spark, tmp_path):
    put(tmp_path, "raw/good.fits", exposure())
    put(tmp_path, "raw/cut.fits", exposure()[:-2880])
    put(tmp_path, "raw/tail.fits", exposure() + b"x" * 100)
    compressed = exposure(1).replace(b"XTENSION= 'IMAGE   '", b"XTENSION= 'BINTABLE'")
    put(tmp_path, "raw/packed.fits", compressed)
    found = files.read_files(spark, str(tmp_path))
    problems = {r.file_path: r.reason for r in fits.file_problems(found).collect()}
    assert set(problems) == {"raw/cut.fits", "raw/tail.fits", "raw/packed.fits"}
    assert "100 bytes" in problems["raw/tail.fits"] and "BINTABLE" in problems["raw/packed.fits"]
    lines = fits.image_lines(found, strict=False).select("exposure_id").distinct().collect()
    assert {r.exposure_id for r in lines} == {"raw/good.fits", "raw/tail.fits"}
    with pytest.raises(PySparkException, match="cut.fits"):
        fits.image_lines(found.filter("file_path like '%cut%'")).collect()


def test_unreadable_values_are_reported(spark, tmp_path):
    tree, store = tmp_path / "tree", str(tmp_path / "catalog")
    put(tree, "raw/exposure_seconds=long/a.fits", exposure(ROTANGLE="steep"))
    put(tree, "raw/b.fits", exposure())
    path = B.refresh_catalog(spark, str(tree), store)
    (v,) = DQ.unreadable(spark.read.parquet(path)).collect()
    assert v.key.endswith("a.fits") and "ROTANGLE=steep" in v.detail and "exposure_seconds=long" in v.detail
    with pytest.raises(ValueError, match="rule type"):
        B.refresh_catalog(spark, str(tree), str(tmp_path / "strict"), strict=True)


def test_tables_are_one_entry_and_the_newest(spark, tmp_path):
    tree, store = tmp_path / "tree", str(tmp_path / "catalog")
    put(tree, "raw/a.fits", exposure())
    put(tmp_path / "landing", "wx.2024.dat", "2024 1 1 0 0 7 10 1.5 20 600\n")
    for speed in (7, 8):
        put(tmp_path / "landing", "wx.2024.dat", f"2024 1 1 0 0 {speed} 10 1.5 20 600\n")
        newest = weather.refresh_weather(spark, str(tmp_path / "landing"), f"{tree}/misc/weather", now=NOW)
    put(tree, "misc/weather/snapshot-0000000009-x/type=WEATHER/station=CFHT/part.parquet", "unpublished")
    B.refresh_catalog(spark, str(tree), store)
    catalog = B.current_catalog(spark, store)
    (row,) = M.first_match(schemas.WEATHER, catalog.filter("type = 'OBJECT'"), catalog).collect()
    assert row.n_matches == 1 and newest.endswith(row.match_path.split("/")[2])
    assert spark.read.parquet(f"{tree}/{row.match_path}").first().wind_speed == 8

    import gzip

    put(tree, "raw/logs/type=RAW_LOGS/l.gz", gzip.compress(b"SNIFS_on 1 2 B ==>Tue Jan  2 03:04:05 UTC 2024 \nSNIFS_on 1 2 B ==>never \n"))
    B.refresh_catalog(spark, str(tree), store)
    for _ in range(2):
        runlogs.extract_run_logs(spark, str(tree), store, B.current_catalog(spark, store))
    B.refresh_catalog(spark, str(tree), store)
    (entry,) = B.current_catalog(spark, store).filter("type = 'CCD_ON_TIMES'").collect()
    events = spark.read.parquet(f"{tree}/{entry.file_path}")
    assert events.count() == 2 and DQ.event_violations(events).count() == 1
    with pytest.raises(ValueError, match="rule time"):
        runlogs.extract_run_logs(spark, str(tree), store, B.current_catalog(spark, store), strict=True)


def test_writers_do_not_share_a_snapshot_and_old_ones_go(spark, tmp_path):
    root = str(tmp_path / "t")
    assert sinks.next_snapshot(spark, root) != sinks.next_snapshot(spark, root)
    rows = C.conform(spark.createDataFrame([("a/b",)], "file_path string"))
    paths = [sinks.write_catalog(rows, root) for _ in range(4)]
    assert len(sinks.drop_old_snapshots(spark, root, keep=2)) == 2
    assert sinks.published_snapshots(spark, root) == paths[2:]


def model(channel):
    return json.dumps({"model_version": 1, "parameters": [[0.01 * k for k in range(9)]] * 2})


def test_files_to_corrected_lines(spark, tmp_path):
    tree, store, out = tmp_path / "tree", str(tmp_path / "catalog"), str(tmp_path / "out")
    put(tree, "raw/two.fits", exposure())
    put(tree, "raw/two_r.fits", exposure(channel="R"))
    whole = np.concatenate(PIXELS, axis=1)
    one = {
        "DATASEC0": "[1:24,1:20]", "BIASSEC0": "[25:30,1:18]", "DATASEC1": "[1:24,21:40]", "BIASSEC1": "[25:30,21:38]",
        "CCDNAMP": 2, "SATURATE": 60000.0,
    }
    put(tree, "raw/one.fits", fits_file([image(np.array(whole), **one)], OBSTYPE="OBJECT", CHANNEL="R", RUNID="r1"))
    put(tree, "raw/four.fits", exposure(4))
    put(tree, "raw/unmodelled.fits", exposure(channel="X"))
    for c in ("B", "R"):
        put(tree, f"models/type=BINARY_OFFSET_MODEL/channel={c}/m.json", model(c))
    B.refresh_catalog(spark, str(tree), store)
    run = exposures.preprocess_files(spark, str(tree), store, out, axis="x")
    corrected = spark.read.parquet(run.corrected)
    done = {r.exposure_id for r in corrected.select("exposure_id").distinct().collect()}
    assert {"raw/two.fits", "raw/two_r.fits"} <= done and not done & {"raw/four.fits", "raw/unmodelled.fits"}
    rules = {(r.key, r.rule) for r in spark.read.parquet(run.violations).collect()}
    assert {("raw/four.fits", "two_images"), ("raw/unmodelled.fits", "model")} <= rules
    done_steps = spark.read.parquet(run.provenance).filter("key = 'OVSCDONE'").select("exposure_id").distinct()
    assert {r.exposure_id for r in done_steps.collect()} == done
    # the same pixels as from lines in memory
    found = files.read_files(spark, str(tree)).filter("file_path = 'raw/two.fits'")
    models = spark.createDataFrame([("B", [[0.01 * k for k in range(9)]] * 2)], "channel string, parameters array<array<double>>")
    want = P.corrected_lines(P.preprocess(fits.image_lines(found, integer=True), models))
    key = lambda rows: sorted((r.amp, r.x, tuple(np.round(r.value, 9))) for r in rows)
    assert key(corrected.filter("exposure_id = 'raw/two.fits'").collect()) == key(want.collect())
    again = exposures.preprocess_files(spark, str(tree), store, out, axis="x")
    assert again.corrected is None
    with pytest.raises((ValueError, PySparkException)):
        exposures.preprocess_files(spark, str(tree), store, str(tmp_path / "strict"), axis="x", strict=True)


def test_no_pixel_row_is_sorted(spark, sf):
    from nightframe.registry import detector as R
    from nightframe.registry import views as V

    plan = P.preprocess_images(V.lines(spark, sf), R._models(spark))._jdf.queryExecution().executedPlan().toString()
    top = plan[: plan.index("Generate posexplode")]
    assert "Sort" not in top and "Window" not in top


def test_header_facts_decode_once(spark, tmp_path):
    put(tmp_path, "raw/a.fits", exposure())
    found = files.read_files(spark, str(tmp_path))
    plan = B.entries_of(found, NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    split = L.split_lines(fits.image_lines(found, integer=True))
    assert split._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1


def test_percentiles_of_one_bucket(spark):
    df = spark.range(10_000).select(F.lit("g").alias("g"), (F.lit(1000.0) + F.col("id") * 1e-7).alias("v"))
    (row,) = percentiles.exact_percentiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()
    assert np.allclose(row.percentiles, [1000.0, 1000.0 + 4999.5e-7, 1000.0 + 9999e-7], rtol=0, atol=1e-9)


def test_defaults_of_optional_flags_and_text(spark):
    images = spark.createDataFrame([(1, 0)], "exposure_id int, image_no int")
    none = spark.createDataFrame([], "exposure_id int, image_no int, key string, vtype string, value_str string, value_double double, value_bool boolean")
    assert H.get(images, none, "K", "bool", default=True).first()["value"] is True
    assert H.get(images, none, "K", "str", default="x").first()["value"] == "x"
    with pytest.raises(PySparkException, match="not available"):
        H.get(images, none, "K", "str", default="x", required=True).collect()


def test_rule_with_a_function(spark):
    rule = M.registry.register(
        M.MatchRule("DARK_TEST", pairs=lambda p, c: p.alias("p").join(c.alias("c"), F.col("c.run_id") < F.col("p.run_id")).select(
            F.col("p.file_path").alias("file_path"), F.col("c.file_path").alias("match_path")))
    )
    try:
        rows = [("p", "OBJECT", "5"), ("q", "OBJECT", "1"), ("d1", "DARK_TEST", "2"), ("d2", "DARK_TEST", "4"), ("d3", "DARK_TEST", "6")]
        catalog = spark.createDataFrame(rows, "file_path string, type string, run_id string")
        got = M.first_match("DARK_TEST", catalog.filter("type = 'OBJECT'"), catalog).collect()
        assert {(r.file_path, r.n_matches, r.match_path) for r in got} == {("p", 2, "d1"), ("q", 0, None)}
    finally:
        del M.registry._rules[rule.file_type]


def test_line_level_amplitudes_of_short_lines(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0, 2.0, 3.0, 5.0, 7.0],)], "a array<double>")
    got = [r["f"] for r in df.select(D._blind_cells_filled(F.col("a")).alias("f")).collect()]
    assert got == [[None, None], [6.0, 6.0, 6.0, 5.0, 7.0]]
