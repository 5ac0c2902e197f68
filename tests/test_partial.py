"""Queries on detector images of which the table lacks lines."""

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from fixtures import fits_file, image
from pyspark.sql import functions as F

import __spark_entry__ as entry
import check
from nightframe.plans import preprocess as P
from nightframe.registry import views as V
from nightframe.registry.detector import _models
from nightframe.sources import fits


def partial_tables(folder, sf, kept):
    """The rows of ``embeddings`` that ``kept`` says."""
    rows = pq.read_table(f"{sf}/embeddings.parquet")
    pq.write_table(rows.filter([bool(kept(v)) for v in rows["vec_id"].to_pylist()]), folder / "embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{folder}/embeddings.parquet'")
    return str(folder), con


@pytest.fixture(scope="module")
def ragged(tmp_path_factory, sf):
    """Exposure 0 is whole; 1 has gaps in both images, 2 a single line, 3 three lines each, 4 lacks all bias lines but one."""
    kept = {0: range(50), 1: [*range(6), *range(9, 33), *range(40, 50)], 2: [0], 3: range(6), 4: range(42)}
    return partial_tables(tmp_path_factory.mktemp("ragged"), sf, lambda v: v % 50 in kept.get(v // 50, ()))


@pytest.fixture(scope="module")
def paired(tmp_path_factory, sf):
    """As above, with both images of each line."""
    kept = {0: range(50), 1: [*range(6), *range(10, 32), *range(40, 50)], 2: range(2), 3: range(34), 4: range(42)}
    return partial_tables(tmp_path_factory.mktemp("paired"), sf, lambda v: v % 50 in kept.get(v // 50, ()))


@pytest.mark.parametrize(
    "name",
    ["fits_catalog", "fits_data_headers", "fits_headers", "catalog_job", "fits_images", "fits_one_hdu", "fits_lines", "fits_one_header", "tree_headers", "tree_changes"],
)
def test_files_of_partial_images(spark, ragged, name):
    verdict = check.compare(spark, ragged[1], ragged[0], name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


@pytest.mark.parametrize(
    "name", ["preprocess_exposure", "preprocess_chip", "preprocess_files", "preprocess_resumed", "stage_delta", "stage_percentiles", "stage_zoom"]
)
def test_images_without_bias_lines(spark, paired, name):
    verdict = check.compare(spark, paired[1], paired[0], name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_images_without_bias_lines_are_violations(spark, paired):
    lines, models = V.lines(spark, paired[0]), _models(spark)
    good, violations = P.usable_lines(lines, models)
    assert {(r.rule, r.key, r.detail) for r in violations.collect()} == {("bias_section", k, "no lines") for k in "23"}
    assert {r[0] for r in P.preprocess_images(good, models).select("exposure_id").distinct().collect()} == {0, 1, 4}


def test_blank_cells_are_null_and_blank_lines_absent(spark):
    pixels = np.arange(12).reshape(4, 3) + 1000
    pixels[1], pixels[2, 0] = 77, 77
    rows = [("a", bytearray(fits_file([image(pixels, BLANK=77 - 32768)]))), ("b", bytearray(fits_file([image(pixels)])))]
    for integer in (True, False):
        lines = fits.image_lines(spark.createDataFrame(rows, "file_path string, content binary"), integer=integer)
        got = {(r.exposure_id, r.x): r.data for r in lines.collect()}
        assert sorted(x for path, x in got if path == "a") == [0, 2, 3]
        assert got["a", 2] == [None, 1007, 1008] and got["a", 0] == [1000, 1001, 1002]
        assert got["b", 1] == [77, 77, 77] and got["b", 2] == [77, 1007, 1008]


def test_partial_file_keeps_its_extent(spark, ragged):
    cards = fits.header_rows(V.image_files(spark, ragged[0])).filter("hdu > 0")
    whole = F.col("file_path").endswith("exposure_0.fits")
    assert cards.filter(whole & (F.col("key") == "BLANK")).count() == 0
    assert cards.filter(~whole & (F.col("key") == "BLANK")).count() == 8
