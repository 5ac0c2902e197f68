"""Pre-process files of the catalogue from end to end."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.operators import lines as L
from nightframe.operators import match as M
from nightframe.operators import overscan as O
from nightframe.operators import quality as DQ
from nightframe.plans import preprocess as P
from nightframe.plans.build_catalog import current_catalog
from nightframe.sources import files, fits, models, sinks


@dataclass(frozen=True)
class Run:
    """Snapshots that a run wrote; None for all but the violations if there was nothing to do."""

    lines: str | None
    corrected: str | None
    provenance: str | None
    violations: str | None


def corrected_of(spark: SparkSession, out_root: str) -> DataFrame | None:
    """Corrected lines of all runs; each run's snapshot has the exposures that were new to it."""
    found = sinks.published_snapshots(spark, f"{out_root.rstrip('/')}/corrected")
    return spark.read.parquet(*found) if found else None


def _written(rows: DataFrame, root: str) -> str:
    path = sinks.next_snapshot(rows.sparkSession, root)
    rows.write.mode("overwrite").parquet(path)
    return sinks.publish(rows.sparkSession, path)


def preprocess_files(
    spark: SparkSession,
    data_root: str,
    catalog_root: str,
    out_root: str,
    primaries: DataFrame | None = None,
    axis: str = "y",
    strict: bool = False,
) -> Run:
    """Catalogue to corrected lines and provenance, for the given primaries or all science and continuum files.

    Exposures that an earlier run corrected are skipped. The files of the others are decoded once, one-image
    files are split, and the raw lines are stored; everything after that reads the stored lines, pruned. The model
    of each channel is the catalogue's first one. Broken files and exposures that can't be
    pre-processed are written as violations; with ``strict`` they fail the run.
    """
    out = out_root.rstrip("/")
    catalog = current_catalog(spark, catalog_root)
    if catalog is None:
        raise FileNotFoundError(f"no catalogue in {catalog_root}")
    wanted = catalog.filter(F.col("type").isin(schemas.SCIENCE, schemas.CONTINUUM)) if primaries is None else primaries
    done = corrected_of(spark, out)
    if done is not None:
        known = done.select(F.col("exposure_id").alias("file_path")).distinct()
        wanted = wanted.join(known, "file_path", "left_anti")
    found = files.read_selected(spark, data_root, wanted.select("file_path").distinct())
    broken = fits.file_problems(found).select(
        F.lit("file").alias("rule"), F.col("file_path").alias("key"), F.concat_ws(": ", "hdu", "reason").alias("detail")
    )
    if strict:
        DQ.require_clean(broken)
    raw = sinks.write_lines(L.split_lines(fits.image_lines(found, integer=True, strict=strict), axis), f"{out}/lines")
    lines = spark.read.parquet(raw)
    texts = files.read_selected(spark, data_root, M.members(schemas.BINARY_OFFSET_MODEL, catalog).withColumnRenamed("match_path", "file_path"))
    parsed = models.parse_models(texts.select("file_path", F.decode("content", "UTF-8").alias("value")))
    by_channel = M.models_of_exposures(P.exposures_of(lines), catalog, parsed.filter("valid"))
    good, violations = P.usable_lines(lines, by_channel, strict)
    listed = _written(broken.unionByName(violations), f"{out}/violations")
    if good.isEmpty():
        return Run(raw, None, None, listed)
    pixels = P.preprocess(good, by_channel)
    corrected = sinks.write_lines(P.corrected_lines(pixels), f"{out}/corrected")
    obstypes = good.select("exposure_id", "amp", "obstype").distinct()
    kept = O.provenance(P.overscan_models(good, by_channel), obstypes)
    return Run(raw, corrected, _written(kept, f"{out}/provenance"), listed)
