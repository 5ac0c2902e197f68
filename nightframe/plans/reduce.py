"""Reduce exposures: resolve each primary's inputs and pre-process its images."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe.operators import match as M
from nightframe.plans.preprocess import preprocess


def reduce_science(
    primaries: DataFrame, catalog: DataFrame, lines: DataFrame, models: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Inputs of every science primary, and the corrected pixels of their exposures.

    Refresh the weather first (``plans.weather.refresh_weather``). ``primaries`` has ``exposure_id``
    beside the catalogue columns; other exposures' lines are left out before anything is shuffled.
    """
    return M.resolve_science(primaries, catalog, strict), preprocess(lines_of_primaries(lines, primaries), models)


def reduce_continuum(
    primaries: DataFrame, catalog: DataFrame, lines: DataFrame, models: DataFrame, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Inputs of every continuum primary, and the corrected pixels of their exposures."""
    return M.resolve_continuum(primaries, catalog, strict), preprocess(lines_of_primaries(lines, primaries), models)


def lines_of_primaries(lines: DataFrame, primaries: DataFrame) -> DataFrame:
    """Only the lines of the wanted exposures. The wanted ids are few beside the lines."""
    return lines.join(primaries.select("exposure_id").distinct(), "exposure_id", "left_semi")


def image_summary(pixels: DataFrame) -> DataFrame:
    """Pixel count, saturated count and mean value per exposure."""
    return pixels.groupBy("exposure_id").agg(
        F.count("*").alias("pixels"),
        F.count_if("saturated").alias("saturated"),
        F.avg("value").alias("mean_value"),
    )


def with_image_summary(inputs: DataFrame, pixels: DataFrame) -> DataFrame:
    """Inputs with their exposure's summary; the join meets one row per exposure."""
    return inputs.join(image_summary(pixels), "exposure_id", "left")
