"""Looking at the stages of a run: one row per pixel and stage, with step-to-step deltas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe.operators import detector as D
from nightframe.operators import percentiles as Q

ZOOM_START = (512, 512)  # fixed values: default zoom window
ZOOM_SIZE = (100, 100)
STRETCH = (0.01, 0.99)  # fixed values: percentiles of the display stretch


def finite(c: Column) -> Column:
    """Null for nan and infinities, so that aggregates skip them."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def stage_rows(snapshots: DataFrame, steps: Sequence[tuple[str, D.Step]] = D.STEPS) -> DataFrame:
    """Snapshots of :func:`detector.run_steps` as rows.

    All stages of a pixel sit in one row, so a delta is a subtraction, not a join. The first
    stage has no predecessor and gets zero deltas.
    """
    names = [D.INITIAL, *[name for name, _ in steps]]
    stages = []
    for k, name in enumerate(names):
        fields = [F.lit(k).alias("stage_no"), F.lit(name).alias("stage")]
        for what in ("value", "variance"):
            now = finite(F.col(f"{what}_s{k}"))
            fields.append(now.alias(what))
            delta = now - finite(F.col(f"{what}_s{k - 1}")) if k else F.lit(0.0)
            fields.append(delta.alias(f"{what}_delta"))
        stages.append(F.struct(*fields))
    return snapshots.select("exposure_id", "amp", "x", "y", F.inline(F.array(*stages)))


def in_zoom(start: tuple[int, int] = ZOOM_START, size: tuple[int, int] = ZOOM_SIZE) -> Column:
    (x0, y0), (nx, ny) = start, size
    return F.col("x").between(x0, x0 + nx - 1) & F.col("y").between(y0, y0 + ny - 1)


def zoom(
    pixels: DataFrame, start: tuple[int, int] = ZOOM_START, size: tuple[int, int] = ZOOM_SIZE
) -> DataFrame:
    return pixels.filter(in_zoom(start, size))


def stretch_limits(
    stages: DataFrame,
    start: tuple[int, int] = ZOOM_START,
    size: tuple[int, int] = ZOOM_SIZE,
    probabilities: Sequence[float] = STRETCH,
    exact: bool = True,
) -> DataFrame:
    """Display limits over data and variance of all stages of amplifier 0.

    ``(exposure_id, frame, low, high)`` with frame ``full`` or ``zoom``; both in one go, so the
    stages are computed once per pass and not once per frame.
    """
    frames = F.array_compact(F.array(F.lit("full"), F.when(in_zoom(start, size), F.lit("zoom"))))
    numbers = (
        stages.filter(F.col("amp") == 0)
        .select("exposure_id", F.explode(frames).alias("frame"), "value", "variance")
        .select("exposure_id", "frame", F.explode(F.array("value", "variance")).alias("number"))
    )
    find = Q.exact_percentiles if exact else Q.approximate_percentiles
    found = find(numbers, ["exposure_id", "frame"], "number", probabilities)
    return found.select(
        "exposure_id",
        "frame",
        F.element_at("percentiles", 1).alias("low"),
        F.element_at("percentiles", -1).alias("high"),
    )
