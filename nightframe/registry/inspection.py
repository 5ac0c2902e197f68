"""Queries on the stages of a run."""

from __future__ import annotations

from pyspark.sql import functions as F

from nightframe.operators import stages as S
from nightframe.plans.inspect import stage_table
from nightframe.registry import detector as R
from nightframe.registry import views as V
from nightframe.registry.detector import _CHAIN, _q, r4

ZOOM = dict(start=(4, 8), size=(10, 16))


def _stages(spark, sf):
    return stage_table(V.lines(spark, sf), R._models(spark), without_bias="drop")


def _rounded(rows):
    return rows.withColumns({c: r4(c) for c in ("value", "variance", "value_delta", "variance_delta")})


def stage_delta(spark, sf):
    return _rounded(_stages(spark, sf))


def stage_zoom(spark, sf):
    return _rounded(S.zoom(_stages(spark, sf), **ZOOM))


def stage_percentiles(spark, sf):
    """Stretch limits of the full frame and of the zoom."""
    limits = S.stretch_limits(_stages(spark, sf), **ZOOM)
    return limits.withColumns({"low": r4("low"), "high": r4("high")})


QUERIES = {f.__name__: f for f in (stage_delta, stage_zoom, stage_percentiles)}

_STAGES = """
per_pixel AS (
  SELECT b.exposure_id, b.amp, b.x, b.y, CAST(b.raw AS DOUBLE) AS v0, b.value AS v2, e.value AS v3,
         e.value - (e.x * r.multiplier + r."offset") AS v5, CAST(b.raw AS DOUBLE) AS w0,
         CASE WHEN k.saturated THEN NULL ELSE CAST(b.raw AS DOUBLE) END AS w1, n.v AS noise
  FROM bit_corrected b
  JOIN masked k USING (exposure_id, amp, x, y)
  JOIN even_odd e USING (exposure_id, amp, x, y)
  JOIN noise n USING (exposure_id, amp)
  JOIN ramp r USING (exposure_id, amp, y)
),
stages AS (
  SELECT exposure_id, amp, x, y, 0 AS stage_no, 'initial' AS stage, v0 AS value, w0 AS variance, 0.0 AS value_delta, 0.0 AS variance_delta FROM per_pixel
  UNION ALL SELECT exposure_id, amp, x, y, 1, 'saturation', v0, w1, 0.0, w1 - w0 FROM per_pixel
  UNION ALL SELECT exposure_id, amp, x, y, 2, 'bit_offset', v2, w1, v2 - v0, w1 - w1 FROM per_pixel
  UNION ALL SELECT exposure_id, amp, x, y, 3, 'even_odd', v3, w1, v3 - v2, w1 - w1 FROM per_pixel
  UNION ALL SELECT exposure_id, amp, x, y, 4, 'overscan_variance', v3, w1 + noise, 0.0, w1 + noise - w1 FROM per_pixel
  UNION ALL SELECT exposure_id, amp, x, y, 5, 'overscan_offset', v5, w1 + noise, v5 - v3, w1 - w1 FROM per_pixel
)"""
_SHOWN = """SELECT exposure_id, amp, x, y, stage_no, stage, round(value, 4) + 0.0 AS value, round(variance, 4) + 0.0 AS variance,
  round(value_delta, 4) + 0.0 AS value_delta, round(variance_delta, 4) + 0.0 AS variance_delta FROM stages"""
_ZOOMED = "x >= 4 AND x < 14 AND y >= 8 AND y < 24"

ORACLE = {
    "stage_delta": _q(*_CHAIN[:-1], _STAGES, select=_SHOWN),
    "stage_zoom": _q(*_CHAIN[:-1], _STAGES, select=f"{_SHOWN} WHERE {_ZOOMED}"),
    "stage_percentiles": _q(
        *_CHAIN[:-1], _STAGES,
        f"""numbers AS (
  SELECT exposure_id, frame, n FROM (
    SELECT exposure_id, x, y, value AS n FROM stages WHERE amp = 0
    UNION ALL SELECT exposure_id, x, y, variance FROM stages WHERE amp = 0), (VALUES ('full'), ('zoom')) AS t(frame)
  WHERE n IS NOT NULL AND (frame = 'full' OR ({_ZOOMED})))""",
        select="""SELECT exposure_id, frame, round(quantile_cont(n, 0.01), 4) + 0.0 AS low, round(quantile_cont(n, 0.99), 4) + 0.0 AS high
FROM numbers GROUP BY ALL""",
    ),
}
