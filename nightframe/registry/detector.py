"""Queries on detector images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.functions import bits, sections as S
from nightframe.operators import detector as D
from nightframe.operators import lines as L
from nightframe.operators import overscan as O
from nightframe.plans import preprocess as P
from nightframe.registry import views as V
from nightframe.sources import models as M


def r4(c: Column | str) -> Column:
    """Rounded for comparison; adding zero turns -0.0 into 0.0."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c, 4) + F.lit(0.0)


def _pixels(spark: SparkSession, sf: str) -> DataFrame:
    return L.to_pixels(V.lines(spark, sf))


def _models(spark: SparkSession) -> DataFrame:
    return M.models_by_channel(M.parse_models(V.model_texts(spark)))


def _raw_profile(spark: SparkSession, sf: str) -> DataFrame:
    return O.bias_profile(O.bias_pixels_of_lines(V.lines(spark, sf)))


def _raw_model(spark: SparkSession, sf: str) -> DataFrame:
    return O.overscan_model(_raw_profile(spark, sf), apply_even_odd=False)


def bit_count(spark, sf):
    p = _pixels(spark, sf)
    return p.select("exposure_id", "amp", "x", "y", bits.set_bits(bits.unsigned(F.col("value"))).alias("bits"))


def bit_index_sum(spark, sf):
    p = _pixels(spark, sf)
    total = bits.set_bit_index_sum(bits.unsigned16(F.col("value")))
    return p.select("exposure_id", "amp", "x", "y", total.alias("index_sum"))


def bit_offset_correct(spark, sf):
    lines = V.lines(spark, sf)
    parameters = P.exposure_parameters(lines, _models(spark))
    paired = D.with_parameters(L.with_exposure(L.pair_lines(lines), parameters))
    p = D.bit_offset(D.start_images(D.correction_terms(paired, saturation=False)))
    return p.select("exposure_id", "amp", "x", "y", r4("value").alias("value"))


def saturation_mask(spark, sf):
    return D.saturation_pixels(V.lines(spark, sf)).drop("value")


def section_parse(spark, sf):
    e = V.table(spark, sf, "events")
    label = F.format_string(
        "[%d:%d,%d:%d]",
        F.col("event_id") % 40 + 1,
        F.col("user_id") % 40 + 1,
        F.col("user_id") % 64 + 1,
        F.col("event_id") % 64 + 1,
    )
    s = e.select("event_id", S.parse_section(label).alias("s"))
    return s.select("event_id", "s.*")


def section_extract(spark, sf):
    p = L.to_pixels(L.extract_section(V.lines(spark, sf), "datasec"))
    return p.select("exposure_id", "amp", "x", "y", "value")


def section_assign(spark, sf):
    """Write the negated data section back into the image."""
    lines = V.lines(spark, sf)
    new = L.extract_section(lines, "datasec").withColumn("data", F.transform("data", lambda v: -v))
    p = L.to_pixels(L.assign_section(lines, new))
    return p.select("exposure_id", "amp", "x", "y", F.col("value").cast("double").alias("value"))


def image_transpose(spark, sf):
    return L.transpose(_pixels(spark, sf).select("exposure_id", "amp", "x", "y", "value"))


def line_roundtrip(spark, sf):
    """Pixels collected back to lines; length and ends of every line."""
    p = L.as_double(_pixels(spark, sf).withColumn("variance", F.lit(0)))
    lines = L.to_lines(p)
    return lines.select(
        "exposure_id", "amp", "x",
        F.size("value").alias("cells"),
        F.element_at("value", 1).alias("first_value"),
        F.element_at("value", -1).alias("last_value"),
        F.aggregate("value", F.lit(0.0), lambda a, v: a + v).alias("total"),
    )


def pair_amplifiers(spark, sf):
    paired = L.pair_lines(V.lines(spark, sf))
    cells = F.posexplode(F.arrays_zip("data0", "data1")).alias("y", "c")
    p = paired.select("exposure_id", "x", cells)
    return p.select("exposure_id", "x", "y", F.col("c.data0").alias("v0"), F.col("c.data1").alias("v1"))


def bias_mean(spark, sf):
    m = _raw_model(spark, sf)
    return m.select("exposure_id", "amp", F.posexplode("line_mean").alias("y", "m")).select(
        "exposure_id", "amp", "y", r4("m").alias("bias_mean")
    )


def read_noise(spark, sf):
    m = _raw_model(spark, sf)
    return m.select("exposure_id", "amp", r4("overscan_variance").alias("overscan_variance"),
                    r4("read_noise").alias("read_noise"))


def pair_difference(spark, sf):
    p = _raw_profile(spark, sf)
    return p.select("exposure_id", "amp", F.col("sy").alias("y"), r4("pair_difference").alias("pair_difference"))


def even_odd_fit(spark, sf):
    f = O.even_odd_fit(_raw_profile(spark, sf))
    return f.select("exposure_id", "amp", r4("slope").alias("slope"), r4("intercept").alias("intercept"))


def _raw_overscan(spark, sf, steps, apply_even_odd=True):
    """Overscan steps on raw images, without the bit-offset correction."""
    lines = V.lines(spark, sf)
    model = O.overscan_model(O.bias_profile(O.bias_pixels_of_lines(lines)), apply_even_odd=apply_even_odd)
    calibration = P.exposures_of(lines).drop("channel").join(O.model_per_exposure(model), "exposure_id")
    paired = L.with_exposure(L.pair_lines(lines), calibration)
    terms = D.correction_terms(paired, bit_offset=False, saturation=False, overscan=True)
    return D.run_steps(D.start_images(terms), steps)


def even_odd_correct(spark, sf):
    p = _raw_overscan(spark, sf, [("even_odd", D.even_odd)])
    return p.select("exposure_id", "amp", "x", "y", r4("value").alias("value"))


def overscan_variance(spark, sf):
    p = _raw_overscan(spark, sf, [("overscan_variance", D.overscan_variance)], apply_even_odd=False)
    return p.select("exposure_id", "amp", "x", "y", r4("variance").alias("variance"))


def overscan_subtract(spark, sf):
    p = _raw_overscan(spark, sf, [("overscan_offset", D.overscan_offset)], apply_even_odd=False)
    return p.select("exposure_id", "amp", "x", "y", r4("value").alias("value"))


def exposure_variance(spark, sf):
    p = _raw_overscan(spark, sf, [("exposure_variance", D.exposure_variance)])
    return p.select("exposure_id", "amp", "x", "y", "value", "variance")


def line_median(spark, sf):
    m = _raw_model(spark, sf)
    return m.select("exposure_id", "amp", F.posexplode("line_median").alias("y", "m")).select(
        "exposure_id", "amp", "y", r4("m").alias("line_median")
    )


def overscan_median(spark, sf):
    return _raw_model(spark, sf).select("exposure_id", "amp", r4("overscan_median").alias("overscan_median"))


def ramp_offset(spark, sf):
    lines = V.lines(spark, sf)
    extent = lines.groupBy("exposure_id", "amp").agg(F.max(F.size("data")).alias("y_extent"))
    r = O.ramp_table(_raw_model(spark, sf), extent)
    return r.select("exposure_id", "amp", "y", r4("multiplier").alias("multiplier"), r4("offset").alias("offset"))


def assemble(spark, sf):
    a = L.assemble_lines(V.lines(spark, sf))
    return L.to_pixels(a)


def assemble_x(spark, sf):
    return L.to_pixels(L.assemble_lines(V.lines(spark, sf), axis="x"))


def _one_image_lines(spark, sf):
    """Both amplifiers in one image of 50 lines; amplifier 1 is stored backwards in x."""
    lines = V.lines(spark, sf)
    placed = F.when(F.col("amp") == 0, F.col("x")).otherwise(2 * V.X_EXTENT - 1 - F.col("x"))
    labels = F.array(
        F.struct(F.lit(0).alias("amp"), F.lit("[1:25,1:56]").alias("datasec"), F.lit("[1:25,57:64]").alias("biassec")),
        F.struct(F.lit(1).alias("amp"), F.lit("[50:26,1:56]").alias("datasec"), F.lit("[50:26,57:64]").alias("biassec")),
    )
    return lines.select(
        "exposure_id", F.lit(0).alias("amp"), placed.alias("x"), "data", "channel", "saturate", "obstype",
        labels.alias("image_sections"),
    )


def split_amps(spark, sf):
    p = L.to_pixels(L.split_lines(_one_image_lines(spark, sf)))
    return p.select("exposure_id", "amp", "x", "y", "value", "datasec", "biassec")


def preprocess_exposure(spark, sf):
    """Images with bias pixels; the others have nothing to take an overscan from."""
    p = P.preprocess_images(V.lines(spark, sf), _models(spark), without_bias="drop")
    return p.withColumns({"value": r4("value"), "variance": r4("variance")})


def preprocess_chip(spark, sf):
    p = P.preprocess_chips(V.lines(spark, sf), _models(spark), without_bias="drop")
    return p.withColumns({"value": r4("value"), "variance": r4("variance")})


def provenance(spark, sf):
    lines = V.lines(spark, sf)
    obstypes = lines.groupBy("exposure_id", "amp").agg(F.first("obstype").alias("obstype"))
    rows = O.provenance(P.overscan_models(lines, _models(spark)), obstypes)
    return rows.withColumn("value", r4("value"))


def preprocess_resumed(spark, sf):
    """Images that already had every overscan step: only saturation and bit offset apply, as to those without bias pixels."""
    lines = V.lines(spark, sf)
    models = _models(spark)
    done = O.provenance(P.overscan_models(lines, models))
    p = P.preprocess_images(lines, models, provenance=done, without_bias="keep")
    return p.withColumns({"value": r4("value"), "variance": r4("variance")})


QUERIES = {
    f.__name__: f
    for f in (
        bit_count, bit_index_sum, bit_offset_correct, saturation_mask, section_parse, section_extract,
        section_assign, image_transpose, line_roundtrip, pair_amplifiers, bias_mean, read_noise,
        pair_difference, even_odd_fit, even_odd_correct, overscan_variance, overscan_subtract,
        exposure_variance, line_median, overscan_median, ramp_offset, assemble, assemble_x, split_amps,
        preprocess_exposure, preprocess_chip, provenance, preprocess_resumed,
    )
}

_R = "SELECT exposure_id, amp, CAST(raw AS DOUBLE) AS value, x, y FROM pixels"
_RAW = f"raw_values AS ({_R})"


def _q(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(c.strip() for c in ctes) + "\n" + select


_CHAIN = (
    V.BIT_OFFSET_SQL,
    V.saturated_sql("bit_corrected"),
    V.even_odd_sql("bit_corrected"),
    """noise AS (SELECT exposure_id, amp, var_pop(value) AS v FROM even_odd
       WHERE x >= 20 AND x < 25 AND y < 60 GROUP BY ALL)""",
    V.ramp_sql("even_odd"),
    """corrected AS (
  SELECT e.exposure_id, e.amp, e.x, e.y,
         round(e.value - (e.x * r.multiplier + r."offset"), 4) + 0.0 AS value,
         round(CASE WHEN k.saturated THEN CAST('inf' AS DOUBLE) ELSE CAST(k.raw AS DOUBLE) END + n.v, 4) + 0.0 AS variance
  FROM even_odd e
  JOIN masked k USING (exposure_id, amp, x, y)
  JOIN noise n USING (exposure_id, amp)
  JOIN ramp r USING (exposure_id, amp, y))""",
)

ORACLE = {
    "bit_count": _q(V.LINES_SQL, select="SELECT exposure_id, amp, x, y, CAST(bit_count(raw) AS INTEGER) AS bits FROM pixels"),
    "bit_index_sum": _q(
        V.LINES_SQL,
        select=f"SELECT exposure_id, amp, x, y, CAST({V._index_sum('raw')} AS INTEGER) AS index_sum FROM pixels",
    ),
    "bit_offset_correct": _q(
        V.BIT_OFFSET_SQL, select="SELECT exposure_id, amp, x, y, round(value, 4) + 0.0 AS value FROM bit_corrected"
    ),
    "saturation_mask": _q(
        V.LINES_SQL, V.saturated_sql(),
        select="""SELECT exposure_id, amp, x, y, saturated,
  CASE WHEN saturated THEN CAST('inf' AS DOUBLE) ELSE CAST(raw AS DOUBLE) END AS variance FROM masked""",
    ),
    "section_parse": """
WITH s AS (SELECT event_id, CAST(event_id % 40 + 1 AS INTEGER) AS x1, CAST(user_id % 40 + 1 AS INTEGER) AS x2,
                  CAST(user_id % 64 + 1 AS INTEGER) AS y1, CAST(event_id % 64 + 1 AS INTEGER) AS y2 FROM events)
SELECT event_id, least(x1, x2) - 1 AS x_min, greatest(x1, x2) AS x_max, CASE WHEN x2 < x1 THEN -1 ELSE 1 END AS x_dir,
       least(y1, y2) - 1 AS y_min, greatest(y1, y2) AS y_max, CASE WHEN y2 < y1 THEN -1 ELSE 1 END AS y_dir FROM s""",
    "section_extract": _q(V.LINES_SQL, select="SELECT exposure_id, amp, x, y, raw AS value FROM pixels WHERE x < 20"),
    "section_assign": _q(
        V.LINES_SQL,
        select="SELECT exposure_id, amp, x, y, CAST(CASE WHEN x < 20 THEN -raw ELSE raw END AS DOUBLE) AS value FROM pixels",
    ),
    "image_transpose": _q(V.LINES_SQL, select="SELECT exposure_id, amp, x AS y, y AS x, raw AS value FROM pixels"),
    "line_roundtrip": _q(
        V.LINES_SQL,
        select="""SELECT exposure_id, amp, x, CAST(count(*) AS INTEGER) AS cells, CAST(arg_min(raw, y) AS DOUBLE) AS first_value,
  CAST(arg_max(raw, y) AS DOUBLE) AS last_value, CAST(sum(raw) AS DOUBLE) AS total FROM pixels GROUP BY ALL""",
    ),
    "pair_amplifiers": _q(
        V.LINES_SQL,
        select="""SELECT exposure_id, x, y, max(raw) FILTER (amp = 0) AS v0, max(raw) FILTER (amp = 1) AS v1
  FROM pixels GROUP BY ALL""",
    ),
    "bias_mean": _q(
        V.LINES_SQL, _RAW, V.ramp_sql("raw_values"),
        select="SELECT exposure_id, amp, y, round(m, 4) + 0.0 AS bias_mean FROM means",
    ),
    "read_noise": _q(
        V.LINES_SQL,
        select="""SELECT exposure_id, amp, round(var_pop(raw), 4) + 0.0 AS overscan_variance,
  round(sqrt(var_pop(raw)), 4) + 0.0 AS read_noise FROM pixels WHERE x >= 20 AND y < 60 GROUP BY ALL""",
    ),
    "pair_difference": _q(
        V.LINES_SQL, _RAW, V.even_odd_sql("raw_values"),
        select="SELECT exposure_id, amp, y, round(d, 4) + 0.0 AS pair_difference FROM pair_difference",
    ),
    "even_odd_fit": _q(
        V.LINES_SQL, _RAW, V.even_odd_sql("raw_values"),
        select="SELECT exposure_id, amp, round(slope, 4) + 0.0 AS slope, round(intercept, 4) + 0.0 AS intercept FROM fit",
    ),
    "even_odd_correct": _q(
        V.LINES_SQL, _RAW, V.even_odd_sql("raw_values"),
        select="SELECT exposure_id, amp, x, y, round(value, 4) + 0.0 AS value FROM even_odd",
    ),
    "overscan_variance": _q(
        V.LINES_SQL,
        """noise AS (SELECT exposure_id, amp, var_pop(raw) AS v FROM pixels WHERE x >= 20 AND y < 60 GROUP BY ALL)""",
        select="SELECT exposure_id, amp, x, y, round(raw + v, 4) + 0.0 AS variance FROM pixels JOIN noise USING (exposure_id, amp)",
    ),
    "overscan_subtract": _q(
        V.LINES_SQL, _RAW, V.ramp_sql("raw_values"),
        select="""SELECT exposure_id, amp, x, y, round(value - (x * multiplier + "offset"), 4) + 0.0 AS value
  FROM raw_values JOIN ramp USING (exposure_id, amp, y)""",
    ),
    "exposure_variance": _q(
        V.LINES_SQL,
        select="SELECT exposure_id, amp, x, y, CAST(raw AS DOUBLE) AS value, CAST(2 * raw AS DOUBLE) AS variance FROM pixels",
    ),
    "line_median": _q(
        V.LINES_SQL, _RAW, V.ramp_sql("raw_values"),
        select="SELECT exposure_id, amp, y, round(med, 4) + 0.0 AS line_median FROM medians",
    ),
    "overscan_median": _q(
        V.LINES_SQL, _RAW, V.ramp_sql("raw_values"),
        select="SELECT exposure_id, amp, round(quantile_cont(med, 0.5), 4) + 0.0 AS overscan_median FROM medians GROUP BY ALL",
    ),
    "ramp_offset": _q(
        V.LINES_SQL, _RAW, V.ramp_sql("raw_values"),
        select="""SELECT exposure_id, amp, CAST(y AS INTEGER) AS y, round(multiplier, 4) + 0.0 AS multiplier,
  round("offset", 4) + 0.0 AS "offset" FROM ramp""",
    ),
    "assemble": _q(
        V.LINES_SQL,
        select="SELECT exposure_id, x, CAST(y + 64 * amp AS INTEGER) AS y, raw AS value FROM pixels",
    ),
    "assemble_x": _q(
        V.LINES_SQL,
        select="SELECT exposure_id, CAST(x + 25 * amp AS INTEGER) AS x, y, raw AS value FROM pixels",
    ),
    "split_amps": _q(
        V.LINES_SQL,
        select="""SELECT exposure_id, amp, x, y, raw AS value, '[1:25,1:56]' AS datasec, '[1:25,57:64]' AS biassec FROM pixels""",
    ),
    "preprocess_exposure": _q(*_CHAIN, select="SELECT exposure_id, amp, x, y, value, variance FROM corrected"),
    "preprocess_chip": _q(
        *_CHAIN,
        select="SELECT exposure_id, x, CAST(y + 64 * amp AS INTEGER) AS y, value, variance FROM corrected",
    ),
    "provenance": _q(
        *_CHAIN,
        """medmed AS (SELECT exposure_id, amp, quantile_cont(med, 0.5) AS v FROM medians GROUP BY ALL)""",
        select="""
SELECT exposure_id, amp, key, CAST(position AS INTEGER) AS position, round(value, 4) + 0.0 AS value FROM (
  SELECT exposure_id, amp, 'OEPARAM' AS key, 0 AS position, slope AS value FROM fit
  UNION ALL SELECT exposure_id, amp, 'OEPARAM', 1, intercept FROM fit
  UNION ALL SELECT exposure_id, amp, 'RDNOISE', 0, sqrt(v) FROM noise
  UNION ALL SELECT exposure_id, amp, 'OVSCMED', 0, v FROM medmed
  UNION ALL SELECT exposure_id, amp, k, 0, 1.0 FROM noise, (VALUES ('OVSCNOIS'), ('BIASFRAM'), ('OVSCDONE')) AS t(k))""",
    ),
    "preprocess_resumed": _q(
        V.BIT_OFFSET_SQL, V.saturated_sql("bit_corrected"),
        select="""SELECT exposure_id, amp, x, y, round(value, 4) + 0.0 AS value,
  CASE WHEN saturated THEN CAST('inf' AS DOUBLE) ELSE CAST(raw AS DOUBLE) END AS variance FROM masked""",
    ),
}
