"""Overscan statistics.

All of them come from one aggregation of the bias pixels per ``(exposure, amp, y)``: the
*profile*. The even-odd fit, the overscan variance *after* the even-odd correction and the
ramp medians are then arithmetic on the profile, so the bias section is read once instead
of once per step, and partial aggregation shrinks it before the exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe.functions import sections as S
from nightframe.functions import series
from nightframe.operators import lines as L

IMAGE_KEYS = ("exposure_id", "amp")
HALF_WINDOW = 5  # cells on either side in the running median


def bias_pixels(pixels: DataFrame) -> DataFrame:
    """Bias-section pixels with section-relative coordinates ``sx``, ``sy``.

    Needs ``(exposure_id, amp, x, y, value, bias, x_extent)`` with ``bias`` the parsed section.
    """
    s, x, y = F.col("bias"), F.col("x"), F.col("y")
    return pixels.filter(S.inside(s, x, y)).select(
        *IMAGE_KEYS,
        x,
        y,
        F.col("value").cast("double").alias("value"),
        S.section_x(s, x).alias("sx"),
        S.section_y(s, y).alias("sy"),
        (s["x_max"] - s["x_min"]).alias("width"),
        "x_extent",
    )


def bias_lines(lines: DataFrame) -> DataFrame:
    """The lines that hold bias pixels of any image of the exposure.

    On stored lines the filter reaches the scan; above the decoder of image files it can't.
    """
    return lines.filter((F.col("x") >= F.col("bias_lo")) & (F.col("x") < F.col("bias_hi")))


def bias_pixels_of_lines(lines: DataFrame) -> DataFrame:
    """Bias pixels straight from lines: other lines are dropped before the explode."""
    kept = bias_lines(lines).withColumn("bias", S.parse_section(F.col("biassec")))
    columns = ["exposure_id", "amp", "x", "bias", "x_extent"]
    return bias_pixels(kept.select(*columns, F.posexplode("data").alias("y", "value")))


def bias_profile(bias: DataFrame) -> DataFrame:
    """Per section line: moments of the even and the odd x, and the mean pair difference.

    Pairs are (0,1), (2,3), … in section-relative x; a last cell without partner is left out.
    Moments are split by image-absolute parity because that is what the correction uses.
    """
    value, even = F.col("value"), F.col("x") % 2 == 0
    pairs = F.floor(F.col("width") / 2).cast("int")
    in_pair = F.col("sx") < pairs * 2
    signed = F.when(in_pair, F.when(F.col("sx") % 2 == 0, value).otherwise(-value))
    return bias.groupBy(*IMAGE_KEYS, "sy").agg(
        F.max("y").alias("y"),
        F.max("x_extent").alias("x_extent"),
        F.count(F.when(even, value)).cast("double").alias("n_even"),
        F.avg(F.when(even, value)).alias("mean_even"),
        F.var_pop(F.when(even, value)).alias("var_even"),
        F.count(F.when(~even, value)).cast("double").alias("n_odd"),
        F.avg(F.when(~even, value)).alias("mean_odd"),
        F.var_pop(F.when(~even, value)).alias("var_odd"),
        (F.sum(signed) / F.max(pairs)).alias("pair_difference"),
    )


def even_odd_fit(profile: DataFrame) -> DataFrame:
    """Least-squares line of the pair difference against section-relative y."""
    d, y = F.col("pair_difference"), F.col("sy").cast("double")
    return profile.groupBy(*IMAGE_KEYS).agg(
        F.regr_slope(d, y).alias("slope"), F.regr_intercept(d, y).alias("intercept")
    )


def half_amplitude(slope: Column, intercept: Column, y: Column) -> Column:
    return F.lit(0.5) * (intercept + slope * y)


def overscan_model(
    profile: DataFrame,
    apply_even_odd: bool = True,
    done: DataFrame | None = None,
    half_window: int = HALF_WINDOW,
) -> DataFrame:
    """One row per image with everything the overscan steps need.

    ``done`` optionally says which steps an image has already had: ``(exposure_id, amp,
    even_odd_done, variance_done, offset_done)``. With ``apply_even_odd=False`` variance and
    ramp are those of the values as they are.
    """
    cell = F.struct(
        "sy", "y", "n_even", "mean_even", "var_even", "n_odd", "mean_odd", "var_odd"
    )
    d, sy = F.col("pair_difference"), F.col("sy").cast("double")
    m = profile.groupBy(*IMAGE_KEYS).agg(
        F.array_sort(F.collect_list(cell)).alias("_cells"),
        F.regr_slope(d, sy).alias("slope"),
        F.regr_intercept(d, sy).alias("intercept"),
        F.max("x_extent").alias("x_extent"),
    )
    if done is not None:
        m = m.join(done, list(IMAGE_KEYS), "left")
        for flag in ("even_odd_done", "variance_done", "offset_done"):
            m = m.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
    else:
        m = m.withColumns({f: F.lit(False) for f in ("even_odd_done", "variance_done", "offset_done")})
    active = F.lit(apply_even_odd) & ~F.col("even_odd_done")
    m = m.withColumns(
        {
            "_slope": F.when(active, F.col("slope")).otherwise(0.0),
            "_intercept": F.when(active, F.col("intercept")).otherwise(0.0),
        }
    )

    def corrected(c: Column) -> Column:
        half = half_amplitude(F.col("_slope"), F.col("_intercept"), c["y"])
        zero = F.lit(0.0)

        def part(parity: str, mean: Column) -> Column:
            return F.struct(
                c[f"n_{parity}"].alias("n"),
                F.coalesce(mean, zero).alias("mean"),
                F.coalesce(c[f"var_{parity}"], zero).alias("var"),
            )

        return F.array(part("even", c["mean_even"] - half), part("odd", c["mean_odd"] + half))

    def mean_of(parts: Column) -> Column:
        e, o = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        return (e["n"] * e["mean"] + o["n"] * o["mean"]) / (e["n"] + o["n"])

    m = m.withColumn("_parts", F.transform("_cells", corrected)).drop("_cells")
    m = m.withColumns(
        {
            "line_mean": F.transform("_parts", mean_of),
            "overscan_variance": series.pooled_variance(F.flatten("_parts")),
        }
    )
    m = m.withColumn("line_median", series.running_median(F.col("line_mean"), half_window))
    medians = F.col("line_median")
    extent = F.col("x_extent").cast("double")
    # Centre line of the ramp, one image further on.
    centre = F.floor(extent / 2) + 1 + extent
    before = series.shifted(medians, 1)
    m = m.withColumns(
        {
            "multiplier": F.zip_with(
                medians, before, lambda now, was: F.coalesce((now - was) / extent, F.lit(0.0))
            ),
            "offset": F.zip_with(
                medians,
                before,
                lambda now, was: F.when(was.isNull(), now).otherwise(
                    (now - was) * (extent - centre) / extent + was
                ),
            ),
        }
    )
    return m.select(
        *IMAGE_KEYS,
        "x_extent",
        "slope",
        "intercept",
        "overscan_variance",
        F.sqrt("overscan_variance").alias("read_noise"),
        "line_mean",
        "line_median",
        series.middle(medians).alias("overscan_median"),
        "multiplier",
        "offset",
        "even_odd_done",
        "variance_done",
        "offset_done",
    )


PIXEL_FIELDS = (
    "slope", "intercept", "overscan_variance", "multiplier", "offset", "even_odd_done", "variance_done", "offset_done",
)


def model_per_exposure(model: DataFrame) -> DataFrame:
    """Fold the two images' models into one row per exposure: ``model0``, ``model1``.

    Only the fields that pixels need: the row is repeated for each block of lines.
    """
    fields = [c for c in PIXEL_FIELDS if c in model.columns]
    return model.groupBy("exposure_id").agg(
        *[
            F.first(F.when(F.col("amp") == amp, F.struct(*fields)), ignorenulls=True).alias(f"model{amp}")
            for amp in L.AMPS
        ]
    )


def ramp(multiplier: Column, offset: Column, last_offset: Column, x: Column) -> Column:
    """Ramp value of one pixel; beyond the bias section slope 0 and the last offset hold."""
    return x * F.coalesce(multiplier, F.lit(0.0)) + F.coalesce(offset, last_offset)


def ramp_table(model: DataFrame, y_extent: DataFrame) -> DataFrame:
    """The ramp of every image padded to its full y length, one row per y.

    ``y_extent`` has ``(exposure_id, amp, y_extent)``.
    """
    last = F.element_at("offset", -1)
    padded = model.join(y_extent, list(IMAGE_KEYS)).select(
        *IMAGE_KEYS, "multiplier", "offset", last.alias("_last"),
        F.explode(F.sequence(F.lit(0), F.col("y_extent") - 1)).alias("y"),
    )
    return padded.select(
        *IMAGE_KEYS,
        "y",
        F.coalesce(F.get("multiplier", F.col("y")), F.lit(0.0)).alias("multiplier"),
        F.coalesce(F.get("offset", F.col("y")), F.col("_last")).alias("offset"),
    )


def provenance(model: DataFrame, obstypes: DataFrame | None = None) -> DataFrame:
    """What was done to each image, as ``(exposure_id, amp, key, position, value)``.

    ``obstypes`` optionally has ``(exposure_id, amp, obstype)``; an image of type BIAS gets
    no ``BIASFRAM`` row.
    """
    m = model
    if obstypes is not None:
        m = m.join(obstypes, list(IMAGE_KEYS), "left")
    else:
        m = m.withColumn("obstype", F.lit(None).cast("string"))

    def entry(key: str, value: Column, position: int = 0) -> Column:
        return F.struct(
            F.lit(key).alias("key"), F.lit(position).alias("position"), value.cast("double").alias("value")
        )

    one = F.lit(1.0)
    # fixed values: header keys of the steps
    entries = F.array(
        entry("OEPARAM", F.col("slope"), 0),
        entry("OEPARAM", F.col("intercept"), 1),
        entry("RDNOISE", F.col("read_noise")),
        entry("OVSCNOIS", one),
        entry("BIASFRAM", F.when(F.coalesce(F.col("obstype"), F.lit("")) != "BIAS", one)),
        entry("OVSCMED", F.col("overscan_median")),
        entry("OVSCDONE", one),
    )
    rows = m.select(*IMAGE_KEYS, F.inline(entries))
    return rows.filter(F.col("value").isNotNull())


def steps_done(provenance_rows: DataFrame) -> DataFrame:
    """Which overscan steps each image has already had, from its provenance rows."""
    key, value = F.col("key"), F.col("value")
    return provenance_rows.groupBy(*IMAGE_KEYS).agg(
        F.bool_or(key == "OEPARAM").alias("even_odd_done"),
        F.bool_or((key == "OVSCNOIS") & (value != 0)).alias("variance_done"),
        F.bool_or((key == "OVSCDONE") & (value != 0)).alias("offset_done"),
    )
