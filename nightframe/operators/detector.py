"""Detector corrections on paired pixels.

``correction_terms`` explodes the lines of paired images once and computes, per pixel, every term the
correction steps need. All neighbour access is by shifted copies of the line made before the
explode, and the bit-offset amplitudes and their row mean are computed on the line too, so no pixel row
is ever sorted or shuffled.

A step then only combines a pixel's value, variance and terms; the key columns lift it to
every image at once. ``run_steps`` chains steps, optionally keeping every result.

The cells and line scalars are made non-null before the arithmetic. That halves the generated
code, which must stay below the size the JVM is willing to compile.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe.functions import bits, series
from nightframe.operators import lines as L
from nightframe.operators import overscan as O

SATURATION_LEVEL = 65535.0  # fixed value: level of an image whose header gives none
BLIND_CELLS = 3  # the first cells of a line have no drivers; they get the row mean


def is_saturated(value: Column, before: Column, after: Column, level: Column) -> Column:
    """Saturated, or next to a saturated reading along y (charge bleeds up a column)."""
    level = F.coalesce(level, F.lit(SATURATION_LEVEL))
    none = F.lit(False)
    return (
        F.coalesce(value > level, none)
        | F.coalesce(before > level, none)
        | F.coalesce(after > level, none)
    )


def valid_model(parameters: Column) -> Column:
    """A bit-offset model has two parameter lists of nine."""
    sizes = F.forall(parameters, lambda p: F.size(p) == bits.PARAMETERS_PER_IMAGE)
    return (F.size(parameters) == 2) & sizes


def saturation_pixels(lines: DataFrame) -> DataFrame:
    """Poisson variance with saturated pixels at +inf, for any number of images.

    Result: ``(exposure_id, amp, x, y, value, saturated, variance)``. Narrow: no exchange.
    """
    zipped = F.arrays_zip(
        F.col("data"),
        series.shifted(F.col("data"), 1).alias("before"),
        series.shifted(F.col("data"), -1).alias("after"),
    )
    p = lines.select("exposure_id", "amp", "x", "saturate", F.posexplode(zipped).alias("y", "_p"))
    value = F.col("_p.data").cast("double")
    hit = is_saturated(F.col("_p.data"), F.col("_p.before"), F.col("_p.after"), F.col("saturate"))
    return p.select(
        "exposure_id",
        "amp",
        "x",
        "y",
        value.alias("value"),
        hit.alias("saturated"),
        F.when(hit, F.lit(float("inf"))).otherwise(value).alias("variance"),
    )


def with_parameters(paired: DataFrame, strict: bool = True) -> DataFrame:
    """Split column ``parameters`` of paired lines into ``parameters0``/``parameters1``.

    With ``strict`` an exposure without a valid model fails the query; otherwise it is left
    uncorrected.
    """
    model = F.col("parameters")
    usable = F.coalesce(valid_model(model), F.lit(False))
    if strict:
        message = F.concat(
            F.lit("no valid BINARY_OFFSET_MODEL for exposure "), F.col("exposure_id").cast("string")
        )
        fallback = F.raise_error(message).cast("array<array<double>>")
    else:
        zeros = F.array_repeat(F.lit(0.0), bits.PARAMETERS_PER_IMAGE)
        fallback = F.array(zeros, zeros)
    p = paired.withColumn("parameters", F.when(usable, model).otherwise(fallback))
    return p.withColumns(
        {f"parameters{amp}": F.get("parameters", F.lit(amp)) for amp in L.AMPS}
    ).drop("parameters")


def correction_terms(
    paired: DataFrame,
    bit_offset: bool = True,
    saturation: bool = True,
    overscan: bool = False,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Paired lines to pixels of single images with all correction terms.

    Result: ``exposure_id, amp, x_block, x, y, x_extent, y_extent, raw`` and, as far as asked
    for, ``saturated``, ``bit_offset``, ``even_odd``, ``noise`` and ``ramp``. ``overscan``
    needs ``model0``/``model1`` of :func:`overscan.model_per_exposure`; ``carry`` names scalar
    image columns to keep.
    """
    wanted = {"parameters": bit_offset, "saturate": saturation, "model": overscan}
    per_image = (*[name for name, use in wanted.items() if use], *carry)
    shared = ("x_extent",) if "x_extent" in paired.columns else ()
    images = L.per_amplifier(paired, per_image, shared)

    data, other, zero = F.col("data"), F.col("other"), F.lit(0.0)
    # Arrays are zipped at line level, so that no array is ever an input of a pixel row.
    cells: dict[str, tuple[Column, Column | None]] = {"raw": (data, F.lit(0))}
    scalars: dict[str, Column] = {c: F.col(c) for c in (*shared, *carry)}
    scalars["y_extent"] = F.size("data")
    if saturation:
        cells["before"] = (series.shifted(data, 1), F.lit(-1))
        cells["after"] = (series.shifted(data, -1), F.lit(-1))
        scalars["level"] = F.coalesce(F.col("saturate").cast("double"), F.lit(SATURATION_LEVEL))
    if overscan:
        model, nothing = F.col("model"), F.array().cast("array<double>")
        cells["multiplier"] = (F.coalesce(model["multiplier"], nothing), None)
        cells["offset"] = (F.coalesce(model["offset"], nothing), None)
        for done, name, value in (
            ("even_odd_done", "slope", model["slope"]),
            ("even_odd_done", "intercept", model["intercept"]),
            ("variance_done", "noise", model["overscan_variance"]),
        ):
            scalars[name] = F.when(model[done], zero).otherwise(F.coalesce(value, zero))
        scalars["last_offset"] = F.coalesce(F.element_at(model["offset"], -1), zero)
        scalars["ramp_on"] = F.when(model["offset_done"], zero).otherwise(F.lit(1.0))

    keys = (*L.PAIR_KEYS, "amp")
    readings = F.array().cast("array<struct<back2:int,back3:int,other3:int>>")
    if bit_offset:
        cells["bit_offset"] = (F.col("_amplitudes"), zero)
        readings = F.arrays_zip(
            series.shifted(data, 2).alias("back2"),
            series.shifted(data, 3).alias("back3"),
            series.shifted(other, 3).alias("other3"),
        )
    # An array function with a lambda is outside whole-stage code generation. It is used here
    # to end the generated line-level code before the explode: fused with it, the pixel loop
    # would be too large for the JVM to compile.
    weights = F.col("parameters") if bit_offset else F.array().cast("array<double>")
    weights = F.transform(weights, lambda w: F.coalesce(w, zero))
    at_line = images.withColumns({"_readings": readings, "_w": weights})
    if bit_offset:
        names = [f"_p{k}" for k in range(bits.PARAMETERS_PER_IMAGE)]
        at_line = at_line.withColumns({n: F.coalesce(F.get("_w", F.lit(k)), zero) for k, n in enumerate(names)})
        at_line = at_line.withColumn("_amplitudes", _amplitudes(F.col("_readings"), [F.col(n) for n in names]))
        at_line = at_line.withColumn("_amplitudes", _blind_cells_filled(F.col("_amplitudes")))
    zipped = F.arrays_zip(*[c.alias(n) for n, (c, _) in cells.items()])
    at_line = at_line.select(*keys, *[c.alias(n) for n, c in scalars.items()], zipped.alias("_cells"))
    # The outer form, because the plain one infers a filter on the array's size, which would be
    # pushed below the zip and repeat it. The filter drops its null row and the cells that a
    # model longer than the line would add.
    exploded = at_line.select(*keys, *scalars, F.posexplode_outer("_cells").alias("y", "_c"))
    p = exploded.filter(F.col("y") < F.col("y_extent")).select(
        *keys,
        *scalars,
        "y",
        *[
            (F.col(f"_c.{n}") if fill is None else F.coalesce(F.col(f"_c.{n}"), fill)).alias(n)
            for n, (_, fill) in cells.items()
        ],
    )

    x, y = F.col("x"), F.col("y")
    terms: dict[str, Column] = {}
    if saturation:
        level = F.col("level")
        terms["saturated"] = (
            (F.col("raw") > level) | (F.col("before") > level) | (F.col("after") > level)
        )
    if bit_offset:
        terms["bit_offset"] = F.col("bit_offset")
    if overscan:
        half = O.half_amplitude(F.col("slope"), F.col("intercept"), y)
        terms["even_odd"] = F.when(x % 2 == 0, -half).otherwise(half)
        terms["noise"] = F.col("noise")
        ramp = O.ramp(F.col("multiplier"), F.col("offset"), F.col("last_offset"), x)
        terms["ramp"] = F.col("ramp_on") * ramp
    return p.select(*keys, "y", *shared, "y_extent", *carry, "raw", *[c.alias(n) for n, c in terms.items()])


def _amplitudes(readings: Column, weights: Sequence[Column]) -> Column:
    """The bit-offset amplitude of each reading of a line from those before it."""

    def parts(r: Column) -> Column:
        back = [F.coalesce(r[name], F.lit(0)) for name in ("back2", "back3", "other3")]
        return F.struct(*[c.alias(n) for n, c in bits.transition_parts(*back).items()])

    # Lambdas are interpreted, so shared parts are computed once, in a pass of their own.
    return F.transform(F.transform(readings, parts), lambda r: bits.amplitude_of_parts(r, weights))


def _blind_cells_filled(amplitudes: Column) -> Column:
    """The blind cells get the mean of the others; a line of blind cells alone has none."""
    seen = F.slice(amplitudes, BLIND_CELLS + 1, F.greatest(F.size(amplitudes) - BLIND_CELLS, F.lit(0)))
    mean = series.total(seen) / F.nullif(F.size(seen), F.lit(0))
    blind = F.array_repeat(mean, F.least(F.size(amplitudes), F.lit(BLIND_CELLS)))
    return F.concat(blind, seen)


# --------------------------------------------------------------------------- steps

Step = Callable[[DataFrame], DataFrame]


def start_images(pixels: DataFrame) -> DataFrame:
    """Value is the raw reading; its Poisson variance is the reading itself."""
    raw = F.col("raw").cast("double")
    return pixels.withColumns({"value": raw, "variance": raw})


def saturation(pixels: DataFrame) -> DataFrame:
    infinite = F.when(F.col("saturated"), F.lit(float("inf"))).otherwise(F.col("variance"))
    return pixels.withColumn("variance", infinite)


def bit_offset(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", F.col("value") - F.col("bit_offset"))


def even_odd(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", F.col("value") + F.col("even_odd"))


def overscan_variance(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("variance", F.col("variance") + F.col("noise"))


def overscan_offset(pixels: DataFrame) -> DataFrame:
    return pixels.withColumn("value", F.col("value") - F.col("ramp"))


def exposure_variance(pixels: DataFrame) -> DataFrame:
    """Add the exposure itself to its variance."""
    return pixels.withColumn("variance", F.col("variance") + F.col("value"))


# The order matters: variance starts from raw readings, the bit offset needs raw integers.
STEPS: tuple[tuple[str, Step], ...] = (
    ("saturation", saturation),
    ("bit_offset", bit_offset),
    ("even_odd", even_odd),
    ("overscan_variance", overscan_variance),
    ("overscan_offset", overscan_offset),
)
INITIAL = "initial"


def run_steps(
    pixels: DataFrame, steps: Sequence[tuple[str, Step]] = STEPS, snapshot: bool = False
) -> DataFrame:
    """Apply steps in order.

    With ``snapshot`` every stage stays in the row as columns ``value_s{k}`` and
    ``variance_s{k}`` (0 is the input), so comparing stages needs no join.
    """

    def keep(p: DataFrame, k: int) -> DataFrame:
        return p.withColumns({f"{n}_s{k}": F.col(n) for n in ("value", "variance")})

    p = keep(pixels, 0) if snapshot else pixels
    for k, (_, step) in enumerate(steps, start=1):
        p = step(p)
        if snapshot:
            p = keep(p, k)
    return p
