"""Pre-process exposures: raw lines in, corrected pixels out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe.functions import sections as S
from nightframe.operators import detector as D
from nightframe.operators import lines as L
from nightframe.operators import overscan as O
from nightframe.operators import quality as DQ


def exposures_of(lines: DataFrame) -> DataFrame:
    """One row per exposure: channel and number of lines. Reads three narrow columns.

    The channel is a grouping key first because a string key keeps the aggregation hash-based. An image without
    the card has its exposure's channel; of several channels the first counts (:func:`line_violations`).
    """
    per_channel = lines.groupBy("exposure_id", "channel").agg(F.max("x_extent").alias("x_extent"))
    return per_channel.groupBy("exposure_id").agg(F.min("channel").alias("channel"), F.max("x_extent").alias("x_extent"))


def line_violations(lines: DataFrame, models: DataFrame | None = None) -> DataFrame:
    """``(rule, key, detail)`` for exposures that can't be pre-processed.

    Rules: other than two images, several channels, no bias section or an image without a line in it, and no model for the
    channel if ``models`` (``channel, parameters``) are given. One narrow aggregation of the lines.
    """
    x, low, high = F.col("x"), F.col("bias_lo"), F.col("bias_hi")
    if "biassec" in lines.columns:
        section = S.parse_section(F.col("biassec"))
        low, high = section["x_min"], section["x_max"]
    images = lines.groupBy("exposure_id", "amp", "channel").agg(
        F.max("bias_hi").alias("bias_hi"), F.coalesce(F.bool_or((x >= low) & (x < high)), F.lit(False)).alias("has_bias")
    )
    facts = images.groupBy("exposure_id").agg(
        F.count_distinct("amp").alias("images"),
        F.sort_array(F.collect_set("channel")).alias("channels"),
        F.max("bias_hi").alias("bias_hi"),
        F.bool_and("has_bias").alias("has_bias"),
    )
    checks = [
        ("two_images", F.col("images") != 2, F.col("images").cast("string")),
        ("one_channel", F.size("channels") > 1, F.array_join("channels", ",")),
        ("bias_section", F.col("bias_hi").isNull() | ~F.col("has_bias"), F.when(F.col("bias_hi").isNull(), "none").otherwise("no lines")),
    ]
    if models is not None:
        known = models.select(F.col("channel").alias("_channel"), F.lit(True).alias("_known")).distinct()
        facts = facts.withColumn("_first", F.get("channels", F.lit(0)))
        facts = facts.join(known, F.col("_first") == F.col("_channel"), "left")
        checks.append(("model", F.col("_known").isNull(), F.coalesce("_first", F.lit("no channel"))))
    found = [F.when(bad, F.struct(F.lit(rule).alias("rule"), detail.alias("detail"))) for rule, bad, detail in checks]
    rows = facts.select(F.col("exposure_id").cast("string").alias("key"), F.explode(F.array_compact(F.array(*found))).alias("v"))
    return rows.select("v.rule", "key", "v.detail")


def usable_lines(
    lines: DataFrame, models: DataFrame | None = None, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Lines of the exposures that can be pre-processed, and the violations of the others; strict raises."""
    violations = line_violations(lines, models)
    if strict:
        DQ.require_clean(violations)
    bad = violations.select(F.col("key").alias("_bad")).distinct()
    good = lines.join(bad, F.col("exposure_id").cast("string") == F.col("_bad"), "left_anti")
    return good, violations


def exposure_parameters(lines: DataFrame, models: DataFrame) -> DataFrame:
    """Bit-offset parameters per exposure: ``(exposure_id, x_extent, parameters)``.

    ``models`` has ``(channel, parameters)``, one row per channel. The join runs on one row
    per exposure, never on lines, so a channel holding half of all exposures moves little.
    """
    e = exposures_of(lines).join(models.select("channel", "parameters"), "channel", "left")
    return e.select("exposure_id", "x_extent", "parameters")


def bias_of_corrected(lines: DataFrame, parameters: DataFrame, strict: bool = True) -> DataFrame:
    """Bias pixels after the bit-offset correction; other lines never reach the exchange."""
    paired = L.with_exposure(L.pair_lines(O.bias_lines(lines)), parameters)
    paired = D.with_parameters(paired, strict)
    pixels = D.correction_terms(paired, saturation=False, carry=("bias",))
    return O.bias_pixels(pixels.withColumn("value", F.col("raw") - F.col("bit_offset")))


def overscan_models(
    lines: DataFrame,
    models: DataFrame,
    provenance: DataFrame | None = None,
    strict: bool = True,
) -> DataFrame:
    """Overscan model of every image, as seen after the bit-offset correction."""
    bias = bias_of_corrected(lines, exposure_parameters(lines, models), strict)
    done = None if provenance is None else O.steps_done(provenance)
    return O.overscan_model(O.bias_profile(bias), done=done)


def preprocess(
    lines: DataFrame,
    models: DataFrame,
    provenance: DataFrame | None = None,
    steps: Sequence[tuple[str, D.Step]] = D.STEPS,
    snapshot: bool = False,
    strict: bool = True,
    without_bias: str = "fail",
) -> DataFrame:
    """Corrected pixels of every exposure, with their correction terms.

    An image of which no line lies in a bias section has no overscan model: by ``without_bias`` it fails the query, is left
    out (``drop``), or has the steps that need none (``keep``). :func:`line_violations` names its exposure.

    Two passes over the lines: a small one over the bias lines for the models, and the main
    one, which shuffles each line once, joins it once and explodes it once.
    """
    parameters = exposure_parameters(lines, models)
    bias = bias_of_corrected(lines, parameters, strict)
    done = None if provenance is None else O.steps_done(provenance)
    model = O.model_per_exposure(O.overscan_model(O.bias_profile(bias), done=done))
    calibration = parameters.join(model, "exposure_id", "left")
    paired = D.with_parameters(L.with_exposure(L.pair_lines(lines), calibration), strict)
    if without_bias not in ("fail", "drop", "keep"):
        raise ValueError(f"without_bias is fail, drop or keep, not {without_bias}")
    missing = F.raise_error(
        F.concat(F.lit("no bias section in exposure "), F.col("exposure_id").cast("string"))
    )
    for amp in L.AMPS:
        column = F.col(f"model{amp}")
        if without_bias == "fail":
            checked = F.coalesce(column, missing.cast(model.schema[f"model{amp}"].dataType))
            paired = paired.withColumn(f"model{amp}", checked)
        elif without_bias == "drop":
            paired = paired.withColumn(f"_modelled{amp}", column.isNotNull())
    if without_bias == "drop":
        pixels = D.correction_terms(paired, overscan=True, carry=("_modelled",)).filter("_modelled").drop("_modelled")
    else:
        pixels = D.correction_terms(paired, overscan=True)
    return D.run_steps(D.start_images(pixels), steps, snapshot)


IMAGE_COLUMNS = ("exposure_id", "amp", "x", "y", "value", "variance")


def preprocess_images(lines: DataFrame, models: DataFrame, **options) -> DataFrame:
    """Corrected images, one row per amplifier pixel."""
    return preprocess(lines, models, **options).select(*IMAGE_COLUMNS)


def preprocess_chips(lines: DataFrame, models: DataFrame, axis: str = "y", **options) -> DataFrame:
    """Corrected images with both amplifiers assembled into one."""
    return L.assemble(preprocess(lines, models, **options), axis)


def corrected_lines(pixels: DataFrame) -> DataFrame:
    """Corrected pixels back as lines, for writing.

    The grouping keys contain the shuffle keys of :func:`preprocess`, so no exchange is added.
    """
    return L.to_lines(pixels, ("exposure_id", "x_block", "amp", "x")).drop("x_block")
