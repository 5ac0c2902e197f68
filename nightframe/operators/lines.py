"""Image layouts.

Images are stored as *lines*: one row per ``(exposure_id, amp, x)`` with the readings
along y in one array. Shuffles move lines, never single pixels; a line is exploded to
pixels only after the last exchange.

``x_block`` groups 64 neighbouring lines. ``(exposure_id, x_block)`` is the shuffle key of
every per-exposure step, so even an exposure holding a third of all rows spreads over many
tasks, and a task never holds more than 64 lines of an amplifier per key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe.functions import sections as S

X_BLOCK_SHIFT = 6
BLOCK_KEYS = ("exposure_id", "x_block")
PAIR_KEYS = ("exposure_id", "x_block", "x")
AMPS = (0, 1)

# Per-image attributes that travel with the lines. They are constant per image, so they
# dictionary-encode to almost nothing on disk, and no join is needed to reach them.
IMAGE_ATTRIBUTES = ("bias", "saturate")
EXPOSURE_ATTRIBUTES = ("channel", "x_extent", "bias_lo", "bias_hi")


def x_block(x: Column) -> Column:
    return F.shiftright(x, X_BLOCK_SHIFT)


def x_blocks(x_extent: Column) -> Column:
    """All block numbers of an image of that many lines."""
    return F.sequence(F.lit(0), x_block(F.greatest(x_extent, F.lit(1)) - 1))


def to_pixels(lines: DataFrame, data: str = "data") -> DataFrame:
    """Explode lines to pixels: array ``data`` becomes columns ``y`` and ``value``."""
    keep = [c for c in lines.columns if c != data]
    return lines.select(*keep, F.posexplode(data).alias("y", "value"))


def to_lines(
    pixels: DataFrame, keys: tuple[str, ...] = ("exposure_id", "amp", "x"), values=("value", "variance")
) -> DataFrame:
    """Collect pixels back to lines, one array per value column, ordered by y.

    A group is one detector line; its length is the y extent of the image.
    """
    cells = F.array_sort(F.collect_list(F.struct("y", *values)))
    grouped = pixels.groupBy(*keys).agg(cells.alias("_cells"))
    return grouped.select(*keys, *[F.col(f"_cells.{v}").alias(v) for v in values])


def transpose(pixels: DataFrame) -> DataFrame:
    """Swap the two image axes."""
    renamed = {"x": "y", "y": "x"}
    return pixels.select(*[F.col(c).alias(renamed.get(c, c)) for c in pixels.columns])


def as_double(pixels: DataFrame, columns: tuple[str, ...] = ("value", "variance")) -> DataFrame:
    """Images as double precision."""
    return pixels.withColumns({c: F.col(c).cast("double") for c in columns})


def with_bias_span(lines: DataFrame) -> DataFrame:
    """Add ``bias_lo``/``bias_hi``: the x range holding the bias sections of all images.

    Only for tables whose writer did not store it; costs one exchange of the lines.
    """
    section = S.parse_section(F.col("biassec"))
    span = lines.groupBy("exposure_id").agg(
        F.min(section["x_min"]).alias("bias_lo"), F.max(section["x_max"]).alias("bias_hi")
    )
    return lines.drop("bias_lo", "bias_hi").join(span, "exposure_id")


def pair_lines(lines: DataFrame) -> DataFrame:
    """Put the two amplifiers of an exposure side by side, line by line.

    Result: ``(exposure_id, x_block, x)``, exposure attributes, and ``data0``/``data1``,
    ``saturate0``… and ``bias0``… (the parsed bias section). A line without exactly two
    amplifiers fails. The single exchange is on ``(exposure_id, x_block)``; the grouping and
    every later per-exposure join or window reuse it.
    """
    prepared = lines.withColumn("x_block", x_block(F.col("x")))
    if "biassec" in lines.columns:
        prepared = prepared.withColumn("bias", S.parse_section(F.col("biassec")))
    per_image = [c for c in ("data", *IMAGE_ATTRIBUTES) if c in prepared.columns]
    shared = [c for c in EXPOSURE_ATTRIBUTES if c in lines.columns]
    placed = prepared.select(*PAIR_KEYS, "amp", *per_image, *shared).repartition(*BLOCK_KEYS)
    columns = [
        F.first(F.when(F.col("amp") == amp, F.col(c)), ignorenulls=True).alias(f"{c}{amp}")
        for c in per_image
        for amp in AMPS
    ]
    paired = placed.groupBy(*PAIR_KEYS).agg(
        F.count("*").alias("_images"),
        *columns,
        *[F.first(c, ignorenulls=True).alias(c) for c in shared],
    )
    complete = (F.col("_images") == 2) & F.col("data0").isNotNull() & F.col("data1").isNotNull()
    message = F.concat(
        F.lit("exposure "), F.col("exposure_id").cast("string"), F.lit(" does not have two images")
    )
    checked = F.when(complete, F.col("data0")).otherwise(
        F.raise_error(message).cast("array<int>")
    )
    return paired.withColumn("data0", checked).drop("_images")


def with_exposure(paired: DataFrame, per_exposure: DataFrame) -> DataFrame:
    """Attach one row per exposure to its paired lines.

    ``per_exposure`` has ``exposure_id`` and ``x_extent``; it is repeated once per x block, so
    both sides meet on the lines' own shuffle key and no exposure ends up in one task.
    """
    spread = per_exposure.withColumn("x_block", F.explode(x_blocks(F.col("x_extent")))).drop("x_extent")
    return paired.join(spread, list(BLOCK_KEYS), "left")


def per_amplifier(paired: DataFrame, per_image: tuple[str, ...], shared: tuple[str, ...] = ()) -> DataFrame:
    """Paired lines to one row per amplifier, each still holding the other's readings.

    Adds ``amp``, ``data``, ``other`` and the named image columns without their suffix.
    Narrow, and still at line level.
    """
    images = [
        F.struct(
            F.lit(amp).alias("amp"),
            F.col(f"data{amp}").alias("data"),
            F.col(f"data{1 - amp}").alias("other"),
            *[F.col(f"{c}{amp}").alias(c) for c in per_image],
        )
        for amp in AMPS
    ]
    return paired.select(*PAIR_KEYS, *shared, F.inline(F.array(*images)))


def _cut(data: Column, section: Column) -> Column:
    """The cells of a line inside a section, in the section's direction."""
    part = F.slice(data, section["y_min"] + 1, section["y_max"] - section["y_min"])
    return F.when(section["y_dir"] == 1, part).otherwise(F.reverse(part))


def extract_section(lines: DataFrame, label: str | Column, whole_if_missing: bool = False) -> DataFrame:
    """Keep the part of the images inside a section; coordinates become section-relative.

    Works on whole lines: other lines are filtered out and the rest sliced. A missing label is
    an error unless ``whole_if_missing``. A descending range keeps the same cells backwards.
    """
    label = F.col(label) if isinstance(label, str) else label
    if not whole_if_missing:
        label = F.coalesce(label, F.raise_error(F.lit("section is not set in the header")).cast("string"))
    names = lines.columns
    s, x = F.col("_s"), F.col("x")
    found = lines.withColumn("_s", S.parse_section(label))
    found = found.filter(s.isNull() | ((x >= s["x_min"]) & (x < s["x_max"])))
    found = found.withColumns(
        {
            "x": F.when(s.isNull(), x).otherwise(S.section_x(s, x)),
            "data": F.when(s.isNull(), F.col("data")).otherwise(_cut(F.col("data"), s)),
        }
    )
    return found.select(*names)


def assign_section(lines: DataFrame, new: DataFrame, label: str = "datasec") -> DataFrame:
    """Replace the section of every image by the lines of ``new`` (section-relative).

    ``new`` must have exactly the section's shape, else the query fails. Lines meet lines, so
    the join moves one row per line and splices arrays.
    """
    names = lines.columns
    kind = lines.schema["data"].dataType
    s, x = F.col("_s"), F.col("x")
    whole = F.col("_s").isNull()
    old = lines.withColumn("_s", S.parse_section(F.col(label)))
    old = old.withColumn("_hit", whole | ((x >= s["x_min"]) & (x < s["x_max"])))
    old = old.withColumn("_sx", F.when(F.col("_hit"), F.coalesce(S.section_x(s, x), x)))
    given = new.select("exposure_id", "amp", F.col("x").alias("_sx"), F.col("data").cast(kind).alias("_new"))
    joined = old.join(given, ["exposure_id", "amp", "_sx"], "full")
    length = F.coalesce(s["y_max"] - s["y_min"], F.size("data"))
    fits = x.isNotNull() & F.col("_new").isNotNull() & (F.size("_new") == length)
    placed = F.when(whole | (s["y_dir"] == 1), F.col("_new")).otherwise(F.reverse("_new"))
    spliced = F.concat(
        F.slice("data", 1, F.coalesce(s["y_min"], F.lit(0))),
        placed,
        F.slice("data", F.coalesce(s["y_max"], F.size("data")) + 1, F.size("data")),
    )
    mismatch = F.raise_error(F.lit("new data does not match the section shape")).cast(kind)
    outside = x.isNotNull() & ~F.col("_hit")
    data = F.when(outside, F.col("data")).when(fits, spliced).otherwise(mismatch)
    return joined.withColumn("data", data).select(*names)


def assemble(pixels: DataFrame, axis: str = "y") -> DataFrame:
    """One image per exposure: amplifier 1 beside amplifier 0 on ``axis``.

    ``x_extent``/``y_extent`` of the pixels are the size of amplifier 0's image, so no join.
    """
    shift = F.when(F.col("amp") == 1, F.col(f"{axis}_extent")).otherwise(0)
    placed = pixels.withColumn(axis, (F.col(axis) + shift).cast("int"))
    return placed.select("exposure_id", "x", "y", "value", "variance")


def assemble_lines(lines: DataFrame, axis: str = "y") -> DataFrame:
    """Assemble without leaving the line layout: ``(exposure_id, x, data)``.

    Along y the two arrays are concatenated; along x amplifier 1's lines are renumbered.
    """
    if axis == "y":
        paired = pair_lines(lines)
        return paired.select("exposure_id", "x", F.concat("data0", "data1").alias("data"))
    shift = F.when(F.col("amp") == 1, F.col("x_extent")).otherwise(0)
    return lines.select("exposure_id", (F.col("x") + shift).cast("int").alias("x"), "data")


def split_lines(lines: DataFrame, axis: str = "y") -> DataFrame:
    """Split one-image exposures held as lines, without a join, an exchange or a second read.

    The lines carry the section labels of both amplifiers as ``image_sections``, an array of
    ``struct<amp, datasec, biassec>``. Exposures that already have two images pass through.
    """
    images = F.col("image_sections")
    # Sections become columns first; inlined, each of their many uses would parse the label anew.
    parsed = {}
    for i in AMPS:
        image = F.get(images, F.lit(i))
        parsed[f"_amp{i}"] = image["amp"]
        parsed[f"_d{i}"] = S.parse_section(image["datasec"])
        parsed[f"_b{i}"] = S.parse_section(image["biassec"])
    placed, lows, highs = [], [], []
    for i in AMPS:
        amp, d, b = F.col(f"_amp{i}"), F.col(f"_d{i}"), F.col(f"_b{i}")
        start = d["x_max"] - d["x_min"] if axis == "x" else F.lit(0)
        lows.append(start)
        highs.append(start + b["x_max"] - b["x_min"])
        placed.append(_place_line(amp, d, d, b, axis, bias=False))
        if axis == "x":
            placed.append(_place_line(amp, b, d, b, axis, bias=True))
    remade = ("amp", "x", "data", "datasec", "biassec", "x_extent", "bias_lo", "bias_hi", "image_sections")
    keep = [c for c in lines.columns if c not in remade]
    own = [c for c in ("amp", "x", "data", "datasec", "biassec", "x_extent", "bias_lo", "bias_hi") if c in lines.columns]
    added = [c for c in ("datasec", "biassec", "x_extent", "bias_lo", "bias_hi") if c not in own]
    names = (*own, *added)
    kind = {f.name: f.dataType for f in lines.schema}
    span = {"bias_lo": F.least(*lows), "bias_hi": F.greatest(*highs)}

    def struct_of(pick) -> Column:
        return F.struct(*[(pick(c).cast(kind[c]) if c in kind else pick(c).cast(_SPLIT_TYPES[c])).alias(c) for c in names])

    whole = struct_of(lambda c: F.col(c) if c in own else F.lit(None))
    pieces = F.transform(
        F.array_compact(F.array(*placed)),
        lambda p: struct_of(lambda c: F.col(f"_{c}") if c in span else p[c]),
    )
    rows = F.when(images.isNull(), F.array(whole)).otherwise(pieces)
    parsed = lines.withColumns(parsed).withColumns({f"_{c}": e for c, e in span.items()})
    return parsed.select(*keep, F.explode(rows).alias("_p")).select(*keep, "_p.*")


_SPLIT_TYPES = {"datasec": "string", "biassec": "string", "x_extent": "int", "bias_lo": "int", "bias_hi": "int"}


def _place_line(amp: Column, section: Column, d: Column, b: Column, axis: str, bias: bool) -> Column:
    """Struct of the new line made from the current one, or null if the section misses it."""
    x = F.col("x")
    dx, dy = d["x_max"] - d["x_min"], d["y_max"] - d["y_min"]
    bx, by = b["x_max"] - b["x_min"], b["y_max"] - b["y_min"]

    x_new = S.section_x(section, x) + (dx if bias else F.lit(0))
    if axis == "y":
        # Both sections must cover the same lines, as stacking along y demands.
        same = (bx == dx) & (S.section_x(b, x) == S.section_x(d, x))
        data = F.when(same, F.concat(_cut(F.col("data"), d), _cut(F.col("data"), b))).otherwise(
            F.raise_error(F.lit("data and bias sections differ in x")).cast("array<int>")
        )
        bias_label = S.section_label(bx, by, F.lit(0), dy)
        extent = dx
    else:
        data = _cut(F.col("data"), section)
        bias_label = S.section_label(bx, by, dx, F.lit(0))
        extent = dx + bx
    line = F.struct(
        amp.cast("int").alias("amp"),
        x_new.cast("int").alias("x"),
        data.alias("data"),
        S.section_label(dx, dy).alias("datasec"),
        bias_label.alias("biassec"),
        extent.cast("int").alias("x_extent"),
    )
    return F.when((x >= section["x_min"]) & (x < section["x_max"]), line)
