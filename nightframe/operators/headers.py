"""Header rows: ``(exposure or file, image_no, key, vtype, value_str, value_double, value_bool)``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nightframe.functions import sections as S

NUMERIC = ("int", "float", "bool")
VALUE_COLUMNS = ("vtype", "value_str", "value_double", "value_bool")


def _checked(ok: Column, value: Column, kind: str, sql_type: str, strict: bool) -> Column:
    if not strict:
        return F.when(ok, value)
    message = F.concat(F.lit("key "), F.col("key"), F.lit(f" is not {kind}: its type is "), F.col("vtype"))
    return F.when(F.col("vtype").isNull() | ok, value).otherwise(F.raise_error(message).cast(sql_type))


def _number() -> Column:
    return F.when(F.col("vtype") == "bool", F.col("value_bool").cast("int").cast("double")).otherwise(
        F.col("value_double")
    )


def as_int(strict: bool = True) -> Column:
    """Value as integer: floats truncate, booleans count as 0 and 1, text is a wrong type."""
    return _checked(F.col("vtype").isin(*NUMERIC), _number().cast("long"), "an int", "bigint", strict)


def as_float(strict: bool = True) -> Column:
    return _checked(F.col("vtype").isin(*NUMERIC), _number(), "a float", "double", strict)


def as_bool(strict: bool = True) -> Column:
    return _checked(F.col("vtype") == "bool", F.col("value_bool"), "a bool", "boolean", strict)


def as_str(strict: bool = True) -> Column:
    return _checked(F.col("vtype") == "str", F.col("value_str"), "a str", "string", strict)


_GETTERS = {"int": as_int, "float": as_float, "bool": as_bool, "str": as_str}


def get(
    images: DataFrame,
    header: DataFrame,
    key: str,
    kind: str,
    on: tuple[str, ...] = ("exposure_id", "image_no"),
    default: object = None,
    required: bool = False,
) -> DataFrame:
    """Add a typed card as column ``value`` to images; a missing required card is an error.

    A default stands for an absent card. Required booleans and text ignore it.
    """
    rows = header.filter(F.col("key") == key).select(*on, "key", *VALUE_COLUMNS)
    found = images.join(rows, list(on), "left")
    value = _GETTERS[kind]()
    if default is not None and not (required and kind in ("bool", "str")):
        value = F.coalesce(value, F.lit(default))
    if required:
        sql_type = {"int": "bigint", "float": "double", "bool": "boolean", "str": "string"}[kind]
        missing = F.raise_error(F.lit(f"key {key} is not available in the header"))
        value = F.coalesce(value, missing.cast(sql_type))
    return found.withColumn("value", value).drop("key", *VALUE_COLUMNS)


def merge_first(header: DataFrame, by: str = "exposure_id") -> DataFrame:
    """Merge the headers of all images of an exposure; the first image's value wins."""
    value = F.min_by(F.struct(*VALUE_COLUMNS), F.col("image_no")).alias("_v")
    return header.groupBy(by, "key").agg(value).select(by, "key", "_v.*")


def merge_last(header: DataFrame, by: str = "exposure_id") -> DataFrame:
    """Merge headers; the last image's value wins."""
    value = F.max_by(F.struct(*VALUE_COLUMNS), F.col("image_no")).alias("_v")
    return header.groupBy(by, "key").agg(value).select(by, "key", "_v.*")


def shown_value() -> Column:
    """A card's value as text."""
    vtype = F.col("vtype")
    return (
        F.when(vtype == "str", F.col("value_str"))
        .when(vtype == "int", F.col("value_double").cast("long").cast("string"))
        .when(vtype == "float", F.col("value_double").cast("string"))
        .when(vtype == "bool", F.col("value_bool").cast("string"))
    )


def as_maps(header: DataFrame, by: tuple[str, ...] = ("exposure_id", "image_no")) -> DataFrame:
    """One header map per image; an image's header is one small map by nature."""
    pair = F.struct("key", shown_value().alias("value"))
    return header.groupBy(*by).agg(F.map_from_entries(F.collect_list(pair)).alias("header"))


def fill_defaults(header: Column, defaults: Column) -> Column:
    """Header map with defaults for absent keys."""
    return F.map_zip_with(header, defaults, lambda k, own, default: F.coalesce(own, default))


def merge_maps(first: Column, second: Column) -> Column:
    """Two header maps; the second wins."""
    return F.map_zip_with(first, second, lambda k, a, b: F.coalesce(b, a))


def merge_all_maps(maps: DataFrame, by: str = "exposure_id", order: str = "image_no", header: str = "header") -> DataFrame:
    """The header maps of each group merged in their order, as by :func:`merge_maps` one after the other.

    A group's maps never meet in one row: the last value of every key is found by a partial aggregation, and only
    one card for each key is put into the result.
    """
    cards = maps.select(by, F.col(order).alias("_order"), F.explode(header).alias("key", "_value"))
    # of the values that aren't null the last one; a key that has none stays, without a value
    last = F.expr("max_by(_value, _order) FILTER (WHERE _value IS NOT NULL)")
    merged = cards.groupBy(by, "key").agg(last.alias("value"))
    return merged.groupBy(by).agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias(header))


# Numbered cards of a one-image file and the card each becomes after the split.
SPLIT_PATTERN = r"^(CCDSEC|AMPSEC|DETSEC|CCDBIN)([01])$"
SPLIT_GAIN_PATTERN = r"^CCD([01])GAIN$"
SPLIT_GAIN = "ORIGINAL_GAIN"
SPLIT_TARGETS = (
    "ORIGINAL_GAIN", "CCDNAMP", "DATASEC", "BIASSEC", "CCDSEC", "AMPSEC", "DETSEC", "CCDBIN", "CCDTEMP",
)


def split_header(header: DataFrame, by: str = "file_path", axis: str = "y") -> DataFrame:
    """Header rows of a one-image file to the header rows of its two amplifiers.

    All cards are kept for both; the targets above are replaced by the amplifier's own.
    """
    key = F.col("key")
    amp = F.explode(F.array(F.lit(0), F.lit(1))).alias("amp")
    kept = header.filter(~key.isin(*SPLIT_TARGETS)).select(by, amp, "key", *VALUE_COLUMNS)

    numbered = header.filter(key.rlike(SPLIT_PATTERN) | key.rlike(SPLIT_GAIN_PATTERN))
    is_gain = key.rlike(SPLIT_GAIN_PATTERN)
    renamed = numbered.select(
        by,
        F.when(is_gain, F.regexp_extract(key, SPLIT_GAIN_PATTERN, 1))
        .otherwise(F.regexp_extract(key, SPLIT_PATTERN, 2))
        .cast("int")
        .alias("amp"),
        F.when(is_gain, F.lit(SPLIT_GAIN)).otherwise(F.regexp_extract(key, SPLIT_PATTERN, 1)).alias("key"),
        *VALUE_COLUMNS,
    )

    def text_of(card: str) -> Column:
        return F.max(F.when(key == card, F.col("value_str")))

    def number_of(card: str) -> Column:
        return F.max(F.when(key == card, F.col("value_double")))

    facts = header.groupBy(by).agg(
        *[text_of(f"{s}{i}").alias(f"{s}{i}") for s in ("DATASEC", "BIASSEC") for i in (0, 1)],
        F.coalesce(number_of("CCDTMP"), number_of("DETTEMP")).alias("temperature"),
    )
    none = F.lit(None)

    def card(i: int, name: str, vtype: str, text: Column, number: Column) -> Column:
        return F.struct(
            F.lit(i).alias("amp"),
            F.lit(name).alias("key"),
            F.lit(vtype).alias("vtype"),
            text.cast("string").alias("value_str"),
            number.cast("double").alias("value_double"),
            none.cast("boolean").alias("value_bool"),
        )

    facts = facts.withColumns(
        {f"{s}{i}": S.parse_section(F.col(f"{s}{i}")) for s in ("DATASEC", "BIASSEC") for i in (0, 1)}
    )
    derived = []
    for i in (0, 1):
        d, b = F.col(f"DATASEC{i}"), F.col(f"BIASSEC{i}")
        dx, dy = d["x_max"] - d["x_min"], d["y_max"] - d["y_min"]
        bx, by_ = b["x_max"] - b["x_min"], b["y_max"] - b["y_min"]
        x0, y0 = (dx, F.lit(0)) if axis == "x" else (F.lit(0), dy)
        derived += [
            card(i, "CCDNAMP", "int", none, F.lit(1)),
            card(i, "DATASEC", "str", S.section_label(dx, dy), none),
            card(i, "BIASSEC", "str", S.section_label(bx, by_, x0, y0), none),
            F.when(
                F.col("temperature").isNotNull(), card(i, "CCDTEMP", "float", none, F.col("temperature"))
            ),
        ]
    computed = facts.select(by, F.inline(F.array_compact(F.array(*derived))))
    return kept.unionByName(renamed).unionByName(computed)
