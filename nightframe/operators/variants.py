"""Headers as VARIANT: one row per image that holds all its cards with their own types.

Cards are gathered once, when a header is stored; afterwards a card is read by its path, without a join, a pivot or a list of keys
that has to be known beforehand. Integers are BIGINT, floats DOUBLE, and numbers that JSON can't write, as NaN, stay what they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_KINDS = {"BIGINT": "int", "DOUBLE": "float", "BOOLEAN": "bool", "STRING": "str"}
_TYPES = {"int": "bigint", "float": "double", "bool": "boolean", "str": "string"}
_WANTED = {"int": ("int", "float", "bool"), "float": ("int", "float", "bool"), "bool": ("bool",), "str": ("str",)}


def card_variant() -> Column:
    """A card row's value as VARIANT; without a value it is the variant null."""
    kind = F.col("vtype")
    value = (
        F.when(kind == "str", F.col("value_str").cast("variant"))
        .when(kind == "int", F.col("value_double").cast("long").cast("variant"))
        .when(kind == "float", F.col("value_double").cast("variant"))
        .when(kind == "bool", F.col("value_bool").cast("variant"))
    )
    return F.coalesce(value, F.parse_json(F.lit("null")))


def as_variant(cards: DataFrame, by: tuple[str, ...] = ("exposure_id", "image_no")) -> DataFrame:
    """One row per image, ``header`` being an object of its cards. A key is expected once in an image; rows without a key are left out."""
    pair = F.struct("key", card_variant().alias("value"))
    gathered = cards.where(F.col("key").isNotNull()).groupBy(*by).agg(F.collect_list(pair).alias("cards"))
    return gathered.select(*by, F.to_variant_object(F.map_from_entries("cards")).alias("header"))


def _card(header: Column, key: str) -> Column:
    if '"' in key:
        raise ValueError(f"a header key holds no quote: {key}")
    return F.variant_get(header, f'$["{key}"]', "variant")


def kind(header: Column, key: str) -> Column:
    """``int``, ``float``, ``bool`` or ``str``; null where the card or its value is absent."""
    found = F.schema_of_variant(_card(header, key))
    return F.element_at(F.create_map(*[F.lit(x) for pair in _KINDS.items() for x in pair]), found)


def card(
    header: Column, key: str, as_kind: str, default: object = None, required: bool = False, strict: bool = True
) -> Column:
    """A card's value as ``int``, ``float``, ``bool`` or ``str``.

    Floats truncate to integers and flags count as 0 and 1; text isn't read as a number, nor a number as text. A card of a wrong kind
    is an error, or null where not ``strict``. ``default`` stands for an absent card, ``required`` makes it an error; required flags and text ignore a default.
    """
    target = _TYPES[as_kind]
    own = kind(header, key)
    value = F.when(own.isin(*_WANTED[as_kind]), F.try_variant_get(header, f'$["{key}"]', target))
    if strict:
        wrong = F.raise_error(F.concat(F.lit(f"key {key} is not of kind {as_kind}: its kind is "), own))
        value = F.when(own.isNull() | own.isin(*_WANTED[as_kind]), value).otherwise(wrong.cast(target))
    if default is not None and not (required and as_kind in ("bool", "str")):
        value = F.coalesce(value, F.lit(default).cast(target))
    if required:
        value = F.coalesce(value, F.raise_error(F.lit(f"key {key} is not available in the header")).cast(target))
    return value


def shown(header: Column, key: str) -> Column:
    """A card's value as text, whatever its kind."""
    return F.variant_get(header, f'$["{key}"]', "string")


def image_schema(headers: DataFrame) -> DataFrame:
    """Each image's own keys and types as ``schema``."""
    return headers.withColumn("schema", F.schema_of_variant("header")).drop("header")


def merged_schema(headers: DataFrame, by: str) -> DataFrame:
    """The keys and types that hold for all images of a group; merged partially in each task, so a group may be of any size."""
    return headers.groupBy(by).agg(F.schema_of_variant_agg("header").alias("schema"))
