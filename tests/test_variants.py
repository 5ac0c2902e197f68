"""Headers as VARIANT: kinds, getters and schemas of odd cards."""

import math

import pytest
from pyspark.sql import functions as F

from nightframe.operators import headers as H
from nightframe.operators import variants as X

SCHEMA = "exposure_id long, image_no int, key string, vtype string, value_str string, value_double double, value_bool boolean, note string"
CARDS = [
    (1, 0, "GAIN", "float", None, 1.75, None, "x"),
    (1, 0, "DATE-OBS", "str", "2024-01-02", None, None, "x"),
    (1, 0, "LEVEL", "float", None, float("nan"), None, None),
    (1, 0, "TOP", "float", None, float("inf"), None, None),
    (1, 0, "COUNT", "int", None, 40000.0, None, None),
    (1, 0, "OPEN", "bool", None, None, True, None),
    (1, 0, "DIGITS", "str", "12", None, None, None),
    (1, 0, "EMPTY", "str", None, None, None, None),
    (1, 0, "it's $.a[0]", "int", None, -3.0, None, None),
    (1, 0, None, "int", None, 5.0, None, None),
    (1, 1, "GAIN", "int", None, 2.0, None, None),
    (1, 1, "OPEN", "str", "yes", None, None, None),
    (None, 0, "GAIN", "float", None, -0.5, None, None),
    (2, 0, None, None, None, None, None, None),
]


@pytest.fixture(scope="module")
def headers(spark):
    return X.as_variant(spark.createDataFrame(CARDS, SCHEMA)).cache()


def read(headers, column, exposure=1, image=0):
    row = headers.where(F.col("exposure_id").eqNullSafe(exposure) & (F.col("image_no") == image)).select(column.alias("v")).first()
    return row.v


def test_one_row_an_image(headers):
    rows = {(r.exposure_id, r.image_no) for r in headers.collect()}
    assert rows == {(1, 0), (1, 1), (None, 0)}  # an image whose cards have no key has no header


def test_values_keep_their_kinds(headers):
    h = F.col("header")
    assert [read(headers, X.kind(h, k)) for k in ("GAIN", "COUNT", "OPEN", "DATE-OBS", "EMPTY", "ABSENT")] == ["float", "int", "bool", "str", None, None]
    assert read(headers, X.card(h, "DATE-OBS", "str")) == "2024-01-02"
    assert math.isnan(read(headers, X.card(h, "LEVEL", "float"))) and read(headers, X.card(h, "TOP", "float")) == math.inf
    assert read(headers, X.card(h, "it's $.a[0]", "int")) == -3
    assert read(headers, X.card(h, "GAIN", "float"), None) == -0.5
    with pytest.raises(ValueError, match="quote"):
        X.card(h, 'a"b', "int")


def test_getters_convert_as_those_of_card_rows(spark, headers):
    """Every kind of every card, beside the getters that work on card rows."""
    cards = spark.createDataFrame(CARDS, SCHEMA).where("key IS NOT NULL AND exposure_id = 1 AND image_no = 0")
    cards = cards.where("key <> 'TOP' AND key <> 'LEVEL'")  # no integers
    h = F.col("header")
    getters = {"int": H.as_int, "float": H.as_float, "bool": H.as_bool, "str": H.as_str}
    want = {r.key: r for r in cards.select("key", *[g(strict=False).alias(k) for k, g in getters.items()]).collect()}
    columns = [X.card(h, key, k, strict=False).alias(f"{i}{k}") for i, key in enumerate(want) for k in getters]
    got = headers.where("exposure_id = 1 AND image_no = 0").select(*columns).first()
    for i, key in enumerate(want):
        assert [got[f"{i}{k}"] for k in getters] == [want[key][k] for k in getters], key


def test_defaults_required_and_strict(headers):
    h = F.col("header")
    assert read(headers, X.card(h, "ABSENT", "int", default=7)) == 7
    assert read(headers, X.card(h, "ABSENT", "float", default=7, required=True)) == 7.0
    assert read(headers, X.card(h, "EMPTY", "str", default="none")) == "none"
    for wrong in (X.card(h, "DIGITS", "int"), X.card(h, "COUNT", "str"), X.card(h, "COUNT", "bool")):
        with pytest.raises(Exception, match="is not of kind"):
            read(headers, wrong)
    for kind, default in (("str", "x"), ("bool", True)):
        with pytest.raises(Exception, match="is not available"):
            read(headers, X.card(h, "ABSENT", kind, default=default, required=True))


def test_schemas(spark, headers):
    one = X.image_schema(headers.where("image_no = 1")).first().schema
    assert one == "OBJECT<GAIN: BIGINT, OPEN: STRING>"
    merged = {r.exposure_id: r.schema for r in X.merged_schema(headers, "exposure_id").collect()}
    assert "GAIN: DOUBLE" in merged[1] and "OPEN: VARIANT" in merged[1] and merged[None] == "OBJECT<GAIN: DOUBLE>"
    assert X.merged_schema(headers.limit(0), "exposure_id").count() == 0


def test_a_card_is_read_without_another_exchange(headers, spark):
    plan = spark.createDataFrame(CARDS, SCHEMA).transform(X.as_variant).select(
        X.card(F.col("header"), "GAIN", "float"), X.card(F.col("header"), "COUNT", "int")
    )._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
