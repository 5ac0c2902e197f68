"""Bit-offset model files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.functions.paths import partition_values
from nightframe.operators.detector import valid_model

MODEL_SCHEMA = "model_version INT, parameters ARRAY<ARRAY<DOUBLE>>"


def read_model_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per JSON file below ``path``: ``(file_path, value)``."""
    texts = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .text(path)
    )
    return texts.select(F.col("_metadata.file_path").alias("file_path"), "value")


def parse_models(texts: DataFrame) -> DataFrame:
    """``(file_path, channel, model_version, parameters, valid)``; channel comes from the path."""
    model = F.from_json("value", MODEL_SCHEMA)
    m = texts.select(
        "file_path",
        partition_values(F.col("file_path"))["channel"].alias("channel"),
        model.alias("_m"),
    )
    return m.select(
        "file_path",
        "channel",
        "_m.model_version",
        "_m.parameters",
        F.coalesce(valid_model(F.col("_m.parameters")), F.lit(False)).alias("valid"),
    )


def models_by_channel(models: DataFrame) -> DataFrame:
    """First model in path order of every channel; an invalid one is an error, not skipped."""
    first = models.groupBy("channel").agg(
        F.min_by(F.struct("parameters", "valid", "file_path"), "file_path").alias("_m")
    )
    message = F.concat(F.lit("invalid bit-offset model: "), F.col("_m.file_path"))
    parameters = F.when(F.col("_m.valid"), F.col("_m.parameters")).otherwise(
        F.raise_error(message).cast("array<array<double>>")
    )
    return first.select("channel", parameters.alias("parameters"), F.col("_m.file_path").alias("file_path"))
