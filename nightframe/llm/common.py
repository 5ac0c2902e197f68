"""Helpers shared by the operators: tables, the shared folder, checkpoints."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words in every contract.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``; one of our own only where none is set and Spark runs in one process, as in tests."""
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="nightframe-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """The rows written once as Parquet in the shared folder, with the writer's ``options``, and read back with their schema."""
    path = new_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def row_hashes(df: DataFrame) -> tuple[Column, Column]:
    """Two independent hashes of a whole row, together 96 bits: the row's identity. Maps count as JSON."""
    parts = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if field.dataType.typeName() in ("map", "variant"):
            column = F.to_json(F.struct(column))
        parts += [column.isNull(), column]
    return F.xxhash64(*parts), F.hash(*parts)
