"""Labelled texts to learn from, and the split that keeps held-out rows away."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(modulus))


def training_texts(
    docs: DataFrame, labels: DataFrame, label: str, learnable: Column, rows: int, id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``text, y`` of at most ``rows`` labelled ids, each different text once.

    ``learnable`` is a condition on the id column. The ids are chosen by a hash, alike for every size of the table,
    and are few enough to be sent to every task, so the documents aren't shuffled. Null ids, labels and
    texts are left out; an id with several labels counts with its largest.
    """
    chosen = (
        labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & learnable)
        .groupBy(F.col(id).alias("labelled_id")).agg(F.max(label).cast("int").alias("y"))
        .orderBy(F.xxhash64("labelled_id"), "labelled_id").limit(rows)
    )
    texts = docs.select(F.col(id).alias("labelled_id"), F.col(text).cast("binary").alias("text")).where("text IS NOT NULL")
    found = texts.join(F.broadcast(chosen), "labelled_id")
    return found.groupBy(F.xxhash64("text").alias("h")).agg(F.first("text").alias("text"), F.max("y").alias("y")).drop("h")
