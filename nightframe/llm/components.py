"""Connected components of an edge list by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe.llm.common import checkpoint


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))).first()
    )


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, root`` for every node of an edge, ``root`` being the smallest node reachable.

    Nodes that no edge touches are not returned. Both star steps aggregate partially and then join on
    the centre, so a centre with millions of neighbours is a skewed join, never one task's group.
    Rows with a null end and loops carry no link and are ignored; an empty list gives no rows.
    """
    current = checkpoint(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where(
            F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v"))
        ).distinct()
    )
    before = _fingerprint(current)
    while before[0]:
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        centre = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(centre, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array(F.struct("v", "m"), F.struct(F.col("u").alias("v"), "m"))).alias("e"))
            .select(F.col("e.v").alias("u"), F.col("e.m").alias("v"))
            .where("u != v")
            .distinct()
        )
        current = checkpoint(small)
        after = _fingerprint(current)
        if after == before:
            break
        before = after
    stars = current.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return stars.unionByName(stars.select(F.col("root").alias("node"), "root").distinct())
