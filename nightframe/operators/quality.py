"""Data-quality rules. Every rule yields ``(rule, key, detail)`` rows; no rows means clean."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nightframe import schemas


def _violation(rule: str, key, detail):
    return [F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")]


def not_null(rows: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """One pass for all columns."""
    missing = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in columns]))
    return rows.select(F.col(key).alias("_k"), F.explode(missing).alias("_c")).select(
        *_violation("not_null", F.col("_k"), F.col("_c"))
    )


def unique(rows: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    counted = rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1")
    return counted.select(*_violation("unique", F.col(key), F.col("_n")))


def in_domain(rows: DataFrame, key: str, column: str, domain: Iterable[str]) -> DataFrame:
    outside = rows.filter(~F.col(column).isin(*domain))
    return outside.select(*_violation("domain", F.col(key), F.col(column)))


def castable(rows: DataFrame, key: str, types: Mapping[str, str]) -> DataFrame:
    """Values that do not fit the declared type. One pass for all columns."""
    wrong = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(),
                    F.concat(F.lit(f"{c}="), F.col(c).cast("string")),
                )
                for c, t in types.items()
            ]
        )
    )
    return rows.select(F.col(key).alias("_k"), F.explode(wrong).alias("_c")).select(
        *_violation("type", F.col("_k"), F.col("_c"))
    )


def two_images(rows: DataFrame, key: str = "exposure_id", image: str = "amp") -> DataFrame:
    """Exposures without exactly two images; counts distinct images from tiny partials."""
    images = rows.select(key, image).distinct().groupBy(key).agg(F.count("*").alias("_n"))
    return images.filter("_n <> 2").select(*_violation("two_images", F.col(key), F.col("_n")))


def both(*violations: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, violations)


def unreadable(catalog: DataFrame) -> DataFrame:
    """Header cards and path values of the written entries that could not be read."""
    if "unreadable" not in catalog.columns:
        catalog = catalog.withColumn("unreadable", F.lit(None).cast("string"))
    rows = catalog.filter(F.col("unreadable").isNotNull())
    return rows.select(*_violation("type", F.col("file_path"), F.col("unreadable")))


def catalog_violations(catalog: DataFrame) -> DataFrame:
    return both(
        unique(catalog, "file_path"),
        not_null(catalog, "file_path", schemas.CATALOG_REQUIRED),
        in_domain(catalog, "file_path", "type", schemas.FILE_TYPES),
    )


def weather_violations(rows: DataFrame) -> DataFrame:
    return both(unique(rows, "time"), not_null(rows, "time", schemas.WEATHER_REQUIRED))


def require_clean(violations: DataFrame) -> None:
    """Fail on the first violation."""
    found = violations.take(1)
    if found:
        v = found[0]
        raise ValueError(f"rule {v['rule']} violated by {v['key']}: {v['detail']}")


def check_catalog(catalog: DataFrame) -> None:
    require_clean(catalog_violations(catalog))


def check_catalog_strictly(catalog: DataFrame) -> None:
    """As above, and no value of the newly read files may be lost."""
    require_clean(both(catalog_violations(catalog), unreadable(catalog)))


def event_violations(events: DataFrame) -> DataFrame:
    """Events whose time could not be read."""
    return events.filter(F.col("time").isNull()).select(*_violation("time", F.col("channel"), F.col("zone")))


def check_events_strictly(events: DataFrame) -> None:
    require_clean(event_violations(events))


def check_weather(rows: DataFrame) -> None:
    require_clean(weather_violations(rows))
