"""Queries on weather, run logs and headers."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.functions import times
from nightframe.operators import headers as H
from nightframe.operators import quality as DQ
from nightframe.operators import runlog as L
from nightframe.operators import variants as X
from nightframe.operators import weather as W
from nightframe.registry import views as V
from nightframe.registry.detector import _q

NOW = datetime(2024, 1, 31, 9, 58, tzinfo=timezone.utc)  # one clock reading per run


def _shown(rows):
    """Times as UTC wall clock, for comparison."""
    return rows.withColumn("time", times.utc_wall_clock(F.col("time")))


def weather_parse(spark, sf):
    return _shown(W.parse(V.weather_lines(spark, sf)))


def weather_latest(spark, sf):
    rows = W.newest_per_time(W.parse(V.weather_lines(spark, sf)))
    return _shown(rows)


def weather_merge(spark, sf):
    """Fetched lines merged into existing ones."""
    rows = W.parse(V.weather_lines(spark, sf))
    existing = W.newest_per_time(rows.filter("source_rank = 0")).select(*schemas.WEATHER_ROWS.names)
    fetched = rows.filter("source_rank = 1").drop("source_rank")
    return _shown(W.merge(existing, fetched, ("line_no",)))


def weather_fresh(spark, sf):
    return W.freshness(W.parse(V.weather_lines(spark, sf)), NOW)


def weather_report(spark, sf):
    rows = W.newest_per_time(W.parse(V.weather_lines(spark, sf)))
    return _shown(W.report(W.lookback(rows, NOW)))


def weather_years(spark, sf):
    """Lines of the yearly files a look-back of 7 days touches."""
    lines = V.weather_lines(spark, sf).withColumn(
        "file_path", F.concat(F.lit("wx."), (2022 + F.col("line_no") % 3).cast("string"), F.lit(".dat"))
    )
    years = W.years_to_read(datetime(2024, 1, 3, tzinfo=timezone.utc))
    return W.of_years(lines, years).select("line_no", "file_path")


def weather_quality(spark, sf):
    rows = _shown(W.parse(V.weather_lines(spark, sf)))
    broken = rows.withColumn("temperature", F.when(F.col("line_no") % 10 != 0, F.col("temperature")))
    return DQ.both(
        DQ.unique(broken.withColumn("time", F.date_format("time", "yyyy-MM-dd HH:mm")), "time"),
        DQ.not_null(broken, "line_no", schemas.WEATHER_REQUIRED),
    )


def runlog_events(spark, sf):
    return _shown(L.stored(L.events(V.log_lines(spark, sf))))


def header_typed(spark, sf):
    h = V.headers(spark, sf)
    return h.select(
        "exposure_id", "image_no", "key",
        H.as_int(strict=False).alias("as_int"), H.as_float(strict=False).alias("as_float"),
        H.as_bool(strict=False).alias("as_bool"), H.as_str(strict=False).alias("as_str"),
    )


def header_get(spark, sf):
    """A number card of every image, with a default where it is absent."""
    h = V.headers(spark, sf).withColumn("vtype", F.when(F.col("vtype") != "str", F.col("vtype")))
    images = h.select("exposure_id", "image_no").distinct()
    return H.get(images, h, "PURCHASE", "float", default=-1.0)


def header_pivot(spark, sf):
    """Known cards as columns, one row per image."""
    h = V.headers(spark, sf).withColumn("shown", H.shown_value())
    keys = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
    p = h.groupBy("exposure_id", "image_no").pivot("key", keys).agg(F.max("shown"))
    return p.select("exposure_id", "image_no", *[F.col(k).alias(k.lower()) for k in keys])


def header_merge_first(spark, sf):
    return H.merge_first(V.headers(spark, sf))


def header_merge_last(spark, sf):
    return H.merge_last(V.headers(spark, sf))


def header_merge_maps(spark, sf):
    """The header maps of all images of an exposure, merged in their order."""
    merged = H.merge_all_maps(H.as_maps(V.headers(spark, sf)))
    return merged.select("exposure_id", F.explode("header").alias("key", "value"))


def header_defaults(spark, sf):
    """Defaults for the absent cards of every image."""
    defaults = F.create_map(*map(F.lit, ("VIEW", "none", "GAIN", "1")))
    m = H.as_maps(V.headers(spark, sf)).withColumn("h", H.fill_defaults(F.col("header"), defaults))
    return m.select("exposure_id", "image_no", F.explode("h").alias("key", "value"))


def _typed_get(spark, sf, kind, key, default):
    """A card of every image, without and with a default; other types of it count as absent."""
    h = V.headers(spark, sf)
    images = h.select("exposure_id", "image_no").distinct()
    h = h.filter(F.col("vtype") == kind)
    plain = H.get(images, h, key, kind).withColumnRenamed("value", "plain")
    return H.get(plain, h, key, kind, default=default)


def header_get_bool(spark, sf):
    return _typed_get(spark, sf, "bool", "CLICK", True)


def header_get_str(spark, sf):
    return _typed_get(spark, sf, "str", "SIGNUP", "unknown")


def _variants(spark, sf):
    return X.as_variant(V.headers(spark, sf))


def header_variant_get(spark, sf):
    """Typed cards of every image, read by their paths from one VARIANT."""
    h = F.col("header")
    return _variants(spark, sf).select(
        "exposure_id", "image_no",
        X.card(h, "PURCHASE", "float", default=-1.0, strict=False).alias("number"),
        X.card(h, "ERROR", "int", strict=False).alias("whole"),
        X.card(h, "CLICK", "bool", default=True, strict=False).alias("flag"),
        X.card(h, "SIGNUP", "str", default="unknown", strict=False).alias("text"),
        X.kind(h, "VIEW").alias("kind"),
    )


def header_variant_pivot(spark, sf):
    """Known cards as columns, without a pivot."""
    keys = ["CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW"]
    return _variants(spark, sf).select("exposure_id", "image_no", *[X.shown(F.col("header"), k).alias(k.lower()) for k in keys])


def header_schema(spark, sf):
    """Keys and types of every image."""
    return X.image_schema(_variants(spark, sf))


def header_schema_merged(spark, sf):
    """Keys and types that hold for all images of an exposure."""
    return X.merged_schema(_variants(spark, sf), "exposure_id")


def split_header(spark, sf):
    """One-image files made from the cards of every image: each becomes the headers of two amplifiers."""
    name = F.concat_ws("_", F.concat(F.lit("f"), F.col("exposure_id")), F.col("image_no").cast("string"))
    h = V.headers(spark, sf).withColumn("file_path", name)
    names = {"CLICK": "CCD0GAIN", "ERROR": "CCD1GAIN", "PURCHASE": "CCDSEC0", "SIGNUP": "DETTEMP"}
    renamed = h.replace(names, subset=["key"]).select("file_path", "key", *H.VALUE_COLUMNS)
    sections = {"DATASEC0": "[1:20,1:64]", "DATASEC1": "[45:26,1:64]", "BIASSEC0": "[21:25,1:60]", "BIASSEC1": "[46:50,1:60]"}
    cards = F.explode(F.array(*[F.struct(F.lit(k).alias("key"), F.lit(v).alias("value_str")) for k, v in sections.items()]))
    fixed = renamed.select("file_path").distinct().select("file_path", cards.alias("c")).select(
        "file_path", "c.key", F.lit("str").alias("vtype"), "c.value_str",
        F.lit(None).cast("double").alias("value_double"), F.lit(None).cast("boolean").alias("value_bool"),
    )
    return H.split_header(renamed.unionByName(fixed)).select("file_path", "amp", "key", *H.VALUE_COLUMNS)


QUERIES = {
    f.__name__: f
    for f in (
        weather_parse, weather_latest, weather_merge, weather_fresh, weather_report, weather_years, weather_quality,
        runlog_events, header_typed, header_get, header_pivot, header_merge_first, header_merge_last,
        header_merge_maps, header_defaults, header_get_bool, header_get_str, split_header,
        header_variant_get, header_variant_pivot, header_schema, header_schema_merged,
    )
}

_W = "time, wind_speed, wind_direction, temperature, relative_humidity, pressure"
_TEXT = """
shown AS (SELECT exposure_id, image_no, key, CASE vtype WHEN 'str' THEN value_str
  WHEN 'int' THEN CAST(CAST(value_double AS BIGINT) AS VARCHAR) WHEN 'bool' THEN CAST(value_bool AS VARCHAR) WHEN 'float' THEN CAST(value_double AS VARCHAR) END AS value
  FROM headers)"""

_SCHEMA = "'OBJECT<' || string_agg(key || ': ' || kind, ', ' ORDER BY key) || '>'"
_KIND = "CASE vtype WHEN 'int' THEN 'BIGINT' WHEN 'float' THEN 'DOUBLE' WHEN 'bool' THEN 'BOOLEAN' ELSE 'STRING' END"

ORACLE = {
    "weather_parse": _q(V.WEATHER_SQL, select=f"SELECT {_W}, source_rank, line_no FROM weather"),
    "weather_latest": _q(V.WEATHER_SQL, select=f"SELECT {_W}, source_rank, line_no FROM newest"),
    "weather_merge": _q(V.WEATHER_SQL, select=f"SELECT {_W} FROM newest"),
    "weather_fresh": _q(
        V.WEATHER_SQL,
        select="SELECT coalesce(bool_or(time > TIMESTAMP '2024-01-31 09:58:00' - INTERVAL 5 MINUTE), false) AS fresh FROM weather",
    ),
    "weather_report": _q(
        V.WEATHER_SQL,
        "recent AS (SELECT * FROM newest WHERE time BETWEEN TIMESTAMP '2024-01-31 09:58:00' - INTERVAL 30 DAY AND TIMESTAMP '2024-01-31 09:58:00')",
        select=" UNION ALL ".join(
            f"SELECT time, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM recent WHERE {m} IS NOT NULL"
            for m in schemas.WEATHER_METRICS
        ),
    ),
    "weather_years": """
SELECT event_id AS line_no, 'wx.' || (2022 + event_id % 3) || '.dat' AS file_path FROM events WHERE event_id % 3 IN (1, 2)""",
    "weather_quality": _q(
        V.WEATHER_SQL,
        select="""SELECT 'unique' AS rule, strftime(time, '%Y-%m-%d %H:%M') AS key, CAST(count(*) AS VARCHAR) AS detail
FROM weather GROUP BY time HAVING count(*) > 1
UNION ALL SELECT 'not_null', CAST(line_no AS VARCHAR), 'temperature' FROM weather WHERE line_no % 10 = 0""",
    ),
    "runlog_events": """
SELECT CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'R' END AS channel, date_trunc('second', ts) AS time, 'UTC' AS zone
FROM events WHERE event_type NOT IN ('error', 'view')""",
    "header_typed": _q(
        V.HEADERS_SQL,
        select="""
SELECT exposure_id, image_no, key,
  CAST(CASE WHEN vtype = 'bool' THEN CAST(value_bool AS INTEGER) WHEN vtype <> 'str' THEN trunc(value_double) END AS BIGINT) AS as_int,
  CAST(CASE WHEN vtype = 'bool' THEN CAST(value_bool AS INTEGER) WHEN vtype <> 'str' THEN value_double END AS DOUBLE) AS as_float,
  CASE WHEN vtype = 'bool' THEN value_bool END AS as_bool, CASE WHEN vtype = 'str' THEN value_str END AS as_str FROM headers""",
    ),
    "header_get": _q(
        V.HEADERS_SQL,
        select="""
SELECT i.exposure_id, i.image_no, coalesce(CASE WHEN vtype = 'bool' THEN CAST(CAST(value_bool AS INTEGER) AS DOUBLE)
  WHEN vtype <> 'str' THEN value_double END, -1.0) AS value
FROM (SELECT DISTINCT exposure_id, image_no FROM headers) i
LEFT JOIN (SELECT * FROM headers WHERE key = 'PURCHASE') h USING (exposure_id, image_no)""",
    ),
    "header_pivot": _q(
        V.HEADERS_SQL, _TEXT,
        select="SELECT exposure_id, image_no, "
        + ", ".join(
            f"max(value) FILTER (key = '{k}') AS {k.lower()}" for k in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")
        )
        + " FROM shown GROUP BY ALL",
    ),
    "header_variant_get": _q(
        V.HEADERS_SQL,
        """typed AS (
  SELECT *, CASE vtype WHEN 'bool' THEN CAST(CAST(value_bool AS INTEGER) AS DOUBLE) WHEN 'str' THEN NULL ELSE value_double END AS number FROM headers)""",
        select="""
SELECT exposure_id, image_no, coalesce(max(number) FILTER (key = 'PURCHASE'), -1.0) AS number,
  CAST(trunc(max(number) FILTER (key = 'ERROR')) AS BIGINT) AS whole,
  coalesce(bool_or(value_bool) FILTER (key = 'CLICK'), true) AS flag,
  coalesce(max(value_str) FILTER (key = 'SIGNUP'), 'unknown') AS text, max(vtype) FILTER (key = 'VIEW') AS kind
FROM typed GROUP BY ALL""",
    ),
    "header_variant_pivot": _q(
        V.HEADERS_SQL, _TEXT,
        select="SELECT exposure_id, image_no, "
        + ", ".join(
            f"max(value) FILTER (key = '{k}') AS {k.lower()}" for k in ("CLICK", "ERROR", "PURCHASE", "SIGNUP", "VIEW")
        )
        + " FROM shown GROUP BY ALL",
    ),
    "header_schema": _q(
        V.HEADERS_SQL,
        select=f"SELECT exposure_id, image_no, {_SCHEMA} AS schema FROM (SELECT *, {_KIND} AS kind FROM headers) GROUP BY ALL",
    ),
    "header_schema_merged": _q(
        V.HEADERS_SQL,
        f"""kinds AS (
  SELECT exposure_id, key, CASE WHEN count(DISTINCT vtype) = 1 THEN max({_KIND})
    WHEN bool_and(vtype IN ('int', 'float')) THEN 'DOUBLE' ELSE 'VARIANT' END AS kind FROM headers GROUP BY ALL)""",
        select=f"SELECT exposure_id, {_SCHEMA} AS schema FROM kinds GROUP BY ALL",
    ),
    "header_merge_first": _q(
        V.HEADERS_SQL,
        select="""SELECT exposure_id, key, vtype, value_str, value_double, value_bool FROM headers
QUALIFY row_number() OVER (PARTITION BY exposure_id, key ORDER BY image_no) = 1""",
    ),
    "header_merge_last": _q(
        V.HEADERS_SQL,
        select="""SELECT exposure_id, key, vtype, value_str, value_double, value_bool FROM headers
QUALIFY row_number() OVER (PARTITION BY exposure_id, key ORDER BY image_no DESC) = 1""",
    ),
    "header_merge_maps": _q(
        V.HEADERS_SQL, _TEXT,
        select="""SELECT exposure_id, key, value FROM shown
QUALIFY row_number() OVER (PARTITION BY exposure_id, key ORDER BY image_no DESC) = 1""",
    ),
    "header_defaults": _q(
        V.HEADERS_SQL, _TEXT,
        select="""
SELECT exposure_id, image_no, key, value FROM shown
UNION ALL
SELECT e.exposure_id, e.image_no, d.key, d.value FROM (SELECT DISTINCT exposure_id, image_no FROM shown) e,
  (VALUES ('VIEW', 'none'), ('GAIN', '1')) AS d(key, value)
WHERE NOT EXISTS (FROM shown s WHERE s.image_no = e.image_no AND s.exposure_id = e.exposure_id AND s.key = d.key)""",
    ),
    **{
        name: _q(
            V.HEADERS_SQL,
            select=f"""SELECT i.exposure_id, i.image_no, h.{column} AS plain, coalesce(h.{column}, {default}) AS value
FROM (SELECT DISTINCT exposure_id, image_no FROM headers) i
LEFT JOIN (SELECT * FROM headers WHERE key = '{key}' AND vtype = '{kind}') h USING (exposure_id, image_no)""",
        )
        for name, key, kind, column, default in (
            ("header_get_bool", "CLICK", "bool", "value_bool", "true"),
            ("header_get_str", "SIGNUP", "str", "value_str", "'unknown'"),
        )
    },
    "split_header": _q(
        V.HEADERS_SQL,
        """cards AS (
  SELECT 'f' || exposure_id || '_' || image_no AS file_path, CASE key WHEN 'CLICK' THEN 'CCD0GAIN' WHEN 'ERROR' THEN 'CCD1GAIN'
    WHEN 'PURCHASE' THEN 'CCDSEC0' WHEN 'SIGNUP' THEN 'DETTEMP' ELSE key END AS key, vtype, value_str, value_double, value_bool
  FROM headers),
sections AS (SELECT file_path, k AS key, v AS value_str FROM (SELECT DISTINCT file_path FROM cards),
  (VALUES ('DATASEC0', '[1:20,1:64]'), ('DATASEC1', '[45:26,1:64]'), ('BIASSEC0', '[21:25,1:60]'), ('BIASSEC1', '[46:50,1:60]')) AS s(k, v)),
amps AS (SELECT unnest([0, 1])::INTEGER AS amp)""",
        select="""
SELECT file_path, amp, key, vtype, value_str, value_double, value_bool FROM cards, amps
UNION ALL SELECT file_path, amp, key, 'str', value_str, NULL, NULL FROM sections, amps
UNION ALL SELECT file_path, CAST(key[4] AS INTEGER), 'ORIGINAL_GAIN', vtype, value_str, value_double, value_bool
  FROM cards WHERE key IN ('CCD0GAIN', 'CCD1GAIN')
UNION ALL SELECT file_path, 0, 'CCDSEC', vtype, value_str, value_double, value_bool FROM cards WHERE key = 'CCDSEC0'
UNION ALL SELECT DISTINCT file_path, amp, 'CCDNAMP', 'int', NULL, 1.0, NULL FROM cards, amps
UNION ALL SELECT DISTINCT file_path, amp, 'DATASEC', 'str', '[1:20,1:64]', NULL, NULL FROM cards, amps
UNION ALL SELECT DISTINCT file_path, amp, 'BIASSEC', 'str', '[1:5,65:124]', NULL, NULL FROM cards, amps
UNION ALL SELECT file_path, amp, 'CCDTEMP', 'float', NULL, value_double, NULL FROM cards, amps
  WHERE key = 'DETTEMP' AND value_double IS NOT NULL""",
    ),
}
