"""Queries on the catalogue and on matching."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe import schemas
from nightframe.functions import paths, times
from nightframe.operators import catalog as C
from nightframe.operators import match as M
from nightframe.operators import quality as DQ
from nightframe.plans import reduce as R
from nightframe.registry import detector as RD
from nightframe.registry import views as V
from nightframe.registry.detector import _CHAIN, _q, r4

COLUMNS = ("file_path", "type", "object", "run_id", "channel", "size_mb", "time_added")


def _catalog(spark: SparkSession, sf: str) -> DataFrame:
    """The view's catalogue after dedup, pruning and raster re-classification."""
    kept = C.present(C.latest(V.catalog_entries(spark, sf)), V.listing(spark, sf))
    return C.reclassify_rasters(kept)


def _primaries(spark, sf):
    return _catalog(spark, sf).filter(F.col("type") == schemas.SCIENCE)


def path_partitions(spark, sf):
    p = V.catalog_entries(spark, sf).select("file_path").distinct()
    return p.select(
        "file_path",
        paths.file_name(F.col("file_path")).alias("file_name"),
        paths.suffix(F.col("file_path")).alias("suffix"),
        F.explode(paths.partition_values(F.col("file_path"))).alias("key", "value"),
    )


def raster_reclass(spark, sf):
    e = C.reclassify_rasters(V.catalog_entries(spark, sf))
    return e.select("batch_no", "file_path", "type", "size_mb")


def catalog_latest(spark, sf):
    return C.latest(V.catalog_entries(spark, sf)).select(*COLUMNS, "batch_no")


def _halves(spark, sf):
    """Old and new rows; the new ones lack a column and have a numeric run."""
    e = V.catalog_entries(spark, sf)
    median = F.expr("batch_no % 2 = 0")
    old = e.filter(median).select(*COLUMNS)
    new = e.filter(~median).select(*COLUMNS).drop("object").withColumn("run_id", F.col("run_id").cast("int"))
    return old, new


def catalog_merge(spark, sf):
    old, new = _halves(spark, sf)
    return C.merge(C.latest(old, order=("time_added",)), C.latest(new, order=("time_added",)))


def catalog_refresh(spark, sf):
    old, new = _halves(spark, sf)
    return C.refreshed(
        C.latest(old, order=("time_added",)), C.latest(new, order=("time_added",)), V.listing(spark, sf)
    )


def catalog_upsert(spark, sf):
    """Every entry of the newer half, added to or replacing those of the catalogue."""
    old, new = _halves(spark, sf)
    return C.upsert(C.latest(old, order=("time_added",)), C.latest(new, order=("time_added",)))


def catalog_prune_deleted(spark, sf):
    return C.present(V.catalog_entries(spark, sf), V.listing(spark, sf)).select(*COLUMNS, "batch_no")


def catalog_anti_new(spark, sf):
    """Listed files that no typed catalogue row knows."""
    known = V.catalog_entries(spark, sf).filter(F.col("type").isNotNull())
    return C.new_files(V.listing(spark, sf), known)


def catalog_lookup(spark, sf):
    """Every listed path looked up among the typed files, found or not."""
    typed = C.latest(V.catalog_entries(spark, sf)).filter(F.col("type").isNotNull())
    found = C.lookup(V.listing(spark, sf), typed, strict=False)
    return found.select("file_path", "matches", "type", "run_id")


def catalog_counts(spark, sf):
    return C.counts(_catalog(spark, sf))


def catalog_sorted(spark, sf):
    """Catalogue in storage order, with absolute paths."""
    c = _catalog(spark, sf).orderBy("file_path")
    return c.select("file_path", C.absolute_path("/data", F.col("file_path")).alias("absolute_path"))


def catalog_fingerprint(spark, sf):
    return C.fingerprint(_catalog(spark, sf).select("file_path", "type", "object", "run_id", "channel"))


def dq_violations(spark, sf):
    e = V.catalog_entries(spark, sf)
    numbers = e.withColumn("object_number", F.regexp_replace("object", "obj[0-2]", "9"))
    return DQ.both(
        DQ.unique(e, "file_path"),
        DQ.not_null(e, "batch_no", ("file_path", "type", "object", "time_added")),
        DQ.in_domain(e.withColumn("type", F.when(F.col("size_mb") == 3, "DARK").otherwise(F.col("type"))),
                     "batch_no", "type", schemas.FILE_TYPES),
        DQ.castable(numbers, "batch_no", {"object_number": "int", "run_id": "int"}),
    )


def dq_two_images(spark, sf):
    """Exposures of events with other than two distinct image numbers."""
    e = V.table(spark, sf, "events").select(
        F.col("user_id").alias("exposure_id"), (F.col("event_id") % 4).alias("amp")
    )
    return DQ.two_images(e)


# ------------------------------------------------------------------ matching


def _summary(spark, sf, file_type):
    found = M.first_match(file_type, _primaries(spark, sf), _catalog(spark, sf))
    return found.select("file_path", *M.registry.rule(file_type).keys, "n_matches", "match_path")


def match_arc(spark, sf):
    return _summary(spark, sf, schemas.ARC)


def match_flats(spark, sf):
    return _summary(spark, sf, schemas.CONTINUUM)


def match_model(spark, sf):
    return _summary(spark, sf, schemas.BINARY_OFFSET_MODEL)


def match_first(spark, sf):
    """First match of every global rule for every primary."""
    p, c = _primaries(spark, sf).select("file_path"), _catalog(spark, sf)
    parts = [M.first_match(t, p, c).withColumn("type", F.lit(t)) for t in (schemas.RAW_LOGS, schemas.WEATHER)]
    return parts[0].unionByName(parts[1]).select("file_path", "type", "n_matches", "match_path")


def match_members(spark, sf):
    """All members of all arc and flat match sets."""
    c = _catalog(spark, sf)
    parts = [M.members(t, c).withColumn("type", F.lit(t)) for t in (schemas.ARC, schemas.CONTINUUM)]
    return parts[0].unionByName(parts[1])


def match_global(spark, sf):
    c = _catalog(spark, sf)
    parts = [M.members(t, c).withColumn("type", F.lit(t)) for t in (schemas.RAW_LOGS, schemas.WEATHER)]
    return parts[0].unionByName(parts[1])


def match_all(spark, sf):
    """Every arc of every primary, as pairs."""
    return M.all_matches(schemas.ARC, _primaries(spark, sf), _catalog(spark, sf))


def resolve_flats(spark, sf):
    """Every flat of every primary, as pairs; given lists win."""
    return M.continuum_files(_given(spark, sf), _catalog(spark, sf))


def _given(spark, sf):
    """Primaries of which some come with an explicit arc or flat list."""
    p = _primaries(spark, sf)
    return p.withColumns(
        {
            "arc_file": F.when(F.col("f") % 36 == 0, "given/arc.fits"),
            "continuum_files": F.when(F.col("f") % 24 == 0, F.array(F.lit("given/a.fits"), F.lit("given/b.fits"))).otherwise(
                F.array().cast("array<string>")
            ),
        }
    )


def resolve_science(spark, sf):
    r = M.resolve_science(_given(spark, sf), _catalog(spark, sf))
    return r.select("file_path", "run_id", "object", "channel", "arc_file", "weather_file", "n_flats", "first_flat")


def resolve_continuum(spark, sf):
    c = _catalog(spark, sf)
    r = M.resolve_continuum(c.filter(F.col("type") == schemas.CONTINUUM), c)
    return r.select("file_path", "arc_file", "weather_file")


def _exposures_of_files(spark, sf, primaries):
    """Each primary's exposure: files are dealt to the exposures there are."""
    n = V.lines(spark, sf).agg((F.max("exposure_id") + 1).alias("n")).scalar()
    return primaries.withColumn("exposure_id", F.col("f") % n)


def reduce_science(spark, sf):
    p = _exposures_of_files(spark, sf, _given(spark, sf))
    inputs, pixels = R.reduce_science(p, _catalog(spark, sf), V.lines(spark, sf), RD._models(spark))
    return R.with_image_summary(inputs, pixels).select(
        "file_path", "exposure_id", "arc_file", "weather_file", "n_flats", "first_flat",
        "pixels", "saturated", r4("mean_value").alias("mean_value"),
    )


def reduce_continuum(spark, sf):
    c = _catalog(spark, sf)
    p = _exposures_of_files(spark, sf, c.filter(F.col("type") == schemas.CONTINUUM))
    inputs, pixels = R.reduce_continuum(p, c, V.lines(spark, sf), RD._models(spark))
    return R.with_image_summary(inputs, pixels).select(
        "file_path", "exposure_id", "arc_file", "weather_file", "pixels", "saturated",
        r4("mean_value").alias("mean_value"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        path_partitions, raster_reclass, catalog_latest, catalog_merge, catalog_refresh, catalog_prune_deleted,
        catalog_anti_new, catalog_lookup, catalog_counts, catalog_sorted, catalog_fingerprint, dq_violations,
        dq_two_images, match_arc, match_flats, match_model, match_first, match_members, match_global,
        catalog_upsert, match_all, resolve_flats, resolve_science, resolve_continuum, reduce_science, reduce_continuum,
    )
}

_COLS = ", ".join(COLUMNS)
_HALVES = """
old AS (SELECT * FROM entries WHERE batch_no % 2 = 0
        QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY time_added DESC) = 1),
new AS (SELECT * REPLACE (NULL AS object) FROM entries WHERE batch_no % 2 = 1
        QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY time_added DESC) = 1),
merged AS (SELECT * FROM (SELECT 0 AS k, * FROM old UNION ALL SELECT 1 AS k, * FROM new)
           QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY time_added DESC, k DESC) = 1)"""


def _match_sql(file_type: str, keys: str) -> str:
    on = " AND ".join(f"s.{k} = p.{k}" for k in keys.split(", "))
    shown = ", ".join(f"p.{k}" for k in keys.split(", "))
    return _q(
        V.CATALOG_SQL,
        f"sets AS (SELECT {keys}, count(*) AS n_matches, min(file_path) AS match_path FROM catalog "
        f"WHERE type = '{file_type}' GROUP BY {keys})",
        select=f"SELECT p.file_path, {shown}, coalesce(n_matches, 0) AS n_matches, match_path "
        f"FROM catalog p LEFT JOIN sets s ON {on} WHERE p.type = 'OBJECT'",
    )


_RESOLVED = """
arcs AS (SELECT run_id, object, channel, min(file_path) AS arc FROM catalog WHERE type = 'ARC' GROUP BY ALL),
flats AS (SELECT run_id, object, channel, count(*) AS n, min(file_path) AS flat FROM catalog WHERE type = 'FLAT' GROUP BY ALL),
science AS (
  SELECT p.*, CASE WHEN p.f % 36 = 0 THEN 'given/arc.fits' ELSE a.arc END AS arc_file,
    (SELECT min(file_path) FROM catalog WHERE type = 'WEATHER') AS weather_file,
    CASE WHEN p.f % 24 = 0 THEN 2 ELSE coalesce(n, 0) END AS n_flats,
    CASE WHEN p.f % 24 = 0 THEN 'given/a.fits' ELSE flat END AS first_flat
  FROM catalog p
  LEFT JOIN arcs a ON a.run_id = p.run_id AND a.object = p.object AND a.channel = p.channel
  LEFT JOIN flats t ON t.run_id = p.run_id AND t.object = p.object AND t.channel = p.channel
  WHERE p.type = 'OBJECT'
),
continuum AS (
  SELECT p.*, a.arc AS arc_file, (SELECT min(file_path) FROM catalog WHERE type = 'WEATHER') AS weather_file
  FROM catalog p LEFT JOIN arcs a ON a.run_id = p.run_id AND a.object = p.object AND a.channel = p.channel
  WHERE p.type = 'FLAT'
)"""
_SUMMARY = """
summary AS (
  SELECT exposure_id, count(*) AS pixels, count(*) FILTER (variance = 'inf') AS saturated,
         round(avg(value), 4) + 0.0 AS mean_value
  FROM (SELECT exposure_id, variance, value FROM corrected_exact) GROUP BY exposure_id
)"""
_EXACT = """
corrected_exact AS (
  SELECT e.exposure_id, e.value - (e.x * r.multiplier + r."offset") AS value,
         CASE WHEN k.saturated THEN CAST('inf' AS DOUBLE) ELSE CAST(k.raw AS DOUBLE) END AS variance
  FROM even_odd e JOIN masked k USING (exposure_id, amp, x, y) JOIN ramp r USING (exposure_id, amp, y)
)"""


def _reduce_sql(source: str, shown: str) -> str:
    return _q(
        V.CATALOG_SQL, _RESOLVED, *_CHAIN[:-1], _EXACT, _SUMMARY,
        f"dealt AS (SELECT *, f % (SELECT max(vec_id) // 50 + 1 FROM embeddings) AS exposure_id FROM {source})",
        select=f"SELECT file_path, exposure_id, {shown}, pixels, saturated, mean_value FROM dealt LEFT JOIN summary USING (exposure_id)",
    )


ORACLE = {
    "path_partitions": _q(
        V.CATALOG_SQL,
        select="""
SELECT file_path, 'f' || f || '.fits' AS file_name, '.fits' AS suffix, k AS key,
       CASE k WHEN 'run_id' THEN run_id ELSE channel END AS value
FROM (SELECT DISTINCT file_path, f, run_id, channel FROM entries), (VALUES ('run_id'), ('channel')) AS t(k)""",
    ),
    "raster_reclass": _q(
        V.CATALOG_SQL,
        select="""SELECT batch_no, file_path, CASE WHEN type = 'FLAT' AND size_mb < 8 THEN 'RASTER' ELSE type END AS type,
  size_mb FROM entries""",
    ),
    "catalog_latest": _q(V.CATALOG_SQL, select=f"SELECT {_COLS}, batch_no FROM latest"),
    "catalog_merge": _q(V.CATALOG_SQL, _HALVES, select=f"SELECT {_COLS} FROM merged"),
    "catalog_refresh": _q(
        V.CATALOG_SQL, _HALVES,
        select=f"SELECT {_COLS} FROM merged WHERE type IS NOT NULL AND file_path IN (SELECT file_path FROM listing)",
    ),
    "catalog_prune_deleted": _q(
        V.CATALOG_SQL, select=f"SELECT {_COLS}, batch_no FROM entries WHERE type IS NOT NULL AND f % 7 <> 0"
    ),
    "catalog_anti_new": _q(
        V.CATALOG_SQL,
        select="SELECT file_path FROM listing WHERE file_path NOT IN (SELECT file_path FROM entries WHERE type IS NOT NULL)",
    ),
    "catalog_lookup": _q(
        V.CATALOG_SQL,
        select="""SELECT l.file_path, CASE WHEN e.file_path IS NULL THEN 0 ELSE 1 END::BIGINT AS matches, e.type, e.run_id
  FROM listing l LEFT JOIN (SELECT * FROM latest WHERE type IS NOT NULL) e USING (file_path)""",
    ),
    "catalog_counts": _q(V.CATALOG_SQL, select="SELECT type, channel, count(*) AS files FROM catalog GROUP BY ALL"),
    "catalog_sorted": _q(
        V.CATALOG_SQL, select="SELECT file_path, '/data/' || file_path AS absolute_path FROM catalog ORDER BY file_path"
    ),
    "catalog_fingerprint": _q(
        V.CATALOG_SQL,
        """digests AS (SELECT CAST('0x' || md5(concat_ws(chr(31), channel, file_path, coalesce(object, chr(0)), run_id, type))[1:15]
             AS BIGINT) AS d FROM catalog)""",
        select="""SELECT count(*) AS rows, CAST(sum(CAST(d AS DECIMAL(28,0))) AS DECIMAL(38,0)) AS digest_sum,
  bit_xor(d) AS digest_xor FROM digests""",
    ),
    "dq_violations": _q(
        V.CATALOG_SQL,
        select="""
SELECT 'unique' AS rule, file_path AS key, CAST(count(*) AS VARCHAR) AS detail FROM entries GROUP BY file_path HAVING count(*) > 1
UNION ALL SELECT 'not_null', CAST(batch_no AS VARCHAR), 'type' FROM entries WHERE type IS NULL
UNION ALL SELECT 'not_null', CAST(batch_no AS VARCHAR), 'object' FROM entries WHERE object IS NULL
UNION ALL SELECT 'domain', CAST(batch_no AS VARCHAR), 'DARK' FROM entries WHERE size_mb = 3
UNION ALL SELECT 'type', CAST(batch_no AS VARCHAR), 'object_number=' || object FROM entries WHERE object IN ('obj3', 'obj4')""",
    ),
    "dq_two_images": """
SELECT 'two_images' AS rule, CAST(user_id AS VARCHAR) AS key, CAST(count(DISTINCT event_id % 4) AS VARCHAR) AS detail
FROM events GROUP BY user_id HAVING count(DISTINCT event_id % 4) <> 2""",
    "match_arc": _match_sql("ARC", "run_id, object, channel"),
    "match_flats": _match_sql("FLAT", "run_id, object, channel"),
    "match_model": _match_sql("BINARY_OFFSET_MODEL", "channel"),
    "match_first": _q(
        V.CATALOG_SQL,
        select=" UNION ALL ".join(
            f"""SELECT file_path, '{t}' AS type, (SELECT count(*) FROM catalog WHERE type = '{t}') AS n_matches,
  (SELECT min(file_path) FROM catalog WHERE type = '{t}') AS match_path FROM catalog WHERE type = 'OBJECT'"""
            for t in ("RAW_LOGS", "WEATHER")
        ),
    ),
    "match_all": _q(
        V.CATALOG_SQL,
        select="""SELECT p.file_path, a.file_path AS match_path FROM catalog p JOIN catalog a USING (run_id, object, channel)
WHERE p.type = 'OBJECT' AND a.type = 'ARC'""",
    ),
    "resolve_flats": _q(
        V.CATALOG_SQL,
        select="""SELECT p.file_path, a.file_path AS match_path FROM catalog p JOIN catalog a USING (run_id, object, channel)
WHERE p.type = 'OBJECT' AND a.type = 'FLAT' AND p.f % 24 <> 0
UNION ALL SELECT file_path, unnest(['given/a.fits', 'given/b.fits']) FROM catalog WHERE type = 'OBJECT' AND f % 24 = 0""",
    ),
    "catalog_upsert": _q(
        V.CATALOG_SQL, _HALVES,
        f"""upserted AS (SELECT * FROM (SELECT 0 AS k, * FROM old UNION ALL SELECT 1 AS k, * FROM new)
           QUALIFY row_number() OVER (PARTITION BY file_path ORDER BY time_added DESC, k DESC) = 1)""",
        select=f"SELECT {_COLS} FROM upserted",
    ),
    "match_members": _q(
        V.CATALOG_SQL,
        select="""SELECT run_id, object, channel, file_path AS match_path, type FROM catalog
  WHERE type IN ('ARC', 'FLAT') AND object IS NOT NULL""",
    ),
    "match_global": _q(
        V.CATALOG_SQL, select="SELECT file_path AS match_path, type FROM catalog WHERE type IN ('RAW_LOGS', 'WEATHER')"
    ),
    "resolve_science": _q(
        V.CATALOG_SQL, _RESOLVED,
        select="SELECT file_path, run_id, object, channel, arc_file, weather_file, n_flats, first_flat FROM science",
    ),
    "resolve_continuum": _q(V.CATALOG_SQL, _RESOLVED, select="SELECT file_path, arc_file, weather_file FROM continuum"),
    "reduce_science": _reduce_sql("science", "arc_file, weather_file, n_flats, first_flat"),
    "reduce_continuum": _reduce_sql("continuum", "arc_file, weather_file"),
}
