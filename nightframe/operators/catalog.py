"""The file catalogue."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, TimestampType

from nightframe import schemas
from nightframe.functions import paths, times


#: Column of a batch's entries that names what could not be read; it is written beside the catalogue's columns.
UNREADABLE = "unreadable"


def visible_files(files: DataFrame) -> DataFrame:
    """Files of a listing that count: at least one folder deep and not a note."""
    path = F.col("file_path")
    return files.filter((paths.segments(path) >= 2) & (paths.suffix(path) != ".md"))


def new_files(listing: DataFrame, catalog: DataFrame | None, refresh: bool = False) -> DataFrame:
    """Files not analysed yet. Runs on the listing alone, before any byte is read."""
    if catalog is None or refresh:
        return listing
    return listing.join(catalog.select("file_path"), "file_path", "left_anti")


# ------------------------------------------------------------------ from headers to columns


def _header_type(name: str):
    return next(f.dataType for f in schemas.CATALOG if f.name == name)


def header_facts(header: DataFrame) -> DataFrame:
    """What the headers of a file say, one row per file: catalogue columns, numbers of HDUs, unreadable cards.

    Card names are matched without regard to case and strings are stripped. One aggregation gives all of it, so
    the files are decoded once; it is partial before the exchange, whatever number of rows a file has.
    ``unreadable`` lists the wanted cards of the primary header whose value isn't of the column's type.
    """
    wanted = {
        c: schemas.HEADER_CARDS.get(c, c).upper()
        for c in schemas.CATALOG.names
        if c not in schemas.NOT_FROM_HEADER
    }
    key = F.upper("key")
    primary = (F.col("hdu") == 0) & key.isin(*wanted.values())
    text = F.regexp_replace("value_str", r"^\s+|\s+$", "")
    number, vtype = F.col("value_double"), F.col("vtype")
    shown = F.when(vtype == "str", text).when(vtype == "int", number.cast("long").cast("string"))
    shown = shown.when(vtype == "float", number.cast("string")).when(
        vtype == "bool", F.col("value_bool").cast("string")
    )
    rows = header.select(
        "file_path",
        "hdu",
        "has_data",
        F.when(primary, key).alias("_key"),
        shown.alias("_text"),
        F.coalesce(number, text.try_cast("double")).alias("_number"),
        times.header_time(vtype, number, text).alias("_time"),
    )
    columns, unreadable = [], []
    for name, card in wanted.items():
        source = {StringType: "_text", DoubleType: "_number", TimestampType: "_time"}[type(_header_type(name))]
        own = F.col("_key") == card
        columns.append(F.max(F.when(own, F.col(source))).alias(name))
        if source != "_text":
            lost = own & F.col(source).isNull() & F.col("_text").isNotNull()
            unreadable.append(F.max(F.when(lost, F.concat(F.lit(f"{card}="), F.col("_text")))))
    return rows.groupBy("file_path").agg(
        *columns,
        (F.max("hdu") + 1).cast("int").alias("num_extensions"),
        F.size(F.collect_set(F.when(F.col("has_data"), F.col("hdu")))).cast("int").alias("num_data_extensions"),
        F.array_compact(F.array(*unreadable)).alias("unreadable"),
    )


def file_facts(files: DataFrame, added: datetime | Column) -> DataFrame:
    """Name, size and ingest time; one ingest time per batch."""
    added = added if isinstance(added, Column) else F.lit(added)
    return files.select(
        "file_path",
        paths.file_name(F.col("file_path")).alias("file_name"),
        added.alias("time_added"),
        (F.col("length") / F.lit(1048576.0)).alias("size_mb"),
    )


def reclassify_rasters(entries: DataFrame) -> DataFrame:
    """A flat below the size limit is a raster readout."""
    small = (F.col("type") == schemas.CONTINUUM) & (F.col("size_mb") < schemas.RASTER_BELOW_MB)
    return entries.withColumn("type", F.when(small, schemas.RASTER).otherwise(F.col("type")))


def entries(facts: DataFrame, header: DataFrame | None = None) -> DataFrame:
    """Catalogue rows of a batch: path values win over file facts, which win over headers.

    Column ``unreadable`` lists header cards and path values that aren't of their column's type; it is
    null if there are none.
    """
    e = facts
    if header is not None:
        e = e.join(header_facts(header), "file_path", "left")
    e = e.withColumn("_path", paths.partition_values(F.col("file_path")))
    columns, lost = {}, []
    for field in schemas.CATALOG:
        from_path = F.col("_path")[field.name]
        if not isinstance(field.dataType, StringType):
            told = from_path
            from_path = told.try_cast(field.dataType)
            bad = told.isNotNull() & from_path.isNull()
            lost.append(F.when(bad, F.concat(F.lit(f"{field.name}="), told)))
        known = F.col(field.name) if field.name in e.columns else F.lit(None)
        columns[field.name] = F.coalesce(from_path, known.cast(field.dataType))
    if header is not None:
        lost.append(F.array_join("unreadable", ", "))
    lost = F.array_compact(F.array(*[F.nullif(c, F.lit("")) for c in lost]))
    columns[UNREADABLE] = F.nullif(F.array_join(lost, ", "), F.lit(""))
    e = reclassify_rasters(e.withColumns(columns))
    return e.select(*schemas.CATALOG.names, UNREADABLE)


# ------------------------------------------------------------------ merging


def ragged_union(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name: missing columns become null, numbers widen, text wins over numbers."""
    types = {f.name: f.dataType for f in old.schema}
    changed = [
        f.name
        for f in new.schema
        if f.name in types
        and f.dataType != types[f.name]
        and isinstance(f.dataType, StringType) != isinstance(types[f.name], StringType)
    ]
    as_text = {c: F.col(c).cast("string") for c in changed}
    if changed:
        old, new = old.withColumns(as_text), new.withColumns(as_text)
    return old.unionByName(new, allowMissingColumns=True)


def latest(rows: DataFrame, key: str = "file_path", order: tuple[str, ...] = ("time_added", "batch_no")) -> DataFrame:
    """Last row per key. Spark drops losers before the exchange, so a hot key stays cheap."""
    w = Window.partitionBy(key).orderBy(*[F.desc_nulls_last(c) for c in order])
    return rows.withColumn("_n", F.row_number().over(w)).filter("_n = 1").drop("_n")


def merge(catalog: DataFrame | None, fresh: DataFrame) -> DataFrame:
    """Old and new rows, last one per path; on equal ingest times the new batch wins."""
    fresh = fresh.withColumn("batch_no", F.lit(1))
    both = fresh if catalog is None else ragged_union(catalog.withColumn("batch_no", F.lit(0)), fresh)
    return latest(both).drop("batch_no")


def present(catalog: DataFrame, listing: DataFrame) -> DataFrame:
    """Rows whose file is still listed and whose type is known."""
    return catalog.join(listing.select("file_path"), "file_path", "left_semi").dropna(subset=["type"])


def refreshed(
    catalog: DataFrame | None, fresh: DataFrame, listing: DataFrame, refresh: bool = False
) -> DataFrame:
    """Incremental refresh: merge, then drop deleted files and rows without type."""
    return present(merge(None if refresh else catalog, fresh), listing)


def conform(rows: DataFrame) -> DataFrame:
    """Exactly the catalogue's columns and types, missing ones null; and ``unreadable`` if the rows have it."""
    columns = []
    for f in schemas.CATALOG:
        c = F.col(f.name) if f.name in rows.columns else F.lit(None)
        c = c.cast(f.dataType)
        columns.append((times.milliseconds(c) if isinstance(f.dataType, TimestampType) else c).alias(f.name))
    return rows.select(*columns, *[c for c in (UNREADABLE,) if c in rows.columns])


def lookup(requested: DataFrame, catalog: DataFrame, strict: bool = True) -> DataFrame:
    """Catalogue rows of requested paths. Not found or found twice is an error when strict.

    Otherwise ``matches`` tells: 0, 1 or more.
    """
    wanted = requested.select("file_path")
    sizes = catalog.groupBy("file_path").agg(F.count("*").alias("matches"))
    found = wanted.join(sizes, "file_path", "left").join(catalog, "file_path", "left")
    found = found.withColumn("matches", F.coalesce("matches", F.lit(0)))
    if strict:
        name = F.col("file_path")
        found = found.withColumn(
            "file_path",
            F.when(F.col("matches") == 1, name)
            .when(F.col("matches") == 0, F.raise_error(F.concat(F.lit("not in catalogue: "), name)).cast("string"))
            .otherwise(F.raise_error(F.concat(F.lit("several records for "), name)).cast("string")),
        )
    return found


def absolute_path(root: str, path: Column) -> Column:
    return F.concat_ws("/", F.lit(root.rstrip("/")), path)


def counts(catalog: DataFrame) -> DataFrame:
    """Rows per type and channel, for reports."""
    return catalog.groupBy("type", "channel").agg(F.count("*").alias("files"))


# ------------------------------------------------------------------ change detection


def fingerprint(rows: DataFrame, ignore: tuple[str, ...] = ("time_added", UNREADABLE)) -> DataFrame:
    """One row that changes when the content changes, whatever the row order.

    Combines row digests by sum and by xor, so it aggregates partially on every executor.
    """
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in sorted(rows.columns) if c not in ignore]
    digest = F.conv(F.substring(F.md5(F.concat_ws("\u001f", *cells)), 1, 15), 16, 10).cast("long")
    return rows.select(digest.alias("_d")).agg(
        F.count("*").alias("rows"),
        F.sum(F.col("_d").cast("decimal(28,0)")).cast("decimal(38,0)").alias("digest_sum"),
        F.bit_xor("_d").alias("digest_xor"),
    )


def upsert(catalog: DataFrame, changed: DataFrame) -> DataFrame:
    """Catalogue with the given entries added or replaced."""
    return merge(catalog, changed)


def differs(old: DataFrame, new: DataFrame) -> bool:
    """Whether two catalogues differ in content; moves two fingerprint rows to the driver."""
    return old.transform(fingerprint).first() != new.select(*[c for c in old.columns if c in new.columns]).transform(fingerprint).first()


def moved_fingerprint(known: dict, removed: DataFrame, added: DataFrame) -> dict:
    """The fingerprint of a catalogue after rows are removed and added, from the ``known`` one and these rows alone.

    Sums and xor can be undone, so nothing else of the catalogue is read.
    """
    now = {k: int(v) for k, v in known.items()}
    for rows, sign in ((removed, -1), (added, 1)):
        part = rows.transform(fingerprint).first().asDict()
        now["rows"] += sign * part["rows"]
        now["digest_sum"] += sign * int(part["digest_sum"] or 0)
        now["digest_xor"] ^= part["digest_xor"] or 0
    return {k: str(v) for k, v in now.items()}


def replaced_by(catalog: DataFrame, fresh: DataFrame, replaces: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that an upsert of ``fresh`` takes from the catalogue, and rows that it puts there: those of the same paths after the merge.

    Entries whose path starts with ``replaces`` go first.
    """
    gone = catalog.filter(F.startswith("file_path", F.lit(replaces))) if replaces is not None else catalog.limit(0)
    rest = catalog.filter(~F.startswith("file_path", F.lit(replaces))) if replaces is not None else catalog
    same = rest.join(fresh.select("file_path").distinct(), "file_path", "left_semi")
    return gone.unionByName(same), conform(merge(same, fresh))
