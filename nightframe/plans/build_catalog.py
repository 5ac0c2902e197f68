"""Build or refresh the catalogue of a directory tree."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from nightframe.functions import paths
from nightframe.operators import catalog as C
from nightframe.operators import quality as DQ
from nightframe.sources import files, fits, sinks, storage, tree


def current_catalog(spark: SparkSession, catalog_root: str) -> DataFrame | None:
    path = sinks.latest_snapshot(spark, catalog_root)
    return None if path is None else files.read_catalog(spark, path)


def entries_of(found: DataFrame, added: datetime, header: DataFrame | None = None) -> DataFrame:
    """Catalogue entries of files ``(file_path, length, content)``; only FITS files are opened.

    With ``header``, their header rows, no content is needed.
    """
    if header is None:
        header = fits.header_rows(found.filter(is_image_file()))
    return C.entries(C.file_facts(found, added), header)


def is_image_file() -> Column:
    return paths.suffix(F.col("file_path")) == ".fits"


def refresh_catalog(
    spark: SparkSession,
    data_root: str,
    catalog_root: str,
    refresh: bool = False,
    added: datetime | None = None,
    strict: bool = False,
) -> str:
    """Bring the catalogue up to date with the tree and write it as a new snapshot.

    Executors list the tree, and only folders that have changed since the last refresh; the tree is kept in ``_tree`` beside the snapshots.
    Only files the catalogue does not know are opened, and of these the headers alone are read: the anti-join runs on the listing.
    ``refresh`` lists and re-reads everything. An empty tree gives
    an empty catalogue. A table kept in snapshots is one entry, its newest published one.
    Values that cannot be read are null and named in the snapshot's column ``unreadable``
    (``quality.unreadable``); with ``strict`` they fail the job. Returns the snapshot's folder.

    In a store that executors can't open by themselves (``storage.reachable``) Spark's own readers list and read whole files.
    """
    added = added or datetime.now(timezone.utc)
    known = None if refresh else current_catalog(spark, catalog_root)
    is_table = F.col("file_path").rlike(files.SNAPSHOT)
    if storage.reachable(data_root):
        trees = f"{catalog_root.rstrip('/')}/_tree"
        walked = tree.walk(spark, data_root, None if refresh else tree.latest_tree(spark, trees))
        walked = tree.read_tree(spark, tree.write_tree(walked, trees))
        listing = files.published_tables(spark, data_root, C.visible_files(walked.files))
        new = C.new_files(listing, known)
        images = new.filter(~is_table & is_image_file())
        fresh = entries_of(new, added, fits.header_rows_at(images, data_root))
    else:
        listing = files.published_tables(spark, data_root, files.list_files(spark, data_root))
        new = C.new_files(listing, known)
        # a table's entry is its folder: nothing of it is opened here
        plain = files.read_files(spark, data_root) if known is None else files.read_selected(spark, data_root, new.filter(~is_table))
        tables = new.filter(is_table).withColumn("content", F.lit(None).cast("binary"))
        fresh = entries_of(plain.filter(~is_table).unionByName(tables), added)
    fresh = C.conform(fresh).persist()  # files are opened once, also if another writer comes first

    def attempt(base: sinks.Head) -> str:
        old = None if refresh or base.path is None else files.read_catalog(spark, base.path)
        catalog = C.conform(C.refreshed(old, fresh, listing))
        return sinks.write_catalog(catalog, catalog_root, DQ.check_catalog_strictly if strict else DQ.check_catalog, base)

    try:
        return sinks.committed(spark, catalog_root, attempt)
    finally:
        fresh.unpersist()


def upsert_files(
    spark: SparkSession,
    found: DataFrame,
    catalog_root: str,
    added: datetime | None = None,
    replaces: str | None = None,
) -> str | None:
    """Add or replace single files; writes a new snapshot only if the content changed.

    Entries whose path starts with ``replaces`` go first. Whether the content changes is told by the rows that go and those that come: the
    fingerprint that the commit in force has noted is moved by theirs. Of two upserts at once both are kept.
    """
    added = added or datetime.now(timezone.utc)
    fresh = C.conform(entries_of(found, added)).persist()

    def attempt(base: sinks.Head) -> str | None:
        if base.path is None:
            return sinks.write_catalog(C.latest(fresh, order=("time_added",)), catalog_root, DQ.check_catalog, base)
        old = files.read_catalog(spark, base.path)
        known = base.notes or sinks.fingerprint_notes(old)
        gone, come = C.replaced_by(old, fresh, replaces)
        now = C.moved_fingerprint(known, gone, come)
        if now == known:
            return None
        rest = old if replaces is None else old.filter(~F.startswith("file_path", F.lit(replaces)))
        return sinks.write_catalog(C.conform(C.upsert(rest, fresh)), catalog_root, DQ.check_catalog, base, now)

    try:
        return sinks.committed(spark, catalog_root, attempt)
    finally:
        fresh.unpersist()
