"""Withdrawn records in the stream (X3, K3): versions per landed file, files that still stand.

A replayed day replaces its files, so a record that the new files lack is withdrawn and
an older version of it, from another day, is the newest again. A table of one version
per key cannot follow that. Here every key keeps one version *per landed file*, and a
version counts only while its file stands in the landing zone:

* each micro-batch is reduced to one row per (key, file) and stored as an addition to
  the current version, as in ``latest.merge_batch``; the files it came from are noted in
  ``{table}__files``;
* the noted files are compared with the landing listing. Files that are gone, or were
  rewritten in place (same path, other time), are stored as a small list; a rewritten
  file, which the file source does not read twice, is read again there and then;
* the table name is a view: newest version per key over version and additions, without
  the rows of files on that list. The version is read through its buckets, so neither
  the list nor the reduction shuffles it, and retracting a day writes the list alone;
* every ``compact_every`` additions, or when the list outgrows its bound, the standing
  rows are written as the next version and the list starts empty.

After each trigger the table equals ``postings.stage`` over the files that stand then. A
trigger without new files does not run: after a day is only deleted, call
``retract``. State grows with the landed files' rows, and one day's outage
costs a list of its files, whatever the history. (Keyed state in a streaming operator
would have to visit every key of the day: keys a replay withdraws send no record.)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..plans.postings import STAGING_COLUMNS, rename_raw, row_hash, version_order
from ..plans.staging import landed_files, read_files
from ..session import checkpoint_dir
from ..sinks.materialize import GONE, current_version, deltas, point_view, write_version
from .latest import COMPACT_EVERY, _reduced_sql, merged_sql

FILE = ["path", "modificationTime"]
GONE_ROWS = 100_000  # files on the list that a reader broadcasts; beyond it the table is rewritten


def per_file(renamed: DataFrame) -> DataFrame:
    """One row per key and landed file (ties inside a file: by row hash, as in ``newest``)."""
    return latest_per_key(renamed.select(*STAGING_COLUMNS),
                          ["posting_id", "source_file", "ingested_at"], [row_hash().desc()])


def _files_table(table: str) -> str:
    return f"{table}__files"


def _files_of(rows: DataFrame) -> DataFrame:
    return rows.select(F.col("source_file").alias("path"),
                       F.col("ingested_at").alias("modificationTime")).distinct()


def noted_files(spark: SparkSession, table: str, version: str | None = None) -> DataFrame | None:
    """Files whose rows are stored; read off the rows themselves if the note is lost."""
    if spark.catalog.tableExists(_files_table(table)):
        return spark.table(_files_table(table)).distinct()
    version = version or current_version(spark, table)
    if version is None:
        return None
    stored = [_files_of(spark.table(t)) for t in [version, *deltas(spark, version)]]
    out = stored[0]
    for more in stored[1:]:
        out = out.unionByName(more)
    return out.distinct()


def _note(files: DataFrame, table: str, mode: str) -> None:
    files.write.mode(mode).format("parquet").saveAsTable(_files_table(table))


def live_sql(version: str, additions: list[str], gone: str | None, newest_by_day: bool) -> str:
    """The view: newest per key over the rows of standing files."""
    def standing(t: str) -> str:
        if gone is None:
            return t
        return (f"(SELECT /*+ BROADCAST(g) */ h.* FROM {t} h LEFT ANTI JOIN {gone} g "
                "ON h.source_file = g.path AND h.ingested_at = g.modificationTime)")

    base = f"({_reduced_sql(standing(version), version_order(newest_by_day))})"
    return merged_sql(base, [standing(t) for t in additions], newest_by_day)


def merge_live(batch: DataFrame, root: str, table: str, buckets: int | None = None,
               newest_by_day: bool = False, compact_every: int = COMPACT_EVERY) -> None:
    """Fold one micro-batch into ``table`` and withdraw what its landing zone no longer holds.

    A re-run micro-batch stores the same rows again, which changes nothing: a key's
    versions of one file are equal. An empty batch only withdraws.
    """
    spark = batch.sparkSession
    checkpoint_dir(spark)
    listing = landed_files(spark, root).checkpoint(eager=True)
    rows = per_file(rename_raw(batch))
    noted = noted_files(spark, table)
    if noted is not None:
        rewritten = listing.join(noted.select("path").distinct(), "path", "left_semi").join(
            noted, FILE, "left_anti").checkpoint(eager=True)
        if not rewritten.isEmpty():
            rows = rows.unionByName(per_file(rename_raw(read_files(spark, root, rewritten))))
    version = current_version(spark, table)
    if version is None:
        version, _ = write_version(rows, table, bucket_by="posting_id", buckets=buckets)
        added = version
    else:
        added, stored = write_version(rows, table, onto=version)
        if stored == 0:
            spark.sql(f"DROP TABLE {added}")
            added = None
    if not spark.catalog.tableExists(_files_table(table)):
        _note(noted_files(spark, table, version).checkpoint(eager=True), table, "overwrite")
    elif added is not None:
        _note(_files_of(spark.table(added)), table, "append")
    _settle(spark, listing, table, version, buckets, newest_by_day, compact_every)


def retract(spark: SparkSession, root: str, table: str, buckets: int | None = None,
            newest_by_day: bool = False, compact_every: int = COMPACT_EVERY) -> None:
    """Withdraw the records of files that are gone, without any new file."""
    version = current_version(spark, table)
    if version is not None:
        checkpoint_dir(spark)
        listing = landed_files(spark, root).checkpoint(eager=True)
        _settle(spark, listing, table, version, buckets, newest_by_day, compact_every)


def _settle(spark: SparkSession, listing: DataFrame, table: str, version: str,
            buckets: int | None, newest_by_day: bool, compact_every: int) -> None:
    """Point the view at what stands, rewriting the table first where that is due."""
    missing = noted_files(spark, table, version).join(listing, FILE, "left_anti")
    gone, n = write_version(missing, table, onto=version, kind=GONE)
    if n == 0:
        spark.sql(f"DROP TABLE {gone}")
        gone = None
    additions = deltas(spark, version)
    if len(additions) < compact_every and n <= GONE_ROWS:
        point_view(spark, table, version, body=live_sql(version, additions, gone, newest_by_day))
        for old in deltas(spark, version, GONE):
            if gone is None or old.split(".")[-1] != gone.split(".")[-1].lower():
                spark.sql(f"DROP TABLE {old}")
        return
    standing = spark.table(version).select(*STAGING_COLUMNS)
    for t in additions:
        standing = standing.unionByName(spark.table(t).select(*STAGING_COLUMNS))
    if gone is not None:
        lost = spark.table(gone).select(F.col("path").alias("source_file"),
                                        F.col("modificationTime").alias("ingested_at"))
        standing = standing.join(lost, ["source_file", "ingested_at"], "left_anti")
    compacted, _ = write_version(per_file(standing), table, bucket_by="posting_id", buckets=buckets)
    point_view(spark, table, compacted,
               body=live_sql(compacted, [], None, newest_by_day))
    _note(_files_of(spark.table(compacted)).checkpoint(eager=True), table, "overwrite")
