"""Staging that reads each landed file once.

"Newest version per key" is a max over a total order, so for old files A and
new files B: newest(A + B) = newest(newest(A) + B). The previous staging
result is newest(A) exactly as long as none of the files it was built from
has since been removed or rewritten. Each build therefore:

1. snapshots the landing file listing (path, modification time) once,
   checkpointed so every later step sees the same files;
2. compares it with the manifest stored by the previous build: if any file
   read before is gone or changed (a replayed day), it rebuilds from all
   files; otherwise it reads only the new files (their list stays distributed)
   and merges their newest versions into the previous staging rows
   (``merge_newest``: the previous table is read through its buckets, so
   only the new rows are shuffled);
3. writes the buckets that the new rows touch (all of them in a rebuild) as a new
   version that takes over the files of the others (``sinks.buckets``), re-points the
   staging view at it, and only then stores the new file manifest.

A failure before the manifest is stored leaves the previous manifest, so the
next build re-reads the same new files; merging them again is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast, side_size
from ..session import checkpoint_dir
from ..sinks.buckets import manifest as bucket_manifest
from ..sinks.buckets import only, stored_in_buckets, touched_buckets, write_buckets
from ..sources.landing import read_landing
from .postings import STAGING_COLUMNS, newest, rename_raw, version

# The rows of one bucket that a merge may hold in a hash table, on average.
HASHED_BUCKET_BYTES = 16 * 1024 * 1024
FULL, INCREMENTAL, UNCHANGED = "full", "incremental", "unchanged"


def landed_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path, modificationTime)`` of every file a partitioned read of ``root`` sees.

    Both come from the ``_metadata`` struct, so they equal the ``source_file`` and
    ``ingested_at`` of the records read from that file.
    """
    listing = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
               .select(F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_modification_time").alias("modificationTime")))
    return listing.filter(F.col("path").rlike(r"/ingest_date=[^/]+/[^/]+$"))


def read_files(spark: SparkSession, root: str, files: DataFrame) -> DataFrame:
    """The landing read of ``read_landing`` restricted to ``files`` (``path``, ``modificationTime``).

    The list itself stays distributed: only its days (at most one per calendar
    day) and its oldest modification time come to the driver. Both prune the
    listing before any file is opened; a semi join on the path then keeps
    exactly the listed files. A list within the broadcast bounds is broadcast: joined by
    a shuffle, all records of one file would go to one task.
    """
    day = F.regexp_extract("path", r"/ingest_date=([^/]+)/[^/]+$", 1)
    span = files.agg(F.collect_set(day).alias("days"), F.min("modificationTime").alias("oldest"))
    days, oldest = span.first()
    wanted = files.select(F.col("path").alias("source_file"))
    return (read_landing(spark, root)
            .filter(F.col("ingest_date").cast("string").isin(days))
            .filter(F.col("ingested_at") >= F.lit(oldest))
            .join(bounded_broadcast(wanted), "source_file", "left_semi"))


def merge_newest(previous: DataFrame, fresh: DataFrame, newest_by_day: bool = False
                 ) -> DataFrame:
    """``newest(previous + fresh)`` when each side already holds one row per key.

    A full outer join on ``posting_id`` keeps, per key, the side whose
    ``version`` is greater. ``previous`` is the staging table, bucketed on
    ``posting_id``: read through its buckets it is already partitioned for the
    join, so only ``fresh`` is shuffled, never the history. NULL keys (one group
    in ``newest``, never equal in a join) are merged apart, over at most one row
    from each side. That branch reads both sides again under an ``IS NULL`` filter,
    which row group statistics of a stored table answer; give both sides stored.
    (A union of bucketed tables would do without the join, but Spark 4.1.2
    zips the wrong buckets when it reads such a union in columns.)
    """
    key = F.col("posting_id")
    p = previous.filter(key.isNotNull()).alias("p")
    f = fresh.filter(key.isNotNull()).alias("f")
    joined = p.join(f, F.col("p.posting_id") == F.col("f.posting_id"), "full_outer")
    take_fresh = F.col("p.posting_id").isNull() | (
        F.col("f.posting_id").isNotNull()
        & (version("f.", newest_by_day) > version("p.", newest_by_day)))
    merged = joined.select(*[F.when(take_fresh, F.col(f"f.{c}")).otherwise(F.col(f"p.{c}"))
                             .alias(c) for c in STAGING_COLUMNS])
    null_keys = (previous.filter(key.isNull()).select(*STAGING_COLUMNS)
                 .unionByName(fresh.filter(key.isNull()).select(*STAGING_COLUMNS))
                 .orderBy(version("", newest_by_day).desc()).limit(1))
    return merged.unionByName(null_keys)


def hashed_if_small(fresh: DataFrame, buckets: int) -> DataFrame:
    """``fresh``, hinted as the hash side of a join by bucket if its measured size allows.

    Its keys are unique, so buckets are even. A hash join reads the previous rows as they
    are stored; a merge join, kept beyond the bound, sorts all of them.
    """
    return (fresh.hint("shuffle_hash")
            if side_size(fresh).first()["bytes"] <= HASHED_BUCKET_BYTES * buckets else fresh)


def stage_into(spark: SparkSession, landing_root: str, name: str, buckets: int | None = None,
               full: bool = False, newest_by_day: bool = False) -> tuple[DataFrame, str]:
    """Bring staging view ``name`` up to date with the landing zone; return it and the mode.

    An incremental build reads and writes only the buckets that hold a key of the new
    files, so its cost follows the new rows' spread over buckets, not the history.
    """
    manifest = f"{name}__files"
    checkpoint_dir(spark)
    snapshot = landed_files(spark, landing_root).checkpoint(eager=True)
    previous = stored_in_buckets(spark, name)
    mode = FULL
    if previous and spark.catalog.tableExists(manifest) and not full:
        seen = spark.table(manifest)
        keys = ["path", "modificationTime"]
        if seen.join(snapshot, on=keys, how="left_anti").isEmpty():
            new_files = snapshot.join(seen, on=keys, how="left_anti").checkpoint(eager=True)
            mode = UNCHANGED if new_files.isEmpty() else INCREMENTAL
    if mode == UNCHANGED:
        return spark.table(name), mode
    if mode == FULL:
        result = newest(rename_raw(read_landing(spark, landing_root)), newest_by_day)
        write_buckets(result, name, "posting_id", buckets)
    else:
        fresh = newest(rename_raw(read_files(spark, landing_root, new_files)), newest_by_day
                       ).checkpoint(eager=True)
        n = len(bucket_manifest(spark, name, previous))
        touched = touched_buckets(fresh, "posting_id", n)
        # The merge joins on the previous version's buckets, so its tasks already
        # hold one bucket each: no re-layout before the bucketed write.
        result = merge_newest(only(spark, previous, touched), hashed_if_small(fresh, len(touched)),
                              newest_by_day)
        write_buckets(result, name, "posting_id", previous=previous, touched=touched, align=False)
    snapshot.write.mode("overwrite").format("parquet").saveAsTable(manifest)
    return spark.table(name), mode
