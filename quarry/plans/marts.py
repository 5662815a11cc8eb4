"""Maintained marts (A1, A2): a build changes what its new staging rows change.

Staging is copy-on-write (``sinks.buckets``), so two versions name the buckets in which
they differ. Inside those, the rows of both are joined once on their key alone, which is
what they are bucketed on: bucket by bucket, without a shuffle (a second join key would
make Spark deal both sides out anew). Rows that are equal in the columns a mart reads
fall out. What is left maintains the marts:

* ``fct_postings`` is a function of each staging row: the touched buckets are written anew;
* ``fct_tag_popularity`` counts by signed deltas: every (posting, tag) pair of an old row
  counts -1, of a new one +1. First and last time follow a new pair by ``least`` and
  ``greatest``; only a tag that lost a pair standing at its first or last time reads
  staging again, for these tags alone. Tags that reach zero leave.

Each mart version notes the staging version it was built from. A mart whose note is not
the staging version before this build (a failed or skipped build) is built whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..sinks.buckets import (manifest, only, stored_in_buckets, touched_buckets, write_buckets)
from ..sinks.materialize import table_property
from .postings import (POPULARITY_COLUMNS, STAGING_COLUMNS, posting_tags, postings_mart,
                       tag_popularity_mart)

BUILT_FROM = "quarry.built_from"
FULL, MAINTAINED = "full", "maintained"


def changed_buckets(spark: SparkSession, staging: str, before: str, after: str) -> list[int]:
    """Buckets whose files differ between two staging versions."""
    old, new = (manifest(spark, staging, v) for v in (before, after))
    return sorted(b for b in new if old.get(b) != new[b])


def changes(spark: SparkSession, staging: str, before: str, after: str,
            columns: Sequence[str] = STAGING_COLUMNS) -> DataFrame:
    """One row per key whose ``columns`` differ between two staging versions: ``was`` and
    ``now``, structs of them, NULL where a version lacks the key.

    Keys are unique; NULL is one key, joined apart over at most one row from each side
    (row group statistics answer that read).
    """
    touched = changed_buckets(spark, staging, before, after)
    old, new = (only(spark, v, touched).select("posting_id", F.struct(*columns).alias(side))
                for v, side in ((before, "was"), (after, "now")))
    theirs = F.col("n.posting_id")

    def joined(keys, on: Column) -> DataFrame:
        return (old.filter(keys).alias("o").join(new.filter(keys).alias("n"), on, "full_outer")
                .select("was", "now"))

    key = F.col("posting_id")
    both = joined(key.isNotNull(), F.col("o.posting_id") == theirs).unionByName(
        joined(key.isNull(), F.col("o.posting_id").eqNullSafe(theirs)))
    return both.filter(~F.col("was").eqNullSafe(F.col("now")))


def changed_rows(spark: SparkSession, staging: str, before: str, after: str
                 ) -> tuple[DataFrame, DataFrame]:
    """Staging rows that only ``before`` holds, and rows that only ``after`` holds."""
    found = changes(spark, staging, before, after)
    removed, added = (found.filter(F.col(side).isNotNull()).select(f"{side}.*")
                      for side in ("was", "now"))
    return removed, added


def signed_rows(found: DataFrame) -> DataFrame:
    """The rows of ``changes``: those that went with ``sign`` -1, those that came with 1."""
    sides = F.array(F.struct(F.lit(-1).alias("sign"), F.col("was").alias("row")),
                    F.struct(F.lit(1).alias("sign"), F.col("now").alias("row")))
    return (found.select(F.explode(sides).alias("s")).select("s.sign", "s.row")
            .filter(F.col("row").isNotNull()).select("sign", "row.*"))


def tag_deltas(removed: DataFrame, added: DataFrame) -> DataFrame:
    """``signed_deltas`` of rows that went and rows that came."""
    return signed_deltas(removed.withColumn("sign", F.lit(-1))
                         .unionByName(added.withColumn("sign", F.lit(1))))


def signed_deltas(rows: DataFrame) -> DataFrame:
    """Per tag: ``delta``, and the extreme times of the pairs that went and that came."""
    pairs = posting_tags(rows, carry=["sign"])
    gone, come = (F.when(F.col("sign") == s, F.col("posted_at")) for s in (-1, 1))
    return pairs.groupBy("tag").agg(
        F.sum("sign").alias("delta"), F.min(gone).alias("gone_first"), F.max(gone).alias("gone_last"),
        F.min(come).alias("come_first"), F.max(come).alias("come_last"))


def popularity_after(current: DataFrame, deltas: DataFrame, staging: DataFrame) -> DataFrame:
    """``current`` (the rows of touched tags) after ``deltas``; ``staging`` holds all new rows.

    A tag's first time is lost if a pair that went stood at it and none that came is as
    early (the last time alike); the times of those tags are read from ``staging`` again.
    A tag whose pairs have no time has none.
    """
    def lost(now: str, went: Column, came: Column) -> Column:
        return F.coalesce(went & F.coalesce(came, F.lit(True)), F.lit(False)).alias(now)

    first, last = F.col("first_seen_at"), F.col("last_seen_at")
    joined = current.join(deltas, "tag", "full_outer").select(
        "tag", (F.coalesce("postings", F.lit(0)) + F.coalesce("delta", F.lit(0))).cast("bigint").alias("postings"),
        F.least(first, "come_first").alias("first_seen_at"),
        F.greatest(last, "come_last").alias("last_seen_at"),
        lost("lost_first", F.col("gone_first") <= first, F.col("come_first") > first),
        lost("lost_last", F.col("gone_last") >= last, F.col("come_last") < last),
    ).filter("postings > 0").checkpoint(eager=True)
    kept = joined.filter("NOT (lost_first OR lost_last)").select(*POPULARITY_COLUMNS)
    open_ones = joined.filter("lost_first OR lost_last").select("tag", "postings")
    if open_ones.isEmpty():
        return kept
    tags = posting_tags(staging).join(bounded_broadcast(open_ones.select("tag")), "tag", "left_semi")
    times = tag_popularity_mart(tags).drop("postings")
    return kept.unionByName(open_ones.join(times, "tag").select(*POPULARITY_COLUMNS))


def _note(spark: SparkSession, version: str, staging_version: str) -> None:
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{BUILT_FROM}' = '{staging_version}')")


def _maintainable(spark: SparkSession, name: str, staging: str, before: str | None, after: str
                  ) -> str | None:
    """The mart's version if it was built from staging version ``before`` and that has as
    many buckets as ``after``."""
    version = stored_in_buckets(spark, name)
    if not version or not before or table_property(spark, version, BUILT_FROM) != before:
        return None
    old, new = (manifest(spark, staging, v) for v in (before, after))
    return version if old and len(old) == len(new) else None


def postings_into(spark: SparkSession, staging: str, before: str | None, name: str,
                  buckets: int | None = None) -> tuple[DataFrame, str]:
    """Bring mart ``name`` up to the current staging version; return it and how (A1)."""
    after = stored_in_buckets(spark, staging)
    version = _maintainable(spark, name, staging, before, after)
    if version is None:
        new = write_buckets(postings_mart(spark.table(staging)), name, "posting_id", buckets)
        mode = FULL
    else:
        mode = MAINTAINED
        if before == after:
            return spark.table(name), mode
        touched = changed_buckets(spark, staging, before, after)
        new = write_buckets(postings_mart(only(spark, after, touched)), name, "posting_id",
                            previous=version, touched=touched, align=False)
    _note(spark, new, after)
    return spark.table(name), mode


def popularity_into(spark: SparkSession, staging: str, before: str | None, name: str,
                    buckets: int | None = None) -> tuple[DataFrame, str]:
    """Bring the popularity mart up to the current staging version; return it and how (A2)."""
    after = stored_in_buckets(spark, staging)
    version = _maintainable(spark, name, staging, before, after)
    rows = spark.table(staging)
    if version is None:
        new = write_buckets(tag_popularity_mart(posting_tags(rows)), name, "tag", buckets)
        mode = FULL
    else:
        mode = MAINTAINED
        if before == after:
            return spark.table(name), mode
        found = changes(spark, staging, before, after, ["posting_id", "tags", "posted_at"])
        deltas = signed_deltas(signed_rows(found)).checkpoint(eager=True)
        touched = touched_buckets(deltas, "tag", len(manifest(spark, name, version)))
        if touched:
            result = popularity_after(only(spark, version, touched), deltas, rows)
            new = write_buckets(result, name, "tag", previous=version, touched=touched)
        else:  # rows changed, no tag did
            new = version
    _note(spark, new, after)
    return spark.table(name), mode
