"""The postings build: staging -> tag grain -> marts -> enriched mart.

Each model is a pure function of its inputs; ``build`` materialises them in
dependency order (staging as a table, so the landing files are scanned once;
the tag grain as a view; marts as versions behind a view) and returns the frames.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, trim_spaces
from ..functions.time import epoch_to_instant, now_literal, to_day
from ..operators.aggregates import key_popularity
from ..operators.classify import DISCIPLINES, UNCLASSIFIED, label_expr
from ..operators.dedup import latest_per_key
from ..operators.fanout import explode_clean, item_count
from ..operators.joins import lookup
from ..sinks.materialize import as_versioned, as_view

STAGING_COLUMNS = ["posting_id", "title", "company_name", "location", "is_remote", "tags",
                   "posted_at", "source_file", "ingest_date", "ingested_at"]
TAG_COLUMNS = ["posting_id", "tag", "posted_at"]
MART_COLUMNS = ["posting_id", "title", "company_name", "location", "is_remote", "tags",
                "tag_count", "posted_at", "posted_date", "ingested_at"]
POPULARITY_COLUMNS = ["tag", "postings", "first_seen_at", "last_seen_at"]
# The published contract: title first, then the mart, then the enrichment.
ENRICHED_COLUMNS = ["title", "posting_id", "company_name", "location", "is_remote", "tags",
                    "tag_count", "posted_at", "posted_date", "ingested_at", "discipline",
                    "enriched_at"]


def rename_raw(raw: DataFrame) -> DataFrame:
    """Source names to domain names, cleaned (P1-P4); one row per landed record."""
    return raw.select(
        F.col("slug").alias("posting_id"),
        trim_spaces("title").alias("title"),
        trim_spaces("company_name").alias("company_name"),
        blank_to_null("location").alias("location"),
        F.col("remote").alias("is_remote"),
        F.col("tags"),
        epoch_to_instant("created_at").alias("posted_at"),
        "source_file", "ingest_date", "ingested_at",
    )


def newest(renamed: DataFrame, newest_by_day: bool = False) -> DataFrame:
    """One row per posting_id, the newest version.

    "Newest" is the latest file modification time; ties go to the later day
    folder, then the later file path, then a hash of the row, so the choice is
    deterministic (and the same whichever subset of versions it is applied
    to first, which makes incremental staging exact). ``newest_by_day=True``
    puts the day folder first instead (a replayed old day then no longer wins).
    """
    order = [F.col(c).desc_nulls_last() for c in version_order(newest_by_day)]
    order.append(row_hash().desc())
    return latest_per_key(renamed.select(*STAGING_COLUMNS), "posting_id", order)


def version_order(newest_by_day: bool = False) -> list[str]:
    """Columns deciding which version of a posting is newest, most significant first."""
    first = ["ingest_date", "ingested_at"] if newest_by_day else ["ingested_at", "ingest_date"]
    return [*first, "source_file"]


def row_hash(prefix: str = "") -> Column:
    """The last tie-break of ``newest``: a hash of the whole staging row."""
    return F.xxhash64(*[F.col(f"{prefix}{c}") for c in STAGING_COLUMNS])


def version(prefix: str = "", newest_by_day: bool = False) -> Column:
    """The ``newest`` order as one struct: of two versions the greater is newer.

    Struct comparison puts a NULL field below any value, as ``desc_nulls_last``
    does in ``newest``.
    """
    return F.struct(*[F.col(f"{prefix}{c}") for c in version_order(newest_by_day)],
                    row_hash(prefix))


def stage(raw: DataFrame, newest_by_day: bool = False) -> DataFrame:
    """Rename, clean and keep the newest version of each posting."""
    return newest(rename_raw(raw), newest_by_day)


def posting_tags(stg: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """One row per (posting, cleaned tag) with the posting's time and ``carry``.

    Staging holds one row per posting_id, so per-posting de-duplication needs
    no shuffle.
    """
    return explode_clean(stg, "posting_id", "tags", "tag", carry=["posted_at", *carry])


def postings_mart(stg: DataFrame) -> DataFrame:
    """One row per posting with its cleaned tag count and UTC day.

    ``tag_count`` counts exactly the rows ``posting_tags`` emits for the posting
    (0 when none); it is computed in-row from the same cleaning expression.
    """
    return stg.select(
        "posting_id", "title", "company_name", "location", "is_remote", "tags",
        item_count("tags").alias("tag_count"),
        "posted_at", to_day("posted_at").alias("posted_date"), "ingested_at")


def tag_popularity_mart(tags: DataFrame) -> DataFrame:
    """Postings per tag and when it was first and last seen (A2)."""
    return key_popularity(tags, "tag", "posted_at", "postings", "first_seen_at", "last_seen_at")


def enriched_mart(mart: DataFrame, now: dt.datetime | None = None, rules=DISCIPLINES,
                  labels: DataFrame | None = None) -> DataFrame:
    """The mart plus ``discipline`` and ``enriched_at`` in contract order.

    By default the ordered keyword rules label every row in place. Given a
    ``labels`` table ``(title, discipline)`` (the batched labeller's output) the
    label is looked up instead, and titles not yet labelled become ``other``
    (J4).
    """
    if labels is None:
        out = mart.withColumn("discipline", label_expr("title", rules, UNCLASSIFIED))
    else:
        out = lookup(mart, labels, "title", "discipline", UNCLASSIFIED)
    return out.withColumn("enriched_at", now_literal(now)).select(*ENRICHED_COLUMNS)


@dataclass
class Build:
    staging: DataFrame
    tags: DataFrame
    postings: DataFrame
    popularity: DataFrame
    enriched: DataFrame
    staging_mode: str = "full"


def build(spark: SparkSession, landing_root: str, database: str = "default",
          now: dt.datetime | None = None, labels: DataFrame | None = None,
          buckets: int | None = None, threads: int = 2, full: bool = False,
          newest_by_day: bool = False) -> Build:
    """Materialise every model of the build in dependency order (K4, K5).

    Staging reads only files landed since the previous build when that is
    exact (``plans.staging``; ``full=True`` forces a rebuild from all files).
    ``newest_by_day`` puts the day folder before the file time in "newest" (change
    it together with ``full=True``).
    The three posting-grain relations are bucketed on ``posting_id`` with one
    bucket count, so the uniqueness, grain and referential checks on them (and
    the tag view exploded from staging) read co-partitioned data and need no
    shuffle; the popularity mart is bucketed on its key, ``tag``. Staging and both
    count marts are copy-on-write: a build writes the buckets its new rows touch and
    maintains the counts by what changed in them (``plans.marts``).

    After staging, the two independent branches (postings mart -> enriched
    mart, and the popularity mart) are submitted as concurrent Spark jobs from
    ``threads`` driver threads; ``threads=1`` builds them one after another.
    """
    from ..sinks.buckets import stored_in_buckets
    from .marts import popularity_into, postings_into
    from .staging import stage_into

    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    by_posting = {"bucket_by": "posting_id", "buckets": buckets}
    staging = f"{database}.stg_postings"
    before = stored_in_buckets(spark, staging)
    stg, mode = stage_into(spark, landing_root, staging, buckets, full, newest_by_day)
    tags = as_view(posting_tags(stg), f"{database}_int_posting_tags")

    def postings_branch():
        mart, _ = postings_into(spark, staging, before, f"{database}.fct_postings", buckets)
        enriched = as_versioned(enriched_mart(mart, now, labels=labels),
                                f"{database}.fct_postings_enriched", **by_posting)
        return mart, enriched

    def popularity_branch():
        return popularity_into(spark, staging, before, f"{database}.fct_tag_popularity", buckets)[0]

    if threads > 1:
        with ThreadPoolExecutor(max_workers=threads) as pool:
            postings_job = pool.submit(postings_branch)
            popularity_job = pool.submit(popularity_branch)
            (mart, enriched), pop = postings_job.result(), popularity_job.result()
    else:
        (mart, enriched), pop = postings_branch(), popularity_branch()
    return Build(stg, tags, mart, pop, enriched, mode)
