"""URL filters (operator 1, native): a temporal join of captures with dated lists.

List entries are dated edits ``(list, domain, action, at)``: ``add`` puts a domain
(and everything below it) on a list, ``remove`` takes it off. Edits become
validity intervals ``[at, next edit of that list and domain)``; a capture is
judged by the intervals that hold its host or a parent domain at fetch time.

Both sides are cut into time buckets, so the join is an equi-join on (domain,
bucket) with a range check inside: a domain that owns a third of all captures is
spread over the buckets, and each side's rows of one bucket stay few. Everything
is DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._columns import indices, let

BUCKET_SECONDS = 86_400
ALLOW_LIST = "allow"


def host_of(url: Column) -> Column:
    """Lower-case host of a URL with a scheme; empty for NULL or anything else."""
    return F.lower(F.coalesce(
        F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1),
        F.lit("")))


def domains_of(host: Column) -> Column:
    """The host and its parents of two labels or more (a one-label host: itself)."""
    return F.when(host == "", F.array().cast("array<string>")).otherwise(
        let(F.split(host, r"\."), lambda labels: F.transform(
            indices(F.greatest(F.size(labels) - 1, F.lit(1))),
            lambda i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))))


def validity(entries: DataFrame, bucket_seconds: int = BUCKET_SECONDS) -> DataFrame:
    """``(list_name, domain, valid_from, valid_to)``; ``valid_to`` is NULL while open.

    ``entries``: ``list_name, domain, action, at`` (epoch seconds). Of edits of one
    list and domain at one instant a ``remove`` wins. Rows with a NULL field are
    not edits and are left out. The next edit is looked up inside a time bucket
    first and across buckets on one row per bucket, so the long history of one
    domain is not sorted in one task.
    """
    key = ["list_name", "domain"]
    edits = (entries.select(*key, "action", F.col("at").cast("bigint").alias("at"))
             .dropna()
             .groupBy(*key, "at").agg(F.max("action").alias("action"))
             .withColumn("bucket", F.floor(F.col("at") / bucket_seconds)))
    firsts = (edits.groupBy(*key, "bucket").agg(F.min("at").alias("first_at"))
              .withColumn("later", F.lead("first_at").over(
                  Window.partitionBy(*key).orderBy("bucket")))
              .select(*key, "bucket", "later"))
    following = F.lead("at").over(Window.partitionBy(*key, "bucket").orderBy("at"))
    return (edits.withColumn("__next", following)
            .join(firsts, [*key, "bucket"])
            .filter(F.col("action") == "add")
            .select(*key, F.col("at").alias("valid_from"),
                    F.coalesce("__next", "later").alias("valid_to")))


def active_lists(captures: DataFrame, entries: DataFrame, id_col: str = "page_id",
                 url_col: str = "url", at_col: str = "fetched_at",
                 bucket_seconds: int = BUCKET_SECONDS, allow_list: str = ALLOW_LIST) -> DataFrame:
    """One row per distinct capture: ``(id, host, fetched_at, n_active, lists, blocked)``.

    ``lists`` names the lists that hold the capture at its fetch time, sorted and
    comma-joined; ``blocked`` is true if one of them is not the allow list and the
    allow list is not among them. Captures with a NULL or hostless URL, or without
    a fetch time, match nothing and are not blocked. Captures repeated in all three
    columns give one row. Empty tables and columns of other names are fine.
    """
    rows = captures.select(
        F.col(f"`{id_col}`").alias("__id"), host_of(F.col(f"`{url_col}`")).alias("host"),
        F.col(f"`{at_col}`").cast("bigint").alias("fetched_at"))
    spread = (rows.withColumn("bucket", F.floor(F.col("fetched_at") / bucket_seconds))
              .select("*", F.explode_outer(domains_of(F.col("host"))).alias("domain")))
    last = rows.agg(F.max("fetched_at").alias("last")).select("last").scalar()
    intervals = validity(entries, bucket_seconds)
    ended = F.least(F.coalesce(F.col("valid_to") - 1, last), last)
    cut = (intervals.filter(ended >= F.col("valid_from"))
           .select("list_name", "domain", "valid_from", "valid_to",
                   F.explode(F.sequence(F.floor(F.col("valid_from") / bucket_seconds),
                                        F.floor(ended / bucket_seconds))).alias("bucket")))
    held = spread.join(
        cut, (spread["domain"] == cut["domain"]) & (spread["bucket"] == cut["bucket"])
        & (F.col("valid_from") <= F.col("fetched_at"))
        & (F.col("valid_to").isNull() | (F.col("fetched_at") < F.col("valid_to"))), "left")
    found = F.collect_set("list_name")
    return (held.groupBy("__id", "host", "fetched_at").agg(F.sort_array(found).alias("__lists"))
            .select(F.col("__id").alias(id_col), "host", "fetched_at",
                    F.size("__lists").cast("bigint").alias("n_active"),
                    F.array_join("__lists", ",").alias("lists"),
                    ((F.size("__lists") > 0)
                     & ~F.array_contains("__lists", allow_list)).alias("blocked")))
