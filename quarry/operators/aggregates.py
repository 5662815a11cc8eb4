"""Aggregations (A1-A10, G2). Every one is a hash aggregate with a map-side
partial step, so a hot key is combined inside each map task before the
shuffle; none gathers a group's rows into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def count_per_key(df: DataFrame, key: str, out_col: str = "n") -> DataFrame:
    """``count(*) group by key``."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out_col))


def key_popularity(df: DataFrame, item_col: str, at_col: str,
                   count_col: str = "postings", first_col: str = "first_seen_at",
                   last_col: str = "last_seen_at") -> DataFrame:
    """Rows, first and last ``at_col`` per item (A2)."""
    return df.groupBy(item_col).agg(
        F.count(F.lit(1)).alias(count_col),
        F.min(at_col).alias(first_col),
        F.max(at_col).alias(last_col),
    )


def empty_check(df: DataFrame, out_col: str = "problem") -> DataFrame:
    """One row ``problem = 1`` if ``df`` is empty, else no rows (A3)."""
    counted = df.agg(F.count(F.lit(1)).alias("n"))
    return counted.filter(F.col("n") == 0).select(F.lit(1).alias(out_col))


def key_counts(df: DataFrame, key: str, out_col: str = "rows_found") -> DataFrame:
    """Non-NULL values of ``key`` with their row counts.

    The one shape every single-key check (unique, both sides of a referential
    check) aggregates a relation to. Checks that share it in one plan share
    its scan and shuffle: Spark reuses an exchange whose subtree is identical.
    """
    return (df.filter(F.col(key).isNotNull())
            .groupBy(key).agg(F.count(F.lit(1)).alias(out_col)))


def duplicate_groups(df: DataFrame, keys: Sequence[str], out_col: str = "rows_found") -> DataFrame:
    """Groups of ``keys`` seen more than once, with their count.

    For a single column this is dbt's ``unique`` test: NULLs are excluded.
    """
    keys = list(keys)
    if len(keys) == 1:
        counted = key_counts(df, keys[0], out_col)
    else:
        counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out_col))
    return counted.filter(F.col(out_col) > 1)


def freshness(df: DataFrame, at_col: str, day_col: str) -> DataFrame:
    """``max(at), count(*), count(distinct day)`` (A5)."""
    return df.agg(
        F.max(at_col).alias("last_ingested"),
        F.count(F.lit(1)).alias("row_count"),
        F.countDistinct(day_col).alias("days_covered"),
    )


def publish_verification(df: DataFrame, key: str, at_col: str) -> DataFrame:
    """``rows``, ``ids``, ``latest`` and ``rows = ids``."""
    out = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct(key).alias("ids"),
        F.max(at_col).alias("latest"),
    )
    return out.withColumn("dedup_held", F.col("rows") == F.col("ids"))


def reconcile_counts(df: DataFrame, key: str, reported_col: str) -> DataFrame:
    """Keys whose reported total disagrees with the rows present.

    ``reported_col`` carries the producer's claimed row count (or a running
    number whose maximum is that count); ``actual`` is what is really there. A
    key without a reported total disagrees too.
    """
    return (df.groupBy(key)
            .agg(F.max(reported_col).cast("bigint").alias("expected"),
                 F.count(F.lit(1)).alias("actual"))
            .filter(~F.col("expected").eqNullSafe(F.col("actual"))))
