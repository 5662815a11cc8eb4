"""Checks and counts kept per bucket (D1-D3, D7, A5, A6): only changed buckets are read again.

A table of hash buckets (``sinks.buckets``) splits its rows by key, so what is asked of the
whole table adds up over buckets, exactly: rows, NULLs per column, keys that repeat, and
distinct keys, since a key is in one bucket; the latest time and the days covered are a
maximum and a union. Against a second table of the same buckets, keys without a partner
add up as well. ``{table}__summary`` holds these figures per bucket beside the folder they
were taken from. A figure stands as long as the current version names that folder; the
rest is taken anew from the buckets whose folders differ, and nothing else is read.

Distinct values of columns that are not the key do not add up. They are kept as HLL
sketches (``SKETCH_BITS``: about 1.6 percent standard error), merged at read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.time import to_day
from ..sinks.buckets import bucket_of, manifest, only, stored_in_buckets
from ..sinks.materialize import as_versioned

SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def bucket_figures(rows: DataFrame, key: str, n: int, at: str | None = None,
                   sketched: Sequence[str] = ()) -> DataFrame:
    """One row per bucket of ``rows``: the mergeable figures.

    Rows of one key are first reduced to one (a partial aggregate), so a key that holds a
    third of all rows is one row behind the shuffle. ``repeated`` counts keys that occur
    more than once, NULL left out; ``distinct_keys`` leaves NULL out too.
    """
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in rows.columns]
    times = [] if at is None else [F.max(at).alias("latest"), F.collect_set(to_day(at)).alias("days")]
    sketches = [F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), SKETCH_BITS).alias(f"sketch_{c}") for c in sketched]
    per_key = rows.groupBy(F.col(f"`{key}`").alias("__key")).agg(F.count(F.lit(1)).alias("__rows"), *nulls, *times)
    keyed = F.col("__key").isNotNull()
    merged = [F.sum(f"null_{c}").alias(f"null_{c}") for c in rows.columns]
    if at is not None:
        merged += [F.max("latest").alias("latest"),
                   F.array_distinct(F.flatten(F.collect_set("days"))).alias("days")]
    figures = per_key.groupBy(bucket_of("__key", n).alias("bucket")).agg(
        F.sum("__rows").alias("rows"), F.count_if(keyed).alias("distinct_keys"),
        F.count_if(keyed & (F.col("__rows") > 1)).alias("repeated"), *merged)
    if not sketches:
        return figures
    return figures.join(rows.groupBy(bucket_of(key, n).alias("bucket")).agg(*sketches), "bucket")


def _bucket_orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str, n: int) -> DataFrame:
    """Rows of ``child`` per bucket whose key ``parent`` lacks, counted per key first."""
    keys = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("__rows"))
    lost = keys.join(parent.select(F.col(parent_key).alias(key)).distinct(), key, "left_anti")
    return lost.groupBy(bucket_of(key, n).alias("bucket")).agg(F.sum("__rows").alias("orphans"))


def summarised(spark: SparkSession, table: str, key: str, at: str | None = None,
               sketched: Sequence[str] = (), parent: str | None = None,
               parent_key: str | None = None) -> tuple[DataFrame, int]:
    """The up-to-date figures of ``table``, one row per bucket, and how many buckets were read.

    With ``parent``, a table of as many buckets on ``parent_key``, ``orphans`` counts rows
    of ``table`` without a partner there; a bucket is read again if either side changed.
    """
    folders = manifest(spark, table, stored_in_buckets(spark, table))
    n = len(folders)
    theirs = manifest(spark, parent, stored_in_buckets(spark, parent)) if parent else {}
    if parent and len(theirs) != n:
        raise ValueError(f"{parent} has {len(theirs)} buckets, {table} has {n}")
    now = {b: f"{at_} {theirs.get(b, '')}" for b, at_ in folders.items()}
    name = f"{table}__summary"
    taken = {}
    if spark.catalog.tableExists(name):
        stored = spark.table(name)
        taken = {r["bucket"]: r["folder"] for r in stored.select("bucket", "folder").collect()}
    stale = sorted(b for b in now if taken.get(b) != now[b])
    if not stale:
        return spark.table(name), 0
    rows = only(spark, stored_in_buckets(spark, table), stale)
    figures = bucket_figures(rows, key, n, at, sketched)
    places = spark.createDataFrame([(b, now[b]) for b in stale], "bucket int, folder string")
    fresh = places.join(figures, "bucket", "left")  # an empty bucket has a row too
    if parent:
        lost = _bucket_orphans(rows, key, only(spark, stored_in_buckets(spark, parent), stale), parent_key, n)
        fresh = fresh.join(lost, "bucket", "left")
    counts = [c for c, kind in fresh.dtypes if kind == "bigint"]
    fresh = fresh.fillna(0, counts)
    if taken:
        fresh = fresh.unionByName(spark.table(name).filter(~F.col("bucket").isin(stale)))
    return as_versioned(fresh.coalesce(1), name), len(stale)


def summary_report(summary: DataFrame, table: str, key: str) -> DataFrame:
    """``(check_name, status, failures)`` of not-null, unique, relationship and not-empty checks."""
    columns = [c for c in summary.columns if c.startswith("null_")]
    checks = [(f"not_null_{table}_{c.removeprefix('null_')}", F.sum(c)) for c in columns]
    checks.append((f"unique_{table}_{key}", F.sum("repeated")))
    if "orphans" in summary.columns:
        checks.append((f"relationships_{table}_{key}", F.sum("orphans")))
    checks.append((f"not_empty_{table}", F.when(F.sum("rows") > 0, 0).otherwise(1)))
    sums = summary.agg(*[c.cast("bigint").alias(name) for name, c in checks])
    rows = F.explode(F.array(*[F.struct(F.lit(name).alias("check_name"), F.col(f"`{name}`").alias("failures"))
                               for name, _ in checks]))
    return sums.select(rows.alias("r")).select(
        "r.check_name", F.when(F.col("r.failures") == 0, "pass").otherwise("fail").alias("status"), "r.failures")


def summary_verification(summary: DataFrame) -> DataFrame:
    """``rows``, ``ids``, ``latest``, ``days_covered`` and ``rows = ids`` (A5, A6), exact."""
    out = summary.agg(F.sum("rows").alias("rows"), F.sum("distinct_keys").alias("ids"),
                      F.max("latest").alias("latest"),
                      F.size(F.array_distinct(F.flatten(F.collect_list("days")))).cast("bigint").alias("days_covered"))
    return out.withColumn("dedup_held", F.col("rows") == F.col("ids"))


def distinct_estimates(summary: DataFrame) -> DataFrame:
    """``(column, estimate, low, high)`` of the sketched columns; the bounds are three standard errors."""
    names = [c.removeprefix("sketch_") for c in summary.columns if c.startswith("sketch_")]
    merged = summary.agg(*[F.hll_sketch_estimate(F.hll_union_agg(f"sketch_{c}")).alias(c) for c in names])
    each = merged.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("estimate"))
                                             for c in names])).alias("r")).select("r.*")
    return each.withColumns({"low": F.col("estimate") / (1 + 3 * SKETCH_ERROR),
                             "high": F.col("estimate") / (1 - 3 * SKETCH_ERROR)})
