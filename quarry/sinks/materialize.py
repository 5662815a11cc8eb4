"""Materialising relations."""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import latest_per_key
from ..operators.joins import unseen_keys


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def bucket_count(df: DataFrame, buckets: int | None) -> int:
    """The bucket count: ``buckets``, else ``spark.sql.shuffle.partitions``."""
    return buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def by_bucket(df: DataFrame, bucket_by: str, n: int) -> DataFrame:
    """``df`` laid out one bucket per task before a write bucketed ``n`` ways on ``bucket_by``.

    A bucketed write makes every task write one file per bucket it holds, so
    input not partitioned on the key (T tasks each holding all n buckets)
    would leave T x n small files. Repartitioning on the bucket column with
    the bucket count applies the bucket function itself (Murmur3 hash mod n),
    so each bucket is written once. Spark drops this exchange when the input is
    already so partitioned (a bucketed read, or a shuffle on the key into n
    partitions). The tables bucketed here are keyed uniquely (``posting_id``,
    ``tag``), so no bucket is hot.
    """
    return df.repartition(n, bucket_by)


def as_table(df: DataFrame, name: str, partition_by: list[str] | None = None,
             bucket_by: str | None = None, buckets: int | None = None) -> DataFrame:
    """Full rebuild of a managed table (K4); returns a frame reading it back.

    Downstream steps read the stored result, so the source files are scanned
    once per build rather than once per consumer. ``bucket_by`` stores the
    table hash-bucketed on that key: tables bucketed on the same key with the
    same bucket count are then grouped and joined on it without any shuffle.
    ``buckets`` defaults to ``spark.sql.shuffle.partitions`` (size it so one
    bucket fits a task at the target scale).
    """
    n = bucket_count(df, buckets)
    writer = (by_bucket(df, bucket_by, n) if bucket_by else df).write.mode("overwrite")
    writer = writer.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _split(spark: SparkSession, name: str) -> tuple[str, str]:
    db, _, short = name.rpartition(".")
    return (db or spark.catalog.currentDatabase()), short


VERSION_PROPERTY = "quarry.version_of"
CURRENT_PROPERTY = "quarry.current"


def versions(spark: SparkSession, name: str) -> list[str]:
    """Qualified names of the stored versions of ``name``, oldest first.

    Only tables whose whole name has the form that ``write_version`` gives and
    that carry its mark for this very relation: a neighbour named alike is
    nobody's version.
    """
    db, short = _split(spark, name)
    form = re.compile(re.escape(short.lower()) + r"__v[0-9]{14}_[0-9a-f]{8}")
    return _marked_tables(spark, db, short, form)


def _marked_tables(spark: SparkSession, db: str, short: str, form: re.Pattern) -> list[str]:
    found = [t.name for t in spark.catalog.listTables(dbName=db)
             if not t.isTemporary and form.fullmatch(t.name.lower())]
    return [f"{db}.{n}" for n in sorted(found) if _marked(spark, f"{db}.{n}", short)]


ADDED, GONE = "d", "g"  # kinds of tables that stand beside a version


def deltas(spark: SparkSession, version: str, kinds: str = ADDED) -> list[str]:
    """Stored additions to ``version`` (``write_version(..., onto=version)``), oldest first.

    ``kinds`` may name further tables beside the version.
    """
    db, short = _split(spark, version)
    form = re.compile(re.escape(short.lower()) + rf"__[{kinds}][0-9]{{14}}_[0-9a-f]{{8}}")
    return _marked_tables(spark, db, short, form)


def table_property(spark: SparkSession, table: str, key: str) -> str | None:
    marks = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {table}").collect()}
    return marks.get(key)


def _marked(spark: SparkSession, table: str, short: str) -> bool:
    return table_property(spark, table, VERSION_PROPERTY) == short.lower()


def current_version(spark: SparkSession, name: str) -> str | None:
    """The version that view ``name`` stands on; NULL where ``name`` is no such view."""
    if not spark.catalog.tableExists(name):
        return None
    return table_property(spark, name, CURRENT_PROPERTY)


PINNED_PROPERTY = "quarry.pinned_by"


def pins(spark: SparkSession, version: str) -> set[str]:
    """Published relations that stand on ``version``: it is not dropped while there are any."""
    return set(filter(None, (table_property(spark, version, PINNED_PROPERTY) or "").split(",")))


def pin(spark: SparkSession, version: str, by: str, held: bool = True) -> None:
    """Note (or, with ``held=False``, strike out) that relation ``by`` stands on ``version``."""
    now = pins(spark, version) | {by} if held else pins(spark, version) - {by}
    spark.sql(f"ALTER TABLE {version} SET TBLPROPERTIES ('{PINNED_PROPERTY}' = '{','.join(sorted(now))}')")


def swap_in(spark: SparkSession, name: str, put) -> None:
    """Run ``put()``, which creates relation ``name``, in place of a plain table of that name.

    The old table is renamed aside first and dropped only after ``put`` has
    succeeded; if it fails the old table gets its name back.
    """
    aside = None
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        aside = f"{name}__aside_{uuid.uuid4().hex[:8]}"
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
    try:
        put()
    except Exception:
        if aside:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        raise
    if aside:
        spark.sql(f"DROP TABLE {aside}")


def write_version(df: DataFrame, name: str, bucket_by: str | None = None,
                  buckets: int | None = None, stamp: str | None = None,
                  align: bool = True, onto: str | None = None, kind: str = ADDED
                  ) -> tuple[str, int]:
    """Write ``df`` once to a new table ``{name}__v{stamp}_{id}``; return it and its row count.

    Version names sort by creation time, so the newest is last. ``align=False``
    skips ``by_bucket`` for input the caller knows is already laid out one
    bucket per task but whose plan cannot show it (a full outer join on the
    bucket key reports unknown partitioning). With ``onto``, a version of ``name``,
    the table is an addition to it, or of another ``kind``: ``{onto}__d{stamp}_{id}``.
    """
    stamp = stamp or dt.datetime.now(tz=dt.UTC).strftime("%Y%m%d%H%M%S")
    kind, of = (kind, onto) if onto else ("v", name)
    version = f"{of}__{kind}{stamp}_{uuid.uuid4().hex[:8]}"
    obs = Observation(f"version_{uuid.uuid4().hex[:8]}")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    n = bucket_count(df, buckets)
    writer = ((by_bucket(observed, bucket_by, n) if bucket_by and align else observed)
              .write.mode("errorifexists").format("parquet"))
    if bucket_by:
        writer = writer.bucketBy(n, bucket_by)
    writer.saveAsTable(version)
    short = _split(df.sparkSession, of)[1].lower()
    df.sparkSession.sql(
        f"ALTER TABLE {version} SET TBLPROPERTIES ('{VERSION_PROPERTY}' = '{short}')")
    return version, int(obs.get["rows"])


def point_view(spark: SparkSession, name: str, version: str, comment: str | None = None,
               keep_previous: int = 1, body: str | None = None) -> None:
    """Re-point view ``name`` at ``version`` in one statement; drop versions beyond
    ``keep_previous`` that nothing else stands on.

    ``body`` is the query the view holds where that is more than all of ``version``.

    Metadata only: no data is moved and readers never see a missing relation.
    A plain table already holding the name (a first run over an older layout)
    is kept aside until the view stands.
    """
    clause = f" COMMENT '{comment}'" if comment else ""
    clause += f" TBLPROPERTIES ('{CURRENT_PROPERTY}' = '{version}')"
    swap_in(spark, name, lambda: spark.sql(
        f"CREATE OR REPLACE VIEW {name}{clause} AS {body or f'SELECT * FROM {version}'}"))
    db, short = _split(spark, version)
    current = f"{db}.{short}"
    older = [v for v in versions(spark, name) if v != current]
    for stale in older[:max(0, len(older) - keep_previous)]:
        if pins(spark, stale):
            continue
        for part in [*deltas(spark, stale, ADDED + GONE), stale]:
            spark.sql(f"DROP TABLE IF EXISTS {part}")


def as_versioned(df: DataFrame, name: str, bucket_by: str | None = None,
                 buckets: int | None = None) -> DataFrame:
    """Full rebuild behind a view (K4): readers keep the old rows until the new ones stand.

    A failed build leaves the view where it was. Layout as in ``as_table``.
    """
    version, _ = write_version(df, name, bucket_by, buckets)
    point_view(df.sparkSession, name, version)
    return df.sparkSession.table(name)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A lazy named relation (K5)."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def ensure_table(spark: SparkSession, name: str, schema) -> None:
    """Create an empty table of the given shape (StructType or DDL) if it is missing."""
    if not table_exists(spark, name):
        spark.createDataFrame([], schema).write.format("parquet").saveAsTable(name)


def append_unseen(spark: SparkSession, rows: DataFrame, name: str, key: str) -> int:
    """Append the rows of ``rows`` whose ``key`` is not in table ``name``.

    Existing rows are kept; an empty increment is a success that leaves the
    table as it is. The key stays unique: of several new rows of one key the one
    with the smallest row hash is appended, and NULL is a key like any other (one
    row, once). Returns the number of rows appended.
    """
    ensure_table(spark, name, rows.schema)
    seen = spark.table(name).select(F.col(key).alias("__seen"))
    once = latest_per_key(rows, key, [F.xxhash64(*rows.columns)])
    new = once.join(seen, F.col(key).eqNullSafe(F.col("__seen")), "left_anti")
    obs = Observation(f"append_{name}")
    new.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(
        "parquet").saveAsTable(name)
    return int(obs.get["rows"])


def append_ledger(spark: SparkSession, rows: DataFrame, name: str = "ops.dbt_test_runs") -> int:
    """Append run-ledger rows (K10); zero rows writes nothing, not even the table."""
    if rows.isEmpty():
        return 0
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    obs = Observation("ledger")
    rows.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(
        "parquet").saveAsTable(name)
    return int(obs.get["rows"])


def new_keys(candidates: DataFrame, key: str, spark: SparkSession, name: str) -> DataFrame:
    """Keys of ``candidates`` not yet in table ``name`` (J3 on a stored target)."""
    seen = spark.table(name) if table_exists(spark, name) else None
    return unseen_keys(candidates, key, seen)
