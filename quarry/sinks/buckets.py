"""Copy-on-write tables of hash buckets (K4): a change rewrites the buckets it touches.

A table is stored as ``n`` buckets of one key, one folder each. A *version* is a catalog
table, partitioned by bucket number and bucketed on the key, whose partitions name the
folder that holds each bucket: a new version takes over the folders of the buckets that
did not change and names new ones for those that did. Only these are written. Readers
see a view, re-pointed in one statement once the version stands; versions stay readable
until the view has moved on twice, folders until no version names them.

The bucket number is the very function Spark buckets by (Murmur3 modulo ``n``), so a
folder holds one bucket's file, and scans of the table are as co-partitioned for joins
and aggregations on the key as those of a plain bucketed table.

What a version names is kept beside the data (``_manifest``), one row per bucket.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .materialize import (VERSION_PROPERTY, _split, bucket_count, current_version, point_view,
                          versions)

BUCKET = "bucket_no"


def bucket_of(key: str, n: int) -> Column:
    """The bucket of ``key`` as ``bucketBy`` and hash partitioning compute it (NULL has one too)."""
    return F.pmod(F.hash(key), F.lit(n))


def table_folder(spark: SparkSession, name: str) -> str:
    db, short = _split(spark, name)
    return f"{spark.catalog.getDatabase(db).locationUri.rstrip('/')}/{short.lower()}__buckets"


def manifest(spark: SparkSession, name: str, version: str) -> dict[int, str] | None:
    """``{bucket: folder}`` of a version (as many entries as buckets); None if it has none."""
    path = f"{table_folder(spark, name)}/_manifest/{_split(spark, version)[1]}"
    if not _exists(spark, path):
        return None
    rows = spark.read.schema("bucket int, folder string").json(path).collect()
    return {r["bucket"]: r["folder"] for r in rows}


def _filesystem(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _exists(spark: SparkSession, path: str) -> bool:
    fs, folder = _filesystem(spark, path)
    return fs.exists(folder)


def _stored(df: DataFrame, folder: str, table: str, key: str, n: int, align: bool) -> None:
    """Write ``df`` to ``folder`` as external ``table``, one file per bucket it holds."""
    rows = df.withColumn(BUCKET, bucket_of(key, n))
    rows = rows.repartition(n, key) if align else rows
    (rows.write.format("parquet").partitionBy(BUCKET).bucketBy(n, key).option("path", folder)
     .mode("errorifexists").saveAsTable(table))


def write_buckets(df: DataFrame, name: str, key: str, buckets: int | None = None,
                  previous: str | None = None, touched: list[int] | None = None,
                  align: bool = True) -> str:
    """Store ``df`` as a new version of ``name`` and point the view at it; return the version.

    Without ``previous``, ``df`` is the whole table. With it, ``df`` holds all rows of the
    ``touched`` buckets and the other buckets stay those of ``previous``. ``align=False``
    skips the exchange for rows known to be laid out one bucket per task.
    """
    spark = df.sparkSession
    base = manifest(spark, name, previous) if previous else {}
    n = len(base) or bucket_count(df, buckets)
    stamp = f"{dt.datetime.now(tz=dt.UTC).strftime('%Y%m%d%H%M%S')}_{uuid.uuid4().hex[:8]}"
    db, short = _split(spark, name)
    root = table_folder(spark, name)
    folder = f"{root}/{stamp}"
    version, part = f"{name}__v{stamp}", f"{db}.{short}__w{stamp}"
    _stored(df, folder, part, key, n, align)
    spark.sql(f"DROP TABLE {part}")  # external: its files stay
    changed = range(n) if touched is None else touched
    folders = base | {b: f"{folder}/{BUCKET}={b}" for b in changed}
    _name_version(spark, version, df, key, n, folder, folders)
    _write_manifest(spark, f"{root}/_manifest/{_split(spark, version)[1]}", folders)
    columns = ", ".join(f"`{c}`" for c in df.columns)
    known = {v: manifest(spark, name, v) or {} for v in versions(spark, name)}
    point_view(spark, name, version, body=f"SELECT {columns} FROM {version}")
    _drop_unnamed(spark, name, known)
    return version


def _name_version(spark: SparkSession, version: str, df: DataFrame, key: str, n: int, folder: str,
                  folders: dict[int, str]) -> None:
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    short = _split(spark, version)[1].rsplit("__v", 1)[0].lower()
    spark.sql(f"CREATE TABLE {version} ({ddl}, {BUCKET} INT) USING parquet "
              f"PARTITIONED BY ({BUCKET}) CLUSTERED BY (`{key}`) INTO {n} BUCKETS "
              f"LOCATION '{folder}' TBLPROPERTIES ('{VERSION_PROPERTY}' = '{short}')")
    held = " ".join(f"PARTITION ({BUCKET}={b}) LOCATION '{at}'" for b, at in sorted(folders.items())
                    if _exists(spark, at))
    if held:
        spark.sql(f"ALTER TABLE {version} ADD IF NOT EXISTS {held}")


def _write_manifest(spark: SparkSession, path: str, folders: dict[int, str]) -> None:
    rows = spark.createDataFrame(sorted(folders.items()), "bucket int, folder string")
    rows.coalesce(1).write.mode("overwrite").json(path)


def _drop_unnamed(spark: SparkSession, name: str, known: dict[str, dict[int, str]]) -> None:
    """Delete the folders that only versions dropped since ``known`` was read have named."""
    kept = versions(spark, name)
    named = {at for v in kept for at in (manifest(spark, name, v) or {}).values()}
    for version, folders in known.items():
        if version in kept:
            continue
        for at in [*(set(folders.values()) - named),
                   f"{table_folder(spark, name)}/_manifest/{_split(spark, version)[1]}"]:
            fs, folder = _filesystem(spark, at)
            fs.delete(folder, True)


def drop_buckets(spark: SparkSession, name: str) -> None:
    """Remove the view, its versions and their files."""
    stored = versions(spark, name)
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for version in stored:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
    fs, folder = _filesystem(spark, table_folder(spark, name))
    fs.delete(folder, True)


def touched_buckets(rows: DataFrame, key: str, n: int) -> list[int]:
    """Buckets that hold a key of ``rows``, ascending (at most ``n`` rows on the driver)."""
    found = rows.select(bucket_of(key, n).alias("b")).distinct()
    return sorted(r["b"] for r in found.collect())


def only(spark: SparkSession, version: str, touched: list[int]) -> DataFrame:
    """The rows of some buckets; the others' files are not listed, let alone read."""
    return spark.table(version).filter(F.col(BUCKET).isin(touched)).drop(BUCKET)


def stored_in_buckets(spark: SparkSession, name: str) -> str | None:
    """The current version of ``name`` if it has a manifest."""
    version = current_version(spark, name)
    return version if version and manifest(spark, name, version) is not None else None
