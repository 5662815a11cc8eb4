"""Newest version per key, maintained by Structured Streaming.

The landing folder is a file stream: each trigger picks up files not seen
before (a new day needs no change anywhere). ``start`` keeps the postings
staging table current without any streaming state and without rewriting
history: every micro-batch is reduced to the newest version per ``posting_id``
with the batch ``newest`` ordering and stored as a small addition to the current
version. The table name is a view that merges the version with its additions as
``plans.staging.merge_newest`` does: the version is read through its
``posting_id`` buckets, so a reader shuffles the additions only. Every
``compact_every`` additions the view's rows become the next version. After any
number of triggers the table equals ``postings.stage`` over the same files. A
re-run micro-batch (after a failure) adds the same rows again, which changes
nothing.

``newest_by_max`` is the stateful form of the same reduction, a streaming
aggregation of ``max(struct(order..., payload...))`` with one state row per
key, for streams whose result is small enough to re-emit each trigger.

``merge_batch`` keeps one version per key, so a record that a replayed day withdraws
stays (X3), and a file rewritten in place is not read again. ``start(withdraw=True)``
follows replays instead: see ``streaming.replays``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..plans.postings import STAGING_COLUMNS, newest, rename_raw, version_order
from ..plans.staging import merge_newest
from ..sinks.materialize import current_version, deltas, point_view, write_version
from ..sources.landing import POSTING_DDL

STATE_STORE_KEY = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def landing_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None
                   ) -> DataFrame:
    """The landing zone as an unbounded table, lineage columns included."""
    schema = StructType.fromDDL(POSTING_DDL + ", ingest_date date")
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.json(root)
            .withColumn("source_file", F.col("_metadata.file_path"))
            .withColumn("ingested_at", F.col("_metadata.file_modification_time")))


def newest_by_max(df: DataFrame, key: str, order_cols, payload_cols) -> DataFrame:
    """One row per ``key``: the row that is greatest under ``order_cols``.

    ``max(struct(order..., payload...))`` is an algebraic aggregate (partial per
    task, then merged), valid in a streaming aggregation and equal to the batch
    ``row_number() over (partition by key order by order_cols desc) = 1`` when
    the order columns are unique per key.
    """
    version = F.struct(*[F.col(c) for c in order_cols], *[F.col(c) for c in payload_cols])
    newest = df.groupBy(key).agg(F.max(version).alias("__v"))
    return newest.select(key, *[F.col(f"__v.{c}").alias(c) for c in [*order_cols, *payload_cols]])


def _started(spark: SparkSession, writer, state_partitions: int | None) -> StreamingQuery:
    """Start ``writer``; ``state_partitions`` sizes its stateful shuffle.

    A streaming aggregation keeps ``spark.sql.shuffle.partitions`` state
    partitions for the life of its checkpoint (micro-batches are not coalesced
    by AQE), so the count is chosen when the query first starts. State lives in
    RocksDB unless the session names another provider: off the JVM heap and
    checkpointed incrementally, so a large key count neither fills the heap
    nor rewrites all state each trigger. The stream runs in a clone of the
    session, so the settings are restored right after.
    """
    settings = {STATE_STORE_KEY: spark.conf.get(STATE_STORE_KEY, None) or ROCKSDB_PROVIDER}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    previous = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in previous.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def run_to_table(df: DataFrame, path: str, checkpoint: str,
                 state_partitions: int | None = None) -> None:
    """Drain a streaming aggregation into parquet at ``path`` (complete result, availableNow)."""

    def write(batch: DataFrame, _epoch: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    writer = (df.writeStream.outputMode("complete").option("checkpointLocation", checkpoint)
              .foreachBatch(write).trigger(availableNow=True))
    query = _started(df.sparkSession, writer, state_partitions)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))


COMPACT_EVERY = 16


def _reduced_sql(rows: str, order: list[str]) -> str:
    """The newest row per key of relation ``rows`` (a NULL key is one key)."""
    columns = ", ".join(STAGING_COLUMNS)
    newest_first = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    return f"""
          SELECT {columns} FROM (
            SELECT *, row_number() OVER (PARTITION BY posting_id ORDER BY {newest_first}) AS nth
            FROM {rows}) WHERE nth = 1"""


def merged_sql(base: str, additions: list[str], newest_by_day: bool) -> str:
    """``merge_newest(base, newest(additions))`` as the text of a view.

    ``base`` and ``additions`` are relations or queries in brackets; ``base`` holds one
    row per key. A file's records are all in one part, or the same in two after a
    re-run: rows of one key that tie across parts are equal, so no row hash has to choose.
    """
    order = version_order(newest_by_day)
    columns = ", ".join(STAGING_COLUMNS)
    if not additions:
        return f"SELECT {columns} FROM {base}"
    newest_first = ", ".join(f"{c} DESC NULLS LAST" for c in order)
    union = " UNION ALL ".join(f"SELECT {columns} FROM {t}" for t in additions)
    p, f = (f"struct({', '.join(f'{side}.{c}' for c in order)})" for side in "pf")
    picked = ", ".join(f"if(p.posting_id IS NULL OR (f.posting_id IS NOT NULL AND {f} > {p}), "
                       f"f.{c}, p.{c}) AS {c}" for c in STAGING_COLUMNS)
    return f"""
        WITH fresh AS ({_reduced_sql(f'({union})', order)}),
        no_key AS (
          SELECT {columns} FROM (
            SELECT {columns} FROM {base} WHERE posting_id IS NULL
            UNION ALL SELECT {columns} FROM fresh WHERE posting_id IS NULL)
          ORDER BY {newest_first} LIMIT 1)
        SELECT {picked}
        FROM (SELECT * FROM {base} WHERE posting_id IS NOT NULL) p
        FULL OUTER JOIN (SELECT * FROM fresh WHERE posting_id IS NOT NULL) f
          ON p.posting_id = f.posting_id
        UNION ALL SELECT {columns} FROM no_key"""


def merge_batch(batch: DataFrame, table: str, buckets: int | None = None,
                newest_by_day: bool = False, compact_every: int = COMPACT_EVERY) -> None:
    """Fold one micro-batch of landed records into staging table ``table``.

    Writes the batch's own rows only, but for every ``compact_every``-th call, which
    also writes the next version: history is rewritten once in that many triggers.
    NULL keys are one key, as in ``newest``; an empty batch changes nothing.
    """
    spark = batch.sparkSession
    fresh = newest(rename_raw(batch), newest_by_day)
    by_key = {"bucket_by": "posting_id", "buckets": buckets}
    version = current_version(spark, table)
    if version is None:
        if spark.catalog.tableExists(table):  # a relation of an older layout
            fresh = merge_newest(spark.table(table), fresh, newest_by_day)
        version, _ = write_version(fresh, table, **by_key)
        point_view(spark, table, version)
        return
    # Additions are not bucketed: they are small, and their union must be shuffled.
    addition, rows = write_version(fresh, table, onto=version)
    if rows == 0:
        spark.sql(f"DROP TABLE {addition}")
        return
    additions = deltas(spark, version)
    point_view(spark, table, version, body=merged_sql(version, additions, newest_by_day))
    if len(additions) >= compact_every:
        # Read through the version's buckets: already one bucket per task.
        compacted, _ = write_version(spark.table(table), table, align=False, **by_key)
        point_view(spark, table, compacted)


def start(spark: SparkSession, root: str, table: str, checkpoint: str,
          available_now: bool = True, max_files_per_trigger: int | None = None,
          buckets: int | None = None, compact_every: int = COMPACT_EVERY,
          interval: str = "1 minute", newest_by_day: bool = False,
          withdraw: bool = False) -> StreamingQuery:
    """Keep ``table`` equal to the newest version per key of every landed file.

    Stateless: the stream only tracks which files it has read (in
    ``checkpoint``); the table itself carries the result between triggers. Drains
    what is there by default, else looks again every ``interval``. With ``withdraw``
    the table also follows replayed days (X3, ``replays.merge_live``); a table is
    kept in one way for its whole life, as is ``newest_by_day``.
    """
    from .replays import merge_live

    def write(batch: DataFrame, _epoch: int) -> None:
        if withdraw:
            merge_live(batch, root, table, buckets, newest_by_day, compact_every)
        else:
            merge_batch(batch, table, buckets, newest_by_day, compact_every)

    writer = (landing_stream(spark, root, max_files_per_trigger)
              .writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(write))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
