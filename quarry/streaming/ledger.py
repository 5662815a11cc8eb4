"""The run ledger, each node of each run once.

Run-results documents arrive as files; a stream picks up files not seen before and its
epoch number is the key of what it writes: an epoch owns one partition of the ledger and
replaces that partition whole, so a task or an epoch run again after a failure leaves the
same rows, not twice as many. Rows that another epoch holds already (a document landed a
second time, a run reported twice) are left out before the write; inside an epoch equal
keys are reduced to one row. A row's key is run, node and time of the run: documents
without a run id share the id ``unknown`` and are told apart by their time.

The ledger is a plain partitioned table. ``append_once`` is the same write for a batch of
rows, under a name of the caller's for the batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.dedup import latest_per_key
from ..session import checkpoint_dir
from ..sources.run_results import LEDGER_DDL, RUN_RESULTS_DDL, node_rows

KEY = ["invocation_id", "node", "run_at"]
BATCH = "batch"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
COLUMNS = [f.split()[0] for f in LEDGER_DDL.split(", ")]


def run_results_stream(spark: SparkSession, folder: str, multi_line: bool = True) -> DataFrame:
    """Run-results documents below ``folder`` as an unbounded table; broken ones have no results."""
    schema = StructType.fromDDL(RUN_RESULTS_DDL + ", _corrupt_record string")
    return (spark.readStream.schema(schema).option("mode", "PERMISSIVE")
            .option("multiLine", multi_line).json(folder))


def _ensure(spark: SparkSession, name: str) -> None:
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    if not spark.catalog.tableExists(name):
        spark.sql(f"CREATE TABLE {name} ({LEDGER_DDL}, {BATCH} string) USING parquet PARTITIONED BY ({BATCH})")


def append_once(rows: DataFrame, name: str, batch: str) -> None:
    """Write the ledger rows of ``batch``; written again, they replace themselves.

    Rows whose key another batch holds are left out. NULL key columns equal each other.
    """
    spark = rows.sparkSession
    _ensure(spark, name)
    once = latest_per_key(rows.select(*COLUMNS), KEY, [F.xxhash64(*COLUMNS)])
    held = (spark.table(name).filter(F.col(BATCH) != batch)
            .select(*[F.col(c).alias(f"held_{c}") for c in KEY]).distinct())
    same = F.lit(True)
    for c in KEY:
        same = same & F.col(c).eqNullSafe(F.col(f"held_{c}"))
    fresh = once.join(held, same, "left_anti")
    # Spark refuses to overwrite a table that the query reads, so the rows are cut off first.
    checkpoint_dir(spark)
    settled = fresh.withColumn(BATCH, F.lit(batch)).checkpoint(eager=True)
    previous = spark.conf.get(OVERWRITE_MODE)
    spark.conf.set(OVERWRITE_MODE, "dynamic")  # insertInto takes it from the session alone
    try:
        settled.write.mode("overwrite").insertInto(name)
    finally:
        spark.conf.set(OVERWRITE_MODE, previous)


def follow_runs(spark: SparkSession, folder: str, name: str, checkpoint: str,
                stream: str = "runs", multi_line: bool = True, available_now: bool = True,
                interval: str = "1 minute") -> StreamingQuery:
    """Keep ledger ``name`` up with the documents below ``folder``.

    ``stream`` names this stream among all that write the ledger: with the epoch number
    it is the key of a write. A stream started anew from an empty ``checkpoint`` reads all
    documents again, finds their rows held by the old epochs, and must have another name.
    """
    def write(batch: DataFrame, epoch: int) -> None:
        append_once(node_rows(batch), name, f"{stream}-{epoch}")

    writer = (run_results_stream(spark, folder, multi_line).writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint).foreachBatch(write))
    if available_now:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
