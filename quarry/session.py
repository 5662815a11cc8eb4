"""Session settings every step relies on.

* ``spark.sql.session.timeZone=UTC`` so ``date(posted_at)`` does not move with
  the machine's zone.
* AQE on, with skew-join splitting and partition coalescing, so a hot key or a
  tiny shuffle is re-planned at runtime rather than guessed up front.
* ``spark.sql.variant.allowDuplicateKeys`` so a JSON object with a repeated key
  parses with the last value winning, like Python's ``json`` module.

``configure`` only sets options on a session a caller already owns; it never
stops or replaces it.
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results, not just speed. Applied to every session.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A JSON answer with a repeated key keeps the last value, as Python's json does.
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}

# Execution settings: runtime re-planning for skew and small shuffles.
# No broadcast is planned from file-size estimates (they grow with the data and
# are not a bound); a side is broadcast either after its rows and bytes were
# measured under explicit bounds (operators.joins.bounded_broadcast) or by AQE
# once its shuffle output has been measured below the adaptive threshold.
EXECUTION_SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting and execution settings to an existing session."""
    for key, value in {**RESULT_SETTINGS, **EXECUTION_SETTINGS}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int = 8, shuffle_partitions: int | None = None,
                  app_name: str = "quarry") -> SparkSession:
    """A local session for tests and the bench; clusters pass their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cores))
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Checkpoints go once no frame refers to them; a cluster sets it for itself.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    for key, value in {**RESULT_SETTINGS, **EXECUTION_SETTINGS}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage.

    A cluster names it in ``spark.checkpoint.dir``; it is read from the session
    and never overridden. Only when it is unset on a ``local`` master (tests,
    the bench) is a scratch folder created and registered; on a cluster an
    unset folder is an error, since a machine-local folder is not shared.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set: name a shared folder for it")
    local = tempfile.mkdtemp(prefix="quarry-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


@contextlib.contextmanager
def shared_folder(spark: SparkSession, name: str):
    """A new folder below ``checkpoint_dir``, deleted when the block is left."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    try:
        yield path
    finally:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
