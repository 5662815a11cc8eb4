"""Intermediate tables in the cluster's shared folder, removed when the operator is done."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir


class Scratch:
    """Writes frames as Parquet below ``spark.checkpoint.dir`` and reads them back.

    A stored table cuts lineage and survives lost executors. Leaving the ``with``
    block deletes all of them, so what outlives it must be ``keep``-ed.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        self.count = 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        self._delete(self.root)

    def save(self, df: DataFrame, by: str | None = None) -> DataFrame:
        path = f"{self.root}/{self.count}"
        self.count += 1
        writer = df.write
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        """The result: a reliable checkpoint, removed with the frame where the session has
        ``spark.cleaner.referenceTracking.cleanCheckpoints``."""
        return df.checkpoint(eager=True)

    def drop(self, df: DataFrame) -> None:
        """Delete one saved table early, once nothing reads it any more."""
        for source in df.inputFiles()[:1]:
            at = source.index(self.root.rsplit("/", 1)[1])
            name = source[at:].split("/")[1]
            self._delete(f"{self.root}/{name}")

    def _delete(self, path: str) -> None:
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)
