"""Reading finished tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_nonempty(spark: SparkSession, name: str) -> DataFrame:
    """``spark.table(name)``, refusing an empty table (S6 + G1).

    The check reads at most one row.
    """
    df = spark.table(name)
    if df.isEmpty():
        raise ValueError(f"table {name} is empty; it will not be used")
    return df


def spread(df: DataFrame, minimum: int | None = None) -> DataFrame:
    """Round-robin ``df`` over ``minimum`` partitions only if its scan yields fewer.

    Large inputs (many files or row groups) already have more scan splits than
    the cluster has cores, so this is a no-op there and costs no shuffle. A
    small or single-row-group file would otherwise put CPU-heavy row work
    (tokenising, JSON checks) into one task. Meant for scan-level frames:
    counting the partitions of a frame with an adaptive shuffle would run it.
    """
    minimum = minimum or df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= minimum:
        return df
    return df.repartition(minimum)


def read_jdbc(spark: SparkSession, url: str, table: str, schema: str | None = "app",
              partition_column: str | None = None, lower_bound: int | None = None,
              upper_bound: int | None = None, num_partitions: int | None = None,
              properties: dict | None = None) -> DataFrame:
    """One RDBMS table as a DataFrame.

    With ``partition_column`` and bounds the read is split into
    ``num_partitions`` range queries run by the executors in parallel; without
    them it is a single query.
    """
    qualified = f"{schema}.{table}" if schema else table
    props = dict(properties or {})
    if partition_column is not None:
        return spark.read.jdbc(url, qualified, column=partition_column,
                               lowerBound=lower_bound, upperBound=upper_bound,
                               numPartitions=num_partitions or 8, properties=props)
    return spark.read.jdbc(url, qualified, properties=props)
