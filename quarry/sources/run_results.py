"""A build tool's run-results document as a table.

One JSON document per run holds ``metadata`` and a ``results`` array, one
element per executed node. It becomes one row per node:
``invocation_id, node, resource_type, status, execution_time, message, run_at``.
A missing or unreadable file gives zero rows, never an error.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.errors import AnalysisException

from ..functions.text import clip, first_segment
from ..functions.time import iso_prefix_timestamp

RUN_RESULTS_DDL = (
    "metadata struct<invocation_id: string, generated_at: string>, "
    "results array<struct<unique_id: string, status: string, execution_time: double, "
    "message: string>>"
)
LEDGER_DDL = ("invocation_id string, node string, resource_type string, status string, "
              "execution_time double, message string, run_at timestamp")


def node_rows(doc: DataFrame) -> DataFrame:
    """Project parsed documents to one ledger row per node."""
    nodes = doc.select(
        F.coalesce(F.col("metadata.invocation_id"), F.lit("unknown")).alias("invocation_id"),
        F.col("metadata.generated_at").alias("generated_at"),
        F.explode("results").alias("r"))
    node = F.coalesce(F.col("r.unique_id"), F.lit(""))
    return nodes.select(
        "invocation_id",
        node.alias("node"),
        first_segment(node).alias("resource_type"),
        F.coalesce(F.col("r.status"), F.lit("")).alias("status"),
        F.coalesce(F.col("r.execution_time"), F.lit(0.0)).cast("double").alias("execution_time"),
        clip(F.coalesce(F.col("r.message"), F.lit("")), 400).alias("message"),
        iso_prefix_timestamp(F.col("generated_at")).alias("run_at"),
    )


def read_run_results(spark: SparkSession, path: str) -> DataFrame:
    """Ledger rows of every run-results document under ``path``."""
    schema = StructType.fromDDL(RUN_RESULTS_DDL + ", _corrupt_record string")
    try:
        doc = (spark.read.option("multiLine", True).option("mode", "PERMISSIVE")
               .schema(schema).json(path))
    except AnalysisException:
        return spark.createDataFrame([], LEDGER_DDL)
    return node_rows(doc)


def summarise(rows: DataFrame) -> DataFrame:
    """Nodes per status."""
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
