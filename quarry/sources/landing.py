"""Reading payloads and the landing zone.

* ``unwrap_payloads`` (S1): a payload file holds either a JSON list of records
  or an object whose ``data`` member is that list; anything else fails the
  job. One file is one row, so scale comes from many payload files read in
  parallel. Each record comes out as its own JSON text (objects keep their key
  order; scalars keep their quotes), with its file and position.
* ``read_landing`` (S2-S5): every NDJSON file under the landing root, read
  under a pinned schema (fields absent from older files are NULL; a value of
  the wrong JSON type makes that field NULL and keeps the line in
  ``_corrupt_record``); ``ingest_date=`` folders become a DATE column and the
  hidden ``_metadata`` struct supplies file path and modification time.
* ``stray_files`` lists files a partitioned read silently skips.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.answers import whole_json

# Pinned field types of a raw posting (source names, before renaming).
POSTING_DDL = ("slug string, title string, company_name string, location string, "
               "remote boolean, tags array<string>, created_at bigint")
CORRUPT_COL = "_corrupt_record"


def posting_schema(with_corrupt: bool = True) -> StructType:
    ddl = POSTING_DDL + (f", {CORRUPT_COL} string" if with_corrupt else "")
    return StructType.fromDDL(ddl)


def unwrap(df: DataFrame, payload_col: str = "value", keep: tuple[str, ...] = ()
           ) -> DataFrame:
    """``(*keep, position, raw)``: one row per record of every payload in ``payload_col``.

    A payload is a JSON list of records or an object whose ``data`` member is
    that list; anything else fails the job naming what it got.
    """
    v = whole_json(payload_col)
    kind = F.schema_of_variant(v)
    data_kind = F.schema_of_variant(F.try_variant_get(v, "$.data", "variant"))
    is_list = kind.startswith("ARRAY")
    is_wrapped = kind.startswith("OBJECT") & F.coalesce(data_kind.startswith("ARRAY"), F.lit(False))
    got = F.coalesce(F.when(kind.startswith("OBJECT"), F.coalesce(data_kind, F.lit("OBJECT")))
                     .otherwise(kind), F.lit("invalid JSON"))
    # Text form keeps object key order; variant form keeps scalar quoting.
    texts = F.when(is_list, F.from_json(F.col(payload_col), "array<string>")).otherwise(
        F.from_json(F.col(payload_col), "struct<data: array<string>>")["data"])
    values = F.when(is_list, F.try_variant_get(v, "$", "array<variant>")).otherwise(
        F.try_variant_get(v, "$.data", "array<variant>"))
    checked = df.select(
        *keep,
        F.when(is_list | is_wrapped, F.arrays_zip(texts.alias("t"), values.alias("v")))
        .otherwise(F.raise_error(F.concat(F.lit("payload is neither a list nor an object around one: "), got)))
        .alias("records"))
    # The outer form, filtered after: from the inner one Spark infers a size(records) > 0
    # filter below the projection, which would parse every payload a second time.
    exploded = checked.select(*keep, F.posexplode_outer("records").alias("position", "r")).filter(
        F.col("position").isNotNull())
    element_kind = F.schema_of_variant(F.col("r.v"))
    structured = element_kind.startswith("OBJECT") | element_kind.startswith("ARRAY")
    raw = F.when(structured, F.col("r.t")).otherwise(F.to_json(F.col("r.v")))
    return exploded.select(*keep, "position", raw.alias("raw"))


def unwrap_payloads(spark: SparkSession, path: str) -> DataFrame:
    """``(source_file, position, raw)`` for every payload file under ``path``.

    One file is one row (``wholetext``), so scale comes from many payload
    files read in parallel.
    """
    files = (spark.read.text(path, wholetext=True)
             .select("value", F.col("_metadata.file_path").alias("source_file")))
    return unwrap(files, "value", keep=("source_file",))


def read_landing(spark: SparkSession, root: str, schema: StructType | None = None,
                 since: str | None = None) -> DataFrame:
    """Every landed record with ``source_file``, ``ingest_date``, ``ingested_at``.

    ``since`` (``YYYY-MM-DD``) prunes older ``ingest_date`` folders at listing
    time; leave it unset for the full history that latest-version dedup needs.
    """
    schema = schema or posting_schema()
    df = (spark.read.schema(schema)
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", CORRUPT_COL)
          .json(root))
    df = df.withColumn("source_file", F.col("_metadata.file_path")).withColumn(
        "ingested_at", F.col("_metadata.file_modification_time"))
    if since is not None:
        df = df.filter(F.col("ingest_date") >= F.lit(since).cast("date"))
    return df


def stray_files(spark: SparkSession, root: str) -> DataFrame:
    """``(path)`` of files under ``root`` that are not inside an ``ingest_date=`` folder.

    Such files are skipped by a partitioned read without any warning. Only file
    paths are listed (the binary reader does not load contents that are not
    selected).
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .load(root).select("path"))
    return files.filter(~F.col("path").rlike(r"/ingest_date=[^/]+/[^/]+$"))
