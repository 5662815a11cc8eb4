"""Published contracts (G3): a registry of agreed schemas, and what a new schema changes.

A schema is stored as rows, one per place in it: columns, fields of structs (``a.b``),
elements of arrays (``a[]``), keys and values of maps (``a{key}``, ``a{value}``). Two schemas
differ by a join of their rows, however deep the difference lies; of a change that takes
its whole subtree along only the top is named.

Breaking are a place that is removed (a rename is a removal and an addition), retyped, or
that may now be NULL; added places and places that are no longer NULL are not.
``register_contract`` keeps every agreed version in ``{table}__contract``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

PLACE_DDL = "path string, parent string, type string, nullable boolean"
REMOVED, ADDED, RETYPED = "removed", "added", "retyped"
LOOSENED, TIGHTENED = "may be null now", "not null now"


def places(schema: StructType) -> list[tuple[str, str, str, bool]]:
    """``(path, parent, type, nullable)`` of every place of ``schema``."""
    out: list[tuple[str, str, str, bool]] = []

    def walk(path: str, parent: str, kind: DataType, nullable: bool) -> None:
        nested = isinstance(kind, (StructType, ArrayType, MapType))
        out.append((path, parent, kind.typeName() if nested else kind.simpleString(), nullable))
        if isinstance(kind, StructType):
            for f in kind.fields:
                walk(f"{path}.{f.name}", path, f.dataType, f.nullable)
        elif isinstance(kind, ArrayType):
            walk(f"{path}[]", path, kind.elementType, kind.containsNull)
        elif isinstance(kind, MapType):
            walk(f"{path}{{key}}", path, kind.keyType, False)
            walk(f"{path}{{value}}", path, kind.valueType, kind.valueContainsNull)

    for f in schema.fields:
        walk(f.name, "", f.dataType, f.nullable)
    return out


def place_rows(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame(places(schema), PLACE_DDL)


def schema_changes(agreed: DataFrame, proposed: DataFrame) -> DataFrame:
    """``(path, change, old_type, new_type, breaking)`` from two frames of places."""
    old, new = agreed.alias("o"), proposed.alias("n")
    both = old.join(new, F.col("o.path") == F.col("n.path"), "full_outer").select(
        F.coalesce("o.path", "n.path").alias("path"), F.coalesce("o.parent", "n.parent").alias("parent"),
        F.col("o.type").alias("old_type"), F.col("n.type").alias("new_type"),
        F.col("o.nullable").alias("old_null"), F.col("n.nullable").alias("new_null"))
    found = both.withColumn("change", F.when(F.col("new_type").isNull(), REMOVED)
                            .when(F.col("old_type").isNull(), ADDED)
                            .when(F.col("old_type") != F.col("new_type"), RETYPED)
                            .when(~F.col("old_null") & F.col("new_null"), LOOSENED)
                            .when(F.col("old_null") & ~F.col("new_null"), TIGHTENED)).filter("change IS NOT NULL")
    whole = found.filter(F.col("change").isin(REMOVED, ADDED, RETYPED)).select(F.col("path").alias("parent"))
    return found.join(whole, "parent", "left_anti").select(
        "path", "change", "old_type", "new_type",
        F.col("change").isin(REMOVED, RETYPED, LOOSENED).alias("breaking"))


def _contracts(table: str) -> str:
    return f"{table}__contract"


def register_contract(spark: SparkSession, table: str, schema: StructType) -> int:
    """Agree on ``schema`` for ``table`` as its next version; return the version (the last
    one if nothing has changed)."""
    name, version = _contracts(table), 1
    if spark.catalog.tableExists(name):
        version = spark.table(name).agg(F.max("version")).first()[0]
        if schema_changes(agreed_contract(spark, table), place_rows(spark, schema)).isEmpty():
            return version
        version += 1
    (place_rows(spark, schema).withColumn("version", F.lit(version).cast("bigint")).coalesce(1)
     .write.mode("append").format("parquet").saveAsTable(name))
    return version


def agreed_contract(spark: SparkSession, table: str, version: int | None = None) -> DataFrame:
    """The places of the last agreed schema of ``table``, or of a given version."""
    rows = spark.table(_contracts(table))
    version = version or rows.agg(F.max("version")).first()[0]
    return rows.filter(F.col("version") == version).drop("version")


def contract_changes(spark: SparkSession, table: str, proposed: StructType) -> DataFrame:
    """What ``proposed`` changes against the last agreed schema of ``table``."""
    return schema_changes(agreed_contract(spark, table), place_rows(spark, proposed))


def contract_diff(spark: SparkSession, agreed: StructType, proposed: StructType) -> DataFrame:
    """``(column_name, change, old_type, new_type, breaking)`` between two schemas."""
    return schema_changes(place_rows(spark, agreed), place_rows(spark, proposed)).withColumnRenamed(
        "path", "column_name")


def breaking_changes(spark: SparkSession, agreed: StructType, proposed: StructType) -> list[str]:
    """Texts of what ``proposed`` removes or retypes, nested places included.

    Computed on the driver from the two schemas; nullability is left out, since a stored
    table does not keep it.
    """
    old = {p: (parent, kind) for p, parent, kind, _ in places(agreed)}
    new = {p: kind for p, _, kind, _ in places(proposed)}
    gone = {p for p in old if p not in new or new[p] != old[p][1]}
    return [f"removed {p}" if p not in new else f"retyped {p}: {kind} -> {new[p]}"
            for p, (parent, kind) in old.items() if p in gone and parent not in gone]
