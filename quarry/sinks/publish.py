"""Publishing a finished table.

Catalog target: the frame is written once, distributed, to a new uniquely
named version table (the write is observed, so the row count comes from the
same job); only if that count is non-zero and matches what the caller expects
is the published name re-pointed at it - by default a view replaced in one
metadata operation, carrying the provenance comment. The old version is never
touched before the new one is complete.

JDBC target: the staging table is loaded by the executors with
``DataFrame.write.jdbc``; the swap (drop old, rename staging, comment) runs in
one database transaction on the driver, so readers see the old or the new
table, never a half-written one.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType

from ..operators.contract import breaking_changes
from ..operators.quality import require_complete, require_rows
from .materialize import point_view, swap_in, write_version

# Target column type for each source type name; others -> text.
TYPE_MAP: dict[str, str] = {
    "BIGINT": "bigint",
    "INT": "integer",
    "SMALLINT": "smallint",
    "DOUBLE": "double precision",
    "FLOAT": "double precision",
    "DECIMAL": "numeric",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamptz",
    "TIMESTAMP_NTZ": "timestamp",
}


def target_type(type_text: str) -> str:
    """Upper-case, drop ``(p,s)``, look up; unknown types become ``text`` (K8)."""
    return TYPE_MAP.get(type_text.upper().split("(")[0], "text")


def publish_projection(df: DataFrame) -> DataFrame:
    """Make every column storable in a plain RDBMS column (K8).

    Arrays, maps and structs become their JSON text; other types without a
    mapping are cast to string; mapped types pass through.
    """
    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(c).alias(field.name))
        elif target_type(field.dataType.simpleString()) == "text":
            cols.append(c.cast("string").alias(field.name))
        else:
            cols.append(c)
    return df.select(*cols)


# Where a database lacks a type name the map uses (embedded Derby in tests).
DERBY_TYPES = {"timestamptz": "timestamp", "text": "varchar(32672)",
               "numeric": "decimal(31,10)"}


def column_ddl(df: DataFrame, dialect: dict[str, str] | None = None) -> str:
    """Column definitions of the target table, derived from the frame's schema (K8).

    A new column in the mart needs no change here.
    """
    dialect = dialect or {}
    out = []
    for field in df.schema.fields:
        t = target_type(field.dataType.simpleString())
        out.append(f"{field.name} {dialect.get(t, t)}")
    return ", ".join(out)


def provenance(source: str, now: dt.datetime | None = None) -> str:
    """``from <source> at <UTC minute>`` (K9)."""
    now = now or dt.datetime.now(tz=dt.UTC)
    return f"from {source} at {now.strftime('%Y-%m-%dT%H:%MZ')}"


def _write_observed(df: DataFrame, writer) -> int:
    obs = Observation(f"publish_{uuid.uuid4().hex[:8]}")
    writer(df.observe(obs, F.count(F.lit(1)).alias("rows")))
    return int(obs.get["rows"])


class ContractBroken(RuntimeError):
    """The new rows would remove or retype a column of the published relation."""


def publish_table(spark: SparkSession, df: DataFrame, table: str, source: str | None = None,
                  expected_rows: int | None = None, now: dt.datetime | None = None,
                  swap: str = "view", keep_previous: int = 1,
                  check_contract: bool = False) -> int:
    """Replace catalog relation ``table`` with ``df`` (K7, K9).

    The rows are written once, distributed, to a new uniquely named table;
    its observed row count must be non-zero (G1) and equal ``expected_rows``
    when given (G2), else it is dropped and the published relation is left
    as it was.

    ``swap="view"`` (default): ``table`` is a view re-pointed at the new
    version with ``CREATE OR REPLACE VIEW .. COMMENT '<provenance>'`` - one
    metadata operation, no data moved, no moment without a table; the
    ``keep_previous`` most recent older versions are kept for rollback and the
    rest dropped. ``swap="rename"``: drop the old table and rename the new one
    into its place (two catalog operations; a rename of a managed table moves
    its directory, which on an object store is a copy).

    ``check_contract=True`` refuses, before writing anything, a frame that
    removes or retypes a column of the currently published relation (G3);
    added columns are allowed.
    """
    if check_contract and spark.catalog.tableExists(table):
        broken = breaking_changes(spark, spark.table(table).schema, df.schema)
        if broken:
            raise ContractBroken(f"{table}: " + "; ".join(broken))
    stamp = (now or dt.datetime.now(tz=dt.UTC)).strftime("%Y%m%d%H%M%S")
    version, rows = write_version(df, table, stamp=stamp)
    try:
        require_rows(rows, table)
        if expected_rows is not None:
            require_complete(expected_rows, rows, table)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    comment = provenance(source, now).replace("'", "''") if source else None
    if swap == "rename":
        swap_in(spark, table, lambda: spark.sql(f"ALTER TABLE {version} RENAME TO {table}"))
        if comment:
            spark.sql(f"COMMENT ON TABLE {table} IS '{comment}'")
        return rows
    point_view(spark, table, version, comment, keep_previous)
    return rows


def _jdbc_connection(spark: SparkSession, url: str, user: str | None, password: str | None):
    jvm = spark.sparkContext._jvm
    if user is None:
        return jvm.java.sql.DriverManager.getConnection(url)
    return jvm.java.sql.DriverManager.getConnection(url, user, password)


def _table_exists(conn, schema: str | None, table: str) -> bool:
    meta = conn.getMetaData()
    for name in {table, table.upper(), table.lower()}:
        for sch in ({schema, schema.upper(), schema.lower()} if schema else {None}):
            rs = meta.getTables(None, sch, name, None)
            try:
                if rs.next():
                    return True
            finally:
                rs.close()
    return False


def _count_rows(conn, table: str) -> int:
    stmt = conn.createStatement()
    try:
        rs = stmt.executeQuery(f"SELECT COUNT(*) FROM {table}")
        try:
            rs.next()
            return int(rs.getLong(1))
        finally:
            rs.close()
    finally:
        stmt.close()


def _execute(conn, statements) -> None:
    stmt = conn.createStatement()
    try:
        for sql in statements:
            stmt.executeUpdate(sql)
    finally:
        stmt.close()


JDBC_WRITERS = 8


def publish_jdbc(spark: SparkSession, df: DataFrame, url: str, table: str,
                 schema: str | None = None, source: str | None = None,
                 user: str | None = None, password: str | None = None,
                 expected_rows: int | None = None, num_partitions: int = JDBC_WRITERS,
                 now: dt.datetime | None = None) -> int:
    """Replace ``schema.table`` in an RDBMS with ``df`` (K7, K8, K9 over JDBC).

    1. drop a leftover staging table, create it from the mapped column types;
    2. executors append the rows over JDBC (observed row count, G1/G2 guards;
       the staged count in the database must equal it, which catches rows a
       re-run task inserted twice);
    3. one transaction drops the old table, renames staging, sets the comment.

    ``num_partitions`` bounds the connections that executors open at a time.

    ``jdbc:derby:`` gets its ``RENAME TABLE`` syntax and type names and no
    comment (Derby has none); other URLs get ``ALTER TABLE .. RENAME TO`` and
    ``COMMENT ON TABLE``.
    """
    derby = url.startswith("jdbc:derby:")
    projected = publish_projection(df)
    # Caps concurrent database connections. A repartition, not a coalesce:
    # coalesce would also shrink the upstream stage to that many tasks.
    projected = projected.repartition(num_partitions)
    qualified = f"{schema}.{table}" if schema else table
    staging_name = f"{table}__staging"
    staging = f"{schema}.{staging_name}" if schema else staging_name
    props = {} if user is None else {"user": user, "password": password or ""}

    conn = _jdbc_connection(spark, url, user, password)
    try:
        drop = [f"DROP TABLE {staging}"] if _table_exists(conn, schema, staging_name) else []
        ddl = column_ddl(projected, DERBY_TYPES if derby else None)
        _execute(conn, drop + [f"CREATE TABLE {staging} ({ddl})"])
    finally:
        conn.close()

    def drop_staging():
        c = _jdbc_connection(spark, url, user, password)
        try:
            _execute(c, [f"DROP TABLE {staging}"])
        finally:
            c.close()

    try:
        rows = _write_observed(projected, lambda d: d.write.jdbc(url, staging, mode="append",
                                                                 properties=props))
        require_rows(rows, qualified)
        if expected_rows is not None:
            require_complete(expected_rows, rows, qualified)
        # Each task commits its own rows. A task re-run after its commit (a
        # lost executor, speculation) inserts them twice, while the observed
        # count only sums successful attempts: compare with the database.
        conn = _jdbc_connection(spark, url, user, password)
        try:
            require_complete(rows, _count_rows(conn, staging), f"{qualified} (staged)")
        finally:
            conn.close()
    except Exception:
        drop_staging()
        raise

    conn = _jdbc_connection(spark, url, user, password)
    try:
        conn.setAutoCommit(False)
        swap = [f"DROP TABLE {qualified}"] if _table_exists(conn, schema, table) else []
        swap.append(f"RENAME TABLE {staging} TO {table}" if derby
                    else f"ALTER TABLE {staging} RENAME TO {table}")
        if source and not derby:
            comment = provenance(source, now).replace("'", "''")
            swap.append(f"COMMENT ON TABLE {qualified} IS '{comment}'")
        _execute(conn, swap)
        conn.commit()
    except Exception:
        conn.rollback()
        raise
    finally:
        conn.close()
    return rows
