"""Joins (J1-J5).

Broadcast policy: a side is broadcast only after its measured row count and
size have been checked against bounds (``bounded_broadcast``). Beyond the
bounds the plain join is kept and AQE decides at runtime from measured shuffle
sizes (it still turns a small side into a broadcast, and splits skewed
partitions of the other side for inner, left-outer and left-anti joins).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from .aggregates import key_counts

# A lookup side is broadcast only if it has at most this many rows and its
# rows measure at most this many bytes (the adaptive broadcast threshold).
DEFAULT_BROADCAST_ROWS = 1_000_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = 8  # one slot of Spark's row format per field


def _row_bytes(df: DataFrame) -> Column:
    """Approximate in-memory size of a row: a slot per field plus variable data."""
    parts = [F.lit(_FIXED_WIDTH)]
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + _FIXED_WIDTH)
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + _FIXED_WIDTH)
        else:
            parts.append(F.lit(_FIXED_WIDTH))
    total = parts[0]
    for part in parts[1:]:
        total = total + part
    return total.cast("bigint")


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` if ``df`` holds at most ``max_rows`` rows of at most
    ``max_bytes`` bytes in total, else ``df`` unchanged.

    The size is measured, not estimated: one aggregate pass over ``df`` with a
    partial (count, bytes) per task, so only one small row per task moves and
    no task gathers rows. (A ``limit(n).count()`` would instead funnel up to
    ``n`` rows from every task through a single-partition exchange when the
    side turns out to be large.)
    """
    if max_rows <= 0 or max_bytes <= 0:
        return df
    stats = side_size(df).first()
    return F.broadcast(df) if stats["rows"] <= max_rows and stats["bytes"] <= max_bytes else df


def side_size(df: DataFrame) -> DataFrame:
    """One row ``(rows, bytes)``: the measured size of ``df`` (partial per task)."""
    return df.agg(F.count(F.lit(1)).alias("rows"),
                  F.coalesce(F.sum(_row_bytes(df)), F.lit(0)).alias("bytes"))


def attach_counts(left: DataFrame, counts: DataFrame, key: str, count_col: str) -> DataFrame:
    """``left join counts using (key)`` with ``coalesce(count, 0)`` (J1 + P6)."""
    joined = left.join(counts, on=key, how="left")
    return joined.withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)).cast("bigint"))


def lookup(df: DataFrame, mapping: DataFrame, key: str, value_col: str, default,
           max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
           max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Left join a key -> value mapping and default the misses.

    A NULL key never matches, so it gets ``default`` as well. ``mapping`` must
    hold one row per key (else rows multiply, as in SQL).
    """
    side = bounded_broadcast(mapping.select(key, value_col), max_broadcast_rows,
                             max_broadcast_bytes)
    joined = df.join(side, on=key, how="left")
    return joined.withColumn(value_col, F.coalesce(F.col(value_col), F.lit(default)))


def unseen_keys(candidates: DataFrame, key: str, seen: DataFrame | None) -> DataFrame:
    """Distinct truthy keys of ``candidates`` not present in ``seen``.

    Truthy: not NULL and not the empty string.
    """
    keys = (candidates.select(key)
            .filter(F.col(key).isNotNull() & (F.col(key) != F.lit("")))
            .distinct())
    if seen is None:
        return keys
    return keys.join(seen.select(key), on=key, how="left_anti")


def orphans(child: DataFrame, key: str, parent: DataFrame, parent_key: str | None = None,
            out_col: str = "rows_found") -> DataFrame:
    """Non-NULL child keys absent from ``parent`` with their row counts.

    Both sides are reduced to per-key counts (``key_counts``) with a map-side
    partial aggregate before the anti join (whose exchange they share), so a
    hot key crosses the shuffle once per map task, not once per row. A report
    that aggregates the same key elsewhere (unique, the reverse relationship)
    reuses that scan and shuffle instead of repeating them.
    """
    parent_key = parent_key or key
    child_keys = key_counts(child, key, out_col).alias("__child")
    parent_keys = key_counts(parent, parent_key, "__rows").alias("__parent")
    # Every key of key_counts has at least one row, so `__rows > 0` removes no
    # parent key; referencing the count keeps it in the parent's aggregate
    # (otherwise pruned to a distinct), which keeps that side the very subplan
    # a unique or reverse check computes, so their exchange is reused.
    matches = ((F.col(f"__child.`{key}`") == F.col(f"__parent.`{parent_key}`"))
               & (F.col("__parent.__rows") > 0))
    return child_keys.join(parent_keys, matches, "left_anti")
