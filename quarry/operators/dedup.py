"""Latest version per key (W1) and earliest row per composite key.

W1 is a ``row_number() = 1`` window. Spark plans it with a *partial*
``WindowGroupLimit`` before the exchange, so each map task forwards at most one
row per key: a key that holds a third of all rows costs one row per map task
in the shuffle, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def latest_per_key(df: DataFrame, keys, order_by: Sequence[Column]) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order_by``.

    ``order_by`` must end in a column that makes the order total (e.g. a row
    hash), or ties are broken arbitrarily. NULL keys form one group, as in SQL
    ``PARTITION BY``.
    """
    window = Window.partitionBy(*_cols(keys)).orderBy(*order_by)
    rn = "__rn"
    return df.withColumn(rn, F.row_number().over(window)).filter(F.col(rn) == 1).drop(rn)


def earliest_per_group(df: DataFrame, keys, order_col: str) -> DataFrame:
    """One row per ``keys`` keeping the smallest ``order_col``, NULL first.

    When the frame holds only the keys and ``order_col`` this is exactly
    ``row_number() over (partition by keys order by order_col) = 1``, and it is
    planned as a hash aggregate with map-side partial ``min``.
    """
    keys = _cols(keys)
    extra = [c for c in df.columns if c not in keys and c != order_col]
    if extra:
        return latest_per_key(df, keys, [F.col(order_col).asc_nulls_first()])
    least = F.when(F.count(order_col) == F.count(F.lit(1)), F.min(order_col))
    return df.groupBy(*keys).agg(least.alias(order_col)).select(*df.columns)
