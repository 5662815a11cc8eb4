"""Fan-out of an array column into a key-and-item grain.

Semantics: explode, ``lower(trim(item))``, drop blank and NULL items, one row
per (key, item). Rows with a NULL or empty array vanish (the count mart puts
the zero back).

When the key is unique in the input (staging guarantees it for postings),
normalising and de-duplicating inside each row's array gives the same rows
with no shuffle at all; only when the key may repeat does the composite
de-duplication need a (partially pre-aggregated) hash aggregate.
"""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_array
from .dedup import earliest_per_group


def explode_clean(df: DataFrame, key: str, array_col: str, item_col: str = "tag",
                  carry: Sequence[str] = (), key_unique: bool = True,
                  order_col: str | None = None) -> DataFrame:
    """``(key, item, *carry)`` rows, one per distinct cleaned item of each key.

    ``order_col`` (one of ``carry``) decides which row survives when a key
    repeats and ``key_unique`` is False: the earliest wins.
    """
    carry = list(carry)
    out = df.select(key, F.explode(clean_array(array_col)).alias(item_col), *carry)
    if key_unique:
        return out
    if order_col is None:
        return out.dropDuplicates([key, item_col])
    return earliest_per_group(out, [key, item_col], order_col)


def explode_terms(df: DataFrame, key: str, text_col: str, item_col: str = "term",
                  sep: str = " ", carry: Sequence = (), key_unique: bool = True) -> DataFrame:
    """``explode_clean`` over ``split(text, sep)``, for whole texts.

    With a space separator no element holds a space, so per-element
    ``lower(trim(x))`` equals splitting the lower-cased text; the blank filter
    becomes ``array_remove(.., '')``. Everything stays in codegen'd built-ins
    (no per-element lambdas), which matters on long documents.
    """
    if sep != " ":
        tmp = df.select(key, F.split(text_col, re.escape(sep)).alias("__terms"), *carry)
        return explode_clean(tmp, key, "__terms", item_col, carry=[c for c in tmp.columns
                                                                  if c not in (key, "__terms")],
                             key_unique=key_unique)
    terms = F.array_distinct(F.array_remove(F.split(F.lower(F.col(text_col)), " "), ""))
    out = df.select(key, F.explode(terms).alias(item_col), *carry)
    return out if key_unique else out.dropDuplicates([key, item_col])


def item_count(array_col: str) -> F.Column:
    """Per-row count of distinct cleaned items, 0 for NULL/empty arrays (A1 + P6).

    Equal to ``count(*)`` of ``explode_clean`` per key, left-joined back and
    coalesced to 0, when the key is unique.
    """
    # size(NULL) is -1 or NULL depending on ANSI mode: a NULL array is replaced
    # by an empty one first, so the cleaning runs once per row, not twice.
    cleaned = F.coalesce(clean_array(array_col), F.array().cast("array<string>"))
    return F.size(cleaned).cast("bigint")
