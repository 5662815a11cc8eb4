"""Column idioms of the native operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, computed once per row.

    The value becomes a lambda variable, so no optimiser rule can copy its
    expression to each place (or each array element) that uses it.
    """
    return F.transform(F.array(value), body).getItem(0)


def whole_text(name: str) -> Column:
    """The text column, NULL as empty."""
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def word_array(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` in order."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def indices(n: Column) -> Column:
    """``[0 .. n-1]``, empty for ``n <= 0``."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(
        F.array().cast("array<int>"))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fixed_table(values: list[float]) -> Column:
    """A model's table as a foldable ``array<double>``; values are rounded to six decimals.

    Its size is a parameter of the model, never of the data.
    """
    return F.split(F.lit(",".join(repr(round(v, 6)) for v in values)), ",").cast("array<double>")
