"""Data-quality checks that gate publishing.

A check is a query whose rows are failures. ``run_checks`` turns a list of
checks into one report frame ``(check_name, failures, status)``: each check
contributes a single aggregated row, so the report is small however large the
tables are, and nothing but that report is ever brought to the driver.

Row-level checks (not_null, accepted_values, not_in_future, not_empty) carry
a per-row failure predicate over their relation instead of a failing-rows
query; ``run_checks`` folds all row checks of the same relation into a single
aggregate pass. Only uniqueness, grain and referential checks need their own
(pre-aggregated) shuffles.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.time import is_in_future
from .aggregates import duplicate_groups, empty_check
from .joins import orphans


@dataclass(frozen=True, eq=False)
class Check:
    """Either ``failing`` (one row per failure; ``weight_col`` optionally says how
    many failures a row stands for) or ``source`` + ``predicate`` (a row of
    ``source`` fails when the predicate is true; ``empty=True`` instead fails
    once when ``source`` has no rows)."""

    name: str
    failing: DataFrame | None = None
    weight_col: str | None = None
    severity: str = "error"  # "warn" never blocks publishing
    source: DataFrame | None = None
    predicate: Column | None = None
    empty: bool = False

    def failing_rows(self) -> DataFrame:
        """The failing rows as a query (for inspection of any kind of check)."""
        if self.failing is not None:
            return self.failing
        if self.empty:
            return empty_check(self.source)
        return self.source.filter(self.predicate)


def not_null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, failures)`` for every column in one scan."""
    counts = df.agg(*[F.count(F.when(F.col(c).isNull(), 1)).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) as (column_name, failures)")


def not_null_checks(model: str, df: DataFrame, columns: Sequence[str]) -> list[Check]:
    """One ``not_null`` row check per column."""
    return [Check(f"not_null_{model}_{c}", source=df, predicate=F.col(f"`{c}`").isNull())
            for c in columns]


def unique_check(model: str, df: DataFrame, column: str) -> Check:
    """Non-NULL values seen more than once."""
    return Check(f"unique_{model}_{column}", duplicate_groups(df, [column]))


def grain_check(name: str, df: DataFrame, keys: Sequence[str]) -> Check:
    """Composite key groups with more than one row."""
    return Check(name, duplicate_groups(df, keys))


def relationships_check(model: str, child: DataFrame, key: str, parent: DataFrame,
                        parent_key: str | None = None) -> Check:
    """Child rows whose non-NULL key is missing from the parent (D3)."""
    return Check(f"relationships_{model}_{key}", orphans(child, key, parent, parent_key),
                 weight_col="rows_found")


def accepted_values_failures(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """``(value, n)`` for non-NULL values outside ``values``."""
    return (df.filter(F.col(column).isNotNull() & ~F.col(column).isin(list(values)))
            .groupBy(column).agg(F.count(F.lit(1)).alias("n")))


def accepted_values_check(model: str, df: DataFrame, column: str,
                          values: Sequence[str]) -> Check:
    """Rows whose non-NULL value is outside ``values``."""
    c = F.col(f"`{column}`")
    return Check(f"accepted_values_{model}_{column}", source=df,
                 predicate=c.isNotNull() & ~c.isin(list(values)))


def not_in_future_check(name: str, df: DataFrame, column: str,
                        now: dt.datetime | None = None, slack: str = "1 day") -> Check:
    """Rows dated later than ``now + slack``."""
    return Check(name, source=df, predicate=F.coalesce(is_in_future(column, now, slack),
                                                        F.lit(False)))


def not_empty_check(name: str, df: DataFrame) -> Check:
    """One failure when the relation is empty."""
    return Check(name, source=df, empty=True)


def _status(check: Check, failures: Column) -> Column:
    bad = "fail" if check.severity == "error" else "warn"
    return F.when(failures > 0, F.lit(bad)).otherwise(F.lit("pass"))


def _row_check_group(checks: list[Check]) -> DataFrame:
    """All row checks of one relation in one aggregate pass, unpivoted to report rows."""
    source = checks[0].source
    aggs = []
    for i, check in enumerate(checks):
        if check.empty:
            n = F.count(F.lit(1))
            aggs.append(F.when(n == 0, F.lit(1)).otherwise(F.lit(0)).cast("bigint").alias(f"c{i}"))
        else:
            aggs.append(F.count(F.when(check.predicate, 1)).cast("bigint").alias(f"c{i}"))
    counts = source.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"c{i}").alias("failures"),
                              F.lit("fail" if c.severity == "error" else "warn").alias("bad"))
                     for i, c in enumerate(checks)])
    out = counts.select(F.inline(rows))
    return out.select("check_name", "failures",
                      F.when(F.col("failures") > 0, F.col("bad")).otherwise(F.lit("pass"))
                      .alias("status"))


def run_checks(checks: Sequence[Check]) -> DataFrame:
    """``(check_name, failures, status)``, one row per check.

    ``status`` is ``pass``, ``fail`` (error severity) or ``warn``.
    """
    if not checks:
        raise ValueError("no checks to run")
    groups: dict[int, list[Check]] = {}
    parts = []
    for check in checks:
        if check.failing is None:
            groups.setdefault(id(check.source), []).append(check)
            continue
        weight = F.col(check.weight_col) if check.weight_col else F.lit(1)
        failures = F.coalesce(F.sum(weight.cast("bigint")), F.lit(0)).cast("bigint")
        parts.append(check.failing.agg(failures.alias("failures")).select(
            F.lit(check.name).alias("check_name"), "failures",
            _status(check, F.col("failures")).alias("status")))
    parts += [_row_check_group(group) for group in groups.values()]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report


class ChecksFailed(RuntimeError):
    """At least one error-severity check failed; nothing was published."""


def require_passed(report: DataFrame) -> None:
    """Raise unless no check has status ``fail`` (G4); names every failing check."""
    require_rows_passed(report.filter(F.col("status") == "fail").collect())


def require_rows_passed(rows) -> None:
    """``require_passed`` over the report's rows (one per check), already collected."""
    failed = [r["check_name"] for r in rows if r["status"] == "fail"]
    if failed:
        raise ChecksFailed("checks failed, refusing to publish: " + ", ".join(sorted(failed)))


def require_rows(n_rows: int, what: str) -> None:
    """Refuse to land, read or publish nothing (G1)."""
    if n_rows == 0:
        raise ValueError(f"{what} has no rows: refusing to continue with nothing")


def require_complete(expected: int, actual: int, what: str) -> None:
    """Rows read must equal the producer's count."""
    if expected != actual:
        raise RuntimeError(f"{what}: expected {expected} rows, got {actual}; refusing")
