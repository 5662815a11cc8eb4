"""Publishing what a build has stored, several marts as one release.

A build leaves each mart as a stored version behind a view. Publishing re-points the
published views at those very versions: no row is written, so there is nothing to count
again, and what readers get is what the checks have seen.

* Everything that can be refused is refused before the first view moves: an empty mart,
  a broken contract, a mart that is no stored version.
* A view moves in one statement. Should one fail in between, the views already moved go
  back to where the last release had them, so a group is published whole or not at all.
* Every release is noted in ``{group}__releases``: per published view the version, the
  query over it, its row count and comment. ``rollback`` returns to the release before.
* A version that a current or the previous release names is pinned: builds keep it, and
  drop it once no release does.

A published view stands on a build's version; a relation published by copy
(``publish_table``) goes on working and is replaced in place.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.contract import breaking_changes
from ..operators.quality import require_rows
from .materialize import current_version, ensure_table, pin, pins, point_view
from .publish import ContractBroken, provenance

RELEASE_DDL = ("release bigint, published string, version string, body string, rows bigint, "
               "comment string")


class NotStored(ValueError):
    """The relation to publish is no view over a stored version."""


def releases(spark: SparkSession, group: str) -> DataFrame:
    """Every release of the group, one row per published view."""
    name = f"{group}__releases"
    ensure_table(spark, name, RELEASE_DDL)
    return spark.table(name)


def _last(spark: SparkSession, group: str, before: int | None = None) -> dict[str, dict]:
    """``{published: release row}`` of the last release, or of the last one below ``before``."""
    known = releases(spark, group)
    known = known if before is None else known.filter(F.col("release") < before)
    last = known.agg(F.max("release")).first()[0]
    if last is None:
        return {}
    return {r["published"]: r.asDict() for r in known.filter(F.col("release") == last).collect()}


def _planned(spark: SparkSession, published: str, mart: str, comment: str | None,
             check_contract: bool) -> dict:
    version = current_version(spark, mart)
    if version is None:
        raise NotStored(f"{mart} is no view over a stored version")
    frame = spark.table(mart)
    if check_contract and spark.catalog.tableExists(published):
        broken = breaking_changes(spark, spark.table(published).schema, frame.schema)
        if broken:
            raise ContractBroken(f"{published}: " + "; ".join(broken))
    rows = frame.agg(F.count(F.lit(1)).alias("n")).first()["n"]  # read off the files' footers
    require_rows(rows, mart)
    columns = ", ".join(f"`{c}`" for c in frame.columns)
    return {"published": published, "version": version, "rows": rows, "comment": comment,
            "body": f"SELECT {columns} FROM {version}"}


def _move(spark: SparkSession, row: dict) -> None:
    comment = row["comment"].replace("'", "''") if row["comment"] else None
    point_view(spark, row["published"], row["version"], comment, body=row["body"])


def _moved_together(spark: SparkSession, rows: list[dict], back: dict[str, dict]) -> None:
    done = []
    try:
        for row in rows:
            done.append(row["published"])
            _move(spark, row)
    except Exception:
        for published in done:
            if published in back:
                _move(spark, back[published])
            elif (current := current_version(spark, published)) and current in {r["version"] for r in rows}:
                spark.sql(f"DROP VIEW {published}")
        raise


def publish_group(spark: SparkSession, group: str, marts: Mapping[str, str],
                  source: str | None = None, now: dt.datetime | None = None,
                  check_contract: bool = True) -> dict[str, int]:
    """Publish ``{published: mart}`` as one release; return the rows per published view."""
    comment = provenance(source, now) if source else None
    plan = [_planned(spark, p, m, comment, check_contract) for p, m in marts.items()]
    last = _last(spark, group)
    release = 1 + max((r["release"] for r in last.values()), default=0)
    for row in plan:
        pin(spark, row["version"], row["published"])
    try:
        _moved_together(spark, plan, last)
    except Exception:
        for row in plan:
            if row["version"] not in {r["version"] for r in last.values()}:
                pin(spark, row["version"], row["published"], held=False)
        raise
    _note(spark, group, release, plan)
    _release_pins(spark, group, plan, last)
    return {r["published"]: r["rows"] for r in plan}


def _note(spark: SparkSession, group: str, release: int, rows: list[dict]) -> None:
    releases(spark, group)
    fields = [f.split()[0] for f in RELEASE_DDL.split(", ")]
    noted = [tuple(release if c == "release" else r[c] for c in fields) for r in rows]
    (spark.createDataFrame(noted, RELEASE_DDL).coalesce(1).write.mode("append").format("parquet")
     .saveAsTable(f"{group}__releases"))


def _release_pins(spark: SparkSession, group: str, *held: list[dict] | dict[str, dict]) -> None:
    """Strike out the pins of all versions that neither of the ``held`` releases names."""
    keep = {(r["version"], r["published"]) for rows in held
            for r in (rows.values() if isinstance(rows, dict) else rows)}
    for r in releases(spark, group).select("version", "published").distinct().collect():
        if tuple(r) not in keep and spark.catalog.tableExists(r["version"]) and (
                r["published"] in pins(spark, r["version"])):
            pin(spark, r["version"], r["published"], held=False)


def rollback(spark: SparkSession, group: str) -> int:
    """Return every view of the group to the release before the last; return its number.

    It is noted as a release of its own, so the next rollback returns from it.
    """
    last = _last(spark, group)
    if not last:
        raise ValueError(f"{group} has no release")
    number = max(r["release"] for r in last.values())
    before = _last(spark, group, number)
    if not before:
        raise ValueError(f"{group} has no release before {number}")
    _moved_together(spark, list(before.values()), last)
    _note(spark, group, number + 1, list(before.values()))
    _release_pins(spark, group, before, last)
    return max(r["release"] for r in before.values())
