"""One day's run: ingest -> build -> checks -> publish, stopping at the first failure.

Publishing happens only when every error-severity check passed (G4): a mart
that failed its checks is worse than yesterday's mart, so the published table
is left untouched and the run raises. A mart that would remove or retype a
published column is refused as well (G3); adding a column is allowed.
"""

from __future__ import annotations

import datetime as dt
import logging
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..operators.quality import require_passed, run_checks
from ..sinks.landing import ingest, source_root
from ..sinks.releases import publish_group
from ..sources.landing import stray_files
from .postings import Build, build
from .suite import checks

log = logging.getLogger(__name__)


@dataclass
class RunResult:
    ingest: dict | None
    build: Build
    report: DataFrame
    published_rows: int | None


def run(spark: SparkSession, landing_root: str, source_name: str, database: str,
        publish_as: str | None = None, payload_path: str | None = None,
        run_date: str | None = None, now: dt.datetime | None = None,
        labels: DataFrame | None = None, newest_by_day: bool = False) -> RunResult:
    landed = None
    if payload_path is not None:
        landed = ingest(spark, payload_path, landing_root, source_name, run_date)
    b = build(spark, source_root(landing_root, source_name), database, now, labels,
              newest_by_day=newest_by_day)
    for path in stray_files(spark, source_root(landing_root, source_name)).toLocalIterator():
        log.warning("outside every ingest_date folder, not read: %s", path["path"])
    report = run_checks(checks(b, now)).cache()
    require_passed(report)
    published = None
    if publish_as is not None:
        # The build's own version, checked above: nothing is written or counted again.
        published = publish_group(spark, publish_as, {publish_as: f"{database}.fct_postings_enriched"},
                                  source=database, now=now)[publish_as]
    return RunResult(landed, b, report, published)
