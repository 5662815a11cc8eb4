"""Landing raw records by day (K1-K3, V4, V5, G1).

Layout: ``{root}/{prefix}/{source}/ingest_date=YYYY-MM-DD/part-*.txt``, one
record's JSON text per line. Landing a day replaces that day only (dynamic
partition overwrite); other days are untouched, so replaying a day is
"land it again with that run date". What is landed is what the source sent,
rejected records included: the gate decides whether the batch is landed at
all, never which records are.
"""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import require_rows
from ..operators.validate import gate, gate_counts, require_some_valid
from ..session import checkpoint_dir
from ..sources.landing import unwrap_payloads

log = logging.getLogger(__name__)

PRODUCTION_PREFIX = "raw"


def run_day(run_date: str | None = None) -> str:
    """The run date, UTC today by default (K2)."""
    return run_date or dt.datetime.now(tz=dt.UTC).date().isoformat()


def day_path(source_name: str, run_date: str | None = None,
             prefix: str = PRODUCTION_PREFIX) -> str:
    """Relative folder of one source's day: ``{prefix}/{source}/ingest_date={d}`` (K2)."""
    return f"{prefix}/{source_name}/ingest_date={run_day(run_date)}"


def source_root(root: str, source_name: str, prefix: str = PRODUCTION_PREFIX) -> str:
    """Folder holding every day of one source: what staging reads."""
    return f"{root.rstrip('/')}/{prefix}/{source_name}"


def land_raw(records: DataFrame, root: str, source_name: str, run_date: str | None = None,
             prefix: str = PRODUCTION_PREFIX, raw_col: str = "raw") -> int:
    """Write ``raw_col`` as NDJSON into that day's folder, replacing the day (K1, K3).

    Returns the number of lines landed; an empty frame lands nothing (the day
    keeps its previous content) and raises (G1).
    """
    obs = Observation("land")
    day = run_day(run_date)
    out = (records.select(F.col(raw_col).alias("value"))
           .withColumn("ingest_date", F.lit(day))
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("ingest_date").text(source_root(root, source_name, prefix)))
    landed = int(obs.get["rows"])
    require_rows(landed, f"landing {source_name} {day}")
    return landed


def ingest(spark: SparkSession, payload_path: str, root: str, source_name: str,
           run_date: str | None = None, prefix: str = PRODUCTION_PREFIX) -> dict:
    """Unwrap payloads, gate every record, land them all.

    Payloads are unwrapped and gated once, into the shared checkpoint folder; the
    counts and the landing write read that, also after a lost executor. The batch
    is landed only if at least one record is valid. Returns
    ``{"landed", "accepted", "rejected"}``.
    """
    checkpoint_dir(spark)
    records = (gate(unwrap_payloads(spark, payload_path)).select("raw", "accepted")
               .checkpoint(eager=True))
    counts = gate_counts(records).first()
    accepted, rejected = int(counts["accepted"]), int(counts["rejected"])
    require_some_valid(accepted, rejected)
    if rejected:
        log.warning("landing %d records, of which %d did not pass the gate",
                    accepted + rejected, rejected)
    landed = land_raw(records, root, source_name, run_date, prefix)
    return {"landed": landed, "accepted": accepted, "rejected": rejected}
