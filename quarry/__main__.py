"""Command line: one subcommand per step of the daily run.

    python -m quarry ingest  --payload P --landing L --source postings [--run-date D] [--prefix raw]
    python -m quarry build   --landing L/raw/postings --database dev_alex [--publish fct_postings]
    python -m quarry publish --table dev_alex.fct_postings_enriched --jdbc-url URL --target fct_postings
    python -m quarry label   --mart dev_alex.fct_postings --target dev_alex.fct_title_discipline
    python -m quarry ledger  --run-results target/run_results.json [--table ops.dbt_test_runs]
    python -m quarry stream  --landing L/raw/postings --table dev_alex.stg_postings_live --checkpoint C

Each runs on the active (or a new) Spark session; cluster settings come from
``spark-submit`` as usual.
"""

from __future__ import annotations

import argparse
import json
import logging
import sys

from pyspark.sql import SparkSession

from .session import configure
from .streaming.latest import COMPACT_EVERY

log = logging.getLogger("quarry")


def _spark() -> SparkSession:
    return configure(SparkSession.builder.appName("quarry").getOrCreate())


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quarry")
    sub = parser.add_subparsers(dest="cmd", required=True)

    p = sub.add_parser("ingest", help="gate and land one day of payload files")
    p.add_argument("--payload", required=True)
    p.add_argument("--landing", required=True)
    p.add_argument("--source", default="source")
    p.add_argument("--run-date", default=None, help="YYYY-MM-DD, default UTC today")
    p.add_argument("--prefix", default="raw")

    p = sub.add_parser("build", help="build every model, run the checks, optionally publish")
    p.add_argument("--landing", required=True, help="folder holding the ingest_date= folders")
    p.add_argument("--database", required=True)
    p.add_argument("--publish", default=None, help="catalog table to swap the mart into")
    p.add_argument("--labels", default=None, help="table of batched labels to use")
    p.add_argument("--threads", type=int, default=2, help="models built concurrently")
    p.add_argument("--newest-by-day", action="store_true",
                   help="the later day folder wins over the later file (with --full on a change)")
    p.add_argument("--full", action="store_true", help="restage from every landed file")

    p = sub.add_parser("publish", help="publish a table to an RDBMS over JDBC")
    p.add_argument("--table", required=True)
    p.add_argument("--jdbc-url", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--schema", default=None)
    p.add_argument("--user", default=None)
    p.add_argument("--password", default=None)
    p.add_argument("--partitions", type=int, default=8, help="concurrent JDBC writers")

    p = sub.add_parser("label", help="label unseen titles in batches")
    p.add_argument("--mart", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--batch-size", type=int, default=200)
    p.add_argument("--per-day", type=int, default=None, help="labeller calls allowed per UTC day")
    p.add_argument("--per-minute", type=int, default=None, help="labeller calls allowed per minute")

    p = sub.add_parser("ledger", help="append a run-results document to the ledger table")
    p.add_argument("--run-results", required=True)
    p.add_argument("--table", default="ops.dbt_test_runs")

    p = sub.add_parser("stream", help="keep the newest version per key from the landing zone")
    p.add_argument("--landing", required=True)
    p.add_argument("--table", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--continuous", action="store_true", help="keep running (default: drain)")
    p.add_argument("--interval", default="1 minute", help="trigger interval when continuous")
    p.add_argument("--compact-every", type=int, default=COMPACT_EVERY,
                   help="stored additions after which the table is rewritten as one version")
    p.add_argument("--buckets", type=int, default=None,
                   help="posting_id buckets of the table (default: shuffle partitions)")
    p.add_argument("--withdraw", action="store_true",
                   help="follow replayed days: records their new files lack leave the table")
    p.add_argument("--newest-by-day", action="store_true",
                   help="the later day folder wins over the later file, as in build")

    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s %(message)s")
    spark = _spark()

    if args.cmd == "ingest":
        from .sinks.landing import ingest
        out = ingest(spark, args.payload, args.landing, args.source, args.run_date, args.prefix)
    elif args.cmd == "build":
        from .operators.quality import require_rows_passed, run_checks
        from .plans.postings import build
        from .plans.suite import checks
        from .sinks.releases import publish_group
        from .sources.landing import stray_files
        labels = spark.table(args.labels) if args.labels else None
        b = build(spark, args.landing, args.database, labels=labels, threads=args.threads,
                  full=args.full, newest_by_day=args.newest_by_day)
        for path in stray_files(spark, args.landing).toLocalIterator():
            log.warning("outside every ingest_date folder, not read: %s", path["path"])
        report = run_checks(checks(b))
        rows = report.collect()  # one small row per check
        for r in rows:
            log.info("%-60s %-5s %d", r["check_name"], r["status"], r["failures"])
        require_rows_passed(rows)
        out = {"checks": len(rows)}
        if args.publish:
            out["published"] = publish_group(
                spark, args.publish, {args.publish: f"{args.database}.fct_postings_enriched"},
                source=args.database)[args.publish]
    elif args.cmd == "publish":
        from .sinks.publish import publish_jdbc
        from .sources.tables import read_nonempty
        df = read_nonempty(spark, args.table)
        out = {"published": publish_jdbc(spark, df, args.jdbc_url, args.target, args.schema,
                                         source=args.table, user=args.user,
                                         password=args.password, num_partitions=args.partitions)}
    elif args.cmd == "label":
        from .plans.title_labels import Quota, label_titles
        out = {"labelled": label_titles(spark, spark.table(args.mart), args.target,
                                        batch_size=args.batch_size,
                                        quota=Quota(args.per_day, args.per_minute))}
    elif args.cmd == "ledger":
        from .sinks.materialize import append_ledger
        from .sources.run_results import read_run_results
        out = {"appended": append_ledger(spark, read_run_results(spark, args.run_results),
                                         args.table)}
    else:
        from .streaming.latest import start
        q = start(spark, args.landing, args.table, args.checkpoint,
                  available_now=not args.continuous, buckets=args.buckets,
                  compact_every=args.compact_every, interval=args.interval,
                  newest_by_day=args.newest_by_day, withdraw=args.withdraw)
        q.awaitTermination()
        out = {"stream": "stopped"}
    print(json.dumps(out))
    return 0


if __name__ == "__main__":
    sys.exit(main())
