"""The command line runs ingest -> build (checks) -> publish on the active session."""

import json
import os

import pytest

from quarry.__main__ import main
from quarry.operators.quality import ChecksFailed

from .conftest import GOOD


def _payload(root, name, records):
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w") as fh:
        json.dump(records, fh)


def _last_json(capsys):
    return json.loads(capsys.readouterr().out.strip().splitlines()[-1])


def test_ingest_then_build_and_publish(spark, tmpdir_path, capsys):
    landing = os.path.join(tmpdir_path, "landing")
    clean = os.path.join(tmpdir_path, "clean")
    _payload(clean, "p.json", {"data": [GOOD, dict(GOOD, slug="x2", title="DevOps Engineer")]})
    assert main(["ingest", "--payload", clean, "--landing", landing, "--source", "postings",
                 "--run-date", "2026-08-12"]) == 0
    assert _last_json(capsys) == {"landed": 2, "accepted": 2, "rejected": 0}
    spark.sql("DROP TABLE IF EXISTS cli_pub")
    assert main(["build", "--landing", os.path.join(landing, "raw", "postings"),
                 "--database", "cli_db", "--publish", "cli_pub"]) == 0
    assert _last_json(capsys) == {"checks": 32, "published": 2}
    assert {r["discipline"] for r in spark.table("cli_pub").collect()} == {"data", "devops"}


def test_landed_reject_fails_the_build_and_nothing_is_published(spark, tmpdir_path, capsys):
    """A rejected record is still landed (the gate does not filter); staging reads
    it back with NULL fields, the not_null checks fail and publishing is refused."""
    landing = os.path.join(tmpdir_path, "landing")
    dirty = os.path.join(tmpdir_path, "dirty")
    _payload(dirty, "p.json", [GOOD, "junk"])
    assert main(["ingest", "--payload", dirty, "--landing", landing, "--source", "postings",
                 "--run-date", "2026-08-13"]) == 0
    assert _last_json(capsys) == {"landed": 2, "accepted": 1, "rejected": 1}
    spark.sql("DROP TABLE IF EXISTS cli_pub2")
    with pytest.raises(ChecksFailed, match="not_null_stg_postings_posting_id"):
        main(["build", "--landing", os.path.join(landing, "raw", "postings"),
              "--database", "cli_db2", "--publish", "cli_pub2"])
    assert not spark.catalog.tableExists("cli_pub2")
