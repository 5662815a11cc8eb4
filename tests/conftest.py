from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from quarry.session import EXECUTION_SETTINGS, RESULT_SETTINGS, checkpoint_dir  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="quarry-tests-")
    builder = (SparkSession.builder.master("local[4]").appName("quarry-tests")
               .config("spark.ui.enabled", "false")
               .config("spark.sql.shuffle.partitions", "4")
               .config("spark.sql.warehouse.dir", os.path.join(scratch, "warehouse"))
               .config("spark.driver.memory", "4g"))
    for k, v in {**RESULT_SETTINGS, **EXECUTION_SETTINGS}.items():
        builder = builder.config(k, v)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(session)
    yield session
    session.stop()


@pytest.fixture
def tmpdir_path():
    return tempfile.mkdtemp(prefix="quarry-t-")


# FIXTURES F1.
GOOD = {
    "slug": "data-engineer-acme",
    "title": "Data Engineer",
    "company_name": "Acme",
    "location": "Amsterdam",
    "remote": True,
    "tags": ["sql", "python"],
    "created_at": 1786481729,
}


def write_day(root: str, day: str, records, name: str = "data.json", mtime: float | None = None):
    """Write NDJSON lines (dicts are dumped, strings written as they are)."""
    folder = os.path.join(root, f"ingest_date={day}")
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as fh:
        fh.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    if mtime is not None:
        os.utime(path, (mtime, mtime))
    return path
