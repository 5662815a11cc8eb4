"""Payload unwrap (S1), landing layout and day replacement (K1-K3), gate-then-land (V4, V5)."""

import json
import os

import pytest

from quarry.sinks.landing import day_path, ingest, land_raw, source_root
from quarry.sources.landing import read_landing, stray_files, unwrap_payloads

from .conftest import GOOD


def _payload(dirpath, name, obj):
    os.makedirs(dirpath, exist_ok=True)
    with open(os.path.join(dirpath, name), "w") as fh:
        fh.write(obj if isinstance(obj, str) else json.dumps(obj))


def test_day_path_layout():
    assert day_path("postings", "2026-08-12") == "raw/postings/ingest_date=2026-08-12"
    assert day_path("postings", "2026-08-12", prefix="alex") == "alex/postings/ingest_date=2026-08-12"
    assert day_path("postings").startswith("raw/postings/ingest_date=")


def test_unwrap_list_and_envelope(spark, tmpdir_path):
    _payload(tmpdir_path, "a.json", [GOOD, "not-a-dict", 42, None])
    _payload(tmpdir_path, "b.json", {"data": [{"z": 1, "a": None}], "meta": 1})
    rows = unwrap_payloads(spark, tmpdir_path).orderBy("source_file", "position").collect()
    raws = [r["raw"] for r in rows]
    assert json.loads(raws[0]) == GOOD
    assert raws[1:4] == ['"not-a-dict"', "42", "null"]
    assert raws[4] == '{"z":1,"a":null}'  # key order and nulls kept


def test_unwrap_rejects_non_list(spark, tmpdir_path):
    _payload(tmpdir_path, "c.json", {"data": {"not": "a list"}})
    with pytest.raises(Exception, match="neither a list nor an object"):
        unwrap_payloads(spark, tmpdir_path).collect()


def test_land_replaces_only_that_day(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    mk = lambda vals: spark.createDataFrame([(v,) for v in vals], "raw string")
    assert land_raw(mk(['{"slug":"a"}', '{"slug":"b"}']), root, "postings", "2026-08-12") == 2
    land_raw(mk(['{"slug":"c"}']), root, "postings", "2026-08-13")
    land_raw(mk(['{"slug":"d"}']), root, "postings", "2026-08-12")
    got = spark.read.text(source_root(root, "postings")).collect()
    assert sorted((r["value"], str(r["ingest_date"])) for r in got) == [
        ('{"slug":"c"}', "2026-08-13"), ('{"slug":"d"}', "2026-08-12")]


def test_empty_landing_refused(spark, tmpdir_path):
    empty = spark.createDataFrame([], "raw string")
    with pytest.raises(ValueError, match="no rows"):
        land_raw(empty, tmpdir_path, "postings", "2026-08-12")


def test_ingest_lands_rejects_too(spark, tmpdir_path):
    pay = os.path.join(tmpdir_path, "payload")
    _payload(pay, "p.json", {"data": [GOOD, {"slug": "missing-everything-else"}]})
    root = os.path.join(tmpdir_path, "landing")
    out = ingest(spark, pay, root, "postings", "2026-08-12")
    assert out == {"landed": 2, "accepted": 1, "rejected": 1}
    assert spark.read.text(source_root(root, "postings")).count() == 2


def test_all_rejected_batch_aborts_and_lands_nothing(spark, tmpdir_path):
    pay = os.path.join(tmpdir_path, "payload")
    _payload(pay, "p.json", ["x", 1])
    root = os.path.join(tmpdir_path, "landing")
    with pytest.raises(RuntimeError, match="nothing to land"):
        ingest(spark, pay, root, "postings", "2026-08-12")
    assert not os.path.exists(source_root(root, "postings"))


def test_read_landing_schema_partition_and_lineage(spark, tmpdir_path):
    from .conftest import write_day
    write_day(tmpdir_path, "2026-08-12", [GOOD])
    write_day(tmpdir_path, "2026-08-13", [dict(GOOD, slug="s2", salary=1)])
    with open(os.path.join(tmpdir_path, "old.json"), "w") as fh:
        fh.write(json.dumps(GOOD))
    df = read_landing(spark, tmpdir_path)
    types = dict(df.dtypes)
    assert types["ingest_date"] == "date" and types["created_at"] == "bigint"
    rows = df.orderBy("ingest_date").collect()
    assert len(rows) == 2  # the stray file beside the day folders is not read...
    assert rows[0]["source_file"].endswith("ingest_date=2026-08-12/data.json")
    assert rows[0]["ingested_at"] is not None
    stray = [r["path"] for r in stray_files(spark, tmpdir_path).collect()]
    assert len(stray) == 1 and stray[0].endswith("/old.json")  # ...but it is reported
