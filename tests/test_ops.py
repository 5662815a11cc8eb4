"""Run ledger (S8, P12, A9, K10), contract diff (G3), table guard."""

import json
import os

import pytest
from pyspark.sql.types import StructType

from quarry.operators.contract import (agreed_contract, breaking_changes, contract_changes,
                                       contract_diff, register_contract)
from quarry.sinks.materialize import append_ledger
from quarry.sources.run_results import read_run_results, summarise
from quarry.sources.tables import read_nonempty
from quarry.streaming.ledger import append_once, follow_runs

DOC = {
    "metadata": {"invocation_id": "abc", "generated_at": "2026-08-12T06:00:00.123456Z"},
    "results": [
        {"unique_id": "model.project.stg_postings", "status": "success",
         "execution_time": 1.5, "message": "OK"},
        {"unique_id": "test.project.not_null_title", "status": "fail", "execution_time": None,
         "message": "Got 1 result, configured to fail if != 0"},
        {"unique_id": "model.project.fct_postings", "status": "success",
         "execution_time": 2.0, "message": "it's done"},
    ],
}


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_run_results_rows(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "rr", "run_results.json")
    _write(p, json.dumps(DOC, indent=2))
    rows = read_run_results(spark, p).orderBy("node").collect()
    assert [r["resource_type"] for r in rows] == ["model", "model", "test"]
    assert rows[2]["execution_time"] == 0.0
    assert str(rows[0]["run_at"]) == "2026-08-12 06:00:00"
    assert rows[0]["message"] == "it's done"  # apostrophe survives
    counts = {r["status"]: r["n"] for r in summarise(read_run_results(spark, p)).collect()}
    assert counts == {"success": 2, "fail": 1}


def test_missing_or_broken_file_is_zero_rows(spark, tmpdir_path):
    assert read_run_results(spark, os.path.join(tmpdir_path, "nope.json")).count() == 0
    p = os.path.join(tmpdir_path, "bad", "run_results.json")
    _write(p, "{not json")
    assert read_run_results(spark, p).count() == 0


def test_ledger_append(spark, tmpdir_path):
    spark.sql("DROP TABLE IF EXISTS ops.dbt_test_runs")
    p = os.path.join(tmpdir_path, "rr2", "run_results.json")
    _write(p, json.dumps(DOC))
    rows = read_run_results(spark, p)
    assert append_ledger(spark, rows) == 3
    assert append_ledger(spark, rows) == 3
    assert spark.table("ops.dbt_test_runs").count() == 6
    assert append_ledger(spark, rows.limit(0), "ops.never_created") == 0
    assert not spark.catalog.tableExists("ops.never_created")


def test_contract_diff(spark):
    old = StructType.fromDDL("posting_id string, title string, tag_count bigint")
    new = StructType.fromDDL("posting_id string, tag_count int, salary double")
    rows = {r["column_name"]: (r["change"], r["breaking"])
            for r in contract_diff(spark, old, new).collect()}
    assert rows == {"title": ("removed", True), "tag_count": ("retyped", True),
                    "salary": ("added", False)}
    assert breaking_changes(spark, old, old) == []


def test_read_nonempty_guard(spark):
    spark.sql("DROP TABLE IF EXISTS empty_mart")
    spark.createDataFrame([], "a int").write.saveAsTable("empty_mart")
    with pytest.raises(ValueError, match="is empty"):
        read_nonempty(spark, "empty_mart")


def test_bucketed_write_leaves_one_file_per_bucket(spark):
    """Input spread over 8 tasks, each holding every bucket: the write still
    leaves one file per bucket, and the table reads back bucketed and whole."""
    from pyspark.sql import functions as F

    from quarry.sinks.materialize import as_table, write_version

    df = spark.range(0, 4000, numPartitions=8).select(
        F.concat(F.lit("k"), (F.col("id") % 500).cast("string")).alias("key"), "id")
    for name, table in (("ops_bucket_t", as_table(df, "ops_bucket_t", bucket_by="key", buckets=4)),
                        ("ops_bucket_v", spark.table(write_version(
                            df, "ops_bucket_v", bucket_by="key", buckets=4)[0]))):
        files = [f for f in table.inputFiles() if f.rsplit("/", 1)[-1].startswith("part-")]
        assert len(files) == 4, name
        assert table.count() == 4000
        assert table.groupBy("key").count().count() == 500


def _stored(spark, name):
    spark.catalog.refreshTable(name)
    return sorted((r["invocation_id"], r["node"], str(r["run_at"]), r["batch"]) for r in spark.table(name).collect())


def test_ledger_stream_holds_each_node_once(spark, tmpdir_path):
    """Documents landed twice, an epoch run again, a stream started anew: one row per node and run."""
    folder, name = os.path.join(tmpdir_path, "runs"), "ops.ledger_once"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    drain = lambda state, stream="runs": follow_runs(
        spark, folder, name, os.path.join(tmpdir_path, state), stream).awaitTermination()
    _write(os.path.join(folder, "one.json"), json.dumps(DOC, indent=2))
    _write(os.path.join(folder, "bad.json"), "{not json")
    drain("state")
    first = _stored(spark, name)
    assert [r[1] for r in first] == sorted(r["unique_id"] for r in DOC["results"])
    assert {r[3] for r in first} == {"runs-0"}
    _write(os.path.join(folder, "copy.json"), json.dumps(DOC))
    later = dict(DOC, metadata={"generated_at": "2026-08-13T06:00:00Z"})
    _write(os.path.join(folder, "two.json"), json.dumps(later))
    drain("state")
    both = _stored(spark, name)
    assert both[:3] == first and len(both) == 6 and {r[0] for r in both[3:]} == {"unknown"}
    drain("state-new", "again")
    assert _stored(spark, name) == both
    rows = spark.table(name).filter("batch = 'runs-1'").drop("batch").checkpoint(eager=True)
    append_once(rows.unionByName(rows), name, "runs-1")  # the epoch run again
    assert _stored(spark, name) == both
    append_once(rows.limit(0), name, "nothing")
    assert _stored(spark, name) == both


def test_nested_contract_changes(spark):
    old = StructType.fromDDL("a struct<b: int, c: array<struct<d: string, e: int>>>, m map<string, int>, "
                             "gone struct<x: int>, n int not null, same string")
    new = StructType.fromDDL("a struct<b: bigint, c: array<struct<d: string, f: int>>, g: int>, "
                             "m map<string, string>, n int, same string, fresh struct<y: int>")
    found = {r["column_name"]: (r["change"], r["breaking"]) for r in contract_diff(spark, old, new).collect()}
    assert found == {
        "a.b": ("retyped", True), "a.c[].e": ("removed", True), "a.c[].f": ("added", False),
        "a.g": ("added", False), "m{value}": ("retyped", True), "gone": ("removed", True),
        "n": ("may be null now", True), "fresh": ("added", False)}
    assert breaking_changes(spark, old, new) == [
        "retyped a.b: int -> bigint", "removed a.c[].e", "retyped m{value}: int -> string", "removed gone"]


def test_contract_versions_are_kept(spark):
    spark.sql("DROP TABLE IF EXISTS reg__contract")
    one, two = StructType.fromDDL("a int, b string"), StructType.fromDDL("a int, b string, c double")
    assert [register_contract(spark, "reg", s) for s in (one, one, two, two, one)] == [1, 1, 2, 2, 3]
    assert {r["path"] for r in agreed_contract(spark, "reg", 2).collect()} == {"a", "b", "c"}
    assert [tuple(r)[:2] for r in contract_changes(spark, "reg", two).collect()] == [("c", "added")]
