"""Inputs on which operators once gave wrong results or lost data."""

import pytest
from pyspark.sql import functions as F

from quarry.operators.aggregates import reconcile_counts
from quarry.operators.dedup import earliest_per_group
from quarry.operators.fanout import explode_terms
from quarry.operators.quality import ChecksFailed, require_passed
from quarry.operators.validate import gate
from quarry.sinks.materialize import append_unseen, point_view, versions, write_version
from quarry.sinks.publish import publish_table
from quarry.sources.landing import unwrap


def _drop(spark, *names):
    for n in names:
        if spark.catalog.tableExists(n):
            kind = "VIEW" if spark.catalog.getTable(n).tableType == "VIEW" else "TABLE"
            spark.sql(f"DROP {kind} {n}")


def test_neighbours_named_like_versions_survive_publishing(spark):
    alike = ["pub__vendors", "pub__volume", "pub__v20240101000000_0123abcd"]
    _drop(spark, "pub", *alike)
    for n in alike:
        spark.range(3).write.saveAsTable(n)
    for i in range(4):
        assert publish_table(spark, spark.range(i + 1), "pub") == i + 1
    assert [spark.table(n).count() for n in alike] == [3, 3, 3]
    assert spark.table("pub").count() == 4 and len(versions(spark, "pub")) == 2
    stored = versions(spark, "pub")
    _drop(spark, "pub", *alike, *stored)


def test_a_failing_view_leaves_the_old_table(spark):
    _drop(spark, "plain_t")
    spark.range(5).write.saveAsTable("plain_t")
    with pytest.raises(Exception):
        point_view(spark, "plain_t", "no_such_version__v20240101000000_00000000")
    assert spark.table("plain_t").count() == 5
    version, _ = write_version(spark.range(2), "plain_t")
    point_view(spark, "plain_t", version)
    assert spark.table("plain_t").count() == 2
    _drop(spark, "plain_t", version)


def test_increment_keeps_the_key_unique(spark):
    _drop(spark, "keyed_t")
    rows = spark.createDataFrame([("a", 1), ("a", 2), (None, 3), (None, 4)], "k string, n int")
    assert append_unseen(spark, rows, "keyed_t", "k") == 2
    assert append_unseen(spark, rows, "keyed_t", "k") == 0
    assert append_unseen(spark, rows.filter("false"), "keyed_t", "k") == 0
    _drop(spark, "keyed_t")


def test_null_order_comes_first(spark):
    df = spark.createDataFrame([(1, 5), (1, None), (2, 7), (2, 6)], "k int, at int")
    want = {1: None, 2: 6}
    assert dict(map(tuple, earliest_per_group(df, "k", "at").collect())) == want
    wide = earliest_per_group(df.withColumn("x", F.lit(0)), "k", "at").select("k", "at")
    assert dict(map(tuple, wide.collect())) == want


def test_missing_report_is_a_difference(spark):
    df = spark.createDataFrame([("a", 2), ("a", 2), ("b", None), ("c", 5)], "k string, n int")
    assert {r["k"] for r in reconcile_counts(df, "k", "n").collect()} == {"b", "c"}


def test_separator_is_plain_text(spark):
    df = spark.createDataFrame([(1, "red|Blue|"), (2, "a.b")], "k int, t string")
    assert {r["term"] for r in explode_terms(df, "k", "t", sep="|").collect()} == {
        "red", "blue", "a.b"}


def test_every_failing_check_is_named(spark):
    report = spark.range(150).select(F.format_string("c%03d", "id").alias("check_name"),
                                     F.lit("fail").alias("status"))
    with pytest.raises(ChecksFailed, match="c149"):
        require_passed(report)


RECORD = '{"slug":"s","title":"t","company_name":"c","created_at":%s}'
# Instants with the verdict of a lax date-time field.
INSTANTS = {
    '"2024-01-01T99:99:00"': False, '"2024-01-01T25:00"': False, '"2024-01-01T10:00+99:00"': False,
    '"2024-01-01T10:60"': False, '"2024-01-01T10:00:61"': False, "1e300": False,
    '"99999999999999999999999999"': False, '"2024-01-01_10:00"': True, '"2024-01-01T10:00:00,5"': True,
    '"2024-01-01T23:59:59.123456Z"': True, '"2024-01-01 00:00+05:30"': True, '"1700000000"': True,
    "1700000000.5": True, "1700000000000.5": True, '"2024-02-30"': False, "-1e11": True,
}


def test_instants_of_the_gate(spark):
    lines = [RECORD % v for v in INSTANTS]
    rows = gate(spark.createDataFrame(list(enumerate(lines)), "i int, raw string")).orderBy("i").collect()
    assert dict(zip(INSTANTS, (r["accepted"] for r in rows))) == INSTANTS


def test_text_after_a_value_is_not_json(spark):
    good = RECORD % 1700000000
    lines = [good, good + " trailing", good + good, good + "\n"]
    rows = gate(spark.createDataFrame(list(enumerate(lines)), "i int, raw string")).orderBy("i").collect()
    assert [r["accepted"] for r in rows] == [True, False, False, True]
    ok = spark.createDataFrame([('[{"a":1}] ',)], "value string")
    assert unwrap(ok).count() == 1
    with pytest.raises(Exception, match="neither a list"):
        unwrap(spark.createDataFrame([('[{"a":1}] junk',)], "value string")).collect()
