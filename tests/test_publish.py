"""Publishing (K7-K9, G1, G2): catalog swap and JDBC swap on embedded Derby (FIXTURES F6)."""

import datetime as dt
import uuid
from decimal import Decimal

import pytest

from quarry.sinks import releases
from quarry.sinks.materialize import as_versioned
from quarry.sinks.publish import (ContractBroken, column_ddl, provenance, publish_jdbc, publish_projection,
                                  publish_table, target_type)
from quarry.sinks.releases import publish_group

NOW = dt.datetime(2026, 8, 13, 11, 2, 30, tzinfo=dt.UTC)
F6_DDL = ("posting_id string, jobs_posted bigint, remote_pct decimal(5,1), is_remote boolean, "
          "posted_at timestamp, tags array<string>")


def _f6(spark):
    return spark.createDataFrame(
        [("a1", 3, Decimal("66.7"), True, dt.datetime(2026, 8, 12), ["sql"])], F6_DDL)


def test_type_map():
    assert target_type("bigint") == "bigint"
    assert target_type("decimal(5,1)") == "numeric"
    assert target_type("timestamp") == "timestamptz"
    assert target_type("timestamp_ntz") == "timestamp"
    assert target_type("array<string>") == "text"
    assert target_type("string") == "text"


def test_projection_turns_nested_into_json(spark):
    row = publish_projection(_f6(spark)).first()
    assert row["tags"] == '["sql"]' and row["jobs_posted"] == 3
    assert "tags text" in column_ddl(publish_projection(_f6(spark)))
    assert "posted_at timestamptz" in column_ddl(_f6(spark))


def test_provenance_stamp():
    assert provenance("team_a.dev_alex", NOW) == "from team_a.dev_alex at 2026-08-13T11:02Z"


def _comment(spark, name):
    return [r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()
            if r["col_name"] == "Comment"]


def _versions(spark, prefix):
    return sorted(t.name for t in spark.catalog.listTables() if t.name.startswith(prefix))


def test_catalog_publish_swaps_and_stamps(spark):
    spark.sql("DROP TABLE IF EXISTS pub_cat")
    spark.createDataFrame([("old",)], "v string").write.saveAsTable("pub_cat")
    assert publish_table(spark, _f6(spark), "pub_cat", source="dev_alex", now=NOW) == 1
    t = spark.table("pub_cat")
    assert t.columns == ["posting_id", "jobs_posted", "remote_pct", "is_remote", "posted_at",
                         "tags"]
    assert _comment(spark, "pub_cat") == ["from dev_alex at 2026-08-13T11:02Z"]
    assert spark.catalog.getTable("pub_cat").tableType == "VIEW"
    # two more publishes: the current version plus one previous are kept
    later = dt.datetime(2026, 8, 14, 9, 0, tzinfo=dt.UTC)
    publish_table(spark, _f6(spark).union(_f6(spark)), "pub_cat", now=later)
    publish_table(spark, _f6(spark), "pub_cat", now=later + dt.timedelta(days=1))
    assert len(_versions(spark, "pub_cat__v")) == 2
    assert spark.table("pub_cat").count() == 1


def test_rename_swap_mode(spark):
    spark.sql("DROP TABLE IF EXISTS pub_ren")
    spark.createDataFrame([("old",)], "v string").write.saveAsTable("pub_ren")
    assert publish_table(spark, _f6(spark), "pub_ren", source="s", now=NOW, swap="rename") == 1
    assert spark.catalog.getTable("pub_ren").tableType == "MANAGED"
    assert _comment(spark, "pub_ren") == ["from s at 2026-08-13T11:02Z"]
    assert _versions(spark, "pub_ren__v") == []


def test_first_publish_without_old_table(spark):
    spark.sql("DROP TABLE IF EXISTS pub_first")
    assert publish_table(spark, _f6(spark), "pub_first") == 1


def test_empty_refused_old_table_kept(spark):
    spark.sql("DROP TABLE IF EXISTS pub_keep")
    spark.createDataFrame([("old",)], "v string").write.saveAsTable("pub_keep")
    with pytest.raises(ValueError, match="no rows"):
        publish_table(spark, spark.createDataFrame([], F6_DDL), "pub_keep")
    assert spark.table("pub_keep").first()["v"] == "old"


def test_incomplete_refused(spark):
    spark.sql("DROP TABLE IF EXISTS pub_short")
    with pytest.raises(RuntimeError, match="expected 9 rows, got 1"):
        publish_table(spark, _f6(spark), "pub_short", expected_rows=9)
    assert not spark.catalog.tableExists("pub_short")
    assert _versions(spark, "pub_short__v") == []


def test_jdbc_publish_on_embedded_derby(spark):
    url = f"jdbc:derby:memory:q{uuid.uuid4().hex[:8]};create=true"
    assert publish_jdbc(spark, _f6(spark), url, "fct_postings", schema="APP") == 1
    # publish again over the existing table: swap, not append
    assert publish_jdbc(spark, _f6(spark).union(_f6(spark)), url, "fct_postings",
                        schema="APP") == 2
    back = spark.read.jdbc(url, "APP.fct_postings").collect()
    assert len(back) == 2 and back[0]["TAGS"] == '["sql"]'


def test_jdbc_publish_refuses_rows_inserted_twice(spark, monkeypatch):
    """A task re-run after its commit inserts its rows again; the observed
    count does not see that, the staged count does: refuse, keep the old table."""
    from quarry.sinks import publish as pub
    url = f"jdbc:derby:memory:d{uuid.uuid4().hex[:8]};create=true"
    assert publish_jdbc(spark, _f6(spark), url, "fct_postings", schema="APP") == 1

    original = pub._write_observed

    def write_with_rerun(df, writer):
        writer(df)  # a first attempt committed, then its executor was lost
        return original(df, writer)

    monkeypatch.setattr(pub, "_write_observed", write_with_rerun)
    with pytest.raises(RuntimeError, match="staged"):
        publish_jdbc(spark, _f6(spark).union(_f6(spark)), url, "fct_postings", schema="APP")
    assert len(spark.read.jdbc(url, "APP.fct_postings").collect()) == 1


def test_jdbc_read_back_partitioned(spark):
    """A backend table read in parallel range queries."""
    from quarry.sources.tables import read_jdbc
    url = f"jdbc:derby:memory:r{uuid.uuid4().hex[:8]};create=true"
    rows = spark.range(0, 100).selectExpr("id AS user_id", "concat('u', id) AS email")
    publish_jdbc(spark, rows, url, "users", schema="APP")
    df = read_jdbc(spark, url, "users", schema="APP", partition_column="USER_ID",
                   lower_bound=0, upper_bound=100, num_partitions=4)
    assert df.rdd.getNumPartitions() == 4
    assert df.count() == 100


def test_contract_guard_refuses_breaking_change(spark):
    from quarry.sinks.publish import ContractBroken
    spark.sql("DROP VIEW IF EXISTS pub_contract")
    publish_table(spark, _f6(spark), "pub_contract", check_contract=True)
    wider = _f6(spark).selectExpr("*", "'x' AS salary_band")
    assert publish_table(spark, wider, "pub_contract", check_contract=True) == 1  # add: safe
    narrower = _f6(spark).drop("tags")
    with pytest.raises(ContractBroken, match="removed tags"):
        publish_table(spark, narrower, "pub_contract", check_contract=True)
    assert "salary_band" in spark.table("pub_contract").columns


def _released(spark, tmp, name, values):
    return as_versioned(spark.createDataFrame([(v,) for v in values], "v int"), name)


def test_a_group_is_released_whole_or_not_at_all(spark, monkeypatch):
    marts = {"rel_a_out": "rel_a", "rel_b_out": "rel_b"}
    read = lambda n: sorted(r["v"] for r in spark.table(n).collect())
    for k, name in enumerate(marts.values()):
        _released(spark, None, name, [k, 10 + k])
    assert publish_group(spark, "rel", marts, source="s", now=NOW) == {"rel_a_out": 2, "rel_b_out": 2}
    assert _comment(spark, "rel_a_out") == ["from s at 2026-08-13T11:02Z"]
    # published views stand on the mart's own files: nothing was written
    assert spark.table("rel_a_out").inputFiles() == spark.table("rel_a").inputFiles()
    _released(spark, None, "rel_a", [7])
    _released(spark, None, "rel_b", [])
    with pytest.raises(ValueError, match="no rows"):
        publish_group(spark, "rel", marts)
    assert read("rel_a_out") == [0, 10]
    # builds go on; what is published is kept until no release names it
    for v in (8, 9):
        for name in marts.values():
            _released(spark, None, name, [v])
    assert read("rel_a_out") == [0, 10]
    publish_group(spark, "rel", marts)
    assert read("rel_a_out") == read("rel_b_out") == [9]
    # a swap that fails in between takes back the one before it
    for name in marts.values():
        _released(spark, None, name, [11])
    real = releases._move

    def fails(session, row):
        if row["published"] == "rel_b_out" and "rel_b__v" in row["version"] and not failed:
            failed.append(1)
            raise RuntimeError("lost the catalog")
        real(session, row)

    failed = []
    monkeypatch.setattr(releases, "_move", fails)
    with pytest.raises(RuntimeError, match="lost the catalog"):
        publish_group(spark, "rel", marts)
    assert read("rel_a_out") == read("rel_b_out") == [9]
    monkeypatch.setattr(releases, "_move", real)
    assert releases.rollback(spark, "rel") == 1
    assert read("rel_a_out") == [0, 10] and read("rel_b_out") == [1, 11]
    assert releases.rollback(spark, "rel") == 2
    assert read("rel_a_out") == [9]


def test_a_group_refuses_broken_contracts_and_plain_tables(spark):
    _released(spark, None, "rel_c", [1])
    publish_group(spark, "relc", {"rel_c_out": "rel_c"})
    as_versioned(spark.createDataFrame([("x",)], "v string"), "rel_c")
    with pytest.raises(ContractBroken):
        publish_group(spark, "relc", {"rel_c_out": "rel_c"})
    spark.range(3).write.mode("overwrite").saveAsTable("rel_plain")
    with pytest.raises(releases.NotStored):
        publish_group(spark, "relp", {"rel_plain_out": "rel_plain"})
    with pytest.raises(ValueError, match="no release"):
        releases.rollback(spark, "relp")
