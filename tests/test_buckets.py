"""Copy-on-write staging (K4) and maintained marts (A1, A2) against builds from scratch."""

import datetime as dt
import os
import random
import shutil

import pytest
from pyspark.sql import functions as F

from quarry.plans.marts import (MAINTAINED, changed_rows, popularity_after, popularity_into,
                                postings_into, tag_deltas)
from quarry.plans.postings import (POPULARITY_COLUMNS, STAGING_COLUMNS, build, posting_tags,
                                   postings_mart, stage, tag_popularity_mart)
from quarry.plans import staging
from quarry.plans.staging import stage_into
from quarry.operators.aggregates import duplicate_groups
from quarry.operators.joins import orphans
from quarry.plans.summaries import (SKETCH_ERROR, distinct_estimates, summarised, summary_report,
                                    summary_verification)
from quarry.sinks import buckets
from quarry.sources.landing import read_landing

from .conftest import GOOD, write_day


def _rows(df, columns=None):
    columns = columns or df.columns
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)


def _files(spark, name):
    folder = buckets.table_folder(spark, name).removeprefix("file:")
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_one_key_rewrites_one_bucket(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    write_day(root, "2026-08-12", [dict(GOOD, slug=f"k{i}") for i in range(300)]
              + [dict(GOOD, slug=None)], mtime=1_786_500_000)
    stg, mode = stage_into(spark, root, "cow_stg", buckets=8)
    assert mode == "full" and stg.columns == STAGING_COLUMNS
    before, version = _files(spark, "cow_stg"), buckets.stored_in_buckets(spark, "cow_stg")
    write_day(root, "2026-08-13", [dict(GOOD, slug="k7", title="New")], mtime=1_786_600_000)
    stg, mode = stage_into(spark, root, "cow_stg", buckets=8)
    assert mode == "incremental"
    assert len(_files(spark, "cow_stg") - before) == 1 and before <= _files(spark, "cow_stg")
    assert _rows(stg) == _rows(stage(read_landing(spark, root)))
    after = buckets.stored_in_buckets(spark, "cow_stg")
    old, new = (buckets.manifest(spark, "cow_stg", v) for v in (version, after))
    assert sum(old[b] != new[b] for b in range(8)) == 1
    gone, come = changed_rows(spark, "cow_stg", version, after)
    assert [(r["posting_id"], r["title"]) for r in come.collect()] == [("k7", "New")]
    assert [r["posting_id"] for r in gone.collect()] == ["k7"]
    # the old version still reads as before; a third one drops it, with the files only it names
    assert spark.table(version).count() == 301
    write_day(root, "2026-08-14", [dict(GOOD, slug="k7", title="Newer"), dict(GOOD, slug=None, title="N")],
              mtime=1_786_700_000)
    stg, _ = stage_into(spark, root, "cow_stg", buckets=8)
    assert not spark.catalog.tableExists(version)
    assert _rows(stg) == _rows(stage(read_landing(spark, root)))
    assert len(before - _files(spark, "cow_stg")) == 1
    buckets.drop_buckets(spark, "cow_stg")
    assert not _files(spark, "cow_stg") and not spark.catalog.tableExists("cow_stg")


def test_buckets_join_and_group_without_a_shuffle(spark):
    rows = spark.range(1000).select(F.concat(F.lit("k"), "id").alias("posting_id"), "id")
    buckets.write_buckets(rows, "cow_a", "posting_id", 6)
    buckets.write_buckets(rows, "cow_b", "posting_id", 6)
    a, b = spark.table("cow_a"), spark.table("cow_b")
    for plan in (a.join(b, "posting_id"), a.groupBy("posting_id").count()):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text, text
        assert plan.count() == 1000
    only = buckets.only(spark, buckets.stored_in_buckets(spark, "cow_a"), [2])
    assert len(only.inputFiles()) >= 1
    assert {r["b"] for r in only.select(buckets.bucket_of("posting_id", 6).alias("b")).distinct().collect()} == {2}
    for name in ("cow_a", "cow_b"):
        buckets.drop_buckets(spark, name)


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().splitlines()


def test_changed_rows_join_by_bucket_without_a_shuffle(spark, tmpdir_path):
    """Only the rows without a key, one at most from each version, are dealt out anew."""
    root = os.path.join(tmpdir_path, "landing")
    days = [[dict(GOOD, slug=s, title="A") for s in ("a", "b", None)],
            [dict(GOOD, slug="b", title="B"), dict(GOOD, slug="c", tags=None)],
            [dict(GOOD, slug=None, title="N", tags=None)]]
    stored = []
    for day, records in enumerate(days):
        write_day(root, f"2026-08-1{day}", records, mtime=1_786_500_000 + day)
        stage_into(spark, root, "cow_diff", buckets=1)
        stored.append(buckets.stored_in_buckets(spark, "cow_diff"))
        if day == 0:
            continue
        pair = changed_rows(spark, "cow_diff", *stored[-2:])
        found = [[(r["posting_id"], r["title"]) for r in side.collect()] for side in pair]
        assert list(map(lambda x: sorted(x, key=repr), found)) == (
            [[("b", "A")], [("b", "B"), ("c", "Data Engineer")]] if day == 1 else [[(None, "A")], [(None, "N")]])
        for side in pair:
            tree = _plan(side)
            moved = [i for i, line in enumerate(tree) if "Exchange" in line]
            below = [next(line for line in tree[i:] if "Filter" in line) for i in moved]
            assert all("isnull(posting_id" in line for line in below), "\n".join(tree)
    buckets.drop_buckets(spark, "cow_diff")


def test_new_files_are_read_and_merged_without_moving_or_sorting_the_rest(spark, tmpdir_path, monkeypatch):
    root = os.path.join(tmpdir_path, "landing")
    write_day(root, "2026-08-12", [dict(GOOD, slug=f"k{i}") for i in range(20)] + [dict(GOOD, slug=None)],
              mtime=1_786_500_000)
    stage_into(spark, root, "cow_merge", buckets=2)
    write_day(root, "2026-08-13", [dict(GOOD, slug=s, title="New") for s in ("k3", "k99", None)],
              mtime=1_786_600_000)
    landed = staging.landed_files(spark, root).filter(F.col("path").contains("2026-08-13"))
    rows = staging.read_files(spark, root, landed)
    assert rows.count() == 3
    assert not any("Exchange hashpartitioning(source_file" in line for line in _plan(rows))
    fresh, want = stage(rows).checkpoint(), _rows(stage(read_landing(spark, root)))
    previous = spark.table(buckets.stored_in_buckets(spark, "cow_merge"))
    for bound, join in ((staging.HASHED_BUCKET_BYTES, "ShuffledHashJoin"), (0, "SortMergeJoin")):
        monkeypatch.setattr(staging, "HASHED_BUCKET_BYTES", bound)
        merged = staging.merge_newest(previous, staging.hashed_if_small(fresh, 2))
        assert any(f"{join} [posting_id" in line and "FullOuter" in line for line in _plan(merged))
        assert _rows(merged, STAGING_COLUMNS) == want
    buckets.drop_buckets(spark, "cow_merge")


def test_a_failed_write_leaves_the_view(spark):
    buckets.write_buckets(spark.range(10).withColumn("v", F.lit(1)), "cow_fail", "id", 3)
    bad = spark.range(10).withColumn("v", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        buckets.write_buckets(bad, "cow_fail", "id", 3)
    assert spark.table("cow_fail").filter("v = 1").count() == 10
    buckets.drop_buckets(spark, "cow_fail")


@pytest.mark.parametrize("seed", [1, 2])
def test_marts_maintained_over_random_days_equal_a_build_from_scratch(spark, tmpdir_path, seed):
    rng = random.Random(seed)
    root = os.path.join(tmpdir_path, "landing")
    stg, mart, tags = (f"keep{seed}_{x}" for x in ("stg", "mart", "tags"))
    modes = []
    for day in range(10, 16):
        records = [dict(GOOD, slug=rng.choice([f"p{rng.randrange(12)}", None]),
                        tags=rng.choice([None, [], [f" T{rng.randrange(6)} ", f"t{rng.randrange(6)}", ""]]),
                        created_at=rng.choice([None, 1_786_400_000 + rng.randrange(5)]))
                   for _ in range(rng.choice([1, 4, 12]))]
        if day == 13:  # a replay: staging is rebuilt, the marts are still maintained
            shutil.rmtree(os.path.join(root, "ingest_date=2026-08-11"))
        write_day(root, f"2026-08-{day}", records, mtime=1_786_500_000 + 1000 * day)
        before = buckets.stored_in_buckets(spark, stg)
        stage_into(spark, root, stg, buckets=4)
        got_mart, one = postings_into(spark, stg, before, mart, 4)
        got_tags, two = popularity_into(spark, stg, before, tags, 3)
        modes.append((one, two))
        staged = stage(read_landing(spark, root))
        assert _rows(got_mart) == _rows(postings_mart(staged), got_mart.columns)
        assert _rows(got_tags, POPULARITY_COLUMNS) == _rows(tag_popularity_mart(posting_tags(staged)),
                                                            POPULARITY_COLUMNS)
    assert modes[1:] == [(MAINTAINED, MAINTAINED)] * 5
    # a mart that missed a build is built whole, not maintained from the wrong state
    stage_into(spark, root, stg, buckets=4, full=True)
    for k in range(2):
        write_day(root, f"2026-08-2{k}", [dict(GOOD, slug="late", tags=["x"])], mtime=1_786_600_000 + k)
        before = buckets.stored_in_buckets(spark, stg)
        stage_into(spark, root, stg, buckets=4)
    got, mode = popularity_into(spark, stg, before, tags, 3)
    assert mode == "full"
    assert _rows(got, POPULARITY_COLUMNS) == _rows(
        tag_popularity_mart(posting_tags(stage(read_landing(spark, root)))), POPULARITY_COLUMNS)
    for name in (stg, mart, tags):
        buckets.drop_buckets(spark, name)


def test_only_tags_that_lost_an_extreme_read_staging_again(spark):
    at = lambda *xs: [f"2026-01-0{x} 00:00:00" if x else None for x in xs]
    current = spark.createDataFrame(
        [("keep", 5, *at(1, 5)), ("first", 5, *at(1, 5)), ("last", 5, *at(1, 5)), ("same", 2, *at(1, 5)),
         ("zero", 1, *at(3, 3)), ("none", 2, *at(0, 0))],
        "tag string, postings bigint, first_seen_at string, last_seen_at string")
    rows = [("a", at(2)[0], ["keep", "none"]), ("b", at(1)[0], ["first", "same"]),
            ("c", at(5)[0], ["last"]), ("d", at(3)[0], ["zero"])]
    new = [("b", at(1)[0], ["same"]), ("e", at(7)[0], ["new", "keep"])]
    frame = lambda some: spark.createDataFrame(some, "posting_id string, posted_at string, tags array<string>")
    deltas = tag_deltas(frame(rows), frame(new))
    staging = frame([("s", at(2)[0], ["first", "last"]), ("t", at(4)[0], ["first", "last", "keep"])])
    got = {r["tag"]: tuple(r)[1:] for r in popularity_after(current, deltas, staging).collect()}
    assert got == {"keep": (5, *at(1, 7)), "first": (4, *at(2, 4)), "last": (4, *at(2, 4)),
                   "same": (2, *at(1, 5)), "none": (1, *at(0, 0)), "new": (1, *at(7, 7))}


def test_build_maintains_its_marts(spark, tmpdir_path):
    write_day(tmpdir_path, "2026-08-12", [dict(GOOD, slug=f"k{i}") for i in range(40)], mtime=1_786_500_000)
    build(spark, tmpdir_path, "cow_db", buckets=4)
    names = [f"cow_db.{x}" for x in ("stg_postings", "fct_postings", "fct_tag_popularity")]
    before = {n: _files(spark, n) for n in names}
    write_day(tmpdir_path, "2026-08-13", [dict(GOOD, slug="k3", tags=["new"])], mtime=1_786_600_000)
    b = build(spark, tmpdir_path, "cow_db", buckets=4)
    assert [len(_files(spark, n) - before[n]) for n in names][:2] == [1, 1]
    assert len(_files(spark, names[2]) - before[names[2]]) <= 3  # new, python, sql
    pop = {r["tag"]: r["postings"] for r in b.popularity.collect()}
    assert pop == {"sql": 39, "python": 39, "new": 1}
    assert b.enriched.count() == 40


def test_figures_per_bucket_equal_the_checks_over_everything(spark):
    """Random changes to two tables: each time the kept figures equal those of the whole tables,
    and only buckets of which either side changed are read."""
    rng = random.Random(3)
    schema, n = "k bigint, v string, at timestamp", 5
    make = lambda m: spark.createDataFrame(
        [(rng.choice([None, *range(40)]), rng.choice([None, *"abcdefgh"]),
          dt.datetime(2026, 8, rng.randrange(1, 9), rng.randrange(24))) for _ in range(m)], schema)
    buckets.drop_buckets(spark, "fig_a"), buckets.drop_buckets(spark, "fig_b")
    spark.sql("DROP VIEW IF EXISTS fig_a__summary")
    rows, parents = make(200), spark.range(0, 40, 2).withColumnRenamed("id", "p")
    version = buckets.write_buckets(rows, "fig_a", "k", n)
    buckets.write_buckets(parents, "fig_b", "p", n)
    asked = dict(key="k", at="at", sketched=["v"], parent="fig_b", parent_key="p")
    for step in range(4):
        figures, read = summarised(spark, "fig_a", **asked)
        stored = spark.table("fig_a")
        want = {"not_null_fig_k": stored.filter("k IS NULL").count(), "not_null_fig_v": stored.filter("v IS NULL").count(),
                "not_null_fig_at": 0, "unique_fig_k": duplicate_groups(stored, ["k"]).count(),
                "relationships_fig_k": orphans(stored, "k", spark.table("fig_b"), "p")
                .agg(F.coalesce(F.sum("rows_found"), F.lit(0))).first()[0], "not_empty_fig": 0}
        assert {r["check_name"]: r["failures"] for r in summary_report(figures, "fig", "k").collect()} == want
        whole = stored.agg(F.count(F.lit(1)), F.countDistinct("k"), F.max("at"), F.countDistinct(F.to_date("at")))
        assert tuple(summary_verification(figures).first())[:4] == tuple(whole.first())
        assert distinct_estimates(figures).first()["estimate"] == 8
        assert read == (n if step == 0 else len(changed))
        assert summarised(spark, "fig_a", **asked)[1] == 0
        some = make(2)
        changed = buckets.touched_buckets(some, "k", n)
        version = buckets.write_buckets(buckets.only(spark, version, changed).unionByName(some), "fig_a", "k",
                                        previous=version, touched=changed)


def test_sketches_keep_their_error(spark):
    rows = spark.range(60_000).selectExpr("id % 997 AS k", "CAST(id % 20000 AS STRING) AS v", "id % 50 AS w")
    buckets.drop_buckets(spark, "fig_s")
    buckets.write_buckets(rows, "fig_s", "k", 4)
    figures, _ = summarised(spark, "fig_s", "k", sketched=["v", "w"])
    found = {r["column"]: r for r in distinct_estimates(figures).collect()}
    assert found["v"]["low"] <= 20_000 <= found["v"]["high"] and found["w"]["low"] <= 50 <= found["w"]["high"]
    assert abs(found["v"]["estimate"] - 20_000) <= 20_000 * 3 * SKETCH_ERROR
