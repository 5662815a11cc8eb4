"""Staging, fan-out, marts, checks and the gated publish over a postings fixture."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from quarry.operators.fanout import explode_clean
from quarry.operators.joins import attach_counts
from quarry.operators.quality import ChecksFailed, require_passed, run_checks
from quarry.plans import daily
from quarry.plans.postings import (ENRICHED_COLUMNS, MART_COLUMNS, POPULARITY_COLUMNS,
                                   STAGING_COLUMNS, TAG_COLUMNS, build, newest, posting_tags,
                                   postings_mart, rename_raw, stage)
from quarry.plans.suite import checks
from quarry.sinks.materialize import as_versioned, versions
from quarry.sources.landing import read_landing

from .conftest import GOOD, write_day

NOW = dt.datetime(2026, 8, 14, 12, 0, 0)
T1, T2 = 1_786_500_000, 1_786_600_000  # file mtimes: day 2 written later


def _fixture(root):
    write_day(root, "2026-08-12", [
        GOOD,
        dict(GOOD, slug="p2", title="  React Native Developer ", location="  ",
             tags=["Python", "python", " python ", ""]),
        dict(GOOD, slug="p3", tags=[]),
        dict(GOOD, slug="p4", tags=None),
        {k: v for k, v in GOOD.items() if k != "tags"} | {"slug": "p5"},
        dict(GOOD, slug="dup", title="First"),
        dict(GOOD, slug="dup", title="Second"),
    ], mtime=T1)
    write_day(root, "2026-08-13", [
        dict(GOOD, title="Data Engineer II", salary=1),
    ], mtime=T2)


@pytest.fixture
def landed(spark, tmpdir_path):
    _fixture(tmpdir_path)
    return read_landing(spark, tmpdir_path)


def test_stage_columns_and_newest_version(landed):
    stg = stage(landed)
    assert stg.columns == STAGING_COLUMNS
    rows = {r["posting_id"]: r for r in stg.collect()}
    assert len(rows) == 6
    assert rows["data-engineer-acme"]["title"] == "Data Engineer II"  # newest file wins
    assert str(rows["data-engineer-acme"]["ingest_date"]) == "2026-08-13"
    assert rows["p2"]["title"] == "React Native Developer" and rows["p2"]["location"] is None
    assert rows["p2"]["posted_at"] == dt.datetime(2026, 8, 11, 20, 55, 29)
    # same key twice in one file: a deterministic winner
    assert rows["dup"]["title"] == stage(landed).filter("posting_id = 'dup'").first()["title"]


def test_tags_and_counts(landed):
    stg = stage(landed)
    tags = posting_tags(stg)
    assert tags.columns == TAG_COLUMNS
    p2 = sorted(r["tag"] for r in tags.filter("posting_id = 'p2'").collect())
    assert p2 == ["python"]
    mart = postings_mart(stg)
    assert mart.columns == MART_COLUMNS
    counts = {r["posting_id"]: r["tag_count"] for r in mart.collect()}
    assert counts["p2"] == 1 and counts["p3"] == 0 and counts["p4"] == 0 and counts["p5"] == 0
    assert counts["data-engineer-acme"] == 2


def test_in_row_count_equals_join_path(landed):
    """The in-row count equals explode -> dedup -> count -> left join -> coalesce 0."""
    stg = stage(landed)
    tags = explode_clean(stg, "posting_id", "tags", "tag", carry=["posted_at"],
                         key_unique=False, order_col="posted_at")
    counts = tags.groupBy("posting_id").agg(F.count(F.lit(1)).alias("tag_count"))
    via_join = attach_counts(stg.select("posting_id"), counts, "posting_id", "tag_count")
    in_row = postings_mart(stg).select("posting_id", "tag_count")
    assert sorted(via_join.collect()) == sorted(in_row.collect())


def test_full_build_checks_and_publish(spark, tmpdir_path):
    _fixture(tmpdir_path)
    b = build(spark, tmpdir_path, "bt1", now=NOW)
    assert b.enriched.columns == ENRICHED_COLUMNS and len(ENRICHED_COLUMNS) == 12
    assert b.popularity.columns == POPULARITY_COLUMNS
    labels = {r["posting_id"]: r["discipline"] for r in b.enriched.collect()}
    assert labels["p2"] == "mobile" and labels["data-engineer-acme"] == "data"
    pop = {r["tag"]: r["postings"] for r in b.popularity.collect()}
    assert pop == {"sql": 2, "python": 3}  # acme + dup; acme + p2 + dup
    suite = checks(b, NOW)
    assert len(suite) == 32
    report = run_checks(suite)
    assert report.filter("status = 'fail'").count() == 0
    require_passed(report)


def test_iso_created_at_fails_not_null_and_blocks_publish(spark, tmpdir_path):
    write_day(tmpdir_path, "2026-08-12", [GOOD, dict(GOOD, slug="iso",
                                                     created_at="2026-08-11T00:00:00Z")])
    spark.sql("DROP TABLE IF EXISTS pub_target")
    spark.createDataFrame([("old",)], "v string").write.saveAsTable("pub_target")
    b = build(spark, tmpdir_path, "bt2", now=NOW)
    with pytest.raises(ChecksFailed, match="not_null_stg_postings_posted_at"):
        require_passed(run_checks(checks(b, NOW)))
    assert [r["v"] for r in spark.table("pub_target").collect()] == ["old"]


def test_daily_run_publishes_when_green(spark, tmpdir_path):
    import json
    pay = os.path.join(tmpdir_path, "payload")
    os.makedirs(pay)
    with open(os.path.join(pay, "p.json"), "w") as fh:
        json.dump({"data": [GOOD, dict(GOOD, slug="b", title="Backend Developer (Java)")]}, fh)
    landing = os.path.join(tmpdir_path, "landing")
    spark.sql("DROP TABLE IF EXISTS pub_green")
    res = daily.run(spark, landing, "postings", "bt3", publish_as="pub_green",
                    payload_path=pay, run_date="2026-08-12", now=NOW)
    assert res.ingest == {"landed": 2, "accepted": 2, "rejected": 0}
    assert res.published_rows == 2
    assert spark.table("pub_green").columns == ENRICHED_COLUMNS


def test_enriched_from_batched_labels_defaults_late_titles(spark, tmpdir_path):
    """The mart joined to the incremental label table; a title that arrived
    after the last labelling run is `other`, not missing."""
    from quarry.plans.postings import enriched_mart
    from quarry.plans.title_labels import label_titles
    _fixture(tmpdir_path)
    stg = stage(read_landing(spark, tmpdir_path))
    mart = postings_mart(stg)
    spark.sql("DROP TABLE IF EXISTS labels_j4")
    label_titles(spark, mart.filter("posting_id <> 'p2'"), "labels_j4")
    out = enriched_mart(mart, NOW, labels=spark.table("labels_j4"))
    assert out.columns == ENRICHED_COLUMNS
    got = {r["posting_id"]: r["discipline"] for r in out.collect()}
    assert got["p2"] == "other"  # React Native Developer, not labelled yet
    assert got["data-engineer-acme"] == "data"
    assert len(got) == 6


def test_posting_grain_checks_need_no_shuffle(spark, tmpdir_path):
    """Staging and the posting marts are bucketed on posting_id, the popularity
    mart on tag: unique, grain and referential checks run without any hash
    exchange (what remains is one partial count per task into the report)."""
    import contextlib
    import io
    _fixture(tmpdir_path)
    b = build(spark, tmpdir_path, "bt_bucket", now=NOW)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        run_checks(checks(b, NOW)).explain("formatted")
    text = buf.getvalue()
    assert "Arguments: hashpartitioning" not in text


def _tree(df) -> list[str]:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("== Physical Plan ==")[1].split("\n\n")[0].splitlines()


def _rows_of(df):
    return sorted((tuple(r[c] for c in STAGING_COLUMNS) for r in df.collect()), key=repr)


def test_incremental_staging_equals_full_rebuild(spark, tmpdir_path):
    """New day: only its file is read and merged; a replayed day: full rebuild.
    Either way staging equals the newest version over every landed file."""
    import shutil
    _fixture(tmpdir_path)
    first = build(spark, tmpdir_path, "bt_incr", now=NOW)
    assert first.staging_mode == "full"
    again = build(spark, tmpdir_path, "bt_incr", now=NOW)
    assert again.staging_mode == "unchanged"
    # nothing landed: the mart stays the version it was
    assert len(versions(spark, "bt_incr.fct_postings")) == 1
    with pytest.raises(Exception):
        as_versioned(again.postings.select(F.raise_error(F.lit("no")).alias("x")),
                     "bt_incr.fct_postings")
    assert spark.table("bt_incr.fct_postings").count() == again.postings.count()
    write_day(tmpdir_path, "2026-08-14", [dict(GOOD, slug="p3", title="Vue Developer"),
                                          dict(GOOD, slug="new1")], mtime=1_786_700_000)
    incr = build(spark, tmpdir_path, "bt_incr", now=NOW)
    assert incr.staging_mode == "incremental"
    # a changed mart is a new version behind the same view, the one before it is kept
    assert len(versions(spark, "bt_incr.fct_postings")) == 2
    assert _rows_of(incr.staging) == _rows_of(stage(read_landing(spark, tmpdir_path)))
    assert {r["posting_id"]: r["title"] for r in incr.staging.collect()}["p3"] == "Vue Developer"
    # replay day 1 without most of its records: withdrawn postings must disappear
    shutil.rmtree(os.path.join(tmpdir_path, "ingest_date=2026-08-12"))
    write_day(tmpdir_path, "2026-08-12", [dict(GOOD, slug="p2")], mtime=1_786_800_000)
    replay = build(spark, tmpdir_path, "bt_incr", now=NOW)
    assert replay.staging_mode == "full"
    assert _rows_of(replay.staging) == _rows_of(stage(read_landing(spark, tmpdir_path)))
    assert "dup" not in {r["posting_id"] for r in replay.staging.collect()}


def test_merge_newest_shuffles_only_the_new_rows(spark, tmpdir_path):
    """merge_newest(previous, newest(new)) == newest(previous + new) for both
    orderings, NULL keys included, and the bucketed previous side reaches the
    join without an exchange."""
    from quarry.plans.staging import landed_files, merge_newest, read_files

    _fixture(tmpdir_path)
    write_day(tmpdir_path, "2026-08-12", [dict(GOOD, slug=None, title="Old null")],
              name="extra.json", mtime=T1)
    build(spark, tmpdir_path, "bt_merge", now=NOW)
    previous = spark.table("bt_merge.stg_postings").select(*STAGING_COLUMNS)
    write_day(tmpdir_path, "2026-08-11", [
        dict(GOOD, slug="p3", title="Vue Developer"), dict(GOOD, slug="new1"),
        dict(GOOD, slug=None, title="New null"), dict(GOOD, slug="p4", title="Older day")],
        mtime=1_786_700_000)
    wanted = landed_files(spark, tmpdir_path).filter(F.col("path").contains("2026-08-11"))
    landed = read_files(spark, tmpdir_path, wanted)
    assert landed.select("source_file").distinct().count() == 1 and landed.count() == 4
    new = rename_raw(landed)
    for by_day in (False, True):
        got = merge_newest(previous, stage(landed, by_day), by_day)
        want = newest(previous.unionByName(new), by_day)
        assert _rows_of(got) == _rows_of(want)
        titles = {r["posting_id"]: r["title"] for r in got.collect()}
        # file time first: the later-written file wins even for an older day folder
        assert titles["p4"] == ("Data Engineer" if by_day else "Older day")
        assert titles[None] == ("Old null" if by_day else "New null")
    tree = _tree(merge_newest(previous, stage(landed)))
    join = next(i for i, ln in enumerate(tree) if "SortMergeJoin FullOuter" in ln)
    left = tree[join + 1:next(i for i in range(join, len(tree)) if "Scan parquet" in tree[i]) + 1]
    assert not any("Exchange" in ln for ln in left)


def test_streamed_additions_leave_the_version_unshuffled(spark, tmpdir_path):
    """Each micro-batch stores its own rows; reading the view never moves the version's
    rows, and the last batch folds the additions into the next version."""
    from quarry.sinks.materialize import current_version, deltas
    from quarry.streaming.latest import merge_batch

    root = os.path.join(tmpdir_path, "days")
    stored = []
    for d in range(1, 5):
        write_day(root, f"2026-08-0{d}", [dict(GOOD, title=f"T{d}"), dict(GOOD, slug=f"s{d}"),
                                          dict(GOOD, slug=None, title=f"N{d}")],
                  mtime=1_786_000_000 + d * 1000)
        day = read_landing(spark, root).filter(f"ingest_date = DATE'2026-08-0{d}'")
        merge_batch(day, "bt_additions", compact_every=3)
        merge_batch(day.filter("false"), "bt_additions", compact_every=3)
        base = current_version(spark, "bt_additions")
        stored.append((spark.table(base).count(),
                       [spark.table(t).count() for t in deltas(spark, base)]))
        assert _rows_of(spark.table("bt_additions")) == _rows_of(stage(read_landing(spark, root)))
        tree = _tree(spark.table("bt_additions"))
        joins = [i for i, ln in enumerate(tree) if "SortMergeJoin FullOuter" in ln]
        assert len(joins) == (1 if stored[-1][1] else 0)
        for j in joins:
            scan = next(i for i in range(j, len(tree)) if "Scan parquet" in tree[i])
            assert not any("Exchange" in ln for ln in tree[j:scan])
    assert stored == [(3, []), (3, [3]), (3, [3, 3]), (6, [])]
    assert len(versions(spark, "bt_additions")) == 2
