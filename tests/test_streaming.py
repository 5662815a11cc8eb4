"""Streaming newest-version (X1, X2) equals the batch staging after one and two days."""

import os
import tempfile

from quarry.plans.postings import STAGING_COLUMNS, stage
from quarry.sources.landing import read_landing
from quarry.sinks.materialize import ADDED, GONE, current_version, deltas
from quarry.streaming.latest import start
from quarry.streaming.replays import merge_live, retract

from .conftest import GOOD, write_day


def _rows(df):
    return sorted((tuple(r[c] for c in STAGING_COLUMNS) for r in df.collect()), key=repr)


def test_stream_matches_batch_after_each_day(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-ckpt-")
    spark.sql("DROP TABLE IF EXISTS stream_stg")
    write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug="b", tags=["x", " X "])],
              mtime=1_786_500_000)
    start(spark, root, "stream_stg", ckpt).awaitTermination(120)
    spark.catalog.refreshTable("stream_stg")
    assert _rows(spark.table("stream_stg")) == _rows(stage(read_landing(spark, root)))

    write_day(root, "2026-08-13", [dict(GOOD, title="Data Engineer II"),
                                   dict(GOOD, slug="c")], mtime=1_786_600_000)
    start(spark, root, "stream_stg", ckpt).awaitTermination(120)
    spark.catalog.refreshTable("stream_stg")
    streamed = spark.table("stream_stg")
    assert _rows(streamed) == _rows(stage(read_landing(spark, root)))
    titles = {r["posting_id"]: r["title"] for r in streamed.collect()}
    assert titles["data-engineer-acme"] == "Data Engineer II" and len(titles) == 3


def test_replayed_day_divergence_is_pinned(spark, tmpdir_path):
    """A record withdrawn by replaying a day stays in the stream's state,
    while the batch rebuild drops it. The batch rebuild is the source of truth."""
    import shutil
    root = os.path.join(tmpdir_path, "landing")
    ckpt = tempfile.mkdtemp(prefix="quarry-stream-ckpt-")
    spark.sql("DROP TABLE IF EXISTS stream_x3")
    write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug="gone")], mtime=1_786_500_000)
    start(spark, root, "stream_x3", ckpt).awaitTermination(120)
    # replay the day without the withdrawn record, under a new file name
    shutil.rmtree(os.path.join(root, "ingest_date=2026-08-12"))
    write_day(root, "2026-08-12", [GOOD], name="part-2.json", mtime=1_786_600_000)
    start(spark, root, "stream_x3", ckpt).awaitTermination(120)
    spark.catalog.refreshTable("stream_x3")
    streamed = {r["posting_id"] for r in spark.table("stream_x3").collect()}
    batch = {r["posting_id"] for r in stage(read_landing(spark, root)).collect()}
    assert streamed == {"data-engineer-acme", "gone"}
    assert batch == {"data-engineer-acme"}


def test_rerun_micro_batch_changes_nothing(spark, tmpdir_path):
    """A micro-batch run again after a failure merges the same rows again: the
    table is unchanged. A NULL key over two batches stays one row, as in batch."""
    from quarry.streaming.latest import merge_batch

    root = os.path.join(tmpdir_path, "landing")
    write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug=None, title="First null")],
              mtime=1_786_500_000)
    merge_batch(read_landing(spark, root), "stream_rerun")
    write_day(root, "2026-08-13", [dict(GOOD, title="Data Engineer II"),
                                   dict(GOOD, slug=None, title="Second null")],
              mtime=1_786_600_000)
    day2 = read_landing(spark, root).filter("ingest_date = DATE'2026-08-13'")
    merge_batch(day2, "stream_rerun")
    once = _rows(spark.table("stream_rerun"))
    merge_batch(day2, "stream_rerun")
    assert _rows(spark.table("stream_rerun")) == once == _rows(stage(read_landing(spark, root)))
    titles = {r["posting_id"]: r["title"] for r in spark.table("stream_rerun").collect()}
    assert titles == {"data-engineer-acme": "Data Engineer II", None: "Second null"}


def _follow(spark, root, name, ckpt, **more):
    query = start(spark, root, name, ckpt, withdraw=True, **more)
    query.awaitTermination(120)
    assert query.exception() is None
    spark.catalog.refreshTable(name)


def test_withdrawn_records_leave_and_older_versions_return(spark, tmpdir_path):
    """A replayed day, a file rewritten in place, and a deleted day: each time the table
    equals the batch staging of what stands, also over a compaction."""
    import shutil
    root = os.path.join(tmpdir_path, "landing")
    for k, by_day in enumerate((False, True)):
        ckpt = tempfile.mkdtemp(prefix="quarry-stream-ckpt-")
        name = f"stream_live{k}"
        root = os.path.join(tmpdir_path, f"landing{k}")
        equal = lambda: _rows(spark.table(name)) == _rows(
            stage(read_landing(spark, root), by_day))
        follow = lambda: _follow(spark, root, name, ckpt, newest_by_day=by_day,
                                 compact_every=4, buckets=3)
        write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug="gone"), dict(GOOD, slug=None),
                                       dict(GOOD, slug="both", title="Old")], mtime=1_786_500_000)
        follow()
        write_day(root, "2026-08-13", [dict(GOOD, slug="both", title="New")], mtime=1_786_600_000)
        follow()
        assert equal() and len(spark.table(name).collect()) == 4
        # day one replayed under another file name, without a record
        shutil.rmtree(os.path.join(root, "ingest_date=2026-08-12"))
        write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug="both", title="Replayed")],
                  name="part-2.json", mtime=1_786_700_000)
        follow()
        titles = {r["posting_id"]: r["title"] for r in spark.table(name).collect()}
        assert equal() and set(titles) == {"data-engineer-acme", "both"}
        assert titles["both"] == ("New" if by_day else "Replayed")
        # day two rewritten in place without its record, noticed with the next day's file
        write_day(root, "2026-08-13", [dict(GOOD, slug="late")], mtime=1_786_800_000)
        write_day(root, "2026-08-14", [dict(GOOD, slug="x")], mtime=1_786_900_000)
        follow()
        titles = {r["posting_id"]: r["title"] for r in spark.table(name).collect()}
        assert equal() and titles["both"] == "Replayed" and "late" in titles
        # a day that is only deleted
        shutil.rmtree(os.path.join(root, "ingest_date=2026-08-12"))
        retract(spark, root, name, 3, by_day, 4)
        assert equal() and {r["posting_id"] for r in spark.table(name).collect()} == {"late", "x"}
        for day in range(15, 19):  # compaction drops the list, the table stays equal
            write_day(root, f"2026-08-{day}", [dict(GOOD, slug=f"d{day}"), dict(GOOD, slug="x")],
                      mtime=1_786_900_000 + day)
            follow()
            assert equal()
        version = current_version(spark, name)
        assert len(deltas(spark, version, ADDED)) < 4 and not deltas(spark, version, GONE)


def test_rerun_of_a_live_batch_and_lost_notes_change_nothing(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    write_day(root, "2026-08-12", [GOOD, dict(GOOD, slug="b")], mtime=1_786_500_000)
    batch = read_landing(spark, root)
    merge_live(batch, root, "stream_again")
    merge_live(batch, root, "stream_again")
    spark.sql("DROP TABLE stream_again__files")
    os.remove(os.path.join(root, "ingest_date=2026-08-12", "data.json"))
    write_day(root, "2026-08-12", [GOOD], name="part-2.json", mtime=1_786_600_000)
    merge_live(read_landing(spark, root), root, "stream_again")
    assert _rows(spark.table("stream_again")) == _rows(stage(read_landing(spark, root)))
    assert spark.table("stream_again").count() == 1


def test_a_replay_writes_a_list_and_its_own_rows_only(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "landing")
    write_day(root, "2026-08-12", [dict(GOOD, slug=f"k{i}") for i in range(200)], mtime=1_786_500_000)
    merge_live(read_landing(spark, root), root, "stream_few", buckets=4)
    version = current_version(spark, "stream_few")
    os.remove(os.path.join(root, "ingest_date=2026-08-12", "data.json"))
    write_day(root, "2026-08-12", [dict(GOOD, slug="k1")], name="part-2.json", mtime=1_786_600_000)
    merge_live(read_landing(spark, root), root, "stream_few", buckets=4)
    assert current_version(spark, "stream_few") == version
    assert [spark.table(t).count() for t in deltas(spark, version, ADDED + GONE)] == [1, 1]
    assert [r["posting_id"] for r in spark.table("stream_few").collect()] == ["k1"]
    # the history is read through its buckets and joined with a broadcast list: not shuffled
    plan = spark.table("stream_few")._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "BroadcastHashJoin" in plan
