"""Registered queries over the driver's tables, each with its DuckDB twin.

Every query reads whole tables from ``sf_dir`` and runs the same library
operator the postings build uses, with the driver's columns standing in for
the postings' ones (``FIXTURES.md`` F8). ``SQL`` holds, per query, the ANSI
SQL that computes the same rows directly; column names match one to one.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import answer_map, clamp_label
from ..functions.text import blank_to_null, clip, first_segment, hash_personal
from ..functions.time import epoch_to_instant, to_day
from ..operators import aggregates as agg
from ..operators import quality as dq
from ..operators.batching import (assign_batches, batch_prompts, call_batches, global_rank,
                                  parse_answers, prompt_header, rules_answerer)
from ..operators.classify import label_expr, rules_sql
from ..operators.contract import contract_changes, register_contract
from ..operators.dedup import latest_per_key
from ..operators.fanout import explode_clean, explode_terms, item_count
from ..operators.joins import attach_counts, lookup, orphans, unseen_keys
from ..operators.validate import gate, gate_counts, rejects
from ..plans.marts import popularity_into
from ..plans.postings import newest, postings_mart, rename_raw, stage
from ..plans.staging import merge_newest, stage_into
from ..plans.summaries import (distinct_estimates, summarised, summary_report,
                               summary_verification)
from ..plans.title_labels import BatchesUnanswered, label_titles
from ..sinks.buckets import (drop_buckets, manifest, only, stored_in_buckets, touched_buckets,
                             write_buckets)
from ..sinks.landing import land_raw, source_root
from ..sinks.materialize import (ADDED, GONE, append_unseen, as_versioned, current_version,
                                 deltas, versions)
from ..sinks.publish import publish_projection, publish_table
from ..sinks.releases import publish_group, rollback
from ..session import checkpoint_dir, shared_folder
from ..sources.landing import unwrap
from ..sources.run_results import node_rows, summarise
from ..sources.split_payloads import split_payloads
from ..sources.tables import spread
from ..streaming.latest import newest_by_max, run_to_table
from ..streaming.ledger import BATCH, append_once, follow_runs
from ..streaming.latest import start as start_stream

# Stand-in rule set for part names ("hot gear", "old rod", ...): precedence
# matters (vintage first) and `old` must not match inside `cold`.
PART_RULES: dict[str, tuple[str, ...]] = {
    "vintage": ("old",),
    "thermal": ("cold", "hot"),
    "hardware": ("bolt", "rod", "gear"),
}
PART_VOCABULARY = ("vintage", "thermal", "hardware", "other")
EVENT_VOCABULARY = ("view", "click", "signup", "purchase")
BATCH_N = 10
FUTURE_NOW = dt.datetime(2024, 1, 29, 0, 0, 0)
EPOCH_BASE = 1_700_000_000
MERGE_CUTOFF = dt.datetime(2024, 1, 15, 0, 0, 0)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- staging

def staging_clean(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    raw = F.when(F.col("user_id") % 5 == 0, F.lit("   ")).otherwise(
        F.concat(F.lit("  "), F.col("event_type"), F.lit(" ")))
    return ev.select("event_id", blank_to_null(raw).alias("label"))


def latest_per_key_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", "event_type")
    return latest_per_key(ev, "user_id", [F.col("ts").desc(), F.col("event_id").desc()])


def stream_latest_per_key(spark, sf_dir):
    """latest_per_key computed by a Structured Streaming aggregation over the file."""
    schema = table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .parquet(sf_dir.rstrip("/"))).select(
        "user_id", "event_id", "ts", "event_type")
    newest = newest_by_max(stream, "user_id", ["ts", "event_id"], ["event_type"])
    with shared_folder(spark, "stream-latest") as base:
        run_to_table(newest, f"{base}/out", f"{base}/state",
                     state_partitions=spark.sparkContext.defaultParallelism)
        out = spark.read.parquet(f"{base}/out").select("user_id", "event_id", "ts", "event_type")
        return out.checkpoint(eager=True)


def epoch_to_date(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    instant = epoch_to_instant(F.lit(EPOCH_BASE) + F.col("event_id") * 977)
    # The day is registered as ISO text so the comparison does not depend on how
    # a client library renders DATE values; the library column itself is a DATE.
    return ev.select("event_id", F.date_format(to_day(instant), "yyyy-MM-dd").alias("day"))


def _raw_postings(spark, sf_dir) -> DataFrame:
    """Events in the raw posting shape: each user is a posting with many versions."""
    ev = table(spark, sf_dir, "events")
    s = F.lit
    return ev.select(
        F.concat(s("u"), F.col("user_id").cast("string")).alias("slug"),
        F.concat(s("  "), F.col("event_type"), s(" ")).alias("title"),
        F.concat(s("c"), (F.col("user_id") % 7).cast("string")).alias("company_name"),
        F.when(F.col("event_id") % 4 == 0, s("   "))
        .otherwise(F.concat(s("loc"), (F.col("event_id") % 3).cast("string"))).alias("location"),
        (F.col("value") > 25).alias("remote"),
        F.array(F.upper("event_type"), F.concat(s(" "), F.col("event_type"), s(" ")),
                F.concat(s("k"), (F.col("event_id") % 5).cast("string")), s("")).alias("tags"),
        (s(EPOCH_BASE) + F.col("event_id") * 977).alias("created_at"),
        F.concat(s("events/part-"), (F.col("event_id") % 3).cast("string")).alias("source_file"),
        F.to_date("ts").alias("ingest_date"),
        F.col("ts").cast("timestamp").alias("ingested_at"))


def staged_postings_mart(spark, sf_dir):
    """The published postings mart: stage (P1-P5, W1) -> mart (A1, P5, P6) -> K8 projection."""
    mart = publish_projection(postings_mart(stage(_raw_postings(spark, sf_dir))))
    # Registered with zone-free instants and an ISO day (values unchanged under
    # the UTC session) so the comparison does not depend on client rendering.
    return (mart.withColumn("posted_date", F.date_format("posted_date", "yyyy-MM-dd"))
            .withColumn("posted_at", F.col("posted_at").cast("timestamp_ntz"))
            .withColumn("ingested_at", F.col("ingested_at").cast("timestamp_ntz")))


def staged_postings_merge(spark, sf_dir):
    """Incremental staging (``merge_newest``) over raw-shaped records from ``events``.

    The records land in two parts, before and from ``MERGE_CUTOFF`` (a NULL
    time counts as the first part, so every record lands once): the first part
    is staged, the second staged and merged into it. The result must equal
    staging every record at once.
    """
    raw = rename_raw(_raw_postings(spark, sf_dir))
    first = F.coalesce(F.col("ingested_at") < F.lit(MERGE_CUTOFF), F.lit(True))
    checkpoint_dir(spark)
    parts = [newest(raw.filter(part)).checkpoint(eager=True) for part in (first, ~first)]
    merged = merge_newest(*parts)
    return merged.select(
        "posting_id", "title", "company_name", "location", "is_remote",
        F.to_json("tags").alias("tags"),
        F.col("posted_at").cast("timestamp_ntz").alias("posted_at"), "source_file",
        F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"),
        F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"))


def _event_lines(spark, sf_dir, source: str, tags=None) -> DataFrame:
    """``(event_id, event_type, raw)``: every event as the JSON line of one posting, sent by ``source``."""
    ev = table(spark, sf_dir, "events")
    s = F.lit
    tags = F.array(F.upper("event_type"), s("")) if tags is None else tags
    posting = F.struct(
        F.concat(s("e"), F.col("event_id").cast("string")).alias("slug"),
        F.concat(s("  "), F.col("event_type"), s(" ")).alias("title"),
        s(source).alias("company_name"),
        F.when(F.col("user_id") % 4 == 0, s("   ")).otherwise(s("here")).alias("location"),
        (F.col("value") > 25).alias("remote"),
        tags.alias("tags"),
        (s(EPOCH_BASE) + F.col("event_id") * 977).alias("created_at"))
    return ev.select("event_id", "event_type", F.to_json(posting).alias("raw"))


def _staged_view(staged: DataFrame) -> DataFrame:
    return staged.select(
        "posting_id", "title", "company_name", "location", "is_remote",
        F.to_json("tags").alias("tags"),
        F.col("posted_at").cast("timestamp_ntz").alias("posted_at"),
        F.date_format("ingest_date", "yyyy-MM-dd").alias("ingest_date"))


def _drop_versions(spark: SparkSession, name: str) -> None:
    parts = [t for v in versions(spark, name) for t in [*deltas(spark, v, ADDED + GONE), v]]
    spark.sql(f"DROP VIEW IF EXISTS {name}")
    for part in [*parts, f"{name}__files"]:
        spark.sql(f"DROP TABLE IF EXISTS {part}")


def landing_roundtrip(spark, sf_dir):
    """Every event landed by day, staged after each landing, day one then replayed.

    Day one is landed whole, day two corrects the purchases, and the replay of
    day one withdraws the clicks. Staging runs whole, merges day two's file, then
    rebuilds because a file that it had read is gone.
    """
    with shared_folder(spark, "landing") as root:
        name = f"quarry_staged_{uuid.uuid4().hex[:12]}"
        kind = F.col("event_type")
        landings = [("first", "2026-01-01", F.lit(True)),
                    ("second", "2026-01-02", kind == "purchase"),
                    ("replay", "2026-01-01", kind != "click")]
        modes = []
        try:
            for source, day, sent in landings:
                land_raw(_event_lines(spark, sf_dir, source).filter(sent), root, "postings", day)
                staged, mode = stage_into(spark, source_root(root, "postings"), name,
                                          newest_by_day=True)
                modes.append(mode)
            kept = _staged_view(staged).checkpoint(eager=True)
        finally:
            _drop_staging(spark, name)
    return kept.withColumn("modes", F.lit(" ".join(modes)))


def _drop_staging(spark: SparkSession, name: str) -> None:
    drop_buckets(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}__files")


def staging_one_key(spark, sf_dir):
    """Every event staged, then a file that corrects the first one: what the second build wrote."""
    with shared_folder(spark, "one-key") as root:
        name = f"quarry_staged_{uuid.uuid4().hex[:12]}"
        first = table(spark, sf_dir, "events").agg(F.min("event_id").alias("event_id"))
        found = []
        try:
            for source, day in (("first", "2026-01-01"), ("second", "2026-01-02")):
                lines = _event_lines(spark, sf_dir, source)
                if found:
                    lines = lines.join(F.broadcast(first), "event_id")
                land_raw(lines, root, "postings", day)
                staged, mode = stage_into(spark, source_root(root, "postings"), name,
                                          newest_by_day=True)
                found.append(manifest(spark, name, stored_in_buckets(spark, name)))
            kept = _staged_view(staged).checkpoint(eager=True)
        finally:
            _drop_staging(spark, name)
    rewritten = sum(found[0][b] != at for b, at in found[1].items())
    return kept.withColumns({"mode": F.lit(mode), "buckets_rewritten": F.lit(rewritten)})


def maintained_marts(spark, sf_dir):
    """The popularity mart kept up over three landed days, the last two of which change tags."""
    source_tags = lambda source: F.array(F.upper("event_type"), F.concat(
        F.lit(f"{source}-"), (F.col("user_id") % 97).cast("string")))
    landings = [("first", "2026-01-01", F.col("event_id") % 3 != 0),
                ("second", "2026-01-02", F.col("event_id") % 5 == 0),
                ("third", "2026-01-03", F.col("event_id") % 7 == 0)]
    with shared_folder(spark, "marts") as root:
        staging = f"quarry_staged_{uuid.uuid4().hex[:12]}"
        mart = f"{staging}_tags"
        modes = []
        try:
            for source, day, sent in landings:
                land_raw(_event_lines(spark, sf_dir, source, source_tags(source)).filter(sent),
                         root, "postings", day)
                before = stored_in_buckets(spark, staging)
                stage_into(spark, source_root(root, "postings"), staging, newest_by_day=True)
                kept, mode = popularity_into(spark, staging, before, mart)
                modes.append(mode)
            kept = kept.checkpoint(eager=True)
        finally:
            _drop_staging(spark, staging)
            drop_buckets(spark, mart)
    return kept.select("tag", "postings", *[F.col(c).cast("timestamp_ntz").alias(c) for c in (
        "first_seen_at", "last_seen_at")], F.lit(" ".join(modes)).alias("modes"))


def stream_merge(spark, sf_dir):
    """The merge stream over three days of landed events, the last of which compacts."""
    with shared_folder(spark, "stream") as root:
        name = f"quarry_streamed_{uuid.uuid4().hex[:12]}"
        kind = F.col("event_type")
        landings = [("first", "2026-01-01", kind != "signup"),
                    ("second", "2026-01-02", kind.isin("purchase", "signup")),
                    ("third", "2026-01-03", kind.isin("purchase", "click"))]
        stored = []
        try:
            for source, day, sent in landings:
                land_raw(_event_lines(spark, sf_dir, source).filter(sent), f"{root}/in",
                         "postings", day)
                query = start_stream(spark, source_root(f"{root}/in", "postings"), name,
                                     f"{root}/state", compact_every=2)
                query.awaitTermination()
                if query.exception() is not None:
                    raise RuntimeError(str(query.exception()))
                stored.append(1 + len(deltas(spark, current_version(spark, name))))
            spark.catalog.refreshTable(name)
            kept = _staged_view(spark.table(name)).checkpoint(eager=True)
        finally:
            _drop_versions(spark, name)
    return kept.withColumn("stored_tables", F.lit(" ".join(map(str, stored))))


def stream_replay(spark, sf_dir):
    """The three landings of ``landing_roundtrip`` through the stream that follows replays.

    Each landing is one trigger; the replay of day one withdraws the clicks, and the
    purchases of day two stand over both of its landings.
    """
    with shared_folder(spark, "replay") as root:
        name = f"quarry_replayed_{uuid.uuid4().hex[:12]}"
        kind = F.col("event_type")
        landings = [("first", "2026-01-01", F.lit(True)),
                    ("second", "2026-01-02", kind == "purchase"),
                    ("replay", "2026-01-01", kind != "click")]
        stored = []
        try:
            for source, day, sent in landings:
                land_raw(_event_lines(spark, sf_dir, source).filter(sent), f"{root}/in",
                         "postings", day)
                query = start_stream(spark, source_root(f"{root}/in", "postings"), name,
                                     f"{root}/state", newest_by_day=True, withdraw=True)
                query.awaitTermination()
                if query.exception() is not None:
                    raise RuntimeError(str(query.exception()))
                stored.append(1 + len(deltas(spark, current_version(spark, name))))
            spark.catalog.refreshTable(name)
            kept = _staged_view(spark.table(name)).checkpoint(eager=True)
        finally:
            _drop_versions(spark, name)
    return kept.withColumn("stored_tables", F.lit(" ".join(map(str, stored))))


# ---------------------------------------------------------------- fan-out and marts

def _part_tags(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    tags = F.when(F.col("p_size") % 7 == 0, F.lit(None).cast("array<string>")).otherwise(
        F.array(F.upper(w1), F.concat(F.lit(" "), w1, F.lit(" ")), w2, F.lit("  ")))
    return part.select("p_partkey", F.col("p_name").alias("title"), "p_retailprice",
                       tags.alias("tags"))


def tags_normalised(spark, sf_dir):
    return explode_clean(_part_tags(spark, sf_dir), "p_partkey", "tags", "tag")


def tag_count_mart(spark, sf_dir):
    return _part_tags(spark, sf_dir).select("p_partkey", item_count("tags").alias("tag_count"))


def tag_count_join(spark, sf_dir):
    """The count mart the long way: fan out with repeated keys, count, left join."""
    items = _part_tags(spark, sf_dir)
    tags = explode_clean(items.unionByName(items), "p_partkey", "tags", "tag", key_unique=False)
    counts = agg.count_per_key(tags, "p_partkey", "tag_count")
    return attach_counts(items.select("p_partkey"), counts, "p_partkey", "tag_count")


def tag_popularity(spark, sf_dir):
    tags = explode_clean(_part_tags(spark, sf_dir), "p_partkey", "tags", "tag",
                         carry=[F.col("p_partkey").alias("at")])
    return agg.key_popularity(tags, "tag", "at", "postings", "first_partkey", "last_partkey")


def doc_term_popularity(spark, sf_dir):
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "text"))
    terms = explode_terms(docs, "doc_id", "text", "term", carry=[F.col("doc_id").alias("at")])
    return agg.key_popularity(terms, "term", "at", "docs", "first_doc", "last_doc")


# ---------------------------------------------------------------- enrichment

def classify_titles(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    return part.select("p_partkey", label_expr("p_name", PART_RULES).alias("discipline"))


def classify_lookup(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    mapping = (part.filter(F.col("p_size") < 40).select(F.col("p_name").alias("title")).distinct()
               .select("title", label_expr("title", PART_RULES).alias("discipline")))
    postings = part.select("p_partkey", F.col("p_name").alias("title"))
    return lookup(postings, mapping, "title", "discipline", "other").select(
        "p_partkey", "discipline")


def label_lookup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return lookup(docs, labels, "doc_id", "quality", -1)


def enriched_mart(spark, sf_dir):
    """Flagship: part rows as postings, tags counted after cleaning, titles labelled."""
    return _part_tags(spark, sf_dir).select("p_partkey", "title", item_count("tags").alias("tag_count"),
                         label_expr("title", PART_RULES).alias("discipline"))


def classify_histogram(spark, sf_dir):
    return agg.count_per_key(classify_titles(spark, sf_dir), "discipline", "n")


# ---------------------------------------------------------------- incremental labelling

def _seen_titles(part: DataFrame) -> DataFrame:
    return part.filter(F.col("p_size") < 2).select(F.col("p_name").alias("title"))


def _new_titles(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return unseen_keys(part.select(F.col("p_name").alias("title")), "title", _seen_titles(part))


def incremental_new_keys(spark, sf_dir):
    return _new_titles(spark, sf_dir)


def _batched(spark, sf_dir) -> DataFrame:
    return assign_batches(global_rank(_new_titles(spark, sf_dir), "title"), BATCH_N)


def incremental_batches(spark, sf_dir):
    return _batched(spark, sf_dir).select("title", "batch_id", "pos")


def batch_prompts_q(spark, sf_dir):
    return batch_prompts(_batched(spark, sf_dir), "title",
                         vocabulary=PART_VOCABULARY).select("batch_id", "prompt")


def parse_answer(spark, sf_dir):
    ev = spread(table(spark, sf_dir, "events").select("event_id", "event_type", "props"))
    content = (
        F.when(F.col("event_id") % 3 == 0,
               F.concat(F.lit("Sure:\n```json\n{\"0\": \" "), F.upper("event_type"),
                        F.lit(" \"}\n``` ok")))
        .when(F.col("event_id") % 3 == 1,
              F.concat(F.lit("{\"1\": \""), F.col("event_type"), F.lit("\"}")))
        .otherwise(F.concat(F.lit("Result "), F.col("props"))))
    m = answer_map(content)
    return ev.select("event_id", clamp_label(m, F.lit(0), EVENT_VOCABULARY).alias("label"))


def incremental_union(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    seen = (_seen_titles(part).distinct()
            .select("title", label_expr("title", PART_RULES).alias("discipline")))
    prompts = batch_prompts(_batched(spark, sf_dir), "title", vocabulary=PART_VOCABULARY)
    answers = call_batches(prompts, rules_answerer(PART_RULES, PART_VOCABULARY))
    new = parse_answers(answers, "title", "discipline", PART_VOCABULARY)
    return seen.unionByName(new)


def incremental_calls(spark, sf_dir):
    """Titles labelled in two runs, the first of which gets no answer for its first batch.

    The second run meets new titles as well: it asks for these and for the unanswered
    ones alone, in new batches. ``run`` is the run that labelled a title.
    """
    part = table(spark, sf_dir, "part").select("p_size", F.col("p_name").alias("title"))
    early = part.filter(F.col("p_size") < 25)
    first_title = early.filter("title <> ''").agg(F.min("title")).first()[0]
    answer = rules_answerer(PART_RULES, PART_VOCABULARY)

    def fails_once(prompt):
        return "cut off" if first_title is not None and f"0. {first_title}\n" in f"{prompt}\n" else answer(prompt)

    target = f"quarry_labels_{uuid.uuid4().hex[:12]}"
    more = dict(batch_size=BATCH_N, vocabulary=PART_VOCABULARY, header="LINES:\n")
    checkpoint_dir(spark)
    try:
        with contextlib.suppress(BatchesUnanswered):
            label_titles(spark, early, target, fails_once, **more)
        seen = spark.table(target).select("title", F.lit(1).alias("run")).checkpoint(eager=True)
        label_titles(spark, part, target, answer, **more)
        calls = spark.table(f"{target}__calls").agg(F.sum("calls").alias("calls")).first()["calls"]
        stored = spark.table(target).checkpoint(eager=True)
    finally:
        for t in (target, f"{target}__answers", f"{target}__calls"):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    return stored.join(seen, "title", "left").select(
        "title", "discipline", F.coalesce("run", F.lit(2)).alias("run"),
        F.lit(calls).cast("bigint").alias("calls"))


# ---------------------------------------------------------------- validation gate

def _raw_records(spark, sf_dir) -> DataFrame:
    part = table(spark, sf_dir, "part")
    k = F.col("p_partkey").cast("string")
    nm, br = F.col("p_name"), F.col("p_brand")
    w1 = F.split_part("p_name", F.lit(" "), F.lit(1))
    w2 = F.split_part("p_name", F.lit(" "), F.lit(2))
    created = (F.lit(EPOCH_BASE) + F.col("p_partkey")).cast("string")
    remote = F.when(F.col("p_partkey") % 2 == 0, F.lit("true")).otherwise(F.lit('"yes"'))
    s = F.lit
    raw = (F.when(F.col("p_size") % 5 == 0, F.concat(
                s('{"slug":"p-'), k, s('","title":"'), nm, s('","company_name":"'), br,
                s('","location":null,"remote":'), remote, s(',"tags":["'), w1, s('","'), w2,
                s('"],"created_at":'), created, s("}")))
           .when(F.col("p_size") % 5 == 1, F.concat(
                s('{"slug":'), k, s(',"title":"'), nm, s('","company_name":"'), br,
                s('","created_at":'), created, s("}")))
           .when(F.col("p_size") % 5 == 2, F.concat(s('"'), nm, s('"')))
           .when(F.col("p_size") % 5 == 3, F.concat(
                s('{"slug":"p-'), k, s('","company_name":"'), br,
                s('","remote":null,"tags":['), k, s('],"created_at":"2024-01-0'),
                (F.col("p_partkey") % 9 + 1).cast("string"), s('"}')))
           .otherwise(F.concat(s('{"slug":"p-'), k, s('","title":'))))
    return spread(part.select(raw.alias("raw")))


def payload_records(spark, sf_dir):
    """S1 over payloads built from conversation rows: both envelope forms, with
    a scalar string, a number and a null beside each object."""
    conv = table(spark, sf_dir, "conversations")
    s = F.lit
    role = F.coalesce(F.concat(s('"'), F.col("role"), s('"')), s("null"))
    obj = F.concat(s('{"conv_id":'), F.col("conv_id").cast("string"), s(',"turn":'),
                   F.col("turn").cast("string"), s(',"role":'), role, s("}"))
    payload = F.when(F.col("conv_id") % 2 == 0, F.concat(
        s('{"data":['), obj, s(',"t'), F.col("turn").cast("string"), s('",'),
        F.col("turn").cast("string"), s(",null]}"))).otherwise(F.concat(s("["), obj, s("]")))
    payloads = conv.select("conv_id", "turn", payload.alias("payload"))
    return unwrap(payloads, "payload", keep=("conv_id", "turn"))


CONVERSATIONS_PER_FILE = 500


def payload_split(spark, sf_dir):
    """S1 over payload files of many records each, lists and wrapped lists, cut by many tasks.

    Every file holds the turns of 500 conversations, after a first element ``null``.
    """
    conv = table(spark, sf_dir, "conversations")
    s = F.lit
    record = F.concat(s(',{"conv_id":'), F.col("conv_id").cast("string"), s(',"turn":'),
                      F.col("turn").cast("string"), s(',"role":'),
                      F.coalesce(F.concat(s('"'), F.col("role"), s('"')), s("null")), s(',"in":{"n":["}"]}}'))
    turns = conv.select(F.floor(F.col("conv_id") / CONVERSATIONS_PER_FILE).alias("k"), s(1).alias("part"),
                        "conv_id", "turn", record.alias("value"))
    wrapped = F.col("k") % 2 == 1
    edges = turns.select("k").distinct().select("k", F.explode(F.array(
        F.struct(s(0).alias("part"), F.when(wrapped, '{"meta":{"n":[1]},"data":[null').otherwise("[null").alias("value")),
        F.struct(s(2).alias("part"), F.when(wrapped, '],"z":{}}').otherwise("]").alias("value")))).alias("e"))
    lines = turns.unionByName(edges.select("k", "e.part", s(0).cast("bigint").alias("conv_id"),
                                           s(0).cast("bigint").alias("turn"), "e.value"))
    with shared_folder(spark, "payloads") as root:
        (lines.repartition("k").sortWithinPartitions("k", "part", "conv_id", "turn").select("k", "value")
         .write.partitionBy("k").text(f"{root}/in"))
        found = split_payloads(spark, f"{root}/in").checkpoint(eager=True)
    file = F.regexp_extract("source_file", r"/k=([0-9]+)/", 1).cast("bigint")
    return found.select(file.alias("file"), "position", "raw")


def validation_gate(spark, sf_dir):
    return gate_counts(gate(_raw_records(spark, sf_dir)))


def rejects_q(spark, sf_dir):
    return rejects(gate(_raw_records(spark, sf_dir)))


# ---------------------------------------------------------------- data quality

def dq_not_null(spark, sf_dir):
    part = table(spark, sf_dir, "part").select(
        F.when(F.col("p_type") == "ECONOMY", F.lit(None)).otherwise(F.col("p_type")).alias("p_type"),
        "p_name")
    return dq.not_null_counts(part, ["p_type", "p_name"])


def dq_unique_grain(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return agg.duplicate_groups(li, ["l_orderkey", "l_linenumber"])


def dq_relationships(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    return orphans(orders, "o_orderkey", li, "l_orderkey")


def dq_accepted_values(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return dq.accepted_values_failures(ev, "event_type", EVENT_VOCABULARY)


def dq_not_in_future(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return dq.not_in_future_check("f", ev, "ts", now=FUTURE_NOW).failing_rows().select("event_id")


def dq_not_empty(spark, sf_dir):
    """The relation under test: line items that refer to no order."""
    orders, items = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    missing = orphans(items, "l_orderkey", orders, "o_orderkey")
    return agg.empty_check(missing)


def _report_checks(spark, sf_dir) -> list[dq.Check]:
    part = table(spark, sf_dir, "part")
    orders = table(spark, sf_dir, "orders")
    li = table(spark, sf_dir, "lineitem")
    ev = table(spark, sf_dir, "events")
    return [
        *dq.not_null_checks("part", part, ["p_name", "p_type"]),
        dq.unique_check("orders", orders, "o_orderkey"),
        dq.grain_check("grain_lineitem", li, ["l_orderkey", "l_linenumber"]),
        dq.relationships_check("lineitem", li, "l_orderkey", orders, "o_orderkey"),
        dq.relationships_check("orders", orders, "o_orderkey", li, "l_orderkey"),
        dq.accepted_values_check("events", ev, "event_type", EVENT_VOCABULARY),
        dq.not_in_future_check("not_in_future_events", ev, "ts", now=FUTURE_NOW),
        dq.not_empty_check("not_empty_events", ev),
    ]


def dq_report(spark, sf_dir):
    return dq.run_checks(_report_checks(spark, sf_dir))


def checks_after_append(spark, sf_dir):
    """The check report of ``orders`` from figures kept per bucket, after one row was added.

    The added row repeats the first order's key, without a priority: the second report
    reads that key's bucket alone (``buckets_read``) and equals a report of everything.
    """
    orders = table(spark, sf_dir, "orders")
    items = table(spark, sf_dir, "lineitem").select("l_orderkey")
    base = f"quarry_checked_{uuid.uuid4().hex[:12]}"
    name, other = f"{base}_orders", f"{base}_items"
    asked = dict(key="o_orderkey", at="o_orderdate", sketched=["o_custkey"], parent=other, parent_key="l_orderkey")
    checkpoint_dir(spark)
    try:
        version = write_buckets(orders, name, "o_orderkey")
        write_buckets(items, other, "l_orderkey")
        summarised(spark, name, **asked)
        first = orders.agg(F.min("o_orderkey").alias("least"))
        again = (orders.join(F.broadcast(first), F.col("o_orderkey") == F.col("least")).select(orders.columns)
                 .withColumn("o_orderpriority", F.lit(None).cast("string")).checkpoint(eager=True))
        touched = touched_buckets(again, "o_orderkey", len(manifest(spark, name, version)))
        write_buckets(only(spark, version, touched).unionByName(again), name, "o_orderkey",
                      previous=version, touched=touched)
        figures, read = summarised(spark, name, **asked)
        figures = figures.checkpoint(eager=True)
    finally:
        for t in (name, other):
            drop_buckets(spark, t)
        _drop_versions(spark, f"{name}__summary")
    exact = orders.agg(F.countDistinct("o_custkey")).first()[0]
    bounds = distinct_estimates(figures).first()
    whole = summary_verification(figures).select("rows", "ids", "days_covered", "dedup_held").first()
    told = {c: F.lit(v) for c, v in whole.asDict().items()}
    return summary_report(figures, "orders", "o_orderkey").withColumns(
        {"buckets_read": F.lit(read), **told,
         "estimate_in_bounds": F.lit(bounds["low"] <= exact <= bounds["high"])})


# ---------------------------------------------------------------- ops metrics

def freshness_q(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn("day", to_day("ts"))
    return agg.freshness(ev, "ts", "day")


def verify_publish(spark, sf_dir):
    return agg.publish_verification(table(spark, sf_dir, "orders"), "o_orderkey", "o_orderdate")


def reconcile_counts_q(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return agg.reconcile_counts(li, "l_orderkey", "l_linenumber")


def daily_counts(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select(to_day("ts").alias("day"))
    counts = agg.count_per_key(ev, "day", "n")
    return counts.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "n")


def _nodes(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select("event_id", "value", "props",
                     F.concat("event_type", F.lit("."), F.col("user_id").cast("string")).alias("node"))


def status_summary(spark, sf_dir):
    nodes = _nodes(spark, sf_dir).select(first_segment("node").alias("resource_type"))
    return agg.count_per_key(nodes, "resource_type", "n")


def node_projection(spark, sf_dir):
    return _nodes(spark, sf_dir).select(
        "event_id", "node", first_segment("node").alias("resource_type"),
        F.coalesce("value", F.lit(0.0)).alias("execution_time"),
        clip(F.coalesce("props", F.lit("")), 400).alias("message"))


RUN_NODES = 100  # nodes of one run-results document


def _run_documents(spark, sf_dir) -> DataFrame:
    """Run-results documents from ``events``: a user's day in documents of bounded size."""
    ev = table(spark, sf_dir, "events")
    result = F.struct(
        F.concat("event_type", F.lit("."), F.col("event_id").cast("string")).alias("unique_id"),
        F.col("event_type").alias("status"), F.col("value").cast("double").alias("execution_time"),
        F.col("props").alias("message"))
    day = F.date_format("ts", "yyyy-MM-dd")
    part = F.floor(F.col("event_id") / RUN_NODES).alias("part")
    return (ev.groupBy("user_id", day.alias("day"), part).agg(F.collect_list(result).alias("results"))
            .select(F.struct(
                F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("invocation_id"),
                F.concat("day", F.lit("T06:30:15.123Z")).alias("generated_at")).alias("metadata"),
                "results"))


def _ledger_view(rows: DataFrame) -> DataFrame:
    return rows.withColumn("run_at", F.date_format("run_at", "yyyy-MM-dd HH:mm:ss"))


def ledger_rows(spark, sf_dir):
    """Run-results documents of ``events`` through the ledger projection."""
    return _ledger_view(node_rows(_run_documents(spark, sf_dir)))


def ledger_stream(spark, sf_dir):
    """The documents landed as files in two parts, then all of them again: each node once.

    Every landing is drained by the ledger stream; ``held`` is the ledger's size after
    each, and the last epoch is written twice, as after a failure.
    """
    with shared_folder(spark, "runs") as root:
        name = f"quarry_ledger_{uuid.uuid4().hex[:12]}"
        docs = _run_documents(spark, sf_dir).select(
            "metadata.invocation_id", F.to_json(F.struct("metadata", "results")).alias("value"))
        half = F.pmod(F.hash("invocation_id"), F.lit(2)) == 0
        held = []
        try:
            for sent in (half, ~half, F.lit(True)):
                docs.filter(sent).select("value").write.mode("append").text(f"{root}/in")
                query = follow_runs(spark, f"{root}/in", name, f"{root}/state", multi_line=False)
                query.awaitTermination()
                if query.exception() is not None:
                    raise RuntimeError(str(query.exception()))
                spark.catalog.refreshTable(name)
                held.append(spark.table(name).count())
            again = spark.table(name).filter(F.col(BATCH) == "runs-1").drop(BATCH)
            append_once(again.checkpoint(eager=True), name, "runs-1")
            spark.catalog.refreshTable(name)
            kept = spark.table(name).drop(BATCH).checkpoint(eager=True)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    first, *rest = held
    return _ledger_view(kept).withColumns({"first_below_all": F.lit(first < held[-1]),
                                           "second": F.lit(rest[0]), "third": F.lit(rest[1])})


def contract_changes_q(spark, sf_dir):
    """What a new ``orders`` relation changes against its agreed contract, and the rows it affects."""
    orders = table(spark, sf_dir, "orders")
    agreed = orders.select(
        "o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus",
        F.array(F.struct("o_custkey", "o_orderdate")).alias("lines"),
        F.struct("o_orderstatus", F.struct("o_custkey").alias("customer")).alias("state"))
    proposed = orders.select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("o_totalprice"), "o_orderstatus",
        F.array(F.struct(F.col("o_custkey").cast("string").alias("o_custkey"),
                         F.col("o_orderstatus").alias("o_flag"))).alias("lines"),
        F.struct(F.col("o_orderstatus"), F.col("o_custkey").alias("customer")).alias("state"),
        F.col("o_orderdate").alias("o_placed"))
    name = f"quarry_contract_{uuid.uuid4().hex[:12]}"
    checkpoint_dir(spark)
    try:
        versions_kept = [register_contract(spark, name, f.schema) for f in (orders, agreed, agreed)]
        changes = contract_changes(spark, name, proposed.schema).checkpoint(eager=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}__contract")
    held = agreed.agg(*[F.count(c).alias(c) for c in agreed.columns])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rows")) for c in agreed.columns])
    per_column = held.select(F.explode(rows).alias("h")).select("h.*")
    column = F.regexp_extract("path", r"^[^.\[{]+", 0)
    return (changes.join(F.broadcast(per_column), column == F.col("column"), "left")
            .select("path", "change", "old_type", "new_type", "breaking",
                    F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows_held"),
                    F.lit(versions_kept[-1]).cast("bigint").alias("version")))


def publish_group_roundtrip(spark, sf_dir):
    """Two stored marts released together, a release that fails on its second mart, a rollback.

    No release writes a row: published views stand on the marts' own files.
    """
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    base = f"quarry_release_{uuid.uuid4().hex[:12]}"
    marts = {f"{base}_{x}_out": f"{base}_{x}" for x in ("a", "b")}
    out_a, out_b = marts
    checkpoint_dir(spark)

    def built(limit):
        as_versioned(orders.filter(F.col("o_orderkey") % 4 < limit).select("o_orderkey", "o_custkey"),
                     marts[out_a])
        as_versioned(customers.filter(F.col("c_custkey") % 4 < limit).select("c_custkey"), marts[out_b])

    def count(name):
        return spark.table(name).count()

    try:
        built(4)
        first = publish_group(spark, base, marts, source="orders")
        own_files = set(spark.table(out_a).inputFiles()) <= set(spark.table(marts[out_a]).inputFiles())
        built(2)
        publish_group(spark, base, marts, source="orders")
        second = count(out_a)
        as_versioned(customers.filter("false").select("c_custkey"), marts[out_b])
        as_versioned(orders.select("o_orderkey", "o_custkey").filter("o_orderkey % 4 = 3"), marts[out_a])
        with contextlib.suppress(ValueError):
            publish_group(spark, base, marts, source="orders")
        failed = count(out_a)
        rollback(spark, base)
        kept = spark.table(out_a).checkpoint(eager=True)
        customers_kept = count(out_b)
    finally:
        for published, mart in marts.items():
            spark.sql(f"DROP VIEW IF EXISTS {published}")
            _drop_versions(spark, mart)
        spark.sql(f"DROP TABLE IF EXISTS {base}__releases")
    return kept.withColumns({"first": F.lit(first[out_a]).cast("bigint"), "second": F.lit(second).cast("bigint"),
                             "after_failure": F.lit(failed).cast("bigint"),
                             "customers": F.lit(customers_kept).cast("bigint"), "own_files": F.lit(own_files)})


def status_counts(spark, sf_dir):
    return summarise(ledger_rows(spark, sf_dir))


def incremental_append(spark, sf_dir):
    """Customers appended twice to a stored table by nation-and-segment key, seen keys kept."""
    rows = table(spark, sf_dir, "customer").select("c_mktsegment", "c_custkey").withColumn(
        "label", F.concat_ws("-", "c_mktsegment", (F.col("c_custkey") % 977).cast("string")))
    keyed = rows.select(F.when(F.col("c_custkey") % 11 > 0, F.col("label")).alias("label"))
    name = f"quarry_increment_{uuid.uuid4().hex[:12]}"
    checkpoint_dir(spark)
    try:
        first = append_unseen(spark, keyed.filter(F.col("label") < "F"), name, "label")
        second = append_unseen(spark, keyed, name, "label")
        again = append_unseen(spark, keyed, name, "label")
        stored = spark.table(name).checkpoint(eager=True)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    return stored.select("label", F.lit(first).cast("bigint").alias("first_run"),
                         F.lit(second).cast("bigint").alias("second_run"),
                         F.lit(again).cast("bigint").alias("third_run"))


def publish_roundtrip(spark, sf_dir):
    """``orders`` published three times, read back through the view, then removed."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    name = f"quarry_published_{uuid.uuid4().hex[:12]}"
    checkpoint_dir(spark)
    try:
        for _ in range(3):
            n = publish_table(spark, rows, name, source="orders", check_contract=True)
        kept = len(versions(spark, name))
        back = spark.table(name).checkpoint(eager=True)
    finally:
        stored = versions(spark, name)
        spark.sql(f"DROP VIEW IF EXISTS {name}")
        for version in stored:
            spark.sql(f"DROP TABLE IF EXISTS {version}")
    return back.select("o_orderkey", "o_custkey", F.lit(n).cast("bigint").alias("published"),
                       F.lit(kept).cast("bigint").alias("versions_kept"))


def publish_projection_q(spark, sf_dir):
    projected = publish_projection(_part_tags(spark, sf_dir).drop("title"))
    return projected.withColumnRenamed("tags", "tags_json")


def pii_hash(spark, sf_dir):
    cust = table(spark, sf_dir, "customer")
    return cust.select("c_custkey", hash_personal("c_name").alias("name_hash"))


QUERIES: dict[str, Query] = {
    "staging_clean": staging_clean,
    "latest_per_key": latest_per_key_q,
    "stream_latest_per_key": stream_latest_per_key,
    "epoch_to_date": epoch_to_date,
    "staged_postings_mart": staged_postings_mart,
    "staged_postings_merge": staged_postings_merge,
    "landing_roundtrip": landing_roundtrip,
    "staging_one_key": staging_one_key,
    "maintained_marts": maintained_marts,
    "stream_merge": stream_merge,
    "stream_replay": stream_replay,
    "tags_normalised": tags_normalised,
    "tag_count_mart": tag_count_mart,
    "tag_count_join": tag_count_join,
    "ledger_rows": ledger_rows,
    "ledger_stream": ledger_stream,
    "contract_changes": contract_changes_q,
    "publish_group_roundtrip": publish_group_roundtrip,
    "status_counts": status_counts,
    "incremental_append": incremental_append,
    "publish_roundtrip": publish_roundtrip,
    "tag_popularity": tag_popularity,
    "doc_term_popularity": doc_term_popularity,
    "classify_titles": classify_titles,
    "classify_lookup": classify_lookup,
    "label_lookup": label_lookup,
    "classify_histogram": classify_histogram,
    "enriched_mart": enriched_mart,
    "incremental_new_keys": incremental_new_keys,
    "incremental_batches": incremental_batches,
    "batch_prompts": batch_prompts_q,
    "parse_answer": parse_answer,
    "incremental_union": incremental_union,
    "incremental_calls": incremental_calls,
    "payload_records": payload_records,
    "payload_split": payload_split,
    "validation_gate": validation_gate,
    "rejects": rejects_q,
    "dq_not_null": dq_not_null,
    "dq_unique_grain": dq_unique_grain,
    "dq_relationships": dq_relationships,
    "dq_accepted_values": dq_accepted_values,
    "dq_not_in_future": dq_not_in_future,
    "dq_not_empty": dq_not_empty,
    "dq_report": dq_report,
    "checks_after_append": checks_after_append,
    "freshness": freshness_q,
    "verify_publish": verify_publish,
    "reconcile_counts": reconcile_counts_q,
    "daily_counts": daily_counts,
    "status_summary": status_summary,
    "node_projection": node_projection,
    "publish_projection": publish_projection_q,
    "pii_hash": pii_hash,
}


# ================================================================ oracle SQL

# Raw-shaped postings from events, renamed and reduced to the newest version
# per key (the CTEs end in `stg`).
_STAGED_POSTINGS = f"""WITH raw AS (
              SELECT 'u' || user_id AS slug, '  ' || event_type || ' ' AS title,
                     'c' || (user_id % 7) AS company_name,
                     CASE WHEN event_id % 4 = 0 THEN '   ' ELSE 'loc' || (event_id % 3) END
                       AS location,
                     value > 25 AS remote,
                     [upper(event_type), ' ' || event_type || ' ', 'k' || (event_id % 5), '']
                       AS tags,
                     {EPOCH_BASE} + event_id * 977 AS created_at,
                     'events/part-' || (event_id % 3) AS source_file,
                     CAST(ts AS DATE) AS ingest_date, ts AS ingested_at
              FROM events),
            ren AS (
              SELECT slug AS posting_id, trim(title) AS title, trim(company_name) AS company_name,
                     NULLIF(trim(location), '') AS location, remote AS is_remote, tags,
                     TIMESTAMP '1970-01-01 00:00:00' + to_seconds(created_at) AS posted_at,
                     source_file, ingest_date, ingested_at
              FROM raw),
            stg AS (
              SELECT * FROM (
                SELECT *, row_number() OVER (PARTITION BY posting_id
                          ORDER BY ingested_at DESC, ingest_date DESC, source_file DESC) AS rn
                FROM ren) x WHERE rn = 1)"""


# What one landed event becomes in staging, whichever landing it came from.
_EVENT_STAGED = f"""'e' || event_id AS posting_id, trim(event_type) AS title,
                   CASE WHEN user_id % 4 = 0 THEN NULL ELSE 'here' END AS location,
                   value > 25 AS is_remote,
                   to_json([upper(event_type), ''])::VARCHAR AS tags,
                   TIMESTAMP '1970-01-01 00:00:00' + to_seconds({EPOCH_BASE} + event_id * 977)
                     AS posted_at"""


def _sql_text(s: str) -> str:
    """A SQL string expression equal to ``s`` (newlines via chr(10))."""
    parts = [("'" + p.replace("'", "''") + "'") for p in s.split("\n")]
    return " || chr(10) || ".join(parts)


_PART_TAGS = """
  SELECT p_partkey, p_retailprice,
         CASE WHEN p_size % 7 = 0 THEN NULL
              ELSE [upper(split_part(p_name, ' ', 1)), ' ' || split_part(p_name, ' ', 1) || ' ',
                    split_part(p_name, ' ', 2), '  '] END AS tags
  FROM part"""

_TAGS_NORMALISED = f"""
  WITH t AS ({_PART_TAGS}),
  e AS (SELECT p_partkey, unnest(tags) AS raw_tag FROM t),
  c AS (SELECT p_partkey, lower(trim(raw_tag)) AS tag FROM e WHERE trim(raw_tag) <> ''),
  d AS (SELECT p_partkey, tag, row_number() OVER (PARTITION BY p_partkey, tag) AS rn FROM c)
  SELECT p_partkey, tag FROM d WHERE rn = 1"""

_NEW_TITLES = """
  SELECT DISTINCT p.p_name AS title FROM part p
  WHERE p.p_name IS NOT NULL AND p.p_name <> ''
    AND NOT EXISTS (SELECT 1 FROM part s WHERE s.p_size < 2 AND s.p_name = p.p_name)"""

_BATCHED = f"""
  SELECT title, CAST(floor((rn - 1) / {BATCH_N}) AS BIGINT) AS batch_id,
         CAST((rn - 1) % {BATCH_N} AS BIGINT) AS pos
  FROM (SELECT title, row_number() OVER (ORDER BY title) AS rn FROM ({_NEW_TITLES}) n) r"""

_RAW = f"""
  SELECT CASE p_size % 5
    WHEN 0 THEN '{{"slug":"p-' || p_partkey || '","title":"' || p_name || '","company_name":"'
                || p_brand || '","location":null,"remote":'
                || (CASE WHEN p_partkey % 2 = 0 THEN 'true' ELSE '"yes"' END)
                || ',"tags":["' || split_part(p_name, ' ', 1) || '","' || split_part(p_name, ' ', 2)
                || '"],"created_at":' || ({EPOCH_BASE} + p_partkey) || '}}'
    WHEN 1 THEN '{{"slug":' || p_partkey || ',"title":"' || p_name || '","company_name":"'
                || p_brand || '","created_at":' || ({EPOCH_BASE} + p_partkey) || '}}'
    WHEN 2 THEN '"' || p_name || '"'
    WHEN 3 THEN '{{"slug":"p-' || p_partkey || '","company_name":"' || p_brand
                || '","remote":null,"tags":[' || p_partkey || '],"created_at":"2024-01-0'
                || (p_partkey % 9 + 1) || '"}}'
    ELSE '{{"slug":"p-' || p_partkey || '","title":' END AS raw
  FROM part"""

# The gate's rules in DuckDB JSON functions (json_type names differ from
# Spark's variant type names, the rules do not).
_GATED = r"""
  WITH r AS ({raw}),
  j AS (SELECT raw, json_valid(raw) AS ok,
               CASE WHEN json_valid(raw) THEN raw ELSE 'null' END AS js FROM r),
  f AS (
    SELECT raw, js, ok, CASE WHEN ok THEN json_type(js) END AS kind,
      json_type(js, '$.slug') AS t_slug,
      json_type(js, '$.title') AS t_title,
      json_type(js, '$.company_name') AS t_company,
      json_type(js, '$.location') AS t_location,
      json_type(js, '$.remote') AS t_remote,
      json_type(js, '$.tags') AS t_tags,
      json_type(js, '$.created_at') AS t_created
    FROM j),
  g AS (
    SELECT *,
      CASE WHEN t_remote IS NULL OR t_remote = 'BOOLEAN' THEN TRUE
           WHEN t_remote IN ('BIGINT', 'UBIGINT', 'DOUBLE')
             THEN CAST(json_extract(js, '$.remote') AS DOUBLE) IN (0, 1)
           WHEN t_remote = 'VARCHAR'
             THEN lower(json_extract_string(js, '$.remote')) IN
                  ('0', 'off', 'f', 'false', 'n', 'no', '1', 'on', 't', 'true', 'y', 'yes')
           ELSE FALSE END AS remote_ok,
      CASE WHEN t_tags = 'ARRAY'
             THEN len(list_filter(json_extract(js, '$.tags[*]'), lambda x: json_type(x) = 'VARCHAR'))
                  = json_array_length(js, '$.tags')
           ELSE FALSE END AS tags_ok,
      CASE WHEN t_created IN ('BOOLEAN', 'DOUBLE') THEN TRUE
           WHEN t_created IN ('BIGINT', 'UBIGINT')
             THEN TRY_CAST(json_extract_string(js, '$.created_at') AS HUGEINT)
                  BETWEEN -62135596800 AND 253402300799
           WHEN t_created = 'VARCHAR' THEN
             regexp_full_match(json_extract_string(js, '$.created_at'), '[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)')
             OR (regexp_full_match(json_extract_string(js, '$.created_at'),
                  '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}([Tt ][0-9]{{2}}:[0-9]{{2}}(:[0-9]{{2}}(\.[0-9]{{1,9}})?)?([Zz]|[+-][0-9]{{2}}(:?[0-9]{{2}})?)?)?')
                 AND try_strptime(substr(json_extract_string(js, '$.created_at'), 1, 10), '%Y-%m-%d') IS NOT NULL)
           ELSE FALSE END AS created_ok
    FROM f),
  reasons AS (
    SELECT raw, kind,
      CASE WHEN NOT ok THEN 'not_json'
           WHEN kind <> 'OBJECT' THEN 'not_object'
           ELSE concat_ws(',',
             CASE WHEN t_slug IS NULL THEN 'slug:missing' WHEN t_slug <> 'VARCHAR' THEN 'slug:not_string' END,
             CASE WHEN t_title IS NULL THEN 'title:missing' WHEN t_title <> 'VARCHAR' THEN 'title:not_string' END,
             CASE WHEN t_company IS NULL THEN 'company_name:missing' WHEN t_company <> 'VARCHAR' THEN 'company_name:not_string' END,
             CASE WHEN t_location IS NOT NULL AND t_location NOT IN ('NULL', 'VARCHAR') THEN 'location:not_string' END,
             CASE WHEN t_remote = 'NULL' THEN 'remote:null' WHEN NOT remote_ok THEN 'remote:not_bool' END,
             CASE WHEN t_tags = 'NULL' THEN 'tags:null' WHEN t_tags IS NOT NULL AND NOT tags_ok THEN 'tags:not_string_list' END,
             CASE WHEN t_created IS NULL THEN 'created_at:missing' WHEN t_created = 'NULL' THEN 'created_at:null'
                  WHEN NOT created_ok THEN 'created_at:invalid' END)
      END AS reasons,
      CASE WHEN kind = 'OBJECT' THEN coalesce(
             CASE WHEN t_slug = 'VARCHAR' THEN json_extract_string(js, '$.slug')
                  ELSE CAST(json_extract(js, '$.slug') AS VARCHAR) END, '<no slug>')
           WHEN kind = 'VARCHAR' THEN left('''' || json_extract_string(js, '$') || '''', 40)
           ELSE left(raw, 40) END AS identifier
    FROM g)
  SELECT identifier, reasons,
         CASE WHEN reasons = '' THEN 0 ELSE len(string_split(reasons, ',')) END AS error_count
  FROM reasons"""


def _oracle() -> dict[str, str]:
    gated = _GATED.format(raw=_RAW)
    header = _sql_text(prompt_header(PART_VOCABULARY))
    part_case = rules_sql("p_name", PART_RULES)
    title_case = rules_sql("title", PART_RULES)
    vocab = ", ".join(f"'{v}'" for v in EVENT_VOCABULARY)
    content = ("CASE WHEN event_id % 3 = 0 THEN 'Sure:' || chr(10) || '```json' || chr(10) "
               "|| '{\"0\": \" ' || upper(event_type) || ' \"}' || chr(10) || '``` ok' "
               "WHEN event_id % 3 = 1 THEN '{\"1\": \"' || event_type || '\"}' "
               "ELSE 'Result ' || props END")
    return {
        "staging_clean": """
            SELECT event_id,
                   NULLIF(TRIM(CASE WHEN user_id % 5 = 0 THEN '   '
                                    ELSE '  ' || event_type || ' ' END), '') AS label
            FROM events""",
        "latest_per_key": """
            SELECT user_id, event_id, ts, event_type FROM (
              SELECT user_id, event_id, ts, event_type,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) x WHERE rn = 1""",
        "stream_latest_per_key": """
            SELECT user_id, event_id, ts, event_type FROM (
              SELECT user_id, event_id, ts, event_type,
                     row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
              FROM events) x WHERE rn = 1""",
        "epoch_to_date": f"""
            SELECT event_id,
                   strftime(CAST(TIMESTAMP '1970-01-01 00:00:00'
                                 + to_seconds({EPOCH_BASE} + event_id * 977) AS DATE), '%Y-%m-%d')
                     AS day
            FROM events""",
        "staged_postings_mart": f"""
            {_STAGED_POSTINGS}
            SELECT posting_id, title, company_name, location, is_remote,
                   to_json(tags)::VARCHAR AS tags,
                   CAST(coalesce(len(list_distinct(list_filter(
                     list_transform(tags, lambda x: lower(trim(x))), lambda x: x <> ''))), 0)
                     AS BIGINT) AS tag_count,
                   posted_at, strftime(CAST(posted_at AS DATE), '%Y-%m-%d') AS posted_date,
                   ingested_at
            FROM stg""",
        "staged_postings_merge": f"""
            {_STAGED_POSTINGS}
            SELECT posting_id, title, company_name, location, is_remote,
                   to_json(tags)::VARCHAR AS tags, posted_at, source_file,
                   strftime(ingest_date, '%Y-%m-%d') AS ingest_date, ingested_at
            FROM stg""",
        "landing_roundtrip": f"""
            SELECT {_EVENT_STAGED},
                   CASE WHEN event_type = 'purchase' THEN 'second' ELSE 'replay' END
                     AS company_name,
                   CASE WHEN event_type = 'purchase' THEN '2026-01-02' ELSE '2026-01-01' END
                     AS ingest_date,
                   'full incremental full' AS modes
            FROM events WHERE event_type <> 'click'""",
        "staging_one_key": f"""
            SELECT {_EVENT_STAGED},
                   CASE WHEN event_id = (SELECT min(event_id) FROM events) THEN 'second' ELSE 'first'
                     END AS company_name,
                   CASE WHEN event_id = (SELECT min(event_id) FROM events) THEN '2026-01-02'
                     ELSE '2026-01-01' END AS ingest_date,
                   'incremental' AS mode, 1 AS buckets_rewritten
            FROM events""",
        "maintained_marts": f"""
            WITH last AS (
                SELECT *, CASE WHEN event_id % 7 = 0 THEN 'third' WHEN event_id % 5 = 0 THEN 'second'
                          ELSE 'first' END AS source,
                       TIMESTAMP '1970-01-01 00:00:00' + to_seconds({EPOCH_BASE} + event_id * 977) AS seen
                FROM events WHERE event_id % 7 = 0 OR event_id % 5 = 0 OR event_id % 3 <> 0),
            tags AS (
                SELECT lower(trim(event_type)) AS tag, seen FROM last
                UNION ALL SELECT source || '-' || (user_id % 97), seen FROM last)
            SELECT tag, count(*) AS postings, min(seen) AS first_seen_at, max(seen) AS last_seen_at,
                   'full maintained maintained' AS modes
            FROM tags WHERE tag <> '' GROUP BY tag""",
        "stream_replay": f"""
            SELECT {_EVENT_STAGED},
                   CASE WHEN event_type = 'purchase' THEN 'second' ELSE 'replay' END
                     AS company_name,
                   CASE WHEN event_type = 'purchase' THEN '2026-01-02' ELSE '2026-01-01' END
                     AS ingest_date,
                   '1 2 3' AS stored_tables
            FROM events WHERE event_type <> 'click'""",
        "stream_merge": f"""
            SELECT {_EVENT_STAGED},
                   CASE event_type WHEN 'signup' THEN 'second' WHEN 'purchase' THEN 'third'
                     WHEN 'click' THEN 'third' ELSE 'first' END AS company_name,
                   CASE event_type WHEN 'signup' THEN '2026-01-02' WHEN 'purchase' THEN '2026-01-03'
                     WHEN 'click' THEN '2026-01-03' ELSE '2026-01-01' END AS ingest_date,
                   '1 2 1' AS stored_tables
            FROM events WHERE event_type IS NOT NULL""",
        "tags_normalised": _TAGS_NORMALISED,
        "tag_count_mart": f"""
            WITH n AS ({_TAGS_NORMALISED}),
            c AS (SELECT p_partkey, count(*) AS tag_count FROM n GROUP BY p_partkey)
            SELECT p.p_partkey, CAST(coalesce(c.tag_count, 0) AS BIGINT) AS tag_count
            FROM part p LEFT JOIN c ON p.p_partkey = c.p_partkey""",
        "tag_count_join": f"""
            WITH n AS ({_TAGS_NORMALISED}),
            c AS (SELECT p_partkey, count(*) AS tag_count FROM n GROUP BY p_partkey)
            SELECT p.p_partkey, CAST(coalesce(c.tag_count, 0) AS BIGINT) AS tag_count
            FROM part p LEFT JOIN c ON p.p_partkey = c.p_partkey""",
        "ledger_rows": """
            SELECT 'run-' || CAST(user_id AS VARCHAR) AS invocation_id,
                   event_type || '.' || CAST(event_id AS VARCHAR) AS node,
                   event_type AS resource_type, event_type AS status,
                   CAST(coalesce(value, 0) AS DOUBLE) AS execution_time,
                   left(coalesce(props, ''), 400) AS message,
                   strftime(ts, '%Y-%m-%d') || ' 06:30:15' AS run_at FROM events""",
        "ledger_stream": """
            SELECT 'run-' || CAST(user_id AS VARCHAR) AS invocation_id,
                   event_type || '.' || CAST(event_id AS VARCHAR) AS node,
                   event_type AS resource_type, event_type AS status,
                   CAST(coalesce(value, 0) AS DOUBLE) AS execution_time,
                   left(coalesce(props, ''), 400) AS message,
                   strftime(ts, '%Y-%m-%d') || ' 06:30:15' AS run_at, true AS first_below_all,
                   (SELECT count(*) FROM events) AS second, (SELECT count(*) FROM events) AS third
            FROM events""",
        "contract_changes": """
            WITH c(path, change, old_type, new_type, breaking) AS (VALUES
                ('o_totalprice', 'retyped', 'double', 'decimal(18,2)', true),
                ('o_orderpriority', 'removed', 'string', NULL, true),
                ('o_placed', 'added', NULL, (SELECT CASE WHEN typeof(any_value(o_orderdate)) LIKE '%TIME ZONE%'
                    THEN 'timestamp' ELSE 'timestamp_ntz' END FROM orders), false),
                ('lines[].o_custkey', 'retyped', 'bigint', 'string', true),
                ('lines[].o_orderdate', 'removed', (SELECT CASE WHEN typeof(any_value(o_orderdate)) LIKE
                    '%TIME ZONE%' THEN 'timestamp' ELSE 'timestamp_ntz' END FROM orders), NULL, true),
                ('lines[].o_flag', 'added', NULL, 'string', false),
                ('state.customer', 'retyped', 'struct', 'bigint', true))
            SELECT *, CASE path WHEN 'o_totalprice' THEN (SELECT count(o_totalprice) FROM orders)
                       WHEN 'o_orderpriority' THEN (SELECT count(o_orderpriority) FROM orders)
                       WHEN 'o_placed' THEN 0 ELSE (SELECT count(*) FROM orders) END AS rows_held,
                   CAST(2 AS BIGINT) AS version FROM c""",
        "publish_group_roundtrip": """
            SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) AS first,
                   (SELECT count(*) FROM orders WHERE o_orderkey % 4 < 2) AS second,
                   (SELECT count(*) FROM orders WHERE o_orderkey % 4 < 2) AS after_failure,
                   (SELECT count(*) FROM customer) AS customers, true AS own_files
            FROM orders""",
        "status_counts": """
            SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type""",
        "incremental_append": """
            WITH k AS (SELECT DISTINCT CASE WHEN c_custkey % 11 > 0 THEN c_mktsegment || '-' ||
                              CAST(c_custkey % 977 AS VARCHAR) END AS label FROM customer),
            n AS (SELECT count(*) FILTER (WHERE label < 'F') AS a, count(*) AS b FROM k)
            SELECT label, a AS first_run, b - a AS second_run, CAST(0 AS BIGINT) AS third_run
            FROM k, n""",
        "publish_roundtrip": """
            SELECT o_orderkey, o_custkey, (SELECT count(*) FROM orders) AS published,
                   CAST(2 AS BIGINT) AS versions_kept FROM orders""",
        "tag_popularity": f"""
            WITH n AS ({_TAGS_NORMALISED})
            SELECT tag, count(*) AS postings, min(p_partkey) AS first_partkey,
                   max(p_partkey) AS last_partkey
            FROM n GROUP BY tag""",
        "doc_term_popularity": """
            WITH e AS (SELECT doc_id, unnest(string_split(text, ' ')) AS raw_term FROM documents),
            c AS (SELECT DISTINCT doc_id, lower(trim(raw_term)) AS term FROM e
                  WHERE trim(raw_term) <> '')
            SELECT term, count(*) AS docs, min(doc_id) AS first_doc, max(doc_id) AS last_doc
            FROM c GROUP BY term""",
        "classify_titles": f"SELECT p_partkey, {part_case} AS discipline FROM part",
        "classify_lookup": f"""
            WITH m AS (SELECT DISTINCT p_name AS title FROM part WHERE p_size < 40),
            l AS (SELECT title, {title_case} AS discipline FROM m)
            SELECT p.p_partkey, coalesce(l.discipline, 'other') AS discipline
            FROM part p LEFT JOIN l ON l.title = p.p_name""",
        "label_lookup": """
            SELECT d.doc_id, coalesce(l.quality, -1) AS quality
            FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""",
        "classify_histogram": f"""
            SELECT discipline, count(*) AS n FROM
              (SELECT {part_case} AS discipline FROM part) x GROUP BY discipline""",
        "enriched_mart": f"""
            WITH n AS ({_TAGS_NORMALISED}),
            c AS (SELECT p_partkey, count(*) AS tag_count FROM n GROUP BY p_partkey)
            SELECT p.p_partkey, p.p_name AS title,
                   CAST(coalesce(c.tag_count, 0) AS BIGINT) AS tag_count,
                   {part_case} AS discipline
            FROM part p LEFT JOIN c ON p.p_partkey = c.p_partkey""",
        "incremental_new_keys": _NEW_TITLES,
        "incremental_batches": _BATCHED,
        "batch_prompts": f"""
            SELECT batch_id,
                   {header} || string_agg(CAST(pos AS VARCHAR) || '. ' || title, chr(10) ORDER BY pos)
                     AS prompt
            FROM ({_BATCHED}) b GROUP BY batch_id""",
        "parse_answer": f"""
            WITH a AS (SELECT event_id, {content} AS content FROM events),
            j AS (SELECT event_id, NULLIF(regexp_extract(content, '(?s)(\\{{.*\\}})', 1), '') AS js
                  FROM a),
            v AS (SELECT event_id, lower(trim(json_extract_string(js, '$."0"'))) AS lab FROM j)
            SELECT event_id, CASE WHEN lab IN ({vocab}) THEN lab ELSE 'other' END AS label
            FROM v""",
        "incremental_calls": f"""
            WITH t AS (SELECT p_name AS title, min(p_size) < 25 AS early FROM part
                       WHERE p_name IS NOT NULL AND p_name <> '' GROUP BY p_name),
            r AS (SELECT *, row_number() OVER (PARTITION BY early ORDER BY title) AS rn FROM t),
            runs AS (SELECT title, CASE WHEN early AND rn > {BATCH_N} THEN 1 ELSE 2 END AS run, early FROM r)
            SELECT title, {title_case} AS discipline, run,
                   (SELECT ceil(count(*) FILTER (early) / {BATCH_N}) + ceil(count(*) FILTER (run = 2) / {BATCH_N})
                    FROM runs)::BIGINT AS calls
            FROM runs""",
        "incremental_union": f"""
            SELECT title, {title_case} AS discipline FROM
              (SELECT DISTINCT p_name AS title FROM part WHERE p_size < 2) s
            UNION ALL
            SELECT title, {title_case} AS discipline FROM ({_NEW_TITLES}) n""",
        "payload_split": f"""
            WITH t AS (
                SELECT conv_id // {CONVERSATIONS_PER_FILE} AS file, conv_id, turn,
                       '{{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":'
                       || coalesce('"' || role || '"', 'null') || ',"in":{{"n":["}}"]}}}}' AS raw FROM conversations)
            SELECT file, (row_number() OVER (PARTITION BY file ORDER BY conv_id, turn))::INTEGER AS position, raw FROM t
            UNION ALL SELECT DISTINCT file, 0, 'null' FROM t""",
        "payload_records": """
            WITH p AS (
              SELECT conv_id, turn,
                     '{"conv_id":' || conv_id || ',"turn":' || turn || ',"role":'
                       || coalesce('"' || role || '"', 'null') || '}' AS obj
              FROM conversations),
            w AS (
              SELECT conv_id, turn,
                     CASE WHEN conv_id % 2 = 0
                          THEN '{"data":[' || obj || ',"t' || turn || '",' || turn || ',null]}'
                          ELSE '[' || obj || ']' END AS payload
              FROM p),
            l AS (
              SELECT conv_id, turn,
                     CASE WHEN json_type(payload) = 'ARRAY' THEN json_extract(payload, '$[*]')
                          ELSE json_extract(payload, '$.data[*]') END AS els
              FROM w)
            SELECT conv_id, turn, CAST(unnest(range(len(els))) AS INTEGER) AS position,
                   CAST(unnest(els) AS VARCHAR) AS raw
            FROM l""",
        "validation_gate": f"""
            SELECT count(*) FILTER (WHERE reasons = '') AS accepted,
                   count(*) FILTER (WHERE reasons <> '') AS rejected
            FROM ({gated}) g""",
        "rejects": f"""
            SELECT identifier, CAST(error_count AS INTEGER) AS error_count, reasons
            FROM ({gated}) g WHERE reasons <> ''""",
        "dq_not_null": """
            SELECT 'p_type' AS column_name,
                   count(*) FILTER (WHERE NULLIF(p_type, 'ECONOMY') IS NULL) AS failures FROM part
            UNION ALL
            SELECT 'p_name', count(*) FILTER (WHERE p_name IS NULL) FROM part""",
        "dq_unique_grain": """
            SELECT l_orderkey, l_linenumber, count(*) AS rows_found FROM lineitem
            GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
        "dq_relationships": """
            SELECT o_orderkey, count(*) AS rows_found FROM orders o
            WHERE o_orderkey IS NOT NULL
              AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
            GROUP BY o_orderkey""",
        "dq_accepted_values": f"""
            SELECT event_type, count(*) AS n FROM events
            WHERE event_type IS NOT NULL AND event_type NOT IN ({vocab})
            GROUP BY event_type""",
        "dq_not_in_future": """
            SELECT event_id FROM events
            WHERE ts > TIMESTAMP '2024-01-29 00:00:00' + INTERVAL 1 DAY""",
        "dq_not_empty": """
            SELECT 1 AS problem FROM
              (SELECT count(*) AS n FROM lineitem WHERE l_orderkey NOT IN
                 (SELECT o_orderkey FROM orders)) c
            WHERE c.n = 0""",
        "checks_after_append": """
            WITH o AS (SELECT * FROM orders UNION ALL
                       SELECT * REPLACE (NULL AS o_orderpriority) FROM orders
                       WHERE o_orderkey = (SELECT min(o_orderkey) FROM orders)),
            c AS (
                SELECT 'not_null_orders_o_orderkey' AS check_name, count(*) FILTER (o_orderkey IS NULL) AS failures FROM o
                UNION ALL SELECT 'not_null_orders_o_custkey', count(*) FILTER (o_custkey IS NULL) FROM o
                UNION ALL SELECT 'not_null_orders_o_orderstatus', count(*) FILTER (o_orderstatus IS NULL) FROM o
                UNION ALL SELECT 'not_null_orders_o_totalprice', count(*) FILTER (o_totalprice IS NULL) FROM o
                UNION ALL SELECT 'not_null_orders_o_orderdate', count(*) FILTER (o_orderdate IS NULL) FROM o
                UNION ALL SELECT 'not_null_orders_o_orderpriority', count(*) FILTER (o_orderpriority IS NULL) FROM o
                UNION ALL SELECT 'unique_orders_o_orderkey', count(*) FROM
                    (SELECT o_orderkey FROM o WHERE o_orderkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
                UNION ALL SELECT 'relationships_orders_o_orderkey', count(*) FROM o
                    WHERE o_orderkey IS NOT NULL AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
                UNION ALL SELECT 'not_empty_orders', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM o)
            SELECT check_name, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status, failures,
                   1 AS buckets_read, (SELECT count(*) FROM o) AS rows,
                   (SELECT count(DISTINCT o_orderkey) FROM o) AS ids,
                   (SELECT count(DISTINCT CAST(o_orderdate AS DATE)) FROM o) AS days_covered,
                   false AS dedup_held, true AS estimate_in_bounds
            FROM c""",
        "dq_report": f"""
            WITH checks AS (
              SELECT 'not_null_part_p_name' AS check_name,
                     count(*) FILTER (WHERE p_name IS NULL) AS failures FROM part
              UNION ALL SELECT 'not_null_part_p_type', count(*) FILTER (WHERE p_type IS NULL) FROM part
              UNION ALL SELECT 'unique_orders_o_orderkey', count(*) FROM
                (SELECT o_orderkey FROM orders WHERE o_orderkey IS NOT NULL
                 GROUP BY o_orderkey HAVING count(*) > 1) u
              UNION ALL SELECT 'grain_lineitem', count(*) FROM
                (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) g
              UNION ALL SELECT 'relationships_lineitem_l_orderkey', count(*) FROM lineitem l
                WHERE l.l_orderkey IS NOT NULL
                  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
              UNION ALL SELECT 'relationships_orders_o_orderkey', count(*) FROM orders o
                WHERE o.o_orderkey IS NOT NULL
                  AND NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
              UNION ALL SELECT 'accepted_values_events_event_type', count(*) FROM events
                WHERE event_type IS NOT NULL AND event_type NOT IN ({vocab})
              UNION ALL SELECT 'not_in_future_events', count(*) FROM events
                WHERE ts > TIMESTAMP '2024-01-29 00:00:00' + INTERVAL 1 DAY
              UNION ALL SELECT 'not_empty_events', count(*) FROM
                (SELECT count(*) AS n FROM events) c WHERE c.n = 0)
            SELECT check_name, CAST(failures AS BIGINT) AS failures,
                   CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS status
            FROM checks""",
        "freshness": """
            SELECT max(ts) AS last_ingested, count(*) AS row_count,
                   count(DISTINCT CAST(ts AS DATE)) AS days_covered
            FROM events""",
        "verify_publish": """
            SELECT count(*) AS rows, count(DISTINCT o_orderkey) AS ids,
                   max(o_orderdate) AS latest, count(*) = count(DISTINCT o_orderkey) AS dedup_held
            FROM orders""",
        "reconcile_counts": """
            SELECT l_orderkey, CAST(max(l_linenumber) AS BIGINT) AS expected, count(*) AS actual
            FROM lineitem GROUP BY l_orderkey
            HAVING CAST(max(l_linenumber) AS BIGINT) IS DISTINCT FROM count(*)""",
        "daily_counts": """
            SELECT strftime(CAST(ts AS DATE), '%Y-%m-%d') AS day, count(*) AS n
            FROM events GROUP BY CAST(ts AS DATE)""",
        "status_summary": """
            SELECT split_part(event_type || '.' || CAST(user_id AS VARCHAR), '.', 1) AS resource_type,
                   count(*) AS n
            FROM events GROUP BY 1""",
        "node_projection": """
            SELECT event_id, event_type || '.' || CAST(user_id AS VARCHAR) AS node,
                   split_part(event_type || '.' || CAST(user_id AS VARCHAR), '.', 1) AS resource_type,
                   coalesce(value, 0.0) AS execution_time,
                   left(coalesce(props, ''), 400) AS message
            FROM events""",
        "publish_projection": f"""
            SELECT p_partkey, p_retailprice, to_json(tags)::VARCHAR AS tags_json
            FROM ({_PART_TAGS}) t""",
        "pii_hash": "SELECT c_custkey, sha256(c_name) AS name_hash FROM customer",
    }


SQL: dict[str, str] = _oracle()
