"""Incremental batched labelling of titles.

Only titles not yet in the target table reach the labeller; they are ranked, cut into
batches of ``batch_size`` and sent one prompt per batch. A call is costly, so:

* answers are kept *per title* (``{target}__answers``). Whatever batch a title falls
  into tomorrow, it is never asked for again once it was answered;
* answers are appended in waves, so a failed run loses one wave of calls at most; a
  wave holds several batches per task and there are at most ``MAX_WAVES`` of them,
  or as many as the quota demands;
* titles that were answered are labelled first. Only then does the run fail for
  batches left without a JSON object, or stop because the quota is spent; the next
  run asks for the titles that are left, in new batches;
* calls are reserved in ``{target}__calls`` before they are made, so that no crash or
  second run exceeds the allowance of a day or a minute.
"""

from __future__ import annotations

import datetime as dt
import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.answers import answer_map
from ..operators.batching import (BATCH_SIZE, BATCH_VOCABULARY, assign_batches, batch_prompts,
                                  call_batches, global_rank, parse_answers, rules_answerer)
from ..session import checkpoint_dir
from ..sinks.materialize import append_unseen, ensure_table, new_keys

log = logging.getLogger(__name__)

LABEL_DDL = "title string, discipline string"
CALL_DDL = "called_at timestamp, calls bigint"
BATCHES_PER_TASK = 4  # of a wave, at least
MAX_WAVES = 16


class BatchesUnanswered(RuntimeError):
    """Some titles got no usable answer; the others are labelled."""


class QuotaSpent(RuntimeError):
    """The allowance is spent; what was answered is labelled, the rest waits."""


@dataclass(frozen=True)
class Quota:
    """Calls allowed per UTC day and in any minute (None: no limit)."""

    per_day: int | None = None
    per_minute: int | None = None

    def allowed(self, spark: SparkSession, calls: str, now: dt.datetime) -> tuple[int | None, float]:
        """Calls that may be made at ``now``, and the seconds until a minute's calls are free
        again if it is the minute that allows none. The table of calls is the bucket: what
        it does not hold may be spent, so all runs share one allowance."""
        day = now.replace(hour=0, minute=0, second=0, microsecond=0)
        minute = now - dt.timedelta(seconds=60)
        at = F.col("called_at")
        spent = spark.table(calls).filter(at >= F.lit(min(day, minute))).agg(
            F.sum(F.when(at >= F.lit(day), F.col("calls"))).alias("day"),
            F.sum(F.when(at > F.lit(minute), F.col("calls"))).alias("minute"),
            F.min(F.when(at > F.lit(minute), F.unix_micros(at))).alias("oldest")).first()
        left, wait = None, 0.0
        if self.per_minute is not None:
            left = max(0, self.per_minute - (spent["minute"] or 0))
            if left == 0:
                wait = 60 - (now.timestamp() - spent["oldest"] / 1e6)
        if self.per_day is not None:
            today = max(0, self.per_day - (spent["day"] or 0))
            left = today if left is None else min(left, today)
            wait = 0.0 if today == 0 else wait
        return left, max(wait, 0.0)


def _reserve(spark: SparkSession, calls: str, n: int, now: dt.datetime) -> None:
    spark.createDataFrame([(now, n)], CALL_DDL).coalesce(1).write.mode("append").format(
        "parquet").saveAsTable(calls)


def ask(spark: SparkSession, titles: DataFrame, call: Callable[[str], str], store: str,
        batch_size: int = BATCH_SIZE, vocabulary: Sequence[str] = BATCH_VOCABULARY,
        concurrency: int | None = None, header: str | None = None, quota: Quota = Quota(),
        calls: str | None = None, clock: Callable[[], dt.datetime] | None = None,
        sleep: Callable[[float], None] = time.sleep) -> bool:
    """Ask for every title of ``titles`` once and keep the answers; False if the day's
    allowance ends before the last batch."""
    clock = clock or (lambda: dt.datetime.now(tz=dt.UTC))
    calls = calls or f"{store}__calls"
    ensure_table(spark, store, LABEL_DDL)
    ensure_table(spark, calls, CALL_DDL)
    checkpoint_dir(spark)
    ranked = assign_batches(global_rank(titles, "title"), batch_size)
    prompts = batch_prompts(ranked, "title", vocabulary=vocabulary, header=header).checkpoint(eager=True)
    tasks = concurrency or spark.sparkContext.defaultParallelism
    n = prompts.count()
    wave, low = max(tasks * BATCHES_PER_TASK, -(-n // MAX_WAVES)), 0
    while low < n:
        allowed, wait = quota.allowed(spark, calls, clock())
        if allowed == 0 and not wait:
            return False
        if allowed == 0:
            sleep(wait)
            continue
        size = min(wave, n - low, wave if allowed is None else allowed)
        _reserve(spark, calls, size, clock())
        asked = prompts.filter(F.col("batch_id").between(low, low + size - 1))
        answers = call_batches(asked, call, concurrency=tasks).filter(answer_map("answer").isNotNull())
        (parse_answers(answers, "title", "discipline", vocabulary)
         .write.mode("append").format("parquet").saveAsTable(store))
        low += size
    return True


def label_titles(spark: SparkSession, postings: DataFrame, target: str,
                 call: Callable[[str], str] | None = None, batch_size: int = BATCH_SIZE,
                 vocabulary: Sequence[str] = BATCH_VOCABULARY, concurrency: int | None = None,
                 header: str | None = None, quota: Quota = Quota(),
                 clock: Callable[[], dt.datetime] | None = None,
                 sleep: Callable[[float], None] = time.sleep) -> int:
    """Label the unseen titles of ``postings`` into table ``target``; return how many.

    Answers are kept in ``{target}__answers``, calls in ``{target}__calls``. Raises
    ``BatchesUnanswered`` or ``QuotaSpent`` after labelling what was answered.
    """
    call = call or rules_answerer(vocabulary=vocabulary)
    store, calls = f"{target}__answers", f"{target}__calls"
    ensure_table(spark, target, LABEL_DDL)
    ensure_table(spark, store, LABEL_DDL)
    checkpoint_dir(spark)
    unseen = new_keys(postings.select("title"), "title", spark, target).checkpoint(eager=True)

    def waiting() -> DataFrame:
        return unseen.join(spark.table(store).select("title"), "title", "left_anti")

    finished = ask(spark, waiting(), call, store, batch_size, vocabulary, concurrency, header,
                   quota, calls, clock, sleep)
    answered = spark.table(store).join(unseen, "title", "left_semi")
    labelled = append_unseen(spark, answered, target, "title")
    left = waiting().agg(F.count(F.lit(1)).alias("n")).first()["n"]
    if left and not finished:
        raise QuotaSpent(f"{labelled} titles labelled, {left} wait for the next allowance")
    if left:
        raise BatchesUnanswered(f"{labelled} titles labelled, {left} have no answer with a JSON object")
    return labelled


def batch_count(spark: SparkSession, postings: DataFrame, target: str,
                batch_size: int = BATCH_SIZE) -> int:
    """How many labeller calls the next run would make (ceil(titles without an answer / N))."""
    todo = new_keys(postings.select("title"), "title", spark, target)
    if spark.catalog.tableExists(f"{target}__answers"):
        todo = todo.join(spark.table(f"{target}__answers").select("title"), "title", "left_anti")
    n = todo.agg(F.count(F.lit(1)).alias("n")).first()["n"]
    return -(-int(n) // batch_size)
