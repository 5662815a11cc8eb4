"""Batched labelling of keys by a pluggable function.

The costly function (a hosted model in the reference) sees a *batch* of keys
per call, as one prompt, and answers with text holding a JSON object from
batch position to label. Shape of the work:

1. ``global_rank``: a 1-based position for every key in key order, computed
   distributively (range partition, per-partition index, prefix sum over the
   per-partition sizes). No single-partition window, no collect.
2. ``assign_batches``: ``batch_id = (rank - 1) div N``, ``pos = (rank - 1) mod N``,
   so n keys make exactly ceil(n / N) batches of at most N.
3. ``batch_prompts``: one row per batch holding its keys (ordered by ``pos``)
   and the prompt text; a batch is at most N keys, so no group is unbounded.
4. ``call_batches``: ``mapInPandas`` calls the function once per batch row.
5. ``parse_answers``: JVM-side JSON extraction and vocabulary clamp; a batch
   whose answer holds no JSON object fails the job.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.answers import answer_map, clamp_label
from ..session import checkpoint_dir
from .classify import DISCIPLINES, UNCLASSIFIED

# The closed vocabulary of the batched labeller (no `mobile`).
BATCH_VOCABULARY: tuple[str, ...] = ("backend", "frontend", "data", "devops", "other")
BATCH_SIZE = 200

_ID_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def global_rank(df: DataFrame, order_col: str, rank_col: str = "rn",
                partitions: int | None = None, stable: bool = True) -> DataFrame:
    """Add ``rank_col``: the 1-based position of each row in ``order_col`` order.

    ``order_col`` must be unique (ranks of equal values are arbitrary). The
    rows are range-partitioned and sorted inside each partition; the per-row
    index inside a partition comes from ``monotonically_increasing_id``; the
    partition offsets are a running sum over one row per partition (bounded by
    the partition count, so that side is broadcast safely).

    The indexed rows feed two branches (partition sizes, and the rows
    themselves). ``stable=True`` (default) checkpoints them once into the
    session's shared checkpoint folder, so both branches read the same
    partitions: recomputing the range exchange would draw new boundary
    samples, and the sizes would then not describe the rows being numbered.
    It also cuts the lineage, so a lost executor does not renumber anything.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    mid = "__mid"
    indexed = (df.repartitionByRange(n, F.col(order_col).asc_nulls_first())
               .sortWithinPartitions(F.col(order_col).asc_nulls_first())
               .withColumn(mid, F.monotonically_increasing_id()))
    if stable:
        checkpoint_dir(spark)
        indexed = indexed.checkpoint(eager=True)
    part = F.shiftright(F.col(mid), _ID_BITS)
    local = F.col(mid).bitwiseAND(F.lit((1 << _ID_BITS) - 1))
    sizes = indexed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    ranked = indexed.withColumn("__part", part).join(F.broadcast(offsets), on="__part")
    return (ranked.withColumn(rank_col, (F.col("__off") + local + 1).cast("bigint"))
            .drop(mid, "__part", "__off"))


def assign_batches(ranked: DataFrame, batch_size: int = BATCH_SIZE, rank_col: str = "rn",
                   batch_col: str = "batch_id", pos_col: str = "pos") -> DataFrame:
    """``batch_id = (rank-1) div N`` and ``pos = (rank-1) mod N``."""
    zero_based = F.col(rank_col) - 1
    return (ranked.withColumn(batch_col, F.floor(zero_based / F.lit(batch_size)).cast("bigint"))
            .withColumn(pos_col, F.pmod(zero_based, F.lit(batch_size)).cast("bigint")))


def prompt_header(vocabulary: Sequence[str] = BATCH_VOCABULARY) -> str:
    """The instruction block placed before the numbered keys of a batch.

    It is derived from the vocabulary; a caller with other needs passes a header
    of its own to ``batch_prompts``.
    """
    form = json.dumps({str(i): label for i, label in enumerate(vocabulary[:2])})
    return (f"CATEGORIES: {' | '.join(vocabulary)}\n"
            f"OUTPUT: line number to category, as JSON like {form}\n"
            "LINES:\n")


def batch_prompts(batched: DataFrame, key_col: str = "title", batch_col: str = "batch_id",
                  pos_col: str = "pos",
                  vocabulary: Sequence[str] = BATCH_VOCABULARY,
                  header: str | None = None) -> DataFrame:
    """One row per batch: ``(batch_id, keys, prompt)``.

    ``keys`` is ordered by ``pos``; the prompt lists them as ``"{pos}. {key}"``
    lines under the header.
    """
    entries = F.array_sort(F.collect_list(F.struct(F.col(pos_col).alias("p"),
                                                   F.col(key_col).alias("k"))))
    grouped = batched.groupBy(batch_col).agg(entries.alias("__entries"))
    lines = F.transform("__entries", lambda e: F.concat(e["p"].cast("string"), F.lit(". "), e["k"]))
    return grouped.select(
        batch_col,
        F.transform("__entries", lambda e: e["k"]).alias("keys"),
        F.concat(F.lit(prompt_header(vocabulary) if header is None else header),
                 F.concat_ws("\n", lines)).alias("prompt"),
    )


def call_batches(prompts: DataFrame, call: Callable[[str], str],
                 batch_col: str = "batch_id", concurrency: int | None = None) -> DataFrame:
    """Run ``call(prompt) -> text`` once per batch row, in the Python workers.

    The batches are dealt by range of their number over ``concurrency`` tasks
    (default: the session's default parallelism), so that many calls run at a
    time: prompts are tiny, and a shuffle sized by bytes would put all of them
    into one task.
    """
    tasks = concurrency or prompts.sparkSession.sparkContext.defaultParallelism

    def run(frames):
        for frame in frames:
            answers = [call(p) for p in frame["prompt"]]
            yield pd.DataFrame({batch_col: frame[batch_col], "keys": frame["keys"],
                                "answer": pd.Series(answers, dtype="object")})

    schema = f"{batch_col} bigint, keys array<string>, answer string"
    dealt = prompts.select(batch_col, "keys", "prompt").repartitionByRange(tasks, batch_col)
    return dealt.mapInPandas(run, schema)


def parse_answers(answers: DataFrame, key_col: str = "title", label_col: str = "discipline",
                  vocabulary: Sequence[str] = BATCH_VOCABULARY,
                  fallback: str = "other") -> DataFrame:
    """``(key, label)`` per key of every batch.

    An answer with no JSON object raises (the whole run fails, as a batch of
    silent fallbacks would be worse).
    """
    parsed = answers.withColumn("__m", answer_map("answer"))
    checked = parsed.withColumn(
        "__m",
        F.when(F.col("__m").isNull(),
               F.raise_error(F.concat(F.lit("no JSON object in the answer: "),
                                      F.substring(F.coalesce("answer", F.lit("")), 1, 120))))
        .otherwise(F.col("__m")),
    )
    exploded = checked.select("__m", F.posexplode("keys").alias("__pos", key_col))
    return exploded.select(key_col, clamp_label(F.col("__m"), F.col("__pos"), vocabulary,
                                                fallback).alias(label_col))


def rules_answerer(rules: Mapping[str, Sequence[str]] = DISCIPLINES,
                   vocabulary: Sequence[str] = BATCH_VOCABULARY,
                   fallback: str = UNCLASSIFIED) -> Callable[[str], str]:
    """An offline, deterministic stand-in for a hosted model.

    Reads the ``"{i}. {title}"`` lines of a prompt and answers with the first
    matching rule label (labels outside ``vocabulary`` are answered as-is and
    clamped later, exactly like a model inventing a category).
    """
    compiled = [(label, re.compile(r"\b(?:" + "|".join(re.escape(k) for k in kws) + r")\b"))
                for label, kws in rules.items()]
    line = re.compile(r"^(\d+)\. (.*)$")

    def answer(prompt: str) -> str:
        out = {}
        for text in prompt.split("\n"):
            m = line.match(text)
            if not m:
                continue
            title = m.group(2).lower()
            out[m.group(1)] = next((lab for lab, rx in compiled if rx.search(title)), fallback)
        return "```json\n" + json.dumps(out) + "\n```"

    return answer
