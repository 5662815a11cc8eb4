"""Quality rules (operator 8, native): n-gram likelihood ratio behind base rules.

Base: a text fails with fewer than ``MIN_WORDS`` words, or if over half of its
words stand in 3-word windows that occur twice or more in it.

Method: unigrams and bigrams are hashed into ``BUCKETS`` buckets. Two multinomials
over the buckets are counted over all documents: the raw corpus, and the trusted
target (the documents named by ``trusted``). A text's score is the sum of
``ln(p_target / p_raw)`` over its n-grams divided by their number; every document
with a score under ``MIN_SCORE`` is rejected, the same way each time.

The only thing that leaves the distributed counts is the table of ``BUCKETS``
ratios, whose size is fixed whatever the corpus. Texts are
not shuffled: word windows, lines and n-grams are arrays inside one row.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ._columns import fixed_table, indices, let, whole_text, word_array

BUCKETS = 1 << 14
SMOOTHING = 1.0
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_SCORE = -0.06
WORD_BYTE = r"[^\x20\x09-\x0D]"


def repeated_words(words: Column) -> Column:
    """Words inside 3-word windows that occur at least twice among ``words``."""
    windows = F.transform(indices(F.size(words) - 2), lambda i: F.xxhash64(
        F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)))

    def positions(hashes: Column) -> Column:
        ordered = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return let(ordered, lambda s: F.filter(
            s, lambda e, k: F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))))

    return let(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            F.size(F.array_distinct(F.flatten(F.transform(
                positions(h), lambda e: F.sequence(e["i"], e["i"] + 2)))))))


def gram_buckets(words: Column, buckets: int = BUCKETS) -> Column:
    """Bucket of every unigram, then of every bigram."""
    return F.concat(
        F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(buckets)).cast("int")),
        F.transform(indices(F.size(words) - 1), lambda i: F.pmod(
            F.xxhash64(F.get(words, i), F.get(words, i + 1)), F.lit(buckets)).cast("int")))


def bucket_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", buckets: int = BUCKETS,
                  smoothing: float = SMOOTHING) -> list[float]:
    """``ln(p_target / p_raw)`` of each of the ``buckets`` buckets.

    Both multinomials are counted in one pass and smoothed by adding ``smoothing``
    to every bucket. Without any trusted document every ratio is 0.
    """
    ids = bounded_broadcast(trusted.select(F.col(f"`{id_col}`").alias("__id"))
                            .dropna().distinct())
    flagged = (docs.select(F.col(f"`{id_col}`").alias("__id"),
                           whole_text(text_col).alias("__text"))
               .join(ids.withColumn("__target", F.lit(1)), "__id", "left"))
    grams = flagged.select("__target", F.explode(
        let(word_array(F.col("__text")), lambda w: gram_buckets(w, buckets))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count(F.lit(1)).alias("raw"),
                                         F.count("__target").alias("target"))
    raw, target = [0] * buckets, [0] * buckets
    for bucket, n, m in counts.toLocalIterator():
        raw[bucket], target[bucket] = n, m
    if not sum(target):
        return [0.0] * buckets
    size = [sum(x) + smoothing * buckets for x in (raw, target)]
    return [log((m + smoothing) / size[1]) - log((n + smoothing) / size[0])
            for n, m in zip(raw, target)]


def verdicts(docs: DataFrame, ratios: list[float], text_col: str = "text",
             min_score: float = MIN_SCORE, buckets: int = BUCKETS) -> DataFrame:
    """``docs`` with one more column, the struct ``__verdict`` of all measures.

    NULL texts count as empty (no words, base failed); a text without n-grams
    scores 0. Every row and every other column stays as it is.
    """
    model = fixed_table(ratios)
    text = whole_text(text_col)
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD_BYTE))

    def measures(words: Column) -> Column:
        grams = gram_buckets(words, buckets)
        score = let(grams, lambda g: F.when(F.size(g) == 0, F.lit(0.0)).otherwise(
            F.aggregate(g, F.lit(0.0), lambda total, b: total + F.get(model, b)) / F.size(g)))
        return F.struct(
            F.size(words).cast("bigint").alias("n_words"),
            F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("bigint")
            .alias("word_chars"),
            F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("bigint").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")
            .alias("n_dup_lines"),
            repeated_words(words).cast("bigint").alias("n_repeat_words"), score.alias("score"))

    def judged(m: Column) -> Column:
        failed = ((m["n_words"] < MIN_WORDS)
                  | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"]))
        return F.struct(*[m[c].alias(c) for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
            failed.alias("base_failed"), (~failed & (m["score"] >= min_score)).alias("kept"),
            m["score"].alias("score"))

    # Through one Generate, so that a later filter on the verdict does not repeat the work.
    found = F.explode(F.array(let(let(word_array(text), measures), judged)))
    return docs.select("*", found.alias("__verdict"))


def quality_rules(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """One row per document: ``id``, the counts, ``base_failed``, ``kept`` and ``score``.

    The two multinomials are counted over all of ``docs``. NULL ids and repeated
    rows keep a row each; an empty table gives none; other columns are ignored.
    """
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").alias("__text"))
    ratios = bucket_ratios(docs, trusted, id_col, text_col)
    return (verdicts(rows, ratios, "__text", min_score)
            .select(F.col("__id").alias(id_col), "__verdict.*"))


def keep_good(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their columns unchanged."""
    ratios = bucket_ratios(docs, trusted, id_col, text_col)
    return (verdicts(docs, ratios, text_col, min_score)
            .filter("__verdict.kept").drop("__verdict"))
