"""A corpus pipeline over ``documents``: rules, near copies, leaks, personal data, pieces.

``STAGES`` holds ``(name, function)``; each function takes ``(spark, docs, sf_dir)``
and returns a DataFrame. All but the last return the columns of ``documents``; the
last returns the encoded documents. ``run`` writes each stage's rows as Parquet in
the shared folder and reads them back as the next stage's documents.

Rows without an id, empty texts and repeated rows pass through each stage as its
operator's docstring says; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, jaccard_join, piece_codec, pii, quality_rules
from quarry.llm._columns import table
from quarry.llm._scratch import Scratch
from quarry.llm.queries import configure, model_path, trusted

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The near-copy stage takes the general rule; the query op10_ has its own contract (4, 85).
NEAR_WORDS = 5
NEAR_PERCENT = 80


def packed(docs: DataFrame) -> DataFrame:
    """``(doc_id, text, row)``: what operators read, and the whole row as one value, so that no
    column's name can meet one that an operator puts beside it."""
    return docs.select("doc_id", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that pass the quality rules (operator 8)."""
    kept = quality_rules.keep_good(packed(docs), trusted(configure(spark), sf_dir))
    return kept.select("row.*")


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of every group of near copies (operator 10): the one of smallest id.

    Near copies share 80 percent of their distinct runs of five words. Rows are judged each
    by their own text, whether their id is repeated or NULL; texts without words stay.
    """
    configure(spark)
    with Scratch(spark, "near-copies") as scratch:
        return scratch.keep(jaccard_join.keep_one(docs, scratch, words=NEAR_WORDS, percent=NEAR_PERCENT))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents that hold no benchmark passage (operator 2)."""
    found = decontaminate.find_contamination(
        packed(docs), table(configure(spark), sf_dir, "benchmark"), keep_cols=("row",))
    return found.filter("not contaminated").select("row.*")


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind (operator 7); ``n_chars`` follows the text."""
    configure(spark)
    with Scratch(spark, "redacted") as scratch:
        found = scratch.keep(pii.find_personal_data(docs, scratch))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    cleaned = pii.redact_documents(packed(docs), found)
    return cleaned.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document (operator 4): doc_id, ids, n_tokens, round_trip."""
    configure(spark)
    return piece_codec.encode(docs, model_path())


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", decontaminated),
    ("personal data", redacted),
    ("sentencepiece", encoded),
]

# Hashed likelihood ratios, contextual extraction and Viterbi pieces are beyond SQL;
# tests/llm compares run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; the last one's rows are the result."""
    docs = table(spark, sf_dir, "documents")
    with Scratch(spark, "pipeline") as scratch:
        for _, stage in STAGES[:-1]:
            docs = scratch.save(stage(spark, docs, sf_dir))
        return scratch.keep(STAGES[-1][1](spark, docs, sf_dir))
