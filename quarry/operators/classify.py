"""Ordered whole-word keyword rules (P13, P14, U1) as one native expression.

Each label has a keyword list. The first label, in declared order, with any
keyword found as a whole word in the case-folded text wins; otherwise the
fallback. NULL or empty text gets the fallback. The whole rule set compiles to
a chained ``CASE WHEN rlike(...)`` that runs inside whole-stage codegen on every
row: no distinct-title collect, no driver-side mapping, no join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import as_col
from ..functions.text import whole_word_pattern

# These must equal the reference's rules for equal results.
# Order is meaning: mobile is tried before frontend so "React Native" is mobile.
DISCIPLINES: dict[str, tuple[str, ...]] = {
    "data": ("data engineer", "data scientist", "analytics", "machine learning", "bi"),
    "mobile": ("android", "ios", "flutter", "react native", "mobile"),
    "backend": ("backend", "back-end", "java", "python developer", "golang", "api", "apis"),
    "frontend": ("frontend", "front-end", "react", "vue", "javascript", "ui"),
    "devops": ("devops", "sre", "platform engineer", "kubernetes", "cloud engineer"),
}
UNCLASSIFIED = "other"


def label_expr(text, rules: Mapping[str, Sequence[str]] = DISCIPLINES,
               fallback: str = UNCLASSIFIED) -> Column:
    """First-match label of ``text`` under ordered ``rules``."""
    if fallback in rules:
        raise ValueError(f"fallback {fallback!r} must not be a rule label")
    haystack = F.lower(as_col(text))
    expr = None
    for label, keywords in rules.items():
        if not keywords:
            continue
        hit = haystack.rlike(whole_word_pattern(keywords))
        expr = F.when(hit, F.lit(label)) if expr is None else expr.when(hit, F.lit(label))
    if expr is None:
        return F.lit(fallback)
    # NULL text makes rlike NULL, which no WHEN takes: it falls through to the fallback.
    return expr.otherwise(F.lit(fallback))


def classify(df: DataFrame, text_col: str, out_col: str = "discipline",
             rules: Mapping[str, Sequence[str]] = DISCIPLINES,
             fallback: str = UNCLASSIFIED) -> DataFrame:
    """Add ``out_col`` with the first-match label of ``text_col``."""
    return df.withColumn(out_col, label_expr(text_col, rules, fallback))


def rules_sql(text_sql: str, rules: Mapping[str, Sequence[str]] = DISCIPLINES,
              fallback: str = UNCLASSIFIED) -> str:
    """The same rule set as an ANSI ``CASE`` using ``regexp_matches`` (oracle SQL).

    RE2's ``\\b`` is ASCII-only, so this twin agrees with ``label_expr`` on
    ASCII text only.
    """
    arms = []
    for label, keywords in rules.items():
        pattern = whole_word_pattern(keywords, unicode=False).replace("'", "''")
        arms.append(f"WHEN regexp_matches(lower({text_sql}), '{pattern}') THEN '{label}'")
    return "CASE " + " ".join(arms) + f" ELSE '{fallback}' END"
