"""String expressions (P1-P3, P7, P8, P12, P17). All JVM-side, codegen-able."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def trim_spaces(c) -> Column:
    """SQL ``trim``: strips spaces only, not tabs or newlines."""
    return F.trim(as_col(c))


def blank_to_null(c) -> Column:
    """``nullif(trim(c), '')``: a blank string becomes NULL."""
    trimmed = F.trim(as_col(c))
    return F.when(trimmed == F.lit(""), F.lit(None).cast("string")).otherwise(trimmed)


def normalise(c) -> Column:
    """``lower(trim(c))`` so that ``Python``, `` python`` merge."""
    return F.lower(F.trim(as_col(c)))


def is_not_blank(c) -> Column:
    """``trim(c) <> ''``: false for blanks, NULL (so filtered out) for NULL."""
    return F.trim(as_col(c)) != F.lit("")


def clean_array(c) -> Column:
    """Normalised, non-blank, distinct elements of a string array, in first-seen order.

    The in-row twin of explode -> P7 -> P8 -> W2 for one key: the fan-out and
    the per-key count are both built on it, so they cannot disagree. A NULL
    array stays NULL.
    """
    arr = as_col(c)
    normalised = F.transform(arr, lambda x: F.lower(F.trim(x)))
    kept = F.filter(normalised, lambda x: F.coalesce(x != F.lit(""), F.lit(False)))
    return F.array_distinct(kept)


def first_segment(c, sep: str = ".") -> Column:
    """``node.split('.')[0]`` (P12): the text before the first separator."""
    return F.substring_index(as_col(c), sep, 1)


def clip(c, n: int) -> Column:
    """``s[:n]`` (P12): the first ``n`` characters."""
    return F.substring(as_col(c), 1, n)


def hash_personal(c, salt: str = "") -> Column:
    """Personal data handling (P17): a salted SHA-256 hex digest, NULL stays NULL."""
    value = as_col(c).cast("string")
    salted = F.concat(F.lit(salt), value) if salt else value
    return F.sha2(salted, 256)


def escape_regex(literal: str) -> str:
    """Backslash every non-alphanumeric so a keyword matches literally.

    Works in Java regex and RE2 alike (both accept ``\\`` before punctuation and
    space); used instead of ``\\Q..\\E`` so the oracle SQL reads the same.
    """
    return "".join(ch if ch.isalnum() or ch == "_" else "\\" + ch for ch in literal)


def whole_word_pattern(keywords, unicode: bool = True) -> str:
    """One regex matching any keyword as a whole word: ``\\b(?:k1|k2)\\b``.

    ``(?U)`` makes ``\\b`` Unicode-aware in Java, the same rule as Python's ``re``
    on ``str``.
    """
    body = "|".join(escape_regex(k) for k in keywords)
    prefix = "(?U)" if unicode else ""
    return prefix + r"\b(?:" + body + r")\b"
