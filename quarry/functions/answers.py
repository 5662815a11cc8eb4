"""Reading a batched labeller's free-text answer (P15, P16), JVM-side.

An answer is prose that should contain one JSON object mapping the position of
each key in its batch (``"0"``, ``"1"``, ...) to a label. The object is the
text from the first ``{`` to the last ``}``; no braces, or braces around
something that is not a JSON object of strings, is an error for the whole
batch. Each position is then clamped to a closed vocabulary: unknown or
missing becomes the fallback, and a missing position never shifts the others.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col


def json_object_text(c) -> Column:
    """First ``{`` to last ``}`` (P15). NULL when there is no such span."""
    found = F.regexp_extract(as_col(c), r"(?s)(\{.*\})", 1)
    return F.when(found == F.lit(""), F.lit(None).cast("string")).otherwise(found)


def whole_json(c) -> Column:
    """The text as one VARIANT; NULL unless all of it is a single JSON value.

    The JSON parser stops after the first value, so the text is parsed as the
    first element of a list that ends in a marker: anything after the value
    (more text, a second value) moves or hides the marker.
    """
    marker = "end-of-text"
    v = F.try_parse_json(F.concat(F.lit("["), as_col(c), F.lit(f',"{marker}"]')))
    ends = ((F.try_variant_get(v, "$[1]", "string") == marker)
            & F.try_variant_get(v, "$[2]", "variant").isNull())
    return F.when(ends, F.try_variant_get(v, "$[0]", "variant"))


def answer_map(c) -> Column:
    """The answer as ``map<string,variant>``; NULL when absent or not one JSON object."""
    return F.try_variant_get(whole_json(json_object_text(c)), "$", "map<string,variant>")


def clamp_label(answer: Column, position, vocabulary, fallback: str = "other") -> Column:
    """The label at ``position`` without surrounding white space, in lower case; outside
    ``vocabulary`` (or not a string) -> fallback (P16)."""
    raw = F.try_variant_get(F.element_at(answer, as_col(position).cast("string")), "$", "string")
    blank = r"[\s\x1c-\x1f]+"
    label = F.lower(F.regexp_replace(raw, f"(?U)^{blank}|{blank}$", ""))
    return F.when(label.isin(list(vocabulary)), label).otherwise(F.lit(fallback))
