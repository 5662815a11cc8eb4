"""The record gate (V1-V5): check every raw record, alter none.

Each raw line is parsed once into a VARIANT (``whole_json``; a broken line, or one
with anything after its value, is NULL, a repeated key keeps its last value with the session setting), and
each rule is a column expression over it. The result is the input plus
``reasons array<string>`` (empty when accepted), ``accepted boolean``,
``error_count int`` and ``identifier string``. Nothing is filtered: the
caller lands the input, not the accepted subset (V5).

Rules (lax validation of a posting, as a Pydantic model would apply them):

* the value is a JSON object;
* ``slug``, ``title``, ``company_name``: present and a JSON string;
* ``location``: absent, null or a string;
* ``remote``: absent, a boolean, 0/1, or one of the yes/no-style strings;
  JSON null is rejected;
* ``tags``: absent or an array whose elements are all strings; null rejected;
* ``created_at``: present; an integer or boolean (epoch seconds within the
  years 1-9999), a number, a numeric string, or an ISO date / date-time string.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.answers import whole_json

# Strings a lax boolean accepts (compared case-insensitively).
BOOL_STRINGS = ("0", "off", "f", "false", "n", "no", "1", "on", "t", "true", "y", "yes")

REQUIRED_STRINGS = ("slug", "title", "company_name")
_HOUR, _SIXTY = "([01][0-9]|2[0-3])", "[0-5][0-9]"
ISO_DATETIME = (r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
                rf"([Tt _]{_HOUR}:{_SIXTY}(:{_SIXTY}([.,][0-9]{{1,9}})?)?"
                rf"([Zz]|[+-]{_HOUR}(:?{_SIXTY})?)?)?$")
NUMERIC_STRING = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
# Compact JSON of an array whose elements are all strings (possibly none).
STRING_ARRAY_JSON = r'^\[(?:"(?:[^"\\]++|\\.)*+"(?:,"(?:[^"\\]++|\\.)*+")*+)?\]$'
# Epoch seconds a datetime can hold (years 1 to 9999).
EPOCH_MIN, EPOCH_MAX = -62_135_596_800, 253_402_300_799
# Fractions and numeric strings: beyond MILLIS_FROM they are milliseconds, and the
# instant must lie in the years 1600 to 9999.
MILLIS_FROM, FIRST_INSTANT = 20_000_000_000, -11_676_096_000


def _instant(x: Column) -> Column:
    """Whether a number names an instant in range, as seconds or milliseconds."""
    seconds = F.when(F.abs(x) > MILLIS_FROM, x / 1000).otherwise(x)
    return F.coalesce(seconds.between(FIRST_INSTANT, EPOCH_MAX), F.lit(False))


def _field_type(v: Column, name: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, f"$.{name}", "variant"))


def _is_number(t: Column) -> Column:
    return (t == "BIGINT") | (t == "DOUBLE") | t.startswith("DECIMAL")


FIELDS = (*REQUIRED_STRINGS, "location", "remote", "tags", "created_at")


def probes(v: Column) -> dict[str, Column]:
    """Per-record values several rules read: the record's kind, each field's type
    and ``created_at`` as text. ``gate`` computes them once, as columns."""
    out = {"kind": F.schema_of_variant(v),
           "created_text": F.try_variant_get(v, "$.created_at", "string")}
    out.update({f"type_{name}": _field_type(v, name) for name in FIELDS})
    return out


def reasons_expr(v: Column, p: dict[str, Column] | None = None) -> Column:
    """``array<string>`` of rule violations for one parsed record; empty = valid.

    ``v`` is ``whole_json(raw)``: NULL for a line that is not one JSON value. ``p``
    holds the ``probes`` of ``v`` (computed inline when omitted).
    """
    p = p or probes(v)
    kind = p["kind"]
    field_reasons = []
    for name in REQUIRED_STRINGS:
        t = p[f"type_{name}"]
        field_reasons.append(F.when(t.isNull(), F.lit(f"{name}:missing"))
                             .when(t != "STRING", F.lit(f"{name}:not_string")))

    t = p["type_location"]
    field_reasons.append(F.when(t.isNotNull() & (t != "VOID") & (t != "STRING"),
                                F.lit("location:not_string")))

    t = p["type_remote"]
    as_double = F.try_variant_get(v, "$.remote", "double")
    as_text = F.lower(F.try_variant_get(v, "$.remote", "string"))
    remote_ok = (t.isNull() | (t == "BOOLEAN")
                 | (_is_number(t) & as_double.isin(0.0, 1.0))
                 | ((t == "STRING") & as_text.isin(*BOOL_STRINGS)))
    field_reasons.append(F.when(t == "VOID", F.lit("remote:null"))
                         .when(~F.coalesce(remote_ok, F.lit(False)), F.lit("remote:not_bool")))

    t = p["type_tags"]
    # The compact JSON text of the value is an array of string literals only:
    # a null, number, boolean or nested element fails (a type check alone
    # cannot tell ["a", null] from ["a"]). No lambda, so the gate stays codegen'd.
    tags_json = F.to_json(F.try_variant_get(v, "$.tags", "variant"))
    all_strings = F.coalesce(tags_json.rlike(STRING_ARRAY_JSON), F.lit(False))
    field_reasons.append(F.when(t == "VOID", F.lit("tags:null"))
                         .when(t.isNotNull() & ~all_strings, F.lit("tags:not_string_list")))

    t = p["type_created_at"]
    text = p["created_text"]
    whole = F.try_variant_get(v, "$.created_at", "decimal(38,0)")
    is_integer = (t == "BIGINT") | (t.startswith("DECIMAL") & t.endswith(",0)"))
    created_ok = ((t == "BOOLEAN")
                  | (is_integer & whole.between(EPOCH_MIN, EPOCH_MAX))
                  | (_is_number(t) & ~is_integer
                     & _instant(F.try_variant_get(v, "$.created_at", "double")))
                  | ((t == "STRING") & ((text.rlike(NUMERIC_STRING)
                                         & _instant(text.try_cast("double")))
                                        | (text.rlike(ISO_DATETIME)
                                           & F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd")
                                           .isNotNull()))))
    field_reasons.append(F.when(t.isNull(), F.lit("created_at:missing"))
                         .when(t == "VOID", F.lit("created_at:null"))
                         .when(~F.coalesce(created_ok, F.lit(False)), F.lit("created_at:invalid")))

    # Drop the NULLs of rules that passed (the reasons are distinct strings).
    per_field = F.array_except(F.array(*field_reasons), F.array(F.lit(None).cast("string")))
    return (F.when(v.isNull(), F.array(F.lit("not_json")))
            .when(~kind.startswith("OBJECT"), F.array(F.lit("not_object")))
            .otherwise(per_field))


def identifier_expr(raw: Column, v: Column, p: dict[str, Column] | None = None) -> Column:
    """What a reject is logged as (V3): its slug, ``<no slug>``, or the start of the value."""
    p = p or probes(v)
    kind = p["kind"]
    slug = F.try_variant_get(v, "$.slug", "variant")
    slug_text = F.when(p["type_slug"] == "STRING",
                       F.try_variant_get(v, "$.slug", "string")).otherwise(F.to_json(slug))
    scalar = F.when(kind == "STRING",
                    F.concat(F.lit("'"), F.try_variant_get(v, "$", "string"), F.lit("'")))
    return (F.when(kind.startswith("OBJECT"), F.coalesce(slug_text, F.lit("<no slug>")))
            .otherwise(F.substring(F.coalesce(scalar, raw), 1, 40)))


def gate(df: DataFrame, raw_col: str = "raw") -> DataFrame:
    """The input plus ``reasons``, ``accepted``, ``error_count``, ``identifier`` (V1, V3)."""
    # Parse once into a column; every rule reads the parsed value. The verdict
    # is produced by one Generate: a later filter on `accepted` then stays
    # above it instead of being inlined into the scan, which would evaluate
    # every rule twice (once in the filter, once in the projection).
    # The probes several rules share are computed once in the projection
    # below it (a Generate does not eliminate repeated subexpressions).
    parsed = df.withColumn("__v", whole_json(raw_col))
    v = F.col("__v")
    probed = parsed.select("*", *[c.alias(f"__p_{k}") for k, c in probes(v).items()])
    p = {k: F.col(f"__p_{k}") for k in probes(v)}
    verdict = F.struct(reasons_expr(v, p).alias("reasons"),
                       identifier_expr(F.col(raw_col), v, p).alias("identifier"))
    checked = probed.select(*[F.col(f"`{c}`") for c in df.columns],
                            F.inline(F.array(verdict)))
    return (checked.withColumn("accepted", F.size("reasons") == 0)
            .withColumn("error_count", F.size("reasons"))
            .select(*[F.col(f"`{c}`") for c in df.columns], "reasons", "accepted",
                    "error_count", "identifier"))


def gate_counts(gated: DataFrame) -> DataFrame:
    """``(accepted, rejected)`` counts in one pass (V2)."""
    return gated.agg(
        F.count(F.when(F.col("accepted"), 1)).alias("accepted"),
        F.count(F.when(~F.col("accepted"), 1)).alias("rejected"),
    )


def rejects(gated: DataFrame) -> DataFrame:
    """Quarantine view of rejected records (V3)."""
    return (gated.filter(~F.col("accepted"))
            .select("identifier", "error_count", F.concat_ws(",", "reasons").alias("reasons")))


def require_some_valid(accepted: int, rejected: int) -> None:
    """All-rejected batch aborts; partial rejection only warns (V4, G1)."""
    if accepted == 0:
        raise RuntimeError(
            f"nothing to land: none of {accepted + rejected} records passed the gate")
