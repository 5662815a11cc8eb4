"""Secret scans (operator 3, native): base patterns and character Markov models.

Base spans are the leftmost non-overlapping matches of three patterns, kept if
long enough. The method adds strings that no pattern names: two first-order
character models, one of random strings and one of ordinary identifiers, score
each candidate token by its log-likelihood ratio per transition.

Both models count the whole corpus: random strings are the secret values of all
base matches, ordinary identifiers are the tokens of all documents without one.
Only the 128 x 128 table of counts leaves the aggregate. All expressions are
native; positions are code points.
"""

from __future__ import annotations

from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._columns import fixed_table, indices, let, whole_text

# The base patterns, in the order of their kinds.
ASSIGN = (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=\-]+)""")
ACCESS = r"(AKIA([A-Z0-9]{16,}))"
HEX = r"([0-9a-f]{24,})"
KINDS = ("assign", "access", "hex", "markov")

CANDIDATE = r"[A-Za-z0-9+/_=\-]{20,}"
TOKEN = r"[A-Za-z0-9+/_=\-]{4,}"
SYMBOLS = 128
ALPHABET = 65
SMOOTHING = 0.5
MIN_RATIO = 1.0


def matches(text: Column, pattern: str, group: int = 0) -> Column:
    """``array<struct<start, end, value>>`` of every leftmost non-overlapping match.

    The pieces between matches and the matches themselves alternate, so running
    sums of their lengths are the positions. ``value`` is the given group. Texts
    without a match skip the work.
    """
    def walk(gaps: Column, hits: Column, values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast(
            "array<struct<start:int,end:int,value:string>>").alias("out"))

        def step(acc: Column, i: Column) -> Column:
            begin = acc["at"] + F.length(F.get(gaps, i))
            end = begin + F.length(F.get(hits, i))
            found = F.struct(begin.alias("start"), end.alias("end"),
                             F.get(values, i).alias("value"))
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(found)).alias("out"))

        return F.aggregate(indices(F.size(hits)), start, step, lambda acc: acc["out"])

    spans = let(F.split(text, pattern), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda hits: let(
            F.regexp_extract_all(text, F.lit(pattern), F.lit(group)),
            lambda values: walk(gaps, hits, values))))
    return F.when(text.rlike(pattern), spans).otherwise(
        F.array().cast("array<struct<start:int,end:int,value:string>>"))


def _tagged(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"),
        m["end"].alias("end"), m["value"].alias("value")))


def base_spans(text: Column) -> Column:
    """Base spans of a text by start, then kind: ``array<struct<start, kind, end, value>>``."""
    assign = F.filter(matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 6)
    return F.sort_array(F.concat(_tagged(assign, "assign"), _tagged(matches(text, ACCESS), "access"),
                                 _tagged(matches(text, HEX), "hex")))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _codes(value: Column) -> Column:
    """ASCII codes of a token's characters."""
    return F.transform(F.split(value, ""), lambda c: F.ascii(c))


def _transitions(value: Column) -> Column:
    return let(_codes(value), lambda a: F.transform(
        indices(F.size(a) - 1), lambda i: F.get(a, i) * SYMBOLS + F.get(a, i + 1)))


def ratio_table(found: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """``ln(P_random(b|a) / P_ordinary(b|a))`` at ``a * 128 + b``.

    ``found`` has ``__text, __base``. Add-``smoothing`` over the 65 token
    characters that the candidates are made of; a character never seen by a model
    has a uniform successor there.
    """
    random, plain = F.size("__base") > 0, F.size("__base") == 0
    values = F.when(plain, F.array("__text")).otherwise(F.transform("__base", lambda s: s["value"]))
    tokens = (found.select(random.cast("int").alias("random"), F.explode(values).alias("value"))
              .select("random", F.explode(F.regexp_extract_all(
                  F.col("value"), F.lit(TOKEN), F.lit(0))).alias("token")))
    counts = (tokens.select("random", F.explode(_transitions(F.col("token"))).alias("t"))
              .groupBy("t").agg(F.sum("random").alias("r"), F.sum(1 - F.col("random")).alias("o")))
    size = SYMBOLS * SYMBOLS
    random, ordinary = [0] * size, [0] * size
    for t, r, o in counts.toLocalIterator():
        random[t], ordinary[t] = r, o

    def rates(n: list[int]) -> list[float]:
        rows = [sum(n[a * SYMBOLS:(a + 1) * SYMBOLS]) + smoothing * ALPHABET for a in range(SYMBOLS)]
        return [log((x + smoothing) / rows[t // SYMBOLS]) for t, x in enumerate(n)]

    return [x - y for x, y in zip(rates(random), rates(ordinary))]


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         min_ratio: float = MIN_RATIO) -> DataFrame:
    """``(id, base, spans)``: arrays of ``struct<start, kind, end, value>``.

    ``spans`` holds the base spans and the added ``markov`` ones (tokens of 20
    characters or more, overlapping no base span, whose mean ratio per transition
    reaches ``min_ratio``), by start, then kind. NULL texts have no spans; NULL
    ids and repeated rows keep a row each; other columns are ignored.
    """
    text = F.col("__text")
    found = (docs.select(whole_text(text_col).alias("__text"))
             .select(F.explode(F.array(F.struct("__text", base_spans(text).alias("__base")))).alias("__f"))
             .select("__f.*"))
    table = fixed_table(ratio_table(found))

    def likely(value: Column) -> Column:
        return let(_transitions(value), lambda t: F.aggregate(
            t, F.lit(0.0), lambda total, k: total + F.get(table, k)) / F.size(t)) >= min_ratio

    def added(base: Column) -> Column:
        clear = lambda m: ~F.exists(
            base, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))
        return F.filter(matches(text, CANDIDATE), lambda m: clear(m) & likely(m["value"]))

    spans = let(base_spans(text), lambda base: F.struct(
        base.alias("base"),
        F.sort_array(F.concat(base, _tagged(added(base), "markov"))).alias("spans")))
    return (docs.select(F.col(f"`{id_col}`").alias("__id"), whole_text(text_col).alias("__text"))
            .select("__id", F.explode(F.array(spans)).alias("__s"))
            .select(F.col("__id").alias(id_col), "__s.base", "__s.spans"))


def secret_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: base counts by kind, the hash of the base spans, and all spans."""
    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")

    return scan(docs, id_col, text_col).select(
        id_col, count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"))
