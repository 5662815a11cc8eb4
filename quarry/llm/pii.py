"""Personal data (operator 7): base patterns and bootstrapped contextual extraction.

Base spans are the leftmost non-overlapping matches of four patterns that pass
their checks. They seed a bootstrap: every identifier-like token (a white-space
word with a digit or an ``@``, of any length and shape) is an instance, and the
two words before it are the lexical pattern it occurs in. Spark scores the
bipartite graph of patterns and instances: a pattern's confidence is the mean
score of its distinct instances, and it is confident at ``MIN_CONFIDENCE`` if at
least ``MIN_SUPPORT`` of them are believed. Seeds score 1; an instance is
believed from the first round that has it in a confident pattern and keeps the
best such confidence as its score, so a pattern is never raised by what it
taught itself. Rounds go on until none believes a new instance. Instances in
confident patterns that overlap no base span become ``learned`` spans.

Graph edges are aggregated per (pattern, instance) before any join, so a hot
pattern or instance crosses a shuffle once per task. Equal texts have equal
candidates: results are keyed by a hash of the text and its length, so copies
are not worked on twice. Positions are code points.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast

KINDS = ("email", "ip", "card", "phone")
LEARNED = "learned"
MIN_SUPPORT = 3
MIN_CONFIDENCE = 0.8

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TRIM = "\"'()[]{}<>.,;:!?*#$%&|"
_SPACES = "\x20\t\n\x0b\x0c\r"
_SPACE = re.compile(r"[\x20\x09-\x0D]")


def _emails(text: str) -> list[tuple[int, int]]:
    """Matches of the email pattern, found from each ``@`` outwards in linear time."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append((start, m.end()))
        done = m.end() if m else at + 1
        at = text.find("@", done)
    return out


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every base span, by kind as listed, then start."""
    out = [("email", a, b) for a, b in _emails(text)]
    if not any(c.isdigit() for c in set(text)):
        return out
    for m in _IP.finditer(text):
        if all(int(p[-4:]) <= 255 and not p[:-4].strip("0") for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            out.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
            out.append(("phone", *m.span()))
    return out


def span_text(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def _hash(*parts: str) -> int:
    raw = hashlib.blake2b("\x1f".join(parts).encode("utf-8", "surrogatepass"), digest_size=8)
    return int.from_bytes(raw.digest(), "big", signed=True)


def _word_before(text: str, end: int) -> tuple[str, int]:
    """The white-space word that ends before ``end``, lower case, and its start."""
    while end and text[end - 1] in _SPACES:
        end -= 1
    start = end
    while start and text[start - 1] not in _SPACES:
        start -= 1
    return text[start:end].lower(), start


def candidates(text: str, base: list[tuple[str, int, int]]
               ) -> list[tuple[int, int, int, int, bool]]:
    """``(pattern, instance, start, end, is seed)`` of every identifier-like token
    with a word before it.

    A base span is the instance of its own kind of place: spans that overlap a
    token replace it (the seed is the whole span).
    """
    out, taken = [], sorted((a, b) for _, a, b in base)
    for a, b in taken:
        out.append((a, b, True))
    at, k = 0, 0
    while m := _MARK.search(text, at):
        start = m.start()
        while start and text[start - 1] not in _SPACES:
            start -= 1
        stop = _SPACE.search(text, m.start())
        end = at = stop.start() if stop else len(text)
        while start < end and text[start] in _TRIM:
            start += 1
        while end > start and text[end - 1] in _TRIM:
            end -= 1
        while k < len(taken) and taken[k][1] <= start:
            k += 1
        near = any(a < end and start < b for a, b in taken[max(0, k - 4):k + 8])
        if end > start and not near:
            out.append((start, end, False))
    found = []
    for start, end, seed in sorted(out):
        value = text[start:end]
        one, at_one = _word_before(text, start)
        if not one:
            continue  # no words before it: no lexical pattern
        two, _ = _word_before(text, at_one)
        found.append((_hash(two, one), _hash(value), start, end, seed))
    return found


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base result and candidates of every whole text (one scan, no shuffle)."""
    struct = pa.list_(pa.struct([("pattern", pa.int64()), ("instance", pa.int64()),
                                 ("start", pa.int64()), ("end", pa.int64()), ("seed", pa.bool_())]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, key, size, texts = part.columns
            counts, hashes, base, found = [], [], [], []
            for text in texts.to_pylist():
                text = text or ""
                spans = base_spans(text)
                joined = span_text(spans)
                counts.append([sum(k == kind for k, _, _ in spans) for kind in KINDS])
                hashes.append(hashlib.sha256(joined.encode()).hexdigest())
                base.append(joined)
                found.append([dict(zip(("pattern", "instance", "start", "end", "seed"), c))
                              for c in candidates(text, spans)])
            by_kind = list(zip(*counts)) if counts else [()] * len(KINDS)
            yield pa.RecordBatch.from_arrays(
                [ids, key, size, *[pa.array(c, pa.int64()) for c in by_kind],
                 pa.array(hashes, pa.string()), pa.array(base, pa.string()),
                 pa.array(found, struct)],
                names=["__id", "__key", "__size", *[f"n_{k}" for k in KINDS], "base_sha256",
                       "__base", "__found"])

    text = F.col(f"`{text_col}`").cast("string")
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.xxhash64(text).alias("__key"),
                       F.length(text).alias("__size"), text.alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(batches, (
        f"__id {kind}, __key bigint, __size int, "
        + ", ".join(f"n_{k} bigint" for k in KINDS) + ", base_sha256 string, __base string, "
        "__found array<struct<pattern:bigint,instance:bigint,start:bigint,end:bigint,seed:boolean>>"))


def confident_patterns(occurrences: DataFrame, scratch, support: int = MIN_SUPPORT,
                       confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """``(pattern, confidence)`` of the confident patterns once no round believes more."""
    edges = scratch.save(
        occurrences.groupBy("pattern", "instance").agg(F.max(F.col("seed").cast("double")).alias("s"))
        .join(occurrences.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("score")),
              "instance")
        .select("pattern", "instance", "score"))
    while True:
        patterns = scratch.save(
            edges.groupBy("pattern").agg(F.avg("score").alias("confidence"),
                                         F.sum((F.col("score") > 0).cast("int")).alias("n"))
            .filter((F.col("n") >= max(support, 1)) & (F.col("confidence") >= confidence)).drop("n"))
        fresh = scratch.save(edges.filter("score = 0").join(bounded_broadcast(patterns), "pattern")
                             .groupBy("instance").agg(F.max("confidence").alias("best")))
        if fresh.isEmpty():
            return patterns
        edges = scratch.save(edges.join(bounded_broadcast(fresh), "instance", "left").select(
            "pattern", "instance", F.coalesce("best", "score").alias("score")))


def find_personal_data(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text",
                       support: int = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per document: ``(id, n_email, n_ip, n_card, n_phone, base_sha256, spans, __key, __size)``.

    ``spans`` lists base spans by kind, then start, then the learned ones. NULL and
    empty texts have none; NULL ids and repeated rows keep a row each; other columns
    are ignored; an empty table gives no rows.
    """
    rows = scratch.save(extract(docs, id_col, text_col))
    texts = (rows.filter(F.size("__found") > 0).groupBy("__key", "__size")
             .agg(F.first("__found").alias("__found")))
    occurrences = scratch.save(texts.select("__key", "__size", F.explode("__found").alias("f"))
                               .select("__key", "__size", "f.*"))
    confident = confident_patterns(occurrences, scratch, support, confidence).select("pattern")
    learned = (occurrences.filter(~F.col("seed"))
               .join(bounded_broadcast(confident), "pattern", "left_semi")
               .groupBy("__key", "__size")
               .agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("__new"))
               .select("__key", "__size", F.array_join(F.transform("__new", lambda s: F.concat_ws(
                   ":", F.lit(LEARNED), s["start"].cast("string"), s["end"].cast("string"))), ",")
                   .alias("__learned")))
    joined = rows.drop("__found").join(bounded_broadcast(learned), ["__key", "__size"], "left")
    return joined.select(
        F.col("__id").alias(id_col), *[f"n_{k}" for k in KINDS], "base_sha256",
        F.concat_ws(",", F.nullif(F.col("__base"), F.lit("")), "__learned").alias("spans"),
        "__key", "__size")


def redact(text: str, spans: str) -> str:
    """The text with every span replaced by its kind in square brackets.

    Overlapping spans are replaced together by the kind of the first one.
    """
    marks = sorted((int(a), int(b), k) for k, a, b in (s.split(":") for s in spans.split(",") if s))
    out, at, until = [], 0, -1
    for start, end, kind in marks:
        if start >= until:
            out += [text[at:start], f"[{kind.upper()}]"]
        until = at = max(until, end)
    return "".join([*out, text[at:]])


def redact_documents(docs: DataFrame, found: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col``; all other columns unchanged.

    Spans depend on the text alone, so they are joined by the text's hash and
    length. The side with spans is broadcast only if it measures small.
    """
    spans = bounded_broadcast(found.filter("spans != ''").groupBy("__key", "__size")
                              .agg(F.first("spans").alias("__spans")))
    text = F.col(f"`{text_col}`")
    names = docs.columns
    joined = (docs.withColumns({"__key": F.xxhash64(text), "__size": F.length(text)})
              .join(spans, ["__key", "__size"], "left"))

    @F.pandas_udf("string")
    def clean(texts, marks):
        return texts.where(marks.isna(), [redact(t, m) if isinstance(m, str) else t
                                          for t, m in zip(texts, marks)])

    return joined.select(*[
        F.when(F.col("__spans").isNull(), F.col(f"`{c}`")).otherwise(clean(text, F.col("__spans")))
        .alias(c) if c == text_col else F.col(f"`{c}`") for c in names])
