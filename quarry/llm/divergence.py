"""Source divergence audit (operator 13): iceberg prefix refinement, exact integer shares.

Which terms does a language keep? Those that stand in at least ``LEAST_DOCS`` of its
documents. They are found by byte prefixes, level by level: a term can only be kept if
each of its prefixes stands in as many documents. Level ``l`` reads the texts and counts,
per language, the distinct documents of the prefixes of ``LEVELS(l)`` bytes, but only of
terms whose previous prefix was kept; terms not longer than that are complete at this
level and are counted with their occurrences per source. Prefixes and terms below the
threshold are discarded and the rest extended, until no unfinished prefix is left.

A document lies in one task, so its distinct prefixes are counted there and only sums per
task meet in a shuffle, one per level. The kept prefixes of a level go to the next one as a bitmap of
``SLOTS`` bits, the same size for any input: two prefixes of one slot let a discarded
prefix through, whose terms are then counted and discarded by their own count.

Shares. Per language with V kept terms and N their occurrences in a group, a term's share
is ``p = 1 + floor(10**9 * (count + 1) / (N + V))``, and a group differs from another by
the sum of ``floor((p - q)**2 / q)`` over all kept terms. Most counts are zero, so the sum
over all terms is taken from the terms that both have, from the number of terms per count
of each, and from the number of terms that neither has.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from . import _text
from ._text import U64

LEAST_DOCS = 3
FIRST_BYTES = 4  # prefix of the first level; each further level doubles it
SLOTS = 1 << 25  # bits of the bitmap of kept prefixes (4 MB)
TOP = 200
HELD_ROWS = 1 << 20  # rows that a task adds up at a time
UNIT = 1_000_000_000
_FIELDS = ["lang", "source", "prefix", "whole", "docs", "n", "slot"]


def term_bytes(data: np.ndarray) -> np.ndarray:
    """True inside ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+``: ASCII letters and all of U+0080 on."""
    return (data >= 0x80) | ((data | 0x20) - 97 < 26)


def counted_prefixes(lang: pa.Array, source: pa.Array, text: pa.Array, low: int, high: int,
                     bitmap: np.ndarray | None, slots: int = SLOTS) -> pa.RecordBatch | None:
    """Sums over one chunk of documents for the level of prefixes of ``high`` bytes.

    ``low`` is the length of the previous level; ``bitmap`` marks its kept prefixes
    (none at the first level). Complete terms are summed per source, unfinished
    prefixes per language, with their slot of the next bitmap.
    """
    data, offsets = _text.column_bytes(text)
    rows, starts, ends = _text.runs(term_bytes(data), offsets)
    longer = ends - starts > low
    rows, starts, ends = rows[longer], starts[longer], ends[longer]
    if not len(rows):
        return None
    lang, source = lang.dictionary_encode(), source.dictionary_encode()
    salt = np.array([_name_hash(x) for x in lang.dictionary.to_pylist()], U64)
    of_lang = lang.indices.to_numpy()
    lowered = data.copy()
    lowered[(data >= 65) & (data <= 90)] |= 0x20
    sums = _text.prefix_hash(lowered, fold=False)
    if bitmap is not None:
        slot = _slots(_text.range_hash(sums, starts, starts + low), salt[of_lang[rows]], slots)
        alive = (bitmap[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
        rows, starts, ends = rows[alive], starts[alive], ends[alive]
        if not len(rows):
            return None
    whole = ends - starts <= high
    ends = np.minimum(ends, starts + high)
    # Complete terms apart from unfinished prefixes of the same bytes.
    name = _text.range_hash(sums, starts, ends) ^ np.where(whole, U64(0), U64(0x5555555555555555))
    # Per document, then per group: each (document, prefix) adds one to docs.
    order = np.lexsort((name, rows))
    r, h = rows[order], name[order]
    first = np.flatnonzero(np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])])
    times = np.diff(np.r_[first, len(r)])
    at = order[first]
    group = of_lang[rows[at]].astype(np.int64) * (len(source.dictionary) + 1)
    group += np.where(whole[at], source.indices.to_numpy()[rows[at]] + 1, 0)
    order = np.lexsort((name[at], group))
    g, h = group[order], name[at][order]
    first = np.flatnonzero(np.r_[True, (g[1:] != g[:-1]) | (h[1:] != h[:-1])])
    docs = np.diff(np.r_[first, len(g)])
    n = np.add.reduceat(times[order], first)
    at = at[order][first]
    sizes = ends[at] - starts[at]
    cut = np.r_[0, np.cumsum(sizes)]
    picked = lowered[np.repeat(starts[at] - cut[:-1], sizes) + np.arange(cut[-1])]
    prefix = pa.Array.from_buffers(pa.binary(), len(at), [
        None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(picked.tobytes())])
    done = pa.array(whole[at])
    sources = source.dictionary.take(pa.array(source.indices.to_numpy()[rows[at]]))
    slot = _slots(_text.range_hash(sums, starts[at], ends[at]), salt[of_lang[rows[at]]], slots)
    return pa.RecordBatch.from_arrays(
        [lang.dictionary.take(pa.array(of_lang[rows[at]])).cast(pa.string()),
         pc.if_else(done, sources.cast(pa.string()), pa.scalar(None, pa.string())), prefix, done,
         pa.array(docs, pa.int64()), pa.array(n, pa.int64()), pa.array(slot, pa.int64())], names=_FIELDS)


def _name_hash(name: str) -> int:
    out = 0xCBF29CE484222325
    for b in name.encode():
        out = (out ^ b) * 0x100000001B3 % (1 << 64)
    return out


def _slots(hashes: np.ndarray, salt: np.ndarray, slots: int) -> np.ndarray:
    return (_text.mix(hashes ^ salt) % U64(slots)).astype(np.int64)


def level(docs: DataFrame, low: int, high: int, kept, slots: int = SLOTS) -> DataFrame:
    """Sums per (lang, source, prefix) for one level, with those per (lang, prefix).

    ``kept`` is the broadcast bitmap of the previous level. A task adds up its documents
    first (``HELD_ROWS`` distinct rows at a time), so one shuffle by (lang, prefix) is all:
    the sums per source and over all sources are both taken behind it. ``lead`` marks one
    row of each prefix.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = None if kept is None else np.frombuffer(kept.value, np.uint8)
        held, rows = [], 0
        for part in parts:
            for a, b in _text.chunks(part.column(2)):
                lang, source, text = (part.column(k).slice(a, b - a) for k in range(3))
                found = counted_prefixes(lang, source, text, low, high, bitmap, slots)
                if found is not None:
                    held.append(found)
                    rows += found.num_rows
            if rows >= HELD_ROWS:
                summed = _summed(held)
                if summed.num_rows >= HELD_ROWS // 2:
                    yield from summed.to_batches()
                    held, rows = [], 0
                else:
                    held, rows = summed.to_batches(), summed.num_rows
        if held:
            yield from _summed(held).to_batches()

    found = docs.mapInArrow(batches, "lang string, source string, prefix binary, whole boolean, "
                                     "docs bigint, n bigint, slot bigint")
    sums = (found.repartition("lang", "prefix").groupBy("lang", "prefix", "whole", "source").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.min("slot").alias("slot")))
    of_prefix = Window.partitionBy("lang", "prefix", "whole")
    return sums.withColumns({
        "all_docs": F.sum("docs").over(of_prefix), "all_n": F.sum("n").over(of_prefix),
        "lead": F.row_number().over(of_prefix.orderBy("source")) == 1})


def _summed(held: list[pa.RecordBatch]) -> pa.Table:
    """Rows of equal names added up."""
    sums = pa.Table.from_batches(held).group_by(_FIELDS[:4], use_threads=False).aggregate(
        [("docs", "sum"), ("n", "sum"), ("slot", "min")])
    return sums.select([*_FIELDS[:4], "docs_sum", "n_sum", "slot_min"]).rename_columns(_FIELDS)


def kept_bitmap(prefixes: DataFrame, slots: int = SLOTS) -> bytes:
    """The ``slots`` bits of the kept prefixes, built by Spark in parts of 4 KB each."""
    # bitmap_* number their buckets from 1 for values from 1 on.
    parts = (prefixes.select((F.col("slot") + 1).alias("slot"))
             .groupBy(F.expr("bitmap_bucket_number(slot)").alias("part"))
             .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(slot))").alias("bits")))
    out = bytearray(max(slots // 8, 4096))
    for r in parts.collect():  # at most slots / 32768 rows
        at = (r["part"] - 1) * len(r["bits"])
        out[at:at + len(r["bits"])] = r["bits"]
    return bytes(out)


def kept_terms(docs: DataFrame, scratch, slots: int = SLOTS) -> DataFrame:
    """``(lang, source, term, n, all_n, lead)``: occurrences of all kept terms, per source and
    in the language; ``lead`` marks one row per term.

    ``docs`` has ``lang, source, text`` without NULLs.
    """
    spark, low, high, kept = docs.sparkSession, 0, FIRST_BYTES, None
    counts = None
    while True:
        found = scratch.save(level(docs, low, high, kept, slots).filter(F.col("all_docs") >= LEAST_DOCS))
        if kept is not None:
            kept.unpersist()
        whole = found.filter("whole").select(
            "lang", "source", F.col("prefix").cast("string").alias("term"), "n", "all_n", "lead")
        counts = whole if counts is None else counts.unionByName(whole)
        going_on = found.filter(~F.col("whole")).select("slot")
        if going_on.isEmpty():
            return counts
        kept = spark.sparkContext.broadcast(kept_bitmap(going_on, slots))
        low, high = high, 2 * high


def share(count: Column | str, n: Column | str, v: Column | str) -> Column:
    """``1 + floor(10**9 * (count + 1) / (n + v))``, exact for any count."""
    return F.expr(f"CAST(1 + ((CAST({count} AS DECIMAL(20, 0)) + 1) * {UNIT}) div "
                  f"(CAST({n} AS DECIMAL(20, 0)) + {v}) AS BIGINT)")


def gap(p: str, q: str) -> str:
    """SQL of ``floor((p - q)**2 / q)``; shares are below 2**31, so it stays a long."""
    return f"(({p} - {q}) * ({p} - {q})) div {q}"


def audit(docs: DataFrame, scratch, lang_col: str = "lang", source_col: str = "source",
          text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """``(lang, source, part, item, value, rank)`` of every (lang, source) group.

    ``pair`` rows: every other source of the language with the summed difference, all
    ranks; ``term`` rows: kept terms that the group uses more than its language, ranks to
    ``TOP``. Ranks order by value descending, then item by its bytes.

    NULL text, lang and source count as empty. Each row is a document, so repeated rows
    count again; other columns are ignored. A group without terms has pairs like any
    other; a language without kept terms has pairs of value zero. A table of one source
    per language gives only terms, an empty table gives no rows.
    """
    rows = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(name)
                         for name, c in (("lang", lang_col), ("source", source_col), ("text", text_col))])
    counts = kept_terms(rows, scratch, slots)
    groups = rows.select("lang", "source").distinct()
    sizes = groups.select("lang").distinct().join(
        counts.groupBy("lang").agg(F.count_if("lead").alias("v"), F.sum("n").alias("all_total")), "lang", "left")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("held"))
    known = scratch.save(groups.join(sizes, "lang").join(totals, ["lang", "source"], "left").select(
        "lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
                            for c in ("v", "all_total", "total", "held")])
        .withColumn("zero", F.when(F.col("v") > 0, share("0", "total", "v"))))
    used = scratch.save(counts.join(bounded_broadcast(known), ["lang", "source"]).select(
        "lang", "source", "term", share("n", "total", "v").alias("p"), "zero",
        share("all_n", "all_total", "v").alias("q")))
    return _pairs(known, used).unionByName(_terms(used))


def _pairs(known: DataFrame, used: DataFrame) -> DataFrame:
    # Terms that both have, one row per unordered pair of sources and term; what their zero
    # shares add below is taken off here.
    x = used.select("lang", "term", *[F.col(c).alias(f"x_{c}") for c in ("source", "p", "zero")])
    y = used.select("lang", "term", *[F.col(c).alias(f"y_{c}") for c in ("source", "p", "zero")])
    fix = lambda p, q, p0, q0: F.sum(F.expr(
        f"{gap(p, q)} - {gap(p, q0)} - {gap(p0, q)} + {gap(p0, q0)}").cast("decimal(38,0)"))
    both = (x.join(y, ["lang", "term"]).filter("x_source < y_source")
            .groupBy("lang", "x_source", "y_source")
            .agg(fix("x_p", "y_p", "x_zero", "y_zero").alias("there"),
                 fix("y_p", "x_p", "y_zero", "x_zero").alias("back")))
    shared = both.select("lang", F.col("x_source").alias("source"), F.col("y_source").alias("item"),
                         F.col("there").alias("part_value")).unionByName(
        both.select("lang", F.col("y_source").alias("source"), F.col("x_source").alias("item"),
                    F.col("back").alias("part_value")))
    # Every group's shares against every other group's zero share, by number of terms per share.
    other = known.select("lang", F.col("source").alias("item"), F.col("v").alias("o_v"),
                         F.col("held").alias("o_held"), F.col("zero").alias("o_zero"))
    shares = used.groupBy("lang", "source", "p", "zero").agg(F.count(F.lit(1)).alias("terms"))
    against = shares.join(other, "lang").filter("source != item")
    part = lambda sql: F.sum(F.expr(f"({sql}) * CAST(terms AS DECIMAL(18, 0))"))
    ahead = against.groupBy("lang", "source", "item").agg(
        part(gap("p", "o_zero")).alias("part_value"))
    behind = against.groupBy("lang", F.col("item").alias("source"), F.col("source").alias("item")).agg(
        part(gap("o_zero", "p")).alias("part_value"))
    rest = (known.join(other, "lang").filter("source != item")
            .select("lang", "source", "item", F.expr(
                f"CASE WHEN v = 0 THEN 0 ELSE CAST(v - held - o_held AS DECIMAL(18, 0)) "
                f"* ({gap('zero', 'o_zero')}) END").alias("part_value")))
    parts = None
    for df in (shared, ahead, behind, rest):
        df = df.select("lang", "source", "item", F.col("part_value").cast("decimal(38,0)").alias("part_value"))
        parts = df if parts is None else parts.unionByName(df)
    value = parts.groupBy("lang", "source", "item").agg(F.sum("part_value").cast("bigint").alias("value"))
    return _ranked(value, "pair")


def _terms(used: DataFrame) -> DataFrame:
    more = used.filter("p > q").select("lang", "source", F.col("term").alias("item"),
                                       F.expr(gap("p", "q")).alias("value"))
    return _ranked(more, "term").filter(F.col("rank") <= TOP)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return rows.select("lang", "source", F.lit(part).alias("part"), "item",
                       F.col("value").cast("bigint").alias("value"),
                       F.row_number().over(order).alias("rank"))
