"""Suffix-array dedup (operator 9) by a logarithmic family of suffix indexes.

Every byte covered by a ``length``-byte string that also starts earlier (in a
smaller document, or earlier in the same one) is removed.

Index. Any ``length``-byte window holds ``length - PREFIX + 1`` suffix starts; the
one whose ``PREFIX``-byte hash is smallest (the last of equals) is the window's
anchor, so equal windows have equal anchors at equal offsets. The suffix array of
a batch holds its anchors only (about three in a hundred positions), ordered by
the 64-bit hash of the suffix's first ``PREFIX`` bytes: equal prefixes stand
together, which is all that a long match needs.

Family. Documents arrive in batches. A new batch is a level of its own; while two
levels are of equal size they are merge-scanned into one of twice the size: one
sort by suffix, in which every suffix that stands beside an equal one is marked.
Any two suffixes meet in the merge that first puts them into one level, so after
the last merge all repeated suffixes are marked, and each was sorted only
``log2(batches)`` times.

Matches. Only marked suffixes go on. Each sends the bytes around it; all windows
anchored there are hashed whole, and along a suffix's occurrences in document
order each window but the first of its kind is a match. Copies of a whole earlier
document need no windows: every window of theirs starts earlier.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from . import _text
from ._text import U64

LENGTH = 100
PREFIX = 32
BATCHES = 4
SPLIT_ROWS = 8192  # suffixes that occur more often are compared in parts of this many
GATHER_ROWS = 8192  # window rows (at most 2 * LENGTH bytes each) looked at together


def _sliding(values: np.ndarray, width: int, largest: bool) -> np.ndarray:
    """Minimum (or maximum) of every run of ``width`` values, by doubling."""
    pick = np.maximum if largest else np.minimum
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def anchors(data: np.ndarray, length: int, prefix: int) -> tuple[np.ndarray, np.ndarray,
                                                               np.ndarray, np.ndarray]:
    """``(position, key, first window, last window)`` of one text's anchors.

    Windows start at ``first .. last`` (inclusive); every window of the text
    belongs to exactly one anchor.
    """
    n = len(data) - length + 1
    if n <= 0:
        none = np.zeros(0, np.int64)
        return none, np.zeros(0, U64), none, none
    sums = _text.prefix_hash(data, fold=False)
    at = np.arange(len(data) - prefix + 1)
    key = _text.range_hash(sums, at, at + prefix)
    return _choose(key, length - prefix + 1)


def _choose(key: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The last smallest key of every window of ``width`` keys, and its windows.

    Window minima come from doubling; where a minimum occurs again further right
    in the same window, the rightmost one is the anchor.
    """
    least = _sliding(key, width, largest=False)
    # The anchor of window w is the last position p in [w, w + width) with key[p] == least[w].
    # Positions whose key is the minimum of some window around them:
    most = _sliding(np.r_[np.zeros(width - 1, U64), least, np.zeros(width - 1, U64)], width, True)
    spots = np.flatnonzero(most == key)
    windows = np.arange(len(least))
    # Among spots of equal key, the last one inside the window: search (key, position) pairs.
    order = np.lexsort((spots, key[spots]))
    ranked = spots[order]
    ranked_key = key[ranked]
    group = np.cumsum(np.r_[0, ranked_key[1:] != ranked_key[:-1]]) if len(ranked) else ranked
    firsts = np.flatnonzero(np.r_[True, ranked_key[1:] != ranked_key[:-1]])
    which = np.searchsorted(ranked_key[firsts], least)
    span = len(key) + width
    flat = group * span + ranked
    found = ranked[np.searchsorted(flat, which * span + windows + width - 1, "right") - 1]
    new = np.flatnonzero(np.r_[True, found[1:] != found[:-1]])
    last = np.r_[new[1:] - 1, len(found) - 1]
    return found[new], key[found[new]], new, last


def anchor_rows(docs: DataFrame, length: int, prefix: int, batches: int) -> DataFrame:
    """``(batch, key, doc, copy, at)``: the suffix array entries of every text."""
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            doc, copy, batch = (part.column(i).to_numpy() for i in range(3))
            data, offsets = _text.column_bytes(part.column(3))
            for i in range(part.num_rows):
                at, key, _, _ = anchors(data[offsets[i]:offsets[i + 1]], length, prefix)
                if len(at):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), batch[i], np.int32)), pa.array(_text.signed(key)),
                         pa.array(np.full(len(at), doc[i])), pa.array(np.full(len(at), copy[i])),
                         pa.array(at, pa.int32())], names=["batch", "key", "doc", "copy", "at"])

    return docs.select("doc", "copy", F.pmod(F.xxhash64("doc", "copy"), F.lit(batches)).cast("int"),
                       "__text").mapInArrow(
        _merged(rows), "batch int, key bigint, doc bigint, copy bigint, at int")


def _gathered(parts: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Small batches joined into batches of at least ``size`` rows."""
    held: list[pa.RecordBatch] = []
    count = 0
    for part in parts:
        held.append(part)
        count += part.num_rows
        if count >= size:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, count = [], 0
    if count:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _merged(rows):
    """An Arrow function whose output batches are joined (fewer, cheaper transfers)."""
    return lambda parts: _gathered(rows(parts), 50_000)


def _beside(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries in suffix order with those marked that stand beside an equal suffix."""
    def marked(part: pa.RecordBatch, before, after) -> pa.RecordBatch:
        key = part.column(0).to_numpy()
        same = key[1:] == key[:-1]
        mark = part.column(4).to_numpy(zero_copy_only=False).copy()
        mark[1:] |= same
        mark[:-1] |= same
        mark[0] |= before is None or before == key[0]
        mark[-1] |= after is None or after == key[-1]
        return pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(mark)],
                                          names=part.schema.names)

    held = before = None
    for part in _gathered(parts, 50_000):
        if held is not None:
            yield marked(held, before, part.column(0)[0].as_py())
            before = held.column(0)[-1].as_py()
        held = part
    if held is not None:
        yield marked(held, before, None)


class IndexFamily:
    """Levels of a suffix index; sizes are in batches, equal sizes merge.

    ``levels`` holds ``(size, table, is sorted and marked)``; a table has
    ``key, doc, copy, at, marked``.
    """

    def __init__(self, scratch):
        self.scratch = scratch
        self.levels: list[tuple[int, DataFrame]] = []

    @staticmethod
    def scan(entries: DataFrame) -> DataFrame:
        """Sort by suffix and mark every suffix that stands beside an equal one.

        Tasks hold ranges of (suffix, document, position), so a suffix that a third
        of all entries share is cut like any other stretch. A task's first and last
        entry are marked too, since their neighbours are in other tasks: one mark
        too many costs a comparison of windows and changes no result.
        """
        order = ["key", "doc", "copy", "at"]
        return (entries.select(*order, "marked").repartitionByRange(*order)
                .sortWithinPartitions(*order).mapInArrow(_beside, entries.select(
                    *order, "marked").schema))

    def add(self, batch: DataFrame) -> None:
        """Take in a batch of suffixes ``key, doc, copy, at``; merge equal levels."""
        size, table = 1, batch.withColumn("marked", F.lit(False))
        while self.levels and self.levels[-1][0] == size:
            below = self.levels.pop()
            table = self.scratch.save(self.scan(below[1].unionByName(table)))
            size += below[0]
        self.levels.append((size, table))

    def matches(self) -> DataFrame:
        """Entries whose suffix occurs at least twice in the whole family."""
        table = self.levels[0][1]
        for _, other in self.levels[1:]:
            table = table.unionByName(other)
        if len(self.levels) > 1 or self.levels[0][0] == 1:
            table = self.scan(table)
        return table.filter("marked").select("key", "doc", "copy", "at")


def packed(positions: DataFrame) -> DataFrame:
    """``(doc, copy, wanted)``: each document's list of positions as bytes (int32)."""
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lists = [x.values.to_numpy().astype(np.int32).tobytes() for x in part.column(2)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1),
                                              pa.array(lists, pa.binary())],
                                             names=["doc", "copy", "wanted"])

    return positions.select("doc", "copy", "at").mapInArrow(
        rows, "doc bigint, copy bigint, wanted binary")


def windows_around(texts: DataFrame, length: int, prefix: int) -> DataFrame:
    """``(key, doc, copy, first, bytes)`` of each wanted anchor: the bytes that its
    windows cover, from the first window's start."""
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            doc, copy = part.column(0).to_numpy(), part.column(1).to_numpy()
            data, offsets = _text.column_bytes(part.column(2))
            wanted = part.column(3)
            for i in range(part.num_rows):
                text = data[offsets[i]:offsets[i + 1]]
                at, key, first, last = anchors(text, length, prefix)
                keep = np.isin(at, np.frombuffer(wanted[i].as_buffer(), np.int32))
                at, key, first, last = at[keep], key[keep], first[keep], last[keep]
                raw = text.tobytes()
                n = len(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_text.signed(key)), pa.array(np.full(n, doc[i])),
                     pa.array(np.full(n, copy[i])), pa.array(first, pa.int32()),
                     pa.array([raw[a:b + length] for a, b in zip(first.tolist(), last.tolist())],
                              pa.binary())],
                    names=["key", "doc", "copy", "first", "bytes"])

    return texts.select("doc", "copy", "__text", "wanted").mapInArrow(
        _merged(rows), "key bigint, doc bigint, copy bigint, first int, bytes binary")


def frequent(found: DataFrame, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``(key, parts)`` of the suffixes that occur more than ``split_rows`` times."""
    return (found.groupBy("key").count().filter(F.col("count") > split_rows)
            .select("key", F.ceil(F.col("count") / split_rows).cast("int").alias("parts")))


def repeated_windows(around: DataFrame, hot: DataFrame, length: int, scratch) -> DataFrame:
    """``(doc, copy, low, high)``: byte ranges covered by windows that start earlier too.

    A window repeats if a window of the same bytes came before it under its key.
    The occurrences of a suffix in ``hot`` are dealt into parts by document; a
    window that is the first of its kind in its part is kept apart with its hash,
    and of all parts' firsts the earliest is the true one: the rest repeat it.
    """
    n = F.col("parts")
    dealt = (around.join(bounded_broadcast(hot), "key", "left")
             .withColumn("part", F.when(n.isNull(), -1).otherwise(
                 F.pmod(F.xxhash64("doc", "copy"), n).cast("int"))).drop("parts"))
    ordered = (dealt.repartition("key", "part")
               .sortWithinPartitions("key", "part", "doc", "copy", "first"))
    found = scratch.save(ordered.mapInArrow(
        lambda parts: _repeats(parts, length),
        "doc bigint, copy bigint, low int, high int, window bigint"))
    ranges = ["doc", "copy", "low", "high"]
    nth = F.row_number().over(Window.partitionBy("window").orderBy("doc", "copy", "low"))
    later = found.filter(F.col("window").isNotNull()).withColumn("nth", nth).filter("nth > 1")
    return found.filter(F.col("window").isNull()).select(*ranges).unionByName(later.select(*ranges))


def _repeats(parts: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Ranges of windows seen before in their group, and each dealt group's first windows.

    A group is a key and part; rows come by group in document order. What a group
    has shown so far is kept from one Arrow batch to the next as distinct hashes.
    """
    names = ["doc", "copy", "low", "high", "window"]
    open_group, shown = None, np.zeros(0, U64)
    for batch in _gathered(parts, GATHER_ROWS):
        key, dealt = batch.column("key").to_numpy(), batch.column("part").to_numpy()
        doc, copy = batch.column("doc").to_numpy(), batch.column("copy").to_numpy()
        first = batch.column("first").to_numpy()
        data, offsets = _bytes(batch.column("bytes"))
        sums = _text.prefix_hash(data, fold=False)
        n = np.diff(offsets) - length + 1
        owner = np.repeat(np.arange(len(key)), n)
        start = np.arange(len(owner)) - np.repeat(np.r_[0, np.cumsum(n)[:-1]], n)
        at = offsets[owner] + start
        window = _text.mix(_text.range_hash(sums, at, at + length) ^ key.view(U64)[owner])
        local = _text.mix(window ^ dealt.astype(np.int64).view(U64)[owner])
        _, once = np.unique(local, return_index=True)
        again = np.ones(len(local), bool)
        again[once] = False
        if open_group is not None:
            carried = ((key == open_group[0]) & (dealt == open_group[1]))[owner]
            again[carried] |= np.isin(local[carried], shown)
        last = (key[-1], dealt[-1])
        fresh = np.unique(local[((key == last[0]) & (dealt == last[1]))[owner]])
        shown = np.union1d(shown, fresh) if last == open_group else fresh
        open_group = last
        hit = np.flatnonzero(again)
        if len(hit):
            joins = (np.diff(hit) == 1) & (owner[hit[1:]] == owner[hit[:-1]])
            new = np.flatnonzero(np.r_[True, ~joins])
            end = np.r_[new[1:] - 1, len(hit) - 1]
            who = owner[hit[new]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[who]), pa.array(copy[who]),
                 pa.array((first[who] + start[hit[new]]).astype(np.int32)),
                 pa.array((first[who] + start[hit[end]] + length).astype(np.int32)),
                 pa.nulls(len(who), pa.int64())], names=names)
        firsts = np.flatnonzero(~again & (dealt >= 0)[owner])
        if len(firsts):
            who = owner[firsts]
            low = (first[who] + start[firsts]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc[who]), pa.array(copy[who]), pa.array(low),
                 pa.array((low + length).astype(np.int32)),
                 pa.array(_text.signed(window[firsts]))], names=names)


def _bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    binary = column.cast(pa.large_binary())
    _, offsets, data = binary.buffers()
    offs = np.frombuffer(offsets, np.int64, len(binary) + 1, binary.offset * 8)
    return np.frombuffer(data, np.uint8)[offs[0]:offs[-1]], offs - offs[0]


def removed_ranges(docs: DataFrame, scratch, length: int = LENGTH, prefix: int = PREFIX,
                   batches: int = BATCHES, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """``(doc, copy, ranges array<struct<low, high>>)`` of documents that lose bytes.

    ``docs`` has distinct ``doc, copy`` (their order is the order of documents) and
    ``__text``; copies of a whole earlier document must not be among them.
    """
    entries = scratch.save(anchor_rows(docs, length, prefix, batches), by="batch")
    family = IndexFamily(scratch)
    for batch in range(batches):
        family.add(entries.filter(F.col("batch") == batch).drop("batch"))
    found = scratch.save(family.matches())
    scratch.drop(entries)
    wanted = scratch.save(packed(found.groupBy("doc", "copy").agg(F.collect_list("at").alias("at"))))
    hot = scratch.save(frequent(found, split_rows))
    scratch.drop(found)
    around = windows_around(docs.join(bounded_broadcast(wanted), ["doc", "copy"]), length, prefix)
    return merged_ranges(repeated_windows(around, hot, length, scratch)
                         .groupBy("doc", "copy").agg(F.collect_list(F.struct("low", "high")).alias("ranges")))


def merged_ranges(collected: DataFrame) -> DataFrame:
    """Each document's ranges joined where they touch: ``(doc, copy, ranges)``."""
    kind = pa.list_(pa.struct([("low", pa.int32()), ("high", pa.int32())]))

    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            out = []
            for item in part.column(2):
                low, high = (item.values.field(k).to_numpy() for k in (0, 1))
                order = np.argsort(low, kind="stable")
                low, reach = low[order], np.maximum.accumulate(high[order])
                new = np.flatnonzero(np.r_[True, low[1:] > reach[:-1]])
                ends = reach[np.r_[new[1:] - 1, len(low) - 1]]
                out.append([{"low": a, "high": b} for a, b in zip(low[new].tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(out, kind)],
                                             names=["doc", "copy", "ranges"])

    return collected.select("doc", "copy", "ranges").mapInArrow(
        rows, "doc bigint, copy bigint, ranges array<struct<low:int,high:int>>")


def _cut(texts: DataFrame) -> DataFrame:
    """``(doc, copy, n_removed, n_spans, kept_sha256)`` of texts with their ranges."""
    def rows(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            data, offsets = _text.column_bytes(part.column(2))
            lists = part.column(3).to_pylist()
            removed, hashes = [], []
            for i, ranges in enumerate(lists):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                digest, at = hashlib.sha256(), 0
                for r in ranges:
                    digest.update(text[at:r["low"]])
                    at = r["high"]
                digest.update(text[at:])
                removed.append(sum(r["high"] - r["low"] for r in ranges))
                hashes.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(removed, pa.int64()),
                 pa.array(list(map(len, lists)), pa.int64()), pa.array(hashes, pa.string())],
                names=["doc", "copy", "n_removed", "n_spans", "kept_sha256"])

    return texts.select("doc", "copy", "__text", "ranges").mapInArrow(
        rows, "doc bigint, copy bigint, n_removed bigint, n_spans bigint, kept_sha256 string")


def dedup_bytes(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text",
                length: int = LENGTH, prefix: int = PREFIX, batches: int = BATCHES,
                split_rows: int = SPLIT_ROWS) -> DataFrame:
    """One row per document: ``(id, n_bytes, n_removed, n_spans, kept_sha256)``.

    Documents are ordered by id, NULL ids last; texts of one id are ordered by
    their hash, and rows repeated in id and text are one document (each row gets
    its result). NULL texts count as empty; texts under ``length`` bytes lose
    nothing; other columns are ignored; an empty table gives no rows.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), text.alias("__text"),
                       F.coalesce(F.col(f"`{id_col}`").cast("bigint"), F.lit((1 << 63) - 1))
                       .alias("doc"))
    plain = scratch.save(rows.select("__id", "doc", F.xxhash64("__text").alias("copy"),
                                     F.octet_length("__text").cast("bigint").alias("n_bytes"),
                                     F.sha2("__text", 256).alias("sha")))
    # Ids that name one text each (the usual case) need no second part of the order.
    several = not plain.groupBy("doc").count().filter("count > 1").isEmpty()
    facts = plain if several else plain.withColumn("copy", F.lit(0).cast("bigint"))
    named = rows.withColumn("copy", F.xxhash64("__text") if several else F.lit(0).cast("bigint"))
    # Whole copies: every text but the first of its bytes, in document order.
    firsts = facts.groupBy("sha").agg(F.min(F.struct("doc", "copy")).alias("f"),
                                      F.min("n_bytes").alias("n_bytes"))
    unique = scratch.save(firsts.filter(F.col("n_bytes") >= length).select("f.doc", "f.copy"))
    texts = (named.join(bounded_broadcast(unique), ["doc", "copy"], "left_semi")
             .select("doc", "copy", "__text"))
    texts = texts.dropDuplicates(["doc", "copy"]) if several else texts
    ranges = scratch.save(removed_ranges(texts, scratch, length, prefix, batches,
                                         split_rows))
    cut = scratch.save(_cut(texts.join(bounded_broadcast(ranges), ["doc", "copy"])))
    known = (facts.join(firsts.select("sha", F.col("f.doc").alias("first_doc")), "sha")
             .join(cut, ["doc", "copy"], "left"))
    whole = (F.col("doc") != F.col("first_doc")) & (F.col("n_bytes") >= length)
    empty = hashlib.sha256(b"").hexdigest()
    return known.select(
        F.col("__id").alias(id_col), "n_bytes",
        F.when(whole, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("bigint").alias("n_spans"),
        F.when(whole, F.lit(empty)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"))

