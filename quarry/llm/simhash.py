"""SimHash near-dedup (operator 12): one-wildcard segment variants, equality join, verification.

A fingerprint has 64 bits; bit ``i`` is set if more than half of the text's word
shingles (repeats count) have bit ``i`` in their XXH64. Documents of equal
fingerprints are one node; two nodes link when at most ``BITS`` bits differ.

Candidates. A fingerprint is cut into ``SEGMENTS`` segments, fewer than ``BITS + 1``
but so many that one of them differs by at most one bit (4 bits over 3 segments). Each
segment is indexed by its variants with one bit wild: two segments at most one bit
apart are equal in the variant that hides that bit. All nodes of one variant form a
block, found by equality.

Links. Nodes of one variant meet in a task and are verified there by exclusive-or and
bit count; most blocks hold one node and give nothing. What leaves the task are links
that join the block's components: in a block of more than ``SMALL_BLOCK`` nodes one less
than each component has nodes, found breadth first, so that neither the pairs of a group
of near copies nor those of chance meetings are ever listed. A block of more than
``CHUNK_NODES`` nodes is dealt in chunks that meet pairwise, so no task holds more than
two chunks of it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.joins import bounded_broadcast
from ..sources.tables import spread
from . import _text
from ._graph import components

WORDS = 4
SEED = 42
BITS = 4
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit and width
BLOCK_SHINGLES = 1 << 16  # shingles whose bits are counted at once
SMALL_BLOCK = 16          # nodes up to which blocks are compared together, each with each
CHUNK_NODES = 4096        # nodes of a block that one side of a task holds
BLOCK_NODES = 256         # nodes that look for neighbours at once
COMPARED = 1 << 20        # fingerprint pairs compared at once
HELD_ROWS = 1 << 16       # rows gathered before their blocks are searched


def shingle_hashes(text: bytes, words: int = WORDS) -> Iterator[list[int]]:
    """XXH64 of every shingle of a whole text, in blocks."""
    parts = text.lower().split()  # splits at 20 and 09-0D, lowers A-Z only: bytes know no others
    if not parts:
        return
    joined = b" ".join(parts)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) + 1
    ends = np.cumsum(sizes)
    starts = ends - sizes
    if len(parts) >= words:
        starts, ends = starts[:len(parts) - words + 1], ends[words - 1:]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK_SHINGLES):
        cut = slice(at, at + BLOCK_SHINGLES)
        yield [digest(joined[a:b], SEED) for a, b in zip(starts[cut].tolist(), (ends[cut] - 1).tolist())]


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64 bits; bit ``i`` is set if over half of the shingle hashes have it. No words: zero."""
    total, ones = 0, np.zeros(64, np.int64)
    for hashes in shingle_hashes(text, words):
        total += len(hashes)
        found = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(found, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int((np.packbits(2 * ones > total, bitorder="little")).view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str, text_col: str, words: int = WORDS) -> DataFrame:
    """``(__id, node)`` of every whole text; ``node`` is the fingerprint as a signed long."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = part.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(t or b"", words) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(_text.signed(found))],
                                             names=["__id", "node"])

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text"))
    return rows.mapInArrow(batches, f"__id {rows.schema['__id'].dataType.simpleString()}, node bigint")


def variants(nodes: DataFrame) -> DataFrame:
    """``(key, node)``: every segment with each of its bits wild once.

    A key holds the segment's other bits in place, the wild bit's number above them.
    """
    keys = []
    for first, width in SEGMENTS:
        segment = F.shiftrightunsigned("node", first).bitwiseAND(F.lit((1 << width) - 1))
        for wild in range(width):
            keys.append(segment.bitwiseAND(F.lit((1 << width) - 1 - (1 << wild)))
                        .bitwiseOR(F.lit((first + wild) << 32)))
    return nodes.select(F.explode(F.array(*keys)).alias("key"), "node")


def forest(fingers: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links ``(from, to)`` that join all linked fingerprints, none twice and no cycles.

    Breadth first: nodes reached last are compared with those not reached yet, so a
    group of near copies costs few comparisons and gives one link less than it has nodes.
    """
    waiting = np.arange(len(fingers))
    reached = waiting[:0]
    while len(waiting):
        if not len(reached):
            reached, waiting = waiting[:1], waiting[1:]
        some, reached = reached[:BLOCK_NODES], reached[BLOCK_NODES:]
        step = max(1, COMPARED // len(some))
        new = []
        for at in range(0, len(waiting), step):
            cut = waiting[at:at + step]
            near = np.bitwise_count(fingers[some, None] ^ fingers[cut][None]) <= bits
            hit = near.any(0)
            yield some[near[:, hit].argmax(0)], cut[hit]
            new.append(hit)
        if new:
            hit = np.concatenate(new)
            reached, waiting = np.r_[reached, waiting[hit]], waiting[~hit]


def small_links(key: np.ndarray, fingers: np.ndarray, bits: int, most: int
                ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All links inside sorted blocks of at most ``most`` nodes, many blocks at once."""
    for apart in range(1, min(most, len(key))):
        a = np.flatnonzero(key[apart:] == key[:-apart])
        a = a[np.bitwise_count(fingers[a] ^ fingers[a + apart]) <= bits]
        yield a, a + apart


def block_links(bits: int):
    """Arrow function over rows sorted by block: links that join each block's components."""
    def of(rows: pa.Table) -> pa.RecordBatch:
        node = rows.column("node").to_numpy()
        tags = [rows.column(c).to_numpy() for c in ("key", "first", "second")]
        new = np.r_[True, np.logical_or.reduce([t[1:] != t[:-1] for t in tags])]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.r_[starts, len(node)])
        block = np.cumsum(new)
        small = np.flatnonzero(np.repeat((sizes > 1) & (sizes <= SMALL_BLOCK), sizes))
        found = [(small[i], small[j]) for i, j in small_links(
            block[small], node[small].view(np.uint64), bits, SMALL_BLOCK)]
        for start, size in zip(starts[sizes > SMALL_BLOCK], sizes[sizes > SMALL_BLOCK]):
            found += [(start + i, start + j) for i, j in forest(
                node[start:start + size].view(np.uint64), bits)]
        a, b = (np.concatenate([x[k] for x in found]) if found else starts[:0] for k in (0, 1))
        return pa.RecordBatch.from_arrays([pa.array(node[a]), pa.array(node[b])], names=["a", "b"])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for part in parts:
            if not part.num_rows:
                continue
            held.append(part)
            rows += part.num_rows
            if rows < HELD_ROWS:
                continue
            # All but the last block are whole.
            table = pa.Table.from_batches(held)
            tags = [table.column(c).to_numpy() for c in ("key", "first", "second")]
            other = np.flatnonzero(np.logical_or.reduce([t != t[-1] for t in tags]))
            cut = int(other[-1]) + 1 if len(other) else 0
            if cut:
                yield of(table.slice(0, cut))
            held = table.slice(cut).combine_chunks().to_batches()
            rows = table.num_rows - cut
        if held:
            yield of(pa.Table.from_batches(held))
    return batches


def links(keyed: DataFrame, bits: int = BITS, chunk_nodes: int = CHUNK_NODES) -> DataFrame:
    """Links ``(a, b)`` that join the components of every block of ``keyed`` (``key, node``)."""
    crowded = (keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
               .filter(F.col("n") > chunk_nodes)
               .select("key", F.ceil(F.col("n") / chunk_nodes).alias("chunks")))
    dealt = (keyed.join(bounded_broadcast(crowded), "key", "left")
             .withColumn("chunks", F.coalesce("chunks", F.lit(1)))
             .withColumn("chunk", F.pmod(F.xxhash64("node"), F.col("chunks")))
             # Every two chunks meet; the only chunk of a block meets nobody.
             .select("key", "node", "chunk", F.explode(
                 F.when(F.col("chunks") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_remove(
                     F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), F.col("chunk")))).alias("other"))
             .select("key", F.least("chunk", "other").alias("first"),
                     F.greatest("chunk", "other").alias("second"), "node"))
    tasks = dealt.repartition("key", "first", "second").sortWithinPartitions("key", "first", "second")
    return tasks.mapInArrow(block_links(bits), "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text",
                    words: int = WORDS, bits: int = BITS) -> DataFrame:
    """One row per document: ``(id, fingerprint, component_id)``.

    ``component_id`` is the smallest id reachable over links, the document itself
    included. NULL, empty and wordless texts have fingerprint zero and are linked like
    any other. Rows without an id take part, lend no id, and get the component's (NULL
    if none has one). Repeated rows keep a row each; other columns are ignored; an empty
    table gives no rows.
    """
    if len(SEGMENTS) * 2 <= bits:
        raise ValueError(f"{len(SEGMENTS)} segments cannot hold {bits} differing bits, one of them at most one")
    rows = scratch.save(fingerprints(docs, id_col, text_col, words))
    nodes = scratch.save(rows.groupBy("node").agg(F.min("__id").alias("__id")))
    found = scratch.save(links(variants(spread(nodes.select("node"))), bits))
    whole = scratch.save(components(found, scratch))
    placed = (nodes.join(whole, "node", "left")
              .select("node", "__id", F.coalesce("root", "node").alias("root")))
    names = placed.groupBy("root").agg(F.min("__id").alias("component_id"))
    classes = placed.join(names, "root").select("node", "component_id")
    return (rows.join(classes, "node")
            .select(F.col("__id").alias(id_col), F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"),
                    "component_id"))
