"""Benchmark decontamination (operator 2): spaced-seed hashing with verified overlaps.

Tokens are runs of letters and digits (ASCII case folded, bytes above 127 count as
letters). A mask such as ``11011011`` hashes the tokens under its ones and ignores
those under its zeros, so a substitution under a zero does not lose the hit. All
masks' hashes of the benchmark items are the query set; every token position of
every document is hashed by the same masks and looked up in it.

A hit fixes a diagonal between a document and an item. The item's tokens are laid
on the document along it: the document is contaminated if some run of
``WINDOW`` aligned tokens (the whole item, if shorter) agrees in at least
``SIMILARITY`` of its positions.

The masks miss no such run: ``covering_masks`` adds to the fixed ones until every
placement of the substitutions that the threshold allows leaves some mask intact
somewhere in the run. Items shorter than ``WINDOW`` have masks of their own length's
cover, the shortest a mask over all their tokens.

The benchmark is a stated query set: it goes to the tasks in blocks of at most
``BLOCK_BYTES`` of text, each against all documents, and documents are never shuffled. A
task holds all blocks of its chain, so its memory follows the benchmark, not the documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._text import U64

MASKS = ("111111", "11011011", "1101001100101")
WINDOW = 13
SIMILARITY = 0.8
MOST_MASKS = 4  # that one cover may add before it takes masks of fewer tokens
BLOCK_BYTES = 16 << 20
_FILTER_BITS = 22


def _intact(mask: str, size: int, placements: set[frozenset]) -> set[frozenset]:
    """Placements of substitutions in ``size`` tokens under which the mask is intact somewhere."""
    ones = [j for j, bit in enumerate(mask) if bit == "1"]
    spots = [{at + j for j in ones} for at in range(size - len(mask) + 1)]
    return {p for p in placements if any(not p & spot for spot in spots)}


def _shapes(size: int, weight: int) -> Iterator[str]:
    """All masks of ``weight`` ones that fit ``size`` tokens."""
    for span in range(weight, size + 1):
        for inner in combinations(range(1, span - 1), max(weight - 2, 0)):
            ones = {0, span - 1, *inner}
            if len(ones) == weight:
                yield "".join("1" if j in ones else "0" for j in range(span))


@cache
def covering_masks(size: int, similarity: float = SIMILARITY, masks: tuple[str, ...] = MASKS
                   ) -> tuple[str, ...]:
    """Masks that hit every run of ``size`` tokens that agrees in ``similarity`` of them.

    Those of ``masks`` that fit, then the mask that reaches most of the placements still
    missed, and so on; of as many tokens as a cover of few masks allows.
    """
    wrong = size - ceil(similarity * size - 1e-9)
    every = {frozenset(p) for p in combinations(range(size), wrong)}
    fixed = tuple(m for m in masks if len(m) <= size)
    # A short run needs shorter masks anyway, so the fixed ones are only its start at full length.
    starts = [fixed] if all(len(m) <= size for m in masks) else []
    for start in [*starts, ()]:
        for weight in range(min(6, size), 0, -1):
            chosen, left = list(start), set(every)
            for mask in start:
                left -= _intact(mask, size, left)
            while left and len(chosen) < len(start) + MOST_MASKS:
                best = max(_shapes(size, weight), key=lambda m: (len(_intact(m, size, left)), -len(m), m))
                found = _intact(best, size, left)
                if not found:
                    break
                chosen.append(best)
                left -= found
            if not left:
                return tuple(chosen)
    raise ValueError(f"no mask is intact in {size} tokens with {wrong} substitutions")


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    rows, starts, ends = _text.words(data, offsets, _text.punctuation_table())
    if not len(rows):
        return rows, np.zeros(0, U64)
    return rows, _text.range_hash(_text.prefix_hash(data, fold=True), starts, ends)


def _seeds(rows: np.ndarray, hashes: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """``(position, key)`` of a mask at every token position where it fits its row."""
    span, n = len(mask), len(hashes)
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    key = np.full(n - span + 1, int(mask, 2), U64)
    for j, bit in enumerate(mask):
        if bit == "1":
            key = (key ^ hashes[j:n - span + 1 + j]) * U64(0x9FB21C651E98DF25)
    at = np.flatnonzero(rows[:n - span + 1] == rows[span - 1:])
    return at, _text.mix(key[at])


@dataclass
class Block:
    """One block of benchmark items: their token hashes and the sorted seeds."""

    items: list
    tokens: list[np.ndarray]
    masks: tuple[str, ...]
    keys: np.ndarray
    item: np.ndarray
    position: np.ndarray
    filter: np.ndarray

    @classmethod
    def build(cls, items: list, texts: list[str], masks: tuple[str, ...], window: int,
              similarity: float) -> Block:
        data, offsets = _text.column_bytes(pa.array(texts, pa.string()))
        rows, hashes = _tokens(data, offsets)
        first = np.searchsorted(rows, np.arange(len(items) + 1))
        tokens = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
        size = np.minimum(np.diff(first), window)
        by_mask: dict[str, list[int]] = {}
        for n in np.unique(size[size > 0]).tolist():
            for mask in covering_masks(n, similarity, masks):
                by_mask.setdefault(mask, []).append(n)
        found = [(np.zeros(0, np.int64), np.zeros(0, U64))]
        for mask, sizes in by_mask.items():
            at, key = _seeds(rows, hashes, mask)
            asked = np.isin(size[rows[at]], sizes) if len(at) else np.zeros(0, bool)
            found.append((at[asked], key[asked]))
        at = np.concatenate([f[0] for f in found])
        keys = np.concatenate([f[1] for f in found])
        order = np.argsort(keys, kind="stable")
        at, keys = at[order], keys[order]
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[(keys >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True
        item = rows[at]
        return cls(items, tokens, tuple(by_mask), keys, item, at - first[item], bits)

    def search(self, rows: np.ndarray, hashes: np.ndarray, window: int, similarity: float
               ) -> set[tuple[int, int]]:
        """``(row, item index)`` of every verified overlap among these documents."""
        hits = []
        for mask in self.masks:
            at, key = _seeds(rows, hashes, mask)
            maybe = self.filter[(key >> U64(64 - _FILTER_BITS)).astype(np.int64)]
            at, key = at[maybe], key[maybe]
            low = np.searchsorted(self.keys, key, "left")
            n = np.searchsorted(self.keys, key, "right") - low
            if not n.any():
                continue
            which = np.repeat(low - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
            here = np.repeat(at, n)
            hits.append(np.stack([rows[here], self.item[which], here - self.position[which]], 1))
        if not hits:
            return set()
        first = np.searchsorted(rows, np.arange(rows[-1] + 2))
        found: set[tuple[int, int]] = set()
        for row, item, diagonal in np.unique(np.concatenate(hits), axis=0).tolist():
            if (row, item) not in found and self._agrees(
                    hashes, first[row], first[row + 1], item, diagonal, window, similarity):
                found.add((row, item))
        return found

    def _agrees(self, hashes, low: int, high: int, item: int, diagonal: int, window: int,
                similarity: float) -> bool:
        tokens = self.tokens[item]
        a, b = max(low, diagonal), min(high, diagonal + len(tokens))
        size = min(window, len(tokens))
        if b - a < size:
            return False
        same = np.r_[0, np.cumsum(hashes[a:b] == tokens[a - diagonal:b - diagonal])]
        return int((same[size:] - same[:-size]).max()) >= ceil(similarity * size - 1e-9)


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int
            ) -> Iterator[tuple[list, list[str]]]:
    """The items in blocks of at most ``block_bytes`` (by a hash of the item; one at least)."""
    items = (benchmark.select(F.col(f"`{item_col}`").alias("item"),
                              F.col(f"`{text_col}`").cast("string").alias("text"))
             .filter("item is not null and text is not null"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    n = max(1, ceil(2 * total / block_bytes))
    for k in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k)
        rows = sorted(part.toLocalIterator())
        yield [r[0] for r in rows], [r[1] for r in rows]


def find_contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", item_col: str = "item_id",
                       item_text_col: str = "text", masks: tuple[str, ...] = MASKS,
                       window: int = WINDOW, similarity: float = SIMILARITY,
                       block_bytes: int = BLOCK_BYTES, keep_cols: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: ``(id, [keep_cols], contaminated, items array<bigint>, n_items)``.

    ``items`` are the sorted ids of the benchmark items verified in the whole text.
    NULL and empty texts are clean; items with a NULL id or text, or without tokens,
    match nothing; an item of up to four tokens matches where it stands verbatim;
    repeated items are reported once;
    NULL ids and repeated documents keep a row each; other columns are ignored.
    Without documents there are no rows, without items all documents are clean.
    """
    spark = docs.sparkSession
    columns = [F.col(f"`{id_col}`").alias("__id"), F.col(f"`{text_col}`").cast("string").alias("__text")]
    rows = docs.select(*columns, *[F.col(f"`{c}`").alias(f"__keep{i}") for i, c in enumerate(keep_cols)],
                       F.array().cast("array<bigint>").alias("__items"))
    for items, texts in _blocks(benchmark, item_col, item_text_col, block_bytes):
        block = spark.sparkContext.broadcast(Block.build(items, texts, masks, window, similarity))
        rows = rows.mapInArrow(_searcher(block, window, similarity), rows.schema)
    return rows.select(
        F.col("__id").alias(id_col), *[F.col(f"__keep{i}").alias(c) for i, c in enumerate(keep_cols)],
        (F.size("__items") > 0).alias("contaminated"), F.col("__items").alias("items"),
        F.size("__items").cast("bigint").alias("n_items"))


def _searcher(block, window: int, similarity: float):
    """An Arrow function that adds one block's items to ``__items``."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: Block = block.value
        for part in parts:
            texts = part.column("__text")
            found: dict[int, set] = {}
            for low, high in _text.chunks(texts):
                rows, hashes = _tokens(*_text.column_bytes(texts.slice(low, high - low)))
                if len(rows):
                    for row, item in known.search(rows, hashes, window, similarity):
                        found.setdefault(low + row, set()).add(known.items[item])
            if found:
                lists = [sorted(found[i].union(x)) if i in found else x
                         for i, x in enumerate(part.column("__items").to_pylist())]
                at = part.schema.get_field_index("__items")
                part = part.set_column(at, part.schema.field(at), pa.array(lists, part.schema.field(at).type))
            yield part
    return batches
