"""Token counts (operator 6): byte-pair merging with a heap over a linked list.

A chunk's characters form a doubly linked list; the heap holds every adjacent
pair that is a piece, by (rank, position). The lowest pair is popped, skipped if
either side has changed since, else merged, and its two new neighbours are
pushed. Only the number of merges is needed: the count is the initial symbols
minus the merges, plus the extra byte tokens of symbols that stay unknown. No
identifiers are produced.

Chunks (see ``_pieces``) repeat heavily, so each Python worker keeps the counts
of up to ``CACHE_ENTRIES`` chunks; what does not fit is computed again.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _pieces

TOKEN_LIMIT = 4096
CACHE_ENTRIES = 1_000_000
CACHE_CHARS = 64  # longer chunks are not kept


def merge_count(chunk: str, rank: dict[str, float]) -> int:
    """Tokens of one chunk: its symbols minus the merges of the lowest-rank pairs."""
    n = len(chunk)
    if n == 1 or chunk in rank and n == 2:
        return 1 if chunk in rank else len(chunk.encode())
    symbols = list(chunk)
    following = list(range(1, n + 1))
    previous = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        pair = symbols[i] + symbols[i + 1]
        r = rank.get(pair)
        if r is not None:
            heap.append((r, i, pair))
    heapq.heapify(heap)
    pop, push = heapq.heappop, heapq.heappush
    merges = 0
    while heap:
        _, left, pair = pop(heap)
        a = symbols[left]
        if a is None:
            continue
        right = following[left]
        if right >= n or len(a) >= len(pair) or a + symbols[right] != pair:
            continue
        symbols[left], symbols[right] = pair, None
        after = following[left] = following[right]
        merges += 1
        if after < n:
            previous[after] = left
            joined = pair + symbols[after]
            r = rank.get(joined)
            if r is not None:
                push(heap, (r, left, joined))
        before = previous[left]
        if before >= 0:
            joined = symbols[before] + pair
            r = rank.get(joined)
            if r is not None:
                push(heap, (r, before, joined))
    unknown = sum(len(s.encode()) - 1 for s in symbols if s is not None and s not in rank)
    return n - merges + unknown


class _Counts(dict):
    """chunk -> tokens, filled on demand and bounded in entries."""

    def __init__(self, rank: dict[str, float]):
        super().__init__()
        self.rank = rank

    def __missing__(self, chunk: str) -> int:
        tokens = merge_count(chunk, self.rank)
        if len(chunk) <= CACHE_CHARS and len(self) < CACHE_ENTRIES:
            self[chunk] = tokens
        return tokens


_workers: dict[str, Callable[[str], int]] = {}


def counter(model: str) -> Callable[[str], int]:
    """``text -> tokens`` for a model file; kept by the worker process across tasks."""
    if model not in _workers:
        vocabulary = _pieces.load(model)
        if not vocabulary.bpe:
            raise ValueError("byte-pair merging needs a BPE model")
        counts, cut = _Counts(vocabulary.rank), vocabulary.chunk.findall

        def count(text: str) -> int:
            return sum(map(counts.__getitem__, cut(_pieces.normalise(text))))

        _workers[model] = count
    return _workers[model]


def count_tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = TOKEN_LIMIT) -> DataFrame:
    """``(id, n_bytes, n_tokens, over_limit)`` of every whole text.

    NULL and empty texts have 0 bytes and 0 tokens. A NULL id is kept; repeated
    rows give repeated results; an empty table gives none; other columns are
    ignored. A row's memory is that of its text: long runs without a cut (one
    huge chunk) cost O(n log n) time.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(model)
        for part in parts:
            ids, sizes, texts = part.columns
            tokens = [count(t) if t else 0 for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([ids, sizes, pa.array(tokens, pa.int64())],
                                             names=["__id", "n_bytes", "n_tokens"])

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"),
                       F.coalesce(F.octet_length(F.col(f"`{text_col}`")), F.lit(0))
                       .cast("bigint").alias("n_bytes"),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    out = rows.mapInArrow(batches, f"__id {kind}, n_bytes bigint, n_tokens bigint")
    return out.select(F.col("__id").alias(id_col), "n_bytes", "n_tokens",
                      (F.col("n_tokens") > limit).alias("over_limit"))
