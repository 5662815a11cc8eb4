"""SentencePiece encoding and decoding (operator 4): Aho-Corasick driven Viterbi.

One Aho-Corasick automaton holds every ordinary piece. Reading a chunk once, the
automaton reports at each end position all pieces that end there (it follows the
output links); each one relaxes the best score of that position from the best
score of its start. A character that no piece covers costs ``UNKNOWN`` and is
written as its UTF-8 byte pieces. Following the best last pieces back gives the
segmentation of highest total log-probability; of equal totals the one with the
longer last piece wins.

A unigram model file carries log-probabilities. A BPE file carries merge ranks
instead, which are no probabilities (their sum would favour many early pieces),
so ranks are turned into log-probabilities by Zipf's law.
"""

from __future__ import annotations

import functools
import math
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _pieces

# Scores are whole millionths of a nat, so that sums are exact wherever a chunk starts.
SCALE = 1_000_000
UNKNOWN = -40 * SCALE
CACHE_ENTRIES = 250_000
CACHE_CHARS = 64


def piece_scores(vocabulary: _pieces.Vocabulary) -> dict[str, int]:
    """Scaled log-probability per ordinary piece: the file's own, or Zipf's law over BPE ranks."""
    if not vocabulary.bpe:
        return {p: round(SCALE * vocabulary.scores[i]) for p, i in vocabulary.ids.items()}
    order = sorted(vocabulary.ids, key=lambda p: (vocabulary.rank[p], vocabulary.ids[p]))
    total = math.log(sum(1 / (k + 1) for k in range(len(order))))
    return {p: round(SCALE * (-math.log(k + 1) - total)) for k, p in enumerate(order)}


class Codec:
    """Encoder and decoder of one model file, with a bounded per-process chunk cache."""

    def __init__(self, path: str):
        import ahocorasick

        v = self.vocabulary = _pieces.load(path)
        self.automaton = ahocorasick.Automaton()
        for piece, score in piece_scores(v).items():
            self.automaton.add_word(piece, (len(piece), score, v.ids[piece]))
        self.automaton.make_automaton()
        self.cache: dict[str, bytes] = {}
        self.decoded = [b""] * len(v.pieces)
        for piece, i in v.ids.items():
            self.decoded[i] = piece.replace(_pieces.SPACE, " ").encode()
        for value, i in enumerate(v.byte_ids):
            self.decoded[i] = bytes([value])

    def segment(self, chunk: str) -> list[int]:
        """Piece ids of one chunk by the single-pass Viterbi."""
        n = len(chunk)
        best = [0] + [-math.inf] * n
        last = [(0, -1)] * (n + 1)
        filled = 0  # positions up to here have their final score

        def unknown(upto: int) -> None:
            """Close the positions that no piece ends at (or ends at worse)."""
            nonlocal filled
            while filled < upto:
                filled += 1
                score = best[filled - 1] + UNKNOWN
                if score > best[filled]:
                    best[filled], last[filled] = score, (1, -1)

        for end, (length, score, piece) in self.automaton.iter(chunk):
            if end > filled:
                unknown(end)
            total = best[end + 1 - length] + score
            here = best[end + 1]
            if total > here or total == here and length > last[end + 1][0]:
                best[end + 1], last[end + 1] = total, (length, piece)
        unknown(n)
        ids: list[int] = []
        while n:
            length, piece = last[n]
            if piece >= 0:
                ids.append(piece)
            else:
                ids.extend(self.vocabulary.byte_ids[b]
                           for b in reversed(chunk[n - 1].encode()))
            n -= length
        ids.reverse()
        return ids

    def _chunk(self, chunk: str) -> bytes:
        found = self.cache.get(chunk)
        if found is None:
            found = array("i", self.segment(chunk)).tobytes()
            if len(chunk) <= CACHE_CHARS and len(self.cache) < CACHE_ENTRIES:
                self.cache[chunk] = found
        return found

    def encode(self, text: str) -> np.ndarray:
        """Piece ids (int32) of a whole text."""
        chunks = self.vocabulary.chunk.findall(_pieces.normalise(text))
        return np.frombuffer(b"".join(map(self._chunk, chunks)), np.int32)

    def decode(self, ids) -> str:
        """The text of piece ids: bytes of the pieces, the leading space taken off."""
        raw = b"".join(map(self.decoded.__getitem__, ids))
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "replace")


@functools.cache
def codec(path: str) -> Codec:
    return Codec(path)


def _kind(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def encode(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text"
           ) -> DataFrame:
    """``(id, ids array<int>, n_tokens, round_trip)`` of every whole text.

    ``round_trip``: decoding the ids gives the text again. It does for every text
    but those holding the space mark U+2581 itself, which decodes as a space.
    NULL and empty texts give an empty array (and ``round_trip`` true); NULL ids,
    repeated rows and other columns are passed over unchanged; an empty table
    gives no rows.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for part in parts:
            keys, texts = part.columns
            found, same = [], []
            for text in texts.to_pylist():
                ids = coder.encode(text or "")
                found.append(ids)
                same.append(coder.decode(ids.tolist()) == (text or ""))
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            flat = np.concatenate(found) if found else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), pa.array(flat, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [keys, lists, pa.array(sizes), pa.array(same, pa.bool_())],
                names=["__id", "ids", "n_tokens", "round_trip"])

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    schema = f"__id {_kind(rows, '__id')}, ids array<int>, n_tokens bigint, round_trip boolean"
    return rows.mapInArrow(batches, schema).withColumnRenamed("__id", id_col)


def decode(encoded: DataFrame, model: str, id_col: str = "doc_id", ids_col: str = "ids"
           ) -> DataFrame:
    """``(id, text)``: the inverse of ``encode``. NULL ids decode to an empty text."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(model)
        for part in parts:
            keys, lists = part.columns
            texts = [coder.decode(x or ()) for x in lists.to_pylist()]
            yield pa.RecordBatch.from_arrays([keys, pa.array(texts, pa.string())],
                                             names=["__id", "text"])

    rows = encoded.select(F.col(f"`{id_col}`").alias("__id"),
                          F.col(f"`{ids_col}`").alias("__ids"))
    out = rows.mapInArrow(batches, f"__id {_kind(rows, '__id')}, text string")
    return out.withColumnRenamed("__id", id_col)
