"""Spelling variant grouping (operator 11): pivotal grams, position limits, verification.

Words are maximal runs of Latin letters of whole texts, counted over all documents.
Two words are near if one inserted, deleted or replaced letter turns one into the
other. Near words are found without comparing all of them:

* Bigrams are ordered by rarity (occurrences in the distinct words). A word's *prefix* holds its
  three rarest bigrams. One edit touches at most two
  adjacent bigrams, so near words share one; of two words, the one whose prefix ends
  later in the order has every intact prefix bigram of the other in its own prefix.
* Of its prefix each word chooses two disjoint *pivots* of least summed frequency, by
  dynamic programming over positions. One edit touches at most one of them: if it is
  in or before the first, the second stands unedited with all that follows it; else
  the first stands unedited with all that comes before it.
* Position limits. The unedited side is equal letter by letter, so it goes into the
  index key; the other side loses at most one letter, in one of its halves, so the key
  also takes the half next to the pivot or the far one. A word asks with its pivots and
  answers with every bigram of its prefix, for partners a letter shorter or longer.
* Asked and answering words meet in an equality join and are verified inside it by
  length, letter parity and edit distance; only near pairs leave it.
"""

from __future__ import annotations

import heapq
import os
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text

LEAST_LETTERS = 7
LEAST_COUNT = 2
FORM_RATIO = 10  # a form occurs at least this many times as often
DROP_EVERY = 31  # runs whose checksum this divides lose one letter
PREFIX = 3       # bigrams of a prefix: 2 * edits + 1
HELD_WORDS = 100_000  # distinct words a task gathers before it passes their counts on
LONG_RUN = 64    # letters (bytes) from which a word's checksum and edits are taken by themselves
BASE, PRIME = 0x5851F42D4C957F2D, (1 << 61) - 1  # of the letter hashes
NONE = (float("inf"), ())


def letter_runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(row, start, end)`` of ``[A-Za-z\\u00C0-\\u00FF]+``; the latter are C3 and one byte."""
    lead = data == 0xC3
    letter = lead | ((data | 0x20) - 97 < 26).astype(bool) if len(data) else lead
    letter[1:] |= lead[:-1]
    return _text.runs(letter, offsets)


def _crc_table() -> np.ndarray:
    """CRC-32 of every byte (reflected polynomial EDB88320)."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC = _crc_table()


def checksums(data: np.ndarray, start_state: np.ndarray, starts: np.ndarray, ends: np.ndarray
              ) -> np.ndarray:
    """CRC-32 of each byte range, each carried on from its own state, byte by byte for all."""
    out = start_state ^ np.uint32(0xFFFFFFFF)
    size = ends - starts
    for i in np.flatnonzero(size > LONG_RUN):
        out[i] = zlib.crc32(data[starts[i]:ends[i]].tobytes(), int(start_state[i])) ^ 0xFFFFFFFF
    active = np.flatnonzero(size <= LONG_RUN)
    for j in range(LONG_RUN):
        active = active[size[active] > j]
        if not len(active):
            break
        state = out[active]
        out[active] = CRC[(state ^ data[starts[active] + j]) & 0xFF] ^ (state >> np.uint32(8))
    return out ^ np.uint32(0xFFFFFFFF)


def counted_words(ids: list, texts: pa.Array) -> Iterator[tuple[str, int]]:
    """``(word, occurrences)`` of a chunk of texts, words of at least ``LEAST_LETTERS``."""
    data, offsets = _text.column_bytes(texts)
    rows, starts, ends = letter_runs(data, offsets)
    if not len(rows):
        return
    letters = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    long = letters[ends] - letters[starts] >= LEAST_LETTERS
    rows, starts, ends = rows[long], starts[long], ends[long]
    lowered = data.copy()
    lowered[(data >= 65) & (data <= 90)] |= 0x20
    state = np.array([zlib.crc32(f"{'' if i is None else i}:".encode()) for i in ids], np.uint32)
    check = checksums(lowered, state[rows], starts, ends)
    cut = check % DROP_EVERY == 0
    raw = lowered.tobytes()
    for i in np.flatnonzero(cut):
        word = raw[starts[i]:ends[i]].decode()
        at = int(check[i]) % len(word)
        if len(word) > LEAST_LETTERS:
            yield word[:at] + word[at + 1:], 1
    starts, ends = starts[~cut], ends[~cut]
    hashes = _text.range_hash(_text.prefix_hash(lowered, fold=False), starts, ends)
    _, first, times = np.unique(hashes, return_index=True, return_counts=True)
    for a, b, n in zip(starts[first].tolist(), ends[first].tolist(), times.tolist()):
        yield raw[a:b].decode(), n


def vocabulary(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)``: words of at least seven letters that occur at least twice overall."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, int] = {}
        for part in parts:
            for low, high in _text.chunks(part.column(1)):
                ids = part.column(0).slice(low, high - low).to_pylist()
                for word, n in counted_words(ids, part.column(1).slice(low, high - low)):
                    held[word] = held.get(word, 0) + n
                if len(held) >= HELD_WORDS:
                    yield _counts(held)
                    held = {}
        yield _counts(held)

    rows = docs.select(F.col(f"`{id_col}`").cast("string"), F.col(f"`{text_col}`").cast("string"))
    return (rows.mapInArrow(batches, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT))


def _counts(held: dict[str, int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()),
                                       pa.array(list(held.values()), pa.int64())], names=["word", "n"])


def bigrams(word: str) -> list[str]:
    return [word[i:i + 2] for i in range(len(word) - 1)]


def bigram_frequency(words: DataFrame) -> dict[str, int]:
    """Occurrences of each bigram in the distinct words, summed per task first.

    At most 90 letters make at most 8,100 bigrams, whatever the input.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        for part in parts:
            for word in part.column(0).to_pylist():
                found.update(bigrams(word))
        yield _counts(found)

    sums = (words.select("word").mapInArrow(batches, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))
    return {r["word"]: r["n"] for r in sums.collect()}


def prefix_positions(order: list[int]) -> tuple[list[int], list[int]]:
    """Positions of the ``PREFIX`` rarest bigrams (``order``: rank per position, ties from
    the left), and these with further bigrams that tie with the last.

    An edit makes at most two new bigrams, so an intact bigram of one word's prefix is
    among the first ``PREFIX + 2`` of a near word: two ties are enough, even in a word
    that repeats one letter.
    """
    ranked = heapq.nsmallest(PREFIX + 2, range(len(order)), key=lambda i: (order[i], i))
    last = order[ranked[min(PREFIX, len(ranked)) - 1]]
    return sorted(ranked[:PREFIX]), [i for i in ranked if order[i] <= last]


def pivots(positions: list[int], weight: list[int], edits: int = 1) -> list[int]:
    """``edits + 1`` disjoint bigrams among ascending ``positions`` of least summed weight.

    ``best[i]`` is the cheapest choice of the current length that ends at the i-th
    position; a longer one extends the cheapest that ends two letters earlier or more.
    """
    best = [(weight[p], (p,)) for p in positions]
    for _ in range(edits):
        longer, cheapest, at = [], NONE, 0
        for p in positions:
            while positions[at] + 2 <= p:
                cheapest = min(cheapest, best[at])
                at += 1
            longer.append((cheapest[0] + weight[p], (*cheapest[1], p)))
        best = longer
    return list(min(best)[1])


class Spans:
    """Hashes of any stretch of a word in constant time, so a long word costs no more per key."""

    power = [1]

    def __init__(self, word: str):
        self.size = len(word)
        self.sums = [0]
        for c in word:
            self.sums.append((self.sums[-1] * BASE + ord(c)) % PRIME)
        while len(self.power) <= self.size:
            self.power.append(self.power[-1] * BASE % PRIME)

    def key(self, kind: int, end: int, near: int, far: int) -> int:
        """Of the first ``near`` letters, the last ``far`` ones and where the bigram ends."""
        tail = (self.sums[self.size] - self.sums[self.size - far] * self.power[far]) % PRIME
        return ((self.sums[near] * BASE + tail) * BASE + 4 * end + kind) % PRIME

    def asked(self, side: int, at: int) -> list[int]:
        """Keys by which the word looks for partners that differ after its bigram at ``at``."""
        end = at + 2
        half = (self.size - end) // 2
        return [self.key(side, end, end + half, 0),
                self.key(side + 1, end, end, self.size - end - half)]

    def answers(self, side: int, at: int) -> set[int]:
        """Keys by which partners of its own length, one less and one more find the word."""
        end, out = at + 2, set()
        rest = self.size - end
        for theirs in (rest - 1, rest, rest + 1):
            half = theirs // 2
            if 0 <= half <= rest:
                out.add(self.key(side, end, end + half, 0))
            if 0 <= theirs - half <= rest:
                out.add(self.key(side + 1, end, end, theirs - half))
        return out


def signatures(words: DataFrame, frequency: dict[str, int]) -> DataFrame:
    """``(word, last, parity, asked, answers)``: the rank that ends a word's prefix, the
    parity of its letters, the keys of its pivots and those of its prefix."""
    rank = {g: i for i, g in enumerate(sorted(frequency, key=lambda g: (frequency[g], g)))}

    def row(word: str) -> tuple:
        grams = bigrams(word)
        order = [rank[g] for g in grams]
        prefix, indexed = prefix_positions(order)
        first, second = pivots(prefix, [frequency[g] for g in grams])
        ahead, back, turn = Spans(word), Spans(word[::-1]), len(word) - 2
        parity = 0
        for c in word:
            parity ^= 1 << (ord(c) & 63)
        asked = ahead.asked(0, first) + back.asked(2, turn - second)
        answers = [k for p in indexed for k in (*ahead.answers(0, p), *back.answers(2, turn - p))]
        return (word, max(order[p] for p in prefix), parity - (1 << 64) if parity >> 63 else parity,
                asked, answers)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            columns = list(zip(*map(row, part.column(0).to_pylist()))) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (
                    pa.string(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64())))],
                names=["word", "last", "parity", "asked", "answers"])

    return words.select("word").mapInArrow(
        batches, "word string, last int, parity bigint, asked array<bigint>, answers array<bigint>")


def near_pairs(signed: DataFrame) -> DataFrame:
    """``(a, b)`` for every two near words, in both directions."""
    def side(keys: str, prefix: str) -> DataFrame:
        return signed.select(F.explode(keys).alias("key"), *[
            F.col(c).alias(prefix + c) for c in ("word", "last", "parity")])

    long = F.length("x_word") > LONG_RUN
    found = side("asked", "x_").join(side("answers", "y_"), "key").filter(
        (F.col("y_last") >= F.col("x_last"))
        & (F.bit_count(F.col("x_parity").bitwiseXOR(F.col("y_parity"))) <= 2)
        & (F.abs(F.length("x_word") - F.length("y_word")) <= 1)
        & F.when(long, F.col("x_word") != F.col("y_word"))
        .otherwise(F.levenshtein("x_word", "y_word", 1) == 1))
    pairs = (found.select(F.explode(F.array(
        F.struct(F.col("x_word").alias("a"), F.col("y_word").alias("b")),
        F.struct(F.col("y_word").alias("a"), F.col("x_word").alias("b")))).alias("p"))
        .select("p.*").distinct())
    return pairs.mapInArrow(_long_ones_verified, "a string, b string")


def _long_ones_verified(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of long words that are near, and all others: Spark's edit distance takes the
    product of the lengths, this check their sum."""
    for part in parts:
        keep = np.ones(part.num_rows, bool)
        for i in np.flatnonzero(pc.utf8_length(part.column(0)).to_numpy() >= LONG_RUN):
            a, b = part.column(0)[int(i)].as_py(), part.column(1)[int(i)].as_py()
            keep[i] = one_edit(a, b)
        yield part.filter(pa.array(keep))


def one_edit(a: str, b: str) -> bool:
    """True if one inserted, deleted or replaced letter turns ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    same = len(os.path.commonprefix([a, b]))
    return a[same + (len(a) >= len(b)):] == b[same + (len(b) >= len(a)):]


def rooted(forms: DataFrame, scratch) -> DataFrame:
    """``(word, root)``: the last of the forms that follow a word with a form.

    Paths are doubled: each step joins a word's farthest form with that form's. A form's
    count is ten times its word's, so no path has twenty forms and six steps always do.
    """
    while True:
        further = forms.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = scratch.save(forms.join(further, "root", "left")
                              .select("word", F.coalesce("next", "root").alias("root"),
                                      F.col("next").isNotNull().alias("moved")))
        forms = joined.select("word", "root")
        if joined.filter("moved").isEmpty():
            return forms


def variants(docs: DataFrame, scratch, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per word: ``(word, form, root, n, n_near, form_n)``.

    ``form`` is the near word of largest count (ties: smallest) if it occurs at least ten
    times as often, else NULL; ``root`` follows forms to the last one.

    NULL and empty texts hold no words. A NULL id counts as an empty one where runs are
    checksummed. Repeated rows count again, other columns are ignored, long runs of
    letters are words like any other; an empty table gives no rows.
    """
    words = scratch.save(vocabulary(docs, id_col, text_col))
    signed = scratch.save(signatures(words, bigram_frequency(words)))
    pairs = scratch.save(near_pairs(signed))
    best = (pairs.join(words.select(F.col("word").alias("b"), "n"), "b")
            .groupBy("a").agg(F.count(F.lit(1)).alias("n_near"),
                              F.min(F.struct((-F.col("n")).alias("n"), "b")).alias("best"))
            .select(F.col("a").alias("word"), "n_near", (-F.col("best.n")).alias("form_n"),
                    F.col("best.b").alias("form")))
    told = (F.col("form_n") >= FORM_RATIO * F.col("n"))
    known = scratch.save(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(told, F.col("form")).alias("form"), F.when(told, F.col("form_n")).alias("form_n")))
    roots = rooted(known.filter("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch)
    return (known.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
