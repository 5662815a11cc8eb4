"""Quality classifier (operator 5): a generalised additive model with pairs.

Each text becomes a dozen and a half numeric features (shares of character
kinds, repetition, word and line shapes). The model adds one lookup table per
feature and one per chosen pair of features over quantile bins. Tables are
learned by cyclic boosting: round after round, every feature in turn (then every
pair) gets one shallow tree fitted to the gradient of the logistic loss, scaled
by a small rate and added to its table. Pairs are chosen by how much loss the
best two-cut tree takes off the residual of the main effects.

Scoring is bin lookups and additions on whole Arrow batches. Only training sees
labels, on at most ``MAX_ROWS`` labelled rows (a documented bound: those with
the smallest hash of their id); features and scores cover all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text
from ._text import U64

MAX_ROWS = 20_000
BINS = 32
PAIR_BINS = 8
ROUNDS = 120
PAIR_ROUNDS = 40
PAIRS = 6
RATE = 0.15
RIDGE = 5.0
CUTOFF = 0.3

FEATURES = ("log_bytes", "log_words", "word_bytes", "log_longest_word", "upper", "digit",
            "punctuation", "symbol", "exclamation", "bar", "beyond_ascii", "stops_per_word",
            "lines_per_word", "same_as_previous", "distinct_words", "repeated_threes",
            "one_byte_words", "capital_words")


def _share(mask: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(mask, dtype=np.int64)]
    return (total[offsets[1:]] - total[offsets[:-1]]).astype(float)


def _table(members: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[[ord(c) for c in members]] = True
    return out


_UPPER, _DIGIT = _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _table("0123456789")
_SYMBOL, _EXCLAMATION, _BAR = _table("#*$%&|<>"), _table("!?"), _table("|")
_STOP, _LINE = _table("."), _table("\n")


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``(rows, len(FEATURES))`` of a chunk of texts; an empty text has only zeros."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    rows, starts, ends = _text.words(data, offsets, _text.space_table())
    per_row = lambda mask: np.bincount(rows[mask], minlength=n).astype(float)
    count = np.bincount(rows, minlength=n).astype(float)
    width = ends - starts
    by_byte, by_word = np.maximum(size, 1), np.maximum(count, 1)
    longest = np.zeros(n)
    out = np.zeros((n, len(FEATURES)))
    if len(rows):
        np.maximum.at(longest, rows, width)
        hashes = _text.range_hash(_text.prefix_hash(data, fold=False), starts, ends)
        same = np.r_[False, (hashes[1:] == hashes[:-1]) & (rows[1:] == rows[:-1])]
        distinct = _distinct(rows, hashes, n)
        three_rows, threes = _text.shingles(hashes, rows, 3)
        windows = np.bincount(three_rows, minlength=n).astype(float)
        repeated = windows - _distinct(three_rows, threes, n)
        out[:] = np.stack([
            np.log1p(size), np.log1p(count), _share(~_text.space_table()[data], offsets) / by_word,
            np.log1p(longest), _share(_UPPER[data], offsets) / by_byte,
            _share(_DIGIT[data], offsets) / by_byte,
            _share(_text.punctuation_table()[data] & ~_text.space_table()[data], offsets) / by_byte,
            _share(_SYMBOL[data], offsets) / by_byte, _share(_EXCLAMATION[data], offsets) / by_byte,
            _share(_BAR[data], offsets) / by_word, _share(data > 127, offsets) / by_byte,
            _share(_STOP[data], offsets) / by_word, _share(_LINE[data], offsets) / by_word,
            per_row(same) / by_word, distinct / by_word, repeated / np.maximum(windows, 1),
            per_row(width == 1) / by_word, per_row(_UPPER[data[starts]]) / by_word], axis=1)
    return out


def _distinct(rows: np.ndarray, hashes: np.ndarray, n: int) -> np.ndarray:
    order = np.lexsort((hashes, rows))
    r, h = rows[order], hashes[order]
    new = np.r_[True, (r[1:] != r[:-1]) | (h[1:] != h[:-1])] if len(r) else np.zeros(0, bool)
    return np.bincount(r[new], minlength=n).astype(float)


def feature_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(__id, features array<double>)`` of every whole text (NULL: empty)."""
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = len(FEATURES)
        for part in parts:
            ids, texts = part.columns
            found = [features(*_text.column_bytes(texts.slice(a, b - a)))
                     for a, b in _text.chunks(texts)]
            flat = np.concatenate(found).ravel() if found else np.zeros(0)
            at = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * width)
            yield pa.RecordBatch.from_arrays(
                [ids, pa.ListArray.from_arrays(at, pa.array(flat))], names=["__id", "features"])

    rows = docs.select(F.col(f"`{id_col}`").alias("__id"),
                       F.col(f"`{text_col}`").cast("string").alias("__text"))
    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"__id {kind}, features array<double>")


@dataclass
class Model:
    """Bin edges per feature, a table per feature, and a table per chosen pair."""

    intercept: float
    edges: list[np.ndarray]
    coarse: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for (a, b), table in zip(self.pairs, self.pair_tables):
            total += table[np.searchsorted(self.coarse[a], x[:, a], "right"),
                           np.searchsorted(self.coarse[b], x[:, b], "right")]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _edges(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1]))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _shallow_tree(g: np.ndarray, h: np.ndarray, depth: int = 2) -> np.ndarray:
    """Leaf value per bin of a greedy tree of ``depth`` over binned gradients."""
    if depth and len(g) > 1:
        left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
        gain = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h)
        cut = int(gain.argmax())
        if gain[cut] > _gain(g.sum(), h.sum()) + 1e-9:
            return np.r_[_shallow_tree(g[:cut + 1], h[:cut + 1], depth - 1),
                         _shallow_tree(g[cut + 1:], h[cut + 1:], depth - 1)]
    return np.full(len(g), -g.sum() / (h.sum() + RIDGE))


def _two_cuts(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Best tree of one cut on each of two features: ``(gain, value per cell)``."""
    gs, hs = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    if min(g.shape) < 2:
        return 0.0, np.zeros(g.shape)
    quads = []
    for s in (gs, hs):
        a, right, low, all_ = s[:-1, :-1], s[:-1, -1:], s[-1:, :-1], s[-1, -1]
        quads.append((a, right - a, low - a, all_ - right - low + a))
    gain = sum(_gain(qg, qh) for qg, qh in zip(*quads))
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [-(qg[i, j]) / (qh[i, j] + RIDGE) for qg, qh in zip(*quads)]
    out = np.empty(g.shape)
    out[:i + 1, :j + 1], out[:i + 1, j + 1:], out[i + 1:, :j + 1], out[i + 1:, j + 1:] = values
    return float(gain[i, j] - _gain(gs[-1, -1], hs[-1, -1])), out


def train(x: np.ndarray, y: np.ndarray) -> Model:
    """Fit the model to features and 0/1 labels (no rows or one class: a constant)."""
    prior = (y.sum() + 1) / (len(y) + 2)
    intercept = float(np.log(prior / (1 - prior)))
    width = len(FEATURES)
    if not len(y) or y.min() == y.max():
        none = [np.zeros(0)] * width
        return Model(intercept, none, none, [np.zeros(1)] * width, [], [])
    edges = [_edges(x[:, j], BINS) for j in range(width)]
    coarse = [_edges(x[:, j], PAIR_BINS) for j in range(width)]
    bins = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(edges)]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    logit = np.full(len(y), intercept)

    def gradients() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-logit))
        return p - y, np.maximum(p * (1 - p), 1e-6)

    for _ in range(ROUNDS):
        for j in range(width):
            g, h = gradients()
            size = len(tables[j])
            step = RATE * _shallow_tree(np.bincount(bins[j], g, size), np.bincount(bins[j], h, size))
            tables[j] += step
            logit += step[bins[j]]

    shapes = [len(e) + 1 for e in coarse]

    def grid(pair: tuple[int, int]) -> tuple[float, np.ndarray]:
        a, b = pair
        shape = (shapes[a], shapes[b])
        at = cells[a] * shapes[b] + cells[b]
        g, h = gradients()
        return _two_cuts(np.bincount(at, g, shape[0] * shape[1]).reshape(shape),
                         np.bincount(at, h, shape[0] * shape[1]).reshape(shape))

    strength = sorted(((grid(p)[0], p) for p in combinations(range(width), 2)), reverse=True)
    pairs = [p for gain, p in strength[:PAIRS] if gain > 0]
    pair_tables = [np.zeros((shapes[a], shapes[b])) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            step = RATE * grid((a, b))[1]
            pair_tables[k] += step
            logit += step[cells[a], cells[b]]
    return Model(intercept, edges, coarse, tables, pairs, pair_tables)


def held_out(id_col: str):
    """The fixed fold that training never sees: crc32 of the id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def fit(rows: DataFrame, labels: DataFrame, id_col: str, label_col: str,
        max_rows: int = MAX_ROWS) -> Model:
    """Train on at most ``max_rows`` labelled rows outside the held-out fold.

    Labels other than 0 and 1 are no labels; of several labels of one id the
    largest counts. Only features reach the model.
    """
    known = (labels.select(F.col(f"`{id_col}`").alias("__id"),
                           F.col(f"`{label_col}`").cast("int").alias("y"))
             .filter("__id is not null and y in (0, 1)").groupBy("__id").agg(F.max("y").alias("y"))
             .filter(~held_out("__id")))
    sample = (rows.join(known, "__id").orderBy(F.xxhash64("__id"), "__id").limit(max_rows)
              .select("features", "y").toPandas())
    if not len(sample):
        return train(np.zeros((0, len(FEATURES))), np.zeros(0))
    return train(np.stack(sample["features"].to_list()), sample["y"].to_numpy(float))


def apply(rows: DataFrame, model: Model) -> DataFrame:
    """``(__id, score)``: bin lookups and additions over Arrow batches."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            ids, lists = part.columns
            x = lists.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), len(FEATURES))
            yield pa.RecordBatch.from_arrays([ids, pa.array(shared.value.score(x))],
                                             names=["__id", "score"])

    kind = rows.schema["__id"].dataType.simpleString()
    return rows.mapInArrow(batches, f"__id {kind}, score double")


def classify(docs: DataFrame, labels: DataFrame, scratch, id_col: str = "doc_id",
             text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS,
             cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: ``(id, held_out, score, predicted)``.

    Features are computed once and kept in ``scratch`` for training and scoring.
    NULL and empty texts score like any text (all features 0). NULL ids are never
    held out nor trained on; repeated rows keep a row each; other columns are
    ignored; without labels every score is the prior 1/2.
    """
    rows = scratch.save(feature_rows(docs, id_col, text_col))
    scores = apply(rows, fit(rows, labels, id_col, label_col, max_rows))
    return scores.select(F.col("__id").alias(id_col), held_out("__id").alias("held_out"), "score",
                         (F.col("score") >= cutoff).cast("int").alias("predicted"))
