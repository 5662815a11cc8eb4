"""The vocabulary of a SentencePiece model file, read for our own encoders.

Only the file is used (its pieces, scores and kinds); the ``sentencepiece``
encoder itself is called by tests alone, as the yardstick.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

SPACE = "▁"
_LATIN = "A-Za-zÀ-ÖØ-öø-ʯ"


@dataclass(frozen=True)
class Vocabulary:
    """``rank``: piece -> merge rank (0 best) of ordinary pieces; ``ids``: piece -> id;
    ``scores``: id -> the file's score; ``byte_ids``: byte value -> id of its fallback piece."""

    pieces: tuple[str, ...]
    ids: dict[str, int]
    scores: tuple[float, ...]
    rank: dict[str, float]
    byte_ids: tuple[int, ...]
    bpe: bool
    chunk: re.Pattern


@functools.cache
def load(path: str) -> Vocabulary:
    """Read ``path`` once per process. Raises on a normaliser other than plain
    "prefix a space, keep every space" and on vocabularies with frozen user pieces."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as fh:
        model.ParseFromString(fh.read())
    norm, trainer = model.normalizer_spec, model.trainer_spec
    if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only identity-normalised models are supported")
    kinds = [p.type for p in model.pieces]
    if any(k in (4, 5) for k in kinds):
        raise ValueError("user-defined and unused pieces are not supported")
    pieces = tuple(p.piece for p in model.pieces)
    ids = {p: i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == 1}
    scores = tuple(p.score for p in model.pieces)
    by_byte = {int(p[3:5], 16): i for i, (p, k) in enumerate(zip(pieces, kinds)) if k == 6}
    if len(by_byte) != 256:
        raise ValueError("the model needs all 256 byte pieces")
    return Vocabulary(pieces, ids, scores, {p: -scores[i] for p, i in ids.items()},
                      tuple(by_byte[b] for b in range(256)),
                      trainer.model_type == trainer.BPE, _chunk_pattern(ids))


def _chunk_pattern(ids: dict[str, int]) -> re.Pattern:
    """Cut a normalised text where no piece of the vocabulary can reach across.

    Runs of Latin letters, digits and other characters are separate chunks (each
    with the space marks before it) if no piece mixes them; that is checked here,
    and otherwise a chunk is a whole word with its space marks.
    """
    fine = re.compile(f"{SPACE}*(?:[{_LATIN}]+|[0-9]+|[^{SPACE}0-9{_LATIN}]+)|{SPACE}+", re.S)
    if all(fine.fullmatch(p) for p in ids):
        return fine
    whole = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+", re.S)
    if all(whole.fullmatch(p) for p in ids):
        return whole
    return re.compile(".+", re.S)


def normalise(text: str) -> str:
    """What the library encodes: one space mark before the text, one for every space."""
    return SPACE + text.replace(" ", SPACE) if text else ""
