"""Pieces and scores of an existing subword vocabulary."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa

SPACE = "▁"

#: A path of the vocabulary file is a parameter everywhere; this one is the box's.
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


@dataclass(frozen=True)
class Vocabulary:
    """Ordinary pieces with id and score, the ids of single bytes, and the unknown id."""

    pieces: dict[str, tuple[int, float]]
    bytes: list[int]
    longest: int = field(default=0)
    #: Score of a character that no piece spells; it becomes its UTF-8 bytes.
    unknown: float = field(default=0.0)
    #: The file, by which vocabularies are told apart.
    path: str = ""

    def __hash__(self) -> int:
        return hash(self.path)

    def __eq__(self, other: object) -> bool:
        return isinstance(other, Vocabulary) and (self.path, len(self.pieces)) == (other.path, len(other.pieces))


def load(path: str = PIECES) -> Vocabulary:
    """Read a SentencePiece model file that has byte pieces. Nothing is trained."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    pieces, byte_ids = {}, [0] * 256
    for i in range(model.vocab_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[1:-1], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            pieces[model.id_to_piece(i)] = (i, float(model.get_score(i)))
    if any(re.search(rf"\n|[^{SPACE}]{SPACE}", p) for p in pieces):
        raise ValueError("a piece spans the border of two pre-tokens")
    usual = [s for _, s in pieces.values() if s > -1e8]
    return Vocabulary(pieces, byte_ids, max(map(len, pieces)), min(usual) - 10, path)


#: Runs of spaces with what follows, line ends, and the rest: no piece crosses them.
_PRE_TOKEN = re.compile(rf"{SPACE}+[^{SPACE}\n]*|\n|[^{SPACE}\n]+")


def escaped(text: str | None) -> str:
    """A space before the text and a mark for each space, as the vocabulary has them; null is empty."""
    return SPACE + text.replace(" ", SPACE) if text else ""


def pre_tokens(text: str | None) -> list[str]:
    """Parts of the escaped text that can be segmented apart from each other."""
    return _PRE_TOKEN.findall(escaped(text))


def coded_pre_tokens(text: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Offsets of each text's pre-tokens, their codes, and the distinct pre-tokens by code."""
    parts: list[str] = []
    offsets = [0]
    for t in text.to_pylist():
        parts.extend(pre_tokens(t))
        offsets.append(len(parts))
    coded = pa.array(parts, pa.string()).dictionary_encode()
    return np.array(offsets), coded.indices.to_numpy(), coded.dictionary.to_pylist()
