"""SentencePiece encoding and decoding: pieces are found in a suffix array of the batch."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import slices
from shoplake.llm.vocabulary import PIECES, SPACE, Vocabulary, coded_pre_tokens, load

#: Encoded pre-tokens that a Python worker remembers before it starts anew.
MAX_KNOWN = 150_000

#: Characters of new pre-tokens that one suffix array holds, unless one is longer.
BATCH_CHARS = 1 << 18

#: Text that one step of encoding takes in.
ENCODE_BYTES = 4 << 20


class Encoder:
    """Best segmentations of batches of pre-tokens."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        names = list(vocabulary.pieces)
        self.vocabulary = vocabulary
        self.ids_by_piece = np.array([vocabulary.pieces[p][0] for p in names], dtype=np.int64)
        self.scores = np.array([vocabulary.pieces[p][1] for p in names])
        self.lengths = np.array([len(p) for p in names], dtype=np.int64)
        self.letters = np.zeros((len(names), vocabulary.longest), dtype=np.int64)
        for i, p in enumerate(names):
            self.letters[i, : len(p)] = [ord(c) for c in p]
        self.forget()

    def forget(self) -> None:
        """Drop all encoded pre-tokens."""
        self.known: dict[str, int] = {}
        self.ids_of = np.zeros(0, dtype=np.int32)  # of all known pre-tokens, joined
        self.first = np.zeros(1, dtype=np.int64)  # of each known pre-token, then the end

    def learn(self, words: set[str]) -> None:
        """Encode the pre-tokens that are not known yet."""
        new = [w for w in words if w not in self.known]
        start = size = 0
        for i, w in enumerate(new):
            size += len(w) + 1
            if size > BATCH_CHARS:
                self._encode(new[start : i + 1])
                start, size = i + 1, 0
        if start < len(new):
            self._encode(new[start:])

    def ids(self, words: list[str], codes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of known pre-tokens (or of those that ``codes`` name), joined, and how many each has."""
        at = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        at = at if codes is None else at[codes]
        first, length = self.first[at], self.first[at + 1] - self.first[at]
        ends = np.cumsum(length)
        return self.ids_of[np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - ends + length, length)], length

    def edges(self, words: list[str]) -> tuple[np.ndarray, ...]:
        """Text, starts and ends of the joined ``words``; begin and length of each edge, and its piece or -1."""
        # Every pre-token is followed by 0, which no piece has.
        text = np.frombuffer(("\0".join(words) + "\0").encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        if "\0" in "".join(words):  # a real U+0000 must not end its pre-token
            text = np.array([c for w in words for c in (*(ord(x) or 0x110000 for x in w), 0)], dtype=np.int64)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = ends - np.array([len(w) for w in words])
        suffixes = suffix_array(text, self.vocabulary.longest)
        low, high = ranges(text, suffixes, self.letters, self.lengths)
        # Edges: each occurrence of each piece, then one for each character alone.
        count = high - low
        piece = np.repeat(np.arange(len(count), dtype=np.int32), count)
        begin = suffixes[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count - low, count)].astype(np.int32)
        lone = np.flatnonzero(text != 0)
        lone = lone[~np.isin(text[lone], self.letters[self.lengths == 1, 0])]
        begin = np.concatenate([begin, lone.astype(np.int32)])
        length = np.concatenate([self.lengths.astype(np.int32)[piece], np.ones(len(lone), dtype=np.int32)])
        return text, starts, ends, begin, length, np.concatenate([piece, np.full(len(lone), -1, dtype=np.int32)])

    def _encode(self, words: list[str]) -> None:
        words = sorted(words, key=len, reverse=True)
        text, starts, ends, begin, length, piece = self.edges(words)
        # Characters without a piece stand behind the pieces, by their UTF-8 bytes.
        pieces = len(self.scores)
        name = np.where(piece >= 0, piece, pieces - 1 + utf8_bytes(text[begin])).astype(np.int32)
        gain = np.concatenate([self.scores, np.full(4, self.vocabulary.unknown)])
        parts = np.concatenate([np.ones(pieces, dtype=np.int64), [1, 2, 3, 4]])
        tokens, back, step = relax(len(text), starts, ends, begin, length, name, gain, parts)
        # Walk all best paths back at once, filling the ids from behind.
        last = np.cumsum(tokens[ends])
        out = np.zeros(last[-1], dtype=np.int32)
        place, at, open_ = last.copy(), ends.copy(), np.arange(len(words))
        while len(open_):
            here = at[open_]
            found = back[here]
            place[open_] -= parts[found]
            whole = found < pieces
            out[place[open_][whole]] = self.ids_by_piece[found[whole]]
            for i, e in zip(open_[~whole].tolist(), here[~whole].tolist()):
                spelled = chr(text[e - 1] % 0x110000).encode(errors="surrogatepass")
                out[place[i] : place[i] + len(spelled)] = [self.vocabulary.bytes[b] for b in spelled]
            at[open_] = here - step[here]
            open_ = open_[at[open_] > starts[open_]]
        self.known.update(zip(words, range(len(self.first) - 1, len(self.first) - 1 + len(words))))
        self.first = np.concatenate([self.first, self.first[-1] + last])
        self.ids_of = np.concatenate([self.ids_of, out])


@cache
def _encoder(vocabulary: Vocabulary) -> Encoder:
    """The worker's encoder: tasks that follow each other share what it knows."""
    return Encoder(vocabulary)


def utf8_bytes(codes: np.ndarray) -> np.ndarray:
    codes = np.where(codes == 0x110000, 0, codes)
    return 1 + (codes > 0x7F).astype(np.int64) + (codes > 0x7FF) + (codes > 0xFFFF)


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of all suffixes, sorted by their first ``depth`` characters (and more, up to a power of two)."""
    letters, rank = np.unique(text, return_inverse=True)
    n, width = len(text), 1
    rank = rank.astype(np.int64)
    while width < 4 and (len(letters) + 1) ** (2 * width) < 1 << 62:  # as many letters as fit in one key
        rank = rank * (len(letters) + 1) ** width + _later(rank, width)
        width *= 2
    order = np.argsort(rank)
    while True:
        ordered = rank[order]
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if width >= depth:
            return order
        rank = rank * (n + 1) + _later(rank, width)
        order = np.argsort(rank)
        width *= 2


def _later(rank: np.ndarray, width: int) -> np.ndarray:
    later = np.zeros(len(rank), dtype=np.int64)
    later[:-width] = rank[width:] + 1
    return later


def ranges(text: np.ndarray, suffixes: np.ndarray, letters: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every piece, the part [low, high) of the suffix array that begins with it.

    All pieces are searched at once: letter by letter, two binary searches narrow
    each piece's part to the suffixes that go on with its next letter.
    """
    n = len(text)
    low, high = np.zeros(len(lengths), dtype=np.int64), np.full(len(lengths), n)
    padded = np.concatenate([text, np.zeros(letters.shape[1], dtype=text.dtype)])
    for depth in range(letters.shape[1]):
        open_ = np.flatnonzero((lengths > depth) & (low < high))
        if not len(open_):
            break
        letter, column = letters[open_, depth], padded[suffixes + depth]
        found = []
        for past in (False, True):
            a, b = low[open_], high[open_]
            while (a < b).any():
                middle = (a + b) >> 1
                seen = column[np.minimum(middle, n - 1)]
                before = (seen <= letter if past else seen < letter) & (a < b)
                a, b = np.where(before, middle + 1, a), np.where(before | (a >= b), b, middle)
            found.append(a)
        low[open_], high[open_] = found
    return low, high


def relax(size, starts, ends, begin, length, name, gain, parts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of the best way to every position, and the name and length of its last edge.

    An edge's score is ``gain`` of its name, its tokens are ``parts`` of it. Edges are
    sorted by position into a table with a row for each end and a column for each
    length; all pre-tokens (the longest first) then advance together. Of equal
    scores the way with fewer tokens wins, then the longer last edge.
    """
    longest, none = int(length.max(initial=1)), len(gain)
    table = np.full((size, longest), none, dtype=np.int32)
    table[begin + length, longest - length] = name
    gain, parts = np.append(gain, -np.inf), np.append(parts, 0)
    score, tokens = np.full(size, -np.inf), np.zeros(size, dtype=np.int64)
    back, step = np.full(size, none, dtype=np.int32), np.zeros(size, dtype=np.int64)
    score[starts] = 0.0
    widths = ends - starts
    active = len(starts) - np.searchsorted(widths[::-1], np.arange(1, widths[0] + 1))
    for distance, count in enumerate(active.tolist(), 1):
        steps = np.arange(min(longest, distance), 0, -1)
        at = starts[:count] + distance
        edge = table[at, longest - len(steps) :]
        source = at[:, None] - steps
        reached = score[source] + gain[edge]
        pick, rows = reached.argmax(axis=1), np.arange(count)
        top = reached[rows, pick]
        if len(tied := np.flatnonzero((reached == top[:, None]).sum(axis=1) > 1)):
            came = np.where(reached[tied] == top[tied][:, None], tokens[source[tied]] + parts[edge[tied]], np.iinfo(np.int64).max)
            pick[tied] = came.argmin(axis=1)  # the first of equals is the longest
        chosen = edge[rows, pick]
        score[at], back[at], step[at] = top, chosen, steps[pick]
        tokens[at] = tokens[at - steps[pick]] + parts[chosen]
    return tokens, back, step


def encode(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """Piece ids of every text: doc_id, ids (array of int).

    The segmentation is the one with the greatest sum of the file's scores, then the
    fewest tokens, then the longest last piece. A task's batch of texts is cut at
    borders that no piece crosses; its distinct pre-tokens, joined, are the text that
    the suffix array indexes. Null and empty texts give no ids; repeated rows are
    encoded each; other columns are not read. Nothing is shuffled.
    """
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(vocabulary)
        for batch in slices(batches, "text", ENCODE_BYTES):
            offsets, codes, words = coded_pre_tokens(batch.column("text"))
            if len(encoder.known) > MAX_KNOWN:
                encoder.forget()
            encoder.learn(set(words))
            ids, length = encoder.ids(words, codes)
            borders = np.concatenate([[0], np.cumsum(length)])[offsets]
            lists = pa.ListArray.from_arrays(pa.array(borders, pa.int32()), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str = PIECES) -> DataFrame:
    """Texts of encoded rows: doc_id, ids, text.

    The one space that encoding put before a text is taken off; texts come back
    unchanged, but for U+2581, which stands for a space. No ids, or null,
    give an empty text, so a null text comes back as an empty one. Byte ids that
    don't form UTF-8 become U+FFFD; an id without a spelling is an error.
    """
    vocabulary = load(path)
    spelled: list[bytes | None] = [None] * (1 + max(*vocabulary.bytes, *(i for i, _ in vocabulary.pieces.values())))
    for piece, (i, _) in vocabulary.pieces.items():
        spelled[i] = piece.replace(SPACE, " ").encode()
    for byte, i in enumerate(vocabulary.bytes):
        spelled[i] = bytes([byte])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(spelled, pa.large_binary())
        for batch in batches:
            ids = batch.column("ids")
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, joined(names, ids)], ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, text string")


def joined(names: pa.Array, ids: pa.ListArray) -> pa.Array:
    """The spellings of each list's ids as one text."""
    found = names.take(ids.flatten())
    if found.null_count:
        raise ValueError("an id has no spelling")
    counts = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False))])
    borders = np.frombuffer(found.buffers()[1], dtype=np.int64)[found.offset : found.offset + len(found) + 1]
    data, borders = found.buffers()[2] or pa.py_buffer(b""), borders[counts]
    raw = np.frombuffer(data, dtype=np.uint8)
    begins = borders[:-1].copy()
    full = begins < borders[1:]
    begins[full] += raw[begins[full]] == 32
    texts = [bytes(raw[a:b]) for a, b in zip(begins.tolist(), borders[1:].tolist())]
    return pa.array([t.decode(errors="replace") for t in texts], pa.string())
