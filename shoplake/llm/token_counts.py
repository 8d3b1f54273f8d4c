"""Token counts: best unigram segmentation, computed once per shared prefix of a trie."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoplake.llm.common import slices
from shoplake.llm.vocabulary import PIECES, Vocabulary, coded_pre_tokens, load

#: Terminal counts that a task remembers between batches; results don't depend on it.
MAX_KNOWN = 500_000


class Trie:
    """Token counts of distinct pre-tokens, which are inserted in sorted order.

    A node is a prefix: its score and tokens belong to its best segmentation
    (greatest sum of piece scores, then fewest tokens), found from those of shorter
    prefixes when the node is made. In sorted order a node is done with once the
    next pre-token leaves it, so only the open branch is held; every prefix that a
    batch's pre-tokens share is still computed once. Terminals keep their count.
    """

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.unknown = vocabulary.unknown
        #: Score of every piece; None for what only ends a piece.
        self.scores: dict[str, float | None] = {p[i:]: None for p in vocabulary.pieces for i in range(1, len(p))}
        self.scores |= {p: s for p, (_, s) in vocabulary.pieces.items()}
        self.terminal: dict[str, int] = {}

    def counts(self, words: list[str]) -> np.ndarray:
        """Tokens of each of the distinct pre-tokens."""
        if len(self.terminal) > MAX_KNOWN:
            self.terminal.clear()
        terminal = self.terminal
        self._insert(sorted(w for w in words if w not in terminal))
        return np.fromiter(map(terminal.__getitem__, words), dtype=np.int64, count=len(words))

    def _insert(self, words: list[str]) -> None:
        scores, unknown, terminal = self.scores, self.unknown, self.terminal
        score, tokens = [0.0], [0]  # of the open branch, by depth
        last = ""
        for word in words:
            depth, most = 0, min(len(last), len(word))
            while depth < most and last[depth] == word[depth]:
                depth += 1
            del score[depth + 1 :], tokens[depth + 1 :]
            for end in range(depth + 1, len(word) + 1):
                letter = word[end - 1]
                s = scores.get(letter)
                if s is not None:
                    best, least = score[-1] + s, tokens[-1] + 1
                else:
                    best, least = score[-1] + unknown, tokens[-1] + len(letter.encode(errors="surrogatepass"))
                for start in range(end - 2, -1, -1):
                    s = scores.get(word[start:end], False)
                    if s is False:  # ends no piece, so no longer part does
                        break
                    if s is not None:
                        way = score[start] + s
                        if way > best or way == best and tokens[start] + 1 < least:
                            best, least = way, tokens[start] + 1
                score.append(best)
                tokens.append(least)
            terminal[word] = tokens[-1]
            last = word


def token_counts(docs: DataFrame, path: str = PIECES) -> DataFrame:
    """Tokens of every text under a subword vocabulary: doc_id, n_pretokens, n_tokens.

    The vocabulary file's own scores rank the segmentations; a character outside the
    vocabulary counts its UTF-8 bytes. Null and empty texts have 0 tokens. Repeated
    rows are counted each; other columns are not read. Nothing is shuffled: a task
    streams its rows, and holds one slice of text and a bounded table of counts.
    """
    vocabulary = load(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie(vocabulary)
        for batch in slices(batches, "text"):
            offsets, codes, words = coded_pre_tokens(batch.column("text"))
            upto = np.concatenate([[0], np.cumsum(trie.counts(words)[codes])])
            parts, tokens = np.diff(offsets), upto[offsets[1:]] - upto[offsets[:-1]]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(parts, pa.int64()), pa.array(tokens, pa.int64())],
                ["doc_id", "n_pretokens", "n_tokens"],
            )

    ids = F.col("doc_id").cast("long").alias("doc_id")
    return docs.select(ids, "text").mapInArrow(run, "doc_id long, n_pretokens long, n_tokens long")
