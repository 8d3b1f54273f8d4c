"""An FM-index over runs of symbols: wavelet matrix, backward search, sampled positions."""

from __future__ import annotations

import numpy as np

#: Positions are kept for one in so many symbols of a run, and for its first.
SAMPLE = 16


class Bits:
    """A sequence of bits that counts the ones before any place."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.zeros(len(bits) // 64 + 1, dtype=np.uint64)
        self.words.view(np.uint8)[: len(packed)] = packed
        self.before = np.zeros(len(self.words) + 1, dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words), out=self.before[1:])

    def ones(self, at: np.ndarray) -> np.ndarray:
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        below = self.words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        return self.before[word] + np.bitwise_count(below)

    def __getitem__(self, at: np.ndarray) -> np.ndarray:
        return ((self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


class Wavelet:
    """Counts of any symbol before any place, by one sequence of bits for each binary digit."""

    def __init__(self, values: np.ndarray, symbols: int):
        self.levels = []
        for shift in reversed(range(max(1, int(symbols - 1).bit_length()))):
            bit = (values >> shift) & 1 == 1
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            values = np.concatenate((values[~bit], values[bit]))
        # Where each symbol's places begin in the last order.
        every = np.arange(symbols)
        self.first = self._sink(every, np.zeros(symbols, dtype=np.int64))

    def _sink(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.ones(at)
            at = np.where((symbols >> shift) & 1 == 1, zeros + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._sink(symbols, at) - self.first[symbols]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before."""
        found = np.zeros(len(at), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            one, ones = bits[at], bits.ones(at)
            found |= one.astype(np.int64) << shift
            at = np.where(one, zeros + ones, at - ones)
        return found, at - self.first[found]


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Zeros end runs: each differs from all others, the earlier is less.

    Orders by one symbol, then two, four and so on, each time only those still tied.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    placed = symbols[order]
    head = np.ones(n, dtype=bool)
    head[1:] = (placed[1:] != placed[:-1]) | (placed[1:] == 0)
    rank = np.empty(n, dtype=np.int64)
    slots, width = np.arange(n), 1
    rank[order] = np.maximum.accumulate(np.where(head, slots, 0))
    while True:
        alone = head & np.append(head[1:], True)
        slots = slots[~alone]
        if not len(slots):
            return order
        tied = order[slots]
        key = (rank[tied] << 32) | rank[tied + width]
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        order[slots] = tied
        head = np.ones(len(slots), dtype=bool)
        head[1:] = key[1:] != key[:-1]
        rank[tied] = np.maximum.accumulate(np.where(head, slots, 0))
        width *= 2


class FmIndex:
    """Index of ``symbols``: runs of numbers from 1 to ``largest``, each ended by a zero."""

    def __init__(self, symbols: np.ndarray, largest: int):
        order = suffix_order(symbols)
        self.size = len(symbols)
        counts = np.bincount(symbols, minlength=largest + 1)
        self.less = np.cumsum(counts) - counts
        self.wavelet = Wavelet(symbols[order - 1] if self.size else symbols, largest + 1)
        starts = np.ones(self.size, dtype=bool)
        starts[1:] = symbols[:-1] == 0
        kept = (starts | (np.arange(self.size) % SAMPLE == 0))[order]
        self.sampled, self.positions = Bits(kept), order[kept]

    def search(self, flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows [low, high) of the suffixes that begin with each phrase ``flat[start : start + length]``."""
        low, high = np.zeros(len(starts), dtype=np.int64), np.full(len(starts), self.size, dtype=np.int64)
        step, open_ = 1, np.arange(len(starts))
        while len(open_):
            symbol = flat[starts[open_] + lengths[open_] - step]
            low[open_] = self.less[symbol] + self.wavelet.rank(symbol, low[open_])
            high[open_] = self.less[symbol] + self.wavelet.rank(symbol, high[open_])
            open_ = open_[(low[open_] < high[open_]) & (lengths[open_] > step)]
            step += 1
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Where each row's suffix begins: steps back to a sampled one, counted."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows.copy(), 0
        while len(open_):
            done = self.sampled[at]
            found[open_[done]] = self.positions[self.sampled.ones(at[done])] + steps
            open_, at = open_[~done], at[~done]
            symbol, before = self.wavelet.symbol_and_rank(at)
            at, steps = self.less[symbol] + before, steps + 1
        return found
