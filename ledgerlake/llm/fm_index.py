"""An FM-index over the words of one shard of texts, in numpy.

Words that no query holds end every match, so each of them is a sentinel of its own: the suffix
order is settled after the run of known words that a suffix begins with, in a few doublings.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 16


def suffix_order(symbols: np.ndarray) -> np.ndarray:
    """The suffix array of `symbols`; zeros are sentinels, smaller the further left they are."""
    n = len(symbols)
    ends = symbols == 0
    rank = symbols.astype(np.int64) + np.int64(n)
    rank[ends] = np.arange(n)[ends]
    step = 1
    while True:
        following = np.full(n, -1, np.int64)
        following[:n - step] = rank[step:]
        # behind a sentinel nothing counts: its rank is its own already
        key = rank * np.int64(2 * n + int(symbols.max(initial=0)) + 2) + following + 1
        order = np.argsort(key, kind="stable")
        sorted_key = key[order]
        new = np.empty(n, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_key[1:] != sorted_key[:-1])])
        if n == 0 or new[order[-1]] == n - 1:
            return order
        rank, step = new, step * 2


class WaveletRanks:
    """How often a symbol occurs before a position: one bit vector with counts for each bit."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self._levels: list[tuple[np.ndarray, int]] = []
        for bit in range(bits - 1, -1, -1):
            ones = ((symbols >> bit) & 1).astype(bool)
            before = np.zeros(len(symbols) + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self._levels.append((before, len(symbols) - int(before[-1])))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self._bits = bits

    def rank(self, symbol: np.ndarray, position: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        low, high = np.zeros_like(position), position.copy()
        for i, (before, zeros) in enumerate(self._levels):
            one = ((symbol >> (self._bits - 1 - i)) & 1).astype(bool)
            low_ones, high_ones = before[low], before[high]
            low = np.where(one, zeros + low_ones, low - low_ones)
            high = np.where(one, zeros + high_ones, high - high_ones)
        return high - low

    def symbol_and_rank(self, position: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each position, and how often it occurs before it."""
        low, at = np.zeros_like(position), position.copy()
        symbol = np.zeros_like(position)
        for before, zeros in self._levels:
            ones = before[at]
            one = before[at + 1] > ones
            low_ones = before[low]
            symbol = symbol * 2 + one
            low = np.where(one, zeros + low_ones, low - low_ones)
            at = np.where(one, zeros + ones, at - ones)
        return symbol, at - low


class FMIndex:
    """Counts and places of short word sequences in the symbols 1..size of a shard; 0 is no word."""

    def __init__(self, symbols: np.ndarray, size: int):
        text = np.concatenate([symbols, [0]])
        order = suffix_order(text)
        last = text[order - 1]
        self._ranks = WaveletRanks(last, max(1, int(size).bit_length()))
        self._before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=size + 1))])
        # no walk back may cross a sentinel, so what follows one is sampled as well
        held = (order % SAMPLE == 0) | (last == 0)
        self._held = np.zeros(len(text) + 1, np.int64)
        np.cumsum(held, out=self._held[1:])
        self._samples = order[held]
        self._n = len(text)

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The interval of suffixes that begin with each phrase (a row of symbols), from behind."""
        low = np.zeros(len(phrases), np.int64)
        high = np.zeros(len(phrases), np.int64)
        alive = np.flatnonzero((phrases > 0).all(1))
        a, b = np.zeros(len(alive), np.int64), np.full(len(alive), self._n, np.int64)
        for column in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, column]
            start = self._before[symbol]
            a, b = start + self._ranks.rank(symbol, a), start + self._ranks.rank(symbol, b)
            found = b > a
            alive, a, b = alive[found], a[found], b[found]
        low[alive], high[alive] = a, b
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The text position of each suffix: back step by step to a sampled one."""
        place, steps = np.full(len(rows), -1, np.int64), 0
        which, at = np.arange(len(rows)), rows.astype(np.int64)
        while len(which):
            held = self._held[at + 1] > self._held[at]
            place[which[held]] = self._samples[self._held[at[held]]] + steps
            which, at = which[~held], at[~held]
            symbol, before = self._ranks.symbol_and_rank(at)
            at, steps = self._before[symbol] + before, steps + 1
        return place
