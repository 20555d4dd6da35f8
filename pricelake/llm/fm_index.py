"""A compressed FM-index over sequences of integers, for many queries at once.

The Burrows-Wheeler transform is held in a wavelet matrix whose bit vectors are
packed into 64-bit words with one rank count per word. ``matching_statistics``
streams queries through it by backward search, all in lockstep.
"""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank."""

    def __init__(self, bits: np.ndarray):
        self.n = len(bits)
        padded = np.zeros(-(-(self.n + 1) // 64) * 64, np.uint8)
        padded[: self.n] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.before = np.r_[0, np.cumsum(np.bitwise_count(self.words))].astype(np.int32)

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones among the first i bits."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


def sorted_suffixes(text: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffix array by prefix doubling, and the rank arrays of the lengths 1, 2, 4, ..."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ranks, h = [rank], 1
    while True:
        tail = np.zeros(n, np.int64)
        if h < n:
            tail[: n - h] = rank[h:] + 1
        key = rank * (n + 1) + tail
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, ordered[1:] != ordered[:-1]])
        ranks.append(rank)
        h *= 2
        if n == 0 or rank[order[-1]] == n - 1:
            return order, ranks


class FMIndex:
    """Of sequences of integers >= 0; each carries a value (its document)."""

    def __init__(self, sequences: list[np.ndarray], values: np.ndarray, depth: int):
        lens = np.fromiter(map(len, sequences), np.int64, len(sequences))
        flat = np.concatenate(sequences) if sequences else np.zeros(0, np.uint64)
        self.alphabet, dense = np.unique(flat, return_inverse=True)
        k, n = len(sequences), len(flat) + len(sequences)
        ends = np.cumsum(lens + 1) - 1
        text = np.empty(n, np.int64)  # every sequence ends with a separator of its own, smaller than all symbols
        text[ends] = np.arange(k)
        inside = np.ones(n, bool)
        inside[ends] = False
        text[inside] = dense + k
        self.n, self.depth = n, depth
        order, ranks = sorted_suffixes(text)
        owner = np.repeat(np.arange(k), lens + 1)
        before = np.where(inside, text - k + 1, 0)[order - 1]  # separators become symbol 0
        self.levels, self.zeros = [], []
        self.bits = max(1, int(len(self.alphabet)).bit_length())
        symbols = before
        for level in range(self.bits - 1, -1, -1):
            bit = (symbols >> level) & 1
            self.levels.append(Bits(bit.astype(np.uint8)))
            self.zeros.append(int(n - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])
        self.first = np.searchsorted(np.where(inside, text - k + 1, 0)[order], np.arange(len(self.alphabet) + 2))
        self.base = self._descend(np.arange(len(self.alphabet) + 1), np.zeros(len(self.alphabet) + 1, np.int64))
        # Suffixes that share their first ``depth`` symbols: a class, its bounds and the smallest value in it.
        common = np.zeros(n, np.int64)
        for power in range(len(ranks) - 1, -1, -1):
            h, rank = 1 << power, ranks[power]
            a, b = order[:-1] + common[1:], order[1:] + common[1:]
            fits = (a < n) & (b < n)
            same = np.zeros(n - 1, bool) if n else np.zeros(0, bool)
            same[fits] = rank[a[fits]] == rank[b[fits]]
            common[1:][same] += h
        cut = np.flatnonzero(np.r_[True, common[1:] < depth]) if n else np.zeros(0, np.int64)
        size = np.diff(np.r_[cut, n])
        self.low, self.high = np.repeat(cut, size), np.repeat(cut + size, size)
        self.least = np.repeat(np.minimum.reduceat(np.asarray(values, np.int64)[owner][order], cut), size) if n else cut

    def _descend(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        for level, zeros, shift in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1)):
            ones = level.rank(i)
            i = np.where((symbol >> shift) & 1, zeros + ones, i - ones)
        return i

    def extend(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One step of backward search: the intervals of symbol + pattern."""
        base, first = self.base[symbol], self.first[symbol]
        return first + self._descend(symbol, low) - base, first + self._descend(symbol, high) - base

    def symbols_of(self, sequence: np.ndarray) -> np.ndarray:
        """Symbols from 1 on; 0 for what the index does not hold."""
        if not len(self.alphabet):
            return np.zeros(len(sequence), np.int64)
        at = np.minimum(np.searchsorted(self.alphabet, sequence), len(self.alphabet) - 1)
        return np.where(self.alphabet[at] == sequence, at + 1, 0)

    def matching_statistics(self, queries: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For every start in every query: the length, at most ``depth``, of the
        longest match that starts there and could still grow to ``depth`` (0 where
        none was met), and, where it is ``depth``, the smallest value of a sequence
        that holds it (else -1)."""
        lens = np.fromiter(map(len, queries), np.int64, len(queries))
        flat = self.symbols_of(np.concatenate(queries)) if queries else np.zeros(0, np.int64)
        start = np.cumsum(lens) - lens
        found, least = np.zeros(len(flat), np.int64), np.full(len(flat), -1, np.int64)
        at, run = lens - 1, np.zeros(len(queries), np.int64)  # the symbol to add next, and the match's length so far
        low, high = np.zeros(len(queries), np.int64), np.full(len(queries), self.n, np.int64)
        live = np.flatnonzero(lens >= self.depth)
        while live.size:
            place = start[live] + at[live]
            symbol = flat[place]
            a, b = self.extend(symbol, low[live], high[live])
            good = (b > a) & (symbol > 0)
            g = live[good]
            low[g], high[g] = a[good], b[good]
            run[g] += 1
            full = run[g] >= self.depth
            w = g[full]
            run[w] = self.depth
            low[w], high[w] = self.low[low[w]], self.high[low[w]]
            found[place[good]] = np.maximum(found[place[good]], run[g])
            least[place[good][full]] = self.least[low[w]]
            at[g] -= 1
            # No match goes on here: it has to end one symbol earlier, and is searched anew from there.
            f = live[~good]
            at[f] += run[f] - (run[f] > 0)
            at[f] -= run[f] == 0
            run[f], low[f], high[f] = 0, 0, self.n
            live = live[at[live] + 1 + run[live] >= self.depth]
            live = live[at[live] >= 0]
        ends = np.cumsum(lens)
        return [found[a:b] for a, b in zip(start, ends)], [least[a:b] for a, b in zip(start, ends)]
