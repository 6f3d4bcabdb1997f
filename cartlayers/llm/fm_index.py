"""An FM-index over words: suffix order, Burrows-Wheeler transform, wavelet matrix, sampled positions.

Everything works on arrays, and all patterns of a search move together.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes; the last symbol must be smaller than every other one.

    Prefixes are doubled, and only suffixes whose rank is still shared are sorted again.
    """
    n = len(symbols)
    bits = max(1, int(symbols.max()).bit_length())
    packed = symbols.astype(np.int64)
    depth = min(n, max(1, 62 // bits))
    key = packed.copy()
    for step in range(1, depth):
        key <<= bits
        key[: n - step] |= packed[step:]
    order = np.argsort(key)
    sorted_keys = key[order]
    new = np.ones(n, dtype=bool)
    new[1:] = sorted_keys[1:] != sorted_keys[:-1]
    start = np.flatnonzero(new)
    rank = np.empty(n, dtype=np.int64)
    rank[order] = start[np.cumsum(new) - 1]
    # suffixes whose group has several members, in their present order
    size = np.diff(np.append(start, n))
    active = order[np.repeat(size > 1, size)]
    while len(active):
        ahead = active + depth
        second = np.where(ahead < n, rank[np.minimum(ahead, n - 1)], -1)
        first = rank[active]
        again = np.lexsort((second, first))
        active, first, second = active[again], first[again], second[again]
        head = np.ones(len(active), dtype=bool)
        head[1:] = first[1:] != first[:-1]
        group = np.flatnonzero(head)[np.cumsum(head) - 1]
        place = first + (np.arange(len(active)) - group)
        order[place] = active
        new = head.copy()
        new[1:] |= second[1:] != second[:-1]
        begin = np.flatnonzero(new)
        rank[active] = place[begin[np.cumsum(new) - 1]]
        size = np.diff(np.append(begin, len(active)))
        active = active[np.repeat(size > 1, size)]
        depth *= 2
    return order


class BitVector:
    """Ones before a place, from packed words and running totals."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, dtype=bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        self.before = np.zeros(len(self.words), dtype=np.int64)
        np.cumsum(np.bitwise_count(self.words)[:-1], out=self.before[1:])

    def rank(self, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64) & np.uint64(1)).astype(bool)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector per bit of a symbol."""

    def __init__(self, sequence: np.ndarray):
        self.bits = max(1, int(sequence.max(initial=0)).bit_length())
        sequence = sequence.astype(np.int32)
        self.levels, self.zeros = [], []
        for bit in range(self.bits - 1, -1, -1):
            ones = (sequence & np.int32(1 << bit)) != 0
            self.levels.append(BitVector(ones))
            self.zeros.append(len(ones) - int(np.count_nonzero(ones)))
            sequence = np.concatenate([sequence[~ones], sequence[ones]])

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        begin = np.zeros_like(at)
        for level, zeros, bit in zip(self.levels, self.zeros, range(self.bits - 1, -1, -1), strict=True):
            one = (symbols >> bit & 1).astype(bool)
            at_ones, begin_ones = level.rank(at), level.rank(begin)
            at = np.where(one, zeros + at_ones, at - at_ones)
            begin = np.where(one, zeros + begin_ones, begin - begin_ones)
        return at - begin

    def access(self, at: np.ndarray) -> np.ndarray:
        """The symbols at the places."""
        found = np.zeros_like(at)
        for level, zeros in zip(self.levels, self.zeros, strict=True):
            one, ones = level.get(at), level.rank(at)
            found = found << 1 | one
            at = np.where(one, zeros + ones, at - ones)
        return found


class FMIndex:
    """Searches a sequence of symbols 1, 2, ... that ends with its only 0."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        self.size = len(symbols)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols))])
        self.last = WaveletMatrix(symbols[order - 1])
        sampled = order % SAMPLE == 0
        self.sampled = BitVector(sampled)
        self.positions = order[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last-plus-one row of the suffixes that begin with each pattern.

        `patterns` has a row of symbols per pattern; -1 is a symbol that does not occur.
        """
        low = np.zeros(len(patterns), dtype=np.int64)
        high = np.where(lengths > 0, self.size, 0)
        for step in range(int(lengths.max(initial=0))):
            live = np.flatnonzero((high > low) & (lengths > step))
            symbol = patterns[live, lengths[live] - 1 - step]
            absent = (symbol < 0) | (symbol >= len(self.below) - 1)
            high[live[absent]] = low[live[absent]]
            live, symbol = live[~absent], symbol[~absent]
            if not len(live):
                break
            low[live] = self.below[symbol] + self.last.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.last.rank(symbol, high[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Places in the sequence of the suffixes in the given rows."""
        found = np.full(len(rows), -1, dtype=np.int64)
        open_rows, steps = np.arange(len(rows)), 0
        rows = rows.astype(np.int64)
        while len(open_rows):
            hit = self.sampled.get(rows)
            found[open_rows[hit]] = self.positions[self.sampled.rank(rows[hit])] + steps
            open_rows, rows = open_rows[~hit], rows[~hit]
            if len(rows):
                symbol = self.last.access(rows)
                rows = self.below[symbol] + self.last.rank(symbol, rows)
            steps += 1
        return found
