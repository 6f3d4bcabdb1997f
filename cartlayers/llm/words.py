"""Words of many texts at once, as arrays: where they are, and a 64-bit hash of each.

Texts come as Arrow string columns; everything works on their UTF-8 bytes. Separators are ASCII, so
a byte is enough to tell whether a character belongs to a word.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
HASH_STEP = np.uint64(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Flags of the 256 bytes that lie in one of the inclusive ranges."""
    flags = np.zeros(256, dtype=bool)
    for low, high in ranges:
        flags[low : high + 1] = True
    return flags


#: Everything but space and the control characters 9 to 13.
NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
#: Digits, small letters and every byte of a character beyond ASCII; for lower-cased text.
ALPHANUMERIC = byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))


def mix(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values; a bijection."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def randoms(n: int, seed: int) -> np.ndarray:
    """The same 64-bit values on every machine."""
    start = mix(np.array([seed], dtype=np.uint64) + HASH_STEP)[0]
    with np.errstate(over="ignore"):
        return mix(start + HASH_STEP * np.arange(1, n + 1, dtype=np.uint64))


_BYTE_VALUES = randoms(256, 11)
_BASE = int(randoms(1, 17)[0]) | 5


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts in a row and the n + 1 places where texts begin and end; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = column.cast(pa.large_binary()).fill_null(b"")
    n = len(wide)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(wide.buffers()[1], dtype=np.int64)[wide.offset : wide.offset + n + 1]
    data = wide.buffers()[2]
    if data is None or data.size == 0:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts with about `most` bytes; a longer text is a range of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, side="right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last
        first = last


@lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, modulo 2 to the 64."""
    steps = np.full((2, n), _BASE, dtype=np.uint64)
    steps[1] = pow(_BASE, -1, 1 << 64)
    steps[:, 0] = 1
    return tuple(np.cumprod(steps, axis=1))


class Words:
    """Words of a range of texts: start and end byte, the text each belongs to, and hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, in_word: np.ndarray):
        """`data` holds exactly the bytes offsets[0] to offsets[-1]; words never cross texts."""
        offsets = offsets - offsets[0]
        self.bytes = LOWER[data]
        self.texts = len(offsets) - 1
        inside = in_word[self.bytes]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        filled = np.flatnonzero(offsets[1:] > offsets[:-1])
        first[offsets[filled]] = inside[offsets[filled]]
        last[offsets[filled + 1] - 1] = inside[offsets[filled + 1] - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        self.first = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.first)
        self.of = np.repeat(np.arange(self.texts), self.counts)

    def hashes(self) -> np.ndarray:
        return slice_hashes(self.bytes, self.starts, self.ends)


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of ordered, disjoint slices: polynomials of their bytes, scrambled.

    A polynomial is the difference of two prefix sums.
    """
    found = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(found):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, side="right")))
        part = data[base : ends[last - 1]]
        power, inverse = _powers(max(CHUNK_BYTES, 1 << (len(part) - 1).bit_length()))
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUES[part] * power[: len(part)], out=sums[1:])
        begin = starts[first:last] - base
        found[first:last] = mix((sums[ends[first:last] - base] - sums[begin]) * inverse[begin])
        first = last
    return found


def runs(hashes: np.ndarray, words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of `size` words and the text it is in.

    A text of fewer words, but not none, has one run of all its words; such runs come last.
    """
    factors = randoms(size, 23) | np.uint64(1)
    n = max(0, len(hashes) - size + 1)
    total = np.zeros(n, dtype=np.uint64)
    for j in range(size):
        total += hashes[j : n + j] * factors[j]
    whole = words.of[:n] == words.of[size - 1 : n + size - 1]
    short = np.flatnonzero((words.counts > 0) & (words.counts < size))
    rest = np.zeros(len(short), dtype=np.uint64)
    for j in range(size - 1):
        have = words.counts[short] > j
        rest[have] += hashes[words.first[short[have]] + j] * factors[j]
    return mix(np.concatenate([total[whole], rest])), np.concatenate([words.of[:n][whole], short])


def expand(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For groups of given sizes laid end to end: the group of each element, and its place there."""
    group = np.repeat(np.arange(len(counts)), counts)
    return group, np.arange(len(group)) - np.repeat(np.cumsum(counts) - counts, counts)
