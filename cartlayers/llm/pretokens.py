"""Pieces that a byte-level BPE tokenizer merges within, for many texts at once.

A piece is a contraction ('s 't 're 've 'm 'll 'd), or letters, or numbers, or other visible
characters, each with one blank before it if there is one; or white space, whose last character
is left to what follows. A special token is a piece of its own.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np

SPACE, LETTER, NUMBER, OTHER = range(4)
#: Characters with the Unicode property White_Space.
WHITE_SPACE = [*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
_TWO = [(ord(a), ord(b)) for a, b in ("re", "ve", "ll")]
_ONE = [ord(c) for c in "stmd"]


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for code in range(0x110000):
        major = unicodedata.category(chr(code))[0]
        if major == "L":
            kinds[code] = LETTER
        elif major == "N":
            kinds[code] = NUMBER
    kinds[WHITE_SPACE] = SPACE
    return kinds


def _specials(data: np.ndarray, offsets: np.ndarray, special: bytes) -> np.ndarray:
    """First bytes of the special token's occurrences, none across texts."""
    raw, found, at = data.tobytes(), [], 0
    while special and (at := raw.find(special, at)) >= 0:
        if np.searchsorted(offsets, at, side="right") == np.searchsorted(offsets, at + len(special) - 1, side="right"):
            found.append(at)
            at += len(special)
        else:
            at += 1
    return np.array(found, dtype=np.int64)


def pieces(data: np.ndarray, offsets: np.ndarray, special: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
    """First byte of every piece of the texts (UTF-8, laid end to end), and how many each text has."""
    offsets = offsets - offsets[0]
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), dtype=np.uint32)
    n = len(points)
    if not n:
        return np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    kind = _kinds()[points]
    head = np.zeros(n + 1, dtype=bool)  # first characters of texts and of stretches around special tokens
    head[np.searchsorted(lead, offsets)] = True
    at = _specials(data, offsets, special)
    head[np.searchsorted(lead, at)] = True
    head[np.searchsorted(lead, at + len(special))] = True
    head[n] = True
    change = head[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    blank = points == 0x20
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~head[:n]
    space = kind == SPACE
    start = change & (space | ~after_blank)
    # the last white-space character before something visible
    tail = np.zeros(n, dtype=bool)
    tail[:-1] = space[:-1] & ~space[1:] & ~head[1:n]
    start |= tail
    # contractions: an apostrophe that starts a piece, and letters right after it in the same stretch
    quote = np.flatnonzero((points == 0x27) & start & ~after_blank)
    quote = quote[quote + 1 < n]
    quote = quote[~head[quote + 1]]
    if len(quote):
        first = points[quote + 1]
        second_at = np.minimum(quote + 2, n - 1)
        second = np.where((quote + 2 < n) & ~head[quote + 2], points[second_at], 0)
        length = np.where(np.isin(first, _ONE), 1, 0)
        for a, b in _TWO:
            length[(first == a) & (second == b)] = 2
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        rest = quote + 1 + length
        inside = rest < n
        start[rest[inside]] = start[rest[inside]] | (kind[rest[inside]] == LETTER)
    for a in np.searchsorted(lead, at):
        start[a + 1 : a + len(special)] = False
    begin = np.flatnonzero(start)
    counts = np.diff(np.searchsorted(lead[begin], offsets))
    return lead[begin], counts
