"""Tables of 64-bit keys in arrays: hash tables to look up many keys at once, and running counts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from cartlayers.llm.words import mix

#: Marks an unused place; as a key it is looked up like any other and never found.
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def hash_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Open addressing with at most two thirds of the places used; keys must be distinct, none EMPTY."""
    size = 1 << (3 * len(keys) // 2 + 8).bit_length()
    places = np.full(size, EMPTY, dtype=np.uint64)
    stored = np.zeros(size, dtype=values.dtype)
    at = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
    left = np.arange(len(keys))
    while len(left):
        spot = at[left]
        free = places[spot] == EMPTY
        trial, first = np.unique(spot[free], return_index=True)
        winner = left[free][first]
        places[trial], stored[trial] = keys[winner], values[winner]
        left = left[places[at[left]] != keys[left]]
        at[left] = (at[left] + 1) & (size - 1)
    return places, stored


def look_up(places: np.ndarray, stored: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of the keys, and which keys are there."""
    size = len(places)
    at = (mix(keys) & np.uint64(size - 1)).astype(np.int64)
    seen = places[at]
    known = seen == keys
    left = np.flatnonzero(~known & (seen != EMPTY))
    while len(left):
        at[left] = (at[left] + 1) & (size - 1)
        seen = places[at[left]]
        known[left] = seen == keys[left]
        left = left[~known[left] & (seen != EMPTY)]
    known &= keys != EMPTY
    return stored[at], known


class Tally:
    """Counts of keys; when it holds many distinct ones it can be emptied and filled again."""

    MOST = 3_000_000

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts))
        self.held += len(found)

    def full(self) -> bool:
        """Merge what is held if it is much; whether it then still is."""
        if self.held > 2 * self.MOST:
            self.parts = [self.merged()]
            self.held = len(self.parts[0][0])
        return self.held > self.MOST

    def merged(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        keys = np.concatenate([k for k, _ in self.parts])
        counts = np.concatenate([c for _, c in self.parts])
        order = np.argsort(keys)
        keys, counts = keys[order], counts[order]
        begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
        return keys[begin], np.add.reduceat(counts, begin) if len(begin) else counts

    def drain(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """What is held, in slices, and nothing is held afterwards."""
        keys, counts = self.merged()
        self.parts, self.held = [], 0
        for a in range(0, len(keys), 200_000):
            yield keys[a : a + 200_000], counts[a : a + 200_000]
