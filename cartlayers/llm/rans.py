"""A static range asymmetric numeral system over ids, many lanes and blocks at a time.

A state of 64 bits takes in a symbol of frequency f (of 2^bits) by growing about 2^bits / f times, and
gives off its low 32 bits whenever it would leave 64 bits. A block deals its ids to LANES states in turn,
whose words share one stream in the order in which the decoder asks for them. Blocks share the
frequencies and nothing else.

Every EVERY steps the states and the place in the stream are kept as a checkpoint, so the segments of a
block can be decoded independently, and each has a checksum of its ids. A segment has to end with
the states of the next checkpoint, the last one with the states that the encoder began with.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

LANES = 64
EVERY = 256
#: Precision of the frequencies, where the number of different ids does not call for more.
BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
#: Payload: ids, bits, lanes, steps between checkpoints; then word counts and checksums of the segments,
#: their states, and the words. Little-endian.
HEADER = struct.Struct("<QHHI")


class DamagedError(ValueError):
    """A payload whose checksums or states do not agree."""


@dataclass(frozen=True)
class Table:
    """Frequencies of the ids 0 .. n-1, which add up to 2^bits, and which id each number below belongs to."""

    bits: int
    freq: np.ndarray
    first: np.ndarray
    owner: np.ndarray

    @staticmethod
    def of(freq: np.ndarray) -> Table:
        freq = freq.astype(np.uint64)
        first = np.cumsum(freq) - freq
        return Table(int(freq.sum()).bit_length() - 1, freq, first, np.repeat(np.arange(len(freq), dtype=np.uint32), freq.astype(np.int64)))


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts of ids scaled to a power of two; every id that occurs keeps at least 1.

    What rounding leaves over or lacks is settled with the most frequent ids, in order. Without any
    count, id 0 gets everything.
    """
    counts = np.asarray(counts, dtype=np.float64)
    present = counts > 0
    if not present.any():
        counts = np.ones(max(len(counts), 1)) * (np.arange(max(len(counts), 1)) == 0)
        present = counts > 0
    bits = max(BITS, int(present.sum()).bit_length() + 4)
    freq = np.where(present, np.maximum(np.floor(counts / counts.sum() * (1 << bits)), 1), 0).astype(np.int64)
    over = int(freq.sum()) - (1 << bits)
    for i in np.argsort(-freq, kind="stable"):
        if over <= 0:
            break
        taken = min(over, int(freq[i]) // 2)
        freq[i] -= taken
        over -= taken
    freq[int(np.argmax(freq))] -= min(over, 0)
    return freq.astype(np.uint32)


def _steps(sizes: Sequence[int]) -> np.ndarray:
    return -(-np.asarray(sizes, dtype=np.int64) // LANES)


def encode(table: Table, blocks: Sequence[np.ndarray]) -> list[bytes]:
    """A payload for each block of ids, all encoded side by side; best for blocks of like size."""
    payloads: list[bytes] = [b""] * len(blocks)
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    steps = _steps([len(blocks[i]) for i in order])
    longest = int(steps[0]) if len(steps) else 0
    filler = int(np.argmax(table.freq))
    ids = np.full((len(order), longest * LANES), filler, dtype=np.int64)
    for row, i in enumerate(order):
        ids[row, : len(blocks[i])] = blocks[i]
    ids = ids.reshape(len(order), longest, LANES)
    active = np.searchsorted(-steps, -np.arange(longest), side="left")
    bits, room = np.uint64(table.bits), np.uint64(63 - table.bits)
    x = np.full((len(order), LANES), LOW, dtype=np.uint64)
    words = np.zeros((len(order), longest, LANES), dtype=np.uint32)
    given = np.zeros((len(order), longest, LANES), dtype=bool)
    states = np.zeros((len(order), -(-longest // EVERY), LANES), dtype=np.uint64)
    for t in range(longest - 1, -1, -1):
        n = active[t]
        s, now = ids[:n, t], x[:n]
        f = table.freq[s]
        out = now >= (f << room)
        words[:n, t] = now.astype(np.uint32)
        given[:n, t] = out
        now = np.where(out, now >> WORD, now)
        q = now // f
        x[:n] = (q << bits) + (now - q * f) + table.first[s]
        if t % EVERY == 0:
            states[:n, t // EVERY] = x[:n]
    for row, i in enumerate(order):
        own, segments = int(steps[row]), -(-int(steps[row]) // EVERY)
        counts = [int(given[row, a : min(a + EVERY, own)].sum()) for a in range(0, own, EVERY)]
        raw = blocks[i].astype("<u4").tobytes()
        size = 4 * EVERY * LANES
        sums = [zlib.crc32(raw[a : a + size]) for a in range(0, len(raw), size)]
        payloads[i] = b"".join([
            HEADER.pack(len(blocks[i]), table.bits, LANES, EVERY),
            np.array(counts, dtype="<u4").tobytes(), np.array(sums, dtype="<u4").tobytes(),
            states[row, :segments].astype("<u8").tobytes(), words[row, :own][given[row, :own]].astype("<u4").tobytes(),
        ])
    return payloads


@dataclass(frozen=True)
class Segments:
    """The segments of a payload that are to be decoded: `first` is the place of the first one's first id."""

    first: int
    sizes: np.ndarray
    sums: np.ndarray
    states: np.ndarray
    after: np.ndarray
    words: np.ndarray
    ends: np.ndarray

    @staticmethod
    def read(payload: bytes, bits: int, low: int = 0, high: int | None = None) -> Segments:
        """Those that hold ids from place `low` up to `high` (excluded) of the block."""
        if len(payload) < HEADER.size:
            raise DamagedError("a payload shorter than its header")
        n, own_bits, lanes, every = HEADER.unpack_from(payload)
        if (own_bits, lanes, every) != (bits, LANES, EVERY):
            raise DamagedError("a payload of other frequencies or another layout")
        segments = -(-int(_steps([n])[0]) // EVERY)
        at = HEADER.size
        if len(payload) < at + segments * (8 + 8 * LANES):
            raise DamagedError("a payload shorter than its checkpoints")
        counts = np.frombuffer(payload, "<u4", segments, at).astype(np.int64)
        sums = np.frombuffer(payload, "<u4", segments, at + 4 * segments)
        at += 8 * segments
        states = np.frombuffer(payload, "<u8", segments * LANES, at).reshape(segments, LANES)
        at += 8 * segments * LANES
        if len(payload) != at + 4 * int(counts.sum()):
            raise DamagedError("a payload without all its words")
        size, high = EVERY * LANES, n if high is None else min(high, n)
        a, b = max(low, 0) // size, -(-max(high, 0) // size)
        a, b = min(a, b), b
        ends = np.cumsum(counts)
        begin = int(ends[a - 1]) if a else 0
        end = int(ends[b - 1]) if b else 0
        after = np.concatenate([states[1:], np.full((min(segments, 1), LANES), LOW)])
        sizes = np.minimum(size, n - size * np.arange(a, b))
        words = np.frombuffer(payload, "<u4", end - begin, at + 4 * begin)
        return Segments(a * size, sizes, sums[a:b], states[a:b], after[a:b], words, ends[a:b] - begin)


def decode(table: Table, blocks: Sequence[Segments]) -> list[np.ndarray]:
    """The ids of each block's segments; all segments are decoded side by side."""
    rows = sum(len(b.sizes) for b in blocks)
    if not rows:
        return [np.zeros(0, np.uint32) for _ in blocks]
    sizes = np.concatenate([b.sizes for b in blocks])
    words = np.concatenate([*[b.words for b in blocks], [0]]).astype(np.uint64)
    base = np.cumsum([0, *[len(b.words) for b in blocks]])
    stops = np.concatenate([b.ends + base[i] for i, b in enumerate(blocks)])
    starts = np.concatenate([np.concatenate([[0], b.ends])[: len(b.ends)] + base[i] for i, b in enumerate(blocks)])
    order = np.argsort(-sizes, kind="stable")
    steps = _steps(sizes[order])
    active = np.searchsorted(-steps, -np.arange(EVERY), side="left")
    x = np.concatenate([b.states for b in blocks])[order].astype(np.uint64)
    at = starts[order]
    bits, mask = np.uint64(table.bits), np.uint64((1 << table.bits) - 1)
    ids = np.zeros((rows, EVERY, LANES), dtype=np.uint32)
    for t in range(int(steps[0])):
        n = active[t]
        now = x[:n]
        slot = now & mask
        s = table.owner[slot]
        ids[:n, t] = s
        now = table.freq[s] * (now >> bits) + slot - table.first[s]
        need = now < LOW
        asked = np.cumsum(need, axis=1)
        # a damaged stream may ask for more words than there are; it is found out below
        place = np.minimum(at[:n, None] + asked - 1, len(words) - 1)
        x[:n] = np.where(need, (now << WORD) | words[place], now)
        at[:n] += asked[:, -1]
    if (at != stops[order]).any() or (x != np.concatenate([b.after for b in blocks])[order]).any():
        raise DamagedError("a segment does not end where the next one begins")
    back = np.empty(rows, dtype=np.int64)
    back[order] = np.arange(rows)
    found, row = [], 0
    for block in blocks:
        parts = [ids[back[row + i]].reshape(-1)[:size] for i, size in enumerate(block.sizes)]
        for part, total in zip(parts, block.sums, strict=True):
            if zlib.crc32(part.astype("<u4").tobytes()) != total:
                raise DamagedError("the checksum of a segment does not agree")
        found.append(np.concatenate([*parts, np.zeros(0, np.uint32)]).astype(np.uint32))
        row += len(parts)
    return found
