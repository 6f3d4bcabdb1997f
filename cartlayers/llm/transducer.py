"""A minimal acyclic transducer: words share prefixes and suffixes, and each has the number of its rank.

States that accept the same endings are one. A transition's output counts the words that come earlier
in order; outputs along a word add up to its rank, which tells its ids.
"""

from __future__ import annotations

import numpy as np

from cartlayers.llm.tables import hash_table, look_up
from cartlayers.llm.words import HASH_STEP, mix

_BYTE = np.uint64(8)


def _shared(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many leading bytes each word has in common with the word before it."""
    shared = np.zeros(len(lengths), dtype=np.int32)
    alive, step = np.arange(1, len(lengths), dtype=np.int32), 0
    while len(alive):
        alive = alive[np.minimum(lengths[alive], lengths[alive - 1]) > step]
        alive = alive[data[starts[alive] + step] == data[starts[alive - 1] + step]]
        step += 1
        shared[alive] = step
    return shared


def compile_words(words: list[bytes], ids: list[np.ndarray]) -> dict[str, np.ndarray]:
    """Arrays of the transducer of distinct, sorted, non-empty words and their ids."""
    lengths = np.array([len(w) for w in words], dtype=np.int32)
    counts = np.array([len(x) for x in ids], dtype=np.int64)
    data = np.frombuffer(b"".join(words), np.uint8)
    return compile_arrays(data, lengths, np.concatenate([*ids, np.zeros(0, np.uint32)]).astype(np.uint32), counts)


def compile_arrays(data: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> dict[str, np.ndarray]:
    """The same of words laid end to end and their ids laid end to end, with the length of each.

    Nothing is made for each word or for each place of each word, only arrays with a few bytes a node: the
    driver compiles, and what it once had in small pieces it would not give back.
    """
    n, lengths = len(lengths), lengths.astype(np.int32)
    starts = (np.cumsum(lengths) - lengths).astype(np.int32)
    shared = _shared(data, starts, lengths)
    other = np.flatnonzero(shared[1:] < lengths[:-1]) + 1  # words that do not go on from the word before
    if (shared >= lengths).any() or (data[starts[other] + shared[other]] < data[starts[other - 1] + shared[other]]).any():
        raise ValueError("words must be distinct, sorted and not empty")
    # the tree of prefixes: node 0 is the root, others are numbered in order of the words
    own = lengths - shared
    last = np.cumsum(own, dtype=np.int32)
    total = int(own.sum()) + 1
    begin = last - own + 1
    level = np.arange(total, dtype=np.int32)
    level[1:] += np.repeat(shared + 1 - begin, own)
    label = np.zeros(total, dtype=np.uint8)
    label[1:] = data[level[1:] - 1 + np.repeat(starts, own)]
    parent = np.arange(-1, total - 1, dtype=np.int32)
    parent[0] = 0
    depth = int(lengths.max(initial=0))
    for d in range(depth):
        # a word that begins its own nodes below level d hangs from the latest node of that level
        hung = np.flatnonzero(shared == d)
        if d == 0:
            parent[begin[hung]] = 0
        elif len(hung):
            nodes = np.flatnonzero(level == d).astype(np.int32)
            parent[begin[hung]] = nodes[np.searchsorted(nodes, begin[hung]) - 1]
    final = np.zeros(total, dtype=bool)
    final[last] = True
    below, height = final.astype(np.int32), np.zeros(total, dtype=np.int32)
    for d in range(depth, 0, -1):
        nodes = np.flatnonzero(level == d)
        np.add.at(below, parent[nodes], below[nodes])
        np.maximum.at(height, parent[nodes], height[nodes] + 1)
    del level, starts, shared, other, own, last, begin
    # words before a child: the parent itself, and the children left of it, whose nodes have smaller numbers
    before = np.zeros(total, dtype=np.int32)
    order = np.argsort(parent[1:], kind="stable").astype(np.int32) + 1
    if len(order):
        running = np.cumsum(below[order]) - below[order]
        head = np.append(True, parent[order][1:] != parent[order][:-1])
        before[order] = running - running[np.flatnonzero(head)][np.cumsum(head) - 1] + final[parent[order]]
        del running, head
    del order, below
    # states: nodes of one height with the same endings, from the leaves up
    ending = final.astype(np.uint64)
    state = np.zeros(total, dtype=np.int32)
    kept, states = np.zeros(total, dtype=bool), 0
    for h in range(int(height.max(initial=0)) + 1):
        nodes = np.flatnonzero(height == h)
        _, first, which = np.unique(mix(ending[nodes]), return_index=True, return_inverse=True)
        state[nodes] = states + which
        kept[nodes[first]] = True
        states += len(first)
        with np.errstate(over="ignore"):
            sign = mix((state[nodes].astype(np.uint64) << _BYTE | label[nodes].astype(np.uint64)) + HASH_STEP)
            inner = nodes > 0
            np.add.at(ending, parent[nodes[inner]], mix(sign[inner]) << np.uint64(1))
    del ending, height
    edge = np.flatnonzero(kept[parent] & (np.arange(total) > 0))
    keys = state[parent[edge]].astype(np.uint64) << _BYTE | label[edge].astype(np.uint64)
    places, values = hash_table(keys, state[edge].astype(np.int64) << 32 | before[edge])
    accepts = np.zeros(states, dtype=bool)
    accepts[state[final]] = True
    arrays = {
        "places": places,
        "values": values,
        "accepts": accepts,
        "start": np.array([state[0]], dtype=np.int64),
        "id_ends": np.concatenate([[0], np.cumsum(counts)]),
        "ids": ids,
    }
    rank, known = find(arrays, data, np.cumsum(lengths, dtype=np.int64) - lengths, lengths)
    if not (known.all() and (rank == np.arange(n)).all()):
        raise ValueError("words must be distinct, sorted and not empty")
    return arrays


def find(arrays: dict[str, np.ndarray], data: np.ndarray, starts: np.ndarray, lengths: np.ndarray):
    """Rank of each word among the compiled ones, and whether it is one of them."""
    state = np.full(len(starts), arrays["start"][0], dtype=np.int64)
    rank, alive, step = np.zeros(len(starts), dtype=np.int64), np.arange(len(starts)), 0
    known = np.zeros(len(starts), dtype=bool)
    while len(alive):
        ended = lengths[alive] == step
        done = alive[ended]
        known[done] = arrays["accepts"][state[done]]
        alive = alive[~ended]
        key = state[alive].astype(np.uint64) << _BYTE | data[starts[alive] + step].astype(np.uint64)
        value, there = look_up(arrays["places"], arrays["values"], key)
        alive, value = alive[there], value[there]
        state[alive] = value >> 32
        rank[alive] += value & 0xFFFFFFFF
        step += 1
    return rank, known
