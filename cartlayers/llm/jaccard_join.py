"""Exact set-similarity join of documents on word shingles, with partition-and-enumerate signatures.

Two sets with Jaccard similarity s or more, the smaller in size band i, lie in bands i and i + 1, so
they meet in one instance: the instance of a band takes the sets of the band and of the one below.
There they differ in at most k elements, k following from s and the band. The feature domain is cut
into n1 parts, each into three thirds; if 2 * n1 > k, some part holds at most one difference, so
two of its thirds are alike. A set emits, for every part and every pair of thirds, a hash of its
elements there: similar sets share one.

Pairs of thirds without elements would be alike for very many sets. A set leaves them out as long as
it has more parts without an empty pair than differences could spoil; the rare others emit them too.

Copies (same shingle set) are one class. Signatures are packed per bucket, deduplicated in each
batch, and give stars: the smallest class of all batches with a signature leads it. Two classes that
share a signature share its leader, so all candidate pairs meet within the group of a leader. Every class
is first compared with one pivot among the classes with the same smallest leader, which joins most copies; then,
in groups that are still in several components, the classes outside the largest one are compared with those of
other components. Both times pairs are thinned by sizes and by the parities of cells, a lower bound of the
difference, before texts are fetched for the exact comparison, and groups are cut into blocks. Only a spanning
forest leaves a block.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.llm.common import giving_back, map_tables, stored, table
from cartlayers.llm.components import connected_components
from cartlayers.llm.words import HASH_STEP, NOT_SPACE, Words, chunks, expand, mix, runs, text_bytes

THIRDS = 3
SIGNATURES_PER_BUCKET = 4_000_000
SIGNATURES_PER_PACK = 1_500_000
#: A block has at most about so many classes, and about so many shingles in all: a class is 170 bytes when its
#: parities are compared, and a shingle some 15 when its text is.
BLOCK, BLOCK_SHINGLES = 4096, 1 << 20
FILTER_BITS = 1 << 26


@dataclass(frozen=True)
class Likeness:
    """Shingle length and the similarity, `percent` in hundredths, at which sets are linked."""

    words: int = 5
    percent: int = 80

    def linked(self, shared, a, b):
        return 100 * shared >= self.percent * (a + b - shared)

    def most_different(self, total: int) -> int:
        """Largest symmetric difference of linked sets whose sizes sum to `total`."""
        return (100 - self.percent) * total // (100 + self.percent)

    def sizes_fit(self, a, b):
        return 100 * np.minimum(a, b) >= self.percent * np.maximum(a, b)


@lru_cache(maxsize=None)
def bands(likeness: Likeness) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First size of each band, largest difference in its instance, and its number of parts."""
    first = [1]
    while first[-1] < 1 << 40:
        first.append(max(first[-1] + 1, first[-1] * 100 // likeness.percent + 1))
    different, parts = [], []
    for low, above in zip(first, first[1:], strict=False):
        k = likeness.most_different(2 * (above - 1))
        smallest = max(1, math.ceil(low * likeness.percent / 100))
        spoiled = k // 2
        n1 = spoiled + 1
        while n1 <= k:
            empty = min(1.0, THIRDS * math.exp(-2 * smallest / (THIRDS * n1)))
            if n1 * (1 - empty) - math.sqrt(n1 * empty) >= spoiled + 1:
                break
            n1 += max(1, n1 // 50)
        different.append(k)
        parts.append(n1)
    return np.array(first), np.array(different), np.array(parts)


class ShingleSets:
    """Distinct shingles of a range of texts: hash and text of each, and the size of each set."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, likeness: Likeness):
        words = Words(data, offsets, NOT_SPACE)
        shingles, text = runs(words.hashes(), words, likeness.words)
        order = np.argsort(shingles)
        shingles, text = shingles[order], text[order]
        same = shingles[1:] == shingles[:-1]
        if same.any():
            near = np.zeros(len(shingles), dtype=bool)
            near[1:] |= same
            near[:-1] |= same
            at = np.flatnonzero(near)
            at = at[np.lexsort((text[at], shingles[at]))]
            again = (shingles[at][1:] == shingles[at][:-1]) & (text[at][1:] == text[at][:-1])
            keep = np.ones(len(shingles), dtype=bool)
            keep[at[1:][again]] = False
            shingles, text = shingles[keep], text[keep]
        self.shingles, self.text = shingles, text
        self.sizes = np.bincount(text, minlength=words.texts)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Two 64-bit hashes of each set."""
        sums = np.zeros((2, len(self.sizes)), dtype=np.uint64)
        np.add.at(sums[0], self.text, mix(self.shingles ^ np.uint64(3)))
        np.add.at(sums[1], self.text, mix(self.shingles ^ np.uint64(7)))
        return mix(sums[0]).view(np.int64), mix(sums[1]).view(np.int64)

    def cells(self) -> pa.Array:
        """A bit for each cell of the domain, as binary: whether the set has an odd number of elements there.

        A cell in which two sets differ in their bits holds an element of their difference, at least. A set has
        two to four times as many cells as elements, a power of two; its halves laid over each other are the bits
        for half as many cells.
        """
        cells = np.int64(1) << np.ceil(np.log2(np.maximum(2 * self.sizes, 64))).astype(np.int64)
        base = np.concatenate([[0], np.cumsum(cells)])
        counts = np.zeros(base[-1], dtype=np.uint8)
        place = base[self.text] + ((self.shingles >> np.uint64(24)).astype(np.int64) & (cells[self.text] - 1))
        np.add.at(counts, place, np.uint8(1))
        bits = np.packbits(counts & 1)
        return pa.Array.from_buffers(
            pa.binary(), len(cells), [None, pa.py_buffer((base // 8).astype(np.int32)), pa.py_buffer(bits)]
        )

    def signatures(self, likeness: Likeness) -> tuple[np.ndarray, np.ndarray]:
        """Signatures of all sets, and the text of each."""
        first, different, n_parts = bands(likeness)
        home = np.searchsorted(first, self.sizes, side="right") - 1
        value = mix(self.shingles + HASH_STEP)
        spot = mix(self.shingles ^ np.uint64(99))
        part_of = (spot >> np.uint64(32)).astype(np.int64)
        third_of = ((spot & np.uint64(0xFFFFFFFF)) * np.uint64(THIRDS) >> np.uint64(32)).astype(np.int64)
        found, owners = [], []
        for above in (0, 1):
            instance = home + above
            taken = (self.sizes > 0) & (100 * self.sizes >= likeness.percent * first[instance])
            parts = np.where(taken, n_parts[instance], 0)
            base = np.concatenate([[0], np.cumsum(parts)])
            sums = np.zeros((base[-1], THIRDS), dtype=np.uint64)
            full = np.zeros((base[-1], THIRDS), dtype=bool)
            use = taken[self.text] if not taken.all() else slice(None)
            text = self.text[use]
            place = (base[text] + (part_of[use] * parts[text] >> 32)) * THIRDS + third_of[use]
            np.add.at(sums.reshape(-1), place, value[use])
            full.reshape(-1)[place] = True
            owner = np.repeat(np.arange(len(parts)), parts)
            part = np.arange(base[-1]) - base[:-1][owner]
            whole = full.sum(axis=1) >= 2
            weak = np.bincount(owner, weights=whole, minlength=len(parts)) <= different[instance] // 2
            every = sums.sum(axis=1)
            label = instance[owner] * (1 << 40) + part * THIRDS
            for third in range(THIRDS):
                some = full[:, (third + 1) % 3] | full[:, (third + 2) % 3] | weak[owner]
                tag = mix((label[some] + third).astype(np.uint64) * HASH_STEP)
                found.append(mix(every[some] - sums[some, third] + tag))
                owners.append(owner[some])
        return np.concatenate(found), np.concatenate(owners)


def _sets_of(column: pa.Array, likeness: Likeness) -> Iterator[tuple[int, int, ShingleSets]]:
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        yield first, last, ShingleSets(data[offsets[first] : offsets[last]], offsets[first : last + 1], likeness)


def shingle_sets(docs: DataFrame, likeness: Likeness) -> DataFrame:
    """doc_id, n_shingles, the two keys of the set and the parities of its cells, for every document."""

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        ids = batch.column(0)
        for first, last, sets in _sets_of(batch.column(1), likeness):
            k1, k2 = sets.keys()
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, last - first), pa.array(sets.sizes), pa.array(k1), pa.array(k2), sets.cells()],
                ["doc_id", "n_shingles", "k1", "k2", "cells"],
            )

    return map_tables(
        docs.select("doc_id", "text"), measure, "doc_id long, n_shingles long, k1 long, k2 long, cells binary"
    )


def _leaders(signatures: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct signatures in order with the smallest key of each, and every (signature, key) of the others, once."""
    order = np.lexsort((keys, signatures))
    signatures, keys = signatures[order], keys[order]
    new = np.ones(len(signatures), dtype=bool)
    new[1:] = signatures[1:] != signatures[:-1]
    again = np.zeros(len(signatures), dtype=bool)
    again[1:] = ~new[1:] & (keys[1:] == keys[:-1])
    other = ~new & ~again
    return signatures[new], keys[new], signatures[other], keys[other]


def star_pairs(docs: DataFrame, likeness: Likeness, buckets: int) -> DataFrame:
    """(leader, member) first keys of classes that share a signature, each pair once.

    A batch sends the smallest class of each of its signatures to the signature's bucket as a leader row,
    the other classes as a follower row. A bucket reads its leader rows first and takes the smallest class
    of each signature; follower rows then pass one by one and get that leader. So a signature that very
    many classes share adds one entry a batch to what a bucket holds, and all its classes one leader. The
    entries of a batch are packed by class, so the fewer the buckets, the fewer classes are sent. 32 bits of
    a signature are enough: a bucket has some millions, and a false pair only costs a comparison.
    """
    columns = ["bucket", "follows", "signatures", "counts", "classes"]

    def packed_rows(follows: bool, signatures: np.ndarray, keys: np.ndarray) -> Iterator[tuple]:
        bucket = ((signatures >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        begin = np.flatnonzero(np.diff(bucket, prepend=-1))  # signatures are in order
        short = mix(signatures).astype(np.uint32)
        for a, b in zip(begin, np.append(begin[1:], len(bucket)), strict=True):
            order = np.argsort(keys[a:b])
            classes, counts = np.unique(keys[a:b], return_counts=True)
            most = 255  # of a byte; a class with more stands there again
            again = -(-counts // most)
            last = np.cumsum(again) - 1
            classes, sent = np.repeat(classes, again), np.full(last[-1] + 1, most)
            sent[last] = counts - most * (again - 1)
            packed = (short[a:b][order], sent.astype(np.uint8), classes)
            yield int(bucket[a]), follows, *(x.tobytes() for x in packed)

    def pack(signatures: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        head, leader, signatures, keys = _leaders(signatures, keys)
        rows = [*packed_rows(False, head, leader)]
        if len(keys):
            rows += packed_rows(True, signatures, keys)
        types = [pa.int64(), pa.bool_()] + [pa.binary()] * 3
        return pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), types, strict=True)], columns
        )

    def emit(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        found, keys, n = [], [], 0
        for _, last, sets in _sets_of(batch.column(0), likeness):
            signatures, owner = sets.signatures(likeness)
            found.append(signatures)
            keys.append(sets.keys()[0][owner])
            n += len(signatures)
            if n and (n >= SIGNATURES_PER_PACK or last == batch.num_rows):
                yield pack(np.concatenate(found), np.concatenate(keys))
                found, keys, n = [], [], 0

    def pairs_of(leader: np.ndarray, member: np.ndarray) -> pa.RecordBatch:
        both = np.unique(np.stack([leader, member], axis=1), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["leader", "member"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, keys, held = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)], None

        def led() -> tuple[np.ndarray, np.ndarray, pa.RecordBatch]:
            head, leader, signatures, members = _leaders(np.concatenate(found), np.concatenate(keys))
            return head, leader, pairs_of(leader[np.searchsorted(head, signatures)], members)

        for batch in batches:
            leaders, members = [], []
            for i in range(batch.num_rows):
                follows, signatures, counts, classes = (batch.column(c)[i].as_py() for c in columns[1:])
                signatures = np.frombuffer(signatures, np.uint32)
                classes = np.repeat(np.frombuffer(classes, np.int64), np.frombuffer(counts, np.uint8))
                if not follows:
                    if held is not None:
                        raise RuntimeError("a leader row came after a follower row")
                    found.append(signatures)
                    keys.append(classes)
                    continue
                if held is None:
                    *held, pairs = led()
                    found, keys = [], []
                    yield pairs
                leader = held[1][np.searchsorted(held[0], signatures)]
                other = leader != classes
                leaders.append(leader[other])
                members.append(classes[other])
            if leaders:
                yield pairs_of(np.concatenate(leaders), np.concatenate(members))
        if held is None:
            yield led()[2]

    packed = map_tables(
        docs.select("text"), emit, "bucket long, follows boolean, signatures binary, counts binary, classes binary"
    )
    ordered = packed.repartition("bucket").sortWithinPartitions("bucket", "follows")
    return ordered.groupBy("bucket").applyInArrow(giving_back(meet), "leader long, member long").distinct()


def _dealt(members: DataFrame) -> DataFrame:
    """Members with their own block (`home`) of their group, the group's `blocks` and its size `n`."""
    blocks = F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES)).cast("int")
    groups = members.groupBy("leader").agg(blocks.alias("blocks"), F.count("*").alias("n"))
    home = F.pmod(F.xxhash64("k1", "k2"), F.col("blocks")).cast("int")
    return members.join(groups, "leader").withColumn("home", home)


#: Rows of a meeting: the residents of `block`, and the visitors from the block `guest` that are compared with
#: them. (l1, l2) is what is known of a class's component; `outside` tells that it is not the one most of the
#: group is in.
MEETING = "leader long, block int, guest int, visits boolean, outside boolean, l1 long, l2 long, k1 long, k2 long"
PIVOT = "leader long, blocks int, k1 long, k2 long, n_shingles long, cells binary, distance double"


def _parities(cells: pa.Array) -> np.ndarray:
    """Parities of sets in rows of 64 bits, over the cells of the set that has the fewest."""
    values = cells.to_pylist()
    width = min(map(len, values), default=8) // 8
    folded = [np.bitwise_xor.reduce(np.frombuffer(x, np.uint64).reshape(-1, width), axis=0) for x in values]
    return np.array(folded, dtype=np.uint64).reshape(-1, width)


def _with_pivots(members: DataFrame) -> DataFrame:
    """Residents of every block, visited by one class of their group: the pivot. A class is in one group only.

    The pivot is the class nearest to the mean parities of its block, of all blocks the nearest one; in a
    group of edited copies that is the text they were made from, or nearly. A group has a pivot row per
    block, so what is compared grows with its members.
    """

    def nearest(rows: pa.Table) -> pa.Table:
        bits = np.unpackbits(_parities(rows.column("cells")).view(np.uint8), axis=1)
        odd = bits.sum(axis=0, dtype=np.int64)  # whole numbers up to the division, the same in any order of rows
        distance = (odd.sum() + bits.astype(np.float64) @ (len(bits) - 2 * odd)) / len(bits)
        at = np.lexsort((rows.column("k2").to_numpy(), rows.column("k1").to_numpy(), distance))[:1]
        best = rows.take(pa.array(at)).select(["leader", "blocks", "k1", "k2", "n_shingles", "cells"])
        return best.append_column("distance", pa.array(distance[at]))

    dealt = stored(_dealt(members).where("n > 1").withColumnRenamed("home", "block"))
    near = dealt.where("n > 2").groupBy("leader", "block").applyInArrow(nearest, PIVOT)
    # of two classes either will do
    pairs = dealt.where("n = 2").select("leader", "blocks", "k1", "k2", "n_shingles", "cells", F.lit(0.0).alias("distance"))
    kept = F.struct("blocks", "k1", "k2", "n_shingles", "cells")
    least = F.min_by(kept, F.struct("distance", "k1", "k2")).alias("p")
    pivots = near.unionByName(pairs).groupBy("leader").agg(least).select("leader", "p.*")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    visitors = pivots.withColumns({"block": every, "visits": F.lit(True)}).drop("blocks")
    rows = dealt.drop("blocks", "n").withColumn("visits", F.lit(False)).unionByName(visitors)
    return rows.withColumns({"guest": F.lit(0), "outside": F.lit(False), "l1": F.col("k1"), "l2": F.col("k2")})


def _apart(members: DataFrame) -> DataFrame:
    """Members of the groups that are in several components (l1, l2)."""
    own = F.struct("l1", "l2")
    split = members.groupBy("leader").agg(F.min(own).alias("least"), F.max(own).alias("most")).where("least != most")
    return members.join(split.select("leader"), "leader", "left_semi")


def _across(members: DataFrame) -> DataFrame:
    """Residents of every block, visited by those classes of their group that are outside its main component.

    A meeting is of two blocks, whatever the size of the group. Members have the components (l1, l2) found so far. Groups within one component are left out; the
    others are compared across components only, and that of most members is not compared with itself.
    """
    sizes = members.groupBy("leader", "l1", "l2").agg(F.count("*").alias("n"))
    main = sizes.groupBy("leader").agg(
        F.max_by(F.struct("l1", "l2"), F.struct("n", "l1", "l2")).alias("main"), F.count("*").alias("components")
    )
    split = members.join(main.where("components > 1").drop("components"), "leader")
    rows = split.withColumn("outside", F.struct("l1", "l2") != F.col("main")).drop("main")
    dealt = _dealt(rows).drop("n")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    visitors = dealt.where("outside").withColumns({"block": every, "guest": F.col("home"), "visits": F.lit(True)})
    residents = dealt.withColumns({"guest": every, "block": F.col("home"), "visits": F.lit(False)})
    return residents.unionByName(visitors).drop("blocks", "home")


class Meeting:
    """The visitors and residents of a block, as positions; each knows its component so far."""

    def __init__(self, rows: pa.Table, sizes: np.ndarray, cells: np.ndarray):
        self.sizes, self.cells = sizes, cells
        self.keys = np.stack([rows.column(c).to_numpy() for c in ("k1", "k2")], axis=1)
        self.labels = np.stack([rows.column(c).to_numpy() for c in ("l1", "l2")], axis=1)
        _, self.root = np.unique(self.labels, axis=0, return_inverse=True)
        self.root = self.root.reshape(-1)
        visits = rows.column("visits").to_numpy(zero_copy_only=False)
        self.outside = rows.column("outside").to_numpy(zero_copy_only=False)
        self.visitors, self.residents = np.flatnonzero(visits), np.flatnonzero(~visits)

    def fitting(self, at: int, likeness: Likeness) -> np.ndarray:
        """Residents of other components that could be linked to a visitor, by sizes and parities.

        Two classes outside visit each other; the one with the smaller key is compared.
        """
        near = self.residents[self.root[self.residents] != self.root[at]]
        near = near[likeness.sizes_fit(self.sizes[near], self.sizes[at])]
        if self.outside[at]:
            own, other = self.keys[at], self.keys[near]
            later = (other[:, 0] > own[0]) | ((other[:, 0] == own[0]) & (other[:, 1] > own[1]))
            near = near[~self.outside[near] | later]
        gap = np.bitwise_count(self.cells[near] ^ self.cells[at]).sum(axis=1, dtype=np.int64)
        total = self.sizes[near] + self.sizes[at]
        return near[gap * (100 + likeness.percent) <= (100 - likeness.percent) * total]


def candidates(meetings: DataFrame, likeness: Likeness) -> DataFrame:
    """Visitors that may be linked to a resident of the block they visit, and those residents."""

    def thin(rows: pa.Table) -> pa.Table:
        meeting = Meeting(rows, rows.column("n_shingles").to_numpy(), _parities(rows.column("cells")))
        use = np.zeros(rows.num_rows, dtype=bool)
        for at in meeting.visitors:
            fit = meeting.fitting(at, likeness)
            use[fit] = True
            use[at] |= len(fit) > 0
        return rows.filter(pa.array(use)).select([f.split()[0] for f in MEETING.split(", ")])

    return meetings.groupBy("leader", "block", "guest").applyInArrow(thin, MEETING)


def _pressed(texts: pa.Array) -> pa.Array:
    """Texts as they are shuffled: each compressed as a whole, which is smaller than Spark's blocks of rows."""
    return pa.array([None if t is None else zlib.compress(t, 1) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def _unpressed(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else zlib.decompress(t) for t in texts.to_pylist()], pa.binary())


def _links(rows: pa.Table, likeness: Likeness) -> np.ndarray:
    """Pairs of components (l1, l2, l1, l2) that a block links, by exact comparison: a spanning forest of them."""
    texts, back = np.unique(rows.column("text").combine_chunks().dictionary_encode().indices.to_numpy(), return_inverse=True)
    distinct = _unpressed(rows.column("text").combine_chunks().dictionary_encode().dictionary.take(pa.array(texts)))
    shingles, sizes, cells, keys = [], [], [], []
    for _, _, found in _sets_of(distinct, likeness):
        order = np.lexsort((found.shingles, found.text))
        shingles += np.split(found.shingles[order], np.cumsum(found.sizes)[:-1])
        sizes.append(found.sizes)
        cells.append(found.cells())
        keys.append(np.stack(found.keys(), axis=1))
    sizes, cells, keys = np.concatenate(sizes), pa.concat_arrays(cells), np.concatenate(keys)
    # a repeated doc_id brings several texts; only one with the class's own set counts
    wanted = np.stack([rows.column(c).to_numpy() for c in ("k1", "k2")], axis=1)
    right = np.flatnonzero((keys[back] == wanted).all(axis=1))
    roles = np.concatenate([wanted, rows.column("visits").to_numpy(zero_copy_only=False)[:, None]], axis=1)
    right = right[np.unique(roles[right], axis=0, return_index=True)[1]]
    own = back[right]
    meeting = Meeting(rows.take(pa.array(right)), sizes[own], _parities(cells.take(pa.array(own))))
    edges = []
    for at in meeting.visitors:
        fit = meeting.fitting(at, likeness)
        if not len(fit):
            continue
        mine = shingles[own[at]]
        others = np.concatenate([shingles[own[j]] for j in fit])
        spot = np.minimum(np.searchsorted(mine, others), len(mine) - 1)
        begin = np.concatenate([[0], np.cumsum(meeting.sizes[fit])[:-1]])
        shared = np.add.reduceat((mine[spot] == others).astype(np.int64), begin)
        for j in fit[likeness.linked(shared, meeting.sizes[at], meeting.sizes[fit])]:
            if meeting.root[j] != meeting.root[at]:
                meeting.root[meeting.root == meeting.root[j]] = meeting.root[at]
                edges.append((*meeting.labels[at], *meeting.labels[j]))
    return np.array(edges, dtype=np.int64).reshape(-1, 4)


def _id_bits(ids: DataFrame) -> np.ndarray:
    """A set of ids as FILTER_BITS flags; other ids with the same last bits are in it, too."""
    bit = F.col("doc_id").bitwiseAND(F.lit(FILTER_BITS - 1))
    words = (
        ids.where(F.col("doc_id").isNotNull())
        .select(F.shiftright(bit, 6).alias("word"), F.expr("shiftleft(1L, int(doc_id & 63))").alias("mask"))
        .groupBy("word")
        .agg(F.bit_or("mask").alias("mask"))
        .toArrow()
    )
    flags = np.zeros(FILTER_BITS // 64, dtype=np.int64)
    flags[words.column("word").to_numpy()] = words.column("mask").to_numpy()
    return flags


def links(docs: DataFrame, classes: DataFrame, found: DataFrame, likeness: Likeness) -> DataFrame:
    """Edges (a, b) between components so far that span what is linked in every block.

    A fixed number of flags tells most of the documents that are not needed, so that only texts of the
    others are shuffled to their blocks; the join on doc_id is exact.
    """
    names = [f.split()[0] for f in MEETING.split(", ")]
    asked = stored(found.join(classes.select("k1", "k2", "rep"), ["k1", "k2"]).select(*names, "rep"))
    flags = _id_bits(asked.select(F.col("rep").alias("doc_id")))

    def keep(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        low = batch.column(0).fill_null(0).to_numpy() & (FILTER_BITS - 1)
        use = (flags[low >> 6] >> (low & 63) & 1).astype(bool) | batch.column(0).is_null().to_numpy(zero_copy_only=False)
        kept = batch.filter(pa.array(use))
        yield pa.RecordBatch.from_arrays([kept.column(0), _pressed(kept.column(1))], ["doc_id", "text"])

    def compare(rows: pa.Table) -> pa.Table:
        ends = _links(rows, likeness)
        return pa.table({n: ends[:, i] for i, n in enumerate(("k1_a", "k2_a", "k1_b", "k2_b"))})

    texts = map_tables(docs.select("doc_id", "text"), keep, "doc_id long, text binary")
    edges = (
        texts.join(asked, F.col("doc_id").eqNullSafe(F.col("rep")))
        .select(*names, "text")
        .groupBy("leader", "block", "guest")
        .applyInArrow(compare, "k1_a long, k2_a long, k1_b long, k2_b long")
    )
    return edges.select(
        F.struct(F.col("k1_a").alias("k1"), F.col("k2_a").alias("k2")).alias("a"),
        F.struct(F.col("k1_b").alias("k1"), F.col("k2_b").alias("k2")).alias("b"),
    )


def _labelled(classes: DataFrame, by: DataFrame) -> DataFrame:
    """Classes with the label of their component after further edges between components."""
    merged = by.select("node", F.col("label").alias("merged"))
    return classes.join(merged, F.col("label") == F.col("node"), "left").select(
        "k1", "k2", "n_shingles", "rep", F.coalesce("merged", "label").alias("label")
    )


def _components(docs: DataFrame, likeness: Likeness) -> tuple[DataFrame, DataFrame]:
    """Sets of all documents, and of every class its smallest doc_id and the label of its component."""
    sets = stored(shingle_sets(docs, likeness))
    filled = sets.where(F.col("n_shingles") > 0)
    classes = stored(
        filled.groupBy("k1", "k2", "n_shingles").agg(F.min("doc_id").alias("rep"), F.min("cells").alias("cells"))
    ).withColumn("label", F.struct("k1", "k2"))
    total = classes.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = 1 + total // SIGNATURES_PER_BUCKET
    stars = stored(star_pairs(docs, likeness, buckets))
    own = stars.select("leader", F.col("leader").alias("member"))
    # first every class with the pivot of one group, that of its smallest leader: it costs as much as there are classes,
    # and as a class is linked with one pivot at most, the pivot names its component
    members = stars.unionByName(own).groupBy("member").agg(F.min("leader").alias("leader"))
    members = members.join(classes.drop("rep", "label"), F.col("member") == F.col("k1")).drop("member")
    found = stored(candidates(_with_pivots(members), likeness))
    pivots = links(docs, classes, found, likeness).select(F.col("b").alias("node"), F.col("a").alias("label"))
    joined = stored(_labelled(classes, pivots))
    # then what is still apart in a group; parities follow when the groups within one component are gone
    held = joined.select("k1", "k2", "n_shingles", F.col("label.k1").alias("l1"), F.col("label.k2").alias("l2"))
    members = stars.unionByName(own.distinct()).join(held, F.col("member") == F.col("k1")).drop("member")
    meetings = _across(stored(_apart(members))).join(classes.select("k1", "k2", "cells"), ["k1", "k2"])
    found = stored(candidates(meetings, likeness))
    labels = connected_components(links(docs, classes, found, likeness))
    return sets, _labelled(joined, labels).select("k1", "k2", "rep", "label")


def near_duplicates(docs: DataFrame, likeness: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of `docs` (doc_id, text).

    component_id is the smallest doc_id among the documents reachable by links. A null or wordless
    text has an empty set: n_shingles 0, linked with nothing, component_id its own doc_id. Repeated
    rows give repeated results; a null doc_id stays null and never becomes a component_id unless the
    whole component has no other. Other columns are ignored. An empty table gives an empty result.
    """
    sets, of_class = _components(docs, likeness)
    component = of_class.groupBy("label").agg(F.min("rep").alias("component_id"))
    to_component = of_class.join(component, "label").select("k1", "k2", "component_id")
    filled = sets.where(F.col("n_shingles") > 0)
    linked = filled.join(to_component, ["k1", "k2"], "left").select("doc_id", "n_shingles", "component_id")
    alone = sets.where(F.col("n_shingles") == 0).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return linked.unionByName(alone)


def one_of_each(docs: DataFrame, likeness: Likeness = Likeness()) -> DataFrame:
    """The rows of `docs` without near duplicates: of each component the row with the smallest doc_id.

    Of repeated rows one stays. Texts without words are all kept. Columns of `docs` are kept as they are.
    """
    mark = "_"
    while any(name.startswith(mark) for name in docs.columns):
        mark += "_"  # so that no column of docs bears a name from here
    size, k1, k2, own1, own2, rep, nth = (mark + name for name in ("size", "k1", "k2", "own1", "own2", "rep", "nth"))
    _, of_class = _components(docs, likeness)
    first = F.min(F.struct(F.col("rep").isNull().alias("no_id"), "rep", "k1", "k2")).alias("first")
    chosen = of_class.groupBy("label").agg(first).select(
        F.col("first.k1").alias(own1), F.col("first.k2").alias(own2), F.col("first.rep").alias(rep)
    )
    added_fields = T.StructType().add(size, "long").add(k1, "long").add(k2, "long").fields
    schema = T.StructType(docs.schema.fields + added_fields)
    names = schema.names

    def keyed(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, sets in _sets_of(batch.column("text"), likeness):
            added = [pa.array(sets.sizes), *(pa.array(k) for k in sets.keys())]
            yield pa.RecordBatch.from_arrays(batch.slice(first, last - first).columns + added, names)

    rows = map_tables(docs, keyed, schema)
    own = (F.col(k1) == F.col(own1)) & (F.col(k2) == F.col(own2)) & F.col("doc_id").eqNullSafe(F.col(rep))
    kept = rows.where(F.col(size) > 0).join(chosen, own, "left_semi")
    order = Window.partitionBy(k1, k2).orderBy("doc_id")
    kept = kept.withColumn(nth, F.row_number().over(order)).where(F.col(nth) == 1)
    return kept.select(docs.columns).unionByName(rows.where(F.col(size) == 0).select(docs.columns))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))
