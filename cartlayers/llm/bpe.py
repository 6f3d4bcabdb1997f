"""Byte-level BPE encoding and decoding with a lexicon of frequent words.

The most frequent pieces of the corpus and their ids are compiled into a minimal acyclic transducer,
whose arrays tasks map into memory. Pieces it does not hold are merged exactly, pair by pair in order
of rank, all of a chunk together. Results never depend on the lexicon; it only saves merging.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.llm.common import SharedArrays, give_back, giving_back, map_tables, table
from cartlayers.llm.pretokens import pieces
from cartlayers.llm.tables import hash_table, look_up
from cartlayers.llm.transducer import compile_arrays, find
from cartlayers.llm.words import chunks, expand, slice_hashes, text_bytes

LEXICON = 300_000
LONGEST_WORD = 32
#: Longer pieces are merged one by one with a heap, in n log n steps.
LONGEST_TOGETHER = 128
_SHIFT = np.uint64(32)


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Vocabulary:
    """A tokenizer file as arrays: id of each byte, merges by pair of ids, bytes of each id."""

    arrays: dict[str, np.ndarray]
    special: bytes
    special_id: int

    @staticmethod
    def read(path: str) -> Vocabulary:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, merges = content["model"]["vocab"], content["model"]["merges"]
        byte_of = _byte_characters()
        special = content["added_tokens"][0]
        texts = {i: bytes(byte_of[c] for c in token) for token, i in ids.items() if token != special["content"]}
        texts[special["id"]] = special["content"].encode()
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        keys = np.array([ids[a] << 32 | ids[b] for a, b in pairs], dtype=np.uint64)
        made = np.array([ids[a + b] for a, b in pairs], dtype=np.int64)
        places, values = hash_table(keys, np.arange(len(pairs), dtype=np.int64) << 32 | made)
        tokens = [texts.get(i, b"") for i in range(max(texts) + 1)]
        own = {b: ids[c] for c, b in byte_of.items()}
        arrays = {
            "merge_places": places,
            "merge_values": values,
            "byte_ids": np.array([own[b] for b in range(256)], dtype=np.int64),
            "token_ends": np.concatenate([[0], np.cumsum([len(t) for t in tokens])]),
            "token_bytes": np.frombuffer(b"".join(tokens), np.uint8),
        }
        return Vocabulary(arrays, special["content"].encode(), special["id"])


class Merger:
    """Exact merges of pieces outside the lexicon."""

    NONE = np.int64(1) << 62

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.places, self.values, self.byte_ids = (arrays[k] for k in ("merge_places", "merge_values", "byte_ids"))

    def _merges(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank and new id of each pair, packed; NONE if it is not merged."""
        value, known = look_up(self.places, self.values, left.astype(np.uint64) << _SHIFT | right.astype(np.uint64))
        return np.where(known, value, self.NONE)

    def together(self, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words laid end to end, and how many each has. A round merges one pair per word."""
        symbols, word = self.byte_ids[data], np.repeat(np.arange(len(lengths)), lengths)
        parts = []
        while len(symbols):
            rank = np.full(len(symbols), self.NONE)
            same = np.flatnonzero(word[1:] == word[:-1])
            rank[same] = self._merges(symbols[same], symbols[same + 1])
            head = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
            size = np.diff(np.append(head, len(word)))
            least = np.minimum.reduceat(rank, head)
            best = np.repeat(least, size)
            open_ = best < self.NONE
            parts.append((word[~open_], symbols[~open_]))
            at = np.flatnonzero((rank == best) & open_)
            at = at[np.append(True, word[at][1:] != word[at][:-1])] if len(at) else at
            symbols[at] = rank[at] & 0xFFFFFFFF
            open_[at + 1] = False
            symbols, word = symbols[open_], word[open_]
        if not parts:
            return np.zeros(0, np.uint32), np.zeros(len(lengths), np.int64)
        words, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(words, kind="stable")
        return ids[order].astype(np.uint32), np.bincount(words, minlength=len(lengths))

    def alone(self, data: np.ndarray) -> np.ndarray:
        """Ids of one long piece, the pairs waiting in a heap."""
        symbols = self.byte_ids[data].tolist()
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        first = self._merges(self.byte_ids[data[:-1]], self.byte_ids[data[1:]])
        table: dict[tuple[int, int], int] = {}

        def merge_of(a: int, b: int) -> int:
            if (a, b) not in table:
                table[a, b] = int(self._merges(np.array([a]), np.array([b]))[0])
            return table[a, b]

        heap = [(int(v) >> 32, i, int(v) & 0xFFFFFFFF, symbols[i], symbols[i + 1]) for i, v in enumerate(first) if v < self.NONE]
        heapq.heapify(heap)
        while heap:
            _, i, made, a, b = heapq.heappop(heap)
            j = after[i]
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n:
                    v = merge_of(symbols[x], symbols[y])
                    if v < self.NONE:
                        heapq.heappush(heap, (v >> 32, x, v & 0xFFFFFFFF, symbols[x], symbols[y]))
        return np.array([s for s in symbols if s >= 0], dtype=np.uint32)


def _ragged(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The slices of `data`, laid end to end."""
    group, place = expand(lengths)
    return data[starts[group] + place]


class Encoder:
    def __init__(self, arrays: dict[str, np.ndarray], special: bytes, special_id: int):
        self.arrays, self.special, self.special_id = arrays, special, special_id
        self.merger = Merger(arrays)

    def ids_of(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of given pieces: all ids, and first id and number of ids of each piece."""
        if "accepts" in self.arrays:
            rank, known = find(self.arrays, data, starts, lengths)
        else:
            rank, known = np.zeros(len(starts), np.int64), np.zeros(len(starts), bool)
        ends = self.arrays["id_ends"] if "accepts" in self.arrays else np.zeros(2, np.int64)
        counts = np.where(known, ends[np.minimum(rank + 1, len(ends) - 1)] - ends[rank], 0)
        found = [_ragged(self.arrays["ids"], ends[rank[known]], counts[known])] if known.any() else []
        owner = [np.flatnonzero(known)]
        rest = np.flatnonzero(~known)
        together = rest[lengths[rest] <= LONGEST_TOGETHER]
        ids, many = self.merger.together(_ragged(data, starts[together], lengths[together]), lengths[together])
        counts[together] = many
        found.append(ids)
        owner.append(together)
        for i in rest[lengths[rest] > LONGEST_TOGETHER]:
            ids = self.merger.alone(data[starts[i] : starts[i] + lengths[i]])
            counts[i] = len(ids)
            found.append(ids)
            owner.append(np.array([i]))
        owners = np.concatenate(owner)
        first = np.zeros(len(starts), dtype=np.int64)
        first[owners] = np.cumsum(counts[owners]) - counts[owners]
        return np.concatenate(found), first, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of texts laid end to end, and how many each text has."""
        starts, per_text = pieces(data, offsets, self.special)
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        _, pick, back = np.unique(slice_hashes(data, starts, ends), return_index=True, return_inverse=True)
        begin, lengths = starts[pick], (ends - starts)[pick]
        special = np.zeros(len(pick), dtype=bool)
        for i in np.flatnonzero(lengths == len(self.special)) if self.special else ():
            special[i] = data[begin[i] : begin[i] + lengths[i]].tobytes() == self.special
        plain = ~special
        ids, first, counts = self.ids_of(data, begin[plain], lengths[plain])
        all_first, all_counts = np.full(len(pick), len(ids)), np.ones(len(pick), dtype=np.int64)
        all_first[plain], all_counts[plain] = first, counts
        ids = np.append(ids, np.uint32(self.special_id)).astype(np.uint32)
        text = np.repeat(np.arange(len(per_text)), per_text)
        many = all_counts[back]
        return _ragged(ids, all_first[back], many), np.bincount(text, weights=many, minlength=len(per_text)).astype(np.int64)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the ids laid end to end, and how many each id has."""
        ends = self.arrays["token_ends"]
        lengths = ends[ids.astype(np.int64) + 1] - ends[ids]
        return _ragged(self.arrays["token_bytes"], ends[ids], lengths), lengths


@dataclass(frozen=True)
class SharedEncoder:
    arrays: SharedArrays
    special: bytes
    special_id: int

    def open(self) -> Encoder:
        return Encoder(self.arrays.open(), self.special, self.special_id)


def piece_counts(docs: DataFrame, special: bytes) -> DataFrame:
    """(piece, n): how often each piece of at most LONGEST_WORD bytes occurs in all texts."""

    def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = text_bytes(batch.column(0))
        for first, last in chunks(offsets, 8 << 20):
            part = data[offsets[first] : offsets[last]]
            starts, _ = pieces(part, offsets[first : last + 1], special)
            ends = np.append(starts[1:], len(part)) if len(starts) else starts
            _, pick, n = np.unique(slice_hashes(part, starts, ends), return_index=True, return_counts=True)
            lengths = (ends - starts)[pick]
            short = lengths <= LONGEST_WORD
            bounds = np.concatenate([[0], np.cumsum(lengths[short])]).astype(np.int32)
            words = _ragged(part, starts[pick][short], lengths[short])
            yield pa.RecordBatch.from_arrays(
                [pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(words)]), pa.array(n[short])],
                ["piece", "n"],
            )

    found = map_tables(docs.select("text"), count, "piece binary, n long")
    return found.groupBy("piece").agg(F.sum("n").alias("n"))


def compiled(rows: pa.Table) -> dict[str, np.ndarray]:
    """The transducer of a table of distinct pieces and their packed ids; no object is made for a row."""
    rows = rows.sort_by("piece")
    data, offsets = text_bytes(rows.column("piece"))
    ids, ends = text_bytes(rows.column("ids"))
    return compile_arrays(data, np.diff(offsets), ids.copy().view(np.uint32), np.diff(ends) // 4)


def prepare(docs: DataFrame, path: str, lexicon: int = LEXICON) -> SharedEncoder:
    """An encoder for the tokenizer file, with the `lexicon` most frequent pieces of `docs` compiled."""
    spark = docs.sparkSession
    vocabulary = Vocabulary.read(path)
    base = SharedArrays.send(spark, **vocabulary.arrays)
    plain = SharedEncoder(base, vocabulary.special, vocabulary.special_id)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = plain.open()
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            ids, first, counts = encoder.ids_of(data, offsets[:-1], np.diff(offsets))
            values = [ids[a : a + n].tobytes() for a, n in zip(first, counts, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["piece", "ids"])

    frequent = piece_counts(docs, vocabulary.special).where(F.col("piece") != F.lit(vocabulary.special))
    frequent = frequent.orderBy(F.desc("n"), "piece").limit(lexicon).select("piece")
    rows = frequent.repartition(16).mapInArrow(giving_back(encode), "piece binary, ids binary").toArrow()
    if not rows.num_rows:
        return plain
    lexical = SharedArrays.send(spark, **compiled(rows))
    del rows, vocabulary
    give_back()
    return SharedEncoder(SharedArrays(base.files | lexical.files), plain.special, plain.special_id)


def encode(docs: DataFrame, encoder: SharedEncoder, tokens: bool = True) -> DataFrame:
    """`docs` with ids, n_tokens, ids_sha256 and decoded_sha256 (hex), from whole texts.

    A null text is empty: no ids, n_tokens 0. `tokens=False` leaves the ids out. One row for each row of
    `docs`; columns with the names of the new ones are replaced.
    """
    kept = docs.drop("ids", "n_tokens", "ids_sha256", "decoded_sha256")
    more = "ids array<int>, " * tokens + "n_tokens long, ids_sha256 string, decoded_sha256 string"
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL(more).fields)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder.open()
        for batch in batches:
            data, offsets = text_bytes(batch.column("text"))
            for first, last in chunks(offsets):
                part = batch.slice(first, last - first)
                ids, counts = own.encode(data[offsets[first] : offsets[last]], offsets[first : last + 1])
                raw, sizes = own.decode(ids)
                cut = np.concatenate([[0], np.cumsum(counts)])
                ends = np.concatenate([[0], np.cumsum(sizes)])[cut]
                packed = [ids[a:b].tobytes() for a, b in zip(cut, cut[1:], strict=False)]
                texts = [raw[a:b].tobytes().decode("utf-8", "replace").encode() for a, b in zip(ends, ends[1:], strict=False)]
                added = [
                    pa.array(counts),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed], pa.string()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()),
                ]
                if tokens:
                    added.insert(0, pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(ids.view(np.int32))))
                yield pa.RecordBatch.from_arrays(part.columns + added, names)

    return kept.mapInArrow(giving_back(run), schema)


def decode(encoded: DataFrame, encoder: SharedEncoder) -> DataFrame:
    """`encoded` with `text` made from its `ids`; null ids give null. A `text` it has is replaced."""
    kept = encoded.drop("text")
    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL("text string").fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder.open()
        for batch in batches:
            texts = [
                None if x is None else own.decode(np.array(x, dtype=np.uint32))[0].tobytes().decode("utf-8", "replace")
                for x in batch.column("ids").to_pylist()
            ]
            yield batch.append_column("text", pa.array(texts, pa.string()))

    return kept.mapInArrow(giving_back(run), schema)


def op8_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    encoder = prepare(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return encode(docs, encoder, tokens=False).drop("text")
