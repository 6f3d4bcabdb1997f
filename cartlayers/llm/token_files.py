"""Token ids in compressed files that are decoded in parallel (rans.py).

A set of files is a folder with four tables:

- `frequencies`: id, freq. Shared by all blocks, learned from all documents.
- `blocks`: part, block, first, n_ids, doc_ids, lengths, payload, crc. A block holds whole documents, some
  BLOCK_IDS ids of them, or a single longer one; `first` counts the ids before it in its part.
- `parts`: part, base, n_ids. `base` counts the ids of the parts before.
- `settings`: the end id, which is appended to each document.

Parts are ranges of doc_id. Parquet holds the blocks, so a lost task is written anew and becomes visible
only as a whole, any file system that Spark writes to will do, and a reader of some ids skips the
other blocks by the statistics of `first`. What a payload holds is in rans.py.
"""

from __future__ import annotations

import gc
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.llm import rans
from cartlayers.llm.common import SharedArrays, shared_folder, stored, table
from cartlayers.llm.order import before
from cartlayers.llm.words import LOWER, NOT_SPACE, Words, byte_set, chunks, slice_hashes, text_bytes

BLOCK_IDS = 1 << 16
#: Ids that are encoded or decoded side by side.
TOGETHER_IDS = 1 << 22
#: Words, and pieces of words, whose ids a worker process remembers.
REMEMBERED = 500_000
TOKENIZER, END_ID = "word_bpe_49k.json", 2
BLOCKS = "part int, block int, first long, n_ids long, doc_ids array<long>, lengths array<long>, payload binary, crc long"


#: Pieces that the library's model gets in one call, and bytes of words that are cut together.
TOGETHER_PIECES, TOGETHER_BYTES = 1 << 13, 1 << 22

#: Bytes of words that are in normal form as they are, of plain letters and Latin-1 ones, which are C3 and another byte.
PLAIN, LATIN = byte_set((0x21, 0x7E)), byte_set((0x80, 0x96), (0x98, 0xB6), (0xB8, 0xBF))
LEAD = 0xC3
#: How the tokenizer cuts lower-cased text, for the bytes of such words: letters, single digits, others, and
#: a quote with what follows it, where nothing but a letter or a digit is before it.
BLANK, LETTER, DIGIT, OTHER = range(4)
KINDS = np.full(256, OTHER, dtype=np.uint8)
KINDS[0x20] = BLANK
KINDS[byte_set((0x61, 0x7A), (0x80, 0xFF))] = LETTER
KINDS[byte_set((0x30, 0x39))] = DIGIT
QUOTE, AFTER_QUOTE = ord("'"), [b"s", b"t", b"m", b"d", b"re", b"ve", b"ll"]


def byte_letters() -> dict[int, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different ones in order, a place of each, and which one stands at every place."""
    order = np.argsort(hashes)
    ordered = hashes[order]
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = ordered[1:] != ordered[:-1]
    kept, picked = ordered[head], order[head]
    del ordered
    place = np.cumsum(head)
    place -= 1
    which = np.empty(len(hashes), dtype=np.int64)
    which[order] = place
    return kept, picked, which


def _spans(firsts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All places of slices, one after the other."""
    begin = np.cumsum(counts)
    np.subtract(firsts, begin, out=begin)
    begin += counts
    places = np.repeat(begin, counts)
    places += np.arange(len(places))
    return places


class _Memory:
    """Ids of words or pieces by their hashes, which are kept in order."""

    def __init__(self) -> None:
        self.hashes, self.again = np.zeros(0, np.uint64), np.zeros(0, bool)
        self.firsts, self.counts, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)

    def unknown(self, hashes: np.ndarray) -> np.ndarray:
        """Which of some ordered hashes are not there; the others count as met again."""
        if not len(self.hashes):
            return np.ones(len(hashes), dtype=bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        unknown = self.hashes[at] != hashes
        self.again[at[~unknown]] = True
        return unknown

    def learn(self, hashes: np.ndarray, firsts: np.ndarray, counts: np.ndarray, ids: np.ndarray) -> None:
        """Take in ordered hashes that are not there; `firsts` are places in `ids`."""
        at = np.searchsorted(self.hashes, hashes)
        self.hashes, self.again = np.insert(self.hashes, at, hashes), np.insert(self.again, at, False)
        self.firsts, self.counts = np.insert(self.firsts, at, firsts + len(self.ids)), np.insert(self.counts, at, counts)
        self.ids = np.concatenate([self.ids, ids])

    def slices(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where in `ids` those of each hash begin, and how many there are."""
        at = np.searchsorted(self.hashes, hashes)
        return self.firsts[at], self.counts[at]

    def shrink(self) -> None:
        """Beyond REMEMBERED, keep only what was met again since it came or was kept, or nothing if that is more than half of it."""
        if len(self.hashes) <= REMEMBERED:
            return
        kept = self.again & (2 * int(self.again.sum()) <= REMEMBERED)
        self.ids = self.ids[_spans(self.firsts[kept], self.counts[kept])]
        self.hashes, self.counts = self.hashes[kept], self.counts[kept]
        self.firsts, self.again = np.cumsum(self.counts) - self.counts, np.zeros(len(self.hashes), dtype=bool)


class WordIds:
    """Ids of texts by a tokenizer that never joins anything across ASCII white space.

    The file's tokenizer drops white space and splits there, after a normalization that no white space
    takes part in, so a text has the ids of its words, one after the other. Words are told apart by
    64-bit hashes, and each different one goes through the tokenizers library once: simple ones are cut here,
    all together, and their different pieces given to its model, many in one call; all others go through
    its whole pipeline. A text that is not UTF-8 has replacement characters.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = [re.escape(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile(b"|".join(added) if added else rb"(?!)")
        # no byte's letter is white space, so blanks tell pieces apart
        self.letters = np.array([code for _, code in sorted((byte_letters() | {0x20: 0x20}).items())], dtype="<u4")
        self.model = self.tokenizer.model
        self.pieces_only = Tokenizer(self.model)
        self.pieces_only.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        vocabulary, suffix = self.tokenizer.get_vocab(with_added_tokens=False), self.model.end_of_word_suffix
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.words, self.pieces = _Memory(), _Memory()

    def _model_ids(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces, one after the other, and how many each has."""
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a in range(0, len(raw), TOGETHER_PIECES):
            some = raw[a : a + TOGETHER_PIECES]
            spelled = self.letters[np.frombuffer(b" ".join(some), np.uint8)].tobytes().decode("utf-32-le")
            coded = self.pieces_only.encode_batch_fast([spelled], add_special_tokens=False)[0].ids
            found = np.array(coded, dtype=np.uint32)
            ends = np.flatnonzero(self.last[found]) + 1
            # a piece has at most one id that ends words, its last; if some have none, each is asked for alone
            if len(ends) != len(some) or ends[-1] != len(found):
                alone = [[t.id for t in self.model.tokenize(piece)] for piece in spelled.split(" ")]
                found = np.fromiter(chain.from_iterable(alone), np.uint32)
                ends = np.cumsum(np.fromiter(map(len, alone), np.int64, len(alone)))
            ids.append(found)
            counts.append(np.diff(ends, prepend=0))
        return np.concatenate(ids), np.concatenate(counts)

    def _simple(self, data: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of simple words, each with a blank after it, and how many each has; `sizes` count the blanks."""
        low = LOWER[data]
        latin = np.flatnonzero(data[:-1] == LEAD) + 1
        low[latin] |= 0x20 * (data[latin] < 0x9F).astype(np.uint8)
        kind = KINDS[low]
        start = kind == DIGIT
        start[0] = True
        start[1:] |= kind[1:] != kind[:-1]
        quote = np.flatnonzero((low == QUOTE) & start)
        after, then = low[quote + 1], low[np.minimum(quote + 2, len(low) - 1)]
        size = np.zeros(len(quote), dtype=np.int64)
        for letters in AFTER_QUOTE:
            size[(after == letters[0]) & ((len(letters) == 1) | (then == letters[-1]))] = len(letters)
        quote, size = quote[size > 0], size[size > 0]
        start[quote + 1] = False
        rest = quote + 1 + size
        start[rest] |= kind[rest] == LETTER
        start &= kind != BLANK
        starts = np.flatnonzero(start)
        ends = np.append(starts[1:], len(low))
        ends -= kind[ends - 1] == BLANK
        hashes, pick, which = _distinct(slice_hashes(low, starts, ends))
        new = self.pieces.unknown(hashes)
        if new.any():
            raw, at = low.tobytes(), pick[new]
            ids, counts = self._model_ids([raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)])
            self.pieces.learn(hashes[new], np.cumsum(counts) - counts, counts, ids)
        of_words = np.searchsorted(starts, np.cumsum(sizes) - sizes)
        # a long word of digits has a piece a byte
        del low, kind, start, starts, ends
        firsts, counts = (x[which] for x in self.pieces.slices(hashes))
        del which
        return self.pieces.ids[_spans(firsts, counts)], np.add.reduceat(counts, of_words)

    def _words(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words; where those of each word begin, and how many there are."""
        raw = b" ".join([*words, b""])
        data, sizes = np.frombuffer(raw, np.uint8), np.fromiter(map(len, words), np.int64, len(words)) + 1
        lead = data == LEAD
        sound = PLAIN[data] | lead | (data == 0x20)
        sound[1:] = np.where(lead[:-1], LATIN[data[1:]], sound[1:])
        strange = np.concatenate([np.flatnonzero(~sound), np.array([m.start() for m in self.special.finditer(raw)], np.int64)])
        simple = np.ones(len(words), dtype=bool)
        simple[np.searchsorted(np.cumsum(sizes), strange, side="right")] = False
        other = np.flatnonzero(~simple)
        plain, sizes = data[np.repeat(simple, sizes)], sizes[simple]
        places = np.concatenate([[0], np.cumsum(sizes)])
        found = [self._simple(plain[places[a] : places[b]], sizes[a:b]) for a, b in chunks(places, TOGETHER_BYTES)]
        ids = np.concatenate([np.zeros(0, np.uint32), *[x for x, _ in found]])
        many = np.concatenate([np.zeros(0, np.int64), *[x for _, x in found]])
        # there is nothing in a cycle, and looking for some takes longer than the words
        gc.disable()
        coded = [e.ids for e in self.tokenizer.encode_batch_fast([words[i].decode("utf-8", "replace") for i in other], add_special_tokens=False)]
        gc.enable()
        firsts, counts = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        counts[simple], counts[other] = many, np.fromiter(map(len, coded), np.int64, len(coded))
        firsts[simple] = np.cumsum(many) - many
        firsts[other] = len(ids) + np.cumsum(counts[other]) - counts[other]
        return np.concatenate([ids, np.fromiter(chain.from_iterable(coded), np.uint32)]), firsts, counts

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of texts laid end to end, and how many each text has."""
        self.words.shrink()
        self.pieces.shrink()
        words = Words(data, offsets, NOT_SPACE)
        hashes, pick, which = _distinct(slice_hashes(data, words.starts, words.ends))
        new = self.words.unknown(hashes)
        if new.any():
            raw, at = data.tobytes(), pick[new]
            ids, firsts, counts = self._words([raw[a:b] for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist(), strict=True)])
            self.words.learn(hashes[new], firsts, counts, ids)
        firsts, many = (x[which] for x in self.words.slices(hashes))
        cut = np.concatenate([[0], np.cumsum(many)])[words.first]
        return self.words.ids[_spans(firsts, many)], np.diff(cut)


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The encoder of a worker process, whose words later tasks of that process need not encode again."""
    return WordIds(path)


def width(tokenizer: str, end_id: int) -> str:
    """The smallest type that holds all ids of a vocabulary."""
    top = max(end_id, WordIds(tokenizer).tokenizer.get_vocab_size(with_added_tokens=True))
    return "<u2" if top < 1 << 16 else "<u4"


def tokenized(docs: DataFrame, path: str, end_id: int, kind: str) -> DataFrame:
    """doc_id, ids (bytes of the type `kind`) and their hash `tie`, from whole texts with the end id; null is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = word_ids(path), np.array([end_id], kind).tobytes()
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for first, last in chunks(offsets, 16 << 20):
                ids, counts = encoder.encode(data[offsets[first] : offsets[last]], offsets[first : last + 1])
                raw, cut = memoryview(ids.astype(kind).tobytes()), np.concatenate([[0], np.cumsum(counts)]) * np.dtype(kind).itemsize
                own = [bytes(raw[a:b]) + end for a, b in zip(cut, cut[1:], strict=False)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(own, pa.binary())], ["doc_id", "ids"])

    kept = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return kept.mapInArrow(run, "doc_id long, ids binary").withColumn("tie", F.xxhash64("ids"))


def id_counts(tokens: DataFrame, kind: str) -> DataFrame:
    """id, n: how often each id occurs. A task gives off each id once per so many ids as there are different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            data, _ = text_bytes(batch.column(0))
            seen = np.bincount(np.frombuffer(data, kind), minlength=len(total))
            seen[: len(total)] += total
            total = seen
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total[ids])], ["id", "n"])

    return tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def _encoded(shared: SharedArrays, kind: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a part, whose documents come in order."""
    frequencies = rans.Table.of(shared.open()["freq"])
    part, block, first = TaskContext.get().partitionId(), 0, 0
    waiting: list[tuple[list, list[np.ndarray]]] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal block, first, waiting, held
        together = [np.concatenate(ids) for _, ids in waiting]
        usual = [i for i, ids in enumerate(together) if len(ids) <= BLOCK_IDS]
        payloads = dict(zip(usual, rans.encode(frequencies, [together[i] for i in usual]), strict=True))
        # a long document alone: beside it the others would be as wide
        payloads |= {i: rans.encode(frequencies, [ids])[0] for i, ids in enumerate(together) if i not in payloads}
        rows = []
        for i, (doc_ids, ids) in enumerate(waiting):
            rows.append((part, block, first, len(together[i]), doc_ids, [len(x) for x in ids], payloads[i], zlib.crc32(payloads[i])))
            block, first = block + 1, first + len(together[i])
        waiting, held = [], 0
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.int64()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["part", "block", "first", "n_ids", "doc_ids", "lengths", "payload", "crc"])

    filled = BLOCK_IDS
    for batch in batches:
        data, offsets = text_bytes(batch.column("ids"))
        for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
            ids = np.frombuffer(data[offsets[i] : offsets[i + 1]].tobytes(), kind)
            if not waiting or filled + len(ids) > BLOCK_IDS:
                if held >= TOGETHER_IDS:
                    yield flush()
                waiting.append(([], []))
                filled = 0
            waiting[-1][0].append(doc_id)
            waiting[-1][1].append(ids)
            filled, held = filled + len(ids), held + len(ids)
    if waiting:
        yield flush()


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID) -> None:
    """Write the ids of every document's whole text, each followed by `end_id`, in order of doc_id to `path`.

    Documents without an id come first, and those of one id in order of a hash of their ids; equal
    rows are documents each. A null text has the end id only. Other columns are ignored.
    """
    spark = docs.sparkSession
    kind = width(tokenizer, end_id)
    tokens = stored(tokenized(docs, tokenizer, end_id, kind))
    counted = id_counts(tokens, kind).toArrow()
    counts = np.zeros(int(max(counted.column("id").to_pylist(), default=0)) + 1)
    counts[counted.column("id").to_numpy()] = counted.column("n").to_numpy()
    freq = rans.frequencies(counts)
    shared = SharedArrays.send(spark, freq=freq)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = tokens.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    ordered.select("doc_id", "ids").mapInArrow(lambda batches: _encoded(shared, kind, batches), BLOCKS).write.parquet(f"{path}/blocks")
    totals = spark.read.schema(BLOCKS).parquet(f"{path}/blocks").groupBy("part").agg(F.sum("n_ids").alias("n_ids"))
    before(totals.withColumn("all", F.lit(0)), "n_ids", ["all"]).drop("all").write.parquet(f"{path}/parts")
    used = np.flatnonzero(freq)
    rows = pa.table({"id": pa.array(used), "freq": pa.array(freq[used].astype(np.int64))})
    spark.createDataFrame(rows).coalesce(1).write.parquet(f"{path}/frequencies")
    spark.createDataFrame([(end_id,)], "end_id long").coalesce(1).write.parquet(f"{path}/settings")


@dataclass(frozen=True)
class TokenFiles:
    """A set of files that was written before."""

    spark: SparkSession
    path: str

    def _blocks(self) -> DataFrame:
        parts = self.spark.read.schema("part int, n_ids long, base long").parquet(f"{self.path}/parts")
        blocks = self.spark.read.schema(BLOCKS).parquet(f"{self.path}/blocks")
        return blocks.join(parts.select("part", "base"), "part").withColumn("start", F.col("base") + F.col("first"))

    def _frequencies(self) -> SharedArrays:
        """The table, at most as large as a vocabulary, for all tasks."""
        rows = self.spark.read.schema("id long, freq long").parquet(f"{self.path}/frequencies").toArrow()
        freq = np.zeros(int(max(rows.column("id").to_pylist())) + 1, dtype=np.uint32)
        freq[rows.column("id").to_numpy()] = rows.column("freq").to_numpy()
        return SharedArrays.send(self.spark, freq=freq)

    def documents(self, ids: bool = True) -> DataFrame:
        """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, unless left out, ids.

        Both the checksums of the payloads and those of their segments are verified; a damaged file ends
        the query with an error.
        """
        shared = self._frequencies()
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * ids
        names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * ids

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequencies = rans.Table.of(shared.open()["freq"])
            for batch, found in _decoded(frequencies, batches):
                for start, doc_ids, lengths, own in zip(
                    batch.column("start").to_pylist(), batch.column("doc_ids"), batch.column("lengths"), found, strict=True
                ):
                    sizes = lengths.values.to_numpy()
                    if int(sizes.sum()) != len(own):
                        raise rans.DamagedError("a block does not hold the ids of its documents")
                    cut = np.concatenate([[0], np.cumsum(sizes)])
                    raw = memoryview(own.astype("<u4").tobytes())
                    sums = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(cut, cut[1:], strict=False)]
                    columns = [doc_ids.values, pa.array(start + cut[:-1]), pa.array(sizes), pa.array(sums, pa.int64())]
                    if ids:
                        columns.append(pa.ListArray.from_arrays(pa.array(cut.astype(np.int32)), pa.array(own.view(np.int32))))
                    yield pa.RecordBatch.from_arrays(columns, names)

        return self._blocks().select("start", "n_ids", "doc_ids", "lengths", "payload", "crc").mapInArrow(run, schema)

    def between(self, first: int, last: int) -> DataFrame:
        """start, ids: the ids at the places from `first` up to `last` (excluded), a row for each block they are in.

        Only segments from the checkpoint before are decoded, and only blocks with such ids are read.
        """
        shared = self._frequencies()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            frequencies = rans.Table.of(shared.open()["freq"])
            for batch in batches:
                for start, payload, crc in zip(*[batch.column(c).to_pylist() for c in ("start", "payload", "crc")], strict=True):
                    segments = rans.Segments.read(_sound(payload, crc), frequencies.bits, first - start, last - start)
                    own = rans.decode(frequencies, [segments])[0]
                    low = max(first - start - segments.first, 0)
                    own = own[low : max(last - start - segments.first, 0)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([start + segments.first + low]), pa.ListArray.from_arrays([0, len(own)], pa.array(own.view(np.int32)))],
                        ["start", "ids"],
                    )

        near = self._blocks().where((F.col("start") < last) & (F.col("start") + F.col("n_ids") > first))
        return near.select("start", "payload", "crc").mapInArrow(run, "start long, ids array<int>")


def _sound(payload: bytes, crc: int) -> bytes:
    if zlib.crc32(payload) != crc:
        raise rans.DamagedError("the checksum of a block does not agree")
    return payload


def _decoded(frequencies: rans.Table, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Some blocks at a time, with their ids."""
    for batch in batches:
        ends = np.concatenate([[0], np.cumsum(batch.column("n_ids").to_numpy())])
        for a, b in chunks(ends, TOGETHER_IDS):
            some = batch.slice(a, b - a)
            payloads = zip(some.column("payload").to_pylist(), some.column("crc").to_pylist(), strict=True)
            yield some, rans.decode(frequencies, [rans.Segments.read(_sound(p, c), frequencies.bits) for p, c in payloads])


def op11_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """All documents written, and what the files say about each when they are read back."""
    path = shared_folder(spark)
    write(table(spark, folder, "documents"), path, public_tokenizers.path(TOKENIZER))
    return TokenFiles(spark, path).documents(ids=False)
