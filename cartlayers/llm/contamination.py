"""Benchmark passages in training texts, found by backward search in an FM-index per shard of texts.

A task cuts its texts into shards of about 300,000 words, indexes each (fm_index.py) and looks for
all benchmark windows at once. Occurrences are located by sampled suffix positions, mark the words
they cover, and the marks are merged into spans. Windows are held by every task, in blocks of bounded
number; further blocks are further passes over the texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.llm.common import map_tables, stored, table
from cartlayers.llm.fm_index import FMIndex
from cartlayers.llm.words import ALPHANUMERIC, Words, chunks, expand, text_bytes

WINDOW = 13
SHARD_WORDS = 300_000
WINDOWS_PER_BLOCK = 200_000
SPANS = "array<struct<begin:int,end:int>>"
ADDED = f"n_words long, word_spans {SPANS}, items array<string>"
_SPAN_TYPE = pa.struct([("begin", pa.int32()), ("end", pa.int32())])


@dataclass(frozen=True)
class Windows:
    """Distinct windows: word hashes, zero beyond a window's length, and the items that have each."""

    hashes: np.ndarray
    lengths: np.ndarray
    items: list[list[str]]


def windows_of(benchmark: DataFrame) -> DataFrame:
    """(item, window): every run of WINDOW words of every item, or all words of a shorter one."""

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        data, offsets = text_bytes(batch.column(1))
        for first, last in chunks(offsets):
            words = Words(data[offsets[first] : offsets[last]], offsets[first : last + 1], ALPHANUMERIC)
            hashes = words.hashes()
            item, begin = expand(np.where(words.counts > 0, np.maximum(words.counts - WINDOW + 1, 1), 0))
            begin += words.first[item]
            end = np.minimum(begin + WINDOW, words.first[item + 1])
            packed = [hashes[a:b].tobytes() for a, b in zip(begin, end, strict=True)]
            names = batch.column(0).slice(first, last - first).take(pa.array(item))
            yield pa.RecordBatch.from_arrays([names, pa.array(packed, pa.binary())], ["item", "window"])

    named = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), "text")
    return map_tables(named, cut, "item string, window binary").distinct()


def window_blocks(benchmark: DataFrame) -> Iterator[Windows]:
    """All windows, at most about WINDOWS_PER_BLOCK at a time."""
    found = stored(windows_of(benchmark))
    blocks = 1 + found.count() // WINDOWS_PER_BLOCK
    block_of = F.pmod(F.xxhash64("window"), F.lit(blocks))
    for block in range(blocks):
        rows = found.where(block_of == block).groupBy("window").agg(F.collect_set("item").alias("items")).collect()
        lengths = np.array([len(r.window) // 8 for r in rows], dtype=np.int64)
        hashes = np.zeros((len(rows), WINDOW), dtype=np.uint64)
        for i, r in enumerate(rows):
            hashes[i, : lengths[i]] = np.frombuffer(bytes(r.window), np.uint64)
        yield Windows(hashes, lengths, [r["items"] for r in rows])


def _occurrences(hashes: np.ndarray, of: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Where (as index of the first word) which window occurs in a shard; words of `of` are one text."""
    vocabulary, which = np.unique(hashes, return_inverse=True)
    ends = np.flatnonzero(np.append(of[1:] != of[:-1], True))
    symbols = np.insert(which + 2, ends + 1, 1)
    index = FMIndex(np.append(symbols, 0))
    spot = np.minimum(np.searchsorted(vocabulary, windows.hashes), len(vocabulary) - 1)
    patterns = np.where(vocabulary[spot] == windows.hashes, spot + 2, -1)
    low, high = index.search(patterns, windows.lengths)
    which, place = expand(high - low)
    at = index.locate(low[which] + place)
    return at - np.searchsorted(ends + 1 + np.arange(1, len(ends) + 1), at, side="right"), which


def _shards(counts: np.ndarray) -> Iterator[list[tuple[int, int]]]:
    """Shards as lists of word ranges; a text too long for one shard is cut with an overlap."""
    pieces: list[tuple[int, int]] = []
    held, begin = 0, 0
    for n in counts:
        for a in range(0, max(1, n), SHARD_WORDS):
            piece = (begin + a, begin + min(n, a + SHARD_WORDS + WINDOW - 1))
            if held and held + piece[1] - piece[0] > SHARD_WORDS:
                yield pieces
                pieces, held = [], 0
            pieces.append(piece)
            held += piece[1] - piece[0]
        begin += n
    if held:
        yield pieces


def _mark(hashes: np.ndarray, words: Words, covered: np.ndarray, windows: Windows) -> np.ndarray:
    """Mark covered words; which (text, window) pairs occur, as rows."""
    pairs = [np.zeros((0, 2), dtype=np.int64)]
    for pieces in _shards(words.counts):
        ranges = np.array(pieces, dtype=np.int64)
        piece, place = expand(ranges[:, 1] - ranges[:, 0])
        if not len(piece):
            continue
        word = ranges[piece, 0] + place
        at, which = _occurrences(hashes[word], piece, windows)
        if len(at):
            begin = word[at]
            change = np.zeros(len(covered) + 1, dtype=np.int32)
            np.add.at(change, begin, 1)
            np.add.at(change, begin + windows.lengths[which], -1)
            covered |= np.cumsum(change[:-1]) > 0
            pairs.append(np.unique(np.stack([words.of[begin], which], axis=1), axis=0))
    return np.concatenate(pairs)


def _runs_of(covered: np.ndarray, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, word after the last, and text of each run of covered words."""
    edge = np.ones(len(covered), dtype=bool)
    edge[1:] = words.of[1:] != words.of[:-1]
    first, last = covered.copy(), covered.copy()
    first[1:] &= ~covered[:-1] | edge[1:]
    last[:-1] &= ~covered[1:] | edge[1:]
    begin = np.flatnonzero(first)
    return begin, np.flatnonzero(last) + 1, words.of[begin]


def _span_lists(begin: np.ndarray, end: np.ndarray, text: np.ndarray, texts: int) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=texts))]).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(begin, pa.int32()), pa.array(end, pa.int32())], fields=list(_SPAN_TYPE))
    return pa.ListArray.from_arrays(pa.array(offsets), spans)


def _first_copies(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text, the first one with the same bytes."""
    seen: dict[bytes, int] = {}
    return np.array(
        [seen.setdefault(data[a:b].tobytes(), i) for i, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False))],
        dtype=np.int64,
    )


def _searched(column: pa.Array, earlier: pa.Array | None, windows: Windows) -> Iterator[tuple[int, int, list[pa.Array]]]:
    """Rows from, to, and for these the word counts, word spans and new items."""
    every, offsets = text_bytes(column)
    for first, last in chunks(offsets, 8 * SHARD_WORDS):
        data, own = every[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        copy_of = _first_copies(data, own)
        lead = np.unique(copy_of)
        if len(lead) < len(copy_of):
            data = np.concatenate([data[own[i] : own[i + 1]] for i in lead])
            own = np.concatenate([[0], np.cumsum(np.diff(own)[lead])])
        words = Words(data, own, ALPHANUMERIC)
        covered = np.zeros(len(words.starts), dtype=bool)
        back = np.searchsorted(lead, copy_of)
        if earlier is not None:
            for i, spans in enumerate(earlier.slice(first, last - first).take(pa.array(lead)).to_pylist()):
                for span in spans:
                    covered[words.first[i] + span["begin"] : words.first[i] + span["end"]] = True
        pairs = _mark(words.hashes(), words, covered, windows)
        begin, end, text = _runs_of(covered, words)
        base = words.first[text]
        items: list[set[str]] = [set() for _ in lead]
        for i, which in pairs:
            items[i].update(windows.items[which])
        lists = [
            pa.array(words.counts),
            _span_lists(begin - base, end - base, text, len(lead)),
            pa.array([sorted(x) for x in items], pa.list_(pa.string())),
        ]
        yield first, last, [x.take(pa.array(back)) for x in lists]


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """`docs` with n_words, word_spans, items and contaminated.

    word_spans are the merged ranges [begin, end) of words inside occurrences of benchmark windows,
    items the ids (as strings, in order) of the benchmark items that occur. A document is contaminated
    if it has a hit and at least one word in twenty is hit. Null and wordless texts have no words and
    are never hit; items without words match nothing; items with the same id count once, and a null id
    counts as "null". Every row of `docs` is kept once, repeated ones too; columns with the names of
    the new ones are replaced. Without benchmark items nothing is hit.
    """
    names = ["n_words", "word_spans", "items", "contaminated"]
    found, kept = docs.drop(*names), docs.drop(*names).columns
    for block, windows in enumerate(window_blocks(benchmark)):
        found = _one_block(found, windows, block)
    hit = F.aggregate("word_spans", F.lit(0), lambda total, span: total + span.end - span.begin).cast("long")
    return found.select(
        *kept, "n_words", "word_spans", F.array_sort("items").alias("items"),
        ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated"),
    )


def _one_block(found: DataFrame, windows: Windows, block: int) -> DataFrame:
    """One pass over the texts, adding to what earlier blocks have found."""
    base = found.drop("n_words", "word_spans", "items")
    schema = T.StructType(base.schema.fields + T.StructType.fromDDL(ADDED).fields)
    carried = len(base.columns)

    def search(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        earlier = batch.column("word_spans") if block else None
        for first, last, added in _searched(batch.column("text"), earlier, windows):
            part = batch.slice(first, last - first)
            if block:
                before = part.column("items").to_pylist()
                added[2] = pa.array([sorted({*a, *b}) for a, b in zip(before, added[2].to_pylist(), strict=True)], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays(part.columns[:carried] + added, schema.names)

    return map_tables(found.select(*base.columns, *(["n_words", "word_spans", "items"] if block else [])), search, schema)


def op10_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, folder, "benchmark"))
    hit = F.aggregate("word_spans", F.lit(0), lambda total, span: total + span.end - span.begin).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )
