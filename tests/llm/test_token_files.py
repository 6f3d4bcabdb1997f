from __future__ import annotations

import json
import random
import zlib
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given as hypothetically
from hypothesis import settings, strategies
from tokenizers import Tokenizer

from cartlayers.llm import rans
from cartlayers.llm import token_files as m
from cartlayers.llm.common import shared_folder
from tests.llm.fixtures import FOLDER, given, no_documents, odd_documents

PATH = public_tokenizers.path(m.TOKENIZER)
STRANGE = [
    "it's\tI'll don't\x0bx\x0cy\x1cz\x85w\xa0v u　t", "<|endoftext|>a <|startoftext|> # <|endoftext|", "a ́b é ẛ̣",
    "ÀÉ İstanbul ΑΣ ﬁ 12 3x\r\n\n--!!", "﻿한글 각 ก็ 中文。字", "x" * 5000, " ", " a b̈́ ̈́",
]


@lru_cache
def library() -> Tokenizer:
    return Tokenizer.from_file(PATH)


def library_ids(text) -> list[int]:
    return library().encode(text or "", add_special_tokens=False).ids


def blocks_of(sizes, top, seed=3):
    rng = np.random.default_rng(seed)
    return [np.minimum(rng.geometric(0.01, n) - 1, top - 1).astype(np.uint32) for n in sizes]


def table_of(blocks, top):
    return rans.Table.of(rans.frequencies(np.bincount(np.concatenate(blocks), minlength=top)))


@pytest.mark.parametrize("top", [1, 2, 300, 70_000])
def test_round_trip_of_blocks_of_any_size(top):
    blocks = blocks_of([0, 1, 31, 32, 33, 8191, 8192, 8193, 20_000], top)
    table = table_of([*blocks, np.arange(top, dtype=np.uint32)], top)
    read = [rans.Segments.read(p, table.bits) for p in rans.encode(table, blocks)]
    for ids, found in zip(blocks, rans.decode(table, read), strict=True):
        assert np.array_equal(ids, found)


@settings(max_examples=30, deadline=None)
@hypothetically(strategies.lists(strategies.integers(0, 10**12), min_size=1, max_size=3000))
def test_frequencies_keep_every_id(counts):
    freq = rans.frequencies(np.array(counts)).astype(np.int64)
    total = int(freq.sum())
    assert total & (total - 1) == 0 and total >= 1 << rans.BITS
    assert all(f > 0 for f, c in zip(freq, counts, strict=True) if c)


def test_size_is_near_the_entropy():
    blocks = blocks_of([65_536] * 2, 5000)
    table = table_of(blocks, 5000)
    p = np.bincount(np.concatenate(blocks)) / 131_072
    entropy = -(p[p > 0] * np.log2(p[p > 0])).sum() * 131_072 / 8
    assert sum(map(len, rans.encode(table, blocks))) < 1.05 * entropy


def test_a_checkpoint_is_enough_to_decode_from():
    ids = blocks_of([50_000], 900)[0]
    table = table_of([ids], 900)
    payload = rans.encode(table, [ids])[0]
    for low, high in [(0, 1), (8191, 8193), (20_000, 30_000), (49_999, 50_000), (7, 7), (50_000, 60_000)]:
        part = rans.Segments.read(payload, table.bits, low, high)
        found = rans.decode(table, [part])[0]
        assert len(found) < high - low + 2 * rans.LANES * rans.EVERY
        assert np.array_equal(found[low - part.first : high - part.first], ids[low:high])


def test_damage_is_found():
    ids = blocks_of([20_000], 900)[0]
    table = table_of([ids], 900)
    payload = rans.encode(table, [ids])[0]
    rng = random.Random(4)
    for at in [0, 9, *[rng.randrange(len(payload)) for _ in range(40)]]:
        broken = bytearray(payload)
        broken[at] ^= 1 << rng.randrange(8)
        with pytest.raises(rans.DamagedError):
            rans.decode(table, [rans.Segments.read(bytes(broken), table.bits)])
    for size in (0, 5, 30, len(payload) - 4):
        with pytest.raises(rans.DamagedError):
            rans.Segments.read(payload[:size], table.bits)


def encoded(encoder, *texts):
    raw = [t.encode() for t in texts]
    return encoder.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))


def test_words_have_the_ids_of_the_library():
    texts = [*STRANGE, " ".join(STRANGE), "", "", "<|ENDOFTEXT|> it's", ""]
    ids, counts = encoded(m.WordIds(PATH), *texts)
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [library_ids(t) for t in texts]


@settings(max_examples=300, deadline=None)
@hypothetically(strategies.text(strategies.sampled_from(" \t\n'aAsStTlLdDmMrReEvV09.,<|>éÉÿßŸ×÷µªãǺ中ΑΣ\x1c\xa0\x00~"), max_size=25))
def test_any_text_has_the_ids_of_the_library(text):
    assert list(encoded(m.word_ids(PATH), text)[0]) == library().encode(text, add_special_tokens=False).ids


def test_forgotten_words_are_encoded_again(monkeypatch):
    monkeypatch.setattr(m, "REMEMBERED", 2)
    encoder = m.WordIds(PATH)
    for text in ["one two three", "three four", "one", ""]:
        assert list(encoded(encoder, text)[0]) == library_ids(text)


class Counted:
    """The library's model or tokenizer, with the number of calls that encode something."""

    def __init__(self, inner):
        self.inner, self.calls = inner, 0

    def __getattr__(self, name):
        self.calls += name in ("tokenize", "encode", "encode_batch", "encode_batch_fast")
        return getattr(self.inner, name)


def watched_encoder():
    encoder = m.WordIds(PATH)
    seen = [name for name, value in vars(encoder).items() if type(value).__module__.startswith("tokenizers")]
    for name in seen:
        setattr(encoder, name, Counted(getattr(encoder, name)))
    return encoder, lambda: sum(getattr(encoder, name).calls for name in seen)


def test_new_words_take_few_calls_of_the_library():
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdeéÉS'.7", k=12)) for _ in range(4000))
    encoder, calls = watched_encoder()
    assert list(encoded(encoder, text)[0]) == library_ids(text)
    assert calls() < 40


def test_words_met_again_are_kept_when_others_are_forgotten(monkeypatch):
    monkeypatch.setattr(m, "REMEMBERED", 40)
    encoder, calls = watched_encoder()
    often = "the often met words, don't forget"
    for i in range(4):
        text = often + "".join(f" w{chr(97 + i)}{chr(97 + j)}" for j in range(20))
        assert list(encoded(encoder, text)[0]) == library_ids(text)
    before = calls()
    assert list(encoded(encoder, often)[0]) == library_ids(often)
    assert calls() == before


def test_bytes_that_are_no_text_are_replaced():
    raw = [b"\xc3", b"\xc3\xa9\xa9 a\xc3", b"\xc3\xc3\xa9 \xa9\xc3\x97 x\xc3\xb7", b"don't \xff'S \xc3\x89'S'tx 5'd"]
    ids, counts = m.WordIds(PATH).encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]))
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [library_ids(t.decode("utf-8", "replace")) for t in raw]


def test_a_vocabulary_without_some_letters(tmp_path):
    content = json.loads(library().to_str())
    content["model"] |= {"vocab": {"a": 0, "b": 1, "b</w>": 2, "'": 3, "s</w>": 4}, "merges": []}
    path = tmp_path / "few.json"
    path.write_text(json.dumps(content))
    texts = ["ab ba", "a", "b's aab's c bcb", "b " * 9000 + "a"]
    ids, counts = encoded(m.WordIds(str(path)), *texts)
    few = Tokenizer.from_file(str(path))
    assert [list(x) for x in np.split(ids, np.cumsum(counts)[:-1])] == [few.encode(t, add_special_tokens=False).ids for t in texts]


def expected(rows) -> list[tuple]:
    found, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*library_ids(text), m.END_ID]
        found.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return found


def test_whole_table(spark):
    rows = [(r.doc_id, r.text) for r in given(spark, "documents").collect()]
    found = m.op11_token_files(spark, FOLDER)
    assert found.dtypes == [("doc_id", "bigint"), ("start", "bigint"), ("n_tokens", "bigint"), ("ids_crc32", "bigint")]
    assert sorted(map(tuple, found.collect())) == expected(rows)


def test_odd_documents_and_places(spark, monkeypatch):
    docs = odd_documents(spark).repartition(3)
    path = shared_folder(spark)
    m.write(docs, path, PATH)
    files = m.TokenFiles(spark, path)
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = files.documents().orderBy("start").collect()
    want = expected(rows)
    assert [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found] == want
    every = [i for r in found for i in r.ids]
    assert every.count(m.END_ID) >= len(rows)
    for first, last in [(0, 10), (len(every) // 2, len(every) // 2 + 9000), (0, len(every)), (len(every) - 1, len(every) + 5), (4, 4)]:
        parts = files.between(first, last).orderBy("start").collect()
        assert [i for p in parts for i in p.ids] == every[first:last]
        assert all(every[p.start : p.start + len(p.ids)] == p.ids for p in parts)


def test_no_documents(spark):
    path = shared_folder(spark)
    m.write(no_documents(spark), path, PATH)
    assert m.TokenFiles(spark, path).documents().collect() == []


def test_damaged_files_end_the_query(spark):
    path = shared_folder(spark)
    m.write(given(spark, "documents").limit(3), path, PATH)
    blocks = spark.read.parquet(f"{path}/blocks")
    other = shared_folder(spark)
    blocks.withColumn("crc", m.F.col("crc") + 1).write.parquet(f"{other}/blocks")
    for name in ("parts", "frequencies"):
        spark.read.parquet(f"{path}/{name}").write.parquet(f"{other}/{name}")
    with pytest.raises(Exception, match="checksum of a block"):
        m.TokenFiles(spark, other).documents().collect()
