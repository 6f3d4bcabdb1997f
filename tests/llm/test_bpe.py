from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from cartlayers.llm import bpe as m
from cartlayers.llm.transducer import compile_words, find
from tests.llm.fixtures import FOLDER, documents, given, no_documents, odd_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [*"ab'sdtrevml  \n\t1€é½中🎉.,!<|>", "<|endoftext|>", "'re", "'ll", " '", "\r\n", "  ", "the ", " house"]


@pytest.fixture(scope="module")
def library():
    tokenizer = tokenizers.Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    return ids, hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()


def compare(library, df):
    for r in df.collect():
        ids, ids_hash, text_hash = expected(library, r.text)
        assert (r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) == (ids, len(ids), ids_hash, text_hash), r.text


@pytest.mark.parametrize("lexicon", [0, 50, 10_000])
def test_ids_equal_the_library(spark, library, lexicon):
    rng = random.Random(lexicon)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(40))) for _ in range(600)]
    texts += ["a" * 3000, "ab" * 500 + "!" * 300, " " * 400, "x" + "\n" * 200 + " y", "<|endoftext|>", None]
    docs = documents(spark, texts)
    compare(library, m.encode(docs, m.prepare(docs, PATH, lexicon)))


def test_round_trip(spark):
    docs = odd_documents(spark)
    encoder = m.prepare(docs, PATH, 100)
    encoded = m.encode(docs, encoder)
    back = {(r.doc_id, r.text) for r in m.decode(encoded, encoder).collect()}
    assert back == {(r.doc_id, r.text or "") for r in docs.collect()}
    assert encoded.count() == docs.count()


def test_odd_and_empty_tables(spark, library):
    docs = odd_documents(spark)
    compare(library, m.encode(docs, m.prepare(no_documents(spark), PATH)))
    assert m.encode(no_documents(spark), m.prepare(docs, PATH, 10)).count() == 0


def test_the_given_table(spark, library):
    found = m.op8_bpe(spark, FOLDER)
    assert found.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    rows = found.collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids, *hashes = expected(library, texts[r.doc_id])
        assert [r.n_tokens, r.ids_sha256, r.decoded_sha256] == [len(ids), *hashes]


def minimal_states(words: list[bytes]) -> int:
    """States of the smallest automaton: different sets of endings after a prefix."""
    prefixes = {w[:i] for w in words for i in range(len(w) + 1)}
    return len({frozenset(w[len(p) :] for w in words if w.startswith(p)) for p in prefixes})


def test_the_transducer_is_minimal_and_exact():
    rng = random.Random(9)
    words = sorted({bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 6))) for _ in range(150)})
    ids = [np.array([i] * (i % 3), dtype=np.uint32) for i in range(len(words))]
    arrays = compile_words(words, ids)
    assert len(arrays["accepts"]) == minimal_states(words)
    probes = words + [b"zz", b"a" * 9, b"abcabcab"]
    data, lengths = np.frombuffer(b"".join(probes), np.uint8), np.array([len(w) for w in probes])
    rank, known = find(arrays, data, np.cumsum(lengths) - lengths, lengths)
    assert known.tolist() == [p in set(words) for p in probes] and rank[known].tolist() == [words.index(p) for p in probes if p in set(words)]
    for i in range(len(words)):
        assert arrays["ids"][arrays["id_ends"][i] : arrays["id_ends"][i + 1]].tolist() == ids[i].tolist()


def test_compiling_holds_a_few_bytes_a_node():
    words = sorted({b"%d" % (i * 7919) for i in range(20_000)} | {b"x" * 1000})
    ids = [np.array([i], dtype=np.uint32) for i in range(len(words))]
    tracemalloc.start()
    arrays = compile_words(words, ids)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(arrays["ids"]) == len(words) and most < 20e6


def test_words_out_of_order_are_refused():
    for words in ([b"b", b"a"], [b"a", b"a"], [b"ab", b"a"], [b"", b"a"]):
        with pytest.raises(ValueError):
            compile_words(words, [np.zeros(1, np.uint32)] * len(words))
    assert len(compile_words([], [])["ids"]) == 0


def test_pieces_of_every_character(library):
    vocabulary = m.Vocabulary.read(PATH)
    encoder = m.Encoder(vocabulary.arrays, vocabulary.special, vocabulary.special_id)
    characters = [chr(i) for i in range(0x110000) if not 0xD800 <= i < 0xE000]
    for a in range(0, len(characters), 40_000):
        text = "".join(f"a{c}a {c}1{c}.{c} " for c in characters[a : a + 40_000])
        data = np.frombuffer(text.encode(), np.uint8)
        ids, _ = encoder.encode(data, np.array([0, len(data)]))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
