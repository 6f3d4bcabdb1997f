from __future__ import annotations

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from cartlayers.llm import lm_scoring as m
from cartlayers.llm.ppm import EDGE, ORDER, ByteTrie, Model, grams
from tests.llm.fixtures import FOLDER, documents, given, no_documents, odd_documents, words


def train_trie(texts) -> ByteTrie:
    trie = ByteTrie()
    for t in texts:
        padded = bytes([EDGE] * ORDER) + b" ".join(words(t)) + bytes([EDGE])
        for i in range(ORDER, len(padded)):
            trie.learn(padded[i - ORDER : i], padded[i])
    return trie


def unigrams(texts):
    counts = Counter(w for t in texts for w in [*words(t), None])
    n, v = sum(counts.values()), len(counts)
    return counts, n, lambda t: sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in [*words(t), None])


def check(rows, train, texts):
    counts, n, base = unigrams(train)
    trie = train_trie(train)
    for r in rows:
        text = texts[r.doc_id]
        own = [*words(text), None]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
        assert r.base_score == pytest.approx(base(text), abs=1e-8)
        assert r.score == pytest.approx(trie.score(b" ".join(words(text)), adapt=False), abs=1e-8)


@pytest.mark.parametrize("head", [2, 500_000])
def test_scores_equal_plain_models(spark, monkeypatch, head):
    monkeypatch.setattr(m, "HEAD_WORDS", head)
    train = ["the cat sat on the mat", "the dog sat", "a  CAT\tand a dog", None, "", "the the the"]
    texts = [*train, "unseen words here", "the zebra \U0001f389 sat", "x" * 300]
    scored = m.score(documents(spark, texts), m.learn(documents(spark, train)))
    check(scored.collect(), train, texts)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    scored = m.score(docs, m.learn(docs))
    rows = scored.collect()
    assert len(rows) == docs.count()
    assert [r.n_tokens for r in rows if r.doc_id in (0, 1, 2, 3)] and {r.n_tokens for r in rows if r.doc_id in (0, 1, 2)} == {1}
    assert m.score(no_documents(spark), m.learn(docs)).count() == 0


def test_nothing_learned(spark):
    rows = m.score(documents(spark, ["ab", None]), m.learn(no_documents(spark))).orderBy("doc_id").collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows] == [(2, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert [r.score for r in rows] == pytest.approx([-3 * math.log10(256), -math.log10(256)])


def test_the_given_table(spark):
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in texts}
    rows = m.op9_lm_scoring(spark, FOLDER).collect()
    assert len(rows) == len(texts) and all(r.held_out == held[r.doc_id] for r in rows)
    counts, n, base = unigrams([t for i, t in texts.items() if not held[i]])
    for r in rows:
        assert (r.train_tokens, r.n_tokens) == (n, len(words(texts[r.doc_id])) + 1)
        assert r.base_score == pytest.approx(base(texts[r.doc_id]), abs=1e-6)
        assert r.score < 0


def test_a_distribution_sums_to_one():
    trie = train_trie(["abracadabra", "abc abd"])
    for context in (b"bracad"[-ORDER:], b"\n" * ORDER, b"zzzzzz"[-ORDER:], b"zzzzab"[-ORDER:]):
        assert sum(10 ** trie.log10(context, s) for s in range(256)) == pytest.approx(1)


def test_model_equals_trie_on_all_bytes():
    texts = ["abracadabra", "abc abd", "ab"]
    trie = train_trie(texts)
    codes = [grams(np.frombuffer(bytes([EDGE] * ORDER) + t.encode() + bytes([EDGE]), np.uint8)) for t in texts]
    model = Model(Model.build(*np.unique(np.concatenate(codes), return_counts=True)))
    probe = bytes([EDGE] * ORDER) + bytes(range(256)) + b"abracabab abx" + bytes([EDGE])
    want = [trie.log10(probe[i - ORDER : i], probe[i]) for i in range(ORDER, len(probe))]
    assert np.allclose(model.log10(grams(np.frombuffer(probe, np.uint8))), want, atol=1e-9)


def test_adaptive_scores(spark):
    rows = m.adaptive_scores(documents(spark, ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "qwertyuiopasdfghjklzxcvbnm123456", None])).collect()
    repeated, varied, empty = (r.score for r in sorted(rows, key=lambda r: r.doc_id))
    assert varied < repeated < empty < 0


@pytest.mark.parametrize("leaves", [1, 25])
def test_more_grams_than_tasks_hold_are_scored_exactly(spark, monkeypatch, leaves):
    monkeypatch.setattr(m, "TRIE_LEAVES", leaves)
    train = ["the cat sat on the mat", "the dog sat", "a  CAT\tand a dog", None, "", "the the the", "зверь"]
    texts = [*train, "unseen words here", "the zebra \U0001f389 sat", "x" * 300, "звезда"]
    scorer = m.learn(documents(spark, train))
    check(m.score(documents(spark, texts), scorer).collect(), train, texts)
