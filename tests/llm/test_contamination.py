from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from cartlayers.llm import contamination as m
from cartlayers.llm.fm_index import FMIndex, suffix_array
from cartlayers.llm.words import ALPHANUMERIC as IN_WORD
from cartlayers.llm.words import Words, text_bytes
from tests.llm.fixtures import ALPHANUMERIC, FOLDER, documents, given, no_documents, odd_documents, prose, words


def windows(items) -> dict:
    found: dict = {}
    for i, t in items:
        w = words(t, ALPHANUMERIC)
        for k in range(max(1, len(w) - 12) if w else 0):
            found.setdefault(tuple(w[k : k + 13]), set()).add("null" if i is None else str(i))
    return found


def brute_force(text, found) -> tuple:
    w = words(text, ALPHANUMERIC)
    hit, items = [False] * len(w), set()
    for n in {len(x) for x in found}:
        for k in range(len(w) - n + 1):
            own = found.get(tuple(w[k : k + n]))
            if own:
                items |= own
                hit[k : k + n] = [True] * n
    return len(w), sum(hit), sorted(items), sum(hit) > 0 and 20 * sum(hit) >= len(w)


def result(r) -> tuple:
    return r.n_words, sum(s.end - s.begin for s in r.word_spans), r["items"], r.contaminated


@pytest.mark.parametrize("block", [200_000, 7])
def test_hits_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(m, "WINDOWS_PER_BLOCK", block)
    items = [(1, prose(1, 40)), (2, "short one"), (None, prose(3, 13)), (4, None), (5, "..."), (6, prose(1, 20)), (7, prose(7, 14)), (7, prose(8, 14))]
    rng = random.Random(4)
    texts = [prose(50 + i, 200) for i in range(10)]
    texts += [f"{prose(90, 30)} {prose(1, 40).upper()}; {prose(91, 600)}", f"x {prose(1, 25)}", "a SHORT, one! and short one", prose(8, 14), prose(8, 13)]
    texts += [" ".join(rng.choice(["short", "one", "x"]) for _ in range(60)), texts[10], None, ""]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = windows(items)
    rows = m.contamination(documents(spark, texts), benchmark).collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert result(r) == brute_force(r.text, found), r.doc_id
        assert all(a.end < b.begin for a, b in zip(r.word_spans, r.word_spans[1:], strict=False))


def test_the_given_table(spark):
    items = [(r.item_id, r.text) for r in given(spark, "benchmark").collect()]
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    found, rows = windows(items), m.op10_decontamination(spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n, hit, own, bad = brute_force(texts[r.doc_id], found)
        digest = hashlib.sha256(",".join(own).encode()).hexdigest()
        assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == (n, hit, len(own), digest, bad)


def test_odd_documents(spark):
    docs, benchmark = odd_documents(spark), given(spark, "benchmark")
    rows = m.contamination(docs, benchmark)
    assert rows.count() == docs.count() and rows.where("contaminated").count() == 0
    assert m.contamination(docs, benchmark.limit(0)).where("n_words > 0").count() > 0
    assert m.contamination(no_documents(spark), benchmark).count() == 0


def test_long_texts_are_cut_with_an_overlap(monkeypatch):
    monkeypatch.setattr(m, "SHARD_WORDS", 50)
    item = prose(1, 30)
    data, offsets = text_bytes(pa.array([item]))
    hashes = Words(data, offsets, IN_WORD).hashes()
    cut = [hashes[k : k + 13] for k in range(18)]
    found = m.Windows(np.array(cut), np.full(18, 13), [["1"]] * 18)
    texts = [prose(9, n) + " " + item + " " + prose(8, 70) for n in range(30, 60)] + ["few", ""]
    parts = [added for _, _, added in m._searched(pa.array(texts), None, found)]
    counts, spans, items = (pa.chunked_array([part[i] for part in parts]) for i in range(3))
    for i, n in enumerate(range(30, 60)):
        assert spans[i].as_py() == [{"begin": n, "end": n + 30}] and items[i].as_py() == ["1"]
    assert spans[30].as_py() == [] and counts[31].as_py() == 0


@pytest.mark.parametrize("n, kinds", [(1, 1), (2, 2), (40, 2), (400, 5), (3000, 60)])
def test_index_equals_plain_search(n, kinds):
    rng = np.random.default_rng(n)
    symbols = np.append(rng.integers(1, kinds + 1, n), 0)
    if n > 200:
        symbols[150:250] = symbols[20:120]
    assert suffix_array(symbols).tolist() == sorted(range(n + 1), key=lambda i: symbols[i:].tolist())
    index = FMIndex(symbols)
    for size in range(1, min(5, n + 1)):
        starts = rng.integers(0, n - size + 1, 20)
        patterns = np.concatenate([np.stack([symbols[s : s + size] for s in starts]), rng.integers(-1, kinds + 2, (10, size))])
        patterns[patterns == 0] = -1
        low, high = index.search(patterns, np.full(len(patterns), size))
        for p, a, b in zip(patterns.tolist(), low, high, strict=True):
            want = [i for i in range(n - size + 1) if symbols[i : i + size].tolist() == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want
