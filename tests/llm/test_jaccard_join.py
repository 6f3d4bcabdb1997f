from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from cartlayers.llm import jaccard_join as m
from cartlayers.llm.words import text_bytes
from tests.llm.fixtures import FOLDER, documents, given, no_documents, odd_documents, prose, words


def shingles(text) -> frozenset:
    w = words(text)
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_force(texts: dict) -> dict:
    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders: dict = {}
    for i, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(i)
    for i, s in sets.items():
        for j in {k for x in s for k in holders[x] if k < i}:
            shared = len(s & sets[j])
            if 100 * shared >= 80 * (len(s) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in texts}


def check(df, texts: dict):
    rows = df.collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == brute_force(texts)


def near_copies(seed: int, sizes, copies: int, edits: int) -> list[str]:
    rng, texts = random.Random(seed), []
    for k, n in enumerate(sizes):
        base = prose(seed * 100 + k, n).split()
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(copy))
                if rng.random() < 0.5:
                    copy[at] = f"x{rng.random()}"
                else:
                    copy.insert(at, "more")
            texts.append(" ".join(copy))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("block", [400, 5])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(m, "BLOCK", block)
    texts = near_copies(3, (4, 6, 9, 15, 30, 70, 150, 400), 12, 6)
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))


def test_components_on_the_given_table(spark):
    texts = {r.doc_id: r.text for r in given(spark, "documents").collect()}
    found = m.op5_jaccard_join(spark, FOLDER)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    check(found, texts)


def test_similar_sets_always_share_a_signature():
    likeness, rng = m.Likeness(), random.Random(5)
    for n in [*range(1, 60), 90, 130, 200, 333, 700]:
        base = [f"w{rng.random()}" for _ in range(n + 4)]
        for _ in range(4):
            other = list(base)
            for _ in range(rng.randint(0, max(1, n // 9))):
                other.insert(rng.randrange(len(other) + 1), f"v{rng.random()}") if rng.random() < 0.3 else other.pop() if len(other) > 5 else None
            pair = [" ".join(base), " ".join(other)]
            a, b = map(shingles, pair)
            if not likeness.linked(len(a & b), len(a), len(b)):
                continue
            import pyarrow as pa

            data, offsets = text_bytes(pa.array(pair))
            found, owner = m.ShingleSets(data, offsets, likeness).signatures(likeness)
            assert set(found[owner == 0]) & set(found[owner == 1]), (n, len(a), len(b))


def test_odd_documents(spark):
    docs = odd_documents(spark)
    rows = m.near_duplicates(docs).collect()
    assert len(rows) == docs.count()
    found = {r.doc_id: r for r in rows}
    assert (found[0].n_shingles, found[0].component_id) == (0, 0) and found[2].component_id == 2
    assert found[8].component_id == 7 and found[10].component_id == 9 and found[3].n_shingles == 1
    assert found[None].component_id is None and found[None].n_shingles == 1
    assert m.near_duplicates(no_documents(spark)).count() == 0


def test_one_of_each_keeps_rows_whole(spark):
    docs = odd_documents(spark)
    kept = m.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=lambda x: (x is None, x))
    assert ids == [0, 1, 2, 3, 4, 5, 6, 7, 9, 11, 12, None]


def test_a_chain_is_one_component(spark):
    w = [f"w{i}" for i in range(104)]
    texts = [" ".join(w[:100]), " ".join([*w[8:100], *(f"a{i}" for i in range(8))]), " ".join([*w[16:100], *(f"a{i}" for i in range(16))])]
    assert not np.diff([r.component_id for r in m.near_duplicates(documents(spark, texts)).collect()]).any()
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))


def test_classes_of_different_batches_share_the_leader_of_a_signature(spark):
    rng, base = random.Random(8), prose(77, 120).split()
    texts = []
    for _ in range(300):
        copy = list(base)
        for _ in range(rng.randint(1, 3)):
            copy[rng.randrange(len(copy))] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    likeness = m.Likeness()
    import pyarrow as pa

    data, offsets = text_bytes(pa.array(texts))
    sets = m.ShingleSets(data, offsets, likeness)
    found, owner = sets.signatures(likeness)
    keys = sets.keys()[0]
    leader: dict = {}
    for s, o in zip(found, owner, strict=True):
        leader[s] = min(leader.get(s, keys[o]), keys[o])
    want = {(int(leader[s]), int(keys[o])) for s, o in zip(found, owner, strict=True) if leader[s] != keys[o]}
    held = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 20)
    try:
        docs = documents(spark, texts).repartition(4)
        assert {(r.leader, r.member) for r in m.star_pairs(docs, likeness, 3).collect()} >= want
        check(m.near_duplicates(docs), dict(enumerate(texts)))
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", held)


def test_copies_of_a_hot_template_are_joined_by_their_pivot(spark, monkeypatch):
    """Copies are linked with the template only, not with each other; what is left to visit blocks must stay small."""
    rng, base = random.Random(9), prose(78, 300).split()
    texts = [" ".join(base)]
    for _ in range(500):
        copy = list(base)
        for at in rng.sample(range(5, 295), rng.randint(4, 6)):
            copy[at] = f"x{rng.random()}"
        texts.append(" ".join(copy))
    monkeypatch.setattr(m, "BLOCK", 40)
    across, left = m._across, []

    def counted(members):
        found = m.stored(across(members))
        left.append(found.where("visits").count())
        return found

    monkeypatch.setattr(m, "_across", counted)
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))
    assert left[0] < 500


def test_a_long_chain_in_blocks(spark, monkeypatch):
    w = [f"w{i}" for i in range(500)]
    texts = [" ".join(w[8 * i : 8 * i + 100]) for i in range(50)]
    monkeypatch.setattr(m, "BLOCK", 4)
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))


def test_texts_are_shuffled_compressed(spark, monkeypatch):
    odd = [None, "", "\u00e9 \u4e2d \U0001f389 \x00 \n", prose(3, 400)]
    assert m._unpressed(m._pressed(pa.array(odd))).cast(pa.string()).to_pylist() == odd
    mapped, sent = m.map_tables, []

    def kept(*args):
        found = mapped(*args)
        if found.columns == ["doc_id", "text"]:
            sent.append(found)
        return found

    monkeypatch.setattr(m, "map_tables", kept)
    texts = near_copies(4, [300, 200], 6, 4)
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))
    assert sent and all(len(r.text) < 0.7 * len(texts[r.doc_id]) for found in sent for r in found.collect())
    assert any(found.count() for found in sent)


def test_parities_rule_out_sets_that_are_not_linked():
    """Also of long texts, and of texts whose sets have different numbers of cells."""
    rng, likeness, texts = random.Random(11), m.Likeness(), []
    for n in (30, 120, 500, 1100, 4000):
        base = [f"w{rng.random()}" for _ in range(n)]
        for change in (0, 0.01, 0.045, 0.06, 0.08):  # of the words; a word is in five shingles
            copy = list(base)
            for at in rng.sample(range(n), int(change * n)):
                copy[at] = f"x{rng.random()}"
            texts += [" ".join(copy), " ".join(copy[: n - n // 10])]
    data, offsets = text_bytes(pa.array(texts))
    sets = m.ShingleSets(data, offsets, likeness)
    cells, own = sets.cells(), [shingles(t) for t in texts]
    assert [len(s) for s in own] == sets.sizes.tolist()
    for i in range(len(texts)):
        for j in range(i - i % 10, i):
            one, other = m._parities(cells.take(pa.array([i, j])))
            gap = int(np.bitwise_count(one ^ other).sum())
            total, shared = len(own[i]) + len(own[j]), len(own[i] & own[j])
            assert gap <= total - 2 * shared
            if shared < 0.7 * (total - shared) and min(len(own[i]), len(own[j])) > 100:
                assert gap > likeness.most_different(total), (i, j)


def test_a_class_meets_one_pivot(spark, monkeypatch):
    thin, compared = m.candidates, []

    def counted(meetings, likeness):
        kept = m.stored(meetings)
        compared.append(kept.where("not visits").count())
        return thin(kept, likeness)

    monkeypatch.setattr(m, "candidates", counted)
    texts = near_copies(12, [120] * 6 + [300] * 6, 10, 4)
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))
    assert compared[0] <= len(set(texts))


def test_many_signatures_of_a_class_are_packed(spark):
    texts = [prose(90, 3000), prose(90, 3000) + " more", prose(91, 50)]
    check(m.near_duplicates(documents(spark, texts)), dict(enumerate(texts)))
