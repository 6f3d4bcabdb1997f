from __future__ import annotations

import numpy as np

from cartlayers.llm import language_id as m
from tests.llm.fixtures import FOLDER, documents, no_documents, odd_documents


def plain_vector(text: str) -> np.ndarray:
    slots, vectors = m._letter_slots(), m._letter_vectors()
    symbols = [0]
    for c in text:
        s = int(slots[ord(c)])
        if s or symbols[-1]:
            symbols.append(s)
    if symbols[-1]:
        symbols.append(0)
    total = np.zeros(m.DIMENSIONS)
    for a, b, c in zip(symbols, symbols[1:], symbols[2:], strict=False):
        total += vectors[0][a].astype(float) * vectors[1][b] * vectors[2][c]
    return total


def cosine(a, b):
    return float(a @ b / np.linalg.norm(a) / np.linalg.norm(b))


def test_scores_are_cosines_with_bundled_prototypes(spark):
    texts = ["Das ist ein Haus und das Meer", "the house is by the sea", "une maison près de la mer", "the the"]
    docs = documents(spark, texts, ["de", "en", "fr", "en"])
    profiles = m.learn(docs)
    assert profiles.languages == ["de", "en", "fr"]
    prototypes = {"de": plain_vector(texts[0]), "en": plain_vector(texts[1]) + plain_vector(texts[3]), "fr": plain_vector(texts[2])}
    for row in m.identify(docs, profiles).collect():
        likeness = {name: cosine(plain_vector(row.text), p) for name, p in prototypes.items()}
        best = max(likeness, key=likeness.get)
        assert row.lang_pred == best and abs(row.score - likeness[best]) < 1e-9


def test_odd_texts(spark):
    docs = odd_documents(spark)
    rows = m.identify(docs, m.learn(docs)).collect()
    assert len(rows) == docs.count()
    undetermined = {r.text for r in rows if r.lang_pred == "und"}
    assert undetermined == {None, "", " \t\n ", "!!! ???", "12"}
    # A negative cosine counts as 0, so a determined text may have that score, too.
    assert all(0 <= r.score <= 1 and (r.lang_pred != "und" or r.score == 0) for r in rows)


def test_nothing_to_learn_from(spark):
    profiles = m.learn(no_documents(spark))
    assert profiles.languages == []
    assert {(r.lang_pred, r.score) for r in m.identify(odd_documents(spark), profiles).collect()} == {("und", 0.0)}
    assert m.identify(no_documents(spark), profiles).count() == 0


def test_ties_go_to_the_first_language(spark):
    docs = documents(spark, ["same words here", "same words here"], ["b", "a"])
    assert {r.lang_pred for r in m.identify(docs, m.learn(docs)).collect()} == {"a"}


def test_held_out_accuracy_on_the_given_table(spark):
    import zlib

    found = m.op1_language_id(spark, FOLDER)
    assert found.columns == ["doc_id", "held_out", "lang_pred", "score"]
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()}
    rows = found.collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(truth[r.doc_id] == r.lang_pred for r in held) / len(held) >= 0.95
