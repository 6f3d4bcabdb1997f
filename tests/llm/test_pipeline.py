from __future__ import annotations

import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
import tokenizers
from pyspark.sql import functions as F

import corpus_pipeline as p
from cartlayers.llm.components import connected_components
from tests.llm.fixtures import documents, given, no_documents, odd_documents, prose
from tests.llm.test_contamination import brute_force as hits
from tests.llm.test_contamination import windows
from tests.llm.test_jaccard_join import brute_force as components

ITEM = prose(1000, 60)
TEXTS = [prose(i, 80) for i in range(12)]
TEXTS += [TEXTS[3], TEXTS[4] + " more", None, "", "?! 12", f"{prose(50, 30)} {ITEM}", f"{prose(51, 3000)} {ITEM}", "mail me at a@b.cc or 10.0.0.1 now"]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("corpus"))
    documents(spark, TEXTS).write.parquet(f"{place}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{place}/benchmark.parquet")
    return place


def brute_force() -> dict:
    kept = {i: t for i, t in enumerate(TEXTS) if t and re.search(r"[^\W\d_]", t)}
    group = components(kept)
    kept = {i: t for i, t in kept.items() if group[i][1] == i}
    found = windows([(1, ITEM)])
    kept = {i: t for i, t in kept.items() if not hits(t, found)[3]}
    return {i: t.replace("a@b.cc", "[EMAIL]").replace("10.0.0.1", "[IP]") for i, t in kept.items()}


def test_run_equals_brute_force(spark, folder):
    library = tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.no_padding()
    library.no_truncation()
    want = {}
    for i, t in brute_force().items():
        ids = library.encode(t, add_special_tokens=False).ids
        want[i] = (ids, len(t), hashlib.sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest())
    rows = p.run(spark, folder).collect()
    assert {r.doc_id: (r.ids, r.n_chars, r.ids_sha256) for r in rows} == want


def test_stages_keep_the_columns_and_take_odd_tables(spark, folder):
    assert [name for name, _ in p.STAGES] == ["language", "near_duplicates", "decontamination", "personal_data", "tokens"]
    for docs in (odd_documents(spark).select("doc_id", "text", "lang", "source", "n_chars"), no_documents(spark).select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in p.STAGES[:-1]:
            assert stage(spark, docs, folder).columns == docs.columns
            assert stage(spark, docs, folder).count() <= docs.count()
        assert p.STAGES[-1][1](spark, docs, folder).count() == docs.count()


def test_columns_of_any_name_stay_as_they_are(spark, folder):
    names = ["lang_pred", "spans", "contaminated", "_k1", "_size", "_row", "_mentions", "document", "mentions"]
    docs = documents(spark, TEXTS[-2:] + TEXTS[:2]).withColumns({name: F.concat(F.lit(name), "doc_id") for name in names})
    for _, stage in p.STAGES[:-1]:
        kept = stage(spark, docs, folder)
        rows = kept.collect()
        assert kept.columns == docs.columns and rows
        assert all(r[name] == f"{name}{r.doc_id}" for r in rows for name in names)


def test_clean_documents_stay(spark, folder):
    docs = given(spark, "documents")
    assert p.keep_languages(spark, docs, folder).count() == docs.where(F.col("text").rlike(r"\p{L}")).count()


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 7), (200, 201), (201, 200), (300, 300)] + [(500, i) for i in range(501, 530)]
    got = {r.node: r.label for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {i: 0 for i in [*range(41), 100]} | {200: 200, 201: 200} | {i: 500 for i in range(500, 530)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_texts_unlike_every_language_stay(spark, folder):
    odd = ["".join(chr(0x4E00 + (i * 7919 + j * 104729) % 20000) for j in range(12)) for i in range(60)]
    docs = documents(spark, [*TEXTS, *odd])
    kept = {r.text for r in p.keep_languages(spark, docs, folder).collect()}
    assert kept >= set(odd) and "?! 12" not in kept
