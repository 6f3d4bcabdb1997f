from __future__ import annotations

import pytest

from cartlayers.llm import license_scan as m
from tests.llm.fixtures import documents, no_documents, odd_documents, prose

TEXTS = [
    "Some prose here.\nReleased under the MIT License.\nMore prose.",
    "licensed under the apache license version 2.0",
    "This work is licensed under the GNU General Public License, version 3.\nAll rights reserved.",
    "Licensed under CC BY-NC 4.0.",
    "Distributed under the terms of the Zeta vendor license agreement.",
    "She had no rights to the domain of kings.",
    prose(4, 200),
    "The MIT campus and the apache helicopter",
]


@pytest.fixture(scope="module")
def found(spark):
    docs = documents(spark, [*TEXTS, *(prose(i, 30) for i in range(30))])
    return {r.doc_id: r.notices for r in m.scan(docs, m.train(docs)).collect()}


def test_families_are_found_and_confirmed(found):
    families = {i: [(n.paragraph, n.family, n.confirmed) for n in found[i]] for i in range(4)}
    assert families == {
        0: [(1, "mit", True)],
        1: [(0, "apache-2.0", True)],
        2: [(0, "gpl-3.0", True), (1, "all-rights-reserved", True)],
        3: [(0, "cc-by-nc-4.0", True)],
    }
    assert all(0.5 <= n.probability <= 1 and 0.5 <= n.similarity <= 1 for i in range(4) for n in found[i])


def test_other_notices_are_unknown_and_prose_is_none(found):
    assert [(n.family, n.confirmed) for n in found[4]] == [("unknown", False)]
    assert not any(n.confirmed for i in (5, 6, 7) for n in found[i]) and not found[6]


def test_odd_and_empty_tables(spark):
    docs = odd_documents(spark)
    classifier = m.train(no_documents(spark))
    rows = m.scan(docs, classifier)
    assert rows.columns == [*docs.columns, "notices"] and rows.count() == docs.count()
    assert rows.where("size(notices) > 0").count() == 0
    again = m.scan(rows, classifier)
    assert again.columns == rows.columns
    assert m.scan(no_documents(spark), classifier).count() == 0


def test_no_python_in_the_plan(spark):
    docs = documents(spark, TEXTS)
    plan = m.scan(docs, m.train(docs))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


SHORT = {
    "Released under Apache 2.0.": "apache-2.0",
    "Distributed under CC BY-SA 4.0.": "cc-by-sa-4.0",
    "Released under the BSD 3-Clause.": "bsd-3-clause",
    "Creative Commons Attribution-NonCommercial 4.0": "cc-by-nc-4.0",
    "GNU GPLv3 or later": "gpl-3.0",
    "Apache-2.0": "apache-2.0",
    "SPDX: MIT": "mit",
}


def test_short_notices_are_not_lost(spark):
    docs = documents(spark, [*SHORT, *(prose(i, 30) for i in range(30))])
    found = {r.text: [n.family for n in r.notices] for r in m.scan(docs, m.train(docs)).collect()}
    assert {t: found[t] for t in SHORT} == {t: [f] for t, f in SHORT.items()}


def test_the_gate_changes_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    classifier = m.train(docs)
    words = sorted({g for g in classifier.weights if " " not in g})
    assert len(classifier.telling) < len(words)
    lines = [*SHORT, *TEXTS, " ".join(w for w in words if w not in classifier.telling)]
    every = docs.unionByName(documents(spark, lines).select("doc_id", "text"))
    whole = m.Classifier(classifier.labels, classifier.weights, classifier.intercepts, classifier.temperature, words)
    of = lambda c: sorted((r.doc_id, r.text or "", r.notices) for r in m.scan(every, c).collect())
    assert of(classifier) == of(whole)
