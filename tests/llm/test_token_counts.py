from __future__ import annotations

import pytest

from cartlayers.llm import token_counts as m
from cartlayers.llm.common import shared_folder
from tests.compare import connect, mismatch
from tests.llm.fixtures import FOLDER, documents, no_documents, odd_documents


def totals(rollup) -> dict:
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in rollup.totals().collect()}


@pytest.fixture
def rollup(spark):
    return m.Rollup(spark, shared_folder(spark))


def test_inserts_deletes_and_revisions(spark, rollup):
    counters = {"words-v1": m.tokenizers()["words-v1"]}
    a, b = documents(spark, ["one two", "three"]), documents(spark, ["four five six"])
    assert rollup.commit("1", m.changes(inserted=m.counted(a, counters)))
    assert totals(rollup) == {("s", "xx", "words-v1"): (2, 3)}
    assert rollup.commit("2", m.changes(revised=(m.counted(a.where("doc_id = 1"), counters), m.counted(b, counters))))
    assert totals(rollup) == {("s", "xx", "words-v1"): (2, 5)}
    assert rollup.commit("3", m.changes(deleted=m.counted(a.where("doc_id = 0"), counters)))
    assert totals(rollup) == {("s", "xx", "words-v1"): (1, 3)}
    rollup.commit("4", m.changes(deleted=m.counted(b, counters)))
    assert totals(rollup) == {} and rollup.batches() == ["1", "2", "3", "4"]


def test_a_batch_counts_once(spark, rollup):
    rows = m.counted(documents(spark, ["one two"]), m.tokenizers())
    assert rollup.commit("a", m.changes(inserted=rows))
    before = totals(rollup)
    assert not rollup.commit("a", m.changes(inserted=rows)) and totals(rollup) == before


def test_a_batch_that_broke_off_is_not_seen_and_can_be_written_again(spark, rollup):
    rows = m.changes(inserted=m.counted(documents(spark, ["one two"]), m.tokenizers()))
    rows.write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{rollup.path}/batch=x")
    assert totals(rollup) == {} and rollup.batches() == []
    assert rollup.commit("x", rows)
    assert totals(rollup)["s", "xx", "words-v1"] == (1, 2)


def test_odd_documents(spark, rollup):
    docs = odd_documents(spark)
    rollup.commit("1", m.changes(inserted=m.counted(docs, m.tokenizers())))
    found = totals(rollup)
    assert sum(d for (_, _, t), (d, _) in found.items() if t == "words-v1") == docs.count()
    assert (None, None, "bytes-v1") in found
    rollup.commit("2", m.changes(inserted=m.counted(no_documents(spark), m.tokenizers())))
    assert totals(rollup) == found
    with pytest.raises(ValueError):
        rollup.commit("no/name", m.changes(inserted=m.counted(docs, m.tokenizers())))
    with pytest.raises(ValueError):
        m.changes()


def test_the_given_table(spark):
    assert mismatch(m.op6_token_counts(spark, FOLDER), connect(FOLDER), m.TOKEN_COUNTS_SQL) is None
