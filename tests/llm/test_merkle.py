from __future__ import annotations

import hashlib
import zlib
from itertools import groupby

from cartlayers.llm import merkle as m
from tests.compare import connect, mismatch
from tests.llm.fixtures import FOLDER, no_documents, odd_documents

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, path string, tree long, leaf int"


def h(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def above(nodes: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root, and for every node the digests beside it, level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 3] for i in range(0, len(nodes), 3)]
        for path, i in zip(paths, at, strict=True):
            path.append(("".join(runs[i // 3][: i % 3]), "".join(runs[i // 3][i % 3 + 1 :])))
        nodes, at = [h(*r) for r in runs], [i // 3 for i in at]
    return nodes[0], paths


def expected(rows) -> list[tuple]:
    def source(r):
        return (r["source"] is not None, (r["source"] or "").encode())

    ordered = sorted(rows, key=lambda r: (*source(r), r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    groups = [list(g) for _, g in groupby(ordered, source)]
    built = [above([leaf(r, r["text"]) for r in g]) for g in groups]
    root, tops = above([subroot for subroot, _ in built])
    found = []
    for group, (subroot, lows), top in zip(groups, built, tops, strict=True):
        for row, low in zip(group, lows, strict=True):
            text, path = row["text"], low + top
            if row["doc_id"] is not None and text and zlib.crc32(str(row["doc_id"]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            node = leaf(row, text)
            for left, right in path:
                node = h(left, node, right)
            proof = h(*[a + b for a, b in path])
            found.append((row["doc_id"], leaf(row, row["text"]), subroot, root, proof, node, node == root))
    return sorted(found, key=repr)


def audited(docs):
    even = "CASE WHEN crc32(cast(doc_id as string)) % 2 = 0 THEN replace(text, '\\n', '') ELSE text END"
    return m.audited(docs, m.LEAF_COLUMNS, "doc_id", "source", {"text": m.F.expr(even)})


def check(docs):
    assert sorted(map(tuple, audited(docs).collect()), key=repr) == expected([r.asDict() for r in docs.collect()])


def test_a_large_group_among_small_ones(spark):
    """One source of more rows than two rounds of levels hold together, others of 1 to 7; a null and an empty source."""
    big = [(i, f"a\nb {i}", "x", "big", i, None, None, None) for i in range(800)]
    small = [(1000 + 10 * s + i, f"{i}\n", None, f"sé{s}", s, "p", 1, 2) for s in range(1, 8) for i in range(s)]
    rest = [(5000, None, None, None, None, None, None, None), (5001, "", "", "", 0, None, None, None)]
    check(spark.createDataFrame(big + small + rest, SCHEMA).repartition(5))


def test_odd_documents(spark):
    check(odd_documents(spark))
    assert audited(no_documents(spark)).collect() == []


def test_repeated_rows_are_leaves_each(spark):
    docs = spark.createDataFrame([(1, "t\n", "x", "s", 2, None, None, None)] * 5, SCHEMA)
    check(docs)
    check(docs.limit(1))


def test_more_than_one_round_over_the_sources(spark):
    docs = spark.range(260).selectExpr(
        "id AS doc_id", "concat('x\\n', id) AS text", "'l' AS lang", "concat('s', id) AS source", "id AS n_chars"
    )
    check(docs)


def test_query_agrees_with_sql(spark):
    assert mismatch(m.op12_merkle(spark, FOLDER), connect(FOLDER), m.MERKLE_SQL) is None


def test_levels_of_a_round_share_one_shuffle(spark):
    nodes = spark.range(1000).selectExpr("cast(id % 2 as string) AS tree", "id AS pos", "500L AS n", "sha2(cast(id as string), 256) AS digest")
    plan = m.climb(nodes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1 and plan.count("Window [") == m.LEVELS
