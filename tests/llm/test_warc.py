from __future__ import annotations

import random

from pyspark.sql import functions as F

from cartlayers.llm import warc as m
from tests.compare import connect, mismatch
from tests.llm.fixtures import FOLDER

SCHEMA = "record_id long, url string, captured long, kind string, headers map<string,string>, body string, part int, canonical string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)


def test_canonical_urls(spark):
    urls = ["HTTP://www.A.com:80/x/?b=2&utm_source=q&a=1#top", "https://a.com/x?a=1&b=2", "a.com", "https://A.com/", None, "", "http://a.com/X?ref=1"]
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select(m.canonical_url(F.col("u"))).collect()
    assert [r[0] for r in rows] == ["a.com/x?a=1&b=2", "a.com/x?a=1&b=2", "a.com", "a.com", None, "", "a.com/X"]


def brute_force(rows) -> dict:
    found = {}
    for rid, url, at, kind, headers, _ in rows:
        if kind != "revisit":
            continue
        earlier = [r for r in rows if r[3] == "response" and r[1] == url and (r[2], r[0]) < (at, rid)]
        if not earlier:
            found[rid] = ("no_earlier_response", None, None)
            continue
        source = max(earlier, key=lambda r: (r[2], r[0]))
        old, new = source[4] or {}, headers or {}
        if "ETag" not in old or "ETag" not in new:
            found[rid] = ("no_validator", None, None)
        elif old["ETag"] != new["ETag"]:
            found[rid] = ("validator_mismatch", None, None)
        else:
            found[rid] = ("resolved", source[0], source[5])
    return found


def test_a_hot_url_over_many_parts(spark):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        url = "a.com/hot" if rng.random() < 0.5 else f"a.com/{rng.randrange(40)}"
        kind = "response" if rng.random() < 0.3 else "revisit"
        headers = {"ETag": str(rng.randrange(2))} if rng.random() < 0.9 else None
        rows.append((i, url, rng.randrange(200), kind, headers, f"body {i}" if kind == "response" else None))
    got = {r.record_id: (r.status, r.response_id, r.body) for r in m.resolve(table(spark, rows)).collect()}
    assert got == brute_force(rows)


def test_headers_merge_and_case(spark):
    rows = [
        (1, "a.com", 1, "response", {"ETag": 'W/"x"', "Content-Length": "5", "Date": "old", "X": "kept"}, "hello"),
        (2, "A.com/", 2, "revisit", {"etag": '"x"', "content-length": "0", "DATE": "new", "Cache": "c"}, None),
    ]
    row = m.resolve(table(spark, rows)).first()
    assert (row.status, row.response_id, row.body) == ("resolved", 1, "hello")
    assert row.headers == {"etag": '"x"', "content-length": "5", "date": "new", "x": "kept", "cache": "c"}


def test_dates_decide_without_tags_and_nulls_are_defined(spark):
    day = {"Last-Modified": "monday"}
    rows = [
        (1, "a.com", 1, "response", day, "one"),
        (2, "a.com", 3, "revisit", day, None),
        (3, "a.com", 4, "revisit", {"Last-Modified": "tuesday"}, None),
        (4, None, 5, "revisit", day, None),
        (5, "a.com", None, "revisit", day, None),
        (6, "a.com", 1, "response", day, "later id, same time"),
        (7, "b.com", 1, None, None, None),
        (8, "a.com", 0, "revisit", day, None),
    ]
    got = {r.record_id: (r.status, r.response_id) for r in m.resolve(table(spark, rows)).collect()}
    none = ("no_earlier_response", None)
    assert got == {2: ("resolved", 6), 3: ("validator_mismatch", None), 4: none, 5: none, 8: none}
    assert m.resolve(table(spark, rows).limit(0)).count() == 0


def test_the_given_pages(spark):
    found = m.op4_warc_revisits(spark, FOLDER)
    assert mismatch(found, connect(FOLDER), m.WARC_SQL) is None
    assert {r.status for r in found.select("status").distinct().collect()} >= {"resolved", "no_validator", "validator_mismatch"}
