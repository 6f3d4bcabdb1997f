"""Not-modified revisits of a web archive, resolved to the response they stand for.

A revisit has no body; it says that the page is as it was. For each one the latest earlier full
response of the same canonical URL is found (an as-of join), its validators are compared, and the headers
that a not-modified answer may update are merged into the stored ones.

Records are dealt by ranges of (URL, time), so a URL of any number of records spreads over many tasks.
Within a part a window carries the last response forward; the last response of the parts before comes
from a small table with one row per URL and part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartlayers.llm.common import stored, table

#: Headers that describe the body or the connection; a revisit never updates them.
KEPT_HEADERS = [
    "connection", "content-encoding", "content-length", "content-range", "content-type", "keep-alive",
    "proxy-authenticate", "proxy-authorization", "te", "trailer", "transfer-encoding", "upgrade",
]
#: Query parameters that only track.
TRACKING = "utm_[a-z]+|ref|gclid|fbclid|sessionid|sid"
STATUSES = ("resolved", "validator_mismatch", "no_validator", "no_earlier_response")


def canonical_url(url: Column) -> Column:
    """Scheme and `www.` dropped, host in small letters, default port, fragment, tracking parameters and
    closing slash dropped, parameters in order. Null stays null."""
    bare = F.regexp_replace(F.trim(url), "#.*$", "")
    bare = F.regexp_replace(bare, r"^(?i:https?)://(?:(?i:www)\.)?", "")
    host = F.lower(F.regexp_replace(F.regexp_extract(bare, r"^([^/?]*)", 1), r":(?:80|443)$", ""))
    path = F.regexp_replace(F.regexp_extract(bare, r"^[^/?]*([^?]*)", 1), "/+$", "")
    query = F.regexp_extract(bare, r"^[^?]*[?](.*)$", 1)
    params = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(rf"^(?i:{TRACKING})(?:=|$)"))
    joined = F.array_join(F.array_sort(params), "&")
    return F.concat(host, path, F.when(joined != "", F.concat(F.lit("?"), joined)).otherwise(""))


def _lower_keys(headers: Column) -> Column:
    """Headers with small names; of several that differ only in case the last counts."""
    entries = F.map_entries(F.coalesce(headers, F.expr("cast(map() as map<string,string>)")))
    names = F.array_distinct(F.transform(entries, lambda e: F.lower(e.key)))

    def last(name: Column) -> Column:
        return F.struct(name.alias("key"), F.element_at(F.filter(entries, lambda e: F.lower(e.key) == name), -1).value.alias("value"))

    return F.map_from_entries(F.transform(names, last))


def _agreement(stored_headers: Column, sent: Column) -> Column:
    """Whether validators agree: true, false, or null where there is none in common.

    Entity tags decide if both have one (weak comparison), else the modification date.
    """

    def tag(headers: Column) -> Column:
        return F.regexp_replace(F.try_element_at(headers, F.lit("etag")), "^W/", "")

    def date(headers: Column) -> Column:
        return F.try_element_at(headers, F.lit("last-modified"))

    return F.coalesce(tag(stored_headers) == tag(sent), date(stored_headers) == date(sent))


def resolve(records: DataFrame) -> DataFrame:
    """`record_id, url, captured, kind, headers, body` -> every revisit with the response it stands for.

    kind is "response" or "revisit"; other kinds (and null) are neither. Output: record_id, canonical,
    captured, status (one of STATUSES), response_id, headers (merged) and body; the last three are null
    unless resolved. Earlier means a smaller captured time; at the same time, a smaller record_id. A
    null URL or time finds nothing. Headers that are null count as none. Repeated revisits are resolved
    each; repeated responses are one. Other columns are ignored.
    """
    known = records.where(F.col("kind").isin("response", "revisit")).select(
        "record_id", canonical_url(F.col("url")).alias("canonical"), "captured",
        (F.col("kind") == "response").alias("full"), _lower_keys(F.col("headers")).alias("headers"), "body",
    )
    usable = F.col("canonical").isNotNull() & F.col("captured").isNotNull()
    # bodies stay behind: only ids, validators and headers are ordered
    slim = known.where(usable).drop("body")
    parts = records.sparkSession.conf.get("spark.sql.shuffle.partitions")
    dealt = slim.repartitionByRange(int(parts), "canonical", "captured", "record_id")
    dealt = stored(dealt.withColumn("part", F.spark_partition_id()))
    response = F.when(F.col("full"), F.struct("record_id", "captured", "headers"))
    order = Window.partitionBy("canonical", "part").orderBy("captured", "record_id", F.col("full").desc())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    near = dealt.withColumn("near", F.last(response, ignorenulls=True).over(before)).where(~F.col("full"))
    ends = dealt.where("full").groupBy("canonical", "part").agg(
        F.max_by(F.struct("record_id", "captured", "headers"), F.struct("captured", "record_id")).alias("end")
    )
    asked = dealt.where(~F.col("full")).select("canonical", "part").distinct()
    both = ends.join(asked, ["canonical", "part"], "full")
    earlier = Window.partitionBy("canonical").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    far = both.withColumn("far", F.last("end", ignorenulls=True).over(earlier)).where("far is not null").drop("end")
    found = near.join(far, ["canonical", "part"], "left").withColumn("source", F.coalesce("near", "far"))
    agreed = _agreement(F.col("source.headers"), F.col("headers"))
    status = (
        F.when(F.col("source").isNull(), STATUSES[3])
        .when(agreed, STATUSES[0]).when(~agreed, STATUSES[1]).otherwise(STATUSES[2])
    )
    judged = found.withColumn("status", status).withColumn("response_id", F.when(F.col("status") == STATUSES[0], F.col("source.record_id")))
    sent = F.map_filter("headers", lambda k, v: ~k.isin(KEPT_HEADERS) & v.isNotNull())
    merged = F.map_concat(F.map_filter("source.headers", lambda k, v: ~F.map_contains_key(sent, k)), sent)
    judged = judged.select(
        "record_id", "canonical", "captured", "status", "response_id",
        F.when(F.col("response_id").isNotNull(), merged).alias("headers"),
    )
    lost = known.where(~F.col("full") & ~usable).select(
        "record_id", "canonical", "captured", F.lit(STATUSES[3]).alias("status"),
        F.lit(None).cast(dealt.schema["record_id"].dataType).alias("response_id"),
        F.lit(None).cast("map<string,string>").alias("headers"),
    )
    bodies = known.where("full").groupBy(F.col("record_id").alias("response_id")).agg(F.min("body").alias("body"))
    return judged.join(bodies, "response_id", "left").unionByName(lost.withColumn("body", F.lit(None).cast("string")))


def records_of(pages: DataFrame) -> DataFrame:
    """The captures that the pages table stands for.

    Every page is a full response: at minute page_id, with a tag and a date made from its HTML. A week
    later it is asked for again and answered not modified; of these answers every fifth has another
    tag, every seventh no validator at all.
    """
    tag = F.concat(F.lit('"'), F.md5("html"), F.lit('"'))
    day = F.concat(F.lit("2024-01-"), F.lpad((F.length("html") % 28 + 1).cast("string"), 2, "0"))
    has_text = F.col("html").isNotNull()
    full = pages.select(
        (F.col("page_id") * 2).alias("record_id"), "url", F.col("page_id").alias("captured"), F.lit("response").alias("kind"),
        F.create_map(
            F.lit("ETag"), F.coalesce(tag, F.lit("none")), F.lit("Last-Modified"), F.coalesce(day, F.lit("never")),
            F.lit("Content-Length"), F.length(F.coalesce("html", F.lit(""))).cast("string"), F.lit("Date"), F.col("page_id").cast("string"),
        ).alias("headers"),
        F.col("html").alias("body"),
    )
    later = F.col("page_id") + 7 * 24 * 60
    sent = (
        F.when(F.col("page_id") % 7 == 0, F.create_map(F.lit("Date"), later.cast("string"), F.lit("Content-Length"), F.lit("0")))
        .otherwise(
            F.create_map(
                F.lit("etag"), F.when(F.col("page_id") % 5 == 0, F.lit('"other"')).otherwise(F.coalesce(tag, F.lit("none"))),
                F.lit("Date"), later.cast("string"), F.lit("Content-Length"), F.lit("0"),
            )
        )
    )
    again = pages.where(has_text).select(
        (F.col("page_id") * 2 + 1).alias("record_id"), "url", later.alias("captured"), F.lit("revisit").alias("kind"),
        sent.alias("headers"), F.lit(None).cast("string").alias("body"),
    )
    return full.unionByName(again)


def op4_warc_revisits(spark: SparkSession, folder: str) -> DataFrame:
    """Every revisit of the pages' captures: its response, and the merged headers and body as digests."""
    found = resolve(records_of(table(spark, folder, "pages")))
    entries = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat_ws("=", e.key, e.value)))
    return found.select(
        "record_id", "canonical", "captured", "status", "response_id",
        F.md5(F.array_join(entries, "\n")).alias("headers_md5"), F.md5("body").alias("body_md5"),
    )


#: The same as a correlated search for the latest earlier response, in DuckDB.
WARC_SQL = r"""
WITH urls AS (
  SELECT page_id, html, regexp_replace(regexp_replace(trim(url, ' '), '#.*$', ''), '^(?i:https?)://((?i:www)\.)?', '') AS bare FROM pages
), parts AS (
  SELECT page_id, html, bare,
    lower(regexp_replace(regexp_extract(bare, '^([^/?]*)', 1), ':(80|443)$', ''))
      || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/+$', '') AS place,
    array_to_string(list_sort(list_filter(string_split(regexp_extract(bare, '^[^?]*[?](.*)$', 1), '&'),
      lambda p: p <> '' AND NOT regexp_matches(p, '^(?i:utm_[a-z]+|ref|gclid|fbclid|sessionid|sid)(=|$)'))), '&') AS query
  FROM urls
), captured AS (
  SELECT page_id, html, CASE WHEN bare IS NULL THEN NULL ELSE place || CASE WHEN query <> '' THEN '?' || query ELSE '' END END AS canonical,
    '"' || md5(html) || '"' AS tag FROM parts
), asked AS (
  SELECT page_id, page_id * 2 + 1 AS record_id, canonical, page_id + 10080 AS captured,
    CASE WHEN page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"other"' ELSE tag END AS tag
  FROM captured WHERE html IS NOT NULL
), joined AS (
  SELECT a.record_id, a.canonical, a.captured, a.tag AS sent, r.page_id AS source, r.tag AS held, r.html
  FROM asked a ASOF LEFT JOIN captured r ON a.canonical = r.canonical AND a.captured > r.page_id
)
SELECT record_id, canonical, captured,
  CASE WHEN source IS NULL THEN 'no_earlier_response' WHEN sent IS NULL THEN 'no_validator'
    WHEN sent = held THEN 'resolved' ELSE 'validator_mismatch' END AS status,
  CASE WHEN sent = held THEN source * 2 END AS response_id,
  CASE WHEN sent = held THEN md5('content-length=' || length(html) || chr(10) || 'date=' || captured || chr(10) || 'etag=' || sent
    || chr(10) || 'last-modified=2024-01-' || lpad(CAST(length(html) % 28 + 1 AS VARCHAR), 2, '0')) END AS headers_md5,
  CASE WHEN sent = held THEN md5(html) END AS body_md5
FROM joined
"""
