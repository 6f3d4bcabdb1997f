"""Token totals by source, language and tokenizer version, kept up to date from deltas.

A batch is a set of changes: an insert adds a document's counts, a delete takes them away, a revision
takes the former counts away and adds the new ones. Changes become signed counts, which are summed per
group before they are stored, so a batch adds at most a row per group and task to read. Every batch has
a folder of its own, written whole and then committed by a marker; a batch that is committed again is left
as it is, one that broke off is written anew. Totals are the sums over all committed batches.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.llm.common import shared_folder, table

GROUP = ["source", "lang", "tokenizer"]
SUMS = ["documents", "tokens"]
SCHEMA = "source string, lang string, tokenizer string, documents long, tokens long"


def tokenizers() -> dict[str, Column]:
    """Versions of simple tokenizers over a column `text`; a null text has no tokens."""
    text = F.coalesce("text", F.lit(""))
    return {
        "bytes-v1": F.octet_length(text).cast("long"),
        "words-v1": F.regexp_count(text, F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long"),
        "words-v2": F.regexp_count(text, F.lit(r"[0-9A-Za-z\x{80}-\x{10FFFF}]+")).cast("long"),
    }


def counted(docs: DataFrame, counters: Mapping[str, Column]) -> DataFrame:
    """source, lang, tokenizer and tokens: a row for every document and tokenizer version."""
    pairs = F.array(*[F.struct(F.lit(n).alias("tokenizer"), c.alias("tokens")) for n, c in counters.items()])
    return docs.select("source", "lang", F.inline(pairs))


def signed(rows: DataFrame, sign: int) -> DataFrame:
    """Counts that are added (1) or taken away (-1)."""
    return rows.select(*GROUP, F.lit(sign).cast("long").alias("documents"), (F.col("tokens") * sign).alias("tokens"))


def changes(
    inserted: DataFrame | None = None,
    deleted: DataFrame | None = None,
    revised: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Signed counts of a batch, from counted rows; `revised` has the former and the new counts."""
    parts = [(inserted, 1), (deleted, -1), *(zip(revised, (-1, 1), strict=True) if revised else ())]
    found = [signed(rows, sign) for rows, sign in parts if rows is not None]
    if not found:
        raise ValueError("a batch needs changes")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every


@dataclass(frozen=True)
class Rollup:
    """Totals in a shared folder."""

    spark: SparkSession
    path: str

    def _file(self, name: str):
        java = self.spark.sparkContext._jvm
        place = java.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), place

    def committed(self, batch: str) -> bool:
        system, place = self._file(f"batch={batch}/_SUCCESS")
        return bool(system.exists(place))

    def commit(self, batch: str, delta: DataFrame) -> bool:
        """Store a batch of signed counts; False if it had been committed before.

        The name is letters, digits, dots and dashes. Spark writes the marker after all files have
        been moved in place, so a lost executor or driver leaves a batch that readers do not see.
        """
        if not batch or not all(c.isalnum() or c in ".-" for c in batch):
            raise ValueError("a batch name has letters, digits, dots and dashes")
        if self.committed(batch):
            return False
        sums = delta.groupBy(*GROUP).agg(*[F.sum(c).cast("long").alias(c) for c in SUMS])
        marked = {"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"}
        sums.write.mode("overwrite").options(**marked).parquet(f"{self.path}/batch={batch}")
        return True

    def batches(self) -> list[str]:
        """Names of the committed batches."""
        system, place = self._file("")
        if not system.exists(place):
            return []
        names = [s.getPath().getName().removeprefix("batch=") for s in system.listStatus(place) if s.isDirectory()]
        return sorted(n for n in names if self.committed(n))

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, documents and tokens; groups that have come to nothing are left out."""
        paths = [f"{self.path}/batch={b}" for b in self.batches()]
        read = self.spark.read.schema(SCHEMA)
        every = read.parquet(*paths) if paths else self.spark.createDataFrame([], SCHEMA)
        sums = every.groupBy(*GROUP).agg(*[F.sum(c).alias(c) for c in SUMS])
        return sums.where((F.col("documents") != 0) | (F.col("tokens") != 0))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Totals after four batches: all documents inserted, those of one id in eleven deleted, the texts of
    one in seven of the others revised (the first line goes), and the second batch committed once more."""
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    counters = tokenizers()
    gone = docs.where(F.col("doc_id") % 11 == 0)
    old = docs.where((F.col("doc_id") % 11 != 0) & (F.col("doc_id") % 7 == 0))
    new = old.withColumn("text", F.regexp_replace("text", r"^[^\n]*\n?", ""))
    rollup = Rollup(spark, shared_folder(spark))
    rollup.commit("1", changes(inserted=counted(docs, counters)))
    rollup.commit("2", changes(deleted=counted(gone, counters)))
    rollup.commit("3", changes(revised=(counted(old, counters), counted(new, counters))))
    rollup.commit("2", changes(deleted=counted(gone, counters)))
    return rollup.totals()


#: The same from the state after all batches.
TOKEN_COUNTS_SQL = r"""
WITH kept AS (
  SELECT source, lang, CASE WHEN doc_id % 7 = 0 THEN regexp_replace(text, '^[^\n]*\n?', '') ELSE text END AS text
  FROM documents WHERE doc_id % 11 <> 0 OR doc_id IS NULL
), counted AS (
  SELECT source, lang, 'bytes-v1' AS tokenizer, strlen(coalesce(text, '')) AS tokens FROM kept
  UNION ALL
  SELECT source, lang, 'words-v1', len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) FROM kept
  UNION ALL
  SELECT source, lang, 'words-v2', len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) FROM kept
)
SELECT source, lang, tokenizer, count(*) AS documents, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counted GROUP BY source, lang, tokenizer
"""
