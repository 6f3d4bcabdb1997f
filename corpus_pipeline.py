"""From raw documents to token ids: language, near duplicates, benchmark passages, personal data, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns
of `documents`. A stage works on all rows its predecessor kept.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.llm import bpe, contamination, jaccard_join, language_id, personal_data
from cartlayers.llm.common import prepared, stored, table


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, and all other columns in one, so that their names meet none that an operator adds."""
    return docs.select("doc_id", "text", F.struct(*[c for c in docs.columns if c not in ("doc_id", "text")]).alias("document"))


def _unpacked(found: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again, in their order."""
    return found.select([c if c in ("doc_id", "text") else F.col("document")[c].alias(c) for c in docs.columns])


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a letter; only undetermined ones go, however unlike the learned languages a text is."""
    prepared(spark)
    found = language_id.identify(_packed(docs), language_id.profiles_of(docs))
    return _unpacked(found.where(F.col("lang_pred") != language_id.UNDETERMINED), docs)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    prepared(spark)
    return jaccard_join.one_of_each(docs)


def keep_clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words repeats benchmark windows."""
    found = contamination.contamination(_packed(docs), table(spark, sf_dir, "benchmark"))
    return _unpacked(found.where(~F.col("contaminated")), docs)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    prepared(spark)
    found = personal_data.detect(_packed(docs))
    spans = F.sort_array(F.concat("spans", "added"))
    hidden = found.select("*", (F.size(spans) > 0).alias("changed")).withColumn(
        "text", personal_data.redacted(F.col("text"), spans)
    )
    n_chars = F.when(F.col("changed"), F.length("text")).otherwise(F.col("document")["n_chars"]).cast("long")
    return _unpacked(hidden.withColumn("document", F.col("document").withField("n_chars", n_chars)), docs)


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with hashes of the ids and of the text decoded from them."""
    prepared(spark)
    encoder = bpe.prepare(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return bpe.encode(docs, encoder).drop("text")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_languages),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_clean),
    ("personal_data", hide_personal_data),
    ("tokens", to_tokens),
]

#: Cosines, merges and bootstrapped patterns are beyond SQL; a brute-force version in the tests agrees.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
