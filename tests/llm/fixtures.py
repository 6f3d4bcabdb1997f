"""Small document tables with the cases that every operator must get right."""

from __future__ import annotations

import random
import re

LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
SPACED = re.compile(rb"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLDER = "/root/testdata/sf0.001"


def words(text, pattern=SPACED) -> list[bytes]:
    return pattern.findall((text or "").encode().translate(LOWER))


def prose(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 6))) for _ in range(n))


LONG = prose(1, 30_000)
ODD_TEXTS = [None, "", " \t\n ", "a", "Ä ö", "!!! ???", "12", LONG, LONG, "tie tie tie", "tie tie tie", "中文 字 \U0001f389", prose(2, 60)]
#: Names that operators use for their own columns.
CLASHING = "score double, n_words long, items string, spans string, ids string, lang_pred string, k1 long, _row long, part int"


def odd_documents(spark):
    """(doc_id, text, lang, source, n_chars) and clashing columns; a repeated row, a null id."""
    rows = [(i, t, "xx" if i % 2 else None, None, len(t or ""), *[None] * 9) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (None, "no id at all here", "xx", "s", 17, *[None] * 9)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING)


def no_documents(spark):
    return odd_documents(spark).limit(0)


def documents(spark, texts, lang=None):
    rows = [(i, t, lang[i] if lang else "xx", "s", len(t or "")) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def given(spark, name: str):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")
