"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. A trigram's vector binds (multiplies) those of its
three letters, each rotated by its place. A text's vector bundles (adds) its trigrams, a language's
prototype those of its training texts. A text gets the language whose prototype has the largest
cosine with it.

Letters are lower-cased, everything else separates words and counts as one blank, so trigrams also
see the ends of words. All sums are of whole numbers, hence independent of partitioning.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.llm.common import giving_back, key_text, table
from cartlayers.llm.words import chunks, randoms, text_bytes

DIMENSIONS = 1024
#: Letters beyond the first 2048 code points share as many further vectors.
OWN_LETTERS = 2048
#: Prototypes are held in memory by every task: at most so many languages of 8 kB each.
MOST_LANGUAGES = 4096
UNDETERMINED = "und"
TEXT_BYTES = 1 << 20
FOLDS = 5


@lru_cache(maxsize=1)
def _letter_slots() -> np.ndarray:
    """Slot of each code point's lower-case letter; 0 for what is no letter."""
    slots = np.zeros(0x110000, dtype=np.int16)
    for code in range(0x110000):
        letter = chr(code)
        if letter.isalpha():
            low = letter.lower()
            small = ord(low) if len(low) == 1 else code
            slots[code] = small if small < OWN_LETTERS else OWN_LETTERS + small % OWN_LETTERS
    return slots


@lru_cache(maxsize=1)
def _letter_vectors() -> np.ndarray:
    """For each place in a trigram, the vectors of all slots."""
    bits = np.unpackbits(randoms(2 * OWN_LETTERS * DIMENSIONS // 64, 5).view(np.uint8))
    plain = (bits.astype(np.int8) * 2 - 1).reshape(-1, DIMENSIONS)
    return np.stack([np.roll(plain, 2 - place, axis=1) for place in range(3)])


def _code_points(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of texts laid end to end, and how many each text has; broken bytes are replaced."""
    try:
        whole = data.tobytes().decode("utf-8")
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        counts = np.diff(heads[offsets - offsets[0]])
    except UnicodeDecodeError:
        start = offsets - offsets[0]
        texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(start, start[1:], strict=False)]
        whole, counts = "".join(texts), np.array([len(x) for x in texts])
    return np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32), counts


class Trigrams:
    """Distinct trigrams of a range of texts, and for each occurrence its trigram and its text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        points, counts = _code_points(data, offsets)
        self.texts = len(counts)
        text = np.repeat(np.arange(self.texts), counts)
        padded = np.zeros(len(points) + 2 * self.texts, dtype=np.int16)
        padded[np.arange(len(points)) + 2 * text + 1] = _letter_slots()[points]
        text = np.repeat(np.arange(self.texts), counts + 2)
        keep = padded != 0
        keep[1:] |= padded[:-1] != 0
        keep[np.cumsum(counts + 2) - (counts + 2)] = True
        slots, text = padded[keep].astype(np.int64), text[keep]
        inside = text[2:] == text[:-2]
        self.text = text[2:][inside]
        present = np.flatnonzero(np.bincount(slots, minlength=1))
        rank = np.zeros(2 * OWN_LETTERS, dtype=np.int64)
        rank[present] = np.arange(len(present))
        small, n = rank[slots], len(present)
        codes = ((small[:-2] * n + small[1:-1]) * n + small[2:])[inside]
        if n <= 160:
            known = np.flatnonzero(np.bincount(codes, minlength=1)) if len(codes) else np.zeros(0, np.int64)
            spot = np.zeros(n**3, dtype=np.int64)
            spot[known] = np.arange(len(known))
            self.which = spot[codes]
        else:
            known, self.which = np.unique(codes, return_inverse=True)
        self.letters = present[np.stack([known // (n * n), known // n % n, known % n])] if n else np.zeros((3, 0), int)

    def counts(self, row: np.ndarray, rows: int) -> np.ndarray:
        """Occurrences per row and trigram; `row` assigns a row to every text, or -1."""
        n = self.letters.shape[1]
        own = row[self.text]
        use = own >= 0
        return np.bincount(own[use] * n + self.which[use], minlength=rows * n).reshape(rows, n)

    def bundle(self, counts: np.ndarray) -> np.ndarray:
        """The vector of every row of counts."""
        total = np.zeros((len(counts), DIMENSIONS), dtype=np.float32)
        vectors = _letter_vectors()
        for a in range(0, counts.shape[1], 2048):
            some = slice(a, a + 2048)
            bound = vectors[0][self.letters[0, some]] * vectors[1][self.letters[1, some]]
            bound *= vectors[2][self.letters[2, some]]
            total += counts[:, some].astype(np.float32) @ bound.astype(np.float32)
        return total


@dataclass(frozen=True)
class Profiles:
    languages: list[str]
    #: Unit prototypes, one row per language.
    vectors: np.ndarray


def _training_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        names = coded.dictionary.to_pylist()
        row = coded.indices.to_numpy(zero_copy_only=False)
        data, offsets = text_bytes(batch.column(1))
        for first, last in chunks(offsets, TEXT_BYTES):
            grams = Trigrams(data[offsets[first] : offsets[last]], offsets[first : last + 1])
            vectors = grams.bundle(grams.counts(row[first:last], len(names)))
            for name, vector in zip(names, vectors, strict=True):
                sums[name] = sums.get(name, 0) + vector.astype(np.int64)
    if sums:
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
            ["lang", "vector"],
        )


def _add(rows: pa.Table) -> pa.Table:
    total = np.zeros(DIMENSIONS, dtype=np.int64)
    for value in rows.column("vector"):
        total += np.frombuffer(value.as_py(), np.int64)
    return pa.table({"lang": rows.column("lang")[:1], "vector": pa.array([total.tobytes()], pa.binary())})


def learn(labelled: DataFrame) -> Profiles:
    """Prototypes from all rows of (lang, text); rows without a lang or a text teach nothing.

    Tasks send one vector per language; these are added in two steps, so no task gets all of them.
    """
    rows = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    parts = rows.mapInArrow(giving_back(_training_part), "lang string, vector binary")
    parts = parts.withColumn("salt", F.spark_partition_id() % 64)
    halfway = parts.groupBy("lang", "salt").applyInArrow(_add, "lang string, vector binary")
    found = halfway.groupBy("lang").applyInArrow(_add, "lang string, vector binary").limit(MOST_LANGUAGES + 1).collect()
    if len(found) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    sums = {r.lang: np.frombuffer(bytes(r.vector), np.int64).astype(np.float64) for r in found}
    names = sorted(name for name, v in sums.items() if v.any())
    units = [sums[n] / np.linalg.norm(sums[n]) for n in names]
    return Profiles(names, np.array(units).reshape(-1, DIMENSIONS))


def identify(docs: DataFrame, profiles: Profiles) -> DataFrame:
    """`docs` with lang_pred and score, from `text` alone.

    A null text, or one without a letter, gets "und" and score 0, as does every text if nothing was
    learned. Negative cosines count as 0; of equal ones the language first in order wins. Columns that
    already bear these names are replaced.
    """
    kept = docs.drop("lang_pred", "score")
    names = np.array([*profiles.languages, UNDETERMINED], dtype=object)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best, score = [], []
            data, offsets = text_bytes(batch.column("text"))
            for first, last in chunks(offsets, TEXT_BYTES):
                grams = Trigrams(data[offsets[first] : offsets[last]], offsets[first : last + 1])
                vectors = grams.bundle(grams.counts(np.arange(grams.texts), grams.texts)).astype(np.float64)
                size = np.linalg.norm(vectors, axis=1)
                likeness = vectors @ profiles.vectors.T / np.where(size > 0, size, 1)[:, None]
                if profiles.languages:
                    pick = np.where(size > 0, likeness.argmax(axis=1), len(profiles.languages))
                    score.append(np.where(size > 0, likeness.max(axis=1), 0.0).clip(0, 1))
                else:
                    pick = np.zeros(grams.texts, dtype=int)
                    score.append(np.zeros(grams.texts))
                best.append(pick)
            if best:
                yield batch.append_column("lang_pred", pa.array(names[np.concatenate(best)], pa.string())).append_column(
                    "score", pa.array(np.concatenate(score))
                )

    schema = T.StructType(kept.schema.fields + T.StructType.fromDDL("lang_pred string, score double").fields)
    return kept.mapInArrow(giving_back(predict), schema)


def held_out(doc_id) -> F.Column:
    return key_text(doc_id) % FOLDS == 0


def profiles_of(docs: DataFrame) -> Profiles:
    """Learn from the documents outside the held-out fold."""
    return learn(docs.where(~held_out(F.col("doc_id"))))


def op1_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = identify(docs.select("doc_id", "text"), profiles_of(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
