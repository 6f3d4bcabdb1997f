"""Language-model scores of documents: a byte-context trie (ppm.py) beside a smoothed unigram model.

Both learn from the same texts in one pass that counts words and byte grams per task and adds them up
in one shuffle. The trie codes the lower-cased words, one blank between them, and an end. Up to
TRIE_LEAVES distinct grams, the whole trie is sent to every task as arrays. Beyond, counts of all orders
stay tables: the TRIE_LEAVES most frequent grams are sent with their final values, the other grams of
the scored texts are joined. Word counts stay a table, too: the HEAD_WORDS most frequent are sent to
every task, the others are joined. So any vocabulary and any number of grams is scored exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cartlayers.llm.common import SharedArrays, key_text, map_tables, stored, table
from cartlayers.llm.ppm import EDGE, ORDER, SYMBOLS, ByteTrie, Model, grams
from cartlayers.llm.tables import Tally, hash_table, look_up
from cartlayers.llm.words import NOT_SPACE, Words, chunks, expand, text_bytes

HEAD_WORDS = 500_000
#: Of some 20 bytes each, several times in the driver while the model is built.
TRIE_LEAVES = 4_000_000
FOLDS = 10
SMOOTHING = 0.1


def _coded(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The texts as the trie codes them, each after ORDER edges, and where each begins (its edges)."""
    lengths = words.ends - words.starts
    body = np.bincount(words.of, weights=lengths + 1, minlength=words.texts).astype(np.int64)
    body = np.maximum(body, 1)
    begin = np.concatenate([[0], np.cumsum(body + ORDER)])
    out = np.full(begin[-1], EDGE, dtype=np.uint8)
    word, place = expand(lengths)
    before = np.cumsum(lengths + 1) - (lengths + 1)
    of_text = before - np.concatenate([[0], before])[np.minimum(words.first[:-1] + 1, len(before))][words.of]
    target = begin[words.of] + ORDER + of_text
    out[target[word] + place] = words.bytes[words.starts[word] + place]
    blank = target + lengths
    last = words.first[1:][words.counts > 0] - 1
    out[blank] = 0x20
    out[blank[last]] = EDGE
    return out, begin


def _text_grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Grams of all scored bytes, and the text of each."""
    out, begin = _coded(words)
    codes = grams(out)
    text = np.repeat(np.arange(words.texts), np.diff(begin))[ORDER:]
    scored = np.arange(ORDER, len(out)) - begin[text] >= ORDER
    return codes[scored], text[scored]


def _word_lists(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    data, offsets = text_bytes(column)
    for first, last in chunks(offsets):
        yield first, last, Words(data[offsets[first] : offsets[last]], offsets[first : last + 1], NOT_SPACE)


def corpus_counts(texts: DataFrame) -> DataFrame:
    """(kind, key, n): how often each word ("w") and gram ("g") occurs, and the number of texts ("t").

    A null text counts as an empty one. A task sends each key once, or again after every few millions.
    """

    def rows(kind: str, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        kinds = pa.array([kind]).take(pa.array(np.zeros(len(keys), dtype=np.int64)))
        return pa.RecordBatch.from_arrays([kinds, pa.array(keys.view(np.int64)), pa.array(counts)], ["kind", "key", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tallies, texts = {"w": Tally(), "g": Tally()}, 0
        for batch in batches:
            texts += batch.num_rows
            for _, _, words in _word_lists(batch.column(0)):
                tallies["w"].add(words.hashes())
                tallies["g"].add(_text_grams(words)[0])
                for kind, tally in tallies.items():
                    if tally.full():
                        yield from (rows(kind, *part) for part in tally.drain())
        for kind, tally in tallies.items():
            yield from (rows(kind, *part) for part in tally.drain())
        if texts:
            yield rows("t", np.zeros(1, np.uint64), np.array([texts]))

    found = texts.select("text").mapInArrow(count, "kind string, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


#: Orders of at most 65,536 symbols in context, kept apart from the longer ones.
SHORT_ORDER = 1


def _low_bits(column, bits: int):
    return column.bitwiseAND(F.lit((1 << bits) - 1))


@dataclass(frozen=True)
class TrieTables:
    """The whole trie as tables, by order: (order, code, n) and (order, context, total, distinct, free, kinds).

    `free` and `kinds` are what a context leaves of the next shorter one once its symbols are excluded.
    """

    codes: DataFrame
    contexts: DataFrame
    symbols: int

    @staticmethod
    def build(leaves: DataFrame) -> TrieTables:
        """From (key, n) of all distinct grams."""
        order = F.explode(F.array(*[F.struct(F.lit(o).alias("order"), _low_bits(F.col("key"), 8 * (o + 1)).alias("code")) for o in range(ORDER + 1)]))
        codes = leaves.select(order.alias("c"), "n").groupBy("c.order", "c.code").agg(F.sum("n").alias("n"))
        codes = stored(codes)
        kept = F.element_at(F.array(*[F.lit((1 << 8 * o) - 1) for o in range(ORDER + 1)]), F.col("order") + 1)
        shorter = codes.select((F.col("order") + 1).alias("order"), F.col("code").alias("lower"), F.col("n").alias("taken"))
        own = codes.withColumn("lower", F.col("code").bitwiseAND(kept)).join(shorter, ["order", "lower"], "left")
        sums = stored(
            own.groupBy("order", F.shiftright("code", 8).alias("context")).agg(
                F.sum("n").alias("total"), F.count("*").alias("distinct"), F.sum("taken").alias("taken")
            )
        )
        above = F.element_at(F.array(F.lit(0), *[F.lit((1 << 8 * o) - 1) for o in range(ORDER)]), F.col("order") + 1)
        parents = sums.select(
            (F.col("order") + 1).alias("order"), F.col("context").alias("parent"),
            F.col("total").alias("all"), F.col("distinct").alias("sorts"),
        )
        contexts = sums.withColumn("parent", F.col("context").bitwiseAND(above)).join(parents, ["order", "parent"], "left")
        contexts = contexts.select(
            "order", "context", "total", "distinct",
            (F.col("all") - F.col("taken")).alias("free"), (F.col("sorts") - F.col("distinct")).alias("kinds"),
        )
        return TrieTables(codes, stored(contexts), codes.where("order = 0").count())

    def frequent(self, most: int) -> DataFrame:
        """(key, value): the log10 probability of the most frequent grams."""
        head = self.codes.where(F.col("order") == ORDER).orderBy(F.desc("n"), "code").limit(most)
        longest = self.contexts.where(F.col("order") == ORDER).select("context", "total", "distinct")
        value = F.log10(F.col("n") / (F.col("total") + F.col("distinct")))
        return head.withColumn("context", F.shiftright("code", 8)).join(longest, "context").select(F.col("code").alias("key"), value.alias("value"))

    def values(self, asked: DataFrame) -> DataFrame:
        """(key, value): the log10 probability of each distinct gram `key`, as Model.log10 gives it."""
        order = F.explode(F.array(*[F.struct(F.lit(o).alias("order"), _low_bits(F.col("key"), 8 * (o + 1)).alias("code")) for o in range(ORDER + 1)]))
        rows = asked.select("key", order.alias("c")).select("key", "c.order", "c.code", F.shiftright("c.code", 8).alias("context"))
        parts = []
        # few short contexts are shared by all grams: apart, their tables are small
        for of_length in (F.col("order") <= SHORT_ORDER, F.col("order") > SHORT_ORDER):
            codes, contexts = stored(self.codes.where(of_length)), stored(self.contexts.where(of_length))
            parts.append(rows.where(of_length).join(codes, ["order", "code"], "left").join(contexts, ["order", "context"], "left"))
        found = F.struct("n", "total", "distinct", "free", "kinds")
        wide = parts[0].unionByName(parts[1]).groupBy("key").agg(
            *[F.max(F.when(F.col("order") == o, found)).alias(f"o{o}") for o in range(ORDER + 1)]
        )
        value = F.lit(0.0)
        for o in range(ORDER, -1, -1):
            left, sorts = F.col(f"o{o}.total"), F.col(f"o{o}.distinct")
            longer = F.lit(False)
            if o < ORDER:
                left, sorts = F.coalesce(f"o{o + 1}.free", left), F.coalesce(f"o{o + 1}.kinds", sorts)
                longer = F.col(f"o{o + 1}.n").isNotNull()
            term = F.when(longer, 0.0).when(F.col(f"o{o}.n").isNotNull(), F.log10(F.col(f"o{o}.n") / (left + sorts)))
            value = value + term.when(sorts > 0, F.log10(sorts / (left + sorts))).otherwise(0.0)
        never = F.lit(math.log10(max(1, SYMBOLS - self.symbols)))
        return wide.select("key", (value - F.when(F.col("o0.n").isNull(), never).otherwise(0.0)).alias("value"))


@dataclass(frozen=True)
class Scorer:
    """A learned model: word counts as a table, their head and the trie as arrays for tasks.

    `trie` is given if the trie is larger; the arrays then hold its most frequent grams only.
    """

    words: DataFrame
    train_tokens: int
    vocabulary: int
    arrays: SharedArrays
    trie: TrieTables | None = None

    def log10(self, count):
        """Smoothed log probability of a token that occurs `count` times, for a Column."""
        return F.log10((count + SMOOTHING) / self.whole)

    @property
    def whole(self) -> float:
        return self.train_tokens + SMOOTHING * (self.vocabulary + 1)


def _arrow_keys(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return rows.column("key").to_numpy().view(np.uint64), rows.column("n").to_numpy()


def learn(texts: DataFrame) -> Scorer:
    spark = texts.sparkSession
    counts = stored(corpus_counts(texts))
    words = counts.where("kind = 'w'").select("key", "n")
    sums = {r.kind: (r.n, r.keys) for r in counts.groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("keys")).collect()}
    n_words, kinds = sums.get("w", (0, 0))
    n_texts = sums.get("t", (0, 0))[0]
    tokens, vocabulary = n_words + n_texts, kinds + (n_texts > 0)
    whole = tokens + SMOOTHING * (vocabulary + 1)
    keys, n = _arrow_keys(words.orderBy(F.desc("n"), "key").limit(HEAD_WORDS).toArrow())
    places, values = hash_table(keys, np.log10((n + SMOOTHING) / whole))
    leaves, tables = counts.where("kind = 'g'").select("key", "n"), None
    if sums.get("g", (0, 0))[1] <= TRIE_LEAVES:
        trie = Model.build(*_arrow_keys(leaves.toArrow()))
    else:
        tables = TrieTables.build(leaves)
        head = tables.frequent(TRIE_LEAVES).toArrow()
        places_of, values_of = hash_table(head.column("key").to_numpy().view(np.uint64), head.column("value").to_numpy())
        trie = {"places": places_of, "values": values_of}
    end = np.array([math.log10((n_texts + SMOOTHING) / whole), float(n_texts > 0)])
    arrays = SharedArrays.send(spark, head_places=places, head_values=values, end=end, **trie)
    return Scorer(words, tokens, vocabulary, arrays, tables)


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """`docs` with n_tokens, n_known, train_tokens, base_score and score, one row for each of its rows.

    A null text is empty: its only token is the end. base_score is the unigram model's, score the
    trie's log10 probability. If nothing was learned, base_score is 0 and every byte has probability
    1/256. Columns with these names are replaced.
    """
    names = ["n_tokens", "n_known", "train_tokens", "base_score", "score"]
    kept, shared, whole = docs.drop(*names), scorer.arrays, scorer.trie is None

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrays = shared.open()
        model, task, n = Model(arrays), TaskContext.get().partitionId() << 40, 0
        for batch in batches:
            for first, last, words in _word_lists(batch.column("text")):
                hashes = words.hashes()
                value, known = look_up(arrays["head_places"], arrays["head_values"], hashes)
                codes, text = _text_grams(words)
                if whole:
                    logs, open_ = model.log10(codes), np.zeros(0, dtype=np.int64)
                else:
                    logs, there = look_up(arrays["places"], arrays["values"], codes)
                    logs, open_ = np.where(there, logs, 0.0), np.flatnonzero(~there)
                by_gram = np.concatenate([[0], np.cumsum(np.bincount(text[open_], minlength=words.texts))])
                rare = np.flatnonzero(~known)
                by_text = np.concatenate([[0], np.cumsum(np.bincount(words.of[rare], minlength=words.texts))])
                added = [
                    pa.array(task + n + np.arange(words.texts)),
                    pa.array(words.counts + 1),
                    pa.array(np.bincount(words.of[known], minlength=words.texts) + int(arrays["end"][1])),
                    pa.array(np.bincount(words.of[known], weights=value[known], minlength=words.texts) + arrays["end"][0]),
                    pa.array(np.bincount(text, weights=logs, minlength=words.texts)),
                    pa.ListArray.from_arrays(pa.array(by_text.astype(np.int32)), pa.array(hashes[rare].view(np.int64))),
                    pa.ListArray.from_arrays(pa.array(by_gram.astype(np.int32)), pa.array(codes[open_].view(np.int64))),
                ]
                n += words.texts
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays(part.drop_columns(["text"]).columns + added, columns)

    more = "_score_row long, n_tokens long, n_known long, base_score double, score double, _score_rare array<long>, _score_open array<long>"
    schema = kept.drop("text").schema
    schema = T.StructType(schema.fields + T.StructType.fromDDL(more).fields)
    columns = schema.names
    first = stored(kept.mapInArrow(measure, schema))
    rare = first.select("_score_row", F.explode("_score_rare").alias("key")).groupBy("_score_row", "key").agg(F.count("*").alias("times"))
    found = rare.join(scorer.words, "key", "left").groupBy("_score_row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("_known"),
        F.sum(F.col("times") * scorer.log10(F.coalesce("n", F.lit(0)))).alias("_base"),
    )
    first = first.join(found, "_score_row", "left")
    value = F.col("score")
    if not whole:
        asked = first.select("_score_row", F.explode("_score_open").alias("key")).groupBy("_score_row", "key").agg(F.count("*").alias("times"))
        values = scorer.trie.values(asked.select("key").distinct())
        logs = asked.join(values, "key").groupBy("_score_row").agg(F.sum(F.col("times") * F.col("value")).alias("_open"))
        first = first.join(logs, "_score_row", "left")
        value = value + F.coalesce("_open", F.lit(0.0))
    return first.select(
        *[c for c in kept.columns if c != "text"],
        "n_tokens",
        (F.col("n_known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
        F.lit(scorer.train_tokens).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("_base", F.lit(0.0))).alias("base_score"),
        value.alias("score"),
    )


def adaptive_scores(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """doc_id and score: log10 probability of each text under a trie that learns from that text alone."""

    def measure(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for first, last, words in _word_lists(batch.column(1)):
            out, begin = _coded(words)
            scores = [
                ByteTrie(order).score(out[a + ORDER : b - 1].tobytes(), adapt=True)
                for a, b in zip(begin, begin[1:], strict=False)
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), pa.array(scores)], ["doc_id", "score"])

    return map_tables(docs.select("doc_id", "text"), measure, "doc_id long, score double")


def op9_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = key_text(F.col("doc_id")) % FOLDS == 0
    scorer = learn(docs.where(~held_out))
    return score(docs.withColumn("held_out", held_out), scorer)
