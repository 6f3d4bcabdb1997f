"""Licence notices in texts, by a trained paragraph classifier and comparison with templates.

A multinomial logistic regression over word unigrams and bigrams tells the families, "unknown" (speaks
of a licence, of no known family) and "none" apart. It learns from shortened and damaged variants of
the templates below and from a bounded sample of the texts' own paragraphs. Its probabilities are
calibrated by a temperature on variants it has not seen; a family below LEAST_PROBABILITY is unknown.
A predicted family counts as confirmed if the paragraph shares enough n-grams with one of its templates.

Scanning is one projection without a shuffle; the model is a constant of the expression. Paragraphs
(lines) without a telling word are "none" without scoring: those words are chosen after training so that
the n-grams of all other words together cannot lift any family above "none". The gate so only saves time.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlayers.llm.common import table

#: Short notices of public licences, by family.
TEMPLATES = {
    "agpl-3.0": ["Licensed under the GNU Affero General Public License, version 3."],
    "all-rights-reserved": ["All rights reserved.", "Copyright by the author. All rights reserved."],
    "apache-2.0": [
        "Released under Apache 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
    ],
    "bsd-3-clause": [
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ],
    "cc-by-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "cc0-1.0": ["Dedicated to the public domain under CC0 1.0."],
    "gpl-2.0": ["This program is licensed under the GNU General Public License, version 2.", "GNU GPLv2 or later"],
    "gpl-3.0": [
        "GNU GPLv3 or later",
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it under the terms of the GNU General Public License, version 3.",
    ],
    "lgpl-3.0": ["Licensed under the GNU Lesser General Public License, version 3."],
    "mit": [
        "Released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software, to deal in the software without restriction.",
    ],
    "mpl-2.0": ["This source code is subject to the terms of the Mozilla Public License, version 2.0."],
}
UNKNOWN_NOTICES = [
    "See the license file for the terms of use.",
    "Distributed under the terms of a custom license.",
    "Licensed under the terms of the vendor agreement.",
    "Use of this text is subject to a license agreement.",
    "This work is released under its own license.",
    "Copyright and license information is in the notice file.",
]
UNKNOWN, NONE = "unknown", "none"
#: Ordinary paragraphs to learn from, at most, and documents they are taken from.
MOST_ORDINARY = 1000
LEAST_PROBABILITY, LEAST_SIMILARITY = 0.5, 0.5
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
WORD = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"


def words_of(paragraph: Column) -> Column:
    return F.regexp_extract_all(F.lower(paragraph), F.lit(WORD), F.lit(0))


def _bound(value: Column, function) -> Column:
    """function(value), with the value computed once however often the function names it."""
    return F.element_at(F.transform(F.array(value), function), 1)


def ngrams_of(words: Column) -> Column:
    """Distinct words and pairs of neighbours."""

    def both(own: Column) -> Column:
        pairs = F.transform(
            F.sequence(F.lit(1), F.size(own) - 1),
            lambda i: F.concat_ws(" ", F.element_at(own, i), F.element_at(own, i + 1)),
        )
        return F.array_distinct(F.concat(own, F.when(F.size(own) > 1, pairs).otherwise(F.expr("cast(array() as array<string>)"))))

    return _bound(words, both)


def _plain_ngrams(text: str) -> list[str]:
    words = re.findall(WORD, text.lower())
    return list(dict.fromkeys(words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]))


def _variants(spark: SparkSession) -> DataFrame:
    """(label, words, fold): every notice, whole, with one word left out, cut short, or amid other words."""
    notices = [(f, t) for f, texts in TEMPLATES.items() for t in texts] + [(UNKNOWN, t) for t in UNKNOWN_NOTICES]
    whole = spark.createDataFrame(notices, "label string, text string").withColumn("words", words_of(F.col("text")))
    at = F.explode(F.sequence(F.lit(0), F.size("words")))
    left_out = whole.withColumn("at", at).select(
        "label", F.filter("words", lambda w, i: i != F.col("at") - 1).alias("words"), (F.col("at") % 4 == 3).alias("held")
    )
    amid = whole.select(
        "label",
        F.explode(
            F.array(*[F.concat(F.array(*map(F.lit, a.split())), "words", F.array(*map(F.lit, b.split()))) for a, b in
                      (("note", "see below"), ("this document is", "and more"), ("the text", "thank you"))])
        ).alias("words"),
        F.lit(False).alias("held"),
    )
    return left_out.unionByName(amid).where(F.size("words") > 0)


#: Lines that are no ordinary paragraphs to learn from: they may be notices.
NOTICE = (
    r"(?i)(?<![a-z0-9])(?:licen[cs]\w*|copyright|rights|permission|redistribut\w*|[al]?gpl\w*|mpl|cc0|domain|gnu|bsd|mozilla|spdx"
    r"|creative commons|cc[ -]by|apache[ -][0-9]|under (?:the )?(?:mit|apache))(?![a-z0-9])"
)

def telling_words(weights: dict[str, list[float]], intercepts: list[float], none: int, common: list[str]) -> list[str]:
    """Vocabulary words of which every paragraph has one that is not "none".

    Words are left out, the most common first, as long as all n-grams of left-out words together, each
    counted where it helps a family against "none", keep every family below "none". Empty if even no
    n-gram at all is not "none", as it is without ordinary paragraphs to learn from.
    """
    words = {g for g in weights if " " not in g}
    ahead = [b - intercepts[none] for i, b in enumerate(intercepts) if i != none]
    if max(ahead) >= 0:
        return []
    helps = {g: [max(0.0, x - w[none]) for i, x in enumerate(w) if i != none] for g, w in weights.items()}
    left_out: set[str] = set()
    for word in common:
        more = [g for g in weights if word in g.split() and left_out.issuperset(set(g.split()) - {word})]
        tried = [a + sum(helps[g][i] for g in more) for i, a in enumerate(ahead)]
        if max(tried) < -1e-6:
            ahead = tried
            left_out.add(word)
    return sorted(words - left_out)


@dataclass(frozen=True)
class Classifier:
    labels: list[str]
    #: Per n-gram, what it adds to the score of each label.
    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float
    #: Every paragraph that is not "none" has one of these words; if empty, NOTICE decides what is scored.
    telling: list[str]

    @property
    def gate(self) -> str:
        """Finds paragraphs with a telling word, also where it is a part of a longer word."""
        if not self.telling:
            return NOTICE
        return r"(?i)(?<![a-z0-9])(?:" + "|".join(map(re.escape, self.telling)) + r")(?![a-z0-9])"


def train(docs: DataFrame) -> Classifier:
    """Learn from the notices and from a sample of `docs`: paragraphs of smallest hash in documents of smallest hash."""
    spark = docs.sparkSession
    sampled = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    sampled = sampled.orderBy(F.xxhash64(F.col("doc_id").cast("string")), F.xxhash64("text")).limit(MOST_ORDINARY)
    lines = sampled.select(F.explode(F.split("text", "\n")).alias("line")).where(~F.col("line").rlike(NOTICE)).distinct()
    ordinary = lines.orderBy(F.xxhash64("line"), "line").limit(MOST_ORDINARY)
    ordinary = ordinary.select(F.lit(NONE).alias("label"), words_of(F.col("line")).alias("words"), F.lit(False).alias("held"))
    labels = [*TEMPLATES, UNKNOWN, NONE]
    number = F.array_position(F.array(*map(F.lit, labels)), F.col("label")) - 1
    vocabulary = sorted({g for texts in [*TEMPLATES.values(), UNKNOWN_NOTICES] for t in texts for g in _plain_ngrams(t)})
    counter = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="ngrams", outputCol="features", minTF=1.0)
    # one line of the notices without any of their words keeps the label "none" known to an empty table
    empty = spark.createDataFrame([(NONE, ["nothing"], False)], "label string, words array<string>, held boolean")
    rows = _variants(spark).unionByName(ordinary).unionByName(empty)
    rows = counter.transform(rows.withColumn("ngrams", ngrams_of(F.col("words")))).withColumn("number", number.cast("double"))
    rows = rows.coalesce(1).cache()
    weighted = rows.withColumn("weight", F.when(F.col("label") == NONE, 0.2).otherwise(1.0))
    regression = LogisticRegression(
        labelCol="number", featuresCol="features", weightCol="weight", family="multinomial", regParam=0.002, standardization=False, maxIter=60
    )
    model = regression.fit(weighted.where(~F.col("held")))
    matrix = model.coefficientMatrix.toArray()
    raw = vector_to_array("rawPrediction")
    own = F.element_at(raw, F.col("number").cast("int") + 1)
    loss = [
        F.avg(F.log(F.aggregate(raw, F.lit(0.0), lambda s, x: s + F.exp((x - own) / t)))).alias(str(i))
        for i, t in enumerate(map(F.lit, TEMPERATURES))
    ]
    losses = model.transform(rows.where("held")).agg(*loss).first()
    rows.unpersist()
    best = min(range(len(TEMPERATURES)), key=lambda i: losses[i])
    weights = {g: [float(x) for x in matrix[:, i]] for i, g in enumerate(vocabulary)}
    intercepts = [float(x) for x in model.interceptVector.toArray()]
    seen = ordinary.select(F.explode(F.array_distinct("words")).alias("word")).where(F.col("word").isin([g for g in vocabulary if " " not in g]))
    common = [r.word for r in seen.groupBy("word").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "word").collect()]
    telling = telling_words(weights, intercepts, labels.index(NONE), common)
    return Classifier(labels, weights, intercepts, TEMPERATURES[best], telling)


def _constant(value, schema: str) -> Column:
    return F.from_json(F.lit(json.dumps(value)), schema)


def scan(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """`docs` with `notices`: an array of (paragraph, family, probability, similarity, confirmed).

    Paragraphs are lines, counted from 0; those that are none are left out. similarity is the largest
    share of n-grams in common with a template of the family, of the union or of the template. Null and
    empty texts have no notices. Rows and other columns are kept; a column `notices` is replaced.
    """
    labels = F.array(*map(F.lit, classifier.labels))
    weights = _constant(classifier.weights, "map<string,array<double>>")
    intercepts = F.array(*map(F.lit, classifier.intercepts))
    grams = {f: [_plain_ngrams(t) for t in texts] for f, texts in TEMPLATES.items()}
    templates = _constant(grams, "map<string,array<array<string>>>")

    def scored(line: Column) -> Column:
        def add(total: Column, gram: Column) -> Column:
            more = F.try_element_at(weights, gram)
            return F.when(more.isNull(), total).otherwise(F.zip_with(total, more, lambda a, b: a + b))

        def summed(ngrams: Column) -> Column:
            return F.struct(line.at.alias("at"), ngrams.alias("ngrams"), F.aggregate(ngrams, intercepts, add).alias("raw"))

        return _bound(ngrams_of(words_of(line.text)), summed)

    def judged(line: Column) -> Column:
        top = F.array_max(line.raw)
        heat = classifier.temperature
        whole = F.aggregate(line.raw, F.lit(0.0), lambda s, x: s + F.exp((x - top) / heat))
        label = F.element_at(labels, F.array_position(line.raw, top).cast("int"))
        sure = (1 / whole >= LEAST_PROBABILITY) | (label == NONE)
        family = F.when(sure, label).otherwise(UNKNOWN)

        def alike(template: Column) -> Column:
            shared = F.size(F.array_intersect(line.ngrams, template))
            union = F.size(line.ngrams) + F.size(template) - shared
            return F.greatest(shared / union, F.when(shared >= 0.8 * F.size(template), shared / F.size(template)).otherwise(0.0))

        options = F.coalesce(F.try_element_at(templates, family), F.expr("cast(array() as array<array<string>>)"))
        similarity = F.coalesce(F.array_max(F.transform(options, alike)), F.lit(0.0))
        return F.struct(
            line.at.alias("paragraph"), family.alias("family"), F.round(1 / whole, 6).alias("probability"),
            F.round(similarity, 6).alias("similarity"), (similarity >= LEAST_SIMILARITY).alias("confirmed"),
        )

    lines = F.transform(F.split("text", "\n"), lambda line, i: F.struct(i.alias("at"), line.alias("text")))
    passed = F.filter(lines, lambda line: line.text.rlike(classifier.gate))
    found = F.filter(F.transform(F.transform(passed, scored), judged), lambda n: n.family != NONE)
    none = F.expr("cast(array() as array<struct<paragraph:int,family:string,probability:double,similarity:double,confirmed:boolean>>)")
    return docs.withColumn("notices", F.when(F.col("text").rlike(classifier.gate), found).otherwise(none))


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: its families, how many notices are confirmed and how many name no known family."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = scan(docs, train(docs))
    families = F.array_sort(F.array_distinct(F.transform(F.filter("notices", lambda n: n.confirmed), lambda n: n.family)))
    count = lambda keep: F.size(F.filter("notices", keep)).cast("long")
    return found.select(
        "doc_id",
        F.array_join(families, ",").alias("families"),
        count(lambda n: n.confirmed).alias("n_confirmed"),
        count(lambda n: n.family == UNKNOWN).alias("n_unknown"),
        F.size("notices").cast("long").alias("n_notices"),
    )
