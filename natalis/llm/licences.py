"""Licence scans: a paragraph classifier confirmed by templates.

A multinomial logistic regression over hashed word n-grams (one and two words) tells the licence families
and "none" apart. Its n-grams are those of the templates, and words that name licences. It learns from the templates below (whole and
in part) and from every line of the corpus that has less than half of any template's words; lines with the same of these n-grams are one
example that weighs as many as they are, so that what the regression passes over is small; a family weighs as much as all of them. A paragraph is believed to state a licence
if the probability of all families together reaches the least one, which is calibrated on the same lines: the 99.9th percentile of what
families get there, at least 0.5. A believed paragraph is compared with the templates of every family that has a share of that
probability: a family is confirmed if ``LIKE`` of a template's words, and of those of them that no other family has, stand in
the paragraph, and as many in the template's order (a longest common subsequence) within twice its length.
What is believed and not confirmed for any family is ``unknown``.

A paragraph is a run of non-blank lines. Each of its lines is scored by itself, so that a statement of one line is found in any
paragraph; statements wrapped over lines are looked for in the joined lines, in windows of ``WINDOWS`` words at steps of an
eighth. Texts, lines and windows are scored that have one of a few words: those of which every text with ``LIKE`` of a
template has one, or one that names licences (``CUES``).

Only DataFrame operations and Spark's own ML transformers; every line of every text is looked at.

Defined results: a null or empty text has no paragraphs and no licence; a paragraph gives its stating lines, one row for each
confirmed family of a line, and once for each family what is only confirmed across lines (its place is the paragraph's first line, its text
the stating words), which its unknown lines then belong to; equal paragraphs agree; rows of equal id are one document, rows without
an id another; an empty table gives no rows. Only id and text are read.
"""

from __future__ import annotations

import functools
import re

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from natalis.llm.base import cut, table

FEATURES = 1 << 14
#: The share of a template's words that a confirmed statement has, in order too.
LIKE = 0.8
#: The probability from which a family is compared with its templates.
LIKELY_FAMILY = 0.02
#: Partitions of the examples that the regression passes over again and again, at least; examples of a partition beyond that.
FITTED_PARTS, FITTED_ROWS = 4, 50_000
#: Steps in which the least probability is found.
STEPS = 10_000
GAPS = r"[^\p{L}\p{N}.+-]+"
#: Words of windows over joined lines, by which every template lies in a window of not many more words.
WINDOWS = (4, 8, 16, 24)
NONE, UNKNOWN = "none", "unknown"
#: Sentences by which texts state their licence, by family.
TEMPLATES = {
    "mit": ["SPDX-License-Identifier: MIT", "Released under the MIT License.", "Licensed under the MIT License.", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."],
    "apache-2.0": ["SPDX-License-Identifier: Apache-2.0", "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License."],
    "gpl": ["SPDX-License-Identifier: GPL-3.0-or-later", "This work is licensed under the GNU General Public License, version 3.", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."],
    "bsd": ["SPDX-License-Identifier: BSD-3-Clause", "Licensed under the BSD 3-Clause License.", "Redistribution and use in source and binary forms, with or without modification, are permitted."],
    "cc-by": ["SPDX-License-Identifier: CC-BY-4.0", "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["SPDX-License-Identifier: CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "proprietary": ["All rights reserved.", "Copyright. All rights reserved. No part of this work may be reproduced without permission."],
}
CUES = r"(?i)\b(licen[sc]e[ds]?|copyright|all rights reserved|spdx)\b"
#: Words that name licences: the classifier knows them beside those of the templates.
NAMING = ("license", "licence", "licensed", "licenced", "licenses", "licences", "copyright", "spdx")
#: Parts of lower-cased texts of which any text with a cue has one.
CUE_PARTS = ("licen", "copyright", "all rights reserved", "spdx")


def terms(text: Column) -> Column:
    """The lower-cased words of a paragraph."""
    return F.filter(F.transform(F.split(F.lower(text), GAPS), lambda w: F.rtrim(w, F.lit(".-+"))), lambda w: w != "")


def with_grams(rows: DataFrame, templates: Templates) -> DataFrame:
    """The rows with ``words`` and ``grams``.

    Words pass through a generator, as the optimizer would else split the text anew for every use of them.
    """
    return paired(rows.select("*", F.explode(F.array(terms(F.col("text")))).alias("words")), templates)


def paired(rows: DataFrame, templates: Templates) -> DataFrame:
    """The rows (words, ...) with ``grams``: the words, and pairs of consecutive words, that the classifier knows."""
    firsts, seconds = (sorted({g.split(" ")[k] for g in templates.pairs}) for k in (0, 1))
    both = F.filter(F.sequence(F.lit(0), F.size("words") - 2), lambda k: F.get("words", k).isin(firsts) & F.get("words", k + 1).isin(seconds))
    pairs = F.when(F.size("words") > 1, F.transform(both, lambda k: F.concat_ws(" ", F.slice("words", k + 1, 2))))
    pairs = F.filter(F.coalesce(pairs, F.array().cast("array<string>")), lambda g: g.isin(templates.pairs))
    return rows.withColumn("grams", F.concat(F.filter("words", lambda w: w.isin(templates.known)), pairs))


def paragraphs(docs: DataFrame, id_: str, text: str) -> DataFrame:
    """(id, place, text) of the non-blank lines of every text."""
    rows = docs.select(F.col(id_).alias("id"), F.posexplode(F.split(F.col(text), "\n")).alias("place", "text"))
    return rows.where(F.trim("text") != "")


class Templates:
    """The templates as rows (family, text, words, own); own words occur in no other family's templates."""

    def __init__(self, spark: SparkSession):
        rows = [(family, text) for family, texts in TEMPLATES.items() for text in texts]
        self.table = spark.createDataFrame(rows, "family string, text string").coalesce(1)
        found = self.table.withColumn("words", terms(F.col("text"))).collect()  # the templates above, not data
        families: dict[str, set[str]] = {}
        for r in found:
            for w in r.words:
                families.setdefault(w, set()).add(r.family)
        own = [sorted({w for w in r.words if len(families[w]) == 1}) for r in found]
        self.known = sorted({*families, *NAMING})
        self.pairs = sorted({" ".join(p) for r in found for p in zip(r.words, r.words[1:], strict=False)})
        self.rows = [(r.family, list(r.words), o or sorted(set(r.words))) for r, o in zip(found, own, strict=True)]

    def anchors(self) -> list[str]:
        """Words of which every text with ``LIKE`` of some template's words, and of its own words, has one.

        For each template as many as may be missing and one more: the longest of its own words, or where these are short
        the most telling of all its words.
        """

        def some(words: list[str]) -> list[str]:
            return sorted(set(words), key=lambda w: (not re.search(CUES + r"|\d\.\d", w), -len(w), w))[: len(set(words)) // 5 + 1]

        return sorted({w for _, words, own in self.rows for w in (some(own) if min(map(len, own)) > 4 else some(words))})

    def nearest(self, words: Column) -> Column:
        """The largest share of any template's words that the words have."""
        return F.greatest(*[_likeness(words, literal(sorted(set(t)))) for _, t, _ in self.rows])

    def confirms(self, family: str, words: Column) -> Column:
        """Whether one of the family's templates stands in the words."""

        def one(template: list[str], own: list[str]) -> Column:
            there = (_likeness(words, literal(sorted(set(template)))) >= LIKE) & (_likeness(words, literal(own)) >= LIKE)
            # the order is only looked at where the words are there
            return F.when(there, in_order(words, template)).otherwise(F.lit(False))

        return functools.reduce(Column.__or__, [one(t, o) for f, t, o in self.rows if f == family])


def literal(words: list[str]) -> Column:
    return F.array(*map(F.lit, words))


def in_order(words: Column, template: list[str]) -> Column:
    """Whether some run of twice the template's length has ``LIKE`` of its words in its order; runs start at a word of the template."""
    n, least, asked = len(template), -(-len(template) * LIKE // 1), literal(template)

    def common(run: Column) -> Column:
        # row by row: the longest common subsequence of the template so far and each beginning of the run
        def row(before: Column, word: Column) -> Column:
            step = lambda now, k: F.concat(now, F.array(F.when(F.element_at(run, k) == word, F.element_at(before, k) + 1).otherwise(F.greatest(F.element_at(before, k + 1), F.element_at(now, F.lit(-1))))))
            return F.aggregate(F.sequence(F.lit(1), F.size(run)), F.array(F.lit(0)), step)

        return F.element_at(F.aggregate(asked, F.array_repeat(F.lit(0), F.size(run) + 1), row), F.lit(-1))

    starts = F.filter(F.sequence(F.lit(1), F.size(words)), lambda k: F.array_contains(asked, F.element_at(words, k)))
    distinct = literal(sorted(set(template)))
    return F.exists(starts, lambda k: F.when(_likeness(F.slice(words, k, 2 * n), distinct) >= LIKE, common(F.slice(words, k, 2 * n)) >= least).otherwise(F.lit(False)))


def _having(rows: DataFrame, known: list[str]) -> DataFrame:
    """The rows whose text has one of the words; it is lower-cased once, behind a generator."""
    parts = [w for w in known if not any(o != w and o in w for o in known)]
    any_ = functools.reduce(Column.__or__, [F.contains("low", F.lit(w)) for w in parts])
    return rows.select("*", F.explode(F.array(F.lower("text"))).alias("low")).where(any_).drop("low")


def windows(docs: DataFrame, id_: str, text: str, templates: Templates) -> DataFrame:
    """(id, place, lines, words, text): windows with most of a template's words in paragraphs of several lines, with the paragraph's first line and number of lines."""
    known = templates.anchors()
    rows = docs.select(F.col(id_).alias("id"), F.col(text).alias("text")).where(F.contains("text", F.lit("\n")))
    rows = _having(rows, known).select("id", F.explode(F.array(F.split("text", "\n"))).alias("all"))
    rows = rows.select("id", "all", F.explode(F.array(F.transform("all", lambda x: ~x.rlike(r"\S")))).alias("blank"))
    starts = F.expr("filter(sequence(0, size(all) - 1), i -> not blank[i] and (i = 0 or blank[i - 1]))")
    ends = F.expr("filter(sequence(0, size(all) - 1), i -> not blank[i] and (i = size(all) - 1 or blank[i + 1]))")
    rows = rows.select("id", "all", F.explode(F.array(F.arrays_zip(starts.alias("a"), ends.alias("b")))).alias("spans"))
    joined = F.expr("transform(filter(spans, s -> s.b > s.a), s -> struct(s.a as place, s.b - s.a + 1 as lines, array_join(slice(all, s.a + 1, s.b - s.a + 1), ' ') as text))")
    rows = _having(rows.select("id", F.inline(joined)), known).select("*", F.explode(F.array(terms(F.col("text")))).alias("every"))
    # only windows around an anchor: their starts are counted back from it
    spots = F.filter(F.sequence(F.lit(0), F.size("every") - 1), lambda k: F.get("every", k).isin(known))
    rows = rows.select("*", F.explode(F.array(spots)).alias("spots"))
    starts = [f"transform(array_distinct(flatten(transform(spots, k -> sequence(greatest(0, k - {n - 1}) div {n // 8 or 1}, k div {n // 8 or 1})))), k -> struct(k * {n // 8 or 1} as a, {n} as n))" for n in WINDOWS]
    rows = rows.select("id", "place", "lines", F.explode(F.expr(f"transform(concat({', '.join(starts)}), w -> slice(every, w.a + 1, w.n))")).alias("words"))
    return rows.where(templates.nearest(F.col("words")) >= LIKE).withColumn("text", F.concat_ws(" ", "words"))


def _likeness(words: Column, template: Column) -> Column:
    """The share of a template's distinct words that the paragraph has."""
    return F.size(F.array_intersect(template, words)) / F.size(template)


class Classifier:
    """A fitted classifier of paragraphs with its calibrated probability."""

    def __init__(self, model, families: list[str], templates: Templates, least: float):
        self.model, self.families, self.templates, self.least = model, families, templates, least

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """The rows (grams, ...) with ``p``, the probabilities of the families in order, and ``probability``, that of all of them."""
        scored = self.model.transform(_hashed(rows)).withColumn("p", F.slice(vector_to_array("probability"), 1, len(self.families)))
        scored = scored.drop("features", "rawPrediction", "probability", "prediction")
        return scored.withColumn("probability", F.aggregate("p", F.lit(0.0), lambda a, x: a + x))

    def judged(self, rows: DataFrame) -> DataFrame:
        """The rows (text, words, grams, ...) that are believed, with ``families``: those confirmed, each with its probability."""
        found = self.probabilities(rows).where(F.col("probability") >= self.least)
        tests = [F.when((F.get("p", F.lit(k)) >= LIKELY_FAMILY) & self.templates.confirms(f, F.col("words")), F.struct(F.lit(f).alias("family"), F.get("p", F.lit(k)).alias("probability"))) for k, f in enumerate(self.families)]
        return found.withColumn("families", F.array_compact(F.array(*tests)))


def _hashed(rows: DataFrame) -> DataFrame:
    return HashingTF(inputCol="grams", outputCol="features", numFeatures=FEATURES, binary=True).transform(rows)


def train(lines: DataFrame) -> Classifier:
    """Fits on templates and all lines; lines are (id, place, text)."""
    templates, families = Templates(lines.sparkSession), list(TEMPLATES)
    grams = F.array_sort(F.array_distinct("grams"))
    # what lines have of the templates is in their n-grams: lines with the same ones are one example
    plain = with_grams(lines.select("text"), templates).groupBy(grams.alias("grams")).agg(F.count("*").cast("double").alias("weight"))
    plain = cut(plain.where(templates.nearest(F.col("grams")) < 0.5))
    examples, total = plain.agg(F.count("*"), F.coalesce(F.sum("weight"), F.lit(0.0))).first()
    parts = max(FITTED_PARTS, -(-examples // FITTED_ROWS))
    plain = plain.coalesce(parts)
    # whole templates, and each without its last or first third, as texts quote them in part
    whole = with_grams(templates.table, templates)
    thirds = F.array("grams", F.expr("slice(grams, 1, greatest(3, size(grams) * 2 div 3))"), F.expr("slice(grams, greatest(1, size(grams) div 3), size(grams))"))
    label = F.array_position(literal(families), F.col("family")) - 1
    # every family weighs as much as all plain lines
    weight = F.get(F.array(*[F.lit(max(1.0, total / (3 * len(TEMPLATES[f])))) for f in families]), label.cast("int"))
    positive = whole.select(label.cast("double").alias("label"), F.explode(thirds).alias("grams"), weight.alias("weight"))
    negative = plain.select(F.lit(float(len(families))).alias("label"), "grams", "weight")
    fit = LogisticRegression(family="multinomial", weightCol="weight", regParam=0.002, maxIter=40, aggregationDepth=2)
    model = fit.fit(_hashed(cut(positive.union(negative).coalesce(parts))))
    fitted = Classifier(model, families, templates, 0.5)
    if model.numClasses <= len(families):  # no line to learn "none" from
        return fitted
    # as many rows as steps, however many lines
    reached = fitted.probabilities(plain).groupBy(F.ceil(F.col("probability") * STEPS).alias("step")).agg(F.sum("weight").alias("weight")).collect()
    left = total
    for step, weight in sorted(reached, reverse=True):
        left -= weight
        if left < 0.999 * total:
            break
    fitted.least = max(0.5, min(0.95, step / STEPS))
    return fitted


def scan(docs: DataFrame, id_: str = "doc_id", text: str = "text", classifier: Classifier | None = None) -> DataFrame:
    """(id, place, text, family, probability, confirmed): the paragraphs that state a licence; unconfirmed ones are ``unknown``."""
    classifier = classifier or train(paragraphs(docs, id_, text))
    # nothing without such a word is believed or confirmed: the texts are read once for it, then their lines
    telling = [*classifier.templates.anchors(), *CUE_PARTS]
    named = _having(docs.select(F.col(id_).alias("id"), F.col(text).alias("text")), telling)
    lines = _having(paragraphs(named, "id", "text"), telling)
    none = F.array(F.struct(F.lit(UNKNOWN).alias("family"), F.col("probability").alias("probability")))
    stated = F.inline(F.when(F.size("families") > 0, F.col("families")).otherwise(none))
    stating = classifier.judged(with_grams(lines, classifier.templates)).select("id", "place", "text", "families", "probability").select("id", "place", "text", stated)
    across = classifier.judged(paired(windows(named, "id", "text", classifier.templates), classifier.templates)).select("id", "place", "lines", "text", F.inline("families"))
    # a family's windows in a paragraph are one statement
    across = cut(across.groupBy("id", "place", "family").agg(F.max("lines").alias("lines"), F.max_by("text", F.struct("probability", "text")).alias("text"), F.max("probability").alias("probability"))).alias("p")
    inside = F.col("p.id").eqNullSafe(F.col("l.id")) & (F.col("l.place") >= F.col("p.place")) & (F.col("l.place") < F.col("p.place") + F.col("p.lines"))
    stating = cut(stating.withColumn("confirmed", F.col("family") != UNKNOWN)).alias("l")
    new = across.join(stating, inside & (F.col("p.family") == F.col("l.family")), "left_anti")
    left = stating.join(new, inside & ~F.col("l.confirmed"), "left_anti")
    return left.unionByName(new.select("id", "place", "text", "family", "probability", F.lit(True).alias("confirmed")))


def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document: of its most probable confirmed paragraph, ``unknown`` if none is confirmed, else
    ``none``; and all its confirmed licences.
    """
    docs = table(spark, sf_dir, "documents")
    best = F.max_by(F.struct("family", "probability", "place"), F.struct("confirmed", "probability", -F.col("place")))
    every = F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family"))))
    found = scan(docs).groupBy("id").agg(best.alias("best"), every.alias("licences"), F.count("*").alias("n"))
    out = docs.select("doc_id").join(found, F.col("doc_id").eqNullSafe(F.col("id")), "left")
    all_ = F.coalesce("licences", F.array().cast("array<string>"))
    return out.select("doc_id", F.coalesce("best.family", F.lit(NONE)).alias("licence"), F.col("best.probability").alias("probability"), F.col("best.place").alias("place"), F.coalesce("n", F.lit(0)).alias("n_paragraphs"), all_.alias("licences"))
