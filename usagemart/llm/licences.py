"""Licence scan: a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are single lines, and blocks of lines up to a blank one: comment marks at the lines' ends are removed and
wrapped lines joined. A block counts where it is confirmed and its lines alone are not: lines of it that are merely
unknown then are part of it. Of other blocks the lines count. Sparse logistic regression over words and word pairs tells licence families, other
licence talk (``unknown``) and other text (``none``) apart; its features are those of the templates. It
learns from templates, whole, cut and inside prose, and from a sample of at most ``PROSE_ROWS`` paragraphs of the corpus. A temperature fitted to rows that
were held back calibrates the probabilities. A family needs a calibrated probability of ``SURE`` and a
template of which ``CONFIRMED`` of the word pairs stand in the paragraph; licence talk that fails either is
unknown. DataFrame operations only; Spark ML fits the regression, and expressions apply it.

Defined cases: very long lines and blocks are paragraphs like others; null or empty text has no paragraphs; lines without letters or digits are none; repeated
rows each get the same result; an empty table leaves only the templates to learn from. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from usagemart.llm.rows import by_row, row_key, stored, texts

PROSE_ROWS = 3_000
COMMON = 100  # a word or pair in more than one of so many paragraphs of prose tells nothing
SURE, CONFIRMED = 0.5, 0.6
TEMPERATURES = [0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0]

# Notices by which licences are applied, by family.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version 3.",
             "under the terms of the GNU Affero General Public License as published by the Free Software Foundation"],
    "apache": ["Licensed under the Apache License, Version 2.0.",
               "you may not use this file except in compliance with the License",
               "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
               "Unless required by applicable law or agreed to in writing, software distributed under the License is "
               "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met",
            "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
            "promote products derived from this software without specific prior written permission",
            "Released under the BSD 3-Clause License."],
    "cc-by": ["Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "cc-by-nc": ["Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "cc-by-sa": ["Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "gpl": ["This work is licensed under the GNU General Public License, version 3.",
            "you can redistribute it and/or modify it under the terms of the GNU General Public License as published "
            "by the Free Software Foundation"],
    "lgpl": ["This library is licensed under the GNU Lesser General Public License, version 2.1.",
             "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files, to deal in the Software without restriction"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."],
    "public-domain": ["This is free and unencumbered software released into the public domain.",
                      "Dedicated to the public domain under CC0 1.0 Universal."],
    "reserved": ["All rights reserved.",
                 "Copyright, all rights reserved. No part may be reproduced without permission."],
    "unknown": ["This software is licensed under the terms of a separate agreement.",
                "Released under the Community Source License, version 1.1.", "Licensed under a custom licence.",
                "See the LICENSE file for the terms of use.", "The licence of this work is given in the file COPYING.",
                "Licensed under the Open Data Terms 2.0.", "This work is licensed under the following terms.",
                "Permission to copy and distribute this work is granted under the licence below."],
}
NONE = "none"
# Every notice has one of these; blocks without them need no look.
TELLING = r"(?i)licen[sc]|copyright|permission|permitted|warrant|redistribut|rights reserved|public domain"
# Marks of comments at the beginning and the end of a line.
MARKS = r"(?m)^[\x20\t]*(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|<!--+|\(\*|\"{3}|'{3}|dnl |rem )?[\x20\t]*|[\x20\t\r]*(?:\*+/|--+>|\*\))?[\x20\t\r]*$"
# Paragraphs with one of these are not taken as examples of plain prose.
LICENCE_TALK = ["license", "licensed", "licence", "licences", "rights", "copyright", "permission"]
LABELS = [*TEMPLATES, NONE]


@dataclass
class Model:
    """Weights of each label for each word or pair of the vocabulary, and for all texts."""

    weights: dict[str, list[float]]
    intercepts: list[float]
    temperature: float = 1.0


def terms(text: str | Column) -> Column:
    """Words of letters and digits, in lower case."""
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def pairs(words: str) -> Column:
    listed = F.col(words)
    return F.transform(F.slice(listed, F.lit(1), F.greatest(F.size(listed) - 1, F.lit(0))),
                       lambda word, i: F.concat_ws(" ", word, F.get(listed, i + 1)))


def grams(words: str = "words") -> Column:
    return F.concat(F.col(words), pairs(words))


def paragraphs(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, at, words) of every line that has a word."""
    return (texts(documents).select("doc_id", row_key(), F.posexplode(F.split("text", "\n")).alias("at", "line"))
            .where(F.col("line").rlike(r"[\p{L}\p{N}]")).withColumn("words", terms("line")).drop("line"))


def blocks(documents: DataFrame) -> DataFrame:
    """(doc_id, text_key, at, last, words) of the blocks of two lines or more that may hold a notice; ``at`` and ``last`` are
    their first and last lines."""
    bare = texts(documents).where(F.col("text").rlike(TELLING)).select(
        "doc_id", row_key(), F.split(F.regexp_replace("text", MARKS, ""), "\n").alias("lines"))
    none = F.array().cast("array<struct<at:int,last:int>>")

    def step(a: Column, x: Column) -> Column:
        blank = ~x["line"].rlike(r"[\p{L}\p{N}]")
        closed = F.when(a["at"] + 1 < x["i"], F.concat(a["found"], F.array(
            F.struct(a["at"].alias("at"), (x["i"] - 1).alias("last"))))).otherwise(a["found"])
        return F.struct(F.when(blank, x["i"] + 1).otherwise(a["at"]).alias("at"),
                        F.when(blank, closed).otherwise(a["found"]).cast("array<struct<at:int,last:int>>").alias("found"))

    # A blank line more, so that the last block ends.
    listed = F.transform(F.concat("lines", F.array(F.lit(""))), lambda line, i: F.struct(line.alias("line"), i.alias("i")))
    placed = F.aggregate(listed, F.struct(F.lit(0).alias("at"), none.alias("found")), step, lambda a: a["found"])
    found = bare.withColumn("block", F.explode(placed)).select(
        "doc_id", "text_key", F.col("block.at").alias("at"), F.col("block.last").alias("last"),
        F.array_join(F.slice("lines", F.col("block.at") + 1, F.col("block.last") - F.col("block.at") + 1), " ").alias("text"))
    return found.where(F.col("text").rlike(TELLING)).select("doc_id", "text_key", "at", "last", terms("text").alias("words"))


def templates(spark: SparkSession) -> DataFrame:
    """(label, words) of every template."""
    listed = F.array(*(F.struct(F.lit(LABELS.index(family)).cast("double").alias("label"), F.lit(text).alias("text"))
                       for family, found in TEMPLATES.items() for text in found))
    return spark.range(1).select(F.inline(listed)).select("label", terms("text").alias("words"))


def training_rows(documents: DataFrame, prose_rows: int = PROSE_ROWS) -> DataFrame:
    """(label, words, held): templates in several forms, and prose."""
    spark = documents.sparkSession
    lines = paragraphs(documents).where(~F.arrays_overlap("words", F.array(*map(F.lit, LICENCE_TALK))))
    # A paragraph that is copied counts once: the least distinct hashes say how far the sample goes.
    lines = lines.select("words", F.xxhash64("words").alias("mark"))
    last = lines.select("mark").distinct().orderBy("mark").limit(prose_rows).agg(F.max("mark")).first()[0]
    once = lines.where(F.col("mark") <= F.lit(last)).groupBy("mark").agg(F.min("words").alias("words"))
    prose = stored(once, "prose")
    marked = prose.select("words", F.pmod("mark", F.lit(97)).alias("slot"))
    whole = templates(spark).withColumn("mark", F.xxhash64("words"))
    size = F.size("words")
    forms = [F.col("words"), F.slice("words", F.lit(1), F.greatest(F.ceil(size * 0.8).cast("int"), F.lit(2))),
             F.slice("words", F.floor(size * 0.2).cast("int") + 1, size)]
    cut = whole.select("label", F.inline(F.array(*(
        F.struct(words.alias("words"), F.lit(i).alias("form")) for i, words in enumerate(forms)))))
    cut = cut.withColumn("slot", F.pmod(F.xxhash64("words"), F.lit(97)))
    inside = (cut.where("form = 0").withColumnRenamed("words", "notice")
              .join(marked, "slot").select("label", F.concat(F.slice("words", 1, 20), "notice").alias("words")))
    plain = prose.select(F.lit(float(LABELS.index(NONE))).alias("label"), "words")
    rows = cut.select("label", "words").unionByName(inside).unionByName(plain)
    return rows.withColumn("held", F.pmod(F.xxhash64("words", "label"), F.lit(10)) < 3)


def _log_loss(temperature: float) -> Column:
    """Mean negative log likelihood at a temperature, from the column ``raw`` of scores."""
    scaled = F.transform("raw", lambda x: x / temperature)
    top = F.array_max(scaled)
    total = F.aggregate(scaled, F.lit(0.0), lambda a, x: a + F.exp(x - top))
    return F.avg(top + F.log(total) - F.element_at(scaled, F.col("label").cast("int") + 1))


def vocabulary(spark: SparkSession, rows: DataFrame) -> list[str]:
    """Words and pairs of the templates (a fixed number), but for those that much prose holds, like "of"."""
    listed = templates(spark).select(F.explode(grams()).alias("gram")).distinct()
    prose = rows.where(F.col("label") == LABELS.index(NONE))
    usual = (prose.select(F.explode(F.array_distinct(grams())).alias("gram")).groupBy("gram").count()
             .where(F.col("count") * COMMON > F.lit(max(prose.count(), 1))))
    kept = [row.gram for row in listed.join(usual, "gram", "left_anti").orderBy("gram").collect()]
    telling = {gram for gram in kept if " " not in gram}
    return [gram for gram in kept if telling.intersection(gram.split())]


def learn(documents: DataFrame, prose_rows: int = PROSE_ROWS) -> Model:
    rows = stored(training_rows(documents, prose_rows), "training")
    listed = vocabulary(documents.sparkSession, rows)
    counted = CountVectorizerModel.from_vocabulary(listed, inputCol="grams", outputCol="features")
    counted.setBinary(True)
    vectors = counted.transform(rows.withColumn("grams", grams())).select("label", "features", "held")
    vectors = stored(vectors, "vectors")
    fitted = LogisticRegression(family="multinomial", regParam=0.002, maxIter=60).fit(vectors.where("NOT held"))
    matrix = fitted.coefficientMatrix.toArray()
    known = len(fitted.interceptVector)
    model = Model({gram: [float(matrix[c, i]) for c in range(known)] for i, gram in enumerate(listed)},
                  [float(x) for x in fitted.interceptVector])
    held = fitted.transform(vectors.where("held")).where(F.col("label") < known).select(
        "label", vector_to_array("rawPrediction").alias("raw"))
    losses = held.agg(*(_log_loss(t).alias(str(i)) for i, t in enumerate(TEMPERATURES))).first()
    tried = [(loss, t) for loss, t in zip(losses, TEMPERATURES) if loss is not None]
    model.temperature = min(tried)[1] if tried else 1.0
    return model


def scan(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, text_key, at, last, family, probability, match, confirmed) of the lines that are not plain text."""
    lines = paragraphs(documents).withColumn("last", F.col("at"))
    return _judged(lines, model)


def found(documents: DataFrame, model: Model) -> DataFrame:
    """The lines of ``scan`` and the blocks that count, once for repeated rows of an id and a text."""
    both = scan(documents, model).unionByName(_judged(blocks(documents), model).where("confirmed"))
    row = F.struct("at", "last", "family", "confirmed")
    gathered = both.groupBy("doc_id", "text_key").agg(F.collect_set(row).alias("all"))

    def within(x: Column, y: Column) -> Column:
        return (y["at"] <= x["at"]) & (x["last"] <= y["last"])

    lines = F.filter("all", lambda x: x["at"] == x["last"])
    wrapped = F.filter("all", lambda b: (b["at"] < b["last"]) & ~F.exists(
        "lines", lambda x: within(x, b) & x["confirmed"] & (x["family"] == b["family"])))
    kept = F.filter("lines", lambda x: x["confirmed"] | ~F.exists("wrapped", lambda b: within(x, b)))
    return (gathered.withColumn("lines", lines).withColumn("wrapped", wrapped)
            .select("doc_id", "text_key", F.inline(F.concat(kept, "wrapped"))))


def _judged(rows: DataFrame, model: Model) -> DataFrame:
    """Of paragraphs (doc_id, text_key, at, last, words), those that are not plain text.

    The weights are a literal map of fixed size. Hits are exploded as an outer column, since Spark would
    push a filter on them below and compute them twice.
    """
    spark = rows.sparkSession
    listed = F.array(*map(F.lit, model.weights))
    table = F.create_map(*(x for gram, found in model.weights.items()
                           for x in (F.lit(gram), F.array(*map(F.lit, found)))))
    hits = F.array_intersect(grams(), listed)
    rows = (rows.select("doc_id", "text_key", "at", "last", "words", F.explode_outer(
                F.array(F.when(F.arrays_overlap("words", listed), hits))).alias("hits"))
            .where("hits IS NOT NULL"))
    raw = F.aggregate("hits", F.array(*map(F.lit, model.intercepts)),
                      lambda a, gram: F.zip_with(a, table[gram], lambda x, y: x + y),
                      lambda a: F.transform(a, lambda x: x / model.temperature))
    scored = rows.select("doc_id", "text_key", "at", "last", "words", F.explode_outer(F.array(raw)).alias("raw"))
    names = F.array(*map(F.lit, LABELS))
    top = F.array_max("raw")
    guess = F.element_at(names, F.array_position("raw", top).cast("int"))
    chance = 1 / F.aggregate("raw", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    found = scored.where(guess != NONE).select(
        "doc_id", "text_key", "at", "last", guess.alias("guess"), chance.alias("probability"),
        F.array_distinct(pairs("words")).alias("own"))
    known = [(LABELS[int(row.label)], row.pairs) for row in templates(spark).select(
        "label", F.array_distinct(pairs("words")).alias("pairs")).collect()]
    literal = F.array(*(F.struct(F.lit(family).alias("family"), F.array(*map(F.lit, listed)).alias("pairs"))
                        for family, listed in known if family != "unknown"))
    match = F.array_max(F.transform(
        F.filter(literal, lambda t: t["family"] == F.col("guess")),
        lambda t: F.size(F.array_intersect(t["pairs"], F.col("own"))) / F.size(t["pairs"])))
    found = found.withColumn("match", F.coalesce(match, F.lit(0.0)))
    sure = (F.col("probability") >= SURE) & (F.col("match") >= CONFIRMED)
    family = F.when(sure, F.col("guess")).otherwise(F.lit("unknown"))
    return found.select("doc_id", "text_key", "at", "last", family.alias("family"), "probability", "match",
                        sure.alias("confirmed"))


def digest(found: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_paragraphs, n_unknown, families) of each text with a licence paragraph."""
    return found.groupBy("doc_id", "text_key").agg(
        F.count_distinct("at", "last").alias("n_paragraphs"),
        F.count_distinct(F.when(F.col("family") == "unknown", F.col("at"))).alias("n_unknown"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"))


def by_document(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, n_paragraphs, n_unknown, families) of every row; ``families`` confirmed, sorted, joined by commas."""
    rows = texts(documents).select("doc_id", row_key())
    joined = by_row(rows, stored(digest(found(documents, model)), "licences"))
    counts = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in ("n_paragraphs", "n_unknown")]
    return joined.select("doc_id", *counts, F.coalesce("families", F.lit("")).alias("families"))
