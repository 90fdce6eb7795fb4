"""License scans: logistic regression over word bigrams names a paragraph's licence family, and templates confirm it."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import Scratch, drawn, let, table

UNKNOWN = "unknown"
# Notices by which texts name their licence, by family. What is trained on is these and paragraphs of the corpus.
TEMPLATES = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
        "This project is released under the Apache 2.0 License",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "MIT": (
        "Released under the MIT License",
        "This project is licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "SPDX-License-Identifier: MIT",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Use of this source code is governed by a BSD-style license",
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD 2-Clause License",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GNU General Public License version 2",
        "You should have received a copy of the GNU General Public License along with this program",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "This library is licensed under the GNU Lesser General Public License",
        "under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3",
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: AGPL-3.0-only",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License, Version 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ),
    "CC-BY": (
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC-SA 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted",
        "Released under the ISC License",
        "SPDX-License-Identifier: ISC",
    ),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software",
        "SPDX-License-Identifier: Unlicense",
    ),
    "CC0": (
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "Dedicated to the public domain under CC0 1.0 Universal",
        "SPDX-License-Identifier: CC0-1.0",
    ),
}
#: Of so many documents at most, the first by a hash of id and text, paragraphs stand for the unknown class.
NEGATIVES = 4_000
CONTAINED = 0.6
LEAST_PROBABILITY = 0.5
#: Fifths of a template that are still a licence's, and that are not; the last two of either are held back from training.
LICENSED = ((1, 2, 3, 4), (0, 2, 3, 4), (0, 1, 3, 4), (0, 1, 2, 4), (0, 1, 2, 3))
UNLICENSED = ((0, 1), (2, 3), (1, 4), (3, 4), (0, 2))
GAP = r"[^\p{L}\p{N}]+"
WORD = r"[\p{L}\p{N}]+"
#: Lines of the windows by which a run of lines is scored, besides the whole run.
WINDOWS = (4, 12)
#: Ends the number in front of a line.
MARK = "\x01"


def _hashes(paragraph: Column) -> Column:
    return F.transform(F.filter(F.split(F.lower(paragraph), GAP), lambda w: w != ""), lambda w: F.xxhash64(w))


def _neighbours(h: Column) -> Column:
    return F.array_distinct(F.zip_with(h, F.slice(h, 2, F.greatest(F.size(h), F.lit(1))), lambda a, b: F.when(b.isNotNull(), F.xxhash64(a, b))))


def bigrams(paragraph: Column) -> Column:
    """Hashes of neighbouring words, each once; words are runs of letters and digits in any case."""
    return let(_hashes(paragraph), _neighbours)


def _line_bigrams(body: Column, after: Column) -> Column:
    """``(gram, over)``: a line's bigrams, and the one over its end."""
    end = lambda h: F.when(after != "", F.xxhash64(F.try_element_at(h, F.lit(-1)), F.xxhash64(after)))
    pair = lambda g, over: F.struct(g.alias("gram"), F.lit(over).alias("over"))
    return let(_hashes(body), lambda h: F.concat(F.transform(_neighbours(h), lambda g: pair(g, False)), F.array(pair(end(h), True))))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, paragraph, body)``: the lines of every whole text, numbered from 0."""
    lines = docs.where(F.col("text").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    return lines.select("row", "doc_id", F.posexplode(F.split("text", r"\r\n|\r|\n")).alias("paragraph", "body")).where(F.length("body") > 0)


def _runs(docs: DataFrame) -> DataFrame:
    """``(row, doc_id, run, at, body, after)``: lines with words, by runs of such lines.

    ``at`` is the line's number in its text, ``run`` that of the first line of its run, and ``after`` the first word of the run's next line. Lines
    get their number in front of them, so that a text can be cut at its lines without words and the pieces still tell where they were.
    """
    lines = docs.where(F.col("text").isNotNull()).select(F.monotonically_increasing_id().alias("row"), "doc_id", F.split("text", r"\r\n|\r|\n").alias("lines"))
    marked = F.array_join(F.transform("lines", lambda x, i: F.concat(F.lit("\n"), i.cast("string"), F.lit(MARK), x)), "")
    pieces = lines.select("row", "doc_id", F.explode(F.split(marked, rf"\n\d+{MARK}[^\p{{L}}\p{{N}}\n]*(?=\n|\z)")).alias("piece")).where(F.length("piece") > 0)
    cut = pieces.select("row", "doc_id", F.split(F.expr("substring(piece, 2)"), "\n").alias("numbered"))
    bare = lambda x: F.substring(x, F.instr(x, MARK) + 1, F.length(x))
    at = lambda x: F.substring_index(x, MARK, 1).cast("int")
    line = lambda x, i: F.struct(at(x).alias("at"), bare(x).alias("body"), F.lower(F.regexp_extract(bare(F.get("numbered", i + 1)), WORD, 0)).alias("after"))
    return cut.select("row", "doc_id", at(F.col("numbered")[0]).alias("run"), F.inline(F.transform("numbered", line)))


def templates(spark: SparkSession) -> DataFrame:
    """``(template, family, grams)``."""
    rows = [(family, t) for family, texts in TEMPLATES.items() for t in texts]
    out = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "template int, family string, body string")
    return out.select("template", "family", F.filter(bigrams(F.col("body")), lambda g: g.isNotNull()).alias("grams"))


def _known(grams: Column, vocabulary: list[int]) -> Column:
    return F.array_intersect(grams, F.array(*[F.lit(g) for g in vocabulary]))


class Model:
    """A weight for each bigram and family, the intercepts, and the line that turns log odds of any licence into calibrated ones."""

    def __init__(self, families: list[str], weights: list[tuple[int, list[float]]], intercepts: list[float], slope: float, shift: float):
        self.families, self.weights, self.intercepts, self.slope, self.shift = families, weights, intercepts, slope, shift

    def probabilities(self, scores: Column) -> Column:
        logits = F.zip_with(scores, F.array(*[F.lit(x) for x in self.intercepts]), lambda s, c: s + c)
        powers = let(logits, lambda z: F.transform(z, lambda x: F.exp(x - F.array_max(z))))
        return let(powers, lambda e: F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))

    def calibrated(self, unknown: Column) -> Column:
        """The probability that a paragraph is a licence's, from what the regression gives the unknown class."""
        return 1 / (1 + F.exp(-(log_odds(unknown) * self.slope + self.shift)))


def log_odds(unknown: Column) -> Column:
    """Log odds of any family against the unknown class, at most thirty either way."""
    return F.least(F.lit(30.0), F.greatest(F.lit(-30.0), F.log((1 - unknown + 1e-13) / (unknown + 1e-13))))


def _parts(grams: list[int], kept: tuple[int, ...]) -> list[int]:
    """Bigrams of a template by their place modulo five."""
    return [g for i, g in enumerate(grams) if i % 5 in kept]


def fit(docs: DataFrame, negatives: int = NEGATIVES) -> Model:
    """Multinomial regression over the templates' bigrams: the templates and parts of them against paragraphs of the corpus.

    Of the corpus, ``negatives`` documents at most are drawn, and of their paragraphs a fourth, without those that hold
    most of a template; they teach the unknown class, and so do two fifths of a template, which are too little of one. A licence is what
    holds four fifths. Half the paragraphs, and other two and four fifths of each template, are held back: on these the
    probability of any licence is calibrated, by a logistic regression on its log odds.
    """
    spark = docs.sparkSession
    known = templates(spark).collect()  # a fixed list
    vocabulary = sorted({g for r in known for g in r["grams"]})
    few = drawn(docs.select("doc_id", "text").withColumn("_all", F.lit(0)), "_all", {0: max(1, docs.count())}, negatives, "doc_id", "text")
    some = paragraphs(few).select("doc_id", "paragraph", _known(bigrams(F.col("body")), vocabulary).alias("grams")).where(F.pmod(F.xxhash64("doc_id", "paragraph"), F.lit(4)) == 0)
    holds = reduce(lambda a, b: a | b, [F.size(F.array_intersect("grams", F.array(*[F.lit(g) for g in r["grams"]]))) >= CONTAINED * len(r["grams"]) for r in known])
    negative = Scratch(spark).table(some.where(~holds).withColumn("held_back", F.pmod(F.xxhash64("paragraph", "doc_id"), F.lit(2)) == 1), "negatives")

    text = lambda c: F.transform(c, lambda g: g.cast("string"))
    families = [UNKNOWN, *sorted(TEMPLATES)]
    at = {f: i for i, f in enumerate(families)}
    row = lambda label, grams, weight: (float(label), [str(g) for g in grams], weight)
    long = [r for r in known if len(r["grams"]) >= 5]
    seen = [row(at[r["family"]], r["grams"], 20.0) for r in known] + [row(at[r["family"]], _parts(r["grams"], k), 10.0) for r in long for k in LICENSED[:3]]
    seen += [row(0, _parts(r["grams"], k), 10.0) for r in long for k in UNLICENSED[:3]] + [row(0, [], 50.0)]
    back = [row(1, _parts(r["grams"], k), 1.0) for r in long for k in LICENSED[3:]] + [row(0, _parts(r["grams"], k), 1.0) for r in long for k in UNLICENSED[3:]]
    schema = "label double, grams array<string>, weight double"
    unlike = lambda held: negative.where(F.col("held_back") == held).select(F.lit(0.0).alias("label"), text("grams").alias("grams"), F.lit(1.0).alias("weight"))
    # A few thousand short rows: one partition, so that the fits' many passes are one task each.
    reader = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(spark.createDataFrame([([str(g) for g in vocabulary],)], "grams array<string>"))
    train = reader.transform(spark.createDataFrame(seen, schema).unionByName(unlike(False)).coalesce(1))
    fitted = LogisticRegression(family="multinomial", weightCol="weight", regParam=0.002, maxIter=60).fit(train)
    apart = fitted.transform(reader.transform(spark.createDataFrame(back, schema).unionByName(unlike(True)).coalesce(1)))
    odds = apart.select("label", "weight", array_to_vector(F.array(log_odds(F.element_at(vector_to_array("probability"), 1)))).alias("odds"))
    line = LogisticRegression(featuresCol="odds", weightCol="weight", regParam=0.001, maxIter=60).fit(odds)
    matrix = fitted.coefficientMatrix.toArray()
    weights = [(int(term), [float(x) for x in matrix[:, i]]) for i, term in enumerate(reader.vocabulary)]
    return Model(families, weights, [float(x) for x in fitted.interceptVector], float(line.coefficients[0]), float(line.intercept))


def _likely(met: DataFrame, keys: list[str], model: Model, sizes: dict[int, tuple[str, int]]) -> DataFrame:
    """Paragraphs that count: keys, doc_id, family, probability, contained, template; from a row a known bigram of each."""
    n = len(model.families)
    scored = met.groupBy(*keys).agg(
        F.first("doc_id").alias("doc_id"), F.array(*[F.sum(F.col("weights")[i]) for i in range(n)]).alias("scores"), F.flatten(F.collect_list("templates")).alias("hits"),
    )
    names = F.array(*[F.lit(f) for f in model.families])
    # Of equal families the first by name.
    likely = scored.withColumn("p", model.probabilities(F.col("scores"))).withColumn("known", F.slice("p", 2, n - 1))
    likely = likely.withColumn("best", F.array_position("known", F.array_max("known")).cast("int") + 1)
    likely = likely.select(*keys, "doc_id", F.element_at(names, F.col("best")).alias("family"), model.calibrated(F.col("p")[0]).alias("probability"), "hits")
    likely = likely.where(F.col("probability") >= LEAST_PROBABILITY)
    # How much of each of its family's templates the paragraph holds.
    hits_of = lambda t: F.size(F.filter("hits", lambda h: h == t))
    share = F.array(*[F.struct((hits_of(t) / size).alias("contained"), F.lit(-t).alias("order"), F.lit(f).alias("of")) for t, (f, size) in sizes.items()])
    best = likely.withColumn("t", F.array_max(F.filter(share, lambda s: s["of"] == F.col("family")))).where(F.col("t.contained") >= CONTAINED)
    return best.select(*keys, "doc_id", "family", F.round("probability", 6).alias("probability"), F.round("t.contained", 6).alias("contained"), (-F.col("t.order")).alias("template"))


def find_licenses(docs: DataFrame, model: Model) -> DataFrame:
    """Licence paragraphs of ``docs (doc_id, text)``: doc_id, paragraph, family, probability, contained, template.

    A paragraph is a line; and, as notices are wrapped, what lines with words follow each other are scored as a run too, without
    those that count on their own: as a whole, and by its windows of WINDOWS lines, so that neither what stands around a notice nor a second one
    hides it. A run gives a row a family, that of the window that holds most of a template; its paragraph is the window's first line.

    Bigrams are hashed where the text is read and meet the model's (a few hundred, from the fixed templates) by a
    broadcast join; a paragraph with none of them has the intercepts alone, which is the unknown class. For the others
    the weights are summed. A paragraph counts if its calibrated probability of being any licence's is one half or more, and a template of
    the likeliest family (of equal ones the first by name) is contained in it to six tenths or more; the template is the one held most, of
    equal ones the first.

    Whole texts count, however long. Null and empty texts have no paragraphs. Equal rows each give theirs; a null doc_id stays null. An empty table gives
    an empty result. Other columns are dropped.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    known = templates(spark)
    sizes = {r["template"]: (r["family"], len(r["grams"])) for r in known.collect()}
    owners = known.select(F.explode("grams").alias("gram"), "template").groupBy("gram").agg(F.collect_list("template").alias("templates"))
    learned = F.broadcast(spark.createDataFrame(model.weights, "gram bigint, weights array<double>").join(owners, "gram"))
    opened = _runs(docs).select("row", "doc_id", "run", "at", F.inline(_line_bigrams(F.col("body"), F.col("after"))))
    opened = scratch.table(opened.join(learned.select("gram"), "gram", "left_semi"), "known_bigrams")
    lines = scratch.table(_likely(opened.where(~F.col("over")).withColumnRenamed("at", "paragraph").join(learned, "gram"), ["row", "paragraph"], model, sizes), "notices")

    # What is left of runs with a bigram over an end, where neither side of that end counts on its own.
    taken = lines.select("row", F.col("paragraph").alias("at"), F.explode(F.array(F.lit(False), F.lit(True))).alias("over"))
    taken = taken.union(lines.select("row", F.col("paragraph") - 1, F.lit(True))).distinct()
    rest = opened.join(taken, ["row", "at", "over"], "left_anti")
    # A template is in a window only if it is in the run.
    least = F.create_map(*[F.lit(x) for t, (_, n) in sizes.items() for x in (t, CONTAINED * n)])
    in_run = rest.groupBy("row", "run", "gram").agg(F.max("over").alias("over")).join(learned, "gram").select("row", "run", "over", F.explode("templates").alias("template"))
    in_run = in_run.groupBy("row", "run", "template").agg(F.count(F.lit(1)).alias("n"), F.max("over").alias("over")).where(F.col("over") & (F.col("n") >= least[F.col("template")]))
    rest = rest.join(in_run.select("row", "run").distinct(), ["row", "run"], "left_semi")

    window = lambda size: lambda start: F.struct(F.lit(size).alias("size"), start.alias("start"))
    windows = [F.transform(F.sequence(F.col("at") - (size - 1), F.col("at")), window(size)) for size in WINDOWS]
    dealt = rest.select("row", "doc_id", "run", "gram", F.inline(F.concat(*windows, F.array(window(0)(F.col("run"))))))
    dealt = dealt.groupBy("row", "run", "size", "start", "gram").agg(F.first("doc_id").alias("doc_id"))
    found = _likely(dealt.join(learned, "gram"), ["row", "run", "size", "start"], model, sizes)
    best = F.max_by(F.struct("doc_id", "start", "probability", "contained", "template"), F.struct("contained", "start", "probability")).alias("b")
    found = found.groupBy("row", "run", "family").agg(best).select("b.doc_id", F.col("b.start").alias("paragraph"), "family", "b.probability", "b.contained", "b.template")
    return lines.drop("row").select(*found.columns).unionByName(found)


def op2_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence paragraphs of all documents."""
    docs = table(spark, sf_dir, "documents")
    return find_licenses(docs, fit(docs))
