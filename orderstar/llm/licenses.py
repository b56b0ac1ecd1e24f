"""Licence scan: a trained classifier of word windows, confirmed by comparison with templates.

The words of a text, whatever lines they stand on, are seen through overlapping windows of equal
length. A window is described by how often each word pair and triple of the templates occurs in it. A
multinomial logistic regression over these sparse counts tells licence families from ``unknown``. It is
trained on the template sentences, alone and joined, and on half of all distinct corpus lines that share
no word triple with any template. The other half, all of it, sets the probability from which a family is
believed; a window can make several believed. A believed family is confirmed if enough of one of its templates
stands in a window of the text.

Scoring uses joins only: places of words are looked up in the broadcast weight table (as large as
the templates, not the corpus), so windows without a known n-gram cost one lookup per word and are
``unknown`` by definition of the features.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, stored
from .decontamination import text_digest

UNKNOWN = "unknown"
MARGIN = 0.05
COVERED = 0.6  # part of a template's word triples that has to stand in a window
STEP = 32  # words from window to window, two steps long; at least the longest template's

# Families whose sentences are alike but for the name. One of them gives way in a text that names
# another of them, but not itself.
NAMES = {"GPL": "gnu general public", "LGPL": "gnu lesser general", "AGPL": "gnu affero general"}

# Sentences by which published licences are recognised.
TEMPLATES: dict[str, list[str]] = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "you may not use this file except in compliance with the License",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed "
        'under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied",
    ],
    "MIT": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "This project is licensed under the terms of the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of "
        'this software and associated documentation files (the "Software"), to deal in '
        "the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software",
    ],
    "GPL": [
        "This work is licensed under the GNU General Public License, version 3",
        "This program is free software: you can redistribute it and/or modify it under "
        "the terms of the GNU General Public License as published by the Free Software "
        "Foundation",
        "either version 3 of the License, or (at your option) any later version",
        "either version 2 of the License, or (at your option) any later version",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "LGPL": [
        "Licensed under the GNU Lesser General Public License",
        "This library is free software; you can redistribute it and/or modify it under "
        "the terms of the GNU Lesser General Public License as published by the Free "
        "Software Foundation",
    ],
    "AGPL": [
        "Licensed under the GNU Affero General Public License",
        "it under the terms of the GNU Affero General Public License as published by the "
        "Free Software Foundation",
    ],
    "BSD": [
        "Released under the BSD License",
        "Licensed under the 3-Clause BSD License",
        "Licensed under the 2-Clause BSD License",
        "Redistribution and use in source and binary forms, with or without modification,"
        " are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list"
        " of conditions and the following disclaimer",
        "Neither the name of the copyright holder nor the names of its contributors may "
        "be used to endorse or promote products derived from this software without "
        "specific prior written permission",
    ],
    "MPL-2.0": [
        "Licensed under the Mozilla Public License, version 2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    ],
    "ISC": [
        "Released under the ISC License",
        "Permission to use, copy, modify, and/or distribute this software for any purpose"
        " with or without fee is hereby granted",
    ],
    "CC-BY": [
        "Licensed under CC BY 4.0",
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
    ],
    "CC-BY-SA": [
        "Licensed under CC BY-SA 4.0",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License",
    ],
    "CC-BY-NC": [
        "Licensed under CC BY-NC 4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License",
    ],
    "CC0": [
        "Released under CC0 1.0 Universal",
        "To the extent possible under law, the author has waived all copyright and "
        "related or neighboring rights to this work",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain",
    ],
}


def words(text: Column) -> Column:
    """Runs of a-z, 0-9 and non-ASCII characters after lower-casing A-Z."""
    return F.array_remove(F.split(ascii_lower(text), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", -1), "")


def _gram(at: Column, size: int) -> Column:
    """Hash of the ``size`` words from a place; NULL past the end."""
    last = F.get("words", at + size - 1)
    return F.when(last.isNotNull(), F.xxhash64(*(F.get("words", at + i) for i in range(size))))


def _grams(lines: DataFrame, sizes: tuple[int, ...]) -> DataFrame:
    """The columns of ``lines`` but words, with one row per n-gram and its place ``at``."""
    # Outer, as an inner explode makes Spark split every line twice to test for emptiness.
    at = F.explode_outer(
        F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1))
    )
    placed = lines.withColumn("at", at)
    kept = [*(c for c in lines.columns if c != "words"), "at"]
    if len(sizes) == 1:
        return placed.select(*kept, _gram(F.col("at"), sizes[0]).alias("gram"))
    both = F.array(*(_gram(F.col("at"), size) for size in sizes))
    return placed.select(*kept, F.explode_outer(both).alias("gram"))


def _windows(at: Column, step: int) -> Column:
    """Numbers of the windows that hold a place: window n begins at word ``n * step``."""
    own = F.floor(at / step).cast("int")
    return F.explode(F.when(own > 0, F.array(own - 1, own)).otherwise(F.array(own)))


def texts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(row, digest, words) of every text; a row number tells copies apart."""
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        text_digest(docs[text]).alias("digest"),
        words(F.coalesce(docs[text], F.lit(""))).alias("words"),
    )


@dataclass
class LicenceModel:
    families: list[str]
    weights: DataFrame  # gram, and one weight column w0, w1, ... per family and, last, unknown
    intercepts: list[float]
    believed: float  # probability from which a family counts
    triples: DataFrame  # template, family, size, gram
    step: int  # windows begin every so many words and are twice as long
    templates: dict[str, list[str]] = field(default_factory=dict)


def _template_rows(spark: SparkSession, templates: dict[str, list[str]]) -> DataFrame:
    rows = []
    for family, sentences in templates.items():
        joined = [" ".join(sentences[i:]) for i in range(len(sentences))]
        for sentence in dict.fromkeys([*sentences, *joined]):
            rows.append((family, sentence, sentence in sentences))
    return spark.createDataFrame(rows, "family string, paragraph string, own boolean")


def _plain_lines(docs: DataFrame, text: str, known: DataFrame, step: int) -> tuple[DataFrame, int]:
    """Distinct lines of all texts that share no triple with a template, for training and calibration.

    Rows (hash, half, n_windows, grams) of those with an n-gram of ``known`` (gram, size, tells: whether
    it is a template's triple), each n-gram with its place; and how many windows the other lines of
    half 0 have. Only hashes and places of known n-grams are shuffled, never a line.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n", -1)).alias("paragraph"))
    own = F.xxhash64("paragraph").alias("hash")
    lines = lines.filter("length(paragraph) > 0").select(own, words(F.col("paragraph")).alias("words"))
    n_windows = F.greatest(F.ceil(F.size("words") / (2 * step)), F.lit(1))
    lines = lines.withColumn("n_windows", n_windows.cast("int"))
    half = F.pmod("hash", F.lit(2)).alias("half")
    total = lines.select("hash", "n_windows").distinct().filter(half == 0).agg(F.sum("n_windows"))
    one = F.struct("at", "size", "gram")
    found = (
        _grams(lines.select("hash", "n_windows", "words"), (2, 3))
        .join(F.broadcast(known), "gram")  # as large as the templates
        .groupBy("hash", "n_windows")
        .agg(F.collect_set(one).alias("grams"), F.max("tells").alias("tells"))  # those of one line
        .select("hash", half, "n_windows", "tells", F.array_sort("grams").alias("grams"))
    )
    found = stored(found, "licence-lines")
    seen = found.filter("half = 0").agg(F.sum("n_windows")).first()[0] or 0
    return found.filter("NOT tells").drop("tells"), (total.first()[0] or 0) - seen


def _unlike(plain: DataFrame, others: int, step: int) -> DataFrame:
    """(grams, n): the n-grams that windows of half 0 hold, and how many windows hold just these."""
    width = 2 * step
    plain = plain.filter("half = 0")
    held = (
        plain.select("hash", F.explode("grams").alias("one"))
        .select("hash", "one.*", F.floor(F.col("one.at") / width).alias("window"))
        .filter(F.col("at") % width + F.col("size") <= width)  # not cut by the end of the window
        .groupBy("hash", "window")
        .agg(F.array_sort(F.collect_list(F.col("gram").cast("string"))).alias("grams"))
        .groupBy("grams")
        .agg(F.count("*").alias("n"))
    )
    held = stored(held, "licence-unlike")
    windows = plain.agg(F.sum("n_windows")).first()[0] or 0
    empty = others + windows - (held.agg(F.sum("n")).first()[0] or 0)
    nothing = held.sparkSession.range(1, numPartitions=1).select(
        F.array().cast("array<string>").alias("grams"), F.lit(empty + 1).cast("bigint").alias("n")
    )  # one more, so that there is an unknown class even without documents
    return held.unionByName(nothing)


def fit(
    docs: DataFrame, text: str = "text", templates: dict[str, list[str]] | None = None
) -> LicenceModel:
    """Train on template sentences and on one half of all distinct corpus lines; calibrate on the other.

    Windows that hold the same n-grams are one weighted example, so there are as many as the templates'
    n-grams occur together in different ways.
    """
    templates = TEMPLATES if templates is None else templates
    spark = docs.sparkSession
    families = sorted(templates)
    classes = [*families, UNKNOWN]
    given = _template_rows(spark, templates).withColumn("words", words(F.col("paragraph")))
    triples = (
        _grams(given.filter("own").select("paragraph", "family", "words"), (3,))
        .filter("gram IS NOT NULL")
        .drop("at")
        .distinct()
    )
    longest = given.filter("own").agg(F.max(F.size("words"))).first()[0]
    step = max(STEP, longest or 0)
    sizes = triples.groupBy("paragraph").agg(F.count("*").alias("size"))
    triples = triples.join(sizes, "paragraph").withColumnRenamed("paragraph", "template")
    numbers = F.create_map(*(F.lit(x) for i, c in enumerate(classes) for x in (c, float(i))))
    labelled = given.withColumn("label", numbers[F.col("family")])
    sentences = _grams(labelled.select("label", "paragraph", "words"), (2, 3)).filter("gram IS NOT NULL")
    pairs = _grams(given.select("words"), (2,)).filter("gram IS NOT NULL").select("gram").distinct()
    known = (
        pairs.select("gram", F.lit(2).alias("size"))
        .unionByName(
            _grams(given.select("words"), (3,))
            .filter("gram IS NOT NULL")
            .select("gram", F.lit(3).alias("size"))
            .distinct()
        )
        .join(triples.select("gram", F.lit(True).alias("tells")).distinct(), "gram", "left")
        .withColumn("tells", F.coalesce("tells", F.lit(False)))
    )
    plain, others = _plain_lines(docs, text, known, step)
    grams = (
        sentences.groupBy("label", "paragraph")
        .agg(F.collect_list(F.col("gram").cast("string")).alias("grams"))
        .select("label", "grams", F.lit(1).cast("bigint").alias("n"))
    )
    unlike = _unlike(plain, others, step)
    grams = grams.unionByName(unlike.select(numbers[F.lit(UNKNOWN)].alias("label"), "grams", "n"))
    grams = stored(grams, "licence-examples")
    vectors = CountVectorizer(inputCol="grams", outputCol="features").fit(
        grams.filter(F.col("label") < len(families))
    )
    model = LogisticRegression(
        family="multinomial", regParam=1e-4, maxIter=60, standardization=False, weightCol="weight"
    ).fit(_balanced(vectors.transform(grams)))
    matrix = model.coefficientMatrix.toArray().T.tolist()  # grams of the templates x families
    names = ", ".join(f"w{i} double" for i in range(len(classes)))
    weights = spark.createDataFrame(
        [(int(g), *row) for g, row in zip(vectors.vocabulary, matrix)], f"gram bigint, {names}"
    )
    found = LicenceModel(
        families, weights, model.interceptVector.toArray().tolist(), 0.5, triples, step, templates
    )
    quiet = plain.filter("half = 1").select("hash", F.explode("grams").alias("one"))
    quiet = quiet.select("hash", "one.at", "one.gram")
    highest = _spoken_for(quiet, ["hash"], found, 0.5).agg(F.max("probability"))
    found.believed = max(0.5, min(0.99, (highest.first()[0] or 0.0) + MARGIN))
    return found


def _balanced(rows: DataFrame) -> DataFrame:
    """Weights that make every class count alike, however many examples (``n`` a row) it has."""
    sizes = rows.groupBy("label").agg(F.sum("n").alias("size"))
    return rows.join(F.broadcast(sizes), "label").select(  # one row per class
        "label", "features", (100.0 * F.col("n") / F.col("size")).alias("weight")
    )


def predictions(rows: DataFrame, model: LicenceModel, least: float = 0.5) -> DataFrame:
    """(row, digest, window, family, probability, won) of families that windows speak for.

    ``probability`` is that of the family against ``unknown`` alone, so that families named in one
    window do not lower each other; those under ``least`` are left out. ``won`` is true for the family
    that leads all others in the window.
    """
    grams = _grams(rows.select("row", "digest", "words"), (2, 3))
    return _spoken_for(grams, ["row", "digest"], model, least)


def _spoken_for(grams: DataFrame, text: list[str], model: LicenceModel, least: float) -> DataFrame:
    """``predictions`` of texts, named by some columns, whose n-grams and their places are given."""
    key = [*text, "window"]
    count = len(model.families) + 1  # the last is unknown
    scored = (
        grams.join(F.broadcast(model.weights), "gram")  # as large as the templates
        .withColumn("window", _windows(F.col("at"), model.step))
        .groupBy(*key)
        .agg(*((F.sum(f"w{i}") + b).alias(f"w{i}") for i, b in zip(range(count), model.intercepts)))
    )
    logits = [F.col(f"w{i}") for i in range(count)]
    each = F.array(
        *(
            F.struct(
                F.lit(family).alias("family"),
                (1 / (1 + F.exp(logits[-1] - logit))).alias("probability"),
                (logit == F.greatest(*logits)).alias("won"),
            )
            for family, logit in zip(model.families, logits)
        )
    )
    spoken = F.filter(each, lambda x: x["probability"] >= least)
    return scored.select(*key, F.explode(spoken).alias("one")).select(*key, "one.*")


def _hits(docs: DataFrame, digests: DataFrame, model: LicenceModel, text: str) -> DataFrame:
    """(digest, at, line, gram, family, template, size): template triples in the texts of ``digests``."""
    found = docs.select(
        text_digest(docs[text]).alias("digest"), F.coalesce(docs[text], F.lit("")).alias("text")
    ).join(digests, "digest", "left_semi")
    split = found.select("digest", F.transform(F.split("text", "\n", -1), words).alias("lines"))
    numbers = F.transform("lines", lambda own, i: F.array_repeat(i, F.size(own)))
    rows = split.select(
        "digest", F.flatten("lines").alias("words"), F.flatten(numbers).alias("line_of")
    )
    places = F.explode_outer(F.when(F.size("words") > 0, F.sequence(F.lit(0), F.size("words") - 1)))
    grams = rows.withColumn("at", places).select(
        "digest", "at", F.get("line_of", F.col("at")).alias("line"), _gram(F.col("at"), 3).alias("gram")
    )
    # Copies of a text say the same.
    return grams.join(F.broadcast(model.triples), "gram").distinct()  # as large as the templates


def _standing(matches: Column) -> Column:
    """The matches of a window that stand, given the best covered first.

    A whole template stands. Of one that is covered in part, enough has to be left besides the triples
    that better covered templates of other families hold: a GPL sentence is most of an AGPL one.
    """
    found = "array<struct<rank:double,longer:int,template:string,family:string,line:int,last:int,grams:array<bigint>>>"
    held = "array<struct<family:string,gram:bigint>>"
    start = F.struct(F.array().cast(held).alias("held"), F.array().cast(found).alias("found"))

    def step(state: Column, one: Column) -> Column:
        others = F.filter(state["held"], lambda h: h["family"] != one["family"])
        left = F.array_except(one["grams"], F.transform(others, lambda h: h["gram"]))
        # rank and longer are negative, as the matches are sorted by them
        stands = (one["rank"] == -1.0) | (-F.size(left) / one["longer"] >= COVERED)
        own = F.transform(one["grams"], lambda g: F.struct(one["family"].alias("family"), g.alias("gram")))
        return F.struct(
            F.when(stands, F.concat(state["held"], own)).otherwise(state["held"]).alias("held"),
            F.when(stands, F.concat(state["found"], F.array(one))).otherwise(state["found"]).alias("found"),
        )

    return F.aggregate(matches, start, step, lambda state: state["found"])


def scan(docs: DataFrame, model: LicenceModel, text: str = "text") -> DataFrame:
    """Per text and family: (digest, family, probability, covered, lines, confirmed).

    Every family that a window of the text makes believed is compared with its own templates.
    ``covered`` is the largest part of one whose word triples stand in a window, ``lines`` has the line
    that holds most of each template found. Without one a family is listed only if it leads a window.
    """
    believed = (
        predictions(texts(docs, text), model, model.believed)
        .groupBy("digest", "family")
        .agg(F.max("probability").alias("probability"), F.max("won").alias("won"))
    )
    believed = stored(believed, "licence-believed")
    hits = stored(_hits(docs, believed.select("digest").distinct(), model, text), "licence-hits")
    matched = (
        hits.withColumn("window", _windows(F.col("at"), model.step))
        .groupBy("digest", "window", "family", "template", "size")
        .agg(
            F.collect_set("gram").alias("grams"),  # those of one template at most
            F.mode("line", True).alias("line"),
            F.max("at").alias("last"),
        )
        .withColumn("covered", F.size("grams") / F.col("size"))
    )
    best = matched.groupBy("digest", "family").agg(F.max("covered").alias("covered"))
    one = F.struct(
        (-F.col("covered")).alias("rank"),
        (-F.col("size")).cast("int").alias("longer"),
        "template",
        "family",
        "line",
        "last",
        "grams",
    )
    stands = (
        matched.filter(F.col("covered") >= COVERED)
        .groupBy("digest", "window")
        .agg(F.array_sort(F.collect_list(one)).alias("matches"))  # one per template at most
        .select("digest", F.explode(_standing(F.col("matches"))).alias("one"))
        .select("digest", "one.family", "one.template", "one.last", "one.line", "one.rank")
        # Two windows that see the end of one sentence count it once.
        .groupBy("digest", "family", "template", "last")
        .agg(F.min_by("line", F.struct("rank", "line")).alias("line"))
        .groupBy("digest", "family")
        .agg(F.array_sort(F.collect_set("line")).alias("lines"))
    )
    named = F.coalesce(
        *(
            F.when(F.col("gram") == F.xxhash64(*map(F.lit, name.split())), F.lit(family))
            for family, name in NAMES.items()
        )
    )
    names = hits.groupBy("digest").agg(F.collect_set(named).alias("names"))
    alike = F.col("family").isin(*NAMES) & (F.size("names") > 0)
    joined = (
        believed.join(best, ["digest", "family"], "left")
        .join(stands, ["digest", "family"], "left")
        .join(names, "digest", "left")
        .withColumn("gives_way", alike & ~F.array_contains("names", F.col("family")))
    )
    confirmed = F.col("lines").isNotNull() & ~F.coalesce("gives_way", F.lit(False))
    return joined.withColumn("confirmed", confirmed).filter("confirmed OR won").select(
        "digest",
        "family",
        "probability",
        F.coalesce("covered", F.lit(0.0)).alias("covered"),
        F.when(F.col("confirmed"), F.col("lines")).otherwise(F.array().cast("array<int>")).alias("lines"),
        "confirmed",
    )


def report(docs: DataFrame, model: LicenceModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_paragraphs, n_licensed, licences, unconfirmed, probability) of every row.

    A paragraph is a line. ``licences`` are the confirmed families, sorted; ``n_licensed`` the lines
    that hold most of a licence sentence, so one wrapped over lines counts once; ``unconfirmed`` the
    families that lead a window without a template that fits anywhere in the text; ``probability`` the
    highest of the confirmed ones, 0 without. A NULL or empty text is one paragraph without licence;
    repeated rows get the same result.
    """
    found = scan(docs, model, text)
    sure = F.col("confirmed")
    per_text = found.groupBy("digest").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("lines")))).alias("n_licensed"),
        F.array_sort(F.collect_set(F.when(sure, F.col("family")))).alias("licences"),
        F.array_sort(F.collect_set(F.when(~sure, F.col("family")))).alias("unconfirmed"),
        F.max(F.when(sure, F.col("probability"))).alias("probability"),
    )
    per_text = stored(per_text, "licence-texts")  # so that copies of one text can be split below
    none = F.array().cast("array<string>")
    rows = docs.select(
        docs[key].alias("key"),
        text_digest(docs[text]).alias("digest"),
        F.size(F.split(F.coalesce(docs[text], F.lit("")), "\n", -1)).cast("long").alias("n_paragraphs"),
    )
    return rows.join(per_text, "digest", "left").select(
        F.col("key").alias(key),
        "n_paragraphs",
        F.coalesce("n_licensed", F.lit(0)).cast("long").alias("n_licensed"),
        F.coalesce("licences", none).alias("licences"),
        F.coalesce("unconfirmed", none).alias("unconfirmed"),
        F.coalesce("probability", F.lit(0.0)).alias("probability"),
    )
