"""Operator 7: licence paragraphs by a trained classifier, confirmed against templates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from filingspark.llm.tables import bind, stored

UNKNOWN = "unknown"
FEATURES = 1 << 15
NEGATIVES = 20_000
VARIANTS = 24
CALIBRATED = 0.995
CONFIRMED = 0.6
WINDOW = 80
OVERLAP = 40
CONTEXTS = 256
AROUND = ".,;:!?()[]{}<>\"'`*_|/\\#=+-"

# Short notices and opening sentences of public licences, by family.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in "
        "compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is "
        "distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License",
    ],
    "LGPL-3.0": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License",
    ],
    "BSD-3-Clause": [
        "Released under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    ],
    "CC-BY-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "CC-BY-NC-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
        "is hereby granted",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain.",
    ],
}


def words_of(text: Column) -> Column:
    """Lower-case words: runs between white space, without the punctuation around them."""
    bare = F.transform(F.split(F.lower(text), r"\s+"), lambda w: F.btrim(w, F.lit(AROUND)))
    return F.filter(bare, lambda w: w != "")


def grams(words: Column) -> Column:
    """The words and their neighbouring pairs."""
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.size(words)), lambda a, b: F.concat_ws(" ", a, b))
    return F.concat(words, F.slice(pairs, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))))


def paragraphs(docs: DataFrame) -> DataFrame:
    """``doc_id, paragraph, words``: the lines with words of each whole text, numbered from 0.

    A line of more than ``WINDOW`` words is read in stretches of as many, each beginning
    ``OVERLAP`` words before the end of the last, so a short notice has its share of the
    stretch and none of the templates is cut in two. Words are made inside an outer
    ``explode``, behind which no filter can pull them out again.
    """
    listed = F.transform(
        F.split("text", "\n"), lambda line, i: F.struct(i.alias("paragraph"), words_of(line).alias("all"))
    )
    lines = docs.select("doc_id", F.explode_outer(listed).alias("_line"))
    words = lines.select("doc_id", "_line.*").where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - OVERLAP, F.lit(1)), F.lit(WINDOW - OVERLAP))
    cut = words.withColumn("_at", F.explode(starts))
    return cut.select("doc_id", "paragraph", "_at", F.slice("all", F.col("_at"), F.lit(WINDOW)).alias("words"))


def templates(spark: SparkSession) -> DataFrame:
    rows = [(family, i, text) for family, texts in TEMPLATES.items() for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "family string, template int, text string").select(
        "family", "template", words_of(F.col("text")).alias("words")
    )


def _drawn(*parts) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def examples(docs: DataFrame, negatives: int = NEGATIVES) -> DataFrame:
    """Labelled paragraphs ``family, words, fold``.

    Each template gives ``VARIANTS`` forms: whole, and with up to a sixth of its words
    left out. The unknown class is a sample of at most about ``negatives`` stretches of
    the corpus, as ``paragraphs`` cuts them (the bound of the training set), leaving out
    those that hold half of a template's pairs or more, and templates with their words in
    another order. Forms of both kinds are shown alone and inside one of ``CONTEXTS``
    stretches of the sample. Choices hang on hashes only.
    """
    spark = docs.sparkSession
    known = templates(spark)
    forms = known.withColumn("form", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    dropped = F.filter(
        "words",
        lambda w, i: (F.col("form") == 0) | (_drawn(w, i, "form") >= F.col("form") / F.lit(6.0 * VARIANTS)),
    )
    positive = forms.select("family", dropped.alias("words"), _drawn("family", "template", "form").alias("fold"))
    mixed = forms.where("form > 0").select(
        F.lit(UNKNOWN).alias("family"),
        F.transform(
            F.array_sort(F.transform("words", lambda w, i: F.struct(_drawn(w, i, "form").alias("k"), w.alias("w")))),
            lambda s: s["w"],
        ).alias("words"),
        _drawn(F.lit("mixed"), "family", "template", "form").alias("fold"),
    )
    lines = paragraphs(docs)
    total = max(1, docs.count())
    # an even share of documents, then of their lines, keeps the sample near its bound
    share = min(1.0, negatives / total / 8)
    some = lines.where(_drawn(F.lit("sample"), "doc_id") < share * 8).where(
        _drawn(F.lit("line"), "doc_id", "paragraph", "_at") < 0.125
    )
    clean = some.where(likeness(F.col("words")) < 0.5).select(
        F.lit(UNKNOWN).alias("family"), "words",
        _drawn(F.lit("fold"), "doc_id", "paragraph").alias("fold"),
    ).limit(negatives)
    clean = stored(clean, "clean")
    around = clean.orderBy(F.size("words").desc(), F.xxhash64("words")).limit(CONTEXTS)
    contexts = around.agg(F.array_sort(F.collect_list("words")).alias("contexts"))  # one row of at most CONTEXTS
    turn = F.xxhash64("family", F.size("words"), F.hash("words"), "fold")
    shown = positive.unionByName(mixed)
    inside = shown.crossJoin(F.broadcast(contexts)).where(F.size("contexts") > 0).withColumn(
        "_other", F.element_at("contexts", (F.pmod(turn, F.size("contexts")) + 1).cast("int"))
    )
    room = F.greatest(F.lit(WINDOW) - F.size("words"), F.lit(0))
    before = F.floor(_drawn(F.lit("before"), "family", "fold") * (room + 1)).cast("int")
    inside = inside.select(
        "family",
        F.concat(
            F.slice("_other", F.lit(1), before), F.col("words"), F.slice("_other", before + 1, room - before)
        ).alias("words"),
        "fold",
    )
    return shown.unionByName(inside).unionByName(clean)


def _template_pairs() -> list[tuple[str, int, list[str]]]:
    out = []
    for family, texts in TEMPLATES.items():
        for i, text in enumerate(texts):
            words = [w for w in (w.strip(AROUND) for w in text.lower().split()) if w]
            out.append((family, i, sorted({f"{a} {b}" for a, b in zip(words, words[1:])})))
    return out


def _found(held: Column, pairs: list[str]) -> Column:
    return F.size(F.array_intersect(held, F.array(*[F.lit(p) for p in pairs]))) / float(len(pairs))


def likeness(words: Column) -> Column:
    """The greatest share of any template's word pairs that a paragraph holds."""
    return bind(grams(words), lambda held: F.greatest(*[_found(held, pairs) for _, _, pairs in _template_pairs()]))


def family_likeness(words: Column, family: Column) -> Column:
    """The same among the templates of ``family``."""

    def best(held: Column) -> Column:
        found = F.lit(0.0)
        for name in TEMPLATES:
            own = [_found(held, pairs) for f, _, pairs in _template_pairs() if f == name]
            found = F.when(family == name, F.greatest(*own, F.lit(0.0))).otherwise(found)
        return found

    return bind(grams(words), best)


@dataclass
class Classifier:
    families: list[str]
    hashing: HashingTF
    regression: LogisticRegressionModel
    temperature: float
    least: float

    def chances(self, rows: DataFrame) -> DataFrame:
        """Adds ``family`` and ``chance``: the best class and its tempered probability."""
        return _tempered(_scored(rows, self.hashing, self.regression), self.families, self.temperature)


def _scored(rows: DataFrame, hashing: HashingTF, regression: LogisticRegressionModel) -> DataFrame:
    hashed = hashing.transform(rows.withColumn("_grams", grams(F.col("words"))))
    scored = regression.transform(hashed)
    return scored.withColumn("_raw", vector_to_array("_margin")).drop("_grams", "_features", "_margin", "_p", "_best")


def _tempered(rows: DataFrame, families: list[str], temperature: float) -> DataFrame:
    top = F.array_max("_raw")
    total = F.aggregate("_raw", F.lit(0.0), lambda s, x: s + F.exp((x - top) / temperature))
    names = F.array(*[F.lit(f) for f in families])
    best = F.element_at(names, F.array_position("_raw", top).cast("int"))
    # from a list of one, so that filters on the result do not repeat the scores below it
    found = F.inline_outer(F.array(F.struct(best.alias("family"), (1.0 / total).alias("chance"))))
    return rows.select("*", found).drop("_raw")


def train(docs: DataFrame, negatives: int = NEGATIVES) -> Classifier:
    """Fits the classes on four fifths of ``examples`` and calibrates on the rest.

    The temperature is the one of a short grid with the least log loss on the held-out
    part; ``least`` is the lowest chance at which ``CALIBRATED`` of the held-out
    paragraphs called a licence are rightly called so.
    """
    families = [*TEMPLATES, UNKNOWN]
    labels = F.array(*[F.lit(f) for f in families])
    rows = stored(
        examples(docs, negatives).withColumn("label", (F.array_position(labels, F.col("family")) - 1).cast("double")),
        "examples",
    )
    hashing = HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True)
    regression = LogisticRegression(
        featuresCol="_features", labelCol="label", rawPredictionCol="_margin", probabilityCol="_p",
        predictionCol="_best", family="multinomial", maxIter=25, regParam=1e-4, standardization=False,
    )
    fold = hashing.transform(rows.withColumn("_grams", grams(F.col("words"))))
    fitted = regression.fit(fold.where("fold < 0.8"))
    held = _scored(rows.where("fold >= 0.8").withColumnRenamed("family", "truth"), hashing, fitted)
    top = F.array_max("_raw")
    grid = [0.5, 0.75, 1.0, 1.5, 2.0, 3.0, 4.0]
    losses = held.agg(
        *[
            F.avg(
                F.log(F.aggregate("_raw", F.lit(0.0), lambda s, x: s + F.exp((x - top) / t)))
                - (F.element_at("_raw", F.col("label").cast("int") + 1) - top) / t
            ).alias(str(i))
            for i, t in enumerate(grid)
        ]
    ).first()
    temperature = min(zip((x if x is not None else float("inf") for x in losses), grid))[1]
    called = _tempered(held, families, temperature).where(F.col("family") != UNKNOWN)
    steps = [0.5 + i / 50 for i in range(25)]
    right = called.agg(
        *[
            F.avg(F.when(F.col("chance") >= s, (F.col("family") == F.col("truth")).cast("double"))).alias(str(i))
            for i, s in enumerate(steps)
        ]
    ).first()
    good = [s for s, r in zip(steps, right) if r is not None and r >= CALIBRATED]
    return Classifier(families, hashing, fitted, temperature, min(good, default=steps[-1]))


def scan(docs: DataFrame, classifier: Classifier, confirmed: float = CONFIRMED) -> DataFrame:
    """``doc_id, paragraph, first_word, family, chance, likeness, confirmed`` of every paragraph called a licence.

    Every line of every whole text is classified; those of the unknown class, or below
    the calibrated chance, are left out. ``confirmed`` says whether the paragraph holds
    at least that share of the word pairs of one of the family's templates. NULL and
    empty texts have no paragraphs; repeated rows are reported each. ``first_word`` is where
    the stretch of the line begins that was read; a notice where two stretches overlap is
    told by both.
    """
    called = classifier.chances(paragraphs(docs)).where(
        (F.col("family") != UNKNOWN) & (F.col("chance") >= classifier.least)
    )
    return called.select(
        "doc_id", "paragraph", (F.col("_at") - 1).alias("first_word"), "family", "chance",
        family_likeness(F.col("words"), F.col("family")).alias("likeness"),
    ).withColumn("confirmed", F.col("likeness") >= confirmed)
