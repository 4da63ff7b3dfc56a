"""Licence scan: a trained paragraph classifier, confirmed by templates.

Paragraphs (single lines, and blocks of lines without a blank one between) become
sparse word uni- and bigrams; multinomial logistic
regression names the licence family or ``unknown``, whose threshold is
calibrated on held-out paragraphs; a predicted family is confirmed by how much
of one of its templates the paragraph holds. DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel, NGram
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import cut

UNKNOWN = "unknown"

#: Notices of each licence family.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("GPL", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("GPL", "SPDX-License-Identifier: GPL-3.0-or-later"),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("BSD", "Released under the BSD 3-Clause License."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "Released under the Mozilla Public License, version 2.0."),
)


def words(text: Column) -> Column:
    """Lower-cased words of letters and digits, as an array without empty strings."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def paragraphs(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, row, block, paragraph, lines, text) of every whole text: each line that
    is not blank (``lines`` 1), and each run of two or more such lines as one
    paragraph. ``paragraph`` is the number of its first line from 0, ``block`` that of its
    run's; ``row`` tells the rows of ``docs`` apart, repeated ones too."""
    held = F.split(F.col(f"`{text}`").cast("string"), "\n")
    # explode of one value: the text is split once, not once for each use
    src = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.explode(F.array(held)).alias("held"))
    full = F.transform("held", lambda x: F.regexp_replace(x, r"\s+", "") != "")
    src = src.select("doc_id", "row", "held", F.explode(F.array(full)).alias("full")).where(F.exists("full", lambda x: x))
    every = F.sequence(F.lit(0), F.size("held") - 1)
    starts = F.filter(every, lambda i: F.get("full", i) & ~F.coalesce(F.get("full", i - 1), F.lit(False)))
    ends = F.filter(every, lambda i: F.get("full", i) & ~F.coalesce(F.get("full", i + 1), F.lit(False)))
    runs = F.arrays_zip(starts.alias("a"), ends.alias("b"))
    src = src.select("doc_id", "row", "held", F.explode(runs).alias("run")).select("doc_id", "row", F.col("run.a").alias("block"), F.slice("held", F.col("run.a") + 1, F.col("run.b") - F.col("run.a") + 1).alias("own"))
    single = F.transform("own", lambda x, i: F.struct((F.col("block") + i).alias("paragraph"), F.lit(1).alias("lines"), x.alias("text")))
    joined = F.array(F.struct(F.col("block").alias("paragraph"), F.size("own").alias("lines"), F.array_join("own", "\n").alias("text")))
    units = F.when(F.size("own") > 1, F.concat(single, joined)).otherwise(single)
    return src.select("doc_id", "row", "block", F.explode(units).alias("u")).select("doc_id", "row", "block", "u.*")


def _grams(df: DataFrame) -> DataFrame:
    """Adds ``grams``: words and word pairs of ``words``."""
    return NGram(n=2, inputCol="words", outputCol="pairs").transform(df).withColumn("grams", F.concat("words", "pairs")).drop("pairs")


@dataclass(frozen=True)
class LicenseModel:
    families: list[str]              # by label; 0 is unknown
    vectorizer: CountVectorizerModel
    classifier: LogisticRegressionModel
    threshold: float
    templates: list[tuple[str, list[str]]]

    def probabilities(self, df: DataFrame) -> DataFrame:
        """``df`` (with ``words``) plus ``p``, the probability of each label."""
        return self.judge(self.vectorizer.transform(_grams(df)))

    def judge(self, seen: DataFrame) -> DataFrame:
        """``probabilities`` of rows that have their ``features``."""
        return self.classifier.transform(seen).withColumn("p", vector_to_array("probability")).drop("features", "rawPrediction", "probability", "prediction")


def _rows(spark: SparkSession, structs: list[Column]) -> DataFrame:
    """A small frame of literal rows."""
    return spark.range(1).select(F.inline(F.array(*structs)))


def fit(docs: DataFrame, templates=TEMPLATES, text: str = "text", doc_id: str = "doc_id", max_negatives: int = 8_000, false_share: float = 0.001) -> LicenseModel:
    """Train on the templates' notices and on paragraphs of the corpus.

    Positives: each notice, whole and with up to a third of its words cut off
    at either end. Negatives (``unknown``): all paragraphs that hold less than
    half of any template, counted by their known grams; together they weigh
    as much as ``max_negatives`` examples, or each one if there are fewer.
    A quarter of them is held out by hash: the threshold on 1 - P(unknown) lets at
    most ``false_share`` of the held-out negatives through, and is 0.5 at least.
    """
    spark: SparkSession = docs.sparkSession
    families = [UNKNOWN, *dict.fromkeys(f for f, _ in templates)]
    notices = _rows(spark, [F.struct(F.lit(f).alias("family"), F.lit(float(families.index(f))).alias("label"), F.lit(x).alias("text")) for f, x in templates])
    t = notices.withColumn("all", words(F.col("text")))
    n, third = F.size("all"), F.floor(F.size("all") / 3).cast("int")
    t = t.withColumn("a", F.explode(F.sequence(F.lit(0), third))).withColumn("b", F.explode(F.sequence(F.lit(0), third)))
    positive = _grams(t.withColumn("words", F.slice("all", F.col("a") + 1, n - F.col("a") - F.col("b"))).where(F.size("words") > 0)).select("label", "words", "grams")
    positive = cut(positive, "license-positives")
    vectorizer = CountVectorizer(inputCol="grams", outputCol="features", minDF=1.0, binary=True).fit(positive)
    whole = _grams(notices.withColumn("words", words(F.col("text"))))
    known = [(r["family"], sorted(set(r["grams"]))) for r in whole.select("family", "grams").collect()]
    model = LicenseModel(families, vectorizer, None, 0.5, known)  # type: ignore[arg-type]
    paras = paragraphs(docs, text, doc_id).withColumn("words", words(F.col("text"))).select("doc_id", "paragraph", "lines", "words")
    held = F.pmod(F.xxhash64(F.lit(7), "doc_id", "paragraph"), F.lit(4)) == 0
    seen = vectorizer.transform(_grams(paras)).select("features", F.least("lines", F.lit(2)).alias("lines"), held.alias("held"))
    counts = seen.groupBy("features", "lines").agg(F.count_if("held").alias("held"), F.count_if(~F.col("held")).alias("trained"))
    vocabulary = F.array(*[F.lit(g) for g in vectorizer.vocabulary])
    grams = F.array_compact(F.zip_with(vector_to_array("features"), vocabulary, lambda x, g: F.when(x > 0, g)))
    # explode of one value: the grams are told once, not once for each template
    negative = counts.select("*", F.explode(F.array(grams)).alias("grams")).where(_share(model, families[1:]) < 0.5)
    negative = cut(negative.groupBy("features", "grams").agg(F.sum("held").alias("held"), F.sum("trained").alias("trained")), "license-negatives")
    total = negative.agg(F.sum("trained")).first()[0] or 0
    weight = F.col("trained") * F.lit(min(1.0, max_negatives / max(1, total)))
    blank = _rows(spark, [F.struct(F.lit(0.0).alias("label"), F.array().cast("array<string>").alias("grams"))])      # unknown always has an example
    known_rows = vectorizer.transform(positive.select("label", "grams").unionByName(blank)).select("label", "features", F.lit(1.0).alias("weight"))
    examples = known_rows.unionByName(negative.where("trained > 0").select(F.lit(0.0).alias("label"), "features", weight.alias("weight")))
    classifier = LogisticRegression(family="multinomial", regParam=1e-3, maxIter=40, weightCol="weight").fit(examples)
    model = LicenseModel(families, vectorizer, classifier, 0.5, known)
    doubt = model.judge(negative.where("held > 0")).select(F.percentile(1 - F.element_at("p", 1), 1 - false_share, F.col("held")).alias("q")).first()["q"]
    return LicenseModel(families, vectorizer, classifier, max(0.5, doubt or 0.0), known)


def _held(model: LicenseModel, grams: Column, families: list[str], pairs: bool = False) -> Column:
    """Largest share of a template of ``families`` that ``grams`` holds; with ``pairs`` of its word pairs alone."""
    of = [(f, [g for g in t if " " in g] if pairs else t) for f, t in model.templates]
    shares = [F.size(F.array_intersect(F.array(*[F.lit(g) for g in t]), grams)) / float(len(t)) for f, t in of if f in families and t]
    return F.greatest(*shares, F.lit(0.0), F.lit(0.0))


def _share(model: LicenseModel, families: list[str]) -> Column:
    """``_held`` of a line; of a block by word pairs, as scattered words of a long one mean nothing."""
    return F.when(F.col("lines") > 1, _held(model, F.col("grams"), families, pairs=True)).otherwise(_held(model, F.col("grams"), families))


def scan(docs: DataFrame, model: LicenseModel, text: str = "text", doc_id: str = "doc_id", confirm: float = 0.5) -> DataFrame:
    """(doc_id, paragraph, lines, family, probability, similarity, confirmed): one row per
    line of any document that the classifier does not call unknown, and one per
    block of lines that is confirmed while none of its lines is (a notice
    wrapped over lines). ``paragraph`` is the first line's number, ``lines`` their count.

    ``similarity`` is the largest share of a template of the predicted family
    that the paragraph holds; ``confirmed`` from ``confirm`` on. Whole texts
    are read; NULL, empty and blank texts have no paragraph. Repeated rows
    give repeated results. Paragraphs are judged where they are; only those found
    are shuffled, by the row and block they stand in.
    """
    told = model.probabilities(paragraphs(docs, text, doc_id).withColumn("words", words(F.col("text"))).drop("text"))
    told = told.where(1 - F.element_at("p", 1) >= model.threshold)
    named = F.slice("p", 2, len(model.families))
    top = F.array_max(named)
    told = told.withColumn("probability", top).withColumn("at", F.array_position(named, top).cast("int"))
    names = F.array(*[F.lit(f) for f in model.families[1:]])
    told = told.withColumn("family", F.element_at(names, F.col("at")))
    similarity = F.coalesce(*[F.when(F.col("family") == f, _share(model, [f])) for f in model.families[1:]])
    told = told.withColumn("similarity", similarity).withColumn("confirmed", F.col("similarity") >= confirm)
    told = told.where((F.col("lines") == 1) | F.col("confirmed")).select("doc_id", "row", "block", "paragraph", "lines", "family", "probability", "similarity", "confirmed")
    known = F.max(F.when(F.col("lines") == 1, F.col("confirmed"))).over(Window.partitionBy("row", "block"))
    return told.withColumn("known", F.coalesce(known, F.lit(False))).where((F.col("lines") == 1) | ~F.col("known")).drop("row", "block", "known")
