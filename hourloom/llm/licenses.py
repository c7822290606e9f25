"""Licence scan with a trained paragraph classifier, in DataFrame operations only.

A paragraph is a line of the text, or several where a notice is wrapped: a line of 50 to 120 characters that ends in a
letter, comma, quote or bracket goes on in the next one if that begins with a letter, quote or bracket; comment signs at
the start of lines do not count. Its features are the word 1- and 2-grams that occur of its lower-cased words. A sparse
multinomial logistic regression over the n-grams of the family templates gives each paragraph a family or `none`; it is
trained on windows of the templates against ordinary prose (a bounded sample: of the 4 * PROSE_ROWS paragraphs of the
corpus that come first by hash, PROSE_ROWS that name no licence).

The smallest probability at which a family is believed is calibrated on templates that the model does not know: a model
without each family's last template and a tenth of the prose is tried on these, and the limit is the lowest one at which
PRECISE of the families that it names there are right (at most 0.5). The model in use then learns from all rows. Below the limit the paragraph
is `unknown`. A believed family is confirmed by comparison with its templates: at least CONFIRM of the paragraph's
2-grams occur in them, or at least CONFIRM of some template's 2-grams occur in the paragraph.

Scoring is the fitted Spark ML model on each paragraph's row (its vocabulary: the templates' n-grams, nothing from the
corpus), so nothing moves but the paragraphs that are not `none`. A document's licence is that of its most probable
confirmed paragraph, ties to the first paragraph.

Null and empty texts: licence `none`, no paragraphs. Whole texts of any length. Rows that repeat both id and text get the
same answer each. Of the documents' columns only doc_id and text are read.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROSE_ROWS, CONFIRM, SMALL, PRECISE = 600, 0.6, 1e-3, 0.95

HASHES = 1 << 40

#: Short standard notices of each family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
        'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
        "This project is released under the Apache License 2.0.",
    ],
    "mit": [
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software',
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "Distributed under the GNU GPL v2 or later.",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation.",
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "Released under the LGPL.",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Released under the 3-Clause BSD License.",
        "Use of this source code is governed by a BSD-style license.",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, version 2.0.",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "Content is available under CC BY-SA 4.0.",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
        "Content is available under CC BY-NC-SA 4.0.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work under CC0 1.0.",
        "Dedicated to the public domain under the CC0 license.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ],
}
#: Prose that shares words with the templates and is none of them.
PROSE = [
    "The driver showed a license to the officer and went on.", "He got the fishing license for free and the permission of the owner.", "The general public is free to use the library and the software in it.",
    "All the rights of the people were reserved for the few.", "In this version of the story the author is released under the condition that the law allows.", "She read the notice above the door and made a copy of the list.",
    "The source of the river is in the public park.", "Version two of the program is distributed in the form of a book.", "An apache helicopter landed in the field.", "The conditions of the agreement are as follows.",
]
FAMILIES = [*TEMPLATES, "none"]


def _pairs(words: Column) -> Column:
    rest = F.greatest(F.size(words) - 1, F.lit(0))
    return F.zip_with(F.slice(words, F.lit(1), rest), F.slice(words, F.lit(2), rest), lambda a, b: F.concat(a, F.lit(" "), b))


def _of_words(text: Column, made) -> Column:
    """made(words), with the words bound to a name so that they are found once however often it uses them."""
    words = F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{N}]+(?:[.'-][\p{L}\p{N}]+)*"), 0)
    return F.get(F.transform(F.array(words), made), F.lit(0))


def word_grams(text: Column) -> Column:
    """Words and pairs of neighbouring words, with repeats."""
    return _of_words(text, lambda w: F.concat(w, _pairs(w)))


def word_pairs(text: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    return F.array_distinct(_of_words(text, _pairs))


def paragraphs(text: Column) -> Column:
    """Lines of the text, wrapped ones joined, without comment signs. The line end comes first in the pattern, so that only
    line ends look back."""
    bare = F.regexp_replace(text, r"(?m)^[ \t]*(?:#+|//+|/?\*+|--+|;+|>+)[ \t]*", "")
    return F.split(F.regexp_replace(bare, r"\r?\n(?<=(?:\n|^)[^\n]{49,119}[\p{L},\")]\r?\n)(?=[ \t]*[\p{L}(\"])", " "), "\n")


def _table(spark, rows: list[tuple], ddl: str) -> DataFrame:
    """A small local table, as JSON in the plan."""
    names = [x.split()[0] for x in ddl.split(", ")]
    blob = json.dumps([dict(zip(names, r, strict=True)) for r in rows])
    return spark.range(0, 1, 1, 1).select(F.inline(F.from_json(F.lit(blob), f"array<struct<{', '.join(x.replace(' ', ': ', 1) for x in ddl.split(', '))}>>")))


def _windows() -> list[tuple[str, str, bool]]:
    """Templates, and their runs of about half and a third of the words, by family; whether it is the family's last."""
    out = []
    for family, texts in TEMPLATES.items():
        for t in texts:
            w = t.split()
            mine = [t] * 4
            if len(w) > 12:
                for part in (len(w) // 2, len(w) // 3):
                    mine += [" ".join(w[i : i + part]) for i in range(0, len(w) - part + 1, max(part // 2, 1))]
            out += [(x, family, t == texts[-1]) for x in mine]
    return out


def _prose(docs: DataFrame) -> list[str]:
    """PROSE_ROWS paragraphs that name no licence, of the 4 * PROSE_ROWS longer ones that come first by hash. Only hashes
    below a bound that leaves about four times as many are sorted."""
    wanted = 4 * PROSE_ROWS
    lines = docs.where("text is not null").select("doc_id", F.explode(paragraphs(F.col("text"))).alias("line")).where(F.length("line") > 20)
    lines = lines.select("line", F.pmod(F.xxhash64("doc_id", "line"), F.lit(HASHES)).alias("o"))
    n = lines.count()
    some = lines.where(F.col("o") < HASHES * min(1.0, 4 * wanted / max(n, 1))).orderBy("o", "line").limit(wanted)
    plain = some.where(~F.lower("line").rlike("licen|copyright|rights|warrant|permission|gnu|public domain"))
    return [r.line for r in plain.orderBy("o", "line").limit(PROSE_ROWS).collect()]


def _limit(tried: DataFrame) -> float:
    """The lowest probability from which PRECISE of the families named in (label, prediction, probability) are right."""
    named = sorted(((float(max(r.probability)), r.label == r.prediction) for r in tried.collect() if r.prediction < len(TEMPLATES)), reverse=True)
    limit, right = 0.5, 0
    for i, (p, good) in enumerate(named, 1):
        right += good
        if right >= PRECISE * i:
            limit = min(limit, p)
    return limit


class LicenceModel:
    """Vocabulary and weights as Spark ML models, the calibrated limit, and the templates' word pairs."""

    def __init__(self, docs: DataFrame):
        spark = docs.sparkSession
        rows = _windows() + [(t, "none", False) for t in PROSE * 4] + [(t, "none", i % 10 == 9) for i, t in enumerate(_prose(docs))]
        data = _table(spark, [(t, FAMILIES.index(f), held) for t, f, held in rows], "text string, label int, held boolean")
        data = data.select(F.col("label").cast("double").alias("label"), word_grams(F.col("text")).alias("grams"), "held")
        counted = CountVectorizer(inputCol="grams", outputCol="features", binary=True).fit(data.where(F.col("label") < len(TEMPLATES)))
        data = counted.transform(data)
        learner = LogisticRegression(family="multinomial", maxIter=60, regParam=SMALL, standardization=False)
        self.limit = _limit(learner.fit(data.where("not held")).transform(data.where("held")).select("label", "prediction", "probability"))
        model = learner.fit(data)
        self.counter = counted
        self.classifier = model.setRawPredictionCol("").setProbabilityCol("likely").setPredictionCol("class")
        pairs = _table(spark, [(t, FAMILIES.index(f)) for f, ts in TEMPLATES.items() for t in ts], "text string, family int").select("family", word_pairs(F.col("text")).alias("pairs"))
        self.templates = [(r.family, r.pairs) for r in pairs.collect()]
        self.of_family = {f: sorted({p for g, ps in self.templates if g == f for p in ps}) for f in range(len(TEMPLATES))}


def licence_paragraphs(docs: DataFrame, model: LicenceModel) -> DataFrame:
    """doc_id, text_key, paragraph, family, probability, confirmed of every paragraph that is not `none`; paragraphs of
    rows that repeat both id and text once."""
    n = len(TEMPLATES)
    lines = docs.where("text is not null").select("doc_id", F.xxhash64("text").alias("text_key"), F.posexplode(paragraphs(F.col("text"))).alias("paragraph", "line"))
    grams = lines.select("doc_id", "text_key", "paragraph", "line", word_grams(F.col("line")).alias("grams"))
    scored = model.classifier.transform(model.counter.transform(grams)).where(F.col("class") < n)
    # Without an n-gram of the vocabulary the classes' shares alone would speak.
    scored = scored.where(F.exists(vector_to_array("features"), lambda x: x > 0))
    found = scored.select("doc_id", "text_key", "paragraph", F.col("class").cast("int").alias("best"), F.array_max(vector_to_array("likely")).alias("probability"), word_pairs(F.col("line")).alias("pairs"))
    found = found.groupBy("doc_id", "text_key", "paragraph").agg(F.first("best").alias("best"), F.first("probability").alias("probability"), F.first("pairs").alias("pairs"))

    def shared(pairs: list[str]) -> Column:
        return F.size(F.array_intersect("pairs", F.array(*map(F.lit, pairs))))

    def near(f: int) -> Column:
        """Most of the paragraph is in the family's templates, or most of one of its templates is in the paragraph."""
        tests = [(F.size("pairs") > 0) & (shared(model.of_family[f]) >= CONFIRM * F.size("pairs"))]
        tests += [shared(p) >= CONFIRM * len(p) for g, p in model.templates if g == f and len(p) > 2]
        return reduce(lambda x, y: x | y, tests)

    close = reduce(lambda x, f: x.when(F.col("best") == f, near(f)), range(n), F)
    return found.select("doc_id", "text_key", "paragraph", F.get(F.array(*map(F.lit, FAMILIES)), F.col("best")).alias("family"), "probability", ((F.col("probability") >= model.limit) & close).alias("confirmed"))


def scan_licences(docs: DataFrame, model: LicenceModel | None = None) -> DataFrame:
    """doc_id, licence (a family, unknown or none), probability, paragraph, n_paragraphs (with a licence), families of
    every row."""
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    found = licence_paragraphs(docs, model or LicenceModel(docs))
    named = found.withColumn("name", F.when(F.col("confirmed"), F.col("family")).otherwise(F.lit("unknown")))
    rank = F.struct(F.col("confirmed"), F.col("probability"), -F.col("paragraph"))
    by_doc = named.groupBy("doc_id", "text_key").agg(
        F.max_by("name", rank).alias("licence"), F.max_by("probability", rank).alias("probability"), F.max_by("paragraph", rank).alias("paragraph"),
        F.sum(F.col("confirmed").cast("long")).alias("n_paragraphs"), F.array_join(F.array_sort(F.collect_set(F.when(F.col("confirmed"), F.col("family")))), ",").alias("families"),
    )
    keys = docs.select(F.col("doc_id").alias("d"), F.xxhash64("text").alias("k"))
    return keys.join(by_doc, keys.d.eqNullSafe(by_doc.doc_id) & (keys.k == by_doc.text_key), "left").select(
        F.col("d").alias("doc_id"), F.coalesce("licence", F.lit("none")).alias("licence"), F.coalesce("probability", F.lit(0.0)).alias("probability"), F.col("paragraph").cast("int").alias("paragraph"),
        F.coalesce("n_paragraphs", F.lit(0)).cast("long").alias("n_paragraphs"), F.coalesce("families", F.lit("")).alias("families"),
    )
