"""Licence scan with a trained paragraph classifier, on DataFrame and MLlib operations only.

A paragraph is a line of text and the lines it is wrapped to: a line of over 50 characters that
does not end a sentence goes on in the next one if that begins in lower case, with a digit, a quote or a
bracket, comment marks left out. Its features are the one and two word runs of a
vocabulary that it has, however often. The classifier is MLlib's multinomial logistic regression over licence
families and ``none``. It is trained on the templates below, filled with versions and
years and cut to shorter forms, and on a bounded sample of the corpus's own paragraphs
as ``none`` (``SAMPLE_ROWS``, chosen by a hash; paragraphs that resemble a template or
name a family are not taken as ``none``). The vocabulary holds all runs of the templates
but those of frequent words only, whatever the sample uses: the classifier weighs common
ones down. A paragraph without any of them is ``none`` whatever its length.

A prediction counts as a family if its probability reaches a threshold calibrated on
training forms held back, and if a template of that family confirms it: enough of
the template's word pairs occur in the paragraph, or of the paragraph's in the template,
and the paragraph has the family's name or a word pair of its templates that no other family's have.
A paragraph that has licence vocabulary but does not pass both is ``unknown`` if the
classifier holds the families together for likelier than ``none``.

Defined cases: null and empty texts have no paragraphs; repeated paragraphs count as
often as they occur; rows are kept by a row key made of doc_id and text, equal rows share
their result; an empty table gives no rows. Columns beside doc_id and text are left out, whatever
they are called.
"""

from __future__ import annotations


from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm.common import bounded_sample, settle, table

NONE, UNKNOWN = "none", "unknown"
SAMPLE_ROWS = 3000
CONFIRM = 0.5
KEPT_SHARE = 0.98
# Short licence notices by family; {v} is a version, {y} a year.
TEMPLATES = {
    "agpl": ["This program is licensed under the GNU Affero General Public License, version {v}.",
             "Released under the GNU Affero General Public License, version {v}.",
             "SPDX-License-Identifier: AGPL-{v}-or-later", "Licensed under the AGPL version {v}.",
             "GNU Affero General Public License", "License: AGPL-{v}"],
    "apache": ["Released under the Apache License, Version {v}.", "Licensed under the Apache License, Version {v}.",
               "Licensed under the Apache License, Version {v} (the \"License\"); you may not use this file except in "
               "compliance with the License.",
               "SPDX-License-Identifier: Apache-{v}",
               "Apache License", "License: Apache-{v}"],
    "bsd": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided "
            "that the following conditions are met:",
            "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
            "Licensed under the BSD {v}-Clause License.", "SPDX-License-Identifier: BSD-{v}-Clause",
            "Released under the BSD License.", "BSD License", "License: BSD-{v}-Clause"],
    "cc": ["Licensed under CC BY-NC {v}.", "Licensed under CC BY-SA {v}.", "Licensed under CC BY {v}.",
           "This work is licensed under a Creative Commons Attribution {v} International License.",
           "To the extent possible under law, the author has waived all copyright under CC0 {v}.",
           "Creative Commons License", "License: CC BY {v}"],
    "epl": ["This program and the accompanying materials are made available under the terms of the Eclipse Public "
            "License v{v}.", "Released under the Eclipse Public License, version {v}.",
            "Licensed under the Eclipse Public License v{v}.", "SPDX-License-Identifier: EPL-{v}",
            "Eclipse Public License", "License: EPL-{v}"],
    "gpl": ["Released under the GNU General Public License, version {v}.", "This work is licensed under the GNU General Public License, version {v}.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
            "Public License as published by the Free Software Foundation, either version {v} of the License, or any "
            "later version.", "Licensed under the GPL version {v}.",
            "SPDX-License-Identifier: GPL-{v}-or-later",
            "GNU General Public License", "License: GPL-{v}"],
    "isc": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
            "granted, provided that the above copyright notice and this permission notice appear in all copies.",
            "Released under the ISC License.", "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
            "ISC License", "License: ISC"],
    "lgpl": ["Released under the GNU Lesser General Public License, version {v}.", "This library is licensed under the GNU Lesser General Public License, version {v}.",
             "SPDX-License-Identifier: LGPL-{v}-or-later",
             "GNU Lesser General Public License", "License: LGPL-{v}"],
    "mit": ["Released under the MIT License.", "Licensed under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files, to deal in the Software without restriction.",
            "SPDX-License-Identifier: MIT",
            "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
            "the Software.", "MIT License", "License: MIT"],
    "mpl": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. {v}.",
            "SPDX-License-Identifier: MPL-{v}",
            "Released under the Mozilla Public License, version {v}.", "Mozilla Public License", "License: MPL-{v}"],
    "unlicense": ["This is free and unencumbered software released into the public domain.",
                  "Released under the Unlicense.", "SPDX-License-Identifier: Unlicense", "The Unlicense",
                  "License: Unlicense"],
}
VERSIONS, YEARS = ("1.0", "1.1", "2", "2.0", "2.1", "3", "3.0", "4.0"), ("1999", "2015", "2024")
FAMILIES = [NONE, *sorted(TEMPLATES)]
# Runs that name a family. A lone "mit" or "apache" does not: both are words of ordinary text too.
NAMING = ["affero general", "agpl", "apache 0", "apache license", "bsd", "cc by", "cc0", "creative commons", "eclipse public",
          "general public", "gnu", "gpl", "identifier apache", "identifier isc", "identifier mit", "isc license", "lgpl",
          "license apache", "license isc", "license mit", "mit license", "mozilla public", "mpl", "public license",
          "spdx license", "unlicense"]
# The end of a line that goes on in the next one; it starts at the line break, so that only breaks are looked at.
WRAPPED = r"\n(?<=[^\n]{50}[^.:;!?\s][ \t]{0,2}\r?\n)[ \t]*(?:(?:#+|//+|[*]+|;+|--+|%+)[ \t]*)?(?=[a-z0-9(\"'])"


def words_of(text: Column) -> Column:
    """Lower-case words; digits of versions become one mark, so that no version has to be learned."""
    plain = F.regexp_replace(F.lower(text), "[0-9]+(?:[.][0-9]+)*", "0")
    return F.filter(F.split(plain, "[^a-z0]+"), lambda w: w != "")


def runs_of(words: Column) -> Column:
    """One and two word runs of an array of words."""
    def runs(bound: Column) -> Column:
        following = F.slice(bound, 2, F.greatest(F.size(bound) - 1, F.lit(0)))
        return F.concat(bound, F.transform(following, lambda w, i: F.concat(F.get(bound, i), F.lit(" "), w)))

    # Bound to a name, so that the words are made once and not once per run.
    return F.element_at(F.transform(F.array(words), runs), 1)


def _forms(spark: SparkSession) -> DataFrame:
    """(family, form, text): filled templates, and the parts of longer ones; form numbers them."""
    rows, n = [], 0
    for family, texts in TEMPLATES.items():
        for text in texts:
            for version in VERSIONS if "{v}" in text else YEARS:
                filled = text.replace("{v}", version)
                parts = [filled, f"Copyright (c) {YEARS[n % 3]}. {filled}", filled.upper()]
                words = filled.split(" ")
                if len(words) > 12:
                    parts += [" ".join(words[:len(words) * 2 // 3]), " ".join(words[len(words) // 3:])]
                for part in parts:
                    rows.append((family, n, part))
                    n += 1
    return spark.createDataFrame(rows, "family string, form int, text string")


def paragraphs(docs: DataFrame, *keep: str) -> DataFrame:
    """A row per paragraph that is not blank, with its number."""
    text = F.regexp_replace(F.coalesce(F.col("text").cast("string"), F.lit("")), WRAPPED, " ")
    return docs.select(*keep, F.posexplode(F.split(text, "\n")).alias("line", "text")).where(F.trim("text") != "")


class Scanner:
    """The trained parts: vocabulary, classifier, threshold, and the runs that tell a family from the others."""

    def __init__(self, vocabulary: list[str], model: PipelineModel, threshold: float, own: dict[str, list[str]]):
        self.vocabulary, self.model, self.threshold, self.own = vocabulary, model, threshold, own


def _own_runs(spark: SparkSession) -> dict[str, list[str]]:
    """Per family its name and the word pairs that its templates alone have."""
    texts = spark.createDataFrame([(f, t.replace("{v}", "1")) for f, every in TEMPLATES.items() for t in every],
                                  "family string, text string")
    families: dict[str, set[str]] = {}
    for row in texts.select("family", F.explode(runs_of(words_of(F.col("text")))).alias("run")).distinct().collect():
        families.setdefault(row.run, set()).add(row.family)
    return {f: sorted({f, *(run for run, having in families.items() if having == {f} and " " in run
                            and not set(run.split(" ")) <= _FREQUENT)}) for f in TEMPLATES}


def _probability(rows: DataFrame) -> DataFrame:
    p = vector_to_array("probability")
    best = F.array_max(F.slice(p, 2, len(FAMILIES) - 1))
    return rows.withColumn("p_none", F.get(p, F.lit(0))).withColumn("p", best).withColumn(
        "family_found", F.element_at(F.lit(FAMILIES), (F.array_position(p, best)).cast("int")))


def train(docs: DataFrame) -> Scanner:
    spark = docs.sparkSession
    forms = settle(_forms(spark).coalesce(1), "licence-forms").withColumn("runs", runs_of(words_of(F.col("text"))))
    chosen = settle(bounded_sample(docs.where("text IS NOT NULL").select("doc_id", "text"), SAMPLE_ROWS), "licence-texts")
    lines = bounded_sample(paragraphs(chosen, "doc_id"), SAMPLE_ROWS).select("text")
    plain = settle(lines, "licence-sample").withColumn("runs", runs_of(words_of(F.col("text"))))
    pairs = {r.run for r in forms.select(F.explode("runs").alias("run")).distinct().collect()}
    two = F.lit(sorted(x for x in pairs if " " in x))
    # A sampled paragraph that repeats several of the templates' word pairs, or names a family, is not evidence for "none".
    plain = plain.where((F.size(F.array_intersect("runs", two)) < 3) & ~F.arrays_overlap("runs", F.lit(NAMING)))
    vocabulary = sorted(run for run in pairs if not set(run.split(" ")) <= _FREQUENT)
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="runs", outputCol="features", minTF=1.0,
                                                   binary=True)
    cases = (" ".join(f"WHEN '{f}' THEN {i}.0D" for i, f in enumerate(FAMILIES)))
    number = SQLTransformer(statement=f"SELECT *, CASE family {cases} END AS label, "
                                      f"CASE family WHEN '{NONE}' THEN 0.1D ELSE 1.0D END AS weight FROM __THIS__")
    learner = LogisticRegression(featuresCol="features", labelCol="label", regParam=0.002, maxIter=60,
                                 family="multinomial", weightCol="weight")
    rows = forms.select("family", "form", "text", "runs").unionByName(
        plain.select(F.lit(NONE).alias("family"), F.lit(0).alias("form"), "text", "runs"))
    back = (F.col("form") % 5 == 4) & (F.col("family") != NONE)
    fitted = Pipeline(stages=[number, counted, learner]).fit(rows.where(~back).coalesce(2))
    model = PipelineModel(fitted.stages[1:])
    held = _probability(model.transform(rows.where(back)))
    threshold = held.where("family = family_found").agg(F.percentile("p", F.lit(1 - KEPT_SHARE))).first()[0]
    return Scanner(vocabulary, model, float(min(threshold if threshold is not None else 0.5, 0.9)),
                   _own_runs(spark))


def _named(family: Column, runs: Column, own: dict[str, list[str]]) -> Column:
    """Whether the paragraph has a run that tells the family from the others."""
    named = F.lit(False)
    for name, telling in own.items():
        named = F.when(family == name, F.arrays_overlap(runs, F.lit(telling))).otherwise(named)
    return named


def _confirmed(family: Column, runs: Column) -> Column:
    """Share of word pairs that the paragraph and the family's nearest template have in common."""
    found = F.filter(runs, lambda r: F.instr(r, " ") > 0)
    shares = F.lit(0.0)
    for name, texts in TEMPLATES.items():
        each = []
        for text in texts:
            pairs = F.filter(runs_of(words_of(F.lit(text.replace("{v}", "1")))), lambda r: F.instr(r, " ") > 0)
            both = F.size(F.array_intersect(found, pairs))
            least = F.greatest(F.least(F.size(F.array_distinct(found)), F.size(F.array_distinct(pairs))), F.lit(1))
            each.append(both / least)
        shares = F.when(family == name, F.greatest(*each) if len(each) > 1 else each[0]).otherwise(shares)
    return shares


def classify(lines: DataFrame, scanner: Scanner) -> DataFrame:
    """Paragraphs with licence vocabulary: ``family`` (or unknown), p, confirmed. Lines that are ``none`` are left out."""
    seen = lines.withColumn("runs", runs_of(words_of(F.col("text"))))
    seen = seen.where(F.arrays_overlap("runs", F.lit(scanner.vocabulary)))
    found = _probability(scanner.model.transform(seen)).where("p_none < 0.5").withColumn(
        "confirmed", _named(F.col("family_found"), F.col("runs"), scanner.own)
        & (_confirmed(F.col("family_found"), F.col("runs")) >= CONFIRM))
    sure = (F.col("p") >= scanner.threshold) & F.col("confirmed")
    return found.withColumn("family", F.when(sure, F.col("family_found")).otherwise(UNKNOWN)).drop(
        "runs", "features", "rawPrediction", "probability", "prediction")


def _gate(scanner: Scanner) -> Column:
    """Whether a text has any word of the vocabulary's runs: without one, no line has a run."""
    heads = sorted({min(run.split(" "), key=lambda w: (w in _FREQUENT, -len(w), w)) for run in scanner.vocabulary})
    return F.lower("text").rlike("(?<![a-z])(?:" + "|".join(heads) + ")(?![a-z])")


# Words that say little: of a run of two words the other one is looked for.
_FREQUENT = set("0 a an and any are as at be by can for from in is it may not of on or that the this to under use with "
                "you".split())


def scan(docs: DataFrame, scanner: Scanner) -> DataFrame:
    """doc_id, n_lines, n_licensed, n_unknown, families (array, sorted): a row per row of ``docs``."""
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    lines = paragraphs(rows.where(_gate(scanner)).dropDuplicates(["doc_id", "text_hash"]), "doc_id", "text_hash")
    found = classify(lines, scanner).groupBy(F.col("doc_id").alias("id"), F.col("text_hash").alias("h")).agg(
        F.sum(F.when(F.col("family") != UNKNOWN, 1).otherwise(0)).alias("licensed"),
        F.sum(F.when(F.col("family") == UNKNOWN, 1).otherwise(0)).alias("unsure"),
        F.array_sort(F.collect_set(F.when(F.col("family") != UNKNOWN, F.col("family")))).alias("names"))
    counts = rows.select("doc_id", "text_hash", F.size(F.filter(
        F.split("text", "\n"), lambda x: F.trim(x) != "")).cast("long").alias("n_lines"))
    joined = counts.join(found, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_hash") == F.col("h")), "left")
    return joined.select("doc_id", "n_lines", F.coalesce("licensed", F.lit(0)).cast("long").alias("n_licensed"),
                         F.coalesce("unsure", F.lit(0)).cast("long").alias("n_unknown"),
                         F.coalesce("names", F.array().cast("array<string>")).alias("families"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op6: doc_id, n_lines, n_licensed, n_unknown, families (comma-joined)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan(docs, train(docs)).withColumn("families", F.array_join("families", ","))
