"""Licence notices in documents, paragraph by paragraph, in DataFrame functions only.

A paragraph is a line. A sparse multinomial logistic regression over word
one- to three-grams, fitted on notices of the licence families and on lines
without any, says which family a paragraph names. All its features hold a cue word, so
paragraphs without cue words score as "none" and are passed over by one regular expression.
A prediction less sure than almost all right ones on held-out notices, or
without support from any notice of its family, is "unknown". Support is the
share of three-grams that the paragraph has in common with the nearest notice.

Null and empty texts have no rows. Rows are judged one by one, so repeated rows
give repeated results. Paragraphs of any length are taken whole.
"""

from __future__ import annotations

import math
import random
import re
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from citelake.session import stage

NONE, UNKNOWN = "none", "unknown"
#: Least common share of three-grams with a notice of the family.
SUPPORT = 0.5
#: Share of right held-out predictions that may end as unknown.
GIVEN_UP = 0.02
PENALTY = 0.001
SEED = 3

# Usual notices of the licence families.
NOTICES = {
    "MIT": (
        "Released under the MIT License.",
        "This project is licensed under the terms of the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        "associated documentation files, to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial "
        "portions of the Software.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0; you may not use this file except in compliance with the "
        "License.",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or later.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 2.1.",
        "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public "
        "License",
        "Released under the LGPL.",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "You can redistribute it under the terms of the GNU Affero General Public License",
        "Released under the AGPL.",
    ),
    "BSD": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "Use of this source code is governed by a BSD-style license.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0",
    ),
    "CC-BY": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
    ),
    "CC-BY-SA": (
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0.",
    ),
    "CC-BY-NC": (
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC 4.0.",
    ),
    "public domain": (
        "This work has been dedicated to the public domain under CC0 1.0 Universal.",
        "This is free and unencumbered software released into the public domain.",
    ),
    "proprietary": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved. No part of this publication may be reproduced without permission.",
        "Proprietary and confidential. Unauthorized copying of this file is strictly prohibited.",
    ),
}
# Lines that hold cue words but are no notices.
OTHER_LINES = (
    "the driver lost his license after the accident",
    "human rights are universal rights of all people",
    "she studied at MIT and later moved to Berlin",
    "an Apache helicopter landed near the village",
    "the public domain of the town was reserved for the market",
    "a table was reserved for the source of the story",
    "he asked permission to use the software at work",
    "version 2.0 of the program has a free file copy",
    "the commons were open to creative people",
    "a copy of the letter is the property of the museum",
    "use of the road is governed by law",
    "a marriage licence must be obtained from the general office",
)
_CUES = (
    "license licence licensed licenses licences copyright gpl lgpl agpl mit apache apache-2.0 bsd bsd-style mpl "
    "mozilla cc cc0 creative commons attribution attribution-sharealike attribution-noncommercial by-nc by-sa "
    "gpl-3.0-or-later gnu redistribution redistribute permission granted reserved rights proprietary confidential "
    "unauthorized domain unencumbered spdx-license-identifier license-2.0 notice software affero lesser"
).split()
_WORDS = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
_CUE_PATTERN = r"(?i)\b(?:" + "|".join(sorted(map(re.escape, _CUES))) + r")\b"


class Model(NamedTuple):
    """Families, weights of each n-gram by family, intercepts, and the least sure probability."""

    families: list[str]
    weights: dict[str, list[float]]
    intercepts: list[float]
    least: float


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_WORDS), F.lit(0))


def grams_of(words: Column, n: int) -> Column:
    """Runs of ``n`` words, joined by blanks."""
    starts = F.when(F.size(words) >= n, F.sequence(F.lit(1), F.size(words) - n + 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))


def features_of(words: Column) -> Column:
    return F.array_distinct(F.concat(grams_of(words, 1), grams_of(words, 2), grams_of(words, 3)))


def _plain_grams(text: str, n: int) -> list[str]:
    words = re.findall(_WORDS, text.lower())
    return [" ".join(words[i : i + n]) for i in range(len(words) - n + 1)]


def training_lines() -> list[tuple[str, str]]:
    """(line, family): every notice whole, in windows, with a word left out and with words around it."""
    rng = random.Random(SEED)
    filler = "and of the to our text was more some each page world time there people".split()
    lines = [(line, NONE) for line in OTHER_LINES] + [("", NONE)]
    for family, notices in NOTICES.items():
        for notice in notices:
            words = notice.split()
            lines.append((notice, family))
            lines += [(" ".join(words[:i] + words[i + 1 :]), family) for i in range(len(words)) if len(words) > 5]
            for _ in range(12):
                around = [rng.choice(filler) for _ in range(rng.randint(0, 8))]
                cut = rng.randint(0, len(around))
                lines.append((" ".join([*around[:cut], *words, *around[cut:]]), family))
    for line in OTHER_LINES:
        for _ in range(15):
            words = line.split()
            rng.shuffle(words)
            lines.append((" ".join(words + [rng.choice(filler) for _ in range(rng.randint(0, 6))]), NONE))
    lines += [(" ".join(rng.choice(filler) for _ in range(rng.randint(1, 15))), NONE) for _ in range(60)]
    lines += [(" ".join(rng.choice(_CUES + filler) for _ in range(rng.randint(1, 8))), NONE) for _ in range(60)]
    return lines


def _values(spark: SparkSession, rows: list[tuple[str, float]], schema: list[str]) -> DataFrame:
    quoted = ", ".join("('" + line.replace("\\", "\\\\").replace("'", "\\'") + f"', {label}D)" for line, label in rows)
    return spark.sql(f"SELECT * FROM VALUES {quoted} AS t({', '.join(schema)})")


def fit(spark: SparkSession) -> Model:
    """Fit on the training lines; every fifth is held out for the least sure probability."""
    lines = training_lines()
    families = [NONE, *NOTICES]
    cues = set(_CUES)
    vocabulary = sorted(
        {g for text, f in lines if f != NONE for n in (1, 2, 3) for g in _plain_grams(text, n) if cues & set(g.split())}
    )
    rows = [(line, float(families.index(family))) for line, family in lines]
    order = random.Random(SEED)
    order.shuffle(rows)
    counted = CountVectorizerModel.from_vocabulary(vocabulary, inputCol="grams", outputCol="vector")
    frame = lambda some: counted.transform(
        _values(spark, some, ["line", "label"]).select("label", features_of(words_of(F.col("line"))).alias("grams"))
    )
    fitted = LogisticRegression(
        featuresCol="vector", labelCol="label", family="multinomial", elasticNetParam=0.9, regParam=PENALTY, maxIter=40
    ).fit(frame([r for i, r in enumerate(rows) if i % 5]).coalesce(1))
    matrix = fitted.coefficientMatrix.toArray()
    weights = {g: matrix[:, i].tolist() for i, g in enumerate(vocabulary) if matrix[:, i].any()}
    model = Model(families, weights, fitted.interceptVector.toArray().tolist(), 0.0)
    held = _values(spark, [r for i, r in enumerate(rows) if i % 5 == 0], ["line", "label"])
    margins = held.select("label", margins_of(features_of(words_of(F.col("line"))), model).alias("margins"))
    sure = []
    for label, values in margins.collect():
        chances = [math.exp(v - max(values)) for v in values]
        if label > 0 and chances[int(label)] == 1.0:
            sure.append(1 / sum(chances))
    least = sorted(sure)[int(GIVEN_UP * len(sure))] if sure else 0.0
    return model._replace(least=least)


def margins_of(grams: Column, model: Model) -> Column:
    """An array with the sum of intercept and weights of each family."""
    doubles = lambda values: F.array(*[F.lit(float(v)) for v in values])
    # One text for the optimizer to fold into a constant map; n-grams hold no "=", "|" or comma.
    held = "|".join(f"{g}={','.join(map(repr, w))}" for g, w in model.weights.items())
    table = F.str_to_map(F.lit(held), F.lit("[|]"), F.lit("="))
    known = F.filter(F.transform(grams, lambda g: F.try_element_at(table, g)), lambda w: w.isNotNull())
    rows = F.transform(known, lambda w: F.split(w, ",").cast("array<double>"))
    return F.aggregate(rows, doubles(model.intercepts), lambda acc, w: F.zip_with(acc, w, lambda a, b: a + b))


def support_of(grams: Column, family: Column) -> Column:
    """Largest share of three-grams in common with a notice of the family, of the shorter of the two."""
    out = F.lit(0.0)
    for name, notices in NOTICES.items():
        shares = []
        for notice in notices:
            held = sorted(set(_plain_grams(notice, 3)))
            both = F.size(F.array_intersect(grams, F.array(*[F.lit(g) for g in held])))
            shares.append(both / F.greatest(F.lit(1), F.least(F.size(grams), F.lit(len(held)))))
        out = F.when(family == name, F.greatest(*shares) if len(shares) > 1 else shares[0]).otherwise(out)
    return out


def scan_licenses(documents: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id, paragraph, family, probability, support`` of every paragraph that is, or may be, a licence notice.

    ``paragraph`` counts lines from 0.
    """
    model = model or fit(documents.sparkSession)
    lines = (
        documents.select("doc_id", F.col("text").cast("string").alias("text"))
        .where(F.col("text").rlike(_CUE_PATTERN))
        .select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line"))
        .where(F.col("line").rlike(_CUE_PATTERN))
        .select("doc_id", "paragraph", words_of(F.col("line")).alias("words"))
    )
    # Staged, or every use of the margins below would work them out again.
    scored = stage(
        lines.select("doc_id", "paragraph", "words", margins_of(features_of(F.col("words")), model).alias("margins")),
        "licence-lines",
    )
    names = F.array(*[F.lit(f) for f in model.families])
    top = F.array_max("margins")
    chance = 1 / F.aggregate(F.transform("margins", lambda m: F.exp(m - top)), F.lit(0.0), lambda a, p: a + p)
    guessed = stage(
        scored.select(
            "doc_id",
            "paragraph",
            F.array_distinct(grams_of(F.col("words"), 3)).alias("grams"),
            chance.alias("probability"),
            F.element_at(names, F.array_position("margins", top).cast("int")).alias("guess"),
        ),
        "licence-guesses",
    ).where(F.col("guess") != NONE)
    supported = guessed.withColumn("support", support_of(F.col("grams"), F.col("guess")))
    sure = (F.col("probability") >= model.least) & (F.col("support") >= SUPPORT)
    return supported.select(
        "doc_id",
        "paragraph",
        F.when(sure, F.col("guess")).otherwise(UNKNOWN).alias("family"),
        "probability",
        "support",
    )
