"""Operator 6: licence families of paragraphs. DataFrame functions and the
DataFrame machine-learning library only.

A multinomial logistic regression over hashed word 1- and 2-grams is trained on
notice templates of the licence families, on generic licence talk (the unknown
class) and on a bounded sample of the corpus's own paragraphs without licence
words (no licence). It scores every paragraph. A family's probability must exceed
a limit, a quantile over all scored paragraphs that have no licence words and
resemble no template; below it, licence-like text is "unknown". A
prediction is confirmed when the paragraph holds most word pairs of a template
of that family.
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, RegexTokenizer, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pick

SAMPLE_DOCS = 400     # documents whose paragraphs stand for "no licence" in training
DIMENSIONS = 1 << 13
CONFIRM = 0.6         # share of a template's word pairs that confirm a prediction
MIN_LIMIT = 0.5       # least probability of a family, whatever the calibration says
QUANTILE = 0.999      # share of the paragraphs without a licence that the limit keeps out
NONE, UNKNOWN = "none", "unknown"

# Short notices by which licences are named in texts.
TEMPLATES = {
    "mit": ("Released under the MIT License.", "Licensed under the MIT license", "SPDX-License-Identifier: MIT",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    "apache-2.0": ("Licensed under the Apache License, Version 2.0.", "SPDX-License-Identifier: Apache-2.0",
                   "Released under the Apache License 2.0",
                   "you may not use this file except in compliance with the License"),
    "gpl-3.0": ("This work is licensed under the GNU General Public License, version 3.",
                "under the terms of the GNU General Public License version 3", "SPDX-License-Identifier: GPL-3.0"),
    "gpl-2.0": ("This work is licensed under the GNU General Public License, version 2.",
                "under the terms of the GNU General Public License version 2", "SPDX-License-Identifier: GPL-2.0"),
    "lgpl": ("Licensed under the GNU Lesser General Public License.", "GNU Lesser General Public License version 3",
             "SPDX-License-Identifier: LGPL-3.0"),
    "agpl-3.0": ("Licensed under the GNU Affero General Public License, version 3.",
                 "SPDX-License-Identifier: AGPL-3.0"),
    "bsd": ("Released under the BSD 3-Clause License.", "Licensed under the BSD 2-Clause License",
            "Redistribution and use in source and binary forms, with or without modification, are permitted",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "mpl-2.0": ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
                "Licensed under the Mozilla Public License 2.0", "SPDX-License-Identifier: MPL-2.0"),
    "cc-by": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 License"),
    "cc-by-sa": ("Licensed under CC BY-SA 4.0.",
                 "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 License"),
    "cc-by-nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 License"),
    "cc0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright"),
    "public-domain": ("This work is in the public domain.",
                      "This is free and unencumbered software released into the public domain."),
    "all-rights-reserved": ("All rights reserved.", "Copyright the authors. All rights reserved.",
                            "No part of this publication may be reproduced without permission"),
    UNKNOWN: ("This work is licensed under its own terms.", "See the license for details.",
              "Use of this text is subject to the terms of a license.", "Licensed to the members of the project",
              "Copyright the authors.", "Distributed under a custom license agreement"),
}
# Words of licence talk: such paragraphs are never taken as examples of "no licence".
LICENCE_WORDS = (r"(?iu)licen[cs]|licenç|lizenz|copyright|copyleft|©|\(c\)|spdx|\brights? reserved|public domain|creative commons|"
                 r"urheber|rechte vorbehalten|derechos reservados|droits réservés|diritti riservati|redistribut|"
                 r"\bcc[ -]?(?:by|0)\b|\b[al]?gpl\b|without permission")
_WORD = r"[^\p{L}\p{N}]+"


def paragraphs(text: Column, separator: str) -> Column:
    return F.split(F.coalesce(text, F.lit("")), separator, -1)


def _features() -> Pipeline:
    return Pipeline(stages=[
        RegexTokenizer(inputCol="para", outputCol="w1", pattern=_WORD),
        NGram(inputCol="w1", outputCol="w2", n=2),
        SQLTransformer(statement="SELECT *, concat(w1, w2) AS grams FROM __THIS__"),
        HashingTF(inputCol="grams", outputCol="features", numFeatures=DIMENSIONS, binary=True)])


def with_pairs(df: DataFrame, name: str) -> DataFrame:
    """Distinct neighbouring word pairs of ``para``; the word itself when there is one only."""
    words = F.col("__words")  # a column of its own, so that the lambda does not split the text again
    n = F.size(words)
    pair = lambda i: F.concat_ws(" ", F.get(words, i), F.get(words, i + 1))
    return (df.withColumn("__words", F.filter(F.split(F.lower("para"), _WORD), lambda w: w != ""))
            .withColumn(name, F.array_distinct(F.when(n > 1, F.transform(F.sequence(F.lit(0), n - 2), pair))
                                               .otherwise(words))).drop("__words"))


def template_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(f, t) for f, ts in TEMPLATES.items() for t in ts], "family string, para string")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", separator: str = "\n",
         sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Licence paragraphs: id, ``paragraph`` (position from 0), ``family``,
    ``probability``, ``similarity`` to the nearest template of the family and
    ``confirmed``. A family below the calibrated limit is reported as unknown,
    without confirmation.

    The fit is bounded: paragraphs of ``sample_docs`` documents, chosen by hash,
    stand for "no licence". Scoring and the limit cover all documents.

    Null, empty and blank texts have no paragraphs with words and give no rows.
    Repeated rows are scanned each by itself, null ids too. An empty table gives
    an empty result (training then has templates only). Other columns are not read.
    """
    spark = docs.sparkSession
    src = pick(docs, {"id": id_col, "text": text_col})
    rows = src.select("id", F.posexplode(paragraphs(F.col("text"), separator)).alias("paragraph", "para"))
    known = template_table(spark)
    families = [*TEMPLATES, NONE]
    label = F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")) - 1

    # Training rows without a licence: paragraphs of a bounded choice of documents
    # that are unlike every template and have no licence words.
    key = F.xxhash64("text", "id")
    filled = src.where(F.length("text") > 0)
    chosen = filled.select(key.alias("k")).orderBy("k").limit(sample_docs)
    sample = (filled.withColumn("k", key).join(F.broadcast(chosen), "k", "left_semi")  # sample_docs rows
              .select(F.explode(paragraphs(F.col("text"), separator)).alias("para"))
              .where(F.col("para").rlike(r"\p{L}")).distinct())
    pairs: dict[str, list] = {}
    for r in with_pairs(known, "t").collect():  # one row per template
        pairs.setdefault(r.family, []).append(F.array(*map(F.lit, r.t)))
    alike = F.array(*[t for ts in pairs.values() for t in ts])
    like = F.exists(alike, lambda t: F.size(F.array_intersect(t, F.col("p"))) >= 0.5 * F.size(t))
    clean = materialize(with_pairs(sample, "p"), "license-sample").where(
        ~like & ~F.col("para").rlike(LICENCE_WORDS)).select("para")
    train = known.unionByName(clean.select(F.lit(NONE).alias("family"), "para")).withColumn("label", label.cast("double"))
    prepare = _features().fit(train)
    train = prepare.transform(train)
    # Each class weighs the same, however many rows stand for it.
    sizes = {r.family: r["count"] for r in train.groupBy("family").count().collect()}  # one row per family
    weight = F.create_map(*[F.lit(x) for f, n in sizes.items() for x in (f, 1.0 / n)])[F.col("family")]
    train = train.withColumn("weight", weight)
    model = LogisticRegression(weightCol="weight", family="multinomial", regParam=2e-4, maxIter=60,
                               standardization=False).fit(train)

    p = vector_to_array("probability")
    licensed = F.slice("p", 1, len(families) - 2)  # without unknown and none

    judged = lambda df: model.transform(prepare.transform(df)).withColumn("p", p)
    # Generating the licence rows, not filtering, keeps the model from being run twice for each paragraph.
    none_at = lambda q: F.get(q, F.lit(len(families) - 1))
    hits = F.filter(F.array(F.struct("paragraph", "para", "p")), lambda x: none_at(x["p"]) < 0.5)
    kept = materialize(judged(rows.where(F.col("para").rlike(r"[\p{L}\p{N}]"))).select("id", F.explode(hits).alias("x"))
                       .select("id", "x.*").withColumn("best", F.array_max(licensed)), "license-scored")

    # Any paragraph above the least limit is among them; the others without a licence only count.
    odd = with_pairs(kept.where((F.col("best") > MIN_LIMIT) & ~F.col("para").rlike(LICENCE_WORDS)).select("para", "best"),
                     "p").where(~like)
    limit, n_odd = MIN_LIMIT, odd.count()
    if n_odd:
        plain = F.size(F.filter(paragraphs(F.col("text"), separator), lambda x: x.rlike(r"[\p{L}\p{N}]")
                                & ~x.rlike(LICENCE_WORDS)))
        allowed = int((1 - QUANTILE) * src.agg(F.sum(plain)).first()[0])
        if n_odd > allowed:
            limit = odd.agg(F.percentile_approx("best", 1 - allowed / n_odd, 10_000)).first()[0]
    kept = (kept
            .withColumn("family", F.when(
                (F.col("best") > limit) & (F.col("best") >= F.get("p", F.lit(len(families) - 2))),
                F.get(F.array(*[F.lit(f) for f in families]), (F.array_position("p", F.col("best")) - 1).cast("int"))
            ).otherwise(UNKNOWN))
            .withColumn("probability", F.when(F.col("family") == UNKNOWN, 1 - none_at(F.col("p"))).otherwise(F.col("best"))))
    kept = with_pairs(kept, "mine")
    per_family = F.create_map(*[x for f, ts in pairs.items() for x in (F.lit(f), F.array(*ts))])
    likeness = F.array_max(F.transform(per_family[F.col("family")], lambda t: F.size(
        F.array_intersect(t, F.col("mine"))) / F.size(t)))
    return (kept.withColumn("similarity", likeness)
            .select(F.col("id").alias(id_col), F.col("paragraph").cast("long"), "family", "probability", "similarity",
                    ((F.col("similarity") >= CONFIRM) & (F.col("family") != UNKNOWN)).alias("confirmed")))
