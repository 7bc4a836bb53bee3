"""License scans with a trained paragraph classifier (operator 6).

Paragraphs are the blocks between blank lines, however many lines they have.  In each, runs of up to ``WINDOW`` words
that hold at least ``CONFIRM`` of a template's two-word shingles are looked for at every position, with numbers
(versions, years, clauses) masked; a multinomial logistic regression over sparse hashed word n-grams (one and two
words) names each run a licence family or ``unknown``, and the run is reported if it names the template's family.

Training.  The families' examples are their templates and seeded variants of them: with words before and behind,
in parts, with single words left out.  The class ``unknown`` is learned from paragraphs of the corpus, a bounded
sample (one run of words of about ``NEGATIVES`` blocks, those with the smallest hashes) without those half like a
template, and from ``SYNTHETIC`` seeded runs of made-up words.  A fifth of all examples is held out and calibrates: one temperature divides the scores, the one of a grid with the smallest held-out log loss, and each
family gets the smallest probability at which at most ``FALSE_RATE`` of the held-out unknowns pass.

A paragraph has one row per family, with the best run's share and probability.  A notice of another family's words
beside it (``All rights reserved.`` above a BSD text) is a row of its own.

Defined results: a null or blank text has no paragraphs; equal rows give equal results; null ids are carried along;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from barforge.llm.common import save

#: usual notices by family (fixed values: licence texts must be quoted as they are)
TEMPLATES = {
    "apache": ("Licensed under the Apache License, Version 2.0.",
               "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
               "SPDX-License-Identifier: Apache-2.0"),
    "mit": ("Released under the MIT License.",
            "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
            "SPDX-License-Identifier: MIT"),
    "gpl": ("This work is licensed under the GNU General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
            "SPDX-License-Identifier: GPL-3.0-or-later"),
    "cc_by_nc": ("Licensed under CC BY-NC 4.0.",
                 "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
                 "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "cc_by": ("Licensed under CC BY 4.0.",
              "This work is licensed under a Creative Commons Attribution 4.0 International License.",
              "SPDX-License-Identifier: CC-BY-4.0"),
    "bsd": ("Licensed under the BSD 3-Clause License.",
            "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
            "SPDX-License-Identifier: BSD-3-Clause"),
    "proprietary": ("All rights reserved.",
                    "Copyright. All rights reserved.",
                    "Copyright (c) 2024 Example Inc. All rights reserved.",
                    "Unauthorized copying of this file, via any medium, is strictly prohibited",
                    "No part of this publication may be reproduced or transmitted in any form without prior written permission of the publisher"),
}
#: how a licence is named behind ``licensed under`` and the like; numbers stand for any version
NAMES = {
    "apache": ("the Apache License", "Apache License", "the Apache Software License", "the Apache 2.0", "Apache 2.0", "Apache-2.0"),
    "mit": ("the MIT License", "MIT License", "MIT", "the MIT/X11 License", "the X11 License", "the Expat License", "an MIT-style license", "a MIT-style license"),
    "gpl": ("the GNU General Public License", "GNU General Public License", "the GNU GPL", "GNU GPL", "the GPL", "GPL", "the GPLv3", "GPLv3", "the GPL-3.0", "GPL-3.0",
            "the GNU GPLv3", "GNU GPLv3", "the terms of the GNU General Public License", "the terms of the GNU GPL", "the terms of the GPL"),
    "cc_by_nc": (*[f"{x}{y}" for x in ("CC BY-NC", "CC-BY-NC") for y in (" 4.0", "-SA 4.0", "-ND 4.0")], "CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0", "CC BY NC 4.0",
                 *[f"{x} Creative Commons Attribution-NonCommercial{y}" for x in ("a", "the") for y in ("", "-ShareAlike", "-NoDerivs", "-NoDerivatives")]),
    "cc_by": ("CC BY 4.0", "CC-BY 4.0", "CC-BY-4.0", *[f"{x} Creative Commons Attribution {y}" for x in ("a", "the") for y in ("4.0", "License")]),
    "bsd": ("the BSD 3-Clause", "BSD 3-Clause", "the 3-Clause BSD", "the BSD-3-Clause", "BSD-3-Clause", "the BSD License", "BSD License", "a BSD License", "a BSD-style license",
            "the New BSD License", "the Modified BSD License", "the Simplified BSD License", "the Revised BSD License"),
    "proprietary": ("a proprietary license", "a commercial license"),
}
#: SPDX identifiers by family
SPDX = {
    "apache": ("Apache-2.0",), "mit": ("MIT", "MIT-0", "MIT-Modern-Variant", "MIT-CMU", "MIT-feh", "MIT-advertising", "MIT-enna", "X11"),
    "gpl": ("GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0-with-classpath-exception"),
    "cc_by_nc": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"), "cc_by": ("CC-BY-4.0",),
    "bsd": ("BSD-3-Clause", "0BSD", "BSD-3-Clause-Clear", "BSD-2-Clause-Patent", "BSD-4-Clause-UC", "BSD-3-Clause-Attribution", "BSD-3-Clause-LBNL", "BSD-2-Clause-Views",
            "BSD-Source-Code", "BSD-Protection"),
    "proprietary": ("LicenseRef-Proprietary", "LicenseRef-Commercial"),
}
VERBS = ("Licensed under", "Released under", "Distributed under", "Available under", "Published under")
FAMILIES = ("unknown", *sorted(TEMPLATES))
#: the quoted notices, and those made of verbs, names and identifiers
MADE = {f: tuple(dict.fromkeys([*(f"{v} {n}" for v in VERBS for n in NAMES[f]), *(f"SPDX-License-Identifier: {x}" for x in SPDX[f])])) for f in TEMPLATES}
#: shingles without which a template is another licence (Lesser or Affero GPL, share-alike), numbers masked
NEEDED = {("gnu", "general"), ("gnu", "gpl"), ("commons", "attribution"), ("commons", "attribution-noncommercial")}
WINDOW = 56
FEATURES = 1 << 15
NEGATIVES = 20_000
#: runs of made-up words among the unknowns, so that a corpus of notices only has unknowns too
SYNTHETIC = 400
VARIANTS = 60
MADE_VARIANTS = 12
TEMPERATURES = (0.5, 0.7, 1.0, 1.4, 2.0, 2.8, 4.0)
FALSE_RATE = 0.001
CONFIRM = 0.8
SEED = 42


def tokens(text: Column) -> Column:
    """Lower-case runs of letters, digits and the marks inside licence names; numbers masked as 0."""
    plain = F.replace(F.regexp_replace(F.lower(text), r"[0-9]+(\.[0-9]+)*", "0"), F.lit("licence"), F.lit("license"))
    return F.regexp_extract_all(plain, F.lit(r"([\p{L}\p{N}]+(?:[.\-][\p{L}\p{N}]+)*)"), F.lit(1))


def shingles(words: Column) -> Column:
    """Two-word shingles; a single word is one itself."""
    pairs = F.transform(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), lambda w, i: F.concat_ws(" ", w, F.get(words, i + 1)))
    return F.when(F.size(words) > 1, pairs).otherwise(words)


def with_grams(df: DataFrame, text: str) -> DataFrame:
    """Add words ``w`` and one- and two-word grams ``g``."""
    return df.withColumn("w", tokens(F.col(text))).withColumn("g", F.array_distinct(F.concat("w", shingles(F.col("w")))))


def paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, paragraph number, text) of every block between blank lines that has a word."""
    blocks = F.split(F.coalesce(F.col(f"`{text_col}`"), F.lit("")), r"\n[ \t\r]*\n")
    return (docs.select(F.col(f"`{id_col}`").alias("id"), F.posexplode(blocks).alias("paragraph", "line"))
            .where(F.col("line").rlike(r"[\p{L}\p{N}]")))


def masked(text: str) -> list[str]:
    """The words of a text as ``tokens`` makes them; each identifier of an SPDX expression behind its own tag."""
    plain = re.sub(r"[0-9]+(?:\.[0-9]+)*", "0", text.lower()).replace("licence", "license")
    words = re.findall(r"[^\W_]+(?:[.\-][^\W_]+)*", plain)
    if SPDX_TAG not in plain:
        return words
    out, tagged = [], False
    for w in words:
        # tag, identifier, then "or" / "and" an identifier or "with" an exception
        if tagged and len(out) > 1 and out[-2] == SPDX_TAG and w in ("or", "and"):
            out.append(SPDX_TAG)
        elif tagged and len(out) > 3 and out[-2] == "with" and out[-4] == SPDX_TAG and w in ("or", "and"):
            out.append(SPDX_TAG)
        else:
            out.append(w)
            tagged = tagged or w == SPDX_TAG
    return out


SPDX_TAG = "spdx-license-identifier"


def _pairs(text: str) -> set[tuple[str, str]]:
    w = masked(text)
    return set(zip(w, w[1:]))


def _table() -> tuple[list[tuple[str, int, frozenset]], dict[tuple[str, str], list[int]]]:
    """Templates (family, number of shingles, needed ones) and, by shingle, the templates that hold it."""
    known, index = [], defaultdict(list)
    for family in sorted(TEMPLATES):
        for pairs in sorted({tuple(sorted(_pairs(t))) for t in (*TEMPLATES[family], *MADE[family])}):
            for p in pairs:
                index[p].append(len(known))
            known.append((family, len(pairs), frozenset(NEEDED.intersection(pairs))))
    return known, dict(index)


KNOWN, INDEX = _table()


def _hits(words: list[str]) -> dict[int, list[tuple[int, tuple[str, str]]]]:
    """By template, place and shingle of its shingles among the words."""
    found = defaultdict(list)
    for i, p in enumerate(zip(words, words[1:])):
        for t in INDEX.get(p, ()):
            found[t].append((i, p))
    return found


def best_share(words: list[str]) -> float:
    """Best share of a template's shingles that the words contain."""
    return max((len({p for _, p in h}) / KNOWN[t][1] for t, h in _hits(words).items()), default=0.0)


def runs(words: list[str]) -> list[tuple[str, float, str]]:
    """(family, share, words) of the runs that hold a template, for a family the best of those that overlap."""
    found = set()
    for t, hits in _hits(words).items():
        family, size, needed = KNOWN[t]
        least = CONFIRM * size - 1e-9
        if len({p for _, p in hits}) < least:
            continue
        inside, left = Counter(), 0
        for i, p in hits:
            inside[p] += 1
            # the shortest run that ends here: no longer than WINDOW, beginning with a shingle it needs
            while i + 2 - hits[left][0] > WINDOW or inside[hits[left][1]] > 1:
                q = hits[left][1]
                inside[q] -= 1
                if not inside[q]:
                    del inside[q]
                left += 1
            if len(inside) >= least and all(q in inside for q in needed):
                found.add((-len(inside) / size, -len(inside), hits[left][0], i + 2, family))
    taken: dict[str, set[int]] = defaultdict(set)
    out = []
    for share, _, start, end, family in sorted(found):
        if taken[family].isdisjoint(range(start, end)):
            taken[family].update(range(start, end))
            out.append((family, -share, " ".join(words[start:end])))
    return out


def candidates(lines: DataFrame) -> DataFrame:
    """(id, paragraph, row, named, similarity, line): the runs of every block; row numbers the blocks."""
    blocks = lines.select("id", "paragraph", F.monotonically_increasing_id().alias("row"), "line")
    schema = StructType([*blocks.schema.fields[:3], StructField("named", StringType()), StructField("similarity", DoubleType()), StructField("line", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [(i, *r) for i, text in enumerate(b.column(3)) for r in runs(masked(text.as_py()))]
            at = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in range(3)], pa.array([x[1] for x in found], pa.string()),
                                              pa.array([x[2] for x in found], pa.float64()), pa.array([x[3] for x in found], pa.string())], schema.names)

    return save(blocks.mapInArrow(run, schema), "license-runs")


def _sample_run(texts: pd.Series, hashes: pd.Series) -> pd.DataFrame:
    """A run of 4 to WINDOW words of each text and the best share of a template in it."""
    out = []
    for text, h in zip(texts, hashes):
        w = masked(text)
        n = 4 + int(h) % (WINDOW - 3)
        at = int(h) // WINDOW % max(1, len(w) - n + 1)
        out.append((" ".join(w[at:at + n]), best_share(w[at:at + n])))
    return pd.DataFrame(out, columns=["line", "share"])


def examples(spark: SparkSession, lines: DataFrame) -> DataFrame:
    """Labelled training paragraphs: (label, text, part) with part 0..4, 0 held out."""
    # the share of all hashes that holds about NEGATIVES paragraphs
    total = lines.count()
    share = min(1.0, NEGATIVES / max(total, 1))
    h = F.xxhash64(F.lit(SEED), "id", "paragraph", "line")
    some = save(lines.select("line", h.alias("h")).where(F.col("h") < int(-(1 << 63) + share * ((1 << 64) - 1025))), "sample")
    some = save(some.select(F.pandas_udf(_sample_run, "line string, share double")("line", "h").alias("t"), "h").select("t.line", "t.share", "h"), "unknown-paragraphs").where("share < 0.5").select(F.lit(0.0).alias("label"), F.col("line").alias("text"), "h")
    fillers = F.lit(["see the file for details", "all files here", "note", "text and images", "the following holds", "contact the authors", ""])
    word = lambda k: F.substring(F.translate(F.md5(F.concat_ws(":", F.lit(SEED), "id", k)), "0123456789", "ghijklmnop"), 1, 2 + k % 7)
    made = spark.range(SYNTHETIC).select(F.lit(0.0).alias("label"), F.array_join(F.transform(F.sequence(F.lit(1), 4 + (F.col("id") % (WINDOW - 3)).cast("int")), word), " ").alias("text"),
                                         F.xxhash64(F.lit(SEED), "id").alias("h"))
    notes = spark.createDataFrame([(float(FAMILIES.index(f)), t, n - 1) for table, n in ((TEMPLATES, VARIANTS), (MADE, MADE_VARIANTS)) for f, ts in table.items() for t in ts],
                                  "label double, notice string, last int")
    varied = notes.withColumn("n", F.explode(F.sequence(F.lit(0), "last"))).withColumn("h", F.xxhash64(F.lit(SEED), "notice", "n"))
    pick = lambda salt, n: F.pmod(F.xxhash64("h", F.lit(salt)), F.lit(n)).cast("int")
    w = F.split("notice", " ")
    left_out = F.array_join(F.filter(w, lambda x, i: (F.size(w) < 6) | (i != F.pmod(F.xxhash64(F.col("h"), F.lit(3)), F.size(w)))), " ")
    varied = varied.select("label", F.concat_ws(" ", F.get(fillers, pick(1, 7)), F.when(pick(4, 2) == 0, F.col("notice")).otherwise(left_out),
                                                F.get(fillers, pick(2, 7))).alias("text"), "h")
    return some.unionByName(made).unionByName(varied).withColumn("part", F.pmod("h", F.lit(5)))


class Model:
    """The classifier with its calibration: temperature and the least probability of each family."""

    def __init__(self, regression: LogisticRegressionModel, temperature: float = 1.0, least: dict[str, float] | None = None):
        self.regression, self.temperature, self.least = regression, temperature, least or {}
        self.hashing = HashingTF(inputCol="g", outputCol="features", numFeatures=FEATURES, binary=True)

    def scores(self, df: DataFrame) -> DataFrame:
        """Add ``raw``: a score per class."""
        out = self.regression.transform(self.hashing.transform(with_grams(df, "line")))
        return out.withColumn("raw", vector_to_array("rawPrediction")).drop("features", "rawPrediction", "g", "w")

    @staticmethod
    def probabilities(raw: Column, temperature: float) -> Column:
        top = F.array_max(raw)
        e = F.transform(raw, lambda x: F.exp((x - top) / temperature))
        return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))

    def predict(self, df: DataFrame) -> DataFrame:
        """Add family and probability of paragraphs (column line)."""
        p = self.scores(df).withColumn("p", self.probabilities(F.col("raw"), self.temperature))
        best = F.array_max(F.transform("p", lambda x, i: F.struct(x.alias("probability"), i.alias("i"))))
        p = p.withColumn("best", best)
        names, least = F.lit(list(FAMILIES)), F.lit([self.least.get(f, 1.1) for f in FAMILIES])
        sure = F.col("best.probability") >= F.get(least, F.col("best.i"))
        return (p.withColumn("family", F.when(sure, F.get(names, F.col("best.i"))).otherwise("unknown"))
                .withColumn("probability", F.col("best.probability")).drop("raw", "p", "best"))


def train(spark: SparkSession, lines: DataFrame) -> Model:
    """Fit and calibrate on templates and a bounded sample of the paragraphs."""
    rows = save(examples(spark, lines), "license-examples")
    data = with_grams(rows.withColumnRenamed("text", "line"), "line")
    hashing = HashingTF(inputCol="g", outputCol="features", numFeatures=FEATURES, binary=True)
    weight = F.when(F.col("label") == 0, 1.0).otherwise(5.0)
    fitted = LogisticRegression(family="multinomial", maxIter=40, regParam=1e-4, weightCol="weight").fit(
        hashing.transform(data.where("part <> 0").withColumn("weight", weight)))
    fitted.setProbabilityCol("").setPredictionCol("")  # the calibrated ones are made here
    model = Model(fitted)
    held = save(model.scores(rows.where("part = 0").withColumnRenamed("text", "line")).select("label", "raw"), "held-out")
    chance = lambda t: F.get(Model.probabilities(F.col("raw"), t), F.col("label").cast("int"))
    losses = held.agg(*[F.avg(-F.log(F.greatest(chance(t), F.lit(1e-12)))).alias(f"t{i}") for i, t in enumerate(TEMPERATURES)]).first()
    temperature = min(zip([x if x is not None else float("inf") for x in losses], TEMPERATURES))[1]
    # the probability that all but FALSE_RATE of the held-out unknowns stay below, and one half at least
    p = Model.probabilities(F.col("raw"), temperature)
    cuts = held.where("label = 0").select(p.alias("p")).agg(*[
        F.percentile(F.get("p", i), F.lit(1 - FALSE_RATE)).alias(f) for i, f in enumerate(FAMILIES) if i]).first()
    least = {f: max(0.5, float(cuts[f] or 0.0)) for f in FAMILIES[1:]}
    return Model(fitted, temperature, least)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per paragraph and licence family that it states: id_col, paragraph, family, probability, similarity."""
    spark = docs.sparkSession
    lines = paragraphs(docs, id_col, text_col)
    model = model or train(spark, lines)
    # written before it is filtered: a filter would be pushed down and evaluate the classifier twice
    named = save(model.predict(candidates(lines)).select("id", "paragraph", "row", "named", "family", "probability", "similarity"), "named")
    best = named.where("named = family").groupBy("row", "family").agg(
        F.first("id").alias("id"), F.first("paragraph").alias("paragraph"), F.max(F.struct("similarity", "probability")).alias("b"))
    return best.select(F.col("id").alias(id_col), "paragraph", "family", "b.probability", "b.similarity")
