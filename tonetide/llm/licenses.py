"""License scan with a trained paragraph classifier.

A paragraph is a window of a text's words, as long as a known text and laid over it at every word the
two may share, so neither line ends nor the words around it matter. It is described by its word 1- to
3-grams, hashed into a sparse vector, and a multinomial logistic regression names its license family
or ``unknown``. The model learns from
varied copies of known texts; paragraphs of the corpus and shuffled license words teach it the
unknown class. Its scores are calibrated on examples kept apart: one temperature for all classes,
and a cut that one in a hundred unknown paragraphs passes. A prediction stands only if the
paragraph also holds most words of a known text of that family.

That comparison allows an exact shortcut: a window without any of a text's few longest words cannot
hold most of its words. So windows are laid at these words only, and only those that hold most words
of the known text they are as long as are classified. Only DataFrame and Spark ML functions run here.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tonetide.llm.shared import bounded_sample, stored

FEATURES = 1 << 14
VARIANTS = 24
SAMPLE_DOCUMENTS = 256
SAMPLE_LINES = 4
COVERAGE = 0.6
PASSING_UNKNOWN = 0.01
UNKNOWN = "unknown"
_TEMPERATURES = (0.5, 0.75, 1.0, 1.5, 2.0)

# Notices and characteristic sentences of well-known licenses, by family.
TEXTS = {
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT license.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    "apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GPL.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "agpl": (
        "Licensed under the GNU Affero General Public License.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "bsd": (
        "Released under the BSD license.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "mpl-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "If a copy of the MPL was not distributed with this file, You can obtain one at mozilla.org/MPL/2.0.",
    ),
    "isc": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "public-domain": (
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related rights to this work (CC0).",
        "Released into the public domain.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this work may be reproduced without permission.",
    ),
}

# Words common in prose; others of a text are looked for first.
COMMON = set(
    "a all an and any are as at be by can either for from has have in is it its may no not of on or "
    "should that the this to under was with without work you".split()
)


def words(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _plain(text: str) -> list[str]:
    """The same for a known text, which is ASCII."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def _anchors_of(text: str, coverage: float) -> list[str]:
    """Words of which every paragraph that covers a known text holds one.

    To hold ceil(coverage * n) of n words, a paragraph can miss all but one of any
    n - ceil(coverage * n) + 1 words at most; those that are rare in prose are taken, longest first.
    """
    own = sorted(set(_plain(text)), key=lambda w: (w in COMMON, -len(w), w))
    need = -int(-coverage * len(own) // 1)
    return own[: len(own) - need + 1]


def _anchors(coverage: float) -> list[str]:
    """The same for any of the known texts."""
    every = (t for texts in TEXTS.values() for t in texts)
    return sorted({w for t in every for w in _anchors_of(t, coverage)})


def _places(coverage: float) -> Column:
    """Map from each anchor to where it stands: ``text`` (index), ``at``, and the text's ``long``."""
    found: dict[str, list[Column]] = {}
    for n, text in enumerate(t for texts in TEXTS.values() for t in texts):
        own, anchors = _plain(text), set(_anchors_of(text, coverage))
        for at, word in enumerate(own):
            if word in anchors:
                place = (n, at, len(own))
                entry = F.struct(*[F.lit(x).alias(k) for x, k in zip(place, ("text", "at", "long"))])
                found.setdefault(word, []).append(entry)
    return F.create_map(*[x for w, at in sorted(found.items()) for x in (F.lit(w), F.array(*at))])


def _windows(all_words: str, coverage: float) -> Column:
    """``start words`` of every window that holds ``coverage`` of the words of its known text.

    A window starts where the known text would, if an anchor of the text were the one found; what
    lies before the first word is cut off.
    """
    texts, places, anchors = _texts(), _places(coverage), _anchors(coverage)
    numbered = F.transform(all_words, lambda w, i: F.struct(w.alias("w"), i.alias("i")))
    hits = F.filter(numbered, lambda h: h["w"].isin(anchors))
    starts = F.array_distinct(
        F.flatten(
            F.transform(
                hits,
                lambda h: F.transform(
                    F.element_at(places, h["w"]),
                    lambda p: F.struct(
                        (h["i"] - p["at"]).alias("start"), p["text"].alias("text"), p["long"].alias("long")
                    ),
                ),
            )
        )
    )
    cut = F.transform(
        starts,
        lambda s: F.struct(
            F.greatest(s["start"], F.lit(0)).alias("start"),
            F.slice(
                F.col(all_words),
                F.greatest(s["start"], F.lit(0)) + 1,
                s["long"] + F.least(s["start"], F.lit(0)),
            ).alias("words"),
            s["text"].alias("text"),
        ),
    )
    held = F.filter(
        cut,
        lambda x: _let(
            F.element_at(texts, x["text"] + 1)["own"],
            lambda own: F.size(F.array_intersect(own, x["words"])) >= F.size(own) * coverage,
        ),
    )
    return F.array_distinct(
        F.transform(held, lambda x: F.struct(x["start"].alias("start"), x["words"].alias("words")))
    )


def _line_of(start: str) -> Column:
    """The line, from 0, of column ``text`` that holds its word number ``start``."""

    def passed(a: Column, line: Column) -> Column:
        seen = a["seen"] + F.size(words(line))
        return F.struct(
            seen.alias("seen"), (a["line"] + F.when(seen <= F.col(start), 1).otherwise(0)).alias("line")
        )

    first = F.struct(F.lit(0).alias("seen"), F.lit(0).alias("line"))
    return F.aggregate(F.split("text", "\n"), first, passed)["line"]


def _known(spark: SparkSession) -> DataFrame:
    """``family template words`` of the known texts."""
    rows = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(f"{family}/{i}").alias("template"),
            F.array(*[F.lit(w) for w in _plain(text)]).alias("words"),
        )
        for family, texts in TEXTS.items()
        for i, text in enumerate(texts)
    ]
    return spark.range(1).select(F.explode(F.array(*rows)).alias("t")).select("t.*")


def _texts() -> Column:
    """The known texts with their distinct words, as an array."""
    rows = [
        F.struct(
            F.lit(family).alias("family"),
            F.lit(f"{family}/{i}").alias("template"),
            F.array(*[F.lit(w) for w in sorted(set(_plain(text)))]).alias("own"),
        )
        for family, texts in TEXTS.items()
        for i, text in enumerate(texts)
    ]
    return F.array(*rows)


def _most_covered(texts: Column) -> Column:
    """``share template`` of the text of which column ``words`` holds the largest share."""
    return F.array_max(
        F.transform(
            texts,
            lambda t: F.struct(
                (F.size(F.array_intersect(t["own"], F.col("words"))) / F.size(t["own"])).alias("share"),
                t["template"].alias("template"),
            ),
        )
    )


def _lines(docs: DataFrame) -> DataFrame:
    """Lines of a bounded sample of documents, at most ``SAMPLE_LINES`` of each.

    Lines that hold most words of a known text are no examples of the unknown class.
    """
    sample = bounded_sample(
        docs.where(F.col("text").isNotNull()), "doc_id", F.lit(0), SAMPLE_DOCUMENTS
    )
    lines = F.slice(F.split("text", "\n"), 1, SAMPLE_LINES)
    listed = sample.select(F.explode(lines).alias("__line"))
    listed = listed.select(words(F.col("__line")).alias("words")).where(F.size("words") > 0)
    return listed.where(_most_covered(_texts())["share"] < COVERAGE)


def _examples(docs: DataFrame) -> DataFrame:
    """``family words apart``: varied copies of known texts, and unknown paragraphs."""
    spark = docs.sparkSession
    lines = stored(_lines(docs))
    numbered = lines.select("words", F.pmod(F.xxhash64("words"), F.lit(64)).alias("__n"))
    context = numbered.groupBy("__n").agg(F.min("words").alias("context"))
    varied = _known(spark).withColumn("v", F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))))
    varied = varied.withColumn(
        "__n", F.pmod(F.xxhash64("template", "v"), F.lit(64))
    ).join(context, "__n", "left")
    # Drop up to two words in ten, and put every other copy into a paragraph of the corpus.
    thin = F.filter("words", lambda w, i: F.pmod(F.xxhash64(w, i, "v"), F.lit(10)) >= F.col("v") % 3)
    around = F.coalesce(F.slice("context", 1, 12), F.array().cast("array<string>"))
    copies = varied.select(
        "family", F.when(F.col("v") % 2 == 1, F.concat(around, thin)).otherwise(thin).alias("words")
    )
    shuffled = F.transform(
        F.array_sort(F.transform("words", lambda w, i: F.struct(F.xxhash64(w, i, "v").alias("o"), w.alias("w")))),
        lambda x: x["w"],
    )
    mixed_up = varied.where(F.col("v") < 3).select(
        F.lit(UNKNOWN).alias("family"), F.concat(around, F.slice(shuffled, 1, 6)).alias("words")
    )
    plain = lines.select(F.lit(UNKNOWN).alias("family"), "words")
    every = copies.unionByName(mixed_up).unionByName(plain)
    return every.withColumn("apart", F.pmod(F.xxhash64("words", "family"), F.lit(4)) == 0)


def _grams(words_: Column) -> Column:
    """Word 1- to 3-grams."""

    def of(n: int) -> Column:
        at = F.sequence(F.lit(1), F.size(words_) - (n - 1))
        grams = F.transform(at, lambda i: F.concat_ws(" ", F.slice(words_, i, n)))
        return F.when(F.size(words_) >= n, grams).otherwise(F.array().cast("array<string>"))

    return F.concat(words_, of(2), of(3))


def _featured(df: DataFrame) -> DataFrame:
    grams = df.withColumn("__grams", _grams(F.col("words")))
    hashing = HashingTF(numFeatures=FEATURES, binary=True, inputCol="__grams", outputCol="__features")
    return hashing.transform(grams).drop("__grams")


@dataclass(frozen=True)
class Scanner:
    model: LogisticRegressionModel
    families: list[str]
    temperature: float
    cut: float


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often and where ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def _softened(scores: Column, temperature: float) -> Column:
    """exp of each score below the greatest one, over the temperature."""

    def with_top(s: Column) -> Column:
        return _let(F.array_max(s), lambda top: F.transform(s, lambda x: F.exp((x - top) / temperature)))

    return _let(scores, with_top)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _best(model, families: list[str], featured: DataFrame, temperature: float) -> DataFrame:
    """Add ``__best``: the likeliest license family, its calibrated probability, and ``license``,
    the probability that the paragraph is of any family."""

    def named(chances: Column) -> Column:
        own = F.zip_with(
            F.slice(chances, 1, len(families) - 1),
            F.array(*[F.lit(f) for f in families[:-1]]),
            lambda p, f: F.struct(
                p.alias("probability"), f.alias("family"), (1 - chances[len(families) - 1]).alias("license")
            ),
        )
        return F.array_max(own)

    def divided(e: Column) -> Column:
        return _let(_sum(e), lambda total: F.transform(e, lambda x: x / total))

    raw = vector_to_array(F.col("__raw"))
    chances = _let(_softened(raw, temperature), divided)
    return model.transform(featured).withColumn("__best", _let(chances, named))


def fit(docs: DataFrame) -> Scanner:
    """Train and calibrate on the known texts and a bounded sample of lines of ``docs``."""
    families = [*TEXTS, UNKNOWN]
    index = F.create_map(*[x for i, f in enumerate(families) for x in (F.lit(f), F.lit(float(i)))])
    examples = _examples(docs).withColumn("label", F.element_at(index, F.col("family")))
    examples = stored(_featured(examples).coalesce(4))
    model = LogisticRegression(
        featuresCol="__features", labelCol="label", rawPredictionCol="__raw",
        probabilityCol="__probability", predictionCol="__prediction",
        regParam=1e-3, maxIter=30, family="multinomial",
    ).fit(examples.where(~F.col("apart")))
    apart = examples.where("apart")
    losses = []
    raw = model.transform(apart).select("label", vector_to_array(F.col("__raw")).alias("s"))
    for t in _TEMPERATURES:
        own = F.element_at("s", (F.col("label") + 1).cast("int")) - F.array_max("s")
        losses.append(F.avg(F.log(_sum(_softened(F.col("s"), t))) - own / t))
    loss = list(raw.agg(*losses).first())
    best = min(range(len(loss)), key=lambda i: (loss[i] is None, loss[i] or 0.0))
    temperature = _TEMPERATURES[best]
    unknown = _best(model, families, apart.where(F.col("family") == UNKNOWN), temperature)
    cut = unknown.agg(F.percentile("__best.license", 1 - PASSING_UNKNOWN)).first()[0]
    return Scanner(model, families, temperature, max(0.5, min(0.95, cut or 0.5)))


def scan(docs: DataFrame, scanner: Scanner, coverage: float = COVERAGE) -> DataFrame:
    """One row per license paragraph:
    ``doc_id paragraph family probability license template coverage``.

    ``paragraph`` is the line, from 0, on which the license text begins, ``probability`` is the
    family's and ``license`` that of any license, which must reach the scanner's cut; ``template``
    is the known text of which the window holds the largest share, ``coverage`` that share. Of several
    windows that begin on a line, the one with the largest share counts, then the likeliest, then
    the family that is last by name. A text of one line, however long, thus gives one row. Null and
    empty texts have no paragraphs; rows that repeat an id are scanned each. Texts are not shuffled;
    windows that hold most of a known text are written once.
    """
    listed = (
        # The row's number also keeps the optimizer from splitting a text twice to filter it first.
        docs.withColumn("__row", F.monotonically_increasing_id())
        .select("doc_id", "text", "__row", words(F.col("text")).alias("__words"))
        .select("doc_id", "text", "__row", F.explode(_windows("__words", coverage)).alias("__window"))
        .select("doc_id", "text", "__row", "__window.start", "__window.words")
        .select("doc_id", "__row", _line_of("start").alias("paragraph"), "words")
    )
    scored = _best(
        scanner.model, scanner.families, _featured(stored(listed)), scanner.temperature
    )
    picked = scored.select("doc_id", "__row", "paragraph", "words", "__best.*").where(
        F.col("license") >= scanner.cut
    )
    own = F.filter(_texts(), lambda t: t["family"] == F.col("family"))
    result = ("family", "probability", "license", "template", "coverage")
    order = ("coverage", "license", "probability", "family", "template")
    return (
        picked.withColumn("__text", _most_covered(own))
        .where(F.col("__text.share") >= coverage)
        .withColumns({"template": F.col("__text.template"), "coverage": F.col("__text.share")})
        .groupBy("__row", "paragraph")
        .agg(F.first("doc_id").alias("doc_id"), F.max(F.struct(*order)).alias("__most"))
        .select("doc_id", "paragraph", *[F.col(f"__most.{c}").alias(c) for c in result])
    )
