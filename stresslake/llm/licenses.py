"""Licence scans by a trained paragraph classifier, scanning in SQL expressions only.

A paragraph is a line. Its word n-grams (one to three words) select weights of a
softmax regression over licence families and an unknown class; the probabilities are
calibrated by a temperature fitted on templates and paragraphs set aside. A family is predicted if
its probability reaches ``MIN_PROBABILITY``, and the prediction is confirmed if the
paragraph holds most of the n-grams of one of the family's templates.

Weights exist only for n-grams with a word that marks licences (an anchor). A
paragraph without an anchor has none of them and falls to the unknown class, so it
needs no scoring; this is exact, not a sample. The fit uses the templates and at most
``MAX_BACKGROUND`` paragraphs of the corpus; the scan reads every whole text.
"""

from __future__ import annotations

import random
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stresslake.llm.common import read, scan_array, smallest_hashes

# Usual notices by licence family, as published with the licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Released under the Apache License 2.0",
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted",
        "Released under the BSD 3-Clause License",
        "Use of this source code is governed by a BSD-style license",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License",
        "Licensed under CC BY 4.0",
        "SPDX-License-Identifier: CC-BY-4.0",
    ],
    "cc-by-nc": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License",
        "Licensed under CC BY-NC 4.0",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ],
    "cc-by-sa": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License",
        "Licensed under CC BY-SA 4.0",
        "SPDX-License-Identifier: CC-BY-SA-4.0",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "Released under the GPL version 2 or later",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 2.1",
        "Released under the LGPL version 3",
        "SPDX-License-Identifier: LGPL-2.1-only",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "Licensed under the Mozilla Public License 2.0",
        "SPDX-License-Identifier: MPL-2.0",
    ],
}
UNKNOWN = "unknown"
# Words that occur in templates but mark no licence by themselves.
COMMON_WORDS = {
    "0", "1", "2", "3", "4", "a", "an", "and", "any", "are", "as", "at", "be", "by", "charge",
    "code", "copy", "for", "form", "forms", "free", "general", "http", "in", "is", "it",
    "later", "may", "of", "only", "or", "org", "person", "public", "published", "s", "source",
    "style", "subject", "terms", "the", "this", "to", "under", "use", "v", "version", "with",
    "without", "work", "www", "you",
}
MAX_GRAM = 3
STEPS = 300
MAX_BACKGROUND = 2_000
MAX_BACKGROUND_CHARS = 5_000
MIN_PROBABILITY = 0.6
MIN_CONTAINED = 0.6
# A paragraph's words: runs of letters and digits in lower case.
GAP = r"[^\p{L}\p{N}]"
SEPARATOR = f"{GAP}+"


def words_of(line: str) -> list[str]:
    return [w for w in re.split(r"[\W_]+", line.lower()) if w]


def grams_of(words: list[str]) -> set[str]:
    return {
        " ".join(words[i:i + n]) for n in range(1, MAX_GRAM + 1) for i in range(len(words) - n + 1)
    }


@dataclass(frozen=True)
class LicenseModel:
    """Weights per n-gram (families, then unknown), bias, and what a scan needs beside."""

    families: list[str]
    anchors: list[str]
    weights: dict[str, list[float]]
    bias: list[float]
    # Of the softmax over all classes, and of a family against unknown alone.
    temperature: float
    pair_temperature: float
    templates: list[tuple[str, list[str]]]


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def fit(background: list[str], templates: dict[str, list[str]] | None = None, seed: int = 7) -> LicenseModel:
    """Train on variants of the templates against other paragraphs.

    Variants drop words and add foreign ones around a notice. Unknown paragraphs are
    the background (lines that hold no template), and lines that mix a few anchors
    with other words, so a lone word is not taken for a licence.
    """
    templates = templates or TEMPLATES
    rng = random.Random(seed)
    families = sorted(templates)
    texts = {f: [words_of(t) for t in templates[f]] for f in families}
    anchors = sorted({w for ts in texts.values() for t in ts for w in t if w not in COMMON_WORDS})
    known = set(anchors)
    foreign = sorted({w for line in background for w in words_of(line)} - known)[:5_000] or ["text"]
    variants: list[tuple[list[str], int, str]] = []
    others: list[tuple[list[str], int]] = []
    for label, family in enumerate(families):
        for words in texts[family]:
            for drop in (0, 0, 0, 0.05, 0.1, 0.15):
                kept = [w for w in words if rng.random() >= drop]
                around = [[rng.choice(foreign) for _ in range(rng.choice((0, 0, 3, 8)))] for _ in range(2)]
                variants.append((around[0] + kept + around[1], label, " ".join(words)))
    unknown = len(families)
    whole = [" ".join(t) for ts in texts.values() for t in ts]
    for line in background:
        words = words_of(line)
        if not any(t in " ".join(words) for t in whole):
            others.append((words, unknown))
    for anchor in anchors:
        for _ in range(3):
            words = [rng.choice(foreign) for _ in range(rng.randint(2, 12))]
            for a in (anchor, rng.choice(anchors))[:rng.randint(1, 2)]:
                words.insert(rng.randint(0, len(words)), a)
            others.append((words, unknown))
    # Only n-grams of templates that hold an anchor carry weight.
    vocabulary = sorted(
        g for g in set().union(*(grams_of(t) for ts in texts.values() for t in ts)) if known & set(g.split())
    )
    at = {g: i for i, g in enumerate(vocabulary)}
    target_of = lambda words: [at[g] for g in grams_of(words) if g in at]

    def solve(part: list[tuple[list[str], int]]) -> tuple[np.ndarray, np.ndarray]:
        x = _presence([target_of(words) for words, _ in part], len(vocabulary))
        target = np.eye(unknown + 1, dtype=np.float32)[[label for _, label in part]]
        w, b = np.zeros((len(vocabulary), unknown + 1), np.float32), np.zeros(unknown + 1, np.float32)
        for _ in range(STEPS):
            error = _softmax(x @ w + b) - target
            w -= 5 * (x.T @ error / np.float32(len(part)) + np.float32(1e-5) * w)
            b -= 5.0 * error.mean(0)
        return w, b

    rows = [(words, label) for words, label, _ in variants] + others
    rng.shuffle(rows)
    part = len(rows) * 4 // 5

    def margins(fitted: list[tuple[list[str], int]], held: list[tuple[list[str], int]]) -> tuple[np.ndarray, np.ndarray]:
        w, b = solve(fitted)
        z = _presence([target_of(words) for words, _ in held], len(vocabulary)) @ w + b
        return z, np.array([label for _, label in held], int)

    # Softmax: the scale that makes the paragraphs set aside most likely.
    z, labels = margins(rows[:part], rows[part:])
    scales = np.geomspace(0.25, 4, 33)
    likelihood = [np.log(_softmax(z / t)[np.arange(len(z)), labels] + 1e-12).mean() for t in scales]
    # A family against unknown, on templates that the weights were not fitted on: one of
    # each family and a fifth of the other paragraphs are set aside.
    last = {(label, " ".join(texts[f][-1])) for label, f in enumerate(families) if len(texts[f]) > 1}
    aside = [(words, label) for words, label, source in variants if (label, source) in last]
    seen = [(words, label) for words, label, source in variants if (label, source) not in last]
    part = len(others) * 4 // 5
    pair = calibrate(*margins(seen + others[:part], aside + others[part:]))
    w, b = solve(rows)
    return LicenseModel(
        families, anchors, {g: [float(v) for v in w[i]] for g, i in at.items()}, [float(v) for v in b],
        float(scales[int(np.argmax(likelihood))]), pair,
        [(f, sorted(grams_of(t))) for f in families for t in texts[f]],
    )


def _presence(places: list[list[int]], width: int) -> np.ndarray:
    x = np.zeros((len(places), width), np.float32)
    for i, found in enumerate(places):
        x[i, found] = 1
    return x


def calibrate(z: np.ndarray, labels: np.ndarray) -> float:
    """Scale of the margins that makes the labels likeliest, each family against unknown.

    For a row of a family that family is judged; for an unknown row the likeliest one.
    """
    if not len(z):
        return 1.0
    unknown = z.shape[1] - 1
    own = np.where(labels < unknown, labels, z[:, :unknown].argmax(1))
    margin = z[np.arange(len(z)), own] - z[:, unknown]
    sign = np.where(labels < unknown, 1.0, -1.0)
    scales = np.geomspace(0.25, 4, 33)
    loss = [np.logaddexp(0, -sign * margin / t).mean() for t in scales]
    return float(scales[int(np.argmin(loss))])


def train(docs: DataFrame, max_background: int = MAX_BACKGROUND, text: str = "text") -> LicenseModel:
    """Fit with a bounded number of the corpus's own paragraphs as background.

    One paragraph of each drawn document; a hash of the text draws both. Paragraphs of
    more than ``MAX_BACKGROUND_CHARS`` are not taken, which bounds the sample in size.
    """
    h = F.xxhash64(text)
    lines = F.filter(F.split(text, "\n", -1), lambda line: line != "")
    drawn = docs.select(h.alias("h"), lines.alias("lines")).where("size(lines) > 0").select(
        "h", F.element_at("lines", (F.pmod("h", F.size("lines")) + 1).cast("int")).alias("line")
    )
    short = drawn.where(F.length("line") <= MAX_BACKGROUND_CHARS)
    # Copies of a text share the hash and count once.
    folded = short.groupBy("h").agg(F.min("line").alias("line"))
    sample = smallest_hashes(folded, "h", max_background, docs.count())
    return fit([r["line"] for r in sample.collect()])


def _literal_map(model: LicenseModel) -> Column:
    pairs = [
        x for gram, weights in model.weights.items()
        for x in (F.lit(gram), F.array(*[F.lit(v) for v in weights]))
    ]
    return F.create_map(*pairs)


def _grams(words: Column, known: Column) -> Column:
    """Distinct n-grams of an array of words, those that ``known`` lists."""
    size = F.size(words)

    def of(n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(size, F.lit(1))), lambda i: i + n - 1 <= size)
        return F.transform(starts, lambda i: F.array_join(F.slice(words, i, F.lit(n)), " "))

    return F.array_intersect(F.concat(*[of(n) for n in range(1, MAX_GRAM + 1)]), known)


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), SEPARATOR), lambda w: w != "")


def _distinctive(model: LicenseModel) -> dict[str, tuple[list[str], list[str]]]:
    """Per family the n-grams that name it and no other: all, and those of several words.

    They hold a word that marks at most four families; 'license' marks all of them.
    """
    grams = {f: set() for f in model.families}
    for family, template in model.templates:
        grams[family].update(template)
    marks = {a for a in model.anchors if sum(a in g for g in grams.values()) <= 4}
    out = {}
    for family, own in grams.items():
        others = set().union(*(g for f, g in grams.items() if f != family))
        found = sorted(g for g in own - others if marks & set(g.split()))
        out[family] = (found, [g for g in found if " " in g])
    return out


def _scored(
    docs: DataFrame, model: LicenseModel, parts: Column, keep, gap: int, name: str, temperature: float,
) -> DataFrame:
    """``docs`` with an array of the parts that hold an anchor, with n-grams and e.

    ``parts`` cover the text with ``gap`` characters between; ``keep`` tells from a
    part's text whether it is wanted. ``e`` are the exponentials of the margins.
    Other n-grams than those of the templates have no weight and confirm nothing.
    """
    weights = _literal_map(model)
    known = F.array(*[F.lit(g) for g in sorted(set().union(model.weights, *(t for _, t in model.templates)))])
    bias = F.array(*[F.lit(v) for v in model.bias])

    # Places of the parts that hold an anchor, with their starts.
    # An anchor is a whole word: what is around it separates words.
    anchored = rf"(?:^|{GAP})(?:{'|'.join(map(re.escape, model.anchors))})(?![\p{{L}}\p{{N}}])"
    numbered = F.transform(parts, lambda line, i: F.struct(
        i.alias("line"), F.length(line).alias("size"),
        F.when(keep(line) & F.lower(line).rlike(anchored), line).alias("body"),
    ))
    def place(at: Column, part: Column) -> tuple[Column, Column]:
        end = at + part["size"]
        return end + gap, F.struct(
            part["line"].alias("line"), at.alias("start"), end.alias("end"), part["body"].alias("body"))

    placed = scan_array(
        numbered, F.lit(0).cast("bigint"), place, "struct<line:int,start:bigint,end:bigint,body:string>")
    out = docs.withColumn(name, F.filter(placed, lambda p: p["body"].isNotNull()))
    # Each step is a list of its own, so what it computes is not computed again later.
    out = out.withColumn(name, F.transform(name, lambda p: F.struct(
        p["line"].alias("line"), p["start"].alias("start"), p["end"].alias("end"),
        _words(p["body"]).alias("words"),
    )))
    out = out.withColumn(name, F.transform(name, lambda p: F.struct(
        p["line"].alias("line"), p["start"].alias("start"), p["end"].alias("end"),
        _grams(p["words"], known).alias("grams"),
    )))
    # Margins: the bias and the weights of the n-grams that have any.
    def margins(grams: Column) -> Column:
        known = F.filter(F.transform(grams, lambda g: F.try_element_at(weights, g)), lambda w: w.isNotNull())
        return F.aggregate(known, bias, lambda total, w: F.zip_with(total, w, lambda a, b: a + b))

    return out.withColumn(name, F.transform(name, lambda p: F.struct(
        p["line"].alias("line"), p["start"].alias("start"), p["end"].alias("end"), p["grams"].alias("grams"),
        F.transform(margins(p["grams"]), lambda z: F.exp(z / temperature)).alias("e"),
    )))


def _confirmed(model: LicenseModel, family: Column, grams: Column) -> Column:
    templates = F.array(*[
        F.struct(F.lit(f).alias("family"), F.array(*[F.lit(g) for g in t]).alias("grams"))
        for f, t in model.templates
    ])
    return F.exists(templates, lambda t: (t["family"] == family) & (
        F.size(F.array_intersect(t["grams"], grams)) >= MIN_CONTAINED * F.size(t["grams"])
    ))


def _lines(text: str) -> Column:
    return F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1)


def scan_licenses(docs: DataFrame, model: LicenseModel, text: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with an array of found licence lines, the likeliest family of each.

    Each has line (from 0), start and end (code points), family, probability and
    confirmed. NULL and empty texts have none. A column with the result's name is
    replaced; other columns and repeated rows stay. ``scan_notices`` finds more.
    """
    n_families = len(model.families)
    out = _scored(docs, model, _lines(text), lambda line: F.lit(True), 1, "_lines", model.temperature)
    names = F.array(*[F.lit(f) for f in model.families])

    def verdict(p: Column) -> Column:
        best = F.array_max(F.slice(p["e"], 1, n_families))
        total = F.aggregate(p["e"], F.lit(0.0), lambda a, v: a + v)
        family = F.element_at(names, F.array_position(p["e"], best).cast("int"))
        return F.struct(
            p["line"].alias("line"), p["start"].alias("start"), p["end"].alias("end"),
            family.alias("family"), (best / total).alias("probability"), p["grams"].alias("grams"),
        )

    out = out.withColumn("_lines", F.filter(F.transform("_lines", verdict), lambda p: p["probability"] >= MIN_PROBABILITY))
    return out.withColumn(name, F.transform("_lines", lambda p: F.struct(
        p["line"].alias("line"), p["start"].alias("start"), p["end"].alias("end"), p["family"].alias("family"),
        p["probability"].alias("probability"), _confirmed(model, p["family"], p["grams"]).alias("confirmed"),
    ))).drop("_lines")


def scan_notices(docs: DataFrame, model: LicenseModel, text: str = "text", name: str = "licenses") -> DataFrame:
    """``docs`` with an array of findings: every family of every line and paragraph.

    Each family is judged against unknown alone, so families do not compete, and needs
    an n-gram that names it and no other; one of several words to be confirmed. A
    paragraph, lines joined up to a blank one, adds the families that are confirmed in
    it and in none of its lines. A finding has start, end (code points), family,
    probability and confirmed.
    """
    unknown = len(model.families) + 1
    naming = _distinctive(model)
    families = F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(f).alias("family"), *[
            F.array(*[F.lit(g) for g in naming[f][k]]).cast("array<string>").alias(n) for k, n in enumerate(("any", "long"))
        ]) for i, f in enumerate(model.families, 1)
    ])

    def findings(p: Column) -> Column:
        def judged(f: Column) -> Column:
            own = F.element_at(p["e"], f["at"])
            return F.struct(
                p["start"].alias("start"), p["end"].alias("end"), f["family"].alias("family"),
                (own / (own + F.element_at(p["e"], F.lit(unknown)))).alias("probability"),
                (F.arrays_overlap(f["long"], p["grams"]) & _confirmed(model, f["family"], p["grams"])).alias("confirmed"),
            )

        named = F.filter(families, lambda f: F.arrays_overlap(f["any"], p["grams"]))
        return F.filter(F.transform(named, judged), lambda f: f["probability"] >= MIN_PROBABILITY)

    # Cut at the line end before a blank line; the blank one begins the next part.
    paragraphs = F.split(F.coalesce(F.col(text), F.lit("")), r"\n(?=[ \t\r]*+\n)", -1)
    warmth = model.pair_temperature
    out = _scored(docs, model, _lines(text), lambda line: F.lit(True), 1, "_lines", warmth)
    # An anchor is one word, so a text without one in any line has none in a paragraph.
    paragraphs = F.when(F.size("_lines") > 0, paragraphs).otherwise(F.array().cast("array<string>"))
    out = _scored(out, model, paragraphs, lambda part: part.rlike(r"\S[^\S\n]*+\n\s*+\S"), 1, "_parts", warmth)
    out = out.withColumns({n: F.flatten(F.transform(n, findings)) for n in ("_lines", "_parts")})

    def within(p: Column, outer: Column) -> Column:
        return (p["family"] == outer["family"]) & (p["start"] >= outer["start"]) & (p["end"] <= outer["end"])

    more = F.filter("_parts", lambda p: p["confirmed"] & ~F.exists(
        F.col("_lines"), lambda line: line["confirmed"] & within(line, p)))
    out = out.withColumn("_parts", more)
    # What a paragraph confirms, its lines need not predict.
    left = F.filter("_lines", lambda line: line["confirmed"] | ~F.exists(F.col("_parts"), lambda p: within(line, p)))
    return out.withColumn(name, F.array_sort(F.concat(left, F.col("_parts")))).drop("_lines", "_parts")


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: notices found, those confirmed, their families, and all findings."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan_notices(docs, train(docs)).drop("text")
    sure = F.filter("licenses", lambda p: p["confirmed"])
    return found.select(
        "doc_id", F.size("licenses").cast("long").alias("n_found"), F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda p: p["family"]))), ",").alias("families"),
        F.array_join(F.transform("licenses", lambda p: F.concat_ws(
            ":", p["family"], p["start"], p["end"], F.when(p["confirmed"], "confirmed").otherwise("predicted")
        )), ",").alias("findings"),
    )
