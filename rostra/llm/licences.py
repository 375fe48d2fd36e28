"""Licence families of paragraphs, by a trained classifier and a comparison with templates.

A multinomial logistic regression over word n-grams is fitted on the driver: on template paragraphs
with words left out at random, and, for the class "unknown", on a bounded sample of paragraphs of the
corpus. Its temperature is set on paragraphs kept out of the fit. The model is a table from n-gram to
weights, of a size that the templates bound. It becomes a literal of the plan, dealt into small maps by a hash of the
n-gram, so that a paragraph is scored inside its row: no join, no shuffle, and no rows beside the
documents' own. A paragraph is scored only if it holds a word that every feature it could have must hold one
of, since without a feature its class is unknown by the fit's construction. A prediction is confirmed if the
paragraph has most of the words and word pairs of one of the family's templates.

Paragraphs are what stands between blank lines, line ends inside counting as blanks, so licences wrapped to any
width are read alike. Those of more than ``WINDOW`` words are read in windows of so many words that start every
``STRIDE`` words and cover all of it. NULL and empty texts have none. Every row of the documents has its own
result, repeated ones and those with NULL identifiers too. An empty table gives an empty result.
"""

from __future__ import annotations

import json
import random
import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from rostra.llm.common import prepare, table

UNKNOWN = "unknown"
SAMPLE = 4000  # corpus paragraphs that teach the class unknown, at most one of a document
COPIES = 16  # variants of each template
NGRAM = 3
WINDOW, STRIDE = 80, 40  # words; a template has at most their difference
LEAST_PROBABILITY, LEAST_COVERAGE = 0.5, 0.6
COMMON, FEW = 0.01, 5  # n-grams in a larger share, and more, of the sampled paragraphs are no features; a feature has a word that is not so common
BUCKETS = 4096  # small maps of the model's literal

# Names of licences as notices give them.
NAMES = {
    "agpl": ["the GNU Affero General Public License, version 3", "the AGPL"],
    "apache": ["the Apache License, Version 2.0", "the Apache 2.0 license"],
    "bsd": ["the BSD 3-Clause License", "the BSD 2-Clause License", "a BSD-style license"],
    "cc-by": ["CC BY 4.0", "the Creative Commons Attribution 4.0 International License"],
    "cc-by-nc": ["CC BY-NC 4.0", "the Creative Commons Attribution-NonCommercial 4.0 License"],
    "cc-by-sa": ["CC BY-SA 4.0", "the Creative Commons Attribution-ShareAlike 4.0 License"],
    "cc0": ["CC0 1.0 Universal", "the CC0 public domain dedication"],
    "gpl": ["the GNU General Public License, version 3", "the GNU General Public License, version 2", "the GPL"],
    "isc": ["the ISC License"],
    "lgpl": ["the GNU Lesser General Public License, version 2.1", "the LGPL"],
    "mit": ["the MIT License", "an MIT-style license"],
    "mpl": ["the Mozilla Public License, version 2.0", "the MPL 2.0"],
    "unlicense": ["the Unlicense"],
}
NOTICES = ["Licensed under {}.", "This work is licensed under {}.", "Released under {}.", "This software is distributed under the terms of {}."]
# Sentences by which headers and licence texts themselves are known.
CLAUSES = {
    "agpl": [
        "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
        "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    ],
    "apache": [
        "you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND",
        "Apache License Version 2.0, January 2004 TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer",
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES",
    ],
    "cc-by": ["Creative Commons Attribution 4.0 International Public License"],
    "cc-by-nc": ["Creative Commons Attribution-NonCommercial 4.0 International Public License"],
    "cc-by-sa": ["Creative Commons Attribution-ShareAlike 4.0 International Public License"],
    "cc0": [
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work",
        "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
    ],
    "gpl": [
        "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
        "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies",
        "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE",
    ],
    "lgpl": [
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    ],
    "mit": [
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software",
        "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY",
    ],
    "mpl": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
        "If a copy of the MPL was not distributed with this file, You can obtain one at",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary",
    ],
}
# Identifiers of licences in tags.
TAGS = {
    "agpl": ["AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later"],
    "apache": ["Apache-2.0"],
    "bsd": ["BSD-2-Clause", "BSD-3-Clause"],
    "cc-by": ["CC-BY-4.0"],
    "cc-by-nc": ["CC-BY-NC-4.0"],
    "cc-by-sa": ["CC-BY-SA-4.0"],
    "cc0": ["CC0-1.0"],
    "gpl": ["GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later"],
    "isc": ["ISC"],
    "lgpl": ["LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later"],
    "mit": ["MIT"],
    "mpl": ["MPL-2.0"],
    "unlicense": ["Unlicense"],
}
TAG = "SPDX-License-Identifier: {}"
# What names no licence though it sounds alike; for the class unknown.
ALIKE = [
    "All rights reserved.", "The terms of the contract were published.", "He was granted permission to leave.",
    "The license of the driver was taken.", "This work is the property of its author.", "Released in spring.",
    "Copyright belongs to the authors.", "Version 2.0 of the program is free.",
]
_WORD = "[a-z0-9]+(?:[.+-][a-z0-9]+)*"
_BLANK_LINE = "\\n[ \\t\\r\\f]*\\n"


def templates() -> list[tuple[str, str]]:
    notices = [(f, notice.format(n)) for f, names in NAMES.items() for n in names for notice in NOTICES]
    clauses = [(f, clause) for f, own in CLAUSES.items() for clause in own]
    return notices + clauses + [(f, TAG.format(t)) for f, own in TAGS.items() for t in own]


def words_of(text: str) -> list[str]:
    return re.findall(_WORD, text.lower(), re.ASCII)


def grams_of(words: list[str], longest: int = NGRAM) -> set[str]:
    return {" ".join(words[i : i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)}


@dataclass(frozen=True)
class Model:
    classes: tuple[str, ...]  # unknown comes first
    features: dict[str, tuple[float, ...]]  # weights by class, divided by the temperature
    bias: tuple[float, ...]
    anchors: tuple[str, ...]  # every feature holds one of these words


def fit(sample: list[list[str]], seed: int = 7, rounds: int = 150) -> Model:
    """Fit on templates and on sampled paragraphs of the corpus, given as words."""
    rng = random.Random(seed)
    classes = (UNKNOWN, *sorted(NAMES))
    ours = [(f, words_of(t)) for f, t in templates()]
    own = set().union(*[grams_of(w) for _, w in ours])
    # Paragraphs that are licences do not teach what is none.
    pairs = [grams_of(w, 2) for _, w in ours]
    sample = [s for s in sample if not any(len(p & g) >= LEAST_COVERAGE * len(p) for g in [grams_of(s, 2)] for p in pairs)]
    seen: dict[str, int] = {}
    for s in sample:
        for g in grams_of(s) & own:
            seen[g] = seen.get(g, 0) + 1
    rare = {g for g in own if seen.get(g, 0) <= max(COMMON * len(sample), FEW)}
    # A run of common words only would make nearly every paragraph one to score.
    features = sorted(g for g in rare if any(u in rare for u in g.split()))
    place = {g: k for k, g in enumerate(features)}
    rows: list[tuple[frozenset[int], int]] = []

    def add(words: list[str], family: str) -> None:
        rows.append((frozenset(place[g] for g in grams_of(words) if g in place), classes.index(family)))

    for family, whole in ours:
        for n in range(COPIES):
            words = [w for w in whole if n == 0 or rng.random() > 0.1]
            if sample and rng.random() < 0.5:  # other words around it
                words = rng.choice(sample)[:12] + words + rng.choice(sample)[:12]
            add(words, family)
        # A few words of a template are not yet a licence.
        for n in (1, 2):
            at = rng.randrange(max(1, len(whole) - n))
            add(whole[at : at + n] if len(whole) > 3 else whole[:1], UNKNOWN)
    for words in [*sample, *[words_of(t) for t in ALIKE * 20]]:
        add(words, UNKNOWN)
    # Equal rows are one row of their number.
    counts: dict[tuple[frozenset[int], int], int] = {}
    for row in rows:
        counts[row] = counts.get(row, 0) + 1
    distinct = sorted(counts, key=lambda r: (sorted(r[0]), r[1]))
    rng.shuffle(distinct)
    x = np.zeros((len(distinct), len(features)), dtype=np.float32)
    for r, (held, _) in enumerate(distinct):
        x[r, list(held)] = 1
    y = np.array([c for _, c in distinct])
    weight = np.array([counts[r] for r in distinct], dtype=np.float32)
    aside = np.arange(len(distinct)) % 5 == 0
    target = np.eye(len(classes), dtype=np.float32)[y]
    xs, ts, share = x[~aside], target[~aside], (weight[~aside] / weight[~aside].sum())[:, None]
    w, b = np.zeros((len(features), len(classes)), np.float32), np.zeros(len(classes), np.float32)
    vw, vb = np.zeros_like(w), np.zeros_like(b)
    for _ in range(rounds):  # gradient descent with momentum and a ridge
        z = xs @ w + b
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        wrong = (p - ts) * share
        vw = 0.9 * vw - 0.5 * (xs.T @ wrong + 1e-4 * w)
        vb = 0.9 * vb - 0.5 * wrong.sum(axis=0)
        w, b = w + vw, b + vb
    z, best = x[aside] @ w + b, (np.inf, 1.0)
    for t in np.geomspace(0.2, 5, 40):
        s = z / t
        top = s.max(axis=1)
        loss = top + np.log(np.exp(s - top[:, None]).sum(axis=1)) - s[np.arange(len(s)), y[aside]]
        best = min(best, (float((loss * weight[aside]).sum() / max(weight[aside].sum(), 1)), float(t)))
    w, b = w / best[1], b / best[1]
    b[0] = max(b[0], b[1:].max() + 2)  # without features the class is unknown
    anchors = {min(g.split(), key=lambda u: (seen.get(u, 0), u)) for g in features}
    rounded = lambda v: tuple(round(float(u), 5) for u in v)
    return Model(classes, {g: rounded(w[k]) for g, k in place.items()}, rounded(b), tuple(sorted(anchors)))


def windows(text: Column, atoms: list[str] | None = None) -> Column:
    """Words of every paragraph, long ones in windows, as an array of arrays.

    With ``atoms`` only of paragraphs that hold one of these runs of letters and digits.
    """
    def cut(words: Column) -> Column:
        n = F.size(words)
        starts = F.sequence(F.lit(0), F.greatest(F.ceil((n - WINDOW) / STRIDE), F.lit(0)).cast("int"))
        return F.transform(starts, lambda i: F.slice(words, i * STRIDE + 1, F.lit(WINDOW)))

    blocks = F.split(F.lower(text), _BLANK_LINE)
    if atoms is not None:
        blocks = F.filter(blocks, lambda b: F.arrays_overlap(F.split(b, "[^a-z0-9]+"), F.lit(atoms)))
    words = F.transform(blocks, lambda b: F.regexp_extract_all(b, F.lit(_WORD), F.lit(0)))
    return F.flatten(F.transform(F.filter(words, lambda w: F.size(w) > 0), cut))


def _grams(words: Column, longest: int) -> Column:
    """Distinct n-grams of an array of words."""
    def runs(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(words) - (n - 1), F.lit(1)))
        some = F.transform(starts, lambda i: F.array_join(F.slice(words, i, n), " "))
        return F.when(F.size(words) >= n, some).otherwise(F.array().cast("array<string>"))

    return F.array_distinct(F.concat(words, *[runs(n) for n in range(2, longest + 1)]))


def _literal(value, kind: str) -> Column:
    """A nested constant; Spark folds the text into a value of the type while planning."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _named(value: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.transform(F.array(value), use)[0]


def scored(words: Column, model: Model) -> Column:
    """(family, probability, coverage) of the words of a paragraph."""
    buckets: list[dict[str, list[float]]] = [{} for _ in range(BUCKETS)]
    for gram, weights in model.features.items():
        buckets[xxhash.xxh64_intdigest(gram.encode(), 42) % BUCKETS][gram] = list(weights)
    held = _literal(buckets, "array<map<string,array<double>>>")
    by_class = [[sorted(grams_of(words_of(t), 2)) for f, t in templates() if f == c] for c in model.classes]
    known = _literal(by_class, "array<array<array<string>>>")
    # BUCKETS is a power of two, so the low bits of the signed hash are those of the unsigned one.
    at = lambda g: F.get(held, F.xxhash64(g).bitwiseAND(F.lit(BUCKETS - 1)).cast("int"))
    bias = F.array(*[F.lit(b) for b in model.bias])

    def judge(grams: Column, logits: Column) -> Column:
        top = F.array_max(logits)
        place = (F.array_position(logits, top) - 1).cast("int")
        whole = F.aggregate(logits, F.lit(0.0), lambda a, z: a + F.exp(z - top))
        shares = F.transform(F.get(known, place), lambda t: F.size(F.array_intersect(t, grams)) / F.size(t))
        family = F.get(F.array(*[F.lit(c) for c in model.classes]), place)
        return F.struct(
            family.alias("family"), (1 / whole).alias("probability"), F.coalesce(F.array_max(shares), F.lit(0.0)).alias("coverage")
        )

    def from_grams(grams: Column) -> Column:
        weights = F.filter(F.transform(grams, lambda g: F.try_element_at(at(g), g)), lambda w: w.isNotNull())
        logits = F.aggregate(weights, bias, lambda a, w: F.zip_with(a, w, lambda x, y: x + y))
        return _named(logits, lambda z: judge(grams, z))

    return _named(_grams(words, NGRAM), from_grams)


def sampled(docs: DataFrame, id_col: str, text_col: str, size: int = SAMPLE) -> list[list[str]]:
    """At most ``size`` paragraphs (of at most ``WINDOW`` words), by hash, at most one of a document."""
    n = docs.count()
    mark = F.xxhash64(text_col, id_col)
    some = docs.where(F.col(text_col).isNotNull() & (F.pmod(mark, F.lit(max(1, n // size))) == 0))
    own = some.select(mark.alias("mark"), windows(F.col(text_col).cast("string")).alias("own")).where(F.size("own") > 0)
    one = own.select("mark", F.get("own", F.pmod(F.shiftright("mark", 20), F.size("own")).cast("int")).alias("words"))
    return [r["words"] for r in one.orderBy("mark", "words").limit(size).collect()]


def classify(docs: DataFrame, model: Model, text_col: str = "text", to: str = "paragraphs") -> DataFrame:
    """All rows and columns of ``docs``, and ``to``: (family, probability, coverage) of the paragraphs that are
    scored, in the order of the text; those that can only be unknown are left out."""
    # Most texts have none of these, and are done when they have been split.
    atoms = sorted({re.split("[.+-]", a)[0] for a in model.anchors})
    anchored = F.filter(
        windows(F.coalesce(F.col(text_col).cast("string"), F.lit("")), atoms),
        lambda w: F.exists(w, lambda u: u.isin(list(model.anchors))),
    )
    kept = [c for c in docs.columns if c != to]
    return docs.select(*kept, F.transform(anchored, lambda w: scored(w, model)).alias(to))


def licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: identifier, ``families`` (confirmed, sorted), ``predicted``, ``probability``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    found = classify(rows, fit(sampled(rows, "id", "text")), "text", "found").select("id", "found")
    likely = F.filter("found", lambda p: (p["family"] != UNKNOWN) & (p["probability"] >= LEAST_PROBABILITY))
    sure = F.filter(likely, lambda p: p["coverage"] >= LEAST_COVERAGE)
    names = lambda ps: F.array_sort(F.array_distinct(F.transform(ps, lambda p: p["family"])))
    return found.select(
        F.col("id").alias(id_col),
        names(sure).alias("families"),
        names(likely).alias("predicted"),
        F.coalesce(F.array_max(F.transform(likely, lambda p: p["probability"])), F.lit(0.0)).alias("probability"),
    )


def op7_licence_scans(spark, sf_dir: str) -> DataFrame:
    """Licence families of every document."""
    found = licences(table(prepare(spark), sf_dir, "documents"))
    return found.select(
        "doc_id",
        F.array_join("families", ",").alias("families"),
        F.size("families").cast("long").alias("n_families"),
        F.array_join("predicted", ",").alias("predicted"),
        F.round("probability", 6).alias("probability"),
    )
