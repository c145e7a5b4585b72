"""Licence scan: a trained paragraph classifier confirmed by templates.

*Paragraphs* are lines, and runs of lines up to one without a word (which a bare
comment marker is, too). A line over ``LONG`` words is cut into overlapping
windows, so whole texts are covered; a run over ``LONG`` words is cut at every
``RUN_STEP``, so that each notice lies in a window as a whole. Comment markers
are no words. *Features* are the word unigrams and
bigrams that occur in the training notices, each counted once. *Training* is
multinomial logistic regression on the driver: notices of each family, varied
by dropped words and surrounding prose; notices of no listed family (class
``unknown``); and at most ``PROSE`` paragraphs of a bounded hash-chosen sample
of the documents as class ``none``, leaving out those that resemble a template.
A fifth of the rows calibrates the probabilities by a temperature.

*Decision.* A paragraph whose calibrated probability of ``none`` is at least
``SURE`` holds no licence. A family needs probability ``SURE`` and a template: the
share of a template's bigrams that the paragraph holds must reach ``ALIKE``, and
no other family may match better. What is neither is an ``unknown`` licence.

*Lines and runs.* The findings of a family are taken by similarity, lines
before runs, then shortness. One is part of another, and left out, if they overlap and the bigrams
that speak for it all belong to the better one's template. A run without a new
family or place adds nothing, and an unknown line inside a notice that only its
run shows is left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltaflow.llm.common import bounded_batches

LONG, STEP, RUN_STEP = 40, 26, 11
#: Sampled documents and prose paragraphs that training takes at most.
SAMPLE_DOCS, PROSE = 400, 4000
VARIANTS = 24
SURE, ALIKE = 0.5, 0.6
FOUND = "array<struct<family: string, probability: double, similarity: double, start: int, end: int>>"
_LINE = re.compile(r"[^\n\r]+")
_WORD = re.compile(r"\w+")

# Standard notices of public licences.
NOTICES = {
    "MIT": (
        "Released under the MIT License.", "Licensed under the MIT License.", "SPDX-License-Identifier: MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction",
        "The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        "of the Software."),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.", "Released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License."),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.", "Licensed under the GNU GPL.",
        "SPDX-License-Identifier: GPL-3.0-or-later", "SPDX-License-Identifier: GPL-2.0-only",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License.", "SPDX-License-Identifier: LGPL-2.1-or-later",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License"),
    "AGPL": (
        "Licensed under the GNU Affero General Public License.", "SPDX-License-Identifier: AGPL-3.0-only"),
    "BSD": (
        "Licensed under the BSD 3-Clause License.", "Released under the BSD license.", "SPDX-License-Identifier: BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "MPL-2.0": (
        "Licensed under the Mozilla Public License 2.0.", "SPDX-License-Identifier: MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "ISC": (
        "Licensed under the ISC License.", "SPDX-License-Identifier: ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted"),
    "CC-BY": (
        "Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-4.0"),
    "CC-BY-SA": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-SA-4.0"),
    "CC-BY-NC": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0"),
    "CC0": (
        "CC0 1.0 Universal Public Domain Dedication", "SPDX-License-Identifier: CC0-1.0",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to "
        "this work."),
    "Unlicense": (
        "This is free and unencumbered software released into the public domain.", "SPDX-License-Identifier: Unlicense"),
    "Proprietary": (
        "All rights reserved.", "Copyright. All rights reserved.",
        "Unauthorized copying of this file, via any medium, is strictly prohibited. Proprietary and confidential."),
}
# Wordings of licences that belong to no listed family.
OTHER = (
    "This work is licensed under its own licence.", "Released under the terms of the Example License, version 1.",
    "Licensed under the Foo Public License.", "Distributed under a custom license agreement.",
    "See the LICENSE file for the license terms.", "The license of this text is described elsewhere.",
    "Use of this file is subject to the license agreement.", "SPDX-License-Identifier: LicenseRef-Other",
)
CLASSES = ("none", "unknown", *NOTICES)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def units_of(text: str | None) -> Iterator[tuple[int, int]]:
    """Offsets of the paragraphs of a text."""
    for m in _LINE.finditer(text or ""):
        if m.end() - m.start() <= 2 * LONG:
            yield m.start(), m.end()
            continue
        at = [w.span() for w in _WORD.finditer(m[0])]
        if len(at) <= LONG:
            yield m.start(), m.end()
        else:
            for k in range(0, len(at) - (LONG - STEP), STEP):
                yield m.start() + at[k][0], m.start() + at[min(k + LONG, len(at)) - 1][1]


def runs_of(text: str | None) -> Iterator[list[tuple[int, int, int]]]:
    """For each run of two or more lines with words: line, start and end of its words."""
    text, run, last, nth = text or "", [], None, 0
    for nth, m in enumerate(_LINE.finditer(text)):
        own = [(nth, m.start() + w.start(), m.start() + w.end()) for w in _WORD.finditer(m[0])]
        if last is not None and (not own or text[last:m.start()] not in ("\n", "\r\n", "\r")):
            if run and run[0][0] != run[-1][0]:
                yield run
            run = []
        run += own
        last = m.end()
    if run and run[0][0] != run[-1][0]:
        yield run


def windows_of(run: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """The windows of a run that cross the end of a line, as ranges of its words."""
    for k in range(0, max(1, len(run) - LONG + RUN_STEP), RUN_STEP):
        end = min(k + LONG, len(run))
        if run[k][0] != run[end - 1][0]:
            yield k, end


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:]))


_TEMPLATES = [(family, bigrams(words_of(t))) for family, notices in NOTICES.items() for t in notices]


def alike(words: list[str]) -> dict[str, float]:
    """For each family, the largest share of a template's bigrams among ``words``."""
    own, out = bigrams(words), {}
    for family, t in _TEMPLATES:
        if own & t:
            out[family] = max(out.get(family, 0.0), len(own & t) / len(t))
    return out


def _evidence(words: list[str], family: str) -> tuple[set, set]:
    """The family's most alike template, and its bigrams among ``words``."""
    own = bigrams(words)
    best = max((t for f, t in _TEMPLATES if f == family), key=lambda t: len(own & t) / len(t))
    return best, own & best


@dataclass
class Model:
    singles: dict[str, int]
    pairs: dict[tuple[str, str], int]
    weights: np.ndarray  # features by classes
    bias: np.ndarray
    temperature: float

    def features(self, words: list[str]) -> set[int]:
        out, last = set(), -2
        for k, w in enumerate(words):
            f = self.singles.get(w)
            if f is None:
                continue
            out.add(f)
            if last == k - 1 and (p := self.pairs.get((words[k - 1], w))) is not None:
                out.add(p)
            last = k
        return out

    def probabilities(self, rows: list[set[int]]) -> np.ndarray:
        z = np.tile(self.bias, (len(rows), 1))
        at = [k for k, r in enumerate(rows) if r]
        if at:
            size = np.array([len(rows[k]) for k in at])
            flat = np.fromiter((f for k in at for f in sorted(rows[k])), np.int64, size.sum())
            z[at] += np.add.reduceat(self.weights[flat], np.cumsum(size) - size)
        return _softmax(z / self.temperature)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _varied(words: list[str], prose: list[list[str]], rng: np.random.Generator, n: int) -> list[str]:
    """A notice with some words dropped and prose around it."""
    kept = [w for w in words if n == 0 or len(words) < 5 or rng.random() > 0.06]
    if n < 2 or not prose:
        return kept
    around = prose[rng.integers(len(prose))]
    a, b = rng.integers(0, 20, 2)
    year = ["copyright", "c", str(rng.integers(1990, 2030))] if n % 4 == 3 else []
    return [*around[:a], *year, *kept, *around[len(around) - b:]]


def fit(prose: list[list[str]], seed: int = 9, steps: int = 250, l2: float = 1e-4) -> Model:
    """Train and calibrate; ``prose`` are the words of paragraphs without a licence."""
    rng = np.random.default_rng(seed)
    rows = [(0, w) for w in prose] or [(0, [])]
    for notices, label in [(OTHER, 1), *((v, CLASSES.index(k)) for k, v in NOTICES.items())]:
        for t in notices:
            rows += [(label, _varied(words_of(t), prose, rng, n)) for n in range(VARIANTS)]
    vocabulary = sorted({w for t in (*OTHER, *(x for v in NOTICES.values() for x in v)) for w in words_of(t)})
    singles = {w: k for k, w in enumerate(vocabulary)}
    every = sorted({b for t in (*OTHER, *(x for v in NOTICES.values() for x in v)) for b in bigrams(words_of(t))})
    pairs = {b: len(singles) + k for k, b in enumerate(every)}
    width = len(singles) + len(pairs)
    model = Model(singles, pairs, np.zeros((width, len(CLASSES))), np.zeros(len(CLASSES)), 1.0)
    x = [sorted(model.features(w)) for _, w in rows]
    y = np.array([k for k, _ in rows])
    aside = rng.random(len(rows)) < 0.2
    for own, learn in ((~aside, True), (aside, False)):
        at = np.flatnonzero(own)
        if not len(at):
            continue
        size = np.array([len(x[k]) for k in at])
        row = np.repeat(np.arange(len(at)), size)
        col = np.array([f for k in at for f in x[k]], np.int64)
        full = np.flatnonzero(size)
        head = (np.cumsum(size) - size)[full]

        def logits():
            z = np.tile(model.bias, (len(at), 1))
            if len(full):
                z[full] += np.add.reduceat(model.weights[col], head)
            return z
        target = np.eye(len(CLASSES))[y[at]]
        if not learn:
            z = logits()
            losses = [-(target * np.log(_softmax(z / t) + 1e-12)).sum() for t in _TEMPERATURES]
            model.temperature = float(_TEMPERATURES[int(np.argmin(losses))])
            continue
        by = np.argsort(col, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(col[by]) != 0])
        used = col[by][starts]
        m = [np.zeros_like(model.weights), np.zeros_like(model.bias)]
        v = [np.zeros_like(model.weights), np.zeros_like(model.bias)]
        for step in range(1, steps + 1):
            err = (_softmax(logits()) - target) / len(at)
            g = l2 * model.weights
            g[used] += np.add.reduceat(err[row[by]], starts)
            for k, (grad, w) in enumerate(((g, model.weights), (err.sum(axis=0), model.bias))):
                m[k] = 0.9 * m[k] + 0.1 * grad
                v[k] = 0.999 * v[k] + 0.001 * grad ** 2
                w -= 0.1 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-9)
    return model


_TEMPERATURES = np.geomspace(0.25, 4.0, 33)


def train(docs: DataFrame, text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> Model:
    """Fit with prose of a bounded sample of the documents. Without any text the
    model knows notices only."""
    near = F.xxhash64(F.lit(13), text_col)
    picked = docs.where(F.col(text_col).isNotNull()).select(near.alias("h"), F.col(text_col).alias("t"))
    # the ids of the sample first, so that only its texts are collected; equal texts count once
    ids = [r["h"] for r in picked.groupBy("h").agg(F.lit(1).alias("one")).orderBy("h").limit(sample_docs).collect()]

    bounded_batches()

    @F.pandas_udf("array<string>")
    def paragraphs(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def some(t):  # about 40 paragraphs, spread over the text
            units = list(units_of(t))
            return [t[a:b] for a, b in units[::max(1, len(units) // 40)]]
        for s in batches:
            yield pd.Series([some(t) for t in s], dtype=object)
    rows = (picked.where(F.col("h").isin(ids)).dropDuplicates(["h"]).select(F.explode(paragraphs("t")).alias("p"))
            .distinct().orderBy(F.xxhash64("p"), "p").limit(PROSE).collect()) if ids else []
    prose = [w for r in rows if (w := words_of(r["p"])) and max(alike(w).values(), default=0) < 0.5]
    return fit(prose)


def _judged(words: list[list[str]], rows: list[set[int]], model: Model) -> Iterator[tuple[int, dict]]:
    """Number and finding of the units that hold a licence."""
    p = model.probabilities(rows)
    for k in np.flatnonzero(p[:, 0] < SURE):
        best = 2 + int(np.argmax(p[k, 2:]))
        similar = alike(words[k])
        own, top = similar.get(CLASSES[best], 0.0), max(similar.values(), default=0.0)
        sure = p[k, best] >= SURE and own >= ALIKE and own >= top
        yield int(k), {"family": CLASSES[best] if sure else "unknown", "similarity": round(own if sure else top, 6),
                       "probability": round(float(p[k, best] if sure else 1 - p[k, 0]), 6)}


def _run_findings(text: str, model: Model) -> Iterator[dict]:
    spans, words, rows = [], [], []
    for run in runs_of(text):
        if not any(text[a:b].lower() in model.singles for _, a, b in run):
            continue
        own = [text[a:b].lower() for _, a, b in run]
        for k, end in windows_of(run):
            f = model.features(own[k:end])
            if f:  # without one it is like an empty line
                spans.append(run[k:end]), words.append(own[k:end]), rows.append(f)
    if not rows:
        return
    for k, f in _judged(words, rows, model):
        at = [0, len(words[k]) - 1]
        if f["family"] != "unknown":  # from the first to the last word that speaks for it
            held = _evidence(words[k], f["family"])[1]
            pairs = [n for n, b in enumerate(zip(words[k], words[k][1:])) if b in held]
            at = [pairs[0], pairs[-1] + 1]
        yield f | {"start": spans[k][at[0]][1], "end": spans[k][at[1]][2], "words": words[k][at[0]:at[1] + 1]}


def _overlap(a: dict, b: dict) -> bool:
    return a["start"] < b["end"] and b["start"] < a["end"]


def scan_text(text: str | None, model: Model) -> list[dict]:
    units = list(units_of(text))
    if not units:
        return []
    words = [words_of(text[a:b]) for a, b in units]
    lines = [f | {"start": units[k][0], "end": units[k][1], "words": words[k], "line": True}
             for k, f in _judged(words, [model.features(w) for w in words], model)]
    found = [*lines, *(f | {"line": False} for f in _run_findings(text, model))]
    taken = []
    for f in sorted((f for f in found if f["family"] != "unknown"),
                    key=lambda f: (-f["similarity"], not f["line"], f["end"] - f["start"], f["start"])):
        template, held = _evidence(f["words"], f["family"])
        near = [(g, t) for g, t in taken if _overlap(f, g)]
        if any((g["family"] == f["family"] and not (f["line"] and g["line"]))
               or (not (f["line"] and g["line"]) and held <= t) for g, t in near):
            continue
        taken.append((f, template))
    out = [f for f, _ in taken]
    for f in lines:
        if f["family"] == "unknown" and not any(not g["line"] and _overlap(f, g) for g, _ in taken):
            out.append(f)
    for f in found:
        if f["family"] == "unknown" and not f["line"] and not any(_overlap(f, g) for g in out):
            out.append(f)
    return [{k: f[k] for k in ("family", "probability", "similarity", "start", "end")}
            for f in sorted(out, key=lambda f: (f["start"], f["end"]))]


def scan(text: Column, model: Model) -> Column:
    """Paragraphs with a licence: family or ``unknown``, calibrated probability
    (of the family; of any licence for ``unknown``), template similarity and code
    point offsets. None for a null or empty text."""
    bounded_batches()

    @F.pandas_udf(FOUND)
    def found(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in batches:
            yield pd.Series([scan_text(t, model) for t in s], dtype=object)
    return found(text)
