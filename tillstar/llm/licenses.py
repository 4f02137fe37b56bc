"""Licence families of paragraphs: n-gram classifier confirmed by template comparison."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = re.compile(r"[a-z0-9]+(?:[.\-+][a-z0-9]+)*")
MARK_WORD = re.compile(r"^\s*(?:dnl|rem)\b")  # comment marks that look like words

# Short public notices and telling sentences of each licence family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the 3-Clause BSD License.",
        "Released under the BSD 2-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "cc0": [
        "Released under CC0 1.0 Universal.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "lgpl": [
        "Licensed under the GNU Lesser General Public License, version 3.",
        "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ],
    "proprietary": [
        "Copyright. All rights reserved.",
        "All rights reserved.",
        "No part of this publication may be reproduced without the prior written permission of the publisher.",
    ],
}
# Notices of no family above, from which the unknown class is learnt.
OTHER_NOTICES = [
    "Licensed under the Example Community License, version 7.",
    "Released under the terms of a custom license agreement.",
    "This file is distributed under the license of the project; see the license file for its terms.",
    "Use of this software is governed by the license agreement.",
    "Permission to use this work is granted under the terms below.",
    "Published under an open data license, version 1.",
]

NONE, UNKNOWN = "none", "unknown"
FAMILIES = sorted(TEMPLATES)
CLASSES = [NONE, UNKNOWN, *FAMILIES]
VARIANTS = 60  # noisy copies of each template to learn from
MOST_LABELLED = 4000  # paragraphs of the corpus, as examples of no licence
MOST_LABELLED_CHARS = 2000  # of such a paragraph
STEPS, RATE, RIDGE = 300, 0.5, 1e-3
LICENCE_SHARE = 0.01  # of paragraphs that state a licence, before their words are seen
CONFIRMED = 0.6  # share of a template's word pairs that a paragraph must hold in order


def grams(words: list[str]) -> set[str]:
    """Single words and pairs of neighbours."""
    return {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}


@dataclass
class Model:
    """Sparse weights per class, the calibrating temperature, and the templates' word pairs."""

    weights: dict[str, np.ndarray]
    bias: np.ndarray
    temperature: float
    templates: list[tuple[str, list[str], set[str]]]

    def __post_init__(self):
        self.seeds = {gram for gram in self.weights if " " not in gram}
        self.longest = max(len(words) for _, words, _ in self.templates)  # words of a notice

    def growing(self, lines: Iterable[list[str]]) -> Iterator[np.ndarray]:
        """The probabilities of the first line's words, of the first two lines', and so on."""
        score = self.bias.copy()
        known = self.weights
        previous = ""
        seen = set()
        for words in lines:
            for word in words:
                for gram in (word, f"{previous} {word}") if previous else (word,):
                    if gram in known and gram not in seen:
                        seen.add(gram)
                        score += known[gram]
                previous = word if word in known else ""
            yield softmax(score[None] / self.temperature)[0]

    def probabilities(self, words: list[str]) -> np.ndarray:
        return next(self.growing([words]))

    def may_confirm(self, words: list[str]) -> bool:
        """Whether enough word pairs of some template are there at all, in any order."""
        pairs = {f"{a} {b}" for a, b in zip(words, words[1:])}
        return any(len(own & pairs) >= CONFIRMED * len(own) if own else template[0] in words for _, template, own in self.templates)

    def confirm(self, family: str, words: list[str]) -> float:
        """The largest share of one of the family's templates that a stretch of the paragraph holds.

        A single-word template must occur itself; others are compared by pairs of
        neighbours within a stretch of twice the template's length.
        """
        best, pairs = 0.0, [f"{a} {b}" for a, b in zip(words, words[1:])]
        for name, template, own in self.templates:
            if name != family:
                continue
            if not own:
                best = max(best, float(template[0] in words))
                continue
            places = [i for i, pair in enumerate(pairs) if pair in own]
            low = 0
            for high, place in enumerate(places):
                while place - places[low] >= 2 * len(template):
                    low += 1
                best = max(best, len({pairs[i] for i in places[low : high + 1]}) / len(own))
        return best


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def noisy(words: list[str], filler: list[str], draw: np.random.Generator, among: bool) -> list[str]:
    """A copy with a few words lost or replaced, often between other words."""
    out = []
    for word in words:
        luck = draw.random()
        if luck < 0.04:
            continue
        out.append(filler[draw.integers(len(filler))] if luck < 0.07 and filler else word)
    if among and filler:
        before, after = (int(draw.integers(0, 25)) for _ in range(2))
        pick = lambda n: [filler[i] for i in draw.integers(0, len(filler), n)]
        out = pick(before) + out + pick(after)
    return out


def fit(paragraphs: list[str]) -> Model:
    """Train on noisy templates, other notices, and corpus paragraphs that hold no template.

    Three quarters of the examples train the weights; the others set the
    temperature, so that probabilities are calibrated.
    """
    draw = np.random.default_rng(7)
    templates = []
    for family in FAMILIES:
        for text in TEMPLATES[family]:
            words = WORD.findall(text.lower())
            templates.append((family, words, {f"{a} {b}" for a, b in zip(words, words[1:])}))
    plain = [WORD.findall(text.lower()) for text in paragraphs]
    held = [own for _, _, own in templates if own]
    plain = [
        words for words in plain
        if max(len(own & grams(words)) / len(own) for own in held) < 0.3
    ]
    # A line that is mostly a piece of a notice, as wrapped ones leave, is no example of none either.
    pieces = set().union(*held, *(grams(WORD.findall(text.lower())) for text in OTHER_NOTICES))
    pairs_of = lambda words: {f"{a} {b}" for a, b in zip(words, words[1:])}
    plain = [words for words in plain if not (own := pairs_of(words)) or len(own & pieces) < 0.5 * len(own)]
    filler = sorted({word for words in plain for word in words})[:5000]
    examples = [(words, 0) for words in plain] + [([], 0)]
    sources = [(CLASSES.index(family), words) for family, words, _ in templates]
    sources += [(1, WORD.findall(text.lower())) for text in OTHER_NOTICES]
    for label, words in sources:
        examples += [(noisy(words, filler, draw, k % 2 == 1), label) for k in range(VARIANTS)]
        examples.append((words, label))
    vocabulary = sorted({gram for _, words in sources for gram in grams(words)})
    number = {gram: i for i, gram in enumerate(vocabulary)}
    rows = np.zeros((len(examples), len(vocabulary)), np.float32)
    for i, (words, _) in enumerate(examples):
        rows[i, [number[g] for g in grams(words) if g in number]] = 1
    labels = np.array([label for _, label in examples])
    train = draw.random(len(examples)) < 0.75
    goal = np.eye(len(CLASSES), dtype=np.float32)[labels]
    w, b = np.zeros((len(vocabulary), len(CLASSES)), np.float32), np.zeros(len(CLASSES), np.float32)
    x, y = rows[train], goal[train]
    each = 1 / np.maximum(y.sum(0), 1)
    weight = (y @ each)[:, None] / len(CLASSES)  # every class weighs the same
    speed_w, speed_b = np.full_like(w, 1e-6), np.full_like(b, 1e-6)
    for _ in range(STEPS):
        error = (softmax(x @ w + b) - y) * weight
        gw, gb = x.T @ error + RIDGE / 10 * w, error.sum(0)
        speed_w += gw**2
        speed_b += gb**2
        w -= RATE * gw / np.sqrt(speed_w)
        b -= RATE * gb / np.sqrt(speed_b)
    w[np.abs(w) < 0.02] = 0
    scores, told = (rows @ w + b)[~train], labels[~train]
    heats = np.geomspace(0.25, 8, 41)
    losses = [-np.log(softmax(scores / h)[np.arange(len(told)), told] + 1e-12).mean() for h in heats] if len(told) else [0]
    b[0] += np.log((1 - LICENCE_SHARE) / LICENCE_SHARE)  # the classes weighed the same in training
    weights = {gram: w[i].astype(np.float64) for gram, i in number.items() if w[i].any()}
    return Model(weights, b.astype(np.float64), float(heats[int(np.argmin(losses))]) if len(told) else 1.0, templates)


def judge(model: Model, words: list[str], p: np.ndarray | None = None) -> tuple[str, float, bool] | None:
    """Family (or unknown), probability (from ``p`` if known) and confirmation of a paragraph; None for no licence."""
    p = model.probabilities(words) if p is None else p
    if p[0] >= 0.5:
        return None
    family = FAMILIES[int(np.argmax(p[2:]))]
    probability = float(p[2:].max())
    if probability >= 0.5 and model.confirm(family, words) >= CONFIRMED:
        return family, probability, True
    # No family that a template confirms: the probability is that of any licence.
    return UNKNOWN, float(1 - p[0]), False


def paragraphs(text: str) -> Iterator[list[tuple[int, int, list[str]]]]:
    """Start, end and words of the lines of each paragraph; lines without words part paragraphs.

    Comment marks are no words, so commented text has paragraphs like any other.
    """
    at, block = 0, []
    for line in text.split("\n"):
        words = WORD.findall(MARK_WORD.sub("", line.lower()))
        if words:
            block.append((at, at + len(line), words))
        elif block:
            yield block
            block = []
        at += len(line) + 1
    if block:
        yield block


def notices(model: Model, lines: list[list[str]]) -> list[tuple[int, int, tuple[str, float, bool]]]:
    """First line, last line and judgement of each notice in a paragraph, wherever its line ends are.

    Neighbouring lines are joined, from each line on, until what follows it is as
    long as a notice may be.  First come the shortest joins that a template
    confirms, then, of the lines between these, the shortest that state any licence.
    """
    seeds = model.seeds
    plain = [seeds.isdisjoint(words) for words in lines]

    def search(low: int, high: int, most: int, confirmed: bool) -> Iterator[tuple[int, int, tuple[str, float, bool]]]:
        free = low  # no line before it may be taken
        for first in range(low, high):
            if first < free or plain[first]:
                continue
            words = []
            for last, p in enumerate(model.growing(lines[first:high]), first):
                words += lines[last]
                told = None if plain[last] or p[0] >= 0.5 else judge(model, words, p)
                if told and (told[2] or not confirmed):
                    # Lines in front that the judgement does not need are left out.
                    for later in range(last, first, -1):
                        own = judge(model, [w for line in lines[later : last + 1] for w in line])
                        if own and (own[0], own[2]) == (told[0], told[2]):
                            first, told = later, own
                            break
                    yield first, last, told
                    free = last + 1
                    break
                if len(words) - len(lines[first]) >= most:
                    break

    whole = [word for line in lines for word in line]
    found = list(search(0, len(lines), 2 * model.longest, True)) if model.may_confirm(whole) else []
    low = 0
    for first, last in [*((x[0], x[1]) for x in found), (len(lines), len(lines))]:
        found += search(low, first, model.longest, False)
        low = last + 1
    return sorted(found)


def scan_batches(model: Model):
    """A function for mapInPandas that tags the paragraphs of whole texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = []
            for text in batch["__text"]:
                own = []
                for block in paragraphs(text) if text else ():
                    for first, last, told in notices(model, [words for _, _, words in block]):
                        family, probability, confirmed = told
                        own.append({"start": block[first][0], "end": block[last][1], "family": family, "probability": probability, "confirmed": confirmed})
                found.append(own)
            out = batch.drop(columns="__text")
            out["found"] = found
            yield out

    return run


def sample(docs: DataFrame, text: str) -> list[str]:
    """A bounded set of different corpus paragraphs, the same for the same rows.

    They are those with the smallest hashes.  Lines are first thinned by hash to
    about three times the number wanted, so only these are shuffled, and a line
    that stands in very many texts is one row per task.
    """
    lines = docs.select(F.explode(F.split(F.col(text), "\n")).alias("line"))
    lines = lines.filter((F.length("line") > 0) & (F.length("line") <= MOST_LABELLED_CHARS))
    share = min(1.0, 3 * MOST_LABELLED / max(lines.count(), 1))
    place = F.xxhash64("line")
    thin = lines.withColumn("place", place).filter(F.pmod("place", F.lit(1 << 40)) <= int(share * (1 << 40)))
    taken = thin.groupBy("place").agg(F.min("line").alias("line"))
    return [row["line"] for row in taken.orderBy("place").limit(MOST_LABELLED).collect()]


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_licenses, license, probability, found.

    ``found`` lists the lines, or neighbouring lines of a paragraph, that state a
    licence (a notice may be wrapped and stand in comments): character offsets, family, probability, and whether a template confirmed the family; a
    notice of no confirmed family is ``unknown``.  ``license`` is the family of
    the surest confirmed paragraph, else ``unknown`` if there is a notice, else
    NULL.  The classifier is fitted on noisy copies of public notices against at
    most ``MOST_LABELLED`` paragraphs of the corpus.

    NULL, empty and wordless texts state nothing.  Repeated rows are judged one
    by one, an empty table gives no rows, other columns are ignored.
    """
    model = fit(sample(docs, text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    none = "cast(array() AS array<struct<start:int,end:int,family:string,probability:double,confirmed:boolean>>)"
    schema = rows.drop("__text").withColumn("found", F.expr(none)).schema
    found = rows.mapInPandas(scan_batches(model), schema)
    order = lambda x: F.struct(
        x["confirmed"].alias("confirmed"), x["probability"].alias("probability"), x["family"].alias("family")
    )
    told = found.withColumn("__surest", F.array_max(F.transform("found", order)))
    return told.select(
        "doc_id",
        F.size("found").cast("long").alias("n_licenses"),
        F.col("__surest.family").alias("license"),
        F.col("__surest.probability").alias("probability"),
        "found",
    )
