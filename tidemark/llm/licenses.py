"""Licence scan: where do texts hold licence notices, and of which family?

A paragraph is a line with a word.  Every paragraph is read in windows of several sizes that
overlap by half, so a notice inside a longer line is one of them.  A softmax regression on hashed
word n-grams (1 to 3) judges each window: it knows the licence families and an unknown class.  It is
trained in numpy on variants of the templates below (cut, with words lost, among other words)
against hard sentences and a bounded sample of windows of the corpus.  Its temperature and the
least probability of each family are calibrated on a held-out part.  A window whose family passes is
confirmed by a template of that family: at least ``contained`` of the template's word pairs must
stand in and around the window.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base, bytewords

_U = np.uint64
BITS = 16

# Short notices of public licences.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "This software is distributed under the terms of the MIT license.",
        "The MIT License (MIT)",
        "MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    "Apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at",
        "Released under the Apache License, Version 2.0.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "GPL": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 2.",
        "Released under the GNU GPL version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "LGPL": (
        "Licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    ),
    "AGPL": (
        "Licensed under the GNU Affero General Public License, version 3.",
        "it under the terms of the GNU Affero General Public License as published by the Free Software Foundation",
    ),
    "BSD": (
        "Released under the BSD 3-Clause License.",
        "Licensed under the BSD License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
    "MPL": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at",
        "Licensed under the Mozilla Public License, Version 2.0.",
    ),
    "CC-BY": ("Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA": ("Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-NC": ("Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "CC-BY-ND": ("Licensed under CC BY-ND 4.0.", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC0": ("Released under CC0 1.0.", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    "ISC": ("Licensed under the ISC License.", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "public-domain": ("This is free and unencumbered software released into the public domain.", "This work has been released into the public domain."),
    "proprietary": ("All rights reserved.", "Copyright. All rights reserved.", "This document is confidential and proprietary. No part of it may be reproduced without written permission."),
}

#: Sentences about licences that are none.
HARD = (
    "She got her driving license in version of the story that he told.",
    "The driver was licensed by the city council under the new law.",
    "He released the bird under the tree and it flew away.",
    "The general public was admitted to the work free of charge.",
    "All seats are reserved for members of the public.",
    "Permission to build was granted by the council to the owner.",
    "The rights of the people are the law of the land.",
    "Copies of the letter were sent to the members without comment.",
    "A fishing license is required by law in this state.",
    "This work is about the history of public law in the city.",
    "The software was slow and the documentation was poor.",
    "You may use the kitchen and the garden at any time.",
)

FAMILIES = ("unknown", *TEMPLATES)


@dataclass(frozen=True)
class Training:
    variants: int = 40
    #: Lines of the corpus, from about so many texts of at most so many bytes.
    texts: int = 2000
    max_bytes: int = 20_000
    windows: int = 12_000
    epochs: int = 5
    rate: float = 0.5
    seed: int = 13
    #: Share of held-out unknown windows that may pass, for each family.
    false_share: float = 0.001
    #: Share of a template's word pairs that a notice must hold.
    contained: float = 0.6


@dataclass(frozen=True)
class Template:
    family: int
    #: Hashes of its word pairs, sorted, and its words.
    pairs: np.ndarray
    words: int


@dataclass(frozen=True)
class Model:
    weights: np.ndarray
    temperature: float
    #: Least probability of each family.
    least: np.ndarray
    templates: tuple[Template, ...]
    contained: float


#: Words of a window; windows of each size overlap by half, and a shorter line is one window.
SIZES = (8, 16, 32, 64)
#: Words that are scored at once.
BLOCK = 40_000

_WORDS = np.array([c + 32 if 65 <= c <= 90 else c if c >= 0x80 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)], np.uint8)


def lines_of(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes, their starts and ends, and the first word of each paragraph (and the end)."""
    plain = _WORDS[buf]
    starts, ends = bytewords.spans(plain)
    words = bytewords.hashes(plain, starts, ends)
    line = np.searchsorted(np.flatnonzero(buf == 10), starts)
    first = np.flatnonzero(np.diff(line, prepend=-1)) if len(line) else np.zeros(0, np.int64)
    return words, starts, ends, np.append(first, len(words))


def windows_of(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words and ends of all windows of the paragraphs that begin at ``first``."""
    a, b = first[:-1], first[1:]
    found = [(a[b - a <= SIZES[-1]], b[b - a <= SIZES[-1]])]  # whole paragraphs
    for size in SIZES:
        long = b - a > size
        x, y = a[long], b[long]
        counts = -(-(y - x - size) // (size // 2)) + 1
        k = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        ends = np.minimum(np.repeat(x, counts) + k * (size // 2) + size, np.repeat(y, counts))
        found.append((ends - size, ends))
    return tuple(np.concatenate(c) for c in zip(*found))


def pairs_of(words: np.ndarray) -> np.ndarray:
    return bytewords.windows(words, 2)


def grams(words: np.ndarray) -> list[np.ndarray]:
    """Buckets of the n-grams (1 to 3) by their first word."""
    found = [words] + [bytewords.windows(words, n) for n in (2, 3)]
    with np.errstate(over="ignore"):
        return [(((h + _U(n)) * bytewords.GOLDEN) >> _U(64 - BITS)).astype(np.int64) for n, h in enumerate(found)]


def words_of(text: str) -> np.ndarray:
    return bytewords.word_hashes(_WORDS[np.frombuffer(text.encode(), np.uint8)])


def softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=-1, keepdims=True))
    return p / p.sum(axis=-1, keepdims=True)


def logits(words: np.ndarray, a: np.ndarray, b: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of the windows from word ``a`` to ``b``: the weights of the n-grams that begin in them, over the root of their number."""
    total = np.zeros((len(words) + 1, weights.shape[1]), np.float64)
    by_word = total[1:]
    for ids in grams(words):
        by_word[: len(ids)] += weights[ids]
    np.cumsum(by_word, axis=0, out=by_word)
    return (total[b] - total[a]) / np.sqrt(3 * (b - a))[:, None] + weights[-1]


def templates() -> tuple[Template, ...]:
    words = [(FAMILIES.index(family), words_of(t)) for family, texts in TEMPLATES.items() for t in texts]
    return tuple(Template(family, np.unique(pairs_of(w)), len(w)) for family, w in words)


def _samples(corpus: list[np.ndarray], training: Training, rng) -> list[tuple[np.ndarray, int]]:
    """(words, family) of windows: templates, cut, with words lost and among other words; other windows are unknown."""
    known = np.unique(np.concatenate([t.pairs for t in templates()]))
    places = [(k, a, b) for k, words in enumerate(corpus) for a, b in zip(*(x.tolist() for x in windows_of(np.array([0, len(words)])))) if b - a > 1]
    windows = [corpus[k][a:b] for k, a, b in places[:: max(1, len(places) // training.windows)]]
    # what looks like a template in the corpus is left out, as nobody has labelled it
    windows = [w for w in windows if np.isin(pairs_of(w), known).mean() < 0.3]
    hard = [words_of(s) for s in HARD]
    rows = [(w, 0) for w in windows] + [(w, 0) for w in hard for _ in range(10)]
    foreign = np.concatenate([*windows, *hard])
    for family, texts in TEMPLATES.items():
        for text in texts:
            words = words_of(text)
            rows.append((words, FAMILIES.index(family)))
            for _ in range(training.variants):
                part = words
                if len(words) > 8:
                    n = max(6, int(len(words) * rng.uniform(0.5, 1.0)))
                    at = int(rng.integers(0, len(words) - n + 1))
                    part = words[at : at + n]
                part = part[rng.random(len(part)) > 0.04] if len(part) > 4 else part
                room = max(0, int(rng.choice(SIZES)) - len(part))
                n = int(rng.integers(0, min(room, 2 * len(part)) + 1))
                at = int(rng.integers(max(1, len(foreign) - n)))
                cut = int(rng.integers(0, n + 1))
                rows.append((np.concatenate([foreign[at : at + cut], part, foreign[at + cut : at + n]]), FAMILIES.index(family)))
    return rows


def trained(corpus: list[np.ndarray], training: Training = Training()) -> Model:
    """Model from the templates and lines (word hashes) of the corpus."""
    rng = np.random.default_rng(training.seed)
    rows = [(np.concatenate(grams(w)), len(w), y) for w, y in _samples(corpus, training, rng)]
    order = rng.permutation(len(rows))
    held, fitted = order[::5], np.array([k for i, k in enumerate(order) if i % 5])
    weights = np.zeros(((1 << BITS) + 1, len(FAMILIES)), np.float32)

    def raw(k: int) -> np.ndarray:
        return weights[rows[k][0]].sum(axis=0, dtype=np.float64) / np.sqrt(3 * rows[k][1]) + weights[-1]

    for epoch in range(training.epochs):
        rate = training.rate / (1 + epoch / 2)
        for k in rng.permutation(fitted):
            ids, n, y = rows[k]
            g = softmax(raw(k))
            g[y] -= 1
            weights[ids] -= (rate / np.sqrt(3 * n) * g).astype(np.float32)  # a repeated n-gram steps once
            weights[-1] -= (0.05 * rate * g).astype(np.float32)
    scores, labels = np.array([raw(k) for k in held]), np.array([rows[k][2] for k in held])
    loss = lambda t: -np.log(softmax(scores / t)[np.arange(len(labels)), labels] + 1e-12).sum()
    temperature = min((0.25, 0.5, 0.75, 1.0, 1.5, 2.0, 3.0), key=loss)
    unknown = softmax(scores[labels == 0] / temperature)
    least = np.full(len(FAMILIES), 0.5)
    if len(unknown):
        least = np.maximum(least, np.quantile(unknown, 1 - training.false_share, axis=0))
    return Model(weights, temperature, np.minimum(least, 0.95), templates(), training.contained)


def learned(docs: DataFrame, training: Training = Training()) -> Model:
    """Model with unknown windows from a bounded sample of ``docs``.

    The texts whose hash is low enough that ``training.texts`` rows of all are expected.
    """
    share = training.texts / max(1, docs.count())
    h = F.xxhash64("text")
    low = min(2**63 - 1, int(-(2**63) + min(1.0, share) * 2**64))
    # about ``texts`` different texts: copies are one, and only these leave their task
    chosen = docs.filter(F.octet_length("text").between(1, training.max_bytes)).filter(h <= low)
    texts = chosen.groupBy(h.alias("h")).agg(F.min("text").alias("text")).orderBy("h")
    corpus = []
    for text in texts.toArrow()["text"].to_pylist():
        words, _, _, first = lines_of(np.frombuffer(text.encode(), np.uint8))
        corpus += [words[a:b] for a, b in zip(first[:-1], first[1:])]
    return trained(corpus, training)


def best_template(words: np.ndarray, family: int, model: Model) -> tuple[float, int, int] | None:
    """(share of the template's pairs, first word, end) of the family's template that ``words`` hold most of."""
    best = None
    pairs = pairs_of(words)
    for t in model.templates:
        if t.family != family:
            continue
        at = np.searchsorted(t.pairs, pairs).clip(max=len(t.pairs) - 1)
        hit = np.flatnonzero(t.pairs[at] == pairs)
        if not len(hit):
            continue
        share = len(np.unique(pairs[hit])) / len(t.pairs)
        if share >= model.contained and (best is None or (share * t.words, t.words) > best[0]):
            best = (share * t.words, t.words), (share, int(hit[0]), int(hit[-1]) + 2)
    return best[1] if best else None


def found_in(words: np.ndarray, first: np.ndarray, model: Model) -> list[tuple[int, int, int, float, float]]:
    """(first word, end, family, probability, contained) of the notices of some whole paragraphs, in order."""
    a, b = windows_of(first)
    z = logits(words, a, b, model.weights) / model.temperature
    likely = np.flatnonzero(z.argmax(axis=1))  # no other window gives a family half of the probability
    p = softmax(z[likely])
    seen: dict[tuple[int, int, int], tuple[float, float]] = {}
    for k, chances in zip(likely, p):
        family = int(chances[1:].argmax()) + 1
        if chances[family] < model.least[family]:
            continue
        # the template may begin before the window and go on after it, within the paragraph
        line = np.searchsorted(first, a[k], "right") - 1
        size = max(t.words for t in model.templates if t.family == family)
        x, y = max(first[line], a[k] - size), min(first[line + 1], b[k] + size)
        best = best_template(words[x:y], family, model)
        if best:
            key = int(x + best[1]), int(x + best[2]), family
            seen[key] = max(seen.get(key, (0.0, 0.0)), (float(chances[family]), best[0]))
    # where two overlap, the one that holds more of its template stays, and takes in others of its family
    out: list[tuple[int, int, int, float, float]] = []
    for (i, j, f), (chance, share) in sorted(seen.items(), key=lambda x: (-x[1][1], -x[1][0], x[0])):
        over = [n for n in out if n[0] < j and i < n[1]]
        if not over:
            out.append((i, j, f, chance, share))
        elif len(over) == 1 and over[0][2] == f:
            out[out.index(over[0])] = (min(i, over[0][0]), max(j, over[0][1]), f, max(chance, over[0][3]), over[0][4])
    return sorted(out)


def scan(buf: np.ndarray, model: Model) -> tuple[int, list[tuple]]:
    """Number of paragraphs, and (start, end, family, probability, contained) of licence notices, in bytes."""
    words, starts, ends, first = lines_of(buf)
    out: list[tuple] = []
    for a, b in _blocks(first):
        x = first[a]
        for i, j, f, p, share in found_in(words[x : first[b]], first[a : b + 1] - x, model):
            out.append((int(starts[x + i]), int(ends[x + j - 1]), FAMILIES[f], p, share))
    return len(first) - 1, out


def _blocks(first: np.ndarray):
    """Runs of paragraphs of about BLOCK words (a longer paragraph is alone)."""
    a = 0
    while a < len(first) - 1:
        b = max(a + 1, int(np.searchsorted(first, first[a] + BLOCK, "right")) - 1)
        yield a, b
        a = b


_RESULT = "n_paragraphs long, notices array<struct<start:long,end:long,family:string,probability:double,contained:double>>"


def scanned(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``n_paragraphs`` and ``notices``; columns of these names are replaced.

    Notices have their characters' offsets, family, probability and the share of the template's word
    pairs that they hold; several windows on one notice are one.  A null or empty text has no
    paragraph; a notice has two words at least.  Rows are judged one by one and never moved, so
    equal rows give equal results, and an empty table gives none.  A very long text is worked
    on by blocks of paragraphs; only a paragraph is held whole.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("family", pa.string()), ("probability", pa.float64()), ("contained", pa.float64())]))

    def run(texts: pa.Array) -> pa.Array:
        counts, notices = [], []
        for buf in base.byte_rows(texts):
            n, found = scan(buf, shared.value)
            counts.append(n)
            chars = np.append(0, np.cumsum((buf & 0xC0) != 0x80)) if found else None
            notices.append([{"start": int(chars[s]), "end": int(chars[e]), "family": f, "probability": p, "contained": c} for s, e, f, p, c in found])
        return base.struct(n_paragraphs=pa.array(counts, pa.int64()), notices=pa.array(notices, kind))

    return base.with_results(docs, F.arrow_udf(run, _RESULT)(F.col("text")), ["n_paragraphs", "notices"])
