"""Licence scan: notices inside longer lines, a plain version of the window scores and of the template test."""

import math
import random

import numpy as np
import pytest

from tests.llm import small
from tidemark.llm import licenses as L


@pytest.fixture(scope="module")
def model():
    rng = random.Random(1)
    corpus = [L.words_of(small.prose(rng, rng.randint(3, 60))) for _ in range(200)]
    return L.trained(corpus, L.Training(variants=15, windows=1500, epochs=3))


def scan(text, model):
    raw = text.encode()
    return [(raw[s:e].decode(), family) for s, e, family, _, _ in L.scan(np.frombuffer(raw, np.uint8), model)[1]]


PLAIN = small.prose(random.Random(2), 40).replace(".", "")


@pytest.mark.parametrize("text, notice, family", [
    ("Released under the MIT License.", "Released under the MIT License", "MIT"),
    (f"{PLAIN} Released under the MIT License.", "Released under the MIT License", "MIT"),
    (f"{PLAIN} Licensed under the Apache License, Version 2.0. {PLAIN}", "Licensed under the Apache License, Version 2.0", "Apache"),
    ("Home About Us. All rights reserved. Terms Privacy Contact", "All rights reserved", "proprietary"),
    ("All rights reserved.", "All rights reserved", "proprietary"),
    (f"{PLAIN} This work is licensed under the GNU General Public License, version 3. {PLAIN} {PLAIN}", "This work is licensed under the GNU General Public License, version 3", "GPL"),
    ("Licensed under CC BY-NC 4.0.", "Licensed under CC BY-NC 4.0", "CC-BY-NC"),
])
def test_verbatim_notices_wherever_they_stand(model, text, notice, family):
    assert scan(text, model) == [(notice, family)]


@pytest.mark.parametrize("text", ["", "MIT", PLAIN, *L.HARD, "You may use this program under the conditions of the MIT licence", "This project uses the Apache 2 licence for all of its source code"])
def test_other_texts_have_no_notice(model, text):
    """The last two are paraphrases: they hold too little of any template to be confirmed."""
    assert scan(text, model) == []


def test_two_notices_in_one_line(model):
    text = f"{PLAIN} Released under the MIT License. {PLAIN} Licensed under CC BY-NC 4.0. {PLAIN}"
    assert [f for _, f in scan(text, model)] == ["MIT", "CC-BY-NC"]


def plain_windows(first):
    """All windows by their definition."""
    out = []
    for a, b in zip(first, first[1:]):
        if b - a <= L.SIZES[-1]:
            out.append((a, b))
        for size in L.SIZES:
            if b - a > size:
                k = 0
                while True:
                    end = min(a + k * (size // 2) + size, b)
                    out.append((end - size, end))
                    if end == b:
                        break
                    k += 1
    return sorted(out)


def test_windows_cover_every_paragraph():
    rng = random.Random(3)
    for _ in range(50):
        first = np.cumsum([0] + [rng.randint(1, 200) for _ in range(rng.randint(1, 6))])
        a, b = L.windows_of(first)
        assert sorted(zip(a.tolist(), b.tolist())) == plain_windows(first.tolist())


def test_scores_equal_a_plain_sum(model):
    rng = random.Random(4)
    words = L.words_of(" ".join([small.prose(rng, 100), "Released under the MIT License.", small.prose(rng, 50)]))
    first = np.array([0, 40, 41, len(words)])
    a, b = L.windows_of(first)
    got = L.logits(words, a, b, model.weights)
    buckets = L.grams(words)
    for k in range(0, len(a), 7):
        z = np.zeros(len(L.FAMILIES))
        for i in range(a[k], b[k]):
            for ids in buckets:
                if i < len(ids):
                    z += model.weights[ids[i]]
        assert got[k] == pytest.approx(z / math.sqrt(3 * (b[k] - a[k])) + model.weights[-1], abs=1e-6)


def plain_share(words, template):
    """Share of the template's distinct word pairs among those of ``words``."""
    held = set(zip(words, words[1:]))
    pairs = set(zip(template, template[1:]))
    return len(held & pairs) / len(pairs)


def test_a_notice_holds_its_share_of_a_template(model):
    every = [(f, small.plain_words(t)) for f, texts in L.TEMPLATES.items() for t in texts]
    rng = random.Random(5)
    for family, template in rng.sample(every, 12):
        n = len(template)
        for kept in range(2, n + 1, max(1, n // 5)):
            text = small.plain_words(PLAIN)[:10] + template[:kept] + small.plain_words(PLAIN)[10:20]
            words = L.words_of(" ".join(text))
            best = L.best_template(words, L.FAMILIES.index(family), model)
            want = max(plain_share(text, t) for f, t in every if f == family)
            assert (best is not None) == (want >= model.contained), (family, kept)


def test_blocks_change_nothing(model, monkeypatch):
    text = "\n".join([PLAIN, f"{PLAIN} Released under the MIT License.", "", "All rights reserved.", PLAIN] * 6)
    known = L.scan(np.frombuffer(text.encode(), np.uint8), model)
    monkeypatch.setattr(L, "BLOCK", 50)
    again = L.scan(np.frombuffer(text.encode(), np.uint8), model)
    assert [x[:3] for x in known[1]] == [x[:3] for x in again[1]] and known[0] == again[0] == 24 and len(known[1]) == 12


def test_odd_rows(spark, model):
    texts = small.odd_texts() + ["ü" * 3000 + " Released under the MIT License. " + "日本 " * 500] * 2
    docs = small.documents(spark, texts).withColumnRenamed("source", "n_paragraphs")
    rows = sorted(L.scanned(docs, model).collect(), key=lambda r: r.doc_id)
    assert [r.n_paragraphs for r in rows[:5]] == [0, 0, 0, 0, 1]
    for r in rows[-2:]:
        (n,) = r.notices
        assert r.text[n.start : n.end] == "Released under the MIT License" and n.family == "MIT"
    assert L.scanned(docs.limit(0), model).count() == 0
