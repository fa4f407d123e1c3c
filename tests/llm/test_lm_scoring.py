import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tests.llm import small
from tidemark.llm import lm_scoring as L

PIECES = ["▁", "▁a", "▁ab", "a", "b", "c", "ab", "bc", "abc", "▁abc"]


def lattice():
    rng = np.random.default_rng(0)
    p = rng.uniform(0.5, 2, len(PIECES))
    return L.Lattice(PIECES, np.log(p / p.sum()))


def segmentations(word):
    if not word:
        yield []
    for n in range(1, len(word) + 1):
        if word[:n] in PIECES:
            yield from ([word[:n], *rest] for rest in segmentations(word[n:]))


WORDS = ["a", "b", "ab", "abc", "cab", "abcabcab", "ccc", "bab", "a" * 12]


def test_marginal_is_the_sum_over_all_segmentations():
    lat = lattice()
    p = dict(zip(PIECES, np.exp(lat.logs[2:])))
    want = [math.log(sum(math.prod(p[x] for x in seg) for seg in segmentations("▁" + w))) for w in WORDS]
    assert lat.marginals(WORDS) == pytest.approx(want)
    lat.LONG = 2  # the way of long words
    assert lat.marginals(WORDS) == pytest.approx(want)


def test_expected_counts_equal_brute_force():
    lat = lattice()
    p = dict(zip(PIECES, np.exp(lat.logs[2:])))
    want, times = Counter(), np.arange(1.0, len(WORDS) + 1)
    for w, c in zip(WORDS, times):
        segs = list(segmentations("▁" + w))
        weights = np.array([math.prod(p[x] for x in s) for s in segs])
        for s, share in zip(segs, weights / weights.sum()):
            for x in s:
                want[x] += c * share
    for long in (40, 2):
        lat.LONG = long
        assert lat.expected(WORDS, times)[2:] == pytest.approx([want[x] for x in PIECES])


def test_unknown_characters_and_very_long_words():
    lat = lattice()
    found = lat.marginals(["aéb", "日本", "x" * 39, "ab" * 3000, "🙂"])
    assert np.isfinite(found).all() and found[2] == pytest.approx(39 * lat.logs[lat.UNKNOWN] + lat.logs[2])
    assert np.isfinite(lat.expected(["🙂" * 30, "é" * 39, "y" * 200], np.ones(3))).all()


def test_more_rounds_make_the_words_likelier():
    lat, before = lattice(), -1e9
    for _ in range(4):
        now = lat.marginals(WORDS).sum()
        assert now >= before - 1e-9
        before, lat = now, lat.reweighted(lat.expected(WORDS, np.ones(len(WORDS))), 1e-6)


def brute(rows):
    tokens = {k: small.SPACED.findall((t or "").translate(small.LOWER)) + [None] for k, t in rows}
    counts = Counter(w for k, ws in tokens.items() if zlib.crc32(str(k).encode()) % 5 != 1 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return tokens, counts, n, {k: sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws) for k, ws in tokens.items()}


@pytest.mark.parametrize("min_share", [1e-5, 0.02, 2.0])
def test_scores(spark, min_share):
    """The base equals brute force, and the scores the stated formulas, whatever words count as frequent."""
    rng = random.Random(9)
    texts = small.odd_texts() + [small.prose(rng, 60) for _ in range(40)]
    docs = small.documents(spark, texts).withColumnRenamed("n_chars", "score")
    rows = {r.doc_id: r for r in L.scored(docs, L.Settings(min_share=min_share)).collect()}
    tokens, counts, n, base = brute(list(enumerate(texts)))
    _, totals = L.learned(docs)
    lat = L.Lattice.read(L.VOCABULARY)
    seen = [w for w in counts if w is not None]
    for _ in range(L.Settings().rounds):
        lat = lat.reweighted(lat.expected(seen, np.array([counts[w] for w in seen], float)), L.Settings().prior)
    for k, ws in tokens.items():
        r = rows[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (zlib.crc32(str(k).encode()) % 5 == 1, len(ws), sum(counts[w] > 0 for w in ws), n)
        assert r.base_score == pytest.approx(base[k])
        marginals = lat.marginals(ws[:-1])
        mixed = totals.interpolated(np.array([counts[w] for w in ws[:-1]]), marginals).sum() if len(ws) > 1 else 0
        assert r.interpolated_score == pytest.approx(mixed + totals.end())
        end = (counts[None] + 0.5) / (n + 1)
        assert r.score == pytest.approx(marginals.sum() / math.log(10) + (len(ws) - 1) * math.log10(1 - end) + math.log10(end))


@pytest.mark.parametrize("min_share", [1e-5, 0.2])
def test_score_is_the_sum_over_all_segmentations(spark, monkeypatch, min_share):
    """A small vocabulary: learned and summed up over every segmentation, in plain Python."""
    monkeypatch.setattr(L.Lattice, "read", classmethod(lambda cls, path: lattice()))
    rng = random.Random(12)
    texts = [" ".join("".join(rng.choice("aabc") for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 12))) for _ in range(25)]
    settings = L.Settings(min_share=min_share, prior=3.0)
    rows = {r.doc_id: r.score for r in L.scored(small.documents(spark, texts), settings).collect()}
    tokens, counts, n, _ = brute(list(enumerate(texts)))
    p = dict(zip(PIECES, np.exp(lattice().logs[2:])))
    chance = lambda seg: math.prod(p[x] for x in seg)
    for _ in range(settings.rounds):
        found = Counter({x: settings.prior * p[x] for x in PIECES})
        for word, times in counts.items():
            segs = list(segmentations("▁" + word)) if word else []
            for seg in segs:
                for x in seg:
                    found[x] += times * chance(seg) / sum(map(chance, segs))
        p = {x: found[x] / sum(found.values()) for x in PIECES}
    end = (counts[None] + 0.5) / (n + 1)
    for k, words in tokens.items():
        want = math.log10(end) + sum(math.log10((1 - end) * sum(map(chance, segmentations("▁" + w)))) for w in words[:-1])
        assert rows[k] == pytest.approx(want)


def test_words_that_only_held_out_texts_have_are_scored_in_place(spark):
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 5 == 1][:60]
    docs = spark.createDataFrame([(k, "seen twice" if k not in held else "never " * 50) for k in range(400)], "doc_id long, text string")
    scores, totals = L.learned(docs)
    (row,) = scores.filter("decode(word, 'utf-8') = 'never'").collect()
    assert (row.n, row.total) == (0, 3000) and row.total > totals.occurrences * L.Settings().min_share
    rows = L.scored(docs).filter("held_out").limit(5).collect()
    assert all(r.n_known == 1 + 2 * (r.n_tokens == 3) for r in rows)


def test_probabilities_of_words_and_end_sum_to_at_most_one():
    lat = lattice()
    totals = L.Totals(tokens=100, ends=10, words=3, discount=0.6)
    known = ["a", "ab", "cab"]
    mass = (10 ** totals.interpolated(np.array([50, 30, 10]), lat.marginals(known))).sum() + 10 ** totals.end()
    others = [x + y + z for x in "abc" for y in "abc" for z in ("", "a", "b", "c") if x + y + z not in known]
    assert 0.9 < mass + (10 ** totals.interpolated(np.zeros(len(others)), lat.marginals(others))).sum() <= 1 + 1e-9


def test_empty_table_and_no_training_documents(spark):
    docs = small.documents(spark, ["a b"])
    assert L.scored(docs.limit(0)).count() == 0
    only = docs.selectExpr("cast(4 as long) doc_id", "text")
    k = next(k for k in range(100) if zlib.crc32(str(k).encode()) % 5 == 1)
    r = L.scored(only.selectExpr(f"cast({k} as long) doc_id", "text")).first()
    assert r.held_out and (r.train_tokens, r.n_known, r.base_score) == (0, 0, 0) and -100 < r.score < 0
