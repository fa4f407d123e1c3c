"""Periodic runs against brute force, the grammar's agreements, the contract's digests, odd inputs."""

import hashlib
import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm import small
from tidemark.llm import base, periodic_runs, queries


def brute(words, least=12):
    """(start, length, period) of all runs, period by period."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        k = 0
        while k < n - p:
            s = k
            while k < n - p and words[k] == words[k + p]:
                k += 1
            length = k - s + p
            if length >= max(least, 2 * p):
                out.setdefault((s, length), p)
            k = max(k, s + 1)
    return sorted((s, length, p) for (s, length), p in out.items())


def periodic(rng, n, letters):
    w = [rng.randrange(letters) for _ in range(n)]
    for _ in range(rng.randrange(3)):
        a = rng.randrange(n + 1)
        p = 1 + rng.randrange(max(1, (n - a) // 2))
        for i in range(a, min(n, a + rng.randrange(1, 8) * p)):
            w[i] = w[a + (i - a) % p] if i < n else 0
    return w


def test_runs_equal_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        texts = [periodic(rng, rng.choice([0, 1, 11, 12, 13, 30, 90, 200]), rng.choice([1, 2, 3, 20])) for _ in range(rng.randint(1, 7))]
        got = periodic_runs.runs_of([np.array(t, np.int64) for t in texts])
        assert [list(map(tuple, g.tolist())) for g in got] == [brute(t) for t in texts]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=120))
def test_runs_of_any_sequence(words):
    (got,) = periodic_runs.runs_of([np.array(words, np.int64)])
    assert list(map(tuple, got.tolist())) == brute(words)


def test_long_texts_use_the_same_grids(monkeypatch):
    rng = random.Random(4)
    texts = [np.array(periodic(rng, 400, 3), np.int64) for _ in range(5)]
    known = periodic_runs.runs_of(texts)
    monkeypatch.setattr(periodic_runs, "SHORT", 10)
    for a, b in zip(known, periodic_runs.runs_of(texts)):
        assert np.array_equal(a, b)


def test_agreements_equal_a_plain_count():
    rng = random.Random(6)
    words = np.array([rng.randrange(2) for _ in range(300)] + [1] * 100, np.int64)
    symbols = np.concatenate([[0], words + 2, [1]]).astype(np.int32)
    levels = periodic_runs.grammar(symbols, 2)
    i = np.array([rng.randrange(1, 400) for _ in range(2000)])
    j = np.array([rng.randrange(1, 401) for _ in range(2000)])
    i, j = np.minimum(i, j)[i != j], np.maximum(i, j)[i != j]

    def plain(a, b, step, back):
        n = 0
        while symbols[a + step * n - back] == symbols[b + step * n - back]:
            n += 1
        return n

    assert list(periodic_runs.agreement(levels, i, j, True)) == [plain(a, b, 1, 0) for a, b in zip(i, j)]
    assert list(periodic_runs.agreement(levels, i, j, False)) == [plain(a, b, -1, 1) for a, b in zip(i, j)]


def test_the_grammar_ends_with_one_symbol_a_text():
    texts = [np.arange(500), np.zeros(500, np.int64), np.arange(1)]
    symbols = np.concatenate([[0], texts[0] + 4, [1], texts[1] + 4, [2], texts[2] + 4, [3]])
    top = periodic_runs.grammar(symbols, 4)[-1]
    assert len(top.symbols) == 7


def contract(doc_id, text):
    """The digest row by the contract's words, in plain Python."""
    words = small.SPACED.findall(text or "")
    n = len(words)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 0
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]
    runs = brute(words)
    gone = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
        sha("".join(f"{s},{length},{p}\n" for s, length, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in gone)),
    )


def digest_rows(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    out = queries.op12_periodic_runs(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    return sorted(map(tuple, out.collect()), key=repr)


def test_query_equals_the_contract(spark, tmp_path):
    rng = random.Random(8)
    texts = small.odd_texts() + [small.prose(rng, rng.choice([5, 20, 60, 200])) for _ in range(60)]
    texts += [" ".join(["a b c"] * 9), "x " * 40, "p q r s " * 3 + "t " * 13 + "p q r s " * 3]
    docs = small.documents(spark, texts).withColumn("runs", base.F.lit("clash")).withColumn("collapsed", base.F.lit(1))
    want = [contract(k, t) for k, t in enumerate(texts)]
    assert digest_rows(spark, docs, tmp_path) == sorted(want, key=repr)
    assert any(r[1] for r in want)


def test_no_rows_null_ids_and_repeated_rows(spark, tmp_path):
    rows = [(None, "a b " * 10, "en", "s", 0), (3, "a b " * 10, "en", "s", 0), (3, "a b " * 10, "en", "s", 0)]
    assert digest_rows(spark, spark.createDataFrame(rows, small.DOCS), tmp_path / "x") == sorted([contract(r[0], r[1]) for r in rows], key=repr)
    assert digest_rows(spark, spark.createDataFrame([], small.DOCS), tmp_path / "y") == []


def test_text_is_collapsed(spark):
    docs = spark.createDataFrame([(1, "start one two one two one two one two one two one two one two end")], "doc_id long, text string")
    row = periodic_runs.detected(docs).first()
    assert row.collapsed == "start one two end" and [tuple(r) for r in row.runs] == [(1, 14, 2)] and row.n_words == 16
