import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import small
from tidemark.llm import quality_rules as Q


def brute(text):
    text = text or ""
    words = small.SPACED.findall(text)
    places = {}
    for i in range(len(words) - 4):
        places.setdefault(tuple(words[i : i + 5]), []).append(i)
    repeated = {j for at in places.values() if len(at) > 1 for i in at for j in range(i, i + 5)}
    lines = Counter(x for x in text.split("\n") if small.SPACED.search(x))
    symbols = sum(c in "#*$%&|<>" for c in text)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), symbols, sum(n - 1 for n in lines.values()), len(repeated), failed


def test_measures_equal_brute_force(spark):
    rng = random.Random(5)
    texts = small.odd_texts() + [" ".join(rng.choice("abc") for _ in range(n)) for n in (4, 5, 6, 9, 30)]
    texts += ["x y\nx y\n \nx y \n# | <>"] + [small.prose(rng, 50) + "\n" + small.prose(rng, 5) * 3]
    rows = Q.judged(small.documents(spark, texts).withColumnRenamed("source", "kept")).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == want
        assert not (r.base_failed and r.kept)


def test_repeated_words_of_many_different_words():
    ids = np.concatenate([np.arange(9000), np.arange(100, 120), np.arange(9000, 17000)])
    assert Q.repeated_words(ids, 5) == 40


def test_distance_is_the_jensen_shannon_distance():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.1, 0.2, 0.7])
    m = (p + q) / 2
    kl = lambda a: sum(x * np.log2(x / y) for x, y in zip(a, m) if x > 0)
    assert Q.distances(p, q[None, :])[0] == pytest.approx(np.sqrt((kl(p) + kl(q)) / 2))
    assert Q.distances(p, p[None, :])[0] == 0
    assert Q.distances(np.array([1.0, 0]), np.array([[0, 1.0]]))[0] == 1


def test_references_come_from_all_documents(spark):
    docs = spark.createDataFrame([(k, "alpha beta " * 5 + "Gamma", "xx") for k in range(20)] + [(20, None, "xx"), (21, "no lang", None)], "doc_id long, text string, lang string")
    refs = Q.references(docs)
    assert refs.langs == ("xx",) and set(refs.words) == {b"alpha", b"beta", b"gamma"}
    assert refs.shares[0][refs.words[b"alpha"]] == pytest.approx(5 / 11) and refs.chars.sum() == pytest.approx(1)


def test_prose_stays_and_strange_texts_go(spark):
    rng = random.Random(8)
    good = [" ".join(rng.choice(["the", "of", "and", "to", small.word(rng), small.word(rng)]) for _ in range(200)) for _ in range(60)]
    bad = [" ".join(w + "%%%" for w in good[0].split()), " | ".join(small.word(rng) for _ in range(200)), good[1].upper()]
    rows = Q.judged(small.documents(spark, good + bad)).collect()
    assert all(r.kept for r in rows[:60]) and not any(r.kept for r in rows[60:])
    assert {r.doc_id for r in Q.kept_documents(small.documents(spark, good + bad)).collect()} == set(range(60))


def test_documents_of_a_rare_language_stay(spark):
    rng = random.Random(11)
    prose = lambda words, n: " ".join(rng.choice(words) for _ in range(n))
    large, rare = [small.word(rng) for _ in range(200)], ["".join(chr(0x4E00 + rng.randrange(900)) for _ in range(6)) for _ in range(60)]
    docs = [(k, prose(large, 400), "en") for k in range(120)] + [(k, prose(rare, 100), "zh") for k in (200, 201)] + [(300, prose(large, 100).replace(" ", "%%% "), "zh")]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string")
    refs = Q.references(df.filter("doc_id < 300"))
    assert refs.langs == ("en",) and set(refs.own) == {"zh"}
    rows = {r.doc_id: r for r in Q.judged(df, refs).collect()}
    assert rows[200].kept and rows[201].kept and rows[200].char_distance < 0.1 and rows[200].word_distance < 0.4 and not rows[300].kept
    assert {200, 201} <= {r.doc_id for r in Q.kept_documents(df.filter("doc_id < 300")).collect()}
    other = Q.judged(df.filter("doc_id = 200").withColumn("lang", F.lit("xx")), refs).first()
    assert other.kept and other.char_distance is None and other.word_distance is None


def test_short_texts_pass_by_the_guards(spark):
    rows = Q.judged(small.documents(spark, ["UPPER CASE ONLY BUT SHORT A B C D E F G"] + [small.prose(random.Random(k), 100) for k in range(10)])).collect()
    assert rows[0].kept and rows[0].char_distance is None and rows[0].word_distance is None


def test_empty_table(spark):
    assert Q.judged(small.documents(spark, []).limit(0)).count() == 0
