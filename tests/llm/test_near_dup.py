import random

import numpy as np
import pyarrow as pa
import pytest

from tests.llm import small
from tidemark.llm import base, bytewords
from tidemark.llm import near_dup as N


def brute_classes(texts):
    sets = [small.shingle_set(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and sets[b] and small.jaccard(sets[a], sets[b]) >= 0.8:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(len(texts))]


def corpus():
    rng = random.Random(4)
    texts = small.odd_texts() + ["word", "WORD!", "", None, "two words", "Two, words."]
    for _ in range(12):
        base = small.prose(rng, 120)
        texts += [base, base.upper(), small.edited(rng, base, 1), small.edited(rng, base, 2), small.edited(rng, base, 9)]
    hub = small.prose(rng, 150)  # a large group: most members are close to the hub only
    texts += [small.edited(rng, hub, rng.randint(1, 5)) for _ in range(60)] + [hub] * 15
    passage = small.prose(rng, 60)
    return texts + [passage + " " + small.prose(rng, 40) for _ in range(20)]


def test_classes_equal_brute_force(spark):
    texts = corpus()
    got = {r.doc_id: r for r in N.classes(small.documents(spark, texts)).collect()}
    want = brute_classes(texts)
    assert [got[k].class_id for k in range(len(texts))] == want
    assert all(got[k].class_size == want.count(want[k]) for k in range(len(texts)))


def test_pairs_among_many_texts_of_one_template(spark):
    rng = random.Random(7)
    template = small.prose(rng, 200)  # any two have 0.784, and 25 pairs of 0.806 mostly share hot buckets only
    own = [small.prose(rng, 27) for _ in range(125)]
    texts = [f"{template} {x}" for x in own] + [f"{template} {' '.join(x.split()[:3])} {small.prose(rng, 24)}" for x in own[::5]]
    got = {r.doc_id: r.class_id for r in N.classes(small.documents(spark, texts)).collect()}
    want = brute_classes(texts)
    assert len(set(want)) == 125 and [got[k] for k in range(len(texts))] == want


def test_a_repeated_passage_hides_no_pair():
    rng = random.Random(9)
    missed = 0
    for _ in range(60):
        words = small.prose(rng, 150).split()
        pair = [small.edited(rng, " ".join(words), 2), " ".join(words[:40] * 20 + words)]
        if small.jaccard(*map(small.shingle_set, pair)) >= 0.8:
            x, y = N._features(N.Settings())(pa.array(pair)).field("bands").to_pylist()
            missed += not {*x} & {*y}
    assert missed == 0


def test_one_of_each_group_stays(spark):
    texts = corpus()
    docs = small.documents(spark, texts).withColumnRenamed("source", "digest")
    left = N.one_of_each(docs.union(docs.filter("doc_id in (5, 30)")))
    assert left.columns == docs.columns
    assert sorted(r.doc_id for r in left.collect()) == sorted(set(brute_classes(texts)))


def test_registers_agree_as_probability_jaccard():
    rng = np.random.default_rng(1)
    elements = bytewords.mix(np.arange(60, dtype=np.uint64))
    x, y = dict(zip(range(40), rng.uniform(0.5, 4, 40))), dict(zip(range(10, 60), rng.uniform(0.5, 4, 50)))
    exact = sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in {*x, *y}) for i in {*x} & {*y})
    agree = n = 0
    for turn in range(40):
        salted = bytewords.mix(elements + np.uint64(1000 * turn))
        a, b = (N.prob_minhash(salted[list(w)], np.array(list(w.values()))) for w in (x, y))
        agree, n = agree + (a == b).sum(), n + len(a)
    assert agree / n == pytest.approx(exact, abs=0.03)


def test_early_termination_does_not_change_the_registers():
    elements = bytewords.mix(np.arange(300, dtype=np.uint64))
    whole = N.prob_minhash(elements, np.ones(300))
    assert len(set(whole.tolist())) > 60 and set(whole.tolist()) <= set(elements.tolist())
    assert (N.prob_minhash(elements[::-1], np.ones(300)) == whole).all()
    assert (N.prob_minhash(elements[:1], np.ones(1)) == elements[0]).all()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(f"{k:03d}", f"{k + 1:03d}") for k in range(40)] + [("x", "y"), ("y", "z"), ("z", "x")], "a string, b string")
    got = {r.node: r.label for r in N.components(links).collect()}
    assert got == {f"{k:03d}": "000" for k in range(41)} | dict.fromkeys("xyz", "x")


def test_empty_table_and_rows_of_one_id(spark):
    docs = small.documents(spark, ["a b c d e f"])
    assert N.classes(docs.limit(0)).count() == 0 and N.one_of_each(docs.limit(0)).count() == 0
    same = docs.union(docs).union(docs.selectExpr("cast(null as long) doc_id", "'other words' text", "lang", "source", "n_chars"))
    assert N.classes(same).count() == 3 and N.one_of_each(same).count() == 2


@pytest.mark.parametrize("own, inside", [("10000", "1000"), ("300", "300"), ("0", "1000")])
def test_batches_are_bounded_only_inside(spark, own, inside):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, own)
        with pytest.raises(ValueError), base.batches_of(spark, 1000):
            assert spark.conf.get(key) == inside
            raise ValueError
        assert spark.conf.get(key) == own
    finally:
        spark.conf.set(key, before)
