import random

import pytest

from tests.llm import small
from tidemark.llm import decontaminate as D


def brute(text, items, window=10):
    words = small.plain_words(text)
    hit, ids = set(), set()
    for item_id, item in items:
        own = small.plain_words(item)
        n = min(window, len(own))
        for i in range(len(own) - n + 1) if n else ():
            for j in range(len(words) - n + 1):
                if words[j : j + n] == own[i : i + n]:
                    hit |= set(range(j, j + n))
                    ids.add(item_id)
    return len(words), len(hit), sorted(str(i) for i in ids if i is not None)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    items = [(k, small.prose(rng, rng.choice([3, 9, 10, 14, 30]))) for k in range(12)] + [(12, ""), (13, None), (14, "?!"), (None, small.prose(rng, 12)), (3, small.prose(rng, 11))]
    texts = small.odd_texts()
    for k, (_, item) in enumerate(items):
        words = (item or "x").split()
        cut = words[: max(1, len(words) - k % 3)]
        texts.append(small.prose(rng, 20) + " " + " ".join(cut).upper() + "; " + small.prose(rng, 5))
    texts.append((items[4][1] + " ") * 3)
    return items, texts


def test_equals_brute_force(spark, case):
    import hashlib

    items, texts = case
    docs = small.documents(spark, texts + texts[-2:]).withColumnRenamed("n_chars", "n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = D.digested(D.scanned(docs, bench)).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        n, hit, ids = brute(r.text, items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, hit, len(ids), hit > 0)
        assert r.items_sha256 == hashlib.sha256(",".join(ids).encode()).hexdigest()


def test_blocks_of_items_give_the_same(spark, case):
    items, texts = case
    docs, bench = small.documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    one = D.digested(D.scanned(docs, bench)).drop("hits").collect()
    assert one == D.digested(D.scanned(docs, bench, block_words=20)).drop("hits").collect()


def test_offsets_point_into_the_original(spark):
    item = "Öl und Wasser, one two three four five six seven eight"
    text = "Ünd vorher … ÖL!! Öl UND wasser -- one two three four five six seven eight nachher"
    docs, bench = small.documents(spark, [text]), spark.createDataFrame([(1, item)], "item_id long, text string")
    hits = D.scanned(docs, bench).first().hits
    assert text[hits[0].start : hits[0].end] == "Öl UND wasser -- one two three four five six seven"
    assert D.cut_out(text, [h.asDict() for h in hits]) == "Ünd vorher … ÖL!!  nachher"


def test_clean_documents_stay(spark, case):
    items, texts = case
    docs, bench = small.documents(spark, texts), spark.createDataFrame(items, "item_id long, text string")
    left = {r.doc_id for r in D.decontaminated(docs, bench).collect()}
    assert left == {k for k, t in enumerate(texts) if not brute(t, items)[1]}


def test_empty_tables(spark):
    docs, none = small.documents(spark, ["a b"]), spark.createDataFrame([], "item_id long, text string")
    assert D.digested(D.scanned(docs, none)).first().n_hit == 0
    assert D.digested(D.scanned(docs.limit(0), none)).count() == 0
    assert D.decontaminated(docs, none).count() == 1
