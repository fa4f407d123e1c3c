import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm import small
from tidemark.llm import labelled, quality_classifier, toxicity

LABELS = "doc_id long, quality int, toxic int"


def labelled_texts(n=400):
    """Quality: a third are symbols, repeats or capitals.  Toxic: a third hold one of four words."""
    rng = random.Random(6)
    texts, labels = [], []
    for k in range(n):
        text = small.prose(rng, rng.randint(40, 120)).split()
        bad, toxic = k % 3 == 0, rng.random() < 0.35
        if bad:
            text = [[w + "%%%" for w in text], [w for w in text[:9] for _ in range(9)], [w.upper() + "!!" for w in text]][k // 3 % 3]
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(["zorka", "plimf", "Grumsk,", "wexot"]))
        texts.append(" ".join(text))
        labels.append((k, int(not bad), int(toxic)))
    return texts, labels


@pytest.fixture(scope="module")
def tables(spark):
    texts, labels = labelled_texts()
    return small.documents(spark, texts + small.odd_texts()), spark.createDataFrame(labels + [(None, 1, 1), (5, None, None), (10**6, 1, 0)], LABELS), labels


def held(k):
    return zlib.crc32(str(k).encode()) % 5 == 0


CASES = [(quality_classifier, 1, "quality", 0.3), (toxicity, 2, "toxic", 0.5)]


@pytest.mark.parametrize("module,at,column,threshold", CASES)
def test_held_out_accuracy(tables, module, at, column, threshold):
    docs, labels, truth = tables
    model = module.learned(docs, labels, column)
    rows = docs.select("doc_id", module.score_column(docs, model).alias("score")).collect()
    scores = {r.doc_id: r.score for r in rows}
    assert len(rows) == docs.count() and all(0 <= s <= 1 for s in scores.values())
    right = [(scores[t[0]] >= threshold) == t[at] for t in truth if held(t[0])]
    assert np.mean(right) >= 0.95


@pytest.mark.parametrize("module,at,column,threshold", CASES)
def test_held_out_labels_lang_and_source_are_not_looked_at(spark, tables, module, at, column, threshold):
    docs, labels, truth = tables
    swapped = labels.withColumn(column, F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col(column)).otherwise(F.col(column)))
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string"))
    a = [r.s for r in docs.select(module.score_column(docs, module.learned(docs, labels, column)).alias("s")).collect()]
    b = [r.s for r in other.select(module.score_column(other, module.learned(other, swapped, column)).alias("s")).collect()]
    assert a == b


@pytest.mark.parametrize("module", [quality_classifier, toxicity])
def test_without_labels_the_share_of_labels_scores(spark, module):
    docs = small.documents(spark, small.odd_texts())
    none = spark.createDataFrame([], LABELS)
    column = {quality_classifier: "quality", toxicity: "toxic"}[module]
    scores = {round(r.s, 9) for r in docs.select(module.score_column(docs, module.learned(docs, none, column)).alias("s")).collect()}
    assert scores == {0.5}
    assert docs.limit(0).select(module.score_column(docs, module.learned(docs.limit(0), none, column))).count() == 0


def test_kept_documents(tables):
    docs, labels, truth = tables
    left = quality_classifier.kept_documents(docs, quality_classifier.learned(docs, labels))
    ids = {r.doc_id for r in left.collect()}
    assert left.columns == docs.columns and np.mean([(t[0] in ids) == t[1] for t in truth]) > 0.97


def test_features_of_blocks_are_those_of_the_text():
    buf = np.frombuffer((small.prose(random.Random(1), 400)).encode(), np.uint8)
    from tidemark.llm import bytewords

    whole = np.sort(np.concatenate(list(quality_classifier.features(buf))))
    parts = list(bytewords.blocks(buf, 100))
    assert b"".join(p.tobytes() for p in parts) == buf.tobytes()
    cut = np.sort(np.concatenate([f for p in parts for f in quality_classifier.features(p)]))
    repeats = quality_classifier.REPEAT
    assert (whole[whole != repeats] == cut[cut != repeats]).all()


def test_convolution_looks_over_chunk_bounds(monkeypatch):
    rng = np.random.default_rng(0)
    f = toxicity.Training().filters
    tables = tuple(rng.normal(size=(toxicity.BUCKETS + 1, toxicity.PLACES * f)).astype(np.float32) for _ in range(toxicity.TABLES))
    model = toxicity.Model(tables, np.zeros(3 * f, np.float32), rng.normal(size=3 * f).astype(np.float32), 0.0)
    buf = np.frombuffer(small.prose(random.Random(2), 300).encode(), np.uint8)
    whole = toxicity.score(buf, model)
    monkeypatch.setattr(toxicity, "CHUNK", 7)
    assert toxicity.score(buf, model) == pytest.approx(whole, abs=1e-6)


def test_language_is_told_by_function_words():
    told = lambda t: toxicity.language(toxicity.words_of(np.frombuffer(t.encode(), np.uint8))[0])
    assert [told(t) for t in ("the cat of the house", "der Hund und die Katze", "le chat et les chiens", "el perro y los gatos", "zzz")] == ["en", "de", "fr", "es", None]


def test_sample_is_bounded_and_fixed(spark, tables):
    docs, labels, _ = tables
    sample, counts = labelled.drawn(docs.union(docs), labels, "quality", labelled.Sample(per_class=20, max_bytes=10_000))
    rows = sample.collect()
    assert sum(r.label for r in rows) == 20 and len(rows) == 40 and rows == sample.collect()
    assert sum(counts.values()) == sum(not held(k) for k in range(400)) + 1
