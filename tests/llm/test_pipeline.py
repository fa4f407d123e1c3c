"""All stages of the pipeline on empty tables, null values, repeated rows and clashing columns."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm import small
from tidemark.llm import base


def run(spark, folder, docs, labels=(), benchmark=()):
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(benchmark), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return base.written(corpus_pipeline.run(spark, str(folder)), "mix")


def test_empty_tables(spark, tmp_path):
    out = run(spark, tmp_path, spark.createDataFrame([], small.DOCS))
    assert out.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"] and out.count() == 0


@pytest.fixture
def odd(spark):
    rng = random.Random(3)
    texts = small.odd_texts() + [small.prose(rng, 80) for _ in range(8)]
    docs = small.documents(spark, texts)
    nulls = spark.createDataFrame([(None, small.prose(rng, 60), None, None, None), (None, None, None, None, None)], small.DOCS)
    rows = docs.union(nulls).union(docs.filter("doc_id = 15")).union(docs.filter("doc_id = 16"))
    # names that the stages use themselves
    return rows.withColumns({"digest": F.lit("x"), "kept": F.lit(1), "Class": F.lit(2.5), "row_id": F.lit(None).cast("string"), "label": F.lit("y"), "n_words": F.lit(0)})


def test_odd_rows_and_clashing_columns(spark, tmp_path, odd):
    passage = odd.filter("doc_id = 14").first().text.split()[10:30]
    out = run(spark, tmp_path, odd, benchmark=[(1, " ".join(passage)), (2, None), (None, "")])
    rows = out.collect()
    ids = {r.doc_id for r in rows}
    assert 14 not in ids, "a passage of the benchmark"
    assert not ids & {0, 1, 2, 3, 4, 5}, "texts of too few words go"
    assert {15, 16, None} <= ids and all(r.text and r.taken > 0 for r in rows)
    first = [r for r in rows if r.doc_id in (15, 16)]
    assert len({(r.doc_id, r.text) for r in first}) == 2
    assert {"digest", "kept", "Class", "row_id", "label"} <= set(out.columns)
