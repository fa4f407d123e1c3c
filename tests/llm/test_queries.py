"""The registered queries: SQL where there is some, whole tables, and the pipeline stage by stage."""

import os
from types import SimpleNamespace

import pytest

import corpus_pipeline
from tests import oracle
from tests.llm import small
from tidemark.llm import base, near_dup, queries

SF_DIR = os.environ.get("CATALOGUE_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_sql(spark, name):
    query = SimpleNamespace(run=queries.QUERIES[name], sql=queries.SQL[name])
    assert oracle.compare(query, spark, oracle.connect(SF_DIR), SF_DIR) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_a_row_for_each_row(spark, name):
    out = queries.QUERIES[name](spark, SF_DIR)
    source, key = ("pages", "page_id") if "page_id" in out.columns else ("documents", "doc_id")
    want = sorted(r[0] for r in base.table(spark, SF_DIR, source).select(key).collect())
    assert sorted(r[0] for r in out.select(key).collect()) == want


def test_registered_under_the_entry_point():
    import __spark_entry__ as entry

    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries())
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{k}" for k in range(1, 14)}


def test_pipeline_stages(spark):
    docs = base.table(spark, SF_DIR, "documents")
    ids = lambda df: sorted(r.doc_id for r in df.collect())
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, base.written(stage(spark, docs, SF_DIR), name)
        assert docs.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
        kept[name] = before, docs
    judged = queries.quality_rules.judged(kept["rules"][0])
    assert ids(kept["rules"][1]) == ids(judged.filter("kept"))
    assert 0 < kept["quality"][1].count() < kept["quality"][0].count()
    classes = near_dup.classes(kept["near_duplicates"][0])
    assert ids(kept["near_duplicates"][1]) == sorted({r.class_id for r in classes.collect()})
    before, after = kept["decontamination"]
    items = [small.plain_words(r.text) for r in base.table(spark, SF_DIR, "benchmark").collect()]
    windows = {tuple(w[i : i + min(10, len(w))]) for w in items if w for i in range(max(1, len(w) - 9))}

    def clean(text):
        w = small.plain_words(text)
        return not any(tuple(w[i : i + n]) in windows for n in {len(x) for x in windows} for i in range(len(w) - n + 1))

    assert ids(after) == sorted(r.doc_id for r in before.collect() if clean(r.text))
    before, after = kept["mix"]
    rows = after.collect()
    assert set(ids(before)) >= {r.doc_id for r in rows} and all(r.taken > 0 for r in rows)
    total = sum(len(small.SPACED.findall(r.text or "")) for r in before.collect())
    assert abs(sum(r.taken for r in rows) - 1.5 * total) <= 25


def test_tables_go_to_the_shared_folder_of_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert base.shared_folder(spark, "x").startswith(root.rstrip("/") + "/x-")
