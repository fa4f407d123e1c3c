"""From raw documents to a training mix; each stage reads what the one before has written.

Every stage takes nulls in any column, empty and very long texts, repeated rows, further columns of
any name, and an empty table (which stays empty); what becomes of them is said with each.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import base, decontaminate, mixing, near_dup, quality_classifier, quality_rules


def _small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python workers ``base.TEXTS_PER_BATCH`` at a time, also in the write that follows a stage.

    The setting stays with the session: it bounds buffers and changes no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(base.TEXTS_PER_BATCH))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    A null or empty text has fewer than ten words and goes.  Equal rows share their fate; a null
    language is a language of its own.  Texts are judged whole.
    """
    _small_batches(spark)
    return quality_rules.kept_documents(docs)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.3 go; the model learns from the labels of the documents it gets.

    Without labels of both kinds all score alike, by the share of label 1.  A null or empty text scores that
    share too.  Equal texts share their fate; texts are scored whole.
    """
    _small_batches(spark)
    model = quality_classifier.learned(docs, base.table(spark, sf_dir, "labels"))
    return quality_classifier.kept_documents(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays.

    It is the one of least id (a null id last); of rows of the same id and text one stays.  A null
    or empty text, or one without words, is no copy of another.
    """
    _small_batches(spark)
    return near_dup.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go.

    A null or empty text has none and stays, as do all documents if the benchmark is empty.
    """
    _small_batches(spark)
    return decontaminate.decontaminated(docs, base.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in training order, once for each pass that takes words of them.

    A text without words is in no pass.  A null source is a source; equal rows each have their place.
    """
    return mixing.placements(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("rules", rules),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: The classifiers cannot be written as SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    docs = base.table(spark, sf_dir, "documents")
    last = len(STAGES) - 1
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        docs = out if k == last else base.written(out, f"pipeline-{name}")
    return docs
