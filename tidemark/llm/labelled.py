"""Bounded samples of labelled documents for the classifiers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import base


@dataclass(frozen=True)
class Sample:
    """``per_class`` rows of each label at most, of texts of at most ``max_bytes`` bytes."""

    per_class: int = 1500
    max_bytes: int = 20_000


def drawn(docs: DataFrame, labels: DataFrame, column: str, sample: Sample, folds: int = 5) -> tuple[DataFrame, dict[int, int]]:
    """(text, label) of a bounded sample of labelled rows, and how many labelled rows there are of each label.

    Only rows outside fold 0 count.  Null labels, ids and texts are left out.  The sample is
    fixed by hashes of the ids, so reruns agree.
    """
    usable = labels.filter(F.col(column).isin(0, 1) & F.col("doc_id").isNotNull() & (base.fold("doc_id", folds) != 0))
    usable = usable.select("doc_id", F.col(column).cast("int").alias("label"))
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    picked = None
    for label in (0, 1):
        part = usable.filter(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample.per_class)
        picked = part if picked is None else picked.union(part)
    texts = docs.filter(F.octet_length("text") <= sample.max_bytes).select("doc_id", "text")
    # the picked ids are at most 4 * per_class rows of two numbers
    found = texts.join(F.broadcast(picked), "doc_id").select("text", "label", F.xxhash64("doc_id", "text").alias("h"))
    parts = [found.filter(F.col("label") == label).orderBy("h").limit(sample.per_class) for label in (0, 1)]
    return parts[0].union(parts[1]).orderBy("h").select("text", "label"), counts
