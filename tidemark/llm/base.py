"""What the operators of this subpackage share: columns, folds, results of Arrow functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: A word of the contracts that split at ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column | str, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text (0)."""
    col = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % folds


def lowered(text: Column) -> Column:
    """A-Z lower-cased, everything else as it is."""
    return F.translate(text, UPPER, UPPER.lower())


def with_results(df: DataFrame, result: Column, names: list[str], temp: str = "_llm_result") -> DataFrame:
    """``df`` with the fields of struct ``result`` as columns; a column of the same name is replaced."""
    while temp.lower() in {c.lower() for c in df.columns}:
        temp += "_"
    taken = {n.lower() for n in names}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in taken]
    return df.withColumn(temp, result).select(*kept, *[F.col(f"`{temp}`.{n}").alias(n) for n in names])


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``; a local one only where the session names none (tests)."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="tidemark-llm-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: Whole texts go to Python workers so many at a time, which bounds the buffers of both sides.
TEXTS_PER_BATCH = 1000


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows in the jobs that start inside; the session's own limit afterwards."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, lineage cut, safe from lost executors."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """:func:`written`, and the rows, counted by the job that writes them."""
    seen = Observation()
    out = written(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return out, seen.get["rows"]


def struct(**columns) -> pa.StructArray:
    return pa.StructArray.from_arrays([pa.array(v) if not isinstance(v, pa.Array) else v for v in columns.values()], names=list(columns))


def byte_rows(texts: pa.Array) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of each text, without copies; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = texts.fill_null("")
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    ends = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].tolist()
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    for a, b in zip(ends[:-1], ends[1:]):
        yield buf[a:b]


def per_text(fn: Callable[[np.ndarray], tuple], names: list[str], dtypes: list) -> Callable[[pa.Array], pa.Array]:
    """Arrow function that applies ``fn`` to the bytes of each text and gathers the tuples as a struct."""

    def run(texts: pa.Array) -> pa.Array:
        rows = [fn(b) for b in byte_rows(texts)]
        columns = list(zip(*rows)) if rows else [[] for _ in names]
        return struct(**{n: pa.array(list(c), t) for n, c, t in zip(names, columns, dtypes)})

    return run
